"""DataFrame → DataFrame operators (column names are parameters).

columns     header harmonisation, renames, projections (P1-P14, C5)
rows        filters, ordering, top-k, distinct, unions (F1-F9, T1-T5, U1-U2)
reshape     wide ↔ long: generators and pivots (R1-R9)
joins       equi-joins with suffixes, lookups, keyword labels (J1-J8)
aggregates  grouped and global aggregates, scalar subqueries (A1-A10, A13, M9)
windows     lag (two-level for hot groups), arg-max rows, fills, changes (W1-W6)
shares      party totals, shares, caps, rankings (A11, A12, M13, M18, T3)
quality     profiles, range checks, history, constraint audit (Q1-Q7)
trends      linear / quadratic fits per series, ARIMA, curves (M3-M5, M14-M17, M20)
features    hash split, exact quantiles, robust scaling (M1, M2)
model       MLlib training, scoring, scenarios, national totals (M6-M8, M19, M22)
evaluate    R², MAE, majority-class metrics (M10-M12, M21)
"""
