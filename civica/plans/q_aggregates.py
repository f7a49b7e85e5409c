"""Catalogue, part 4: profiles, extents, bounding, formatting, quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from civica.functions.numbers import clip, fixed_decimals, floor_at
from civica.operators import quality as Q
from civica.operators import trends as TR
from civica.operators.aggregates import correlation, distinct_sorted, extents as extents_op, group_sums, shape
from civica.operators.rows import drop_null_rows, latest_period
from civica.plans import carriers as C
from civica.plans.q_tables import NULL_ORDERS_SQL, _orders_with_nulls
from civica.plans.registry import query, table
from civica.session import cut_lineage

_NULL_COLS = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_comment_score"]


@query("null_profile", "A8 Q1", f"""
WITH {NULL_ORDERS_SQL}
SELECT 'load' AS stage, (SELECT count(*) FROM nulled) AS n_rows, 4 AS n_columns, column_name, n_null FROM (
""" + "\n  UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM nulled"
                          for c in _NULL_COLS) + ")")
def null_profile(spark, d):
    return Q.profile(_orders_with_nulls(spark, d), "load")


@query("profile_in_passing", "Q1 A8", f"""
WITH {NULL_ORDERS_SQL}, priced AS (SELECT * FROM nulled WHERE o_totalprice IS NOT NULL)
""" + "\nUNION ALL ".join(
    f"SELECT '{stage}' AS stage, (SELECT count(*) FROM {src}) AS n_rows, 4 AS n_columns, '{c}' AS column_name, "
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM {src}"
    for stage, src in (("load", "nulled"), ("priced", "priced")) for c in _NULL_COLS))
def profile_in_passing(spark, d):
    profiles = Q.Profiles()
    loaded = cut_lineage(profiles.watch(_orders_with_nulls(spark, d), "load"), name="load")
    cut_lineage(profiles.watch(drop_null_rows(loaded, ["o_totalprice"]), "priced"), name="priced")
    return profiles.rows(spark)


@query("shape_profile", "A9", "SELECT count(*) AS n_rows, 6 AS n_columns FROM orders")
def shape_profile(spark, d):
    return shape(table(spark, d, "orders"))


@query("latest_period_means", "F9 A4", f"""
WITH {C.VOTES_SQL}
SELECT nom, annee, round(avg(voix), 6) AS mean_voix FROM votes
WHERE annee = (SELECT max(annee) FROM votes) GROUP BY nom, annee""")
def latest_period_means(spark, d):
    v = latest_period(C.votes(spark, d), "annee")
    return v.groupBy("nom", "annee").agg(F.round(F.avg("voix"), 6).alias("mean_voix"))


@query("extents", "A6 A7", f"""
WITH {C.VOTES_SQL}
SELECT min(voix) AS min_voix, max(voix) AS max_voix, min(annee) AS min_annee, max(annee) AS max_annee,
       count(DISTINCT annee) AS n_annees FROM votes""")
def extents(spark, d):
    e = extents_op(C.votes(spark, d), ["voix", "annee"], distinct=["annee"])
    return e.withColumnRenamed("n_annee", "n_annees")


@query("distinct_periods", "A7", f"""
WITH {C.VOTES_SQL}
SELECT DISTINCT annee FROM votes WHERE annee IS NOT NULL ORDER BY annee""")
def distinct_periods(spark, d):
    return distinct_sorted(C.votes(spark, d), "annee")


_SHARE_SQL = f"""WITH {C.VOTES_SQL},
g AS (SELECT annee, code_region, nom, sum(voix) AS voix FROM votes GROUP BY 1, 2, 3),
s AS (SELECT *, 100 * voix / sum(voix) OVER (PARTITION BY annee, code_region) AS share FROM g)"""


def _region_shares(spark, d):
    from civica.operators.shares import normalise_shares
    g = group_sums(C.votes(spark, d), ["annee", "code_region", "nom"], {"voix": "voix"})
    return normalise_shares(g, ["annee", "code_region"], "voix")


@query("clip_floor", "X5 X6", _SHARE_SQL + """
SELECT annee, code_region, nom, round(least(greatest(share, 10), 60), 6) AS share_clip,
       round(greatest(1, share - 10), 6) AS share_floor FROM s""")
def clip_floor(spark, d):
    s = _region_shares(spark, d)
    return s.select("annee", "code_region", "nom", F.round(clip("share", 10, 60), 6).alias("share_clip"),
                    F.round(floor_at(F.col("share") - 10, 1), 6).alias("share_floor"))


@query("format_scores", "X9", f"""
WITH {C.VOTES_SQL}
SELECT nom, printf('%.3f', sum(voix)) AS score FROM votes GROUP BY nom""")
def format_scores(spark, d):
    g = group_sums(C.votes(spark, d), ["nom"], {"voix": "voix"})
    return g.select("nom", fixed_decimals("voix", 3).alias("score"))


_YEARLY_SQL = f"""WITH {C.VOTES_SQL},
y AS (SELECT nom, annee, sum(voix) / 1e6 AS v FROM votes GROUP BY 1, 2)"""


def _yearly_millions(spark, d):
    g = group_sums(C.votes(spark, d), ["nom", "annee"], {"voix": "voix"})
    return g.withColumn("v", F.col("voix") / 1e6)


@query("curve_grid", "X10 M20", _YEARLY_SQL + """,
f AS (SELECT nom, regr_slope(v, annee) AS slope, avg(annee) AS xbar, avg(v) AS ybar FROM y GROUP BY nom),
g AS (SELECT nom, i, 1995 + i * (2003 - 1995) / 99.0 AS x, slope, xbar, ybar
      FROM f, generate_series(0, 99) AS t(i))
SELECT nom, CAST(i AS INTEGER) AS i, round(x, 6) AS x, round(ybar + slope * (x - xbar), 6) AS y FROM g""")
def curve_grid(spark, d):
    fit = TR.linear_fit(_yearly_millions(spark, d), ["nom"], "annee", "v")
    c = TR.curve(fit, 1995, 2003, 100, kind="linear")
    return c.select("nom", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("bounded_curve", "M20 M14", _YEARLY_SQL + """,
f AS (SELECT nom, regr_slope(v, annee) AS slope, avg(annee) AS xbar, avg(v) AS ybar FROM y GROUP BY nom),
c AS (SELECT nom, 'curve' AS kind, 1995 + i * (2003 - 1995) / 99.0 AS x, slope, xbar, ybar
      FROM f, generate_series(0, 99) AS t(i)),
p AS (SELECT nom, 'predicted' AS kind, x, slope, xbar, ybar FROM f, (VALUES (2002.0::DOUBLE), (2003.0::DOUBLE)) AS t(x)),
fit AS (SELECT nom, kind, x, ybar + slope * (x - xbar) AS v FROM (SELECT * FROM c UNION ALL SELECT * FROM p))
SELECT nom, kind, round(x, 6) AS x, round(CASE WHEN kind = 'curve' THEN least(greatest(v, 0), 40) ELSE v END, 6) AS value FROM fit
UNION ALL SELECT nom, 'observed', CAST(annee AS DOUBLE), round(v, 6) FROM y""")
def bounded_curve(spark, d):
    """The data behind a trend plot: the observed points with the
    predictions in one line, and the fitted curve, bounded."""
    y = _yearly_millions(spark, d)
    fit = TR.linear_fit(y, ["nom"], "annee", "v")
    line = TR.history_and_forecast(y, TR.linear_predict(fit, [2002, 2003]), ["nom"], "annee", "v")
    line = line.select("nom", "kind", F.col("annee").cast("double").alias("x"), F.round("value", 6).alias("value"))
    c = TR.curve(fit, 1995, 2003, 100, kind="linear", lo=0.0, hi=40.0)
    return line.unionByName(c.select("nom", F.lit("curve").alias("kind"), F.round("x", 6).alias("x"),
                                     F.round("y", 6).alias("value")))


@query("range_check", "Q2", _SHARE_SQL + """
SELECT annee, code_region, round(sum(share * (1 + (code_region % 3 - 1) / 10.0)), 6) AS total,
       sum(share * (1 + (code_region % 3 - 1) / 10.0)) BETWEEN 95 AND 105 AS in_range
FROM s GROUP BY 1, 2""")
def range_check(spark, d):
    # Shares of two in three regions are off by a tenth, so they miss the range.
    s = _region_shares(spark, d).withColumn("share", F.col("share") * (1 + (F.col("code_region") % 3 - 1) / 10.0))
    r = Q.range_check(s, ["annee", "code_region"], "share", 95, 105)
    return r.select("annee", "code_region", F.round("total", 6).alias("total"), "in_range")


# Columns a model run needs from each input table (one deliberately absent).
REQUIRED = {"orders": ["o_orderkey", "o_totalprice", "o_orderdate", "pourcentage_voix_exprimes"],
            "customer": ["c_custkey", "c_nationkey", "nom"]}


@query("required_columns", "Q3", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    + (f"true AS present, count({c}) AS n_values FROM {t}" if c.startswith(("o_", "c_"))
       else "false AS present, CAST(NULL AS BIGINT) AS n_values")
    for t, cols in REQUIRED.items() for c in cols))
def required_columns(spark, d):
    """Q3 plus a count of the values held by each required column: one
    aggregate per table emits all its check rows."""
    parts = []
    for t, cols in REQUIRED.items():
        df = table(spark, d, t)
        missing = set(Q.require_columns(df, cols))
        checks = [F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                           F.lit(c not in missing).alias("present"),
                           (F.lit(None).cast("bigint") if c in missing else F.count(c)).alias("n_values"))
                  for c in cols]
        parts.append(df.agg(F.array(*checks).alias("__checks")).select(F.inline("__checks")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("min_history", "Q5", f"""
WITH {C.VOTES_SQL},
y AS (SELECT o.o_custkey, v.annee, sum(v.voix) AS voix FROM votes v JOIN orders o ON v.o_orderkey = o.o_orderkey
      GROUP BY 1, 2)
SELECT o_custkey, count(voix) AS n_points FROM y GROUP BY o_custkey HAVING count(voix) >= 3""")
def min_history(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("annee"), "o_totalprice")
    y = group_sums(o, ["o_custkey", "annee"], {"voix": "o_totalprice"})
    return Q.min_history(y, ["o_custkey"], "voix", 3)


@query("constraint_audit", "Q6 K7", """
SELECT 'pk_orders' AS check_name, count(*) AS n_violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'pk_customer', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'pk_lineitem', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'fk_orders_customer', count(*) FROM orders o WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'fk_customer_nation', count(*) FROM customer c WHERE c.c_nationkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey)
UNION ALL SELECT 'fk_nation_region', count(*) FROM nation n WHERE n.n_regionkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM region r WHERE r.r_regionkey = n.n_regionkey)
UNION ALL SELECT 'fk_lineitem_orders', count(*) FROM lineitem l WHERE l.l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'fk_lineitem_part', count(*) FROM lineitem l WHERE l.l_partkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)""")
def constraint_audit(spark, d):
    t = {n: table(spark, d, n) for n in ("orders", "customer", "lineitem", "nation", "region", "part")}
    return Q.constraint_audit([
        Q.duplicate_keys(t["orders"], ["o_orderkey"], "pk_orders"),
        Q.duplicate_keys(t["customer"], ["c_custkey"], "pk_customer"),
        Q.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"], "pk_lineitem"),
        Q.orphans(t["orders"], "o_custkey", t["customer"], "c_custkey", "fk_orders_customer"),
        Q.orphans(t["customer"], "c_nationkey", t["nation"], "n_nationkey", "fk_customer_nation"),
        Q.orphans(t["nation"], "n_regionkey", t["region"], "r_regionkey", "fk_nation_region"),
        Q.orphans(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey", "fk_lineitem_orders"),
        Q.orphans(t["lineitem"], "l_partkey", t["part"], "p_partkey", "fk_lineitem_part"),
    ])


@query("correlation", "A13", f"""
WITH {C.VOTES_SQL}, {C.POVERTY_SQL},
y AS (SELECT annee, sum(voix) AS voix FROM votes GROUP BY annee),
j AS (SELECT y.annee, y.voix, p.taux FROM y JOIN pauvrete p ON y.annee = p.annee)
SELECT CAST(regr_count(voix, taux) AS BIGINT) AS n, round(corr(voix, taux), 9) AS corr, round(regr_r2(voix, taux), 9) AS r2 FROM j""")
def correlation_q(spark, d):
    y = group_sums(C.votes(spark, d), ["annee"], {"voix": "voix"})
    j = y.join(C.yearly_poverty(spark, d), "annee")
    return correlation(j, "taux", "voix").select("n", F.round("corr", 9).alias("corr"), F.round("r2", 9).alias("r2"))


@query("empty_guard", "Q4 S5", """
SELECT count(*) AS n_rows FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001""")
def empty_guard(spark, d):
    """Q4: the year-range scan that feeds training must not be empty (one
    ``LIMIT 1`` job fails fast otherwise); its row count is returned."""
    from civica.sources.warehouse import scan_years
    df = Q.ensure_not_empty(scan_years(table(spark, d, "orders"), "o_orderdate", 1995, 2001), "training scan")
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
