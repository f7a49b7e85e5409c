"""Per-series trends and forecasts.

A series is a short, already aggregated time series (one value per year or
day for one party or indicator).  All series are fitted at once: linear and
quadratic fits are closed-form grouped aggregates (one shuffle for every
series together, no Python loop); ARIMA folds each series for every point of
a parameter grid, whose points are rows, in SQL functions as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civica.functions.numbers import clip, even_grid
from civica.session import cut_lineage


def _explode_years(df: DataFrame, years: Sequence[int], col: str = "annee") -> DataFrame:
    """Rows for each requested year: a literal-array generator, not a join."""
    return df.withColumn(col, F.explode(F.array(*[F.lit(int(y)) for y in years])))


def linear_fit(df: DataFrame, series: Sequence[str], x: str, y: str) -> DataFrame:
    """M4: least-squares line per series (``regr_slope``/``regr_intercept``,
    computed by Spark with a numerically stable co-moment update)."""
    return df.groupBy(*series).agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
                                   F.regr_intercept(y, x).alias("intercept"),
                                   F.avg(F.when(F.col(y).isNotNull(), F.col(x))).alias("xbar"),
                                   F.avg(F.when(F.col(x).isNotNull(), F.col(y))).alias("ybar"))


def linear_predict(fit: DataFrame, years: Sequence[int], out: str = "pred", col: str = "annee") -> DataFrame:
    """M4: ``ŷ(t) = ȳ + slope·(t − x̄)``; a single point gives ``ȳ``."""
    return _explode_years(fit, years, col).withColumn(out, linear_eval(col))


def linear_eval(t) -> F.Column:
    """ŷ(t) for a row of ``linear_fit`` output."""
    return F.col("ybar") + F.coalesce(F.col("slope"), F.lit(0.0)) * (F.col(t) - F.col("xbar"))


def quadratic_fit(df: DataFrame, series: Sequence[str], x: str, y: str) -> DataFrame:
    """M3: least-squares parabola per series from centred moments.

    Rows are first reduced to one per (series, x) — count and Σy, a partial
    hash aggregate that absorbs any hot series — so the per-series mean of
    x comes from a window over at most #distinct-x rows per series (years,
    days), never over raw rows.  With ``u = x − x̄`` the normal equations are
    solved by Cramer's rule.  With only two distinct x the problem is
    under-determined; the result is the minimum-norm solution over the raw
    features (x, x²) that an SVD least-squares solver returns:
    ``ŷ(t) = ȳ + k·(Δx·(t − x̄) + Δq·(t² − q̄))`` with
    ``k = Δx·Σu·y / (Σu²·(Δx² + Δq²))``.  One distinct x gives ``ȳ``."""
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    per_x = pts.groupBy(*series, F.col(x).cast("double").alias("__x")).agg(
        F.count(F.lit(1)).cast("double").alias("__c"), F.sum(F.col(y).cast("double")).alias("__sy"))
    w = Window.partitionBy(*series)
    per_x = per_x.withColumn("__xbar", F.sum(F.col("__c") * F.col("__x")).over(w) / F.sum("__c").over(w))
    u, c, sy = F.col("__x") - F.col("__xbar"), F.col("__c"), F.col("__sy")
    m = per_x.groupBy(*series).agg(
        F.sum("__c").cast("long").alias("n"), F.count(F.lit(1)).alias("n_distinct"),
        F.first("__xbar").alias("xbar"), (F.sum(c * F.col("__x") * F.col("__x")) / F.sum(c)).alias("qbar"),
        (F.sum(sy) / F.sum(c)).alias("ybar"),
        F.sum(c * u * u).alias("s2"), F.sum(c * u * u * u).alias("s3"), F.sum(c * u * u * u * u).alias("s4"),
        F.sum(sy).alias("t0"), F.sum(u * sy).alias("t1"), F.sum(u * u * sy).alias("t2"),
        F.min("__x").alias("xmin"), F.max("__x").alias("xmax"))
    n, s2, s3, s4, t0, t1, t2 = (F.col(k) for k in ["n", "s2", "s3", "s4", "t0", "t1", "t2"])
    det = n * (s2 * s4 - s3 * s3) - s2 * s2 * s2
    # Matrix [[n, 0, s2], [0, s2, s3], [s2, s3, s4]] (Σu = 0), right side (t0, t1, t2).
    a = (t0 * (s2 * s4 - s3 * s3) + s2 * (t1 * s3 - s2 * t2)) / det
    b = (n * (t1 * s4 - s3 * t2) + t0 * s2 * s3 - t1 * s2 * s2) / det
    cc = (n * (s2 * t2 - t1 * s3) - t0 * s2 * s2) / det
    dx = F.col("xmax") - F.col("xmin")
    dq = F.col("xmax") * F.col("xmax") - F.col("xmin") * F.col("xmin")
    k = dx * t1 / (s2 * (dx * dx + dq * dq))
    three = F.col("n_distinct") >= 3
    two = F.col("n_distinct") == 2
    return m.select(*series, "n", "n_distinct", "xbar", "qbar", "ybar",
                    F.when(three, a).alias("a"), F.when(three, b).alias("b"), F.when(three, cc).alias("c"),
                    F.when(two, k).alias("k"), F.when(two, dx).alias("dx"), F.when(two, dq).alias("dq"))


def quadratic_eval(t) -> F.Column:
    """ŷ(t) for a row of ``quadratic_fit`` output (t: column or literal)."""
    t = F.col(t) if isinstance(t, str) else t
    u = t - F.col("xbar")
    full = F.col("a") + F.col("b") * u + F.col("c") * u * u
    two = F.col("ybar") + F.col("k") * (F.col("dx") * u + F.col("dq") * (t * t - F.col("qbar")))
    return F.when(F.col("n_distinct") >= 3, full).when(F.col("n_distinct") == 2, two).otherwise(F.col("ybar"))


def quadratic_predict(fit: DataFrame, years: Sequence[int], out: str = "pred", col: str = "annee") -> DataFrame:
    f = _explode_years(fit, years, col)
    return f.withColumn(out, quadratic_eval(F.col(col).cast("double")))


def bounded(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Clip a projection (e.g. 0..120000 votes, 10..60 %)."""
    return df.withColumn(column, clip(column, lo, hi))


def curve(fit: DataFrame, x0, x1, n: int = 100, kind: str = "quadratic", out: str = "y", lo=None, hi=None) -> DataFrame:
    """``n`` evenly spaced points of the fitted curve from x0 to
    x1 per series (the data behind a trend plot), bounded to [lo, hi]."""
    g = fit.select("*", F.posexplode(even_grid(F.lit(float(x0)), F.lit(float(x1)), n)).alias("i", "x"))
    y = quadratic_eval("x") if kind == "quadratic" else \
        F.col("ybar") + F.coalesce(F.col("slope"), F.lit(0.0)) * (F.col("x") - F.col("xbar"))
    return g.withColumn(out, clip(y, lo, hi))


def history_and_forecast(history: DataFrame, forecast: DataFrame, series: Sequence[str], period: str, value: str,
                         predicted: str = "pred") -> DataFrame:
    """One line per series: its observed points, then its predictions,
    told apart by ``kind``."""
    past = history.select(*series, period, F.col(value).alias("value"), F.lit("observed").alias("kind"))
    return past.unionByName(forecast.select(*series, period, F.col(predicted).alias("value"), F.lit("predicted").alias("kind")))


# --------------------------------------------------------------------------
# ARIMA(1,1,1) by conditional sum of squares over a grid of parameters.
# --------------------------------------------------------------------------

# Grid of both parameters: hundredths from -95 to 95 in steps of 5, inside the
# stationary and invertible region.
ARIMA_GRID = range(-95, 96, 5)


def _fold(d, phi, theta):
    """(previous difference, last innovation, sum of squares) after a series
    of differences; the first innovation is 0."""
    start = F.struct(F.get(d, F.lit(0)).alias("d"), F.lit(0.0).alias("e"), F.lit(0.0).alias("s"))

    def step(acc, x):
        e = x - phi * acc["d"] - theta * acc["e"]
        return F.struct(x.alias("d"), e.alias("e"), (acc["s"] + e * e).alias("s"))

    return F.aggregate(F.slice(d, 2, F.greatest(F.size(d) - 1, F.lit(0))), start, step)


def _best_points(diffs: DataFrame, key: str, phis, thetas) -> DataFrame:
    """Per series the best point of a grid, as a struct (s, phi, theta, d, e).

    Rows are (series, φ), dealt out by both, so that a long series is folded
    in as many tasks as there are φ; the folds over θ run in the row."""
    rows = diffs.select(key, "__d", thetas.alias("__thetas"), F.explode(phis).alias("__phi")).repartition(key, "__phi")

    def point(theta):
        end = _fold(F.col("__d"), F.col("__phi"), theta)
        return F.struct(end.alias("end"), theta.alias("theta"))

    ends = F.transform("__thetas", point)
    ordered = F.transform(ends, lambda x: F.struct(x["end"]["s"].alias("s"), F.col("__phi").alias("phi"), x["theta"].alias("theta"),
                                                   x["end"]["d"].alias("d"), x["end"]["e"].alias("e")))
    return rows.select(key, F.array_min(ordered).alias("__b")).groupBy(key).agg(F.min("__b").alias("__best"))


def arima_forecast(df: DataFrame, series: str, period: str, value: str, steps: int = 4,
                   out: str = "forecast", refine: int = 0) -> DataFrame:
    """M5: per series, forecast ``steps`` periods ahead with an ARIMA(1,1,1)
    without drift.  A series with fewer than 3 points yields nulls.  Steps
    are numbered from the last period of all series, as a common axis needs.

    The parameters are those of the grid with the least conditional sum of
    squares of the innovations ``e_t = d_t - φ·d_{t-1} - θ·e_{t-1}`` (on
    equality the smaller φ, then θ).  Each of ``refine`` further rounds looks
    at a grid five times as fine around the best point, inside the stationary
    and invertible region.  That is exact on the model's definition and on the
    grid; it is not maximum likelihood.

    A series is one array of its differences (one value per period); the
    points of the grid are rows, spread over tasks."""
    # One value per (series, period), whatever the number of rows.
    pts = df.where(F.col(value).isNotNull()).groupBy(series, period) \
            .agg(F.avg(F.col(value).cast("double")).alias("__y"))
    one = pts.groupBy(series).agg(F.array_sort(F.collect_list(F.struct(F.col(period).alias("p"), F.col("__y").alias("y"))))["y"].alias("__y"),
                                  F.max(period).alias("__last"))
    n = F.size("__y")
    diffs = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.get("__y", i) - F.get("__y", i - 1))) \
        .otherwise(F.array().cast("array<double>"))
    # Written once: the grid, its refinements and the levels all come from it.  A null name keeps its series.
    one = cut_lineage(one.select(F.struct(series).alias("__key"), F.get("__y", n - 1).alias("__level"), (n >= 3).alias("__ok"),
                                 diffs.alias("__d"), "__last"), name="differences")
    last = one.agg(F.max("__last")).scalar()
    fitted = one.where("__ok")
    grid = F.transform(F.sequence(F.lit(ARIMA_GRID.start), F.lit(ARIMA_GRID[-1]), F.lit(ARIMA_GRID.step)), lambda x: x / 100)
    best = _best_points(fitted, "__key", grid, grid)
    width = ARIMA_GRID.step / 100
    for _ in range(refine):
        width /= 5
        around = fitted.join(cut_lineage(best, name="best"), "__key")
        near = lambda c: F.filter(F.transform(F.sequence(F.lit(-4), F.lit(4)), lambda i: F.col(f"__best.{c}") + i * F.lit(width)),
                                  lambda x: F.abs(x) < 1)
        best = _best_points(around, "__key", near("phi"), near("theta"))
    fit = one.select("__key", "__level", "__ok").join(best, "__key", "left")
    # The first step has the last innovation, later ones only the damped difference.
    phi, theta, d, e = F.col("__best.phi"), F.col("__best.theta"), F.col("__best.d"), F.col("__best.e")
    moves = [phi * d + theta * e]
    for _ in range(steps - 1):
        moves.append(phi * moves[-1])
    levels = [F.col("__level") + moves[0]]
    for m in moves[1:]:
        levels.append(levels[-1] + m)
    rows = F.array(*[F.struct(F.lit(h + 1).alias("step"), (last + F.lit(h + 1)).alias(period),
                              F.when(F.col("__ok"), levels[h]).alias(out)) for h in range(steps)])
    return fit.select(f"__key.{series}", F.inline(rows))
