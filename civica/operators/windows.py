"""Window-style operators.

Only W1 (lag) truly needs row order inside a group, so only W1 uses a
``Window``.  Arg-max rows (W2, W3) and last values (W6) are ``min_by`` /
``max_by`` aggregates with partial aggregation, so a hot group is reduced
map-side instead of being sorted in one task.  The group mean used for null
filling (W4) is an aggregate joined back, not a window over a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civica.operators.joins import measured
from civica.session import cut_lineage


def lag_within(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
               out: str, offset: int = 1, split=None) -> DataFrame:
    """Previous value within a group.  ``order`` must be a total order
    (year plus tie columns); the reference's stable sort is otherwise
    ambiguous.  Null for the first row of each group.

    A plain window sends each group to one task, so one hot group (say a
    third of all rows under an "other candidates" label) is sorted by a
    single task.  With ``split`` — a column or expression that never
    decreases along ``order``, e.g. the year, or ``struct(year,
    floor(tie / 10**6))`` for finer pieces — the lag is computed in two
    levels: a window per (group, split) spreads a hot group over as many
    tasks as it has splits, and a small table of each split's last value
    (one row per group and split) supplies the value
    carried into the first row of the next split.  Same result, no task
    holding a whole group."""
    if split is None:
        w = Window.partitionBy(*partition).orderBy(*order)
        return df.withColumn(out, F.lag(value, offset).over(w))
    if offset != 1:
        raise ValueError("split lag supports offset 1")
    sp = F.col(split) if isinstance(split, str) else split
    # Keys wrapped in structs: struct equality matches null fields, so one
    # plain equi-join on exactly the window's partition expressions keeps
    # null groups and reuses the window's shuffle for the fact side.
    d = df.withColumn("__gk", F.struct(*[F.col(c) for c in partition])).withColumn("__sk", F.struct(sp.alias("s")))
    w = Window.partitionBy("__gk", "__sk").orderBy(*order)
    local = d.withColumn("__lag", F.lag(value).over(w)).withColumn("__rn", F.row_number().over(w)) \
        .withColumn("__tail", F.lead(F.lit(True)).over(w).isNull())
    # Written once: the rows and the last value of each split come from it.
    local = cut_lineage(local, name="lag")
    tails = local.where("__tail").select("__gk", "__sk", F.col(value).alias("__last"))
    tails = tails.select("__gk", "__sk", F.lag("__last").over(Window.partitionBy("__gk").orderBy("__sk")).alias("__prev"))
    # Only the first row of a split looks at another split; the others stay where they are.
    first = local.where("__rn = 1").drop("__lag").join(tails, ["__gk", "__sk"], "left").withColumnRenamed("__prev", out)
    rest = local.where("__rn > 1").withColumnRenamed("__lag", out)
    names = [*df.columns, out]
    return first.select(names).unionAll(rest.select(names))


def latest_row(df: DataFrame, keys: Sequence[str], latest: str, ties: Sequence[str] = ()) -> DataFrame:
    """Per group the row with the largest ``latest`` (first by ``ties``
    on equality).  Rows without a ``latest`` are skipped.

    The last period of each group is a hash aggregate, joined back (broadcast
    if its written size is small, so that the rows do not move); only the rows
    of that period, the survivors, go through the aggregate that orders
    ties.  ``df`` is read twice: write it first where that is dear."""
    names = {k: f"__k_{k}" for k in keys}
    last = measured(df.where(F.col(latest).isNotNull()).groupBy(*keys).agg(F.max(latest).alias("__latest")).withColumnsRenamed(names))
    same = F.col(latest) == F.col("__latest")
    for k, r in names.items():
        same = same & df[k].eqNullSafe(F.col(r))
    rest = [c for c in df.columns if c not in keys and c != latest]
    kept = df.join(last, same, "left_semi")
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(t) for t in ties] or [F.lit(0)]))
    best = kept.groupBy(*keys, latest).agg(first.alias("__first"))
    return best.select(*keys, latest, "__first.*").select(df.columns)


def argmax_label(df: DataFrame, keys: Sequence[str], label: str, value: str, out: str | None = None,
                 value_out: str | None = None) -> DataFrame:
    """Per group the label with the largest value; on equal values the
    smallest label (pandas ``idxmax`` over a key-sorted group).  Null values
    are skipped."""
    key = F.struct((-F.col(value)).alias("__v"), F.col(label).alias("__l"))
    agg = [F.min_by(F.col(label), key).alias(out or label)]
    if value_out:
        agg.append(F.max(value).alias(value_out))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(*agg)


def group_mean_fill(df: DataFrame, group: Sequence[str], column: str, out: str | None = None,
                    null_keys: bool = False) -> DataFrame:
    """Nulls get the mean of their group: one aggregate per group joined
    back on the group key, broadcast when its measured size is small, so that
    the rows do not move.  Rows whose key is null are not a group and stay
    unfilled unless ``null_keys`` is set."""
    g = list(group)
    means = measured(df.groupBy(*g).agg(F.avg(column).alias("__gmean")))
    ren = {k: f"__g_{k}" for k in g}
    means = means.withColumnsRenamed(ren)
    cond = None
    for k in g:
        c = df[k].eqNullSafe(means[ren[k]]) if null_keys else df[k] == means[ren[k]]
        cond = c if cond is None else cond & c
    j = df.join(means, cond, "left")
    return j.withColumn(out or column, F.coalesce(F.col(column), F.col("__gmean"))) \
            .drop("__gmean", *ren.values())


def pct_change_mean(df: DataFrame, series: str, period: str, value: str, out: str = "evolution") -> DataFrame:
    """Per period, mean over series of the period-on-period change, with
    gaps filled forward; 0 where no series has a change.

    Grid = periods where some series has a value.  A series missing at a
    period, but started earlier, keeps its value and so contributes a change
    of 0; a series not started yet contributes nothing, and neither does one
    whose value before was 0 (its change is undefined).  Hence ``mean(p) = Σ
    changes observed at p / #series started before p with a value other than
    0``, a running count of what each period adds and takes away, and no
    dense series × period grid has to be built.
    """
    obs = (df.where(F.col(value).isNotNull()).groupBy(series, period)
             .agg(F.avg(value).alias("__v")))
    w = Window.partitionBy(series).orderBy(period)
    ch = obs.withColumn("__prev", F.lag("__v").over(w))
    change = F.try_subtract(F.try_divide(F.col("__v"), F.col("__prev")), F.lit(1.0))
    counts = F.count_if(F.col("__prev").isNull() | (F.col("__prev") == 0)) - F.count_if(F.col("__v") == 0)
    grid = ch.groupBy(period).agg(F.sum(change).alias("__s"), counts.alias("__new"))
    # The grid has one row per period (already aggregated), so a running sum
    # over it is a small single-partition window.
    started = F.sum("__new").over(Window.orderBy(period).rowsBetween(Window.unboundedPreceding, -1))
    return grid.select(period, F.coalesce(F.try_divide(F.col("__s"), started), F.lit(0.0)).alias(out))


def last_value(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "last_value") -> DataFrame:
    """Value at the largest ``order`` per group (``series[-1]``)."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, order).alias(out))
