"""Joins (J1-J8).

No join here forces a broadcast of a side whose size grows with the data.
Sides that are bounded by construction (a mapping built from a Python
dict, a top-n list) are hinted; for everything else adaptive execution
measures the built side at runtime and converts to a broadcast join only
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Skewed keys are
split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.functions.text import keyword_pattern, lookup_key
from civica.session import cut_lineage, stored_bytes

# Rows and estimated bytes above which a table with a proven number of rows
# is no longer hinted for broadcast.
BOUNDED_ROWS = 10_000
BOUNDED_BYTES = 64 << 20
# Bytes on disk (Parquet) up to which a written side is broadcast.
MEASURED_BYTES = 8 << 20


def plan_max_rows(df: DataFrame) -> int | None:
    """Upper bound on the rows of ``df`` proven by its optimised plan
    (``LogicalPlan.maxRows``: set by LIMIT, local relations, global
    aggregates and carried through projections and grouping); None when
    the plan does not bound it."""
    try:
        m = df._jdf.queryExecution().optimizedPlan().maxRows()
        return int(m.get()) if m.isDefined() else None
    except AttributeError:   # no JVM handle (e.g. Spark Connect): no proof
        return None


def bounded_broadcast(df: DataFrame, max_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Broadcast hint only when the plan proves ``df`` has at most
    ``max_rows`` rows and estimates at most ``BOUNDED_BYTES``; otherwise
    adaptive execution decides at runtime from the measured size."""
    n = plan_max_rows(df)
    if n is None or n > max_rows:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= BOUNDED_BYTES else df


def measured(df: DataFrame, max_bytes: int = MEASURED_BYTES) -> DataFrame:
    """``df`` written to the shared folder and read back, with a broadcast
    hint if the files have at most ``max_bytes``.

    For the small side of a join whose other side must not move: adaptive
    execution learns sizes only after both sides are shuffled; this way the
    size is known before the plan is made, and a side that has grown is
    joined by an ordinary equi-join."""
    written = cut_lineage(df, name="measured")
    return F.broadcast(written) if stored_bytes(written) <= max_bytes else written


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A dimension built from driver-side literals (size known here)."""
    return bounded_broadcast(spark.createDataFrame(list(rows), schema))


def left_join(df: DataFrame, other: DataFrame, on: Sequence[str] | str, how: str = "left",
              suffix: str = "_right", null_safe: bool = False, measure: bool = False) -> DataFrame:
    """Equi-join on shared key names; right-hand non-key columns that
    collide with left columns get ``suffix``.  ``null_safe`` matches null
    keys to null keys.  ``measure`` writes the right side first and
    broadcasts it if it proves small (see ``measured``)."""
    other = measured(other) if measure else other
    on = [on] if isinstance(on, str) else list(on)
    ren = {c: f"{c}{suffix}" for c in other.columns if c in df.columns and c not in on}
    r = other.withColumnsRenamed(ren) if ren else other
    if not null_safe:
        return df.join(r, on, how)
    rk = {k: f"__rk_{k}" for k in on}
    r = r.withColumnsRenamed(rk)
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(r[rk[k]]) for k in on])
    return df.join(r, cond, how).drop(*rk.values())


def fold_key(s: str | None) -> str | None:
    """Driver-side twin of ``civica.functions.text.lookup_key`` for keys of
    a mapping typed in code (trim blanks, upper-case, fold accents)."""
    from civica.functions.text import ACCENTED_UPPER, FOLDED_UPPER, STRIP_CHARS
    return None if s is None else s.strip(STRIP_CHARS).upper().translate(str.maketrans(ACCENTED_UPPER, FOLDED_UPPER))


def lookup_with_default(df: DataFrame, column: str, mapping: DataFrame | Mapping[str, str], key: str = "key",
                        value: str = "value", out: str = "label", default: str = "Autres",
                        fold: bool = True) -> DataFrame:
    """``df[column].map(mapping).fillna(default)`` as a left join on a
    bounded mapping table.  With ``fold`` both sides are compared after
    trimming, upper-casing and accent folding.  A mapping given as a dict
    is folded and de-duplicated on the driver (first key wins) and
    broadcast; a mapping given as a DataFrame is de-duplicated by Spark."""
    if isinstance(mapping, Mapping):
        seen: dict = {}
        for k, v in mapping.items():
            seen.setdefault(fold_key(k) if fold else k, v)
        spark = df.sparkSession
        m = small_table(spark, list(seen.items()), "__mkey string, __mval string")
    else:
        m = mapping.select(
            (lookup_key(key) if fold else F.col(key)).alias("__mkey"), F.col(value).alias("__mval")
        ).dropDuplicates(["__mkey"])
    left_key = lookup_key(column) if fold else F.col(column)
    j = df.withColumn("__lkey", left_key).join(m, F.col("__lkey") == F.col("__mkey"), "left")
    return j.withColumn(out, F.coalesce(F.col("__mval"), F.lit(default))).drop("__lkey", "__mkey", "__mval")


def keyword_labels(column: str, groups: Mapping[str, Sequence[str]]) -> Column:
    """J7 as an expression: the array of group labels whose keywords occur
    in ``column`` (case-insensitive, possibly several).  Each pattern is a
    literal, compiled once per task; no join and no pair explosion."""
    hits = [F.when(F.coalesce(F.col(column).rlike(keyword_pattern(kws)), F.lit(False)), F.lit(label))
            for label, kws in groups.items() if kws]
    return F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")


def keyword_match(df: DataFrame, column: str, groups: Mapping[str, Sequence[str]],
                  out: str = "parti", first_match: bool = False) -> DataFrame:
    """One output row per (input row, matching group).  Rows matching no
    group are dropped (``left_match`` keeps them via ``keyword_labels``)."""
    labels = keyword_labels(column, groups)
    if first_match:
        return df.withColumn(out, F.element_at(labels, 1)).where(F.col(out).isNotNull())
    return df.withColumn(out, F.explode(labels))


def keyword_index_match(df: DataFrame, column: str, keywords: DataFrame, label: str = "label", keyword: str = "keyword",
                        out: str = "parti", gram: int = 3) -> DataFrame:
    """J7 for any number of keywords: one output row per (input row, label of
    a keyword that occurs in ``column``), as ``keyword_match`` gives, with the
    keywords in a table.  Case is ignored; null and empty keywords match
    nothing.

    Each keyword is anchored at the one of its substrings of ``gram``
    characters that fewest keywords have (a shorter keyword is its own
    anchor).  Distinct names meet the keywords in an equi-join on anchors, a
    comparison verifies the whole keyword, and distinct (name, label) pairs
    are joined back to the rows; a name never meets all keywords."""
    cut = lambda c, size: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - size + 1),
                                                       lambda i: F.substring(c, i, size)))
    kw = keywords.select(F.col(label).alias("__label"), F.lower(F.col(keyword)).alias("__kw")) \
        .where("length(__kw) > 0").distinct().withColumn("__size", F.least(F.length("__kw"), F.lit(gram)))
    grams = kw.select("__kw", "__size").distinct().select("__kw", "__size", F.explode(cut(F.col("__kw"), F.col("__size"))).alias("__gram"))
    rare = grams.join(grams.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n")), "__gram")
    anchor = rare.groupBy("__kw", "__size").agg(F.min(F.struct("__n", "__gram"))["__gram"].alias("__gram"))
    anchored = measured(kw.join(anchor, ["__kw", "__size"]))
    sizes = sorted(r[0] for r in anchored.select("__size").distinct().collect())  # at most ``gram`` numbers
    if not sizes:
        return df.limit(0).withColumn(out, F.lit(None).cast(keywords.schema[label].dataType))
    names = df.select(F.col(column).alias("__name")).where("__name IS NOT NULL").distinct().withColumn("__low", F.lower("__name"))
    every = [F.when(F.length("__low") >= n, cut(F.col("__low"), F.lit(n))).otherwise(F.array().cast("array<string>")) for n in sizes]
    met = names.select("__name", "__low", F.explode(F.flatten(F.array(*every))).alias("__gram")).join(anchored, "__gram") \
        .where(F.contains("__low", "__kw"))
    pairs = met.select("__name", F.col("__label").alias(out)).distinct()
    return df.join(pairs, F.col(column) == F.col("__name")).drop("__name")
