"""Carrier tables: the election roles mapped onto the driver's test tables.

Role map (SURVEY §7.3): ``annee`` = year of ``o_orderdate``; ``code_region`` =
``c_nationkey``; ``nom`` (candidate) = ``o_orderpriority``; ``voix`` (votes) =
``o_totalprice``.  Indicator tables are aggregates of ``lineitem`` and
``events``.  Each builder has a SQL twin used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.functions.text import keyword_pattern
from civica.operators.reshape import pivot_values
from civica.plans.elections import CATEGORIES  # noqa: F401
from civica.plans.registry import table
from civica.session import cut_lineage

# Category of each carrier "candidate" (order priority).  The
# fourth priority is deliberately unmapped so the default category shows up.
PRIORITY_CATEGORY = {
    "1-URGENT": "Extrême gauche",
    "2-HIGH": "Gauche",
    "3-MEDIUM": "Centre",
    "5-LOW": "Droite",
}
# Order keys per split of the two-level lag: (year, key // 2^20) is a prefix
# of the lag order (year, key), so no lag task holds more than 2^20 keys of
# one group, however hot the group is.
SPLIT_KEYS = 1 << 20


def lag_split():
    return F.struct(F.col("annee"), F.floor(F.col("o_orderkey") / SPLIT_KEYS))


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_pattern(keywords) -> str:
    """The keyword pattern in the dialect of the SQL engine, whose ``i`` flag
    folds accented letters by itself."""
    return keyword_pattern(keywords).replace("(?iu)", "(?i)")


def values_sql(rows, cols) -> str:
    """``(VALUES ...) AS name(cols)`` body for a list of tuples."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return sql_str(v)
        return repr(float(v)) if isinstance(v, float) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {cols}"


def votes(spark: SparkSession, d: str) -> DataFrame:
    """Election long table: one row per order (a polling-station result)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.year("o_orderdate").alias("annee"),
        F.col("c_nationkey").alias("code_region"),
        F.col("o_orderpriority").alias("nom"),
        F.col("o_totalprice").alias("voix"),
        "o_orderkey")


VOTES_SQL = """votes AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS annee, c.c_nationkey AS code_region,
         o.o_orderpriority AS nom, o.o_totalprice AS voix, o.o_orderkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

CATEGORY_MAP_SQL = "catmap AS (SELECT * FROM " + values_sql(
    sorted(PRIORITY_CATEGORY.items()), "m(nom, categorie)") + ")"


def categorised_votes(spark: SparkSession, d: str) -> DataFrame:
    from civica.operators.joins import lookup_with_default
    return lookup_with_default(votes(spark, d), "nom", PRIORITY_CATEGORY, out="categorie", default="Autres")


CAT_VOTES_SQL = VOTES_SQL + ",\n" + CATEGORY_MAP_SQL + """,
catvotes AS (
  SELECT v.*, COALESCE(m.categorie, 'Autres') AS categorie
  FROM votes v LEFT JOIN catmap m ON upper(trim(v.nom)) = m.nom)"""


def quarterly_unemployment(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly indicator: mean discount of shipped lines per year/quarter."""
    li = table(spark, d, "lineitem").select("l_shipdate", "l_discount")
    return li.groupBy(F.year("l_shipdate").alias("annee"), F.quarter("l_shipdate").alias("trimestre")) \
             .agg(F.avg("l_discount").alias("taux_chomage"))


QUARTERLY_SQL = """chomage AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, CAST(quarter(l_shipdate) AS INTEGER) AS trimestre,
         avg(l_discount) AS taux_chomage
  FROM lineitem GROUP BY 1, 2)"""


def yearly_poverty(spark: SparkSession, d: str) -> DataFrame:
    """Yearly indicator: mean tax rate of shipped lines per year."""
    li = table(spark, d, "lineitem").select("l_shipdate", "l_tax")
    return li.groupBy(F.year("l_shipdate").alias("annee")).agg(F.avg("l_tax").alias("taux"))


POVERTY_SQL = """pauvrete AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, avg(l_tax) AS taux FROM lineitem GROUP BY 1)"""


def police_rates(spark: SparkSession, d: str) -> DataFrame:
    """Indicator per (year, region): mean tax of lines by supplier nation."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_tax")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey) \
             .groupBy(F.year("l_shipdate").alias("annee"), F.col("s_nationkey").alias("code_region")) \
             .agg(F.avg("l_tax").alias("taux_pour_mille"))


POLICE_SQL = """police AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS annee, s.s_nationkey AS code_region,
         avg(l.l_tax) AS taux_pour_mille
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2)"""


# Wide election table: one row per order, one candidate block per line number.
# The oracle's SQL names the line numbers of the test tables; the Spark side
# takes them from the data.
LINES = list(range(1, 8))


def indicators(spark: SparkSession, d: str) -> DataFrame:
    """Sums and counts per (year, quarter, supplier nation), from one pass
    over the lines: what every indicator of a region or year derives from.
    One row per period and nation."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_discount", "l_tax")
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("code_region"))
    out = li.join(s, li.l_suppkey == s.s_suppkey, "left").groupBy(
        F.year("l_shipdate").alias("annee"), F.quarter("l_shipdate").alias("trimestre"), "code_region").agg(
        F.sum("l_discount").alias("discount"), F.count("l_discount").alias("n_discount"),
        F.sum("l_tax").alias("tax"), F.count("l_tax").alias("n_tax"))
    return cut_lineage(out, name="indicators")


def indicator_tables(ind: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(yearly unemployment, yearly poverty, crime per year and region) of
    ``indicators``."""
    quarterly = ind.groupBy("annee", "trimestre").agg((F.sum("discount") / F.sum("n_discount")).alias("taux_chomage"))
    yearly = quarterly.groupBy("annee").agg(F.avg("taux_chomage").alias("taux_chomage"))
    poverty = ind.groupBy("annee").agg((F.sum("tax") / F.sum("n_tax")).alias("taux"))
    police = ind.where("code_region is not null").groupBy("annee", "code_region") \
        .agg((F.sum("tax") / F.sum("n_tax")).alias("taux_pour_mille"))
    return yearly, poverty, police


def line_blocks(spark: SparkSession, d: str) -> DataFrame:
    """(l_orderkey, l_linenumber, nom, voix): one candidate per order line.
    ``(l_orderkey, l_linenumber)`` is not unique in the test data, so the
    block is an aggregate: smallest part key as name, summed quantity."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return li.groupBy("l_orderkey", "l_linenumber").agg(
        F.concat(F.lit("P"), F.min("l_partkey").cast("string")).alias("nom"),
        F.sum("l_quantity").alias("voix"))


LINE_BLOCKS_SQL = """blocks AS (
  SELECT l_orderkey, l_linenumber, 'P' || CAST(min(l_partkey) AS VARCHAR) AS nom, sum(l_quantity) AS voix
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def line_numbers(spark: SparkSession, d: str) -> list[int]:
    return pivot_values(table(spark, d, "lineitem"), "l_linenumber")


def wide_numbered(spark: SparkSession, d: str) -> DataFrame:
    """Wide table with numbered headers ``Nom.1, Voix.1 … Nom.7, Voix.7``
    (the layout of a yearly results file)."""
    b = line_blocks(spark, d)
    lines = line_numbers(spark, d)
    w = b.groupBy("l_orderkey").pivot("l_linenumber", lines).agg(F.first("nom").alias("n"), F.first("voix").alias("v"))
    cols = ["l_orderkey"]
    for i in lines:
        cols += [F.col(f"{i}_n").alias(f"Nom.{i}"), F.col(f"{i}_v").alias(f"Voix.{i}")]
    return w.select(*cols)


def wide_suffixed(spark: SparkSession, d: str) -> DataFrame:
    """Same, with warehouse-style headers ``nom, voix, nom_2, voix_2 …``."""
    from civica.operators.columns import block_rename_map, rename_aliases
    wide = wide_numbered(spark, d)
    last = max((int(c.rpartition(".")[2]) for c in wide.columns if c.startswith("Nom.")), default=1)
    return rename_aliases(wide, block_rename_map(last, {"Nom": "nom", "Voix": "voix"}, first_suffix=".1"))
