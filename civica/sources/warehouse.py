"""Warehouse tables: scans (S5-S8, S10) and table maintenance (K2, K3, K7, K8).

The warehouse is the Spark catalog: managed Parquet tables in a database
whose location lies in shared storage.  Filters and projections are plain
DataFrame operations, so Catalyst pushes them into the Parquet scan
(``PushedFilters`` / ``ReadSchema`` in the plan) — the hand-written
``WHERE`` of the reference's SQL strings comes for free.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from civica.operators.joins import measured
from civica.operators.quality import constraint_audit, duplicate_keys, orphans
from civica.session import cut_lineage, scratch_database


def scan_years(df: DataFrame, column: str, lo: int, hi: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose year lies in ``[lo, hi]``.  On a date/timestamp
    column the bound is rewritten as a range on the raw column so it can be
    pushed to the file scan (``year(col) BETWEEN`` cannot)."""
    t = df.schema[column].dataType
    if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
        cond = (F.col(column) >= F.lit(dt.datetime(lo, 1, 1)).cast(t)) & \
               (F.col(column) < F.lit(dt.datetime(hi + 1, 1, 1)).cast(t))
    else:
        cond = F.col(column).between(lo, hi)
    out = df.where(cond)
    return out.select(*columns) if columns else out


def full_scan(df: DataFrame) -> DataFrame:
    """The whole table."""
    return df


def scan_where_ordered(df: DataFrame, column: str, value, order: Sequence[str]) -> DataFrame:
    """Equality filter (F2, pushed to the scan) then ordered output."""
    from civica.operators.rows import equals_filter, sort_rows
    return sort_rows(equals_filter(df, column, value), order)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create a database located in shared storage (default: below
    ``spark.checkpoint.dir``, until ``clean_scratch``)."""
    if location is None:
        return scratch_database(spark, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


def append_table(df: DataFrame, name: str) -> None:
    """K2: append rows; new columns are not silently accepted (like SQL)."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def append_batch(df: DataFrame, name: str, batch: str, batch_col: str = "lot") -> None:
    """K2/U2, safe to repeat: the rows of one named batch are a partition of
    the table, which a repeated load replaces, so that a load tried again after a failure doubles nothing.  Columns that
    the table lacks are added to it, with null in the rows before; columns
    that ``df`` lacks are null in its rows.  A type other than the table's is
    an error."""
    spark = df.sparkSession
    rows = df.withColumn(batch_col, F.lit(batch))
    if not spark.catalog.tableExists(name):
        rows.limit(0).write.partitionBy(batch_col).format("parquet").mode("ignore").saveAsTable(name)
    have = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
    for f in rows.schema.fields:
        if f.name.lower() not in have:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")
        elif have[f.name.lower()] != f.dataType:
            raise ValueError(f"{name}.{f.name} is {have[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}")
    own = {c.lower(): c for c in df.columns}
    fields = [f for f in spark.table(name).schema.fields if f.name.lower() != batch_col.lower()]
    rows = df.select(*[F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{batch_col}` = :batch) SELECT * FROM {{rows}}", args={"batch": batch}, rows=rows)


def append_identity(df: DataFrame, name: str, id_col: str, order: Sequence[str]) -> None:
    """K2 with a generated key: rows are appended with the numbers that follow
    the table's largest ``id_col``, dense and in the order of ``order``, so a
    table emptied by ``truncate_all`` starts at 1 again (K8).

    The rows are sorted over all tasks and written beside their task and their
    place in it; a running sum over one row per task gives each task its first
    number.  ``order`` should be a total order: rows that tie get consecutive
    numbers in any order.  One writer at a time, as nothing locks the table."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    last = (spark.table(name).agg(F.max(id_col)).first()[0] if exists else None) or 0
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = cut_lineage(df.drop(id_col).orderBy(*order).withColumn("__task", F.spark_partition_id()).withColumn("__place", place),
                       name="identity")
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)   # one row per task
    first = rows.groupBy("__task").agg(F.count(F.lit(1)).alias("__n")) \
        .select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    numbered = rows.join(measured(first), "__task").select(
        (F.col("__first") + F.col("__place") + 1 + F.lit(last)).cast("long").alias(id_col), *df.drop(id_col).columns)
    append_table(numbered, name)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """K3: replace the table content and schema.  ``partition_by`` (e.g. the
    election year) lets later range filters prune whole directories."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def replace_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """K3 for tables that are joined or windowed on the same keys again and
    again: one shuffle on ``keys`` when written, one file per bucket, sorted
    by the keys and ``sort``.  Joins of tables with equal keys and bucket
    numbers, and windows and aggregates over the keys, then read in place.

    A bucket is one task's work: choose ``buckets`` for files of a few hundred
    megabytes, and keys without hot values (``lag_within`` splits those)."""
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet") \
        .bucketBy(buckets, *keys).sortBy(*keys, *sort).saveAsTable(name)
    return df.sparkSession.table(name)


def create_table(spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
    """K7: declare an (empty) table from a ``StructType``."""
    w = spark.createDataFrame([], schema).write.format("parquet").mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


@dataclass(frozen=True)
class TableDef:
    """A table's columns (DDL), its key, and what its columns refer to."""

    columns: str
    key: str
    refs: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# The warehouse's star schema (K7).
STAR_SCHEMA = {
    "regions": TableDef("code_region int, libelle_region string", "code_region"),
    "departements": TableDef("code_departement int, libelle_departement string, code_region int", "code_departement",
                             {"code_region": ("regions", "code_region")}),
    "cantons": TableDef("id_canton int, code_canton string, libelle_canton string, code_departement int", "id_canton",
                        {"code_departement": ("departements", "code_departement")}),
    "elections": TableDef("id_election int, annee int, type_election string", "id_election"),
    "resultats_electoraux": TableDef(
        "id_resultat int, id_election int, code_region int, code_departement int, id_canton int, inscrits int, "
        "abstentions int, votants int, blancs int, nuls int, exprimes int", "id_resultat",
        {"id_election": ("elections", "id_election"), "code_region": ("regions", "code_region"),
         "code_departement": ("departements", "code_departement"), "id_canton": ("cantons", "id_canton")}),
    "candidats": TableDef("id_candidat int, nom string, prenom string, sexe string", "id_candidat"),
    "votes_candidats": TableDef(
        "id_vote int, id_resultat int, id_candidat int, voix int, pourcentage_voix_inscrits double, "
        "pourcentage_voix_exprimes double", "id_vote",
        {"id_resultat": ("resultats_electoraux", "id_resultat"), "id_candidat": ("candidats", "id_candidat")}),
    "statistiques_police": TableDef(
        "id_stat int, code_region int, annee int, indicateur string, unite_de_compte string, nombre int, "
        "taux_pour_mille double, insee_pop int, insee_pop_millesime int, insee_log int, insee_log_millesime int",
        "id_stat", {"code_region": ("regions", "code_region")}),
}

# The two-table wide schema (K7); its candidate block repeats
# without a number and then with 1 to 10.
_CANDIDATE = (("numero_panneau", "string"), ("sexe", "string"), ("nom", "string"), ("prenom", "string"), ("voix", "int"),
              ("pourcentage_voix_inscrits", "double"), ("pourcentage_voix_exprimes", "double"))
WIDE_SCHEMA = {
    "election": TableDef(
        "id int, code_region int, libelle_departement string, code_canton string, libelle_canton string, inscrits int, "
        "abstentions int, pourcentage_absent_inscrits double, votants int, pourcentage_voix_inscrits_election double, "
        "blancs int, pourcentage_blancs_inscrits double, pourcentage_blancs_votants double, nuls int, "
        "pourcentage_nuls_inscrits double, pourcentage_nuls_votants double, exprimes int, "
        "pourcentage_voix_exprimes_inscrits double, pourcentage_voix_exprimes_votants double, "
        + ", ".join(f"{n}{s} {t}" for s in ["", *[f"_{i}" for i in range(1, 11)]] for n, t in _CANDIDATE)
        + ", annee int, type_election string", "id"),
    "police": TableDef(STAR_SCHEMA["statistiques_police"].columns, "id_stat"),
}


def create_schema(spark: SparkSession, database: str, tables: Mapping[str, TableDef]) -> list[str]:
    """K7: declare every table of a schema."""
    for t, d in tables.items():
        create_table(spark, f"`{database}`.`{t}`", StructType.fromDDL(d.columns))
    return list(tables)


def audit_schema(spark: SparkSession, database: str, tables: Mapping[str, TableDef]) -> DataFrame:
    """Q6: the declared keys and references, which Spark does not enforce,
    as checks over the stored tables."""
    get = {t: spark.table(f"`{database}`.`{t}`") for t in tables}
    checks = [duplicate_keys(get[t], [d.key], f"pk_{t}") for t, d in tables.items()]
    checks += [orphans(get[t], c, get[parent], key, f"fk_{t}_{c}") for t, d in tables.items()
               for c, (parent, key) in d.refs.items()]
    return constraint_audit(checks)


def table_names(spark: SparkSession, database: str) -> list[str]:
    """The names of a database's tables (catalog metadata)."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Catalog listing of a database's tables."""
    return spark.createDataFrame([(n,) for n in table_names(spark, database)], "tablename string")


def truncate_all(spark: SparkSession, database: str) -> list[str]:
    """K8: empty every table of a database (schemas kept)."""
    names = table_names(spark, database)
    for n in names:
        spark.sql(f"TRUNCATE TABLE `{database}`.`{n}`")
    return names


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
