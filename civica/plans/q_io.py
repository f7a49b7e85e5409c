"""Catalogue, part 2: sources, sinks and warehouse maintenance.

Round trips write below ``spark.checkpoint.dir`` (shared storage on a
cluster) and read back, so the registered DataFrame is the re-read data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civica.operators.aggregates import group_sums
from civica.operators.joins import left_join
from civica.operators.reshape import pivot_values
from civica.operators.rows import union_all
from civica.operators.windows import lag_within
from civica.plans import carriers as C
from civica.plans import elections as E
from civica.plans.registry import query, table
from civica.session import scratch_path
from civica.sources import lake as L
from civica.sources import literal as LT
from civica.sources import warehouse as W


def _db(spark, stem):
    return W.ensure_database(spark, f"civica_{stem}_{uuid.uuid4().hex[:8]}")


@query("folder_ingest", "S3 S4", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer
UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation""")
def folder_ingest(spark, d):
    landing = scratch_path(spark, "landing")
    # Two kinds of files land in one folder (different headers).
    L.write_delimited(table(spark, d, "customer").repartition(3), landing)
    L.write_delimited(table(spark, d, "nation"), landing, mode="append")
    groups = list(L.ingest_folder(spark, landing).values())
    kinds = {"customer": ("c_custkey", "c_name"), "nation": ("n_nationkey", "n_name")}
    parts = [g.select(F.lit(k).alias("kind"), F.col(i).try_cast("bigint").alias("id"), F.col(n).alias("name"))
             for g in groups for k, (i, n) in kinds.items() if i in g.columns]
    return union_all(parts)


@query("csv_roundtrip_decimal_comma", "S1 S2 K1 K9 C5",
       "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def csv_roundtrip_decimal_comma(spark, d):
    path = scratch_path(spark, "csv-semicolon")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    L.write_delimited(o, path, sep=";", decimal_comma_columns=["o_totalprice"])
    back = L.read_decimal_comma(spark, path, sep=";", numeric=["o_totalprice"])
    return back.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "o_totalprice", "o_orderpriority")


@query("append_replace_roundtrip", "K2 K3", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS annee FROM orders""")
def append_replace_roundtrip(spark, d):
    db = _db(spark, "load")
    t = f"`{db}`.election_tour_1"
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("annee"))
    W.replace_table(o.withColumn("o_totalprice", F.lit(0.0)), t)
    W.replace_table(o.where("annee % 2 = 0"), t)      # replace drops the first content
    W.append_table(o.where("annee % 2 <> 0"), t)      # append keeps the even years
    return spark.table(t)


@query("evolving_append", "K2 U2", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS annee,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN o_totalprice END AS voix_paires, CASE WHEN year(o_orderdate) % 2 <> 0 THEN o_totalprice END AS voix_impaires
FROM orders""")
def evolving_append(spark, d):
    """Each year's rows, with other columns in even and odd years, appended
    one after another to one table, every batch twice: a repeat replaces it."""
    t = f"`{_db(spark, 'evolving')}`.elections"
    o = table(spark, d, "orders")
    for y in pivot_values(o.select(F.year("o_orderdate").alias("annee")), "annee"):
        rows = W.scan_years(o, "o_orderdate", y, y).select("o_orderkey", F.lit(y).cast("int").alias("annee"),
                                                           F.col("o_totalprice").alias("voix_paires" if y % 2 == 0 else "voix_impaires"))
        for _ in range(2):
            W.append_batch(rows, t, f"annee-{y}")
    return spark.table(t).select("o_orderkey", "annee", "voix_paires", "voix_impaires")


@query("routed_load", "K4 K5 P12", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS annee, 'presidentielle' AS type_election,
       o_totalprice AS mon_taux_prix, o_totalprice AS pourcentage_voix_inscrits_election
FROM orders""")
def routed_load(spark, d):
    """One source per year, routed by its name to the election table."""
    db = _db(spark, "routed")
    o = table(spark, d, "orders")
    years = pivot_values(o.select(F.year("o_orderdate").alias("annee")), "annee")
    text = F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    t = None
    for y in years:
        src = W.scan_years(o, "o_orderdate", y, y).select("o_orderkey", text.alias("mon_taux_prix"),
                                                          text.alias("pourcentage_voix_inscrits"))
        L.load_routed(src, f"Unrelated file {y}", db)                # no route: warned and skipped
        t = L.load_routed(src, f"Election {y}", db)
    return spark.table(t).select("o_orderkey", "annee", "type_election", "mon_taux_prix", "pourcentage_voix_inscrits_election")


_LAYOUT_SQL = f"""
WITH {C.LINE_BLOCKS_SQL}
SELECT l_orderkey AS bureau, 2017 AS annee, nom, 'F' AS sexe, voix, round(voix / 64, 6) AS pourcentage_voix_exprimes
FROM blocks"""


def _write_layout(spark, d, numbered):
    """Results files with one row per order: the code, filler columns, and a
    candidate block per line, with numbers as decimal-comma text.  Headers
    of the positional layout repeat: they differ in trailing blanks only,
    which the writer trims."""
    wide = C.wide_numbered(spark, d)
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    columns = {"Code de la région": F.lit("32"), "Bureau": F.col("l_orderkey")}
    columns |= {f"Commun {i}\xa0": F.lit("x") for i in range(15)}
    for k, n in enumerate(c.rpartition(".")[2] for c in wide.columns if c.startswith("Nom.")):
        nom, voix = F.col(f"`Nom.{n}`"), F.col(f"`Voix.{n}`")
        values = [F.when(nom.isNotNull(), F.lit("F")), nom, F.lit("P"), voix.cast("string"), comma(voix / 32), comma(voix / 64)]
        columns |= {f"{b}.{n}" if numbered else b + " " * k: v for b, v in zip(E.CANDIDATE_BLOCK, values)}
        if numbered:
            columns[f"N°Panneau.{n}"] = F.lit("1")
    path = scratch_path(spark, "layout")
    L.write_delimited(wide.select(*[v.alias(c) for c, v in columns.items()]), path)
    return path


def _layout_rows(df):
    return df.select(F.col("bureau").try_cast("bigint").alias("bureau"), "annee", "nom", "sexe", "voix",
                     F.round("pourcentage_voix_exprimes", 6).alias("pourcentage_voix_exprimes"))


@query("layout_numbered", "P6 R3 P8 P10 S1 C5", _LAYOUT_SQL)
def layout_numbered(spark, d):
    path = _write_layout(spark, d, True)
    return _layout_rows(E.numbered_rows(spark, path, 2017, "32"))


@query("layout_blocks", "P7 R2 P2 P3 P8 S1 C5", _LAYOUT_SQL)
def layout_blocks(spark, d):
    path = _write_layout(spark, d, False)
    return _layout_rows(E.block_rows(spark, path, 2017, "32"))


def _counts(spark, db, names):
    from functools import reduce
    parts = [spark.table(f"`{db}`.`{n}`").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(n).alias("tablename"), "n_rows") for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("table_catalog", "S10", """
SELECT 'nation' AS tablename, count(*) AS n_rows FROM nation
UNION ALL SELECT 'region', count(*) FROM region""")
def table_catalog(spark, d):
    db = _db(spark, "catalog")
    for n in ("nation", "region"):
        W.replace_table(table(spark, d, n), f"`{db}`.{n}")
    return _counts(spark, db, W.table_names(spark, db))


@query("truncate_all", "K8 S10", """
SELECT 'nation' AS tablename, count(*) * 0 AS n_rows FROM nation
UNION ALL SELECT 'region', count(*) * 0 FROM region""")
def truncate_all(spark, d):
    db = _db(spark, "flush")
    for n in ("nation", "region"):
        W.replace_table(table(spark, d, n), f"`{db}`.{n}")
    names = W.truncate_all(spark, db)
    return _counts(spark, db, names)


@query("drop_dataset", "K6", "SELECT 'region' AS dataset, count(*) AS n_rows FROM region")
def drop_dataset(spark, d):
    lake = scratch_path(spark, "lake")
    for n in ("nation", "region"):
        L.write_parquet(table(spark, d, n), f"{lake}/{n}")
    L.delete_path(spark, f"{lake}/nation")
    left = spark.read.option("recursiveFileLookup", True).parquet(lake) \
        .withColumn("dataset", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1))
    return left.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))


@query("create_schema", "K7 Q6", """
SELECT 'regions' AS tablename, count(*) AS n_rows, 2 AS n_columns FROM region
UNION ALL SELECT 'departements', count(*), 3 FROM nation
UNION ALL SELECT t, CAST(0 AS BIGINT), n FROM (VALUES ('cantons', 4), ('elections', 3), ('resultats_electoraux', 11),
  ('candidats', 4), ('votes_candidats', 6), ('statistiques_police', 11), ('election', 98), ('police', 11)) AS v(t, n)
UNION ALL SELECT 'violations', CAST(0 AS BIGINT), 17""")
def create_schema(spark, d):
    """Both schemas declared, two tables filled, and the declared keys and
    references audited: checks and violations in the last row."""
    db = _db(spark, "star")
    tables = W.STAR_SCHEMA | W.WIDE_SCHEMA
    W.create_schema(spark, db, tables)
    W.append_table(table(spark, d, "region").select(F.col("r_regionkey").alias("code_region"),
                                                    F.col("r_name").alias("libelle_region")), f"`{db}`.regions")
    W.append_table(table(spark, d, "nation").select(F.col("n_nationkey").alias("code_departement"),
                                                    F.col("n_name").alias("libelle_departement"),
                                                    F.col("n_regionkey").alias("code_region")), f"`{db}`.departements")
    columns = F.create_map(*[F.lit(x) for t in tables for x in (t, len(spark.table(f"`{db}`.`{t}`").columns))])
    counts = _counts(spark, db, list(tables)).withColumn("n_columns", F.element_at(columns, F.col("tablename")))
    audit = W.audit_schema(spark, db, W.STAR_SCHEMA).agg(F.sum("n_violations"), F.count(F.lit(1)).cast("int")) \
        .toDF("n_rows", "n_columns").select(F.lit("violations").alias("tablename"), "n_rows", "n_columns")
    return counts.unionByName(audit)


# Fixed rule for the literal share table: a base share per candidate plus
# half a point per year since 1995.
BASE_SHARE = {"1-URGENT": 22.0, "2-HIGH": 15.0, "3-MEDIUM": 16.0, "4-NOT SPECIFIED": 7.0, "5-LOW": 5.0}


@query("literal_votes", "S9 A3 X7", f"""
WITH base AS (SELECT * FROM {C.values_sql(list(BASE_SHARE.items()), "s(nom, base)")}),
tot AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS exprimes FROM orders GROUP BY 1)
SELECT nom, round(sum((base + 0.5 * (annee - 1995)) * exprimes / 100.0), 4) AS voix
FROM base CROSS JOIN tot GROUP BY nom""")
def literal_votes(spark, d):
    totals = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("annee")) \
                                      .agg(F.count(F.lit(1)).alias("exprimes"))
    # The literal table: every candidate for every year that has votes.
    base = F.array(*[F.struct(F.lit(n).alias("nom"), F.lit(b).alias("base")) for n, b in BASE_SHARE.items()])
    shares = totals.select("annee", F.inline(base)) \
        .select("annee", "nom", (F.col("base") + 0.5 * (F.col("annee") - 1995)).alias("pourcentage"))
    v = LT.votes_from_shares(shares, totals, ["annee"])
    return group_sums(v, ["nom"], {"voix": "voix"}).select("nom", F.round("voix", 4).alias("voix"))


@query("bucketed_lag", "W1 J3 K3", """
SELECT o.o_orderkey, c.c_nationkey, o.o_totalprice,
       lag(o.o_totalprice) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) AS previous
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def bucketed_lag(spark, d):
    """Lag and join over tables laid out by customer: neither moves the rows again."""
    db = _db(spark, "bucketed")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    o = W.replace_bucketed(o, f"`{db}`.orders", ["o_custkey"], n, ["o_orderdate", "o_orderkey"])
    c = W.replace_bucketed(c, f"`{db}`.customer", ["o_custkey"], n)
    lagged = lag_within(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "previous")
    return left_join(lagged, c, "o_custkey").select("o_orderkey", "c_nationkey", "o_totalprice", "previous")


@query("identity_restart", "K8 K2", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS id_resultat, o_orderkey, 'first' AS lot FROM orders
UNION ALL
SELECT (SELECT count(*) FROM orders) + row_number() OVER (ORDER BY o_orderkey), o_orderkey, 'second'
FROM orders WHERE o_orderpriority = '1-URGENT'""")
def identity_restart(spark, d):
    """Keys follow on from load to load, and start at 1 after a truncation."""
    db = _db(spark, "identity")
    name = f"`{db}`.resultats"
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    urgent = o.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("second").alias("lot"))
    W.append_identity(urgent, name, "id_resultat", ["o_orderkey"])
    W.truncate_all(spark, db)
    W.append_identity(o.select("o_orderkey", F.lit("first").alias("lot")), name, "id_resultat", ["o_orderkey"])
    W.append_identity(urgent, name, "id_resultat", ["o_orderkey"])
    return spark.table(name)
