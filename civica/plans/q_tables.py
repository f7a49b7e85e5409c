"""Catalogue, part 1: scans, filters, casts, header harmonisation, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica.functions.numbers import decimal_comma, fill_empty, fill_sentinel, to_int, to_number
from civica.operators import columns as P
from civica.operators import reshape as R
from civica.operators import rows as RW
from civica.operators.aggregates import group_sums
from civica.operators.windows import argmax_label
from civica.plans import carriers as C
from civica.plans.registry import query, table
from civica.session import cut_lineage
from civica.sources import warehouse as W


@query("majority_category", "J6 A2 W3", f"""
WITH {C.CAT_VOTES_SQL},
g AS (SELECT annee, code_region, categorie, sum(voix) AS voix FROM catvotes GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY annee, code_region ORDER BY voix DESC, categorie) AS rn FROM g)
SELECT annee, code_region, categorie, round(voix, 2) AS voix FROM r WHERE rn = 1""")
def majority_category(spark, d):
    """Winning category per (year, region): lookup, group sum, arg-max."""
    v = C.categorised_votes(spark, d)
    g = group_sums(v, ["annee", "code_region", "categorie"], {"voix": "voix"})
    top = argmax_label(g, ["annee", "code_region"], "categorie", "voix", value_out="voix")
    return top.select("annee", "code_region", "categorie", F.round("voix", 2).alias("voix"))


@query("scan_year_range", "S5 S6", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 2000""")
def scan_year_range(spark, d):
    return W.scan_years(table(spark, d, "orders"), "o_orderdate", 1996, 2000,
                        columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


@query("full_scan", "S7", "SELECT * FROM customer")
def full_scan(spark, d):
    return W.full_scan(table(spark, d, "customer"))


@query("filtered_ordered_scan", "S8 F2 T1", """
SELECT * FROM customer WHERE c_nationkey = 13 ORDER BY c_mktsegment, c_custkey""")
def filtered_ordered_scan(spark, d):
    return W.scan_where_ordered(table(spark, d, "customer"), "c_nationkey", 13, ["c_mktsegment", "c_custkey"])


@query("prefix_filter", "F1", """
SELECT p_partkey, p_size FROM part WHERE CAST(p_size AS VARCHAR) LIKE '1%'""")
def prefix_filter(spark, d):
    return RW.prefix_filter(table(spark, d, "part").select("p_partkey", "p_size"), "p_size", "1")


def _orders_with_nulls(spark, d):
    # Gaps as they occur in result files: no count yet for pending orders
    # (status P), "not specified" recorded as a missing value, and a column
    # that was never filled.
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit(None).cast("double").alias("o_comment_score"))


NULL_ORDERS_SQL = """nulled AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS o_orderpriority,
         CAST(NULL AS DOUBLE) AS o_comment_score
  FROM orders)"""


@query("null_filters", "F3 F4 F5", f"""
WITH {NULL_ORDERS_SQL}
SELECT o_orderkey, o_totalprice, o_orderpriority FROM nulled
WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL""")
def null_filters(spark, d):
    df = RW.drop_all_null_columns(_orders_with_nulls(spark, d))
    df = RW.drop_null_rows(df, ["o_totalprice"])
    return RW.drop_null_rows(df)


@query("coerce_numeric", "C1 C2 C3 C4 C5", """
WITH mixed AS (
  SELECT p_partkey,
         CASE WHEN p_size = 3 THEN CAST(9007199254740993 + p_partkey AS VARCHAR)
              WHEN p_size <= 17 THEN CAST(p_size AS VARCHAR)
              WHEN p_size <= 34 THEN replace(CAST(p_retailprice AS VARCHAR), '.', ',')
              ELSE p_name END AS raw,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS label
  FROM part)
SELECT p_partkey,
       TRY_CAST(raw AS DOUBLE) AS as_number,
       TRY_CAST(replace(trim(raw), ',', '.') AS DOUBLE) AS decimal_comma,
       coalesce(TRY_CAST(raw AS DOUBLE), -1) AS with_sentinel,
       CAST(CASE WHEN regexp_full_match(raw, '[0-9]+') THEN TRY_CAST(raw AS BIGINT)
                 ELSE CAST(trunc(TRY_CAST(replace(trim(raw), ',', '.') AS DOUBLE)) AS BIGINT) END AS VARCHAR) AS as_int,
       coalesce(label, '') AS label
FROM mixed""")
def coerce_numeric(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_name", "p_type")
    # A text column mixing integers (some beyond 53 bits), decimal-comma
    # numbers and words (by part size), and a label missing for promotional
    # parts.
    raw = (F.when(F.col("p_size") == 3, (F.lit(9007199254740993) + F.col("p_partkey")).cast("string"))
            .when(F.col("p_size") <= 17, F.col("p_size").cast("string"))
            .when(F.col("p_size") <= 34, F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")))
            .otherwise(F.col("p_name")))
    m = p.select("p_partkey", raw.alias("raw"),
                 F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("label"))
    return m.select("p_partkey",
                    to_number("raw").alias("as_number"),
                    decimal_comma("raw").alias("decimal_comma"),
                    fill_sentinel(to_number("raw"), -1.0).alias("with_sentinel"),
                    to_int(F.replace("raw", F.lit(","), F.lit("."))).cast("string").alias("as_int"),
                    fill_empty("label", "").alias("label"))


@query("harmonise_headers", "P1 P2 P3 P4 P5 P8 P9 P10", f"""
WITH {C.VOTES_SQL}
SELECT CAST(code_region AS VARCHAR) AS code_region, nom AS nom_departement, o_orderkey AS inscrits,
       voix AS pourcentage_abstentions_inscrits, annee AS exprimes
FROM votes""")
def harmonise_headers(spark, d):
    v = C.votes(spark, d)
    messy = v.select(
        F.col("o_orderkey").alias("Code département"),           # collides, loses (not last)
        F.col("nom").alias("Libellé du\xa0département"),
        F.col("o_orderkey").alias(" Inscrits"),
        F.col("voix").alias("% Abs Ins"),
        F.lit("x").alias("Unnamed: 5"),
        F.col("annee").alias("Exprimés"),
        F.col("code_region").cast("string").alias("Code du département"))
    out = P.harmonise(messy)
    # A leading blank became "_" (strip runs after the blank → "_" rewrite).
    out = P.rename_aliases(out, {"_inscrits": "inscrits"})
    return out.select("code_region", "nom_departement", "inscrits", "pourcentage_abstentions_inscrits", "exprimes")


def _wide_sql(style: str) -> str:
    cols = []
    for i in C.LINES:
        n, v = (f"Nom.{i}", f"Voix.{i}") if style == "numbered" else (("nom", "voix") if i == 1 else (f"nom_{i}", f"voix_{i}"))
        cols.append(f"max(CASE WHEN l_linenumber = {i} THEN nom END) AS \"{n}\"")
        cols.append(f"max(CASE WHEN l_linenumber = {i} THEN voix END) AS \"{v}\"")
    return f"WITH {C.LINE_BLOCKS_SQL}\nSELECT l_orderkey, " + ", ".join(cols) + " FROM blocks GROUP BY l_orderkey"


@query("wide_rename_blocks", "P6 P7 R9", _wide_sql("suffixed"))
def wide_rename_blocks(spark, d):
    return C.wide_suffixed(spark, d)


@query("project_candidate", "P11 P13 P14", f"""
WITH {C.LINE_BLOCKS_SQL}
SELECT l_orderkey, nom AS Nom, voix AS Voix FROM blocks WHERE l_linenumber = 1""")
def project_candidate(spark, d):
    w = C.wide_numbered(spark, d)
    names = P.columns_with_prefix(w, "Nom.")                       # P14
    votes = P.columns_with_prefix(w, "Voix.", exclude_prefix="% Voix")
    others = P.complement(w, names[1:] + votes[1:])                # P13
    first = w.select(*[F.col(f"`{c}`") for c in others])
    return first.select("l_orderkey", F.col("`Nom.1`").alias("Nom"), F.col("`Voix.1`").alias("Voix")) \
                .where(F.col("Nom").isNotNull())                  # P11


LONG_SQL = f"WITH {C.LINE_BLOCKS_SQL}\nSELECT l_orderkey, nom, voix FROM blocks"


@query("long_by_suffix", "R1", LONG_SQL)
def long_by_suffix(spark, d):
    return R.long_by_suffix(C.wide_suffixed(spark, d), ["l_orderkey"], ["nom", "voix"])


@query("long_by_block", "R2", LONG_SQL)
def long_by_block(spark, d):
    w = C.wide_suffixed(spark, d).withColumn("Unnamed: 15", F.lit(None).cast("string"))  # ragged tail
    return R.long_by_block(w, 1, ["nom", "voix"])


@query("long_by_detect", "R3", f"""
WITH {C.LINE_BLOCKS_SQL}
SELECT l_orderkey, l_linenumber AS candidate_number, nom AS Nom, voix AS Voix FROM blocks""")
def long_by_detect(spark, d):
    return R.long_by_detect(C.wide_numbered(spark, d), ["Nom", "Voix"])


@query("unpivot_quarters", "R4 R5 X4", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
       round(sum(o_totalprice), 2) AS taux_chomage
FROM orders GROUP BY 1, 2""")
def unpivot_quarters(spark, d):
    o = table(spark, d, "orders").select("o_orderdate", "o_totalprice")
    y, q = F.year("o_orderdate"), F.quarter("o_orderdate")
    # The wide indicator file: one row, one column per quarter, both label
    # spellings (odd years ``T1_1995``, even years ``1996-T1``).
    label = F.when(y % 2 == 1, F.format_string("T%d_%d", q, y)).otherwise(F.format_string("%d-T%d", y, q))
    sums = cut_lineage(o.groupBy(label.alias("label")).agg(F.sum("o_totalprice").alias("v")), name="quarters")
    labels = R.pivot_values(sums, "label")
    wide = sums.groupBy().pivot("label", labels).agg(F.sum("v"))
    long = R.unpivot_quarters(wide, labels, value_col="taux_chomage")
    return long.withColumn("taux_chomage", F.round("taux_chomage", 2))


@query("pivot_mean", "R6 R7 F4", """
WITH p AS (
  SELECT CAST(ts AS DATE) AS day,
         round(avg(CASE WHEN event_type = 'click' THEN value END), 9) AS click,
         round(avg(CASE WHEN event_type = 'error' THEN value END), 9) AS error,
         round(avg(CASE WHEN event_type = 'purchase' THEN value END), 9) AS purchase,
         round(avg(CASE WHEN event_type = 'signup' THEN value END), 9) AS signup,
         round(avg(CASE WHEN event_type = 'view' THEN value END), 9) AS view
  FROM events GROUP BY 1)
SELECT * FROM p WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL
  AND signup IS NOT NULL AND view IS NOT NULL""")
def pivot_mean(spark, d):
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_type", "value")
    types = R.pivot_values(e, "event_type")
    wide = RW.drop_null_rows(R.pivot_mean(e, ["day"], "event_type", "value", types))
    return wide.select("day", *[F.round(F.col(f"`{t}`"), 9).alias(t) for t in types])


@query("unstack_zero_fill", "R8 R9 M19", f"""
WITH {C.CAT_VOTES_SQL},
g AS (SELECT annee, categorie, sum(voix) AS voix FROM catvotes GROUP BY 1, 2)
SELECT annee,
""" + ",\n".join(
    f"  CASE WHEN EXISTS (SELECT 1 FROM catvotes WHERE categorie = {C.sql_str(c)}) "
    f"THEN round(sum(CASE WHEN categorie = {C.sql_str(c)} THEN voix END), 2) ELSE 0.0 END AS \"{c}\""
    for c in C.CATEGORIES) + "\nFROM g GROUP BY annee")
def unstack_zero_fill(spark, d):
    v = C.categorised_votes(spark, d)
    wide = R.unstack_zero_fill(v, ["annee"], "categorie", "voix", C.CATEGORIES)
    return wide.select("annee", *[F.round(F.col(f"`{c}`"), 2).alias(c) for c in C.CATEGORIES])


@query("pivot_sparse", "R6 R9", """
SELECT l_suppkey, l_partkey, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem
WHERE l_partkey IS NOT NULL GROUP BY ALL""")
def pivot_sparse(spark, d):
    """Mean quantity as a map over all parts per supplier, read back as cells."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    wide = R.pivot_sparse(li, ["l_suppkey"], "l_partkey", "l_quantity")
    return R.unpivot_sparse(wide, ["l_suppkey"], "l_partkey", "mean_quantity") \
        .withColumn("mean_quantity", F.round("mean_quantity", 6))
