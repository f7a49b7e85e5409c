"""Catalogue, part 3: joins, keyword parties, shares, windows, unions, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica.functions.text import normalise_name
from civica.operators import rows as RW
from civica.operators import shares as SH
from civica.operators import windows as WN
from civica.operators.aggregates import fill_global_mean, group_sums
from civica.operators.joins import keyword_index_match, keyword_match, left_join
from civica.plans import carriers as C
from civica.plans.q_tables import NULL_ORDERS_SQL, _orders_with_nulls
from civica.plans.registry import query, table
from civica.session import cut_lineage


@query("left_join_fanout", "J1", f"""
WITH {C.VOTES_SQL}, {C.QUARTERLY_SQL}
SELECT v.o_orderkey, v.annee, c.trimestre, round(c.taux_chomage, 9) AS taux_chomage
FROM votes v LEFT JOIN chomage c ON v.annee = c.annee""")
def left_join_fanout(spark, d):
    v = C.votes(spark, d).select("o_orderkey", "annee")
    j = left_join(v, C.quarterly_unemployment(spark, d), "annee", measure=True)
    return j.withColumn("taux_chomage", F.round("taux_chomage", 9))


@query("left_join_suffix", "J2", f"""
WITH {C.VOTES_SQL}, {C.POVERTY_SQL}
SELECT v.o_orderkey, v.annee, v.voix / 1000 AS taux, round(p.taux, 9) AS taux_pauvrete
FROM votes v LEFT JOIN pauvrete p ON v.annee = p.annee""")
def left_join_suffix(spark, d):
    v = C.votes(spark, d).select("o_orderkey", "annee", (F.col("voix") / 1000).alias("taux"))
    j = left_join(v, C.yearly_poverty(spark, d), "annee", suffix="_pauvrete", measure=True)
    return j.withColumn("taux_pauvrete", F.round("taux_pauvrete", 9))


@query("left_join_composite", "J3", f"""
WITH {C.VOTES_SQL}, {C.POLICE_SQL}
SELECT v.o_orderkey, v.annee, v.code_region, round(p.taux_pour_mille, 9) AS taux_pour_mille
FROM votes v LEFT JOIN police p ON v.annee = p.annee AND v.code_region = p.code_region""")
def left_join_composite(spark, d):
    v = C.votes(spark, d).select("o_orderkey", "annee", "code_region")
    j = left_join(v, C.police_rates(spark, d), ["annee", "code_region"], measure=True)
    return j.withColumn("taux_pour_mille", F.round("taux_pour_mille", 9))


@query("join_distinct_latest", "J4 W2 T4", f"""
WITH {C.CAT_VOTES_SQL},
cand AS (SELECT DISTINCT nom, categorie, code_region FROM catvotes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code_region, nom ORDER BY annee DESC, o_orderkey) AS rn
           FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 3 <> 0 THEN annee END AS annee) FROM catvotes)
           WHERE annee IS NOT NULL),
latest AS (SELECT * FROM ranked WHERE rn = 1)
SELECT c.nom, c.categorie, c.code_region, l.annee, l.voix, l.o_orderkey
FROM cand c LEFT JOIN latest l ON c.nom = l.nom AND c.categorie = l.categorie AND c.code_region = l.code_region""")
def join_distinct_latest(spark, d):
    # The first row of each candidate, region and year (unknown for some
    # rows): both sides come from it.
    v = C.categorised_votes(spark, d).withColumn("annee", F.when(F.col("o_orderkey") % 3 != 0, F.col("annee"))) \
        .groupBy("nom", "categorie", "code_region", "annee") \
        .agg(F.min_by("voix", "o_orderkey").alias("voix"), F.min("o_orderkey").alias("o_orderkey"))
    v = cut_lineage(v, name="first-rows")
    cand = RW.distinct_on(v, ["nom", "categorie", "code_region"])
    latest = WN.latest_row(v, ["code_region", "nom"], "annee", ties=["o_orderkey"])
    return left_join(cand, latest, ["nom", "categorie", "code_region"]) \
        .select("nom", "categorie", "code_region", "annee", "voix", "o_orderkey")


@query("inner_truth_pred", "J5 J8", f"""
WITH {C.VOTES_SQL},
p AS (SELECT *, voix + 100 * (o_orderkey % 3 - 1) AS pred_voix FROM votes),
t AS (SELECT annee, code_region, sum(voix) AS voix FROM p GROUP BY 1, 2),
q AS (SELECT annee, code_region, sum(pred_voix) AS pred_voix FROM p GROUP BY 1, 2)
SELECT t.annee, t.code_region, round(t.voix, 2) AS voix, round(q.pred_voix, 2) AS pred_voix
FROM t JOIN q ON t.annee = q.annee AND t.code_region = q.code_region""")
def inner_truth_pred(spark, d):
    # The deterministic "prediction" travels with its keys (J8: no index
    # alignment needed), then truth and prediction are joined on the keys.
    v = C.votes(spark, d).withColumn("pred_voix", F.col("voix") + 100 * (F.col("o_orderkey") % 3 - 1))
    t = group_sums(v, ["annee", "code_region"], {"voix": "voix"})
    p = group_sums(v, ["annee", "code_region"], {"pred_voix": "pred_voix"})
    return left_join(t, p, ["annee", "code_region"], how="inner") \
        .select("annee", "code_region", F.round("voix", 2).alias("voix"), F.round("pred_voix", 2).alias("pred_voix"))


# Keyword lists of the carrier "parties" over part names.  A
# name may match several parties ("red widget"), or none ("small ring").
PART_PARTIES = {
    "ROUGE": ["red", "hot"],
    "BLEU": ["blue", "cold"],
    "OUTIL": ["widget", "gear", "bolt", "rod"],
    "NEUF": ["new"],
    "AUTRES": [],
}
RIGHT_KEYWORDS = ["red", "hot"]


def _line_parts(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.year("l_shipdate").alias("annee"), "p_name", "p_brand", "l_extendedprice", "l_quantity")


LINE_PARTS_SQL = """lp AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS annee, p.p_name, p.p_brand, l.l_extendedprice, l.l_quantity
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def _party_sql():
    named = [p for p, k in PART_PARTIES.items() if k]
    sums = ",\n  ".join(
        f"coalesce(sum(CASE WHEN regexp_matches(p_name, '{C.sql_pattern(PART_PARTIES[p])}') "
        f"THEN l_extendedprice END), 0) AS \"{p}\"" for p in named)
    longs = "\n  UNION ALL ".join(f"SELECT annee, '{p}' AS parti, \"{p}\" AS voix FROM w" for p in named)
    resid = " + ".join(f'"{p}"' for p in named)
    return f"""
WITH {LINE_PARTS_SQL},
w AS (SELECT annee, sum(l_extendedprice) AS total,
  {sums}
  FROM lp GROUP BY annee),
l AS ({longs}
  UNION ALL SELECT annee, 'AUTRES', greatest(0, total - ({resid})) FROM w)
SELECT annee, parti, round(voix, 2) AS voix,
       round(100 * voix / sum(voix) OVER (PARTITION BY annee), 6) AS share
FROM l"""


@query("keyword_party_votes", "J7 A11 A12", _party_sql())
def keyword_party_votes(spark, d):
    lp = _line_parts(spark, d)
    t = SH.party_totals(lp, ["annee"], "p_name", "l_extendedprice", PART_PARTIES)
    t = SH.normalise_shares(t, ["annee"], "voix")
    return t.select("annee", "parti", F.round("voix", 2).alias("voix"), F.round("share", 6).alias("share"))


@query("keyword_index", "J7", """
WITH kw AS (SELECT DISTINCT s_nationkey AS parti, lower(right(s_name, 3)) AS kw FROM supplier),
m AS (SELECT DISTINCT c.c_custkey, c.c_acctbal, kw.parti FROM customer c JOIN kw ON contains(lower(c.c_name), kw.kw))
SELECT parti, count(*) AS n_names, round(sum(c_acctbal), 2) AS total FROM m GROUP BY parti""")
def keyword_index(spark, d):
    """Every supplier gives a keyword, the end of its name, to its nation:
    customers whose names hold a keyword of a nation, and their balance."""
    names = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    keywords = table(spark, d, "supplier").select("s_nationkey", F.right("s_name", F.lit(3)).alias("keyword"))
    hits = keyword_index_match(names, "c_name", keywords, "s_nationkey", "keyword")
    return hits.groupBy("parti").agg(F.count(F.lit(1)).alias("n_names"), F.round(F.sum("c_acctbal"), 2).alias("total"))


_ACCENTED = [k.replace("e", "é") for ks in PART_PARTIES.values() for k in ks]


@query("unassigned_names", "F8 Q7", f"""
SELECT DISTINCT translate(upper(p_name), 'E', 'É') AS p_name FROM part
WHERE NOT regexp_matches(translate(upper(p_name), 'E', 'É'), '{C.sql_pattern(_ACCENTED)}')""")
def unassigned_names(spark, d):
    # Upper-case accented names against lower-case accented keywords.
    p = table(spark, d, "part").select(F.translate(F.upper("p_name"), "E", "É").alias("p_name"))
    assigned = keyword_match(p, "p_name", {k: [w.replace("e", "é") for w in ws] for k, ws in PART_PARTIES.items()})
    return RW.not_in(p, "p_name", assigned)


@query("right_votes", "F7 A5 M18", f"""
WITH {LINE_PARTS_SQL}
SELECT annee, round(coalesce(sum(CASE WHEN regexp_matches(p_name, '{C.sql_pattern(RIGHT_KEYWORDS)}')
                                 THEN l_extendedprice END), 0), 2) AS votes_droite
FROM lp GROUP BY annee""")
def right_votes(spark, d):
    t = SH.masked_total(_line_parts(spark, d), ["annee"], "p_name", "l_extendedprice", RIGHT_KEYWORDS, "votes_droite")
    return t.select("annee", F.round("votes_droite", 2).alias("votes_droite"))


@query("share_normalised", "A12", f"""
WITH {C.CAT_VOTES_SQL},
g AS (SELECT annee, categorie, sum(voix) AS voix FROM catvotes GROUP BY 1, 2)
SELECT annee, categorie, round(100 * voix / sum(voix) OVER (PARTITION BY annee), 6) AS share FROM g""")
def share_normalised(spark, d):
    g = group_sums(C.categorised_votes(spark, d), ["annee", "categorie"], {"voix": "voix"})
    return SH.normalise_shares(g, ["annee"], "voix").select("annee", "categorie", F.round("share", 6).alias("share"))


@query("top_values_pruned", "A1 T2", """
SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL
GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 20""")
def top_values_pruned(spark, d):
    return RW.top_counts_pruned(table(spark, d, "lineitem"), "l_partkey", 20)


@query("value_counts_top20", "A1 T2", f"""
WITH {LINE_PARTS_SQL}
SELECT p_brand, count(*) AS n FROM lp GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 20""")
def value_counts_top20(spark, d):
    return RW.top_counts(_line_parts(spark, d), "p_brand", 20)


@query("bucket_other", "F6", f"""
WITH {LINE_PARTS_SQL},
top AS (SELECT p_brand FROM lp GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 20)
SELECT CASE WHEN t.p_brand IS NOT NULL THEN lp.p_brand ELSE 'AUTRE' END AS candidat,
       count(*) AS n_lines, round(sum(l_quantity), 2) AS quantite
FROM lp LEFT JOIN top t ON lp.p_brand = t.p_brand GROUP BY 1""")
def bucket_other(spark, d):
    # Per brand once: the ranking and the buckets both come from these rows.
    per = _line_parts(spark, d).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    per = cut_lineage(per, name="brands")
    top = per.where("p_brand is not null").orderBy(F.desc("n"), "p_brand").limit(20).select("p_brand")
    b = RW.keep_or_other(per, "p_brand", top, out="candidat")
    return b.groupBy("candidat").agg(F.sum("n").alias("n_lines"), F.round(F.sum("q"), 2).alias("quantite"))


@query("lag_votes", "W1 T1", f"""
WITH {C.VOTES_SQL}
SELECT o_orderkey, code_region, nom, annee, voix,
       lag(voix) OVER (PARTITION BY code_region, nom ORDER BY annee, o_orderkey) AS voix_prec
FROM votes""")
def lag_votes(spark, d):
    v = C.votes(spark, d)
    # Two-level lag split by (year, key range): no task holds a whole
    # (region, name) group.
    return WN.lag_within(v, ["code_region", "nom"], ["annee", "o_orderkey"], "voix", "voix_prec",
                         split=C.lag_split()) \
        .select("o_orderkey", "code_region", "nom", "annee", "voix", "voix_prec")


@query("group_mean_fill", "W4", f"""
WITH {NULL_ORDERS_SQL}
SELECT o_orderkey, o_orderpriority,
       round(CASE WHEN o_orderpriority IS NULL THEN o_totalprice
                  ELSE coalesce(o_totalprice, avg(o_totalprice) OVER (PARTITION BY o_orderpriority)) END, 6) AS voix
FROM nulled""")
def group_mean_fill(spark, d):
    o = _orders_with_nulls(spark, d)
    f = WN.group_mean_fill(o, ["o_orderpriority"], "o_totalprice", out="voix")
    return f.select("o_orderkey", "o_orderpriority", F.round("voix", 6).alias("voix"))


@query("global_mean_fill", "M9 A4", f"""
WITH {NULL_ORDERS_SQL}
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM nulled)), 6) AS voix FROM nulled""")
def global_mean_fill(spark, d):
    o = _orders_with_nulls(spark, d)
    return fill_global_mean(o, ["o_totalprice"]).select("o_orderkey", F.round("o_totalprice", 6).alias("voix"))


def _event_gaps(spark, d):
    e = table(spark, d, "events").select("ts", "event_type", "value")
    # The "view" series starts on the 4th; "error" values are not recorded at
    # weekends (Spark dayofweek: 1 = Sunday, 7 = Saturday); "signup" is 0 on
    # two days.
    gap = ((F.col("event_type") == "view") & (F.dayofmonth("ts") < 4)) | \
          ((F.col("event_type") == "error") & F.dayofweek("ts").isin(1, 7))
    zero = (F.col("event_type") == "signup") & F.dayofmonth("ts").isin(10, 11)
    return e.select(F.to_date("ts").alias("day"), "event_type",
                    F.when(zero, F.lit(0.0)).when(~gap, F.col("value")).alias("value"))


@query("pct_change_mean", "W5 A10", """
WITH e AS (
  SELECT CAST(ts AS DATE) AS day, event_type,
         CASE WHEN (event_type = 'view' AND dayofmonth(ts) < 4)
                OR (event_type = 'error' AND isodow(ts) IN (6, 7)) THEN NULL
              WHEN event_type = 'signup' AND dayofmonth(ts) IN (10, 11) THEN 0 ELSE value END AS value
  FROM events),
obs AS (SELECT event_type AS s, day AS p, avg(value) AS v FROM e WHERE value IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT DISTINCT p FROM obs), ser AS (SELECT DISTINCT s FROM obs),
dense AS (SELECT ser.s, grid.p, obs.v FROM ser CROSS JOIN grid LEFT JOIN obs ON obs.s = ser.s AND obs.p = grid.p),
ff AS (SELECT s, p, last_value(v IGNORE NULLS) OVER (PARTITION BY s ORDER BY p
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM dense),
ch AS (SELECT s, p, f / nullif(lag(f) OVER (PARTITION BY s ORDER BY p), 0) - 1 AS c FROM ff)
SELECT p AS day, round(coalesce(avg(c), 0), 9) AS evolution FROM ch GROUP BY p""")
def pct_change_mean(spark, d):
    r = WN.pct_change_mean(_event_gaps(spark, d), "event_type", "day", "value")
    return r.select("day", F.round("evolution", 9).alias("evolution"))


@query("last_value", "W6", f"""
WITH {C.VOTES_SQL},
y AS (SELECT nom, annee, sum(voix) AS voix FROM votes GROUP BY 1, 2)
SELECT nom, round(arg_max(voix, annee), 2) AS last_value FROM y GROUP BY nom""")
def last_value(spark, d):
    y = group_sums(C.votes(spark, d), ["nom", "annee"], {"voix": "voix"})
    return WN.last_value(y, ["nom"], "annee", "voix").select("nom", F.round("last_value", 2).alias("last_value"))


@query("rank_parties", "T3", f"""
WITH {C.CAT_VOTES_SQL},
g AS (SELECT annee, categorie, sum(voix) AS voix FROM catvotes GROUP BY 1, 2)
SELECT annee, categorie, round(voix, 2) AS voix,
       CAST(row_number() OVER (PARTITION BY annee ORDER BY voix DESC, categorie) AS INTEGER) AS rang FROM g""")
def rank_parties(spark, d):
    g = group_sums(C.categorised_votes(spark, d), ["annee", "categorie"], {"voix": "voix"})
    return SH.rank_within(g, ["annee"], "voix", ties=["categorie"]) \
        .select("annee", "categorie", F.round("voix", 2).alias("voix"), "rang")


@query("head_rows", "T5", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark, d):
    return RW.head_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 5, ["o_orderkey"])


@query("union_periods", "U1", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def union_periods(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                           F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                           F.col("s_nationkey").alias("nationkey"))
    return RW.union_all([c, s])


@query("union_missing_columns", "U2", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_missing_columns(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                           F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                           F.col("s_acctbal").alias("balance"))
    return RW.union_missing([c, s]).select("id", "name", "segment", "balance")


@query("normalise_names", "X1 X2 X3", """
WITH raw AS (
  SELECT p_partkey,
         CASE WHEN p_size > 45 THEN NULL
              ELSE ' ' || translate(p_name, 'aeo', 'àéô') || '  -' || p_type || ' ' END AS nom
  FROM part)
SELECT p_partkey,
       replace(replace(replace(translate(upper(trim(coalesce(nom, ''))), 'ÉÈÊÀÂÇÔÙÛ', 'EEEAACOUU'),
               '-', ' '), '  ', ' '), 'DUPONT AIGNAN', 'DUPONTAIGNAN') AS nom
FROM raw""")
def normalise_names(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")
    raw = F.when(F.col("p_size") <= 45,                      # large parts: name missing

                 F.concat(F.lit(" "), F.translate("p_name", "aeo", "àéô"), F.lit("  -"), F.col("p_type"), F.lit(" ")))
    return p.select("p_partkey", normalise_name(raw).alias("nom"))
