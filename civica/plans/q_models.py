"""Catalogue, part 5: trends, split, scaling, scenarios, models, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica.functions.text import contains_any
from civica.operators import booster as BO
from civica.operators import evaluate as EV
from civica.operators import model as MD
from civica.operators import shares as SH
from civica.operators import trends as TR
from civica.operators.aggregates import fill_global_mean, group_sums
from civica.operators.features import hash_split as hash_split_op
from civica.operators.features import robust_scale as robust_scale_op
from civica.operators.joins import left_join
from civica.operators import reshape as R
from civica.operators.quality import with_min_history
from civica.operators.windows import lag_within, latest_row, pct_change_mean
from civica.plans import carriers as C
from civica.plans.q_aggregates import _YEARLY_SQL, _yearly_millions
from civica.plans.q_joins import LINE_PARTS_SQL, RIGHT_KEYWORDS, _event_gaps, _line_parts
from civica.plans.registry import query, table
from civica.session import cut_lineage


def quad_sql(src: str, s: str, x: str, y: str, years: list[int] | str) -> str:
    """SQL twin of ``quadratic_fit`` + ``quadratic_predict`` (centred moments,
    Cramer's rule, minimum-norm two-point case) over CTE ``src``, at years or
    at the rows of a query."""
    yrs = years if isinstance(years, str) else "VALUES " + ", ".join(f"({t})" for t in years)
    return f"""
qp AS (SELECT {s} AS s, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {src}
       WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
qc AS (SELECT *, x - avg(x) OVER (PARTITION BY s) AS u FROM qp),
qm AS (SELECT s, count(*) AS n, count(DISTINCT x) AS nd, avg(x) AS xbar, avg(x * x) AS qbar, avg(y) AS ybar,
              sum(u * u) AS s2, sum(u * u * u) AS s3, sum(u * u * u * u) AS s4,
              sum(y) AS t0, sum(u * y) AS t1, sum(u * u * y) AS t2, min(x) AS xmin, max(x) AS xmax
       FROM qc GROUP BY s),
qf AS (SELECT *, n * (s2 * s4 - s3 * s3) - s2 * s2 * s2 AS det, xmax - xmin AS dx, xmax * xmax - xmin * xmin AS dq
       FROM qm),
qpred AS (SELECT s, t.annee,
  CASE WHEN nd >= 3 THEN (t0 * (s2 * s4 - s3 * s3) + s2 * (t1 * s3 - s2 * t2)) / det
                         + (n * (t1 * s4 - s3 * t2) + t0 * s2 * s3 - t1 * s2 * s2) / det * (t.annee - xbar)
                         + (n * (s2 * t2 - t1 * s3) - t0 * s2 * s2) / det * (t.annee - xbar) * (t.annee - xbar)
       WHEN nd = 2 THEN ybar + (dx * t1 / (s2 * (dx * dx + dq * dq)))
                         * (dx * (t.annee - xbar) + dq * (CAST(t.annee AS DOUBLE) * t.annee - qbar))
       ELSE ybar END AS pred
  FROM qf, ({yrs}) AS t(annee))"""


@query("linear_trend", "M4 M16", _YEARLY_SQL + """,
f AS (SELECT nom, regr_slope(v, annee) AS slope, avg(annee) AS xbar, avg(v) AS ybar FROM y GROUP BY nom)
SELECT nom, t.annee, round(ybar + slope * (t.annee - xbar), 6) AS pred
FROM f, (VALUES (2002), (2003), (2004), (2005)) AS t(annee)""")
def linear_trend(spark, d):
    fit = TR.linear_fit(_yearly_millions(spark, d), ["nom"], "annee", "v")
    p = TR.linear_predict(fit, [2002, 2003, 2004, 2005])
    return p.select("nom", "annee", F.round("pred", 6).alias("pred"))


@query("quadratic_trend", "M3 M14", _YEARLY_SQL + "," + quad_sql("y", "nom", "annee", "v", [2002, 2003]) + """
SELECT s AS nom, annee, round(least(greatest(pred, 0), 120), 6) + 0.0 AS pred FROM qpred""")
def quadratic_trend(spark, d):
    fit = TR.quadratic_fit(_yearly_millions(spark, d), ["nom"], "annee", "v")
    p = TR.bounded(TR.quadratic_predict(fit, [2002, 2003]), "pred", 0, 120)
    return p.select("nom", "annee", F.round("pred", 6).alias("pred"))


_CAT_SHARES_SQL = f"""WITH {C.CAT_VOTES_SQL},
g AS (SELECT annee, categorie, sum(voix) AS voix FROM catvotes GROUP BY 1, 2),
sh AS (SELECT annee, categorie, 100 * voix / sum(voix) OVER (PARTITION BY annee) AS share FROM g)"""


def _category_shares(spark, d):
    g = group_sums(C.categorised_votes(spark, d), ["annee", "categorie"], {"voix": "voix"})
    return SH.normalise_shares(g, ["annee"], "voix")


@query("quadratic_two_points", "M3 M15", _CAT_SHARES_SQL + """,
two AS (SELECT * FROM sh WHERE annee IN (2000, 2001)),""" + quad_sql("two", "categorie", "annee", "share", [2006, 2011]) + """
SELECT s AS categorie, annee, round(least(greatest(pred, 10), 60), 6) AS pred FROM qpred""")
def quadratic_two_points(spark, d):
    s = _category_shares(spark, d).where(F.col("annee").isin(2000, 2001))
    fit = TR.quadratic_fit(s, ["categorie"], "annee", "share")
    p = TR.bounded(TR.quadratic_predict(fit, [2006, 2011]), "pred", 10, 60)
    return p.select("categorie", "annee", F.round("pred", 6).alias("pred"))


# Upper bound of each predicted share (percent) by category;
# every other category is bounded by 50.  Floor after bounding: 1.
CAPS = {"Extrême droite": 60.0, "Extrême gauche": 50.0, "Gauche": 20.0}
DEFAULT_CAP = 50.0


@query("party_caps", "M13 T3", _CAT_SHARES_SQL + """,
fitin AS (SELECT * FROM sh WHERE categorie <> 'Autres'),""" + quad_sql("fitin", "categorie", "annee", "share", [2003, 2008]) + """,
capped AS (SELECT s AS categorie, annee,
  greatest(1, least(greatest(pred, 0), CASE s WHEN 'Extrême droite' THEN 60 WHEN 'Extrême gauche' THEN 50
                                             WHEN 'Gauche' THEN 20 ELSE 50 END)) AS v FROM qpred),
tot AS (SELECT annee, sum(v) AS t FROM capped GROUP BY annee),
norm AS (SELECT c.categorie, c.annee, c.v / t.t * 100 AS share, t.t FROM capped c JOIN tot t USING (annee))
SELECT categorie, annee, round(share, 6) AS share FROM norm
UNION ALL SELECT 'Autres', annee, round(CASE WHEN max(t) < 100 THEN 100 - sum(share) ELSE 0 END, 6) + 0.0
FROM norm GROUP BY annee""")
def party_caps(spark, d):
    s = _category_shares(spark, d).where(F.col("categorie") != "Autres")
    p = TR.quadratic_predict(TR.quadratic_fit(s, ["categorie"], "annee", "share"), [2003, 2008])
    p = SH.apply_caps(p.select("categorie", "annee", "pred"), "categorie", "pred", CAPS, DEFAULT_CAP, lo=0.0, floor=1.0)
    r = SH.renormalise_with_residual(p, ["annee"], "categorie", "pred", residual="Autres")
    return r.select("categorie", "annee", (F.round("share", 6) + F.lit(0.0)).alias("share"))


def _features(spark, d, categorised=False):
    """Votes with their indicators: yearly unemployment (mean of the
    quarterly means), poverty, and crime per (year, region).  The lines are
    read once; the votes do not move for the three joins."""
    v = C.categorised_votes(spark, d) if categorised else C.votes(spark, d)
    unemployment, poverty, police = C.indicator_tables(C.indicators(spark, d))
    f = left_join(v, unemployment, "annee", measure=True)
    f = left_join(f, poverty, "annee", suffix="_pauvrete", measure=True)
    return left_join(f, police, ["annee", "code_region"], measure=True)


def _feature_table(spark, d):
    """The categorised votes with indicators and lag (W1), written once:
    training rows, the latest rows and the scenario means all come from it."""
    f = _features(spark, d, categorised=True)
    f = lag_within(f, ["code_region", "nom"], ["annee", "o_orderkey"], "voix", "voix_prec", split=C.lag_split())
    return cut_lineage(f, name="features")


FEATURE_SQL = f"""{C.VOTES_SQL}, {C.QUARTERLY_SQL}, {C.POVERTY_SQL}, {C.POLICE_SQL},
cy AS (SELECT annee, avg(taux_chomage) AS taux_chomage FROM chomage GROUP BY annee),
f AS (SELECT v.*, cy.taux_chomage, p.taux, pl.taux_pour_mille
      FROM votes v LEFT JOIN cy ON v.annee = cy.annee LEFT JOIN pauvrete p ON v.annee = p.annee
      LEFT JOIN police pl ON v.annee = pl.annee AND v.code_region = pl.code_region)"""

INDICATORS = {"chomage": ["taux_chomage"], "pauvrete": ["taux"], "police": ["taux_pour_mille"]}


@query("scenario_rows", "M8 X8 W2 F9 A4", f"""
WITH {FEATURE_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY code_region, nom ORDER BY annee DESC, o_orderkey) AS rn FROM f),
m AS (SELECT avg(taux_chomage) AS c, avg(taux) AS p, avg(taux_pour_mille) AS k FROM f
      WHERE annee = (SELECT max(annee) FROM f)),
s AS (SELECT * FROM (VALUES (2027, 1.0, 1.0, 1.0), (2032, 1.5, 0.5, 2.0)) AS t(y, fc, fp, fk))
SELECT r.code_region, r.nom, CAST(s.y AS INTEGER) AS annee, r.voix,
       round(m.c * s.fc, 9) AS taux_chomage, round(m.p * s.fp, 9) AS taux, round(m.k * s.fk, 9) AS taux_pour_mille
FROM r, m, s WHERE r.rn = 1""")
def scenario_rows(spark, d):
    f = cut_lineage(_features(spark, d), name="features")
    latest = latest_row(f, ["code_region", "nom"], "annee", ties=["o_orderkey"])
    s = MD.scenario_frame(latest, f, "annee", INDICATORS)
    return s.select("code_region", "nom", "annee", "voix",
                    *[F.round(c, 9).alias(c) for c in ("taux_chomage", "taux", "taux_pour_mille")])


FEATURES = ["annee", "voix_prec", "taux_chomage", "taux", "taux_pour_mille"]


INDICATOR_COLUMNS = ["taux_chomage", "taux", "taux_pour_mille"]


def _training_frame(features):
    """Rows without a previous vote are dropped, the remaining indicator gaps
    mean-filled (M9), rows split 80/20 (M1)."""
    f = fill_global_mean(features.where(F.col("voix_prec").isNotNull()), INDICATOR_COLUMNS)
    return hash_split_op(f.withColumn("annee", F.col("annee").cast("double")), ["o_orderkey"])


def booster_sql(src: str, n_features: int, rounds: int, depth: int, rate: float, bins: int, penalty: float = 0.0, least: int = 20) -> str:
    """SQL twin of ``fit_booster`` and its scores: CTEs that end in
    ``boosted(id, score)``.  ``src`` has id, train, y and x0, x1, …; other
    rows are only scored."""
    shares = "[" + ", ".join(repr(i / bins) for i in range(1, bins)) + "]"
    each = lambda body: " UNION ALL ".join(body.format(i=i) for i in range(n_features))
    out = [f"""
bb AS MATERIALIZED (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS k FROM (SELECT DISTINCT f, v FROM ({each(
        f"SELECT {{i}} AS f, unnest(quantile_disc(x{{i}}, {shares})) AS v FROM {src} WHERE train AND x{{i}} IS NOT NULL")}))),
bv AS MATERIALIZED (SELECT f, list(v) AS vs FROM bb GROUP BY f),
bl AS MATERIALIZED (SELECT id, f, CASE WHEN x IS NOT NULL THEN len(list_filter(coalesce(vs, []), lambda v : v < x)) END AS b
  FROM ({each(f"SELECT id, {{i}} AS f, x{{i}} AS x FROM {src}")}) LEFT JOIN bv USING (f)),
bs AS MATERIALIZED (SELECT avg(y) AS base, sum(y * y) - sum(y) * sum(y) / count(*) AS spread FROM {src} WHERE train),
r0 AS MATERIALIZED (SELECT id, train, y, base AS score FROM {src}, bs)"""]
    for t in range(rounds):
        out.append(f"m{t}_0 AS MATERIALIZED (SELECT id, 1 AS node FROM r{t})")
        for lv in range(depth):
            m, h, s = f"m{t}_{lv}", f"h{t}_{lv}", f"s{t}_{lv}"
            out.append(f"""{h} AS MATERIALIZED (SELECT node, f, b, count(*) AS n, sum(y - score) AS g FROM {m} JOIN r{t} USING (id) JOIN bl USING (id)
  WHERE train AND node >= {2 ** lv} GROUP BY 1, 2, 3),
{s} AS MATERIALIZED (SELECT node, f, k, missing_left FROM (
  SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, k, missing_left DESC) AS rk FROM (
    SELECT node, f, k, missing_left, round((lg * lg / (ln + {penalty}) + (g - lg) * (g - lg) / (n - ln + {penalty}) - g * g / (n + {penalty})) / spread, 9) AS gain
    FROM (SELECT *, bn + CASE WHEN missing_left THEN mn ELSE 0 END AS ln, bg + CASE WHEN missing_left THEN mg ELSE 0 END AS lg FROM (
      SELECT h.node, h.f, bb.k, sum(h.n) AS n, sum(h.g) AS g, coalesce(sum(h.n) FILTER (h.b IS NULL), 0) AS mn, coalesce(sum(h.g) FILTER (h.b IS NULL), 0) AS mg,
             coalesce(sum(h.n) FILTER (h.b <= bb.k), 0) AS bn, coalesce(sum(h.g) FILTER (h.b <= bb.k), 0) AS bg
      FROM {h} h JOIN bb ON bb.f = h.f GROUP BY 1, 2, 3), (VALUES (true), (false)) AS w(missing_left)), bs
    WHERE ln >= {least} AND n - ln >= {least} AND (mn > 0 OR missing_left = (2 * ln >= n))) WHERE gain > 0) WHERE rk = 1),
m{t}_{lv + 1} AS MATERIALIZED (SELECT m.id, CASE WHEN s.node IS NULL THEN m.node ELSE 2 * m.node + CASE WHEN coalesce(bl.b <= s.k, s.missing_left) THEN 0 ELSE 1 END END AS node
  FROM {m} m LEFT JOIN {s} s ON s.node = m.node LEFT JOIN bl ON bl.id = m.id AND bl.f = s.f)""")
        out.append(f"""v{t} AS MATERIALIZED (SELECT node, {rate} * sum(y - score) / (count(*) + {penalty}) AS leaf FROM m{t}_{depth} JOIN r{t} USING (id) WHERE train GROUP BY 1),
r{t + 1} AS MATERIALIZED (SELECT id, train, y, score + leaf AS score FROM r{t} JOIN m{t}_{depth} USING (id) JOIN v{t} USING (node))""")
    return ",\n".join(out) + f",\nboosted AS (SELECT id, score FROM r{rounds})"


# Settings of the registered models.
BOOSTING = {"rounds": 8, "depth": 3, "rate": 0.3, "bins": 32, "least": 20}
_SPLIT_SQL = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|#42'), 1, 8)) AS BIGINT) % 100 < 80"
_LAGGED_SQL = f"""{FEATURE_SQL},
l AS (SELECT *, lag(voix) OVER (PARTITION BY code_region, nom ORDER BY annee, o_orderkey) AS voix_prec, {_SPLIT_SQL} AS train FROM f)"""


def _source_sql(where: str = "true", police: str = "taux_pour_mille") -> str:
    return f"""src AS MATERIALIZED (SELECT o_orderkey AS id, train, voix AS y, annee AS x0, voix_prec AS x1, taux_chomage AS x2, taux AS x3, {police} AS x4
  FROM l WHERE {where})"""


def _r2_sql(train: str) -> str:
    return f"(SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 9) FROM scored WHERE {train})"


def _scored_rows(scored):
    """Scored rows of both sides of the split, with the R² of each side."""
    r2_of = lambda side: EV.r2(scored.where(F.col("split") == side), "voix", "pred_voix").select(F.round("r2", 9)).scalar()
    return scored.where("split = 'test'").select("o_orderkey", "split", "voix", F.round("pred_voix", 4).alias("pred_voix"),
                                                 r2_of("train").alias("r2_train"), r2_of("test").alias("r2_test"))


@query("booster_nulls", "M6 M7 M10", f"""
WITH {_LAGGED_SQL}, {_source_sql()}, {booster_sql("src", 5, 1, 4, 1.0, 32)},
scored AS (SELECT o_orderkey, train, voix AS y, score AS p FROM l JOIN boosted ON id = o_orderkey)
SELECT o_orderkey, y AS voix, round(p, 4) AS pred_voix, {_r2_sql("NOT train")} AS r2_test FROM scored WHERE NOT train""")
def booster_nulls(spark, d):
    """One regression tree on the features as they are, missing values
    (first rows, regions without lines) routed as learnt."""
    f = hash_split_op(_feature_table(spark, d), ["o_orderkey"])
    model = BO.fit_booster(f.where("split = 'train'"), FEATURES, "voix", rounds=1, depth=4, rate=1.0, bins=32)
    scored = cut_lineage(BO.booster_predict(model, f).select("o_orderkey", "split", "voix", "pred_voix"), name="scored")
    return _scored_rows(scored).select("o_orderkey", "voix", "pred_voix", "r2_test")


def _booster_frame(features):
    """Rows without a previous vote are dropped and gaps of the crime columns
    filled with their mean, as the reference's preparation does; other
    missing indicators are left to the learner."""
    f = fill_global_mean(features.where(F.col("voix_prec").isNotNull()), ["taux_pour_mille"])
    return hash_split_op(f, ["o_orderkey"])


@query("gbt_predict", "M6 M7 M1 M9 M10 W1 Q4", f"""
WITH {_LAGGED_SQL}, {_source_sql("voix_prec IS NOT NULL", "coalesce(taux_pour_mille, avg(taux_pour_mille) OVER ())")}, {booster_sql(
    "src", 5, BOOSTING["rounds"], BOOSTING["depth"], BOOSTING["rate"], BOOSTING["bins"])},
scored AS (SELECT src.id, train, y, greatest(score, 0) AS p FROM src JOIN boosted USING (id))
SELECT id AS o_orderkey, 'test' AS split, y AS voix, round(p, 4) AS pred_voix, {_r2_sql("train")} AS r2_train, {_r2_sql("NOT train")} AS r2_test
FROM scored WHERE NOT train""")
def gbt_predict(spark, d):
    df = _booster_frame(_feature_table(spark, d))
    model = BO.fit_booster(df.where("split = 'train'"), FEATURES, "voix", **BOOSTING)
    return _scored_rows(cut_lineage(BO.booster_predict(model, df, floor=0.0).select("o_orderkey", "split", "voix", "pred_voix"), name="scored"))


# The forest draws rows by partition: its predictions have no SQL twin.
@query("forest_predict", "M22 M7 M10")
def forest_predict(spark, d):
    df = _training_frame(_feature_table(spark, d))
    model = MD.train_model(df.where("split = 'train'"), FEATURES, "voix", kind="forest", max_depth=4, num_trees=20)
    return _scored_rows(cut_lineage(MD.predict(model, df, floor=0.0).select("o_orderkey", "split", "voix", "pred_voix"), name="scored"))


def projected_votes(spark, d):
    """Train on the training rows, score the 2027/2032 scenario rows (the
    latest row of each candidate with its stored lag, as the election job
    does), clip at 0: one row per candidate, region and year."""
    features = _feature_table(spark, d)
    df = _booster_frame(features)
    model = BO.fit_booster(df.where("split = 'train'"), FEATURES, "voix", **BOOSTING)
    latest = latest_row(features, ["code_region", "nom"], "annee", ties=["o_orderkey"])
    fut = MD.scenario_frame(latest, features, "annee", INDICATORS)
    # A candidate's first row has no lag: the training rows' mean stands in.
    fut = fill_global_mean(fut, ["voix_prec"], source=df)
    return cut_lineage(BO.booster_predict(model, fut, floor=0.0), name="projection")


@query("vote_projection", "M7 M8 M19 R8", f"""
WITH {_LAGGED_SQL}, {C.CATEGORY_MAP_SQL},
lr AS (SELECT *, row_number() OVER (PARTITION BY code_region, nom ORDER BY annee DESC, o_orderkey) AS rn FROM l),
mm AS (SELECT avg(taux_chomage) AS c, avg(taux) AS p, avg(taux_pour_mille) AS k FROM l WHERE annee = (SELECT max(annee) FROM l)),
fr AS MATERIALIZED (SELECT -row_number() OVER (ORDER BY lr.code_region, lr.nom, y.annee) AS id, y.annee, coalesce(cm.categorie, 'Autres') AS categorie,
  coalesce(voix_prec, (SELECT avg(voix_prec) FROM l)) AS lag, mm.c * y.fc AS c, mm.p * y.fp AS p, mm.k * y.fk AS k
  FROM lr LEFT JOIN catmap cm ON upper(trim(lr.nom)) = cm.nom, mm, (VALUES (2027, 1.0, 1.0, 1.0), (2032, 1.5, 0.5, 2.0)) AS y(annee, fc, fp, fk) WHERE rn = 1),
src AS MATERIALIZED (
  SELECT o_orderkey AS id, train, voix AS y, annee AS x0, voix_prec AS x1, taux_chomage AS x2, taux AS x3,
         coalesce(taux_pour_mille, avg(taux_pour_mille) OVER ()) AS x4 FROM l WHERE voix_prec IS NOT NULL
  UNION ALL SELECT id, false, NULL, annee, lag, c, p, k FROM fr),
{booster_sql("src", 5, BOOSTING["rounds"], BOOSTING["depth"], BOOSTING["rate"], BOOSTING["bins"])}
SELECT CAST(y.annee AS INTEGER) AS annee, cat.categorie, round(coalesce(sum(greatest(score, 0)), 0), 3) AS total, count(score) AS n_candidates
FROM (VALUES (2027), (2032)) AS y(annee) CROSS JOIN (VALUES {", ".join("(" + C.sql_str(x) + ")" for x in C.CATEGORIES)}) AS cat(categorie)
LEFT JOIN (SELECT fr.annee, fr.categorie, score FROM fr JOIN boosted USING (id)) AS z USING (annee, categorie) GROUP BY 1, 2""")
def vote_projection(spark, d):
    """Predicted votes per scenario year and category, 0 where a category has
    no candidate, with the number of candidates."""
    preds = projected_votes(spark, d)
    totals = R.unpivot(MD.national_totals(preds, "annee", "categorie", "pred_voix", C.CATEGORIES), C.CATEGORIES, ["annee"],
                       "categorie", "total")
    n = preds.groupBy("annee", "categorie").agg(F.count(F.lit(1)).alias("n_candidates"))
    j = totals.join(n, ["annee", "categorie"], "left").fillna(0, subset=["n_candidates"])
    return j.select("annee", "categorie", F.round("total", 3).alias("total"), "n_candidates")


def _scored(spark, d):
    v = C.categorised_votes(spark, d)
    return v.withColumn("pred_voix", F.col("voix") * 0.5 * (F.col("o_orderkey") % 5))


SCORED_SQL = f"""{C.CAT_VOTES_SQL},
p AS (SELECT *, voix * 0.5 * (o_orderkey % 5) AS pred_voix FROM catvotes)"""


@query("r2_score", "M10", f"""
WITH {SCORED_SQL}
SELECT round(1 - sum((voix - pred_voix) * (voix - pred_voix)) / (var_pop(voix) * count(*)), 9) AS r2 FROM p""")
def r2_score(spark, d):
    return EV.r2(_scored(spark, d), "voix", "pred_voix").select(F.round("r2", 9).alias("r2"))


@query("mae_score", "M21", f"""
WITH {SCORED_SQL}
SELECT round(avg(abs(voix - pred_voix)), 6) AS mae FROM p""")
def mae_score(spark, d):
    return EV.mae(_scored(spark, d), "voix", "pred_voix").select(F.round("mae", 6).alias("mae"))


@query("class_metrics", "M11 M12 J5", f"""
WITH {SCORED_SQL},
g AS (SELECT annee, code_region, categorie, sum(voix) AS voix, sum(pred_voix) AS pred FROM p GROUP BY 1, 2, 3),
t AS (SELECT annee, code_region, categorie AS ct FROM (SELECT *, row_number() OVER (
        PARTITION BY annee, code_region ORDER BY voix DESC, categorie) AS rn FROM g) WHERE rn = 1),
q AS (SELECT annee, code_region, categorie AS cp FROM (SELECT *, row_number() OVER (
        PARTITION BY annee, code_region ORDER BY pred DESC, categorie) AS rn FROM g) WHERE rn = 1),
pairs AS (SELECT t.ct, q.cp FROM t JOIN q ON t.annee = q.annee AND t.code_region = q.code_region),
tc AS (SELECT ct AS label, count(*) AS support, count_if(ct = cp) AS tp FROM pairs GROUP BY 1),
pc AS (SELECT cp AS label, count(*) AS predicted FROM pairs GROUP BY 1),
x AS (SELECT tc.*, CASE WHEN coalesce(pc.predicted, 0) > 0 THEN tp / pc.predicted ELSE 0 END AS prec,
             tp / support AS rec FROM tc LEFT JOIN pc ON tc.label = pc.label)
SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(sum(prec * support) / sum(support), 9) AS precision,
       round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END * support)
             / sum(support), 9) AS f1,
       CAST(sum(support) AS BIGINT) AS n
FROM x""")
def class_metrics(spark, d):
    pairs = EV.majority_labels(_scored(spark, d), ["annee", "code_region"], "categorie", "voix", "pred_voix")
    m = EV.class_metrics(pairs, "categorie_true", "categorie_pred")
    return m.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "f1")], "n")


@query("hash_split", "M1", """
SELECT o_orderkey, CASE WHEN CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|#42'), 1, 8)) AS BIGINT) % 100 < 80
                   THEN 'train' ELSE 'test' END AS split
FROM orders""")
def hash_split(spark, d):
    return hash_split_op(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@query("robust_scale", "M2", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderkey, round((o_totalprice - q2) / CASE WHEN q3 - q1 = 0 THEN 1 ELSE q3 - q1 END, 9) AS scaled
FROM orders, q""")
def robust_scale(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    s = robust_scale_op(o, ["o_totalprice"])
    return s.select("o_orderkey", F.round("o_totalprice_scaled", 9).alias("scaled"))


def _daily_counts(spark, d):
    e = table(spark, d, "events").select("ts", "event_type")
    return e.groupBy("event_type", F.dayofmonth("ts").alias("day_idx")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def arima_sql(src: str, steps: int = 4) -> str:
    """SQL twin of ``arima_forecast`` over CTE ``src(s, p, y)``: the
    recursion runs over the differences for every point of the grid."""
    grid = f"range({TR.ARIMA_GRID.start}, {TR.ARIMA_GRID.stop}, {TR.ARIMA_GRID.step})"
    levels = "\nUNION ALL ".join(
        f"SELECT s, {h} AS step, level + " + " + ".join(["m", *["m" + " * phi" * k for k in range(1, h)]])
        + " AS forecast FROM fin" for h in range(1, steps + 1))
    return f"""
ad AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY p) - 1 AS t, y - lag(y) OVER (PARTITION BY s ORDER BY p) AS d,
              count(*) OVER (PARTITION BY s) AS n FROM {src}),
al AS (SELECT s, arg_max(y, p) AS level, count(*) AS n FROM {src} GROUP BY s),
ag AS (SELECT a / 100.0::DOUBLE AS phi, b / 100.0::DOUBLE AS theta FROM (SELECT unnest({grid}) AS a), (SELECT unnest({grid}) AS b)),
ar(s, t, n, phi, theta, d, e, ss) AS (
  SELECT s, t, n, phi, theta, d, 0.0::DOUBLE, 0.0::DOUBLE FROM ad, ag WHERE t = 1 AND n >= 3
  UNION ALL
  SELECT ar.s, ad.t, ar.n, phi, theta, ad.d, ad.d - phi * ar.d - theta * ar.e,
         ar.ss + (ad.d - phi * ar.d - theta * ar.e) * (ad.d - phi * ar.d - theta * ar.e)
  FROM ar JOIN ad ON ad.s = ar.s AND ad.t = ar.t + 1),
ab AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY ss, phi, theta) AS rk FROM ar WHERE t = n - 1),
fin AS (SELECT al.s, level, phi, phi * d + theta * e AS m FROM al LEFT JOIN ab ON ab.s = al.s AND ab.rk = 1),
af AS ({levels})"""


_DAILY_SQL = """daily AS (SELECT event_type AS s, CAST(dayofmonth(ts) AS INTEGER) AS p, CAST(count(*) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2)"""


@query("arima_forecast", "M5", f"""
WITH RECURSIVE {_DAILY_SQL},{arima_sql("daily")}
SELECT s AS event_type, CAST(step AS INTEGER) AS step, CAST((SELECT max(p) FROM daily) + step AS INTEGER) AS day_idx,
       round(forecast, 6) AS forecast FROM af""")
def arima_forecast(spark, d):
    return TR.arima_forecast(_daily_counts(spark, d), "event_type", "day_idx", "n", steps=4) \
        .withColumn("forecast", F.round("forecast", 6))


@query("model_forecasts", "M17 M4 M3 M5 Q5", f"""
WITH RECURSIVE {_DAILY_SQL},
kept AS (SELECT * FROM daily WHERE s IN (SELECT s FROM daily GROUP BY s HAVING count(*) >= 3)),
h AS (SELECT (SELECT max(p) FROM kept) + h AS t FROM (SELECT unnest(range(1, 5)) AS h)),
lf AS (SELECT s, avg(y) AS yb, avg(p) AS xb, regr_slope(y, p) AS b FROM kept GROUP BY s),
""" + quad_sql("kept", "s", "p", "y", "SELECT t FROM h").lstrip() + f""",{arima_sql("kept")}
SELECT s AS event_type, 'linear' AS model, CAST(t AS INTEGER) AS day_idx, round(yb + b * (t - xb), 6) AS value FROM lf, h
UNION ALL SELECT s, 'quadratic', CAST(annee AS INTEGER), round(pred, 6) FROM qpred
UNION ALL SELECT s, 'arima', CAST((SELECT max(p) FROM kept) + step AS INTEGER), round(forecast, 6) FROM af""")
def model_forecasts(spark, d):
    """Per indicator: linear, quadratic and ARIMA forecasts of the next 4
    periods, for series with at least 3 points, as one long table."""
    s = cut_lineage(with_min_history(cut_lineage(_daily_counts(spark, d), name="daily"), ["event_type"], "n", 3), name="daily")
    last = s.agg(F.max("day_idx")).scalar()
    ahead = F.explode(F.array(*[last + F.lit(h) for h in range(1, 5)]))
    lin = TR.linear_fit(s, ["event_type"], "day_idx", "n").withColumn("day_idx", ahead)
    lin = lin.select("event_type", F.lit("linear").alias("model"), "day_idx", TR.linear_eval("day_idx").alias("value"))
    quad = TR.quadratic_fit(s, ["event_type"], "day_idx", "n").withColumn("day_idx", ahead)
    quad = quad.select("event_type", F.lit("quadratic").alias("model"), "day_idx",
                       TR.quadratic_eval(F.col("day_idx").cast("double")).alias("value"))
    ar = TR.arima_forecast(s, "event_type", "day_idx", "n", steps=4) \
           .select("event_type", F.lit("arima").alias("model"), "day_idx", F.col("forecast").alias("value"))
    return lin.unionByName(quad).unionByName(ar).withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------------------
# Projections of a share and of a change series.
# ---------------------------------------------------------------------------



def _right_share(spark, d):
    """Share of the lines' value under right-wing names, per year, from one
    aggregate per (year, name)."""
    per = group_sums(_line_parts(spark, d), ["annee", "p_name"], {"v": "l_extendedprice"})
    right = F.coalesce(F.sum(F.when(contains_any("p_name", RIGHT_KEYWORDS), F.col("v"))), F.lit(0.0))
    return cut_lineage(per.groupBy("annee").agg((right * 100 / F.sum("v")).alias("v"))
                       .select(F.lit("RN").alias("s"), "annee", "v"), name="right-share")


@query("right_projection", "M15 M18 M4 M3", f"""
WITH {LINE_PARTS_SQL},
y AS (SELECT 'RN' AS s, annee, 100 * coalesce(sum(CASE WHEN regexp_matches(p_name, '{C.sql_pattern(RIGHT_KEYWORDS)}')
                                   THEN l_extendedprice END), 0) / sum(l_extendedprice) AS v FROM lp GROUP BY annee),
lin AS (SELECT 'linear' AS model, 2002 AS annee, avg(v) + regr_slope(v, annee) * (2002 - avg(annee)) AS pred FROM y),
""" + quad_sql("y", "s", "annee", "v", [2002]).lstrip() + """
SELECT model, annee, round(least(greatest(pred, 10), 60), 6) AS pred FROM lin
UNION ALL SELECT 'quadratic', annee, round(least(greatest(pred, 10), 60), 6) FROM qpred""")
def right_projection(spark, d):
    """Right-wing share of each year, projected one period ahead by a line
    and by a parabola, both bounded to [10, 60] percent."""
    y = _right_share(spark, d)
    lin = TR.linear_predict(TR.linear_fit(y, ["s"], "annee", "v"), [2002]).select(F.lit("linear").alias("model"), "annee", "pred")
    quad = TR.quadratic_predict(TR.quadratic_fit(y, ["s"], "annee", "v"), [2002]) \
             .select(F.lit("quadratic").alias("model"), "annee", "pred")
    both = TR.bounded(lin.unionByName(quad), "pred", 10, 60)
    return both.select("model", "annee", F.round("pred", 6).alias("pred"))


@query("crime_trend", "W5 M16 M4", """
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
ch AS (SELECT s, p, f / nullif(lag(f) OVER (PARTITION BY s ORDER BY p), 0) - 1 AS c FROM ff),
evo AS (SELECT dayofmonth(p) AS x, 100 * coalesce(avg(c), 0) AS y FROM ch GROUP BY p)
SELECT CAST(count(*) AS BIGINT) AS n_days, 31 AS day_idx,
       round(avg(y) + regr_slope(y, x) * (31 - avg(x)), 6) AS pred FROM evo""")
def crime_trend(spark, d):
    """Mean period-on-period change of the indicator series (percent),
    extrapolated linearly to the next period (needs at least 2 points)."""
    evo = pct_change_mean(_event_gaps(spark, d), "event_type", "day", "value")
    pts = evo.select(F.lit("all").alias("s"), F.dayofmonth("day").alias("x"), (F.col("evolution") * 100).alias("y"))
    fit = TR.linear_fit(pts, ["s"], "x", "y")
    p = TR.linear_predict(fit.where(F.col("n") >= 2), [31], col="day_idx")
    return p.select(F.col("n").alias("n_days"), "day_idx", F.round("pred", 6).alias("pred"))
