"""The election job end to end: lake → warehouse → features → model →
2027/2032 projection (SURVEY §3.1 + §3.2), as Spark plans.

``load_lake`` lands and harmonises the raw files; ``model_job`` builds the
feature table, trains and evaluates the vote model and projects future
years.  Column names and keys are parameters; the defaults describe the
shipped file layouts.  Heavy results are written to the warehouse (shared
storage), which also cuts lineage between the two halves.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.functions.numbers import clip, fill_sentinel, to_number
from civica.functions.text import light_header, normalise_name
from civica.operators import columns as P
from civica.operators import evaluate as EV
from civica.operators import model as MD
from civica.operators import reshape as R
from civica.operators import rows as RW
from civica.operators.aggregates import fill_global_mean
from civica.operators.features import hash_split
from civica.operators.joins import left_join, lookup_with_default
from civica.operators.quality import Profiles, range_check
from civica.operators.windows import group_mean_fill, lag_within, latest_row
from civica.sources import lake as L
from civica.sources import warehouse as W

# Political category of each candidate surname (lookup J6);
# unknown names fall into "Autres".  One key misspelt in the source data
# set ("PECRESSSE") is spelt "PECRESSE" here.
CANDIDATE_CATEGORY = {
    "CHIRAC": "Droite", "LE PEN": "Extrême droite", "JOSPIN": "Gauche", "SAINT-JOSSE": "Extrême droite",
    "LAGUILLER": "Extrême gauche", "HUE": "Gauche", "TAUBIRA": "Gauche", "BAYROU": "Centre",
    "CHEVENEMENT": "Centre", "MEGRET": "Extrême droite", "LEPAGE": "Centre", "MADELIN": "Droite",
    "BOUTIN": "Droite", "GLUCKSTEIN": "Extrême gauche", "MAMERE": "Gauche", "SARKOZY": "Droite",
    "ROYAL": "Gauche", "BESANCENOT": "Extrême gauche", "BUFFET": "Gauche", "VOYNET": "Gauche",
    "DE VILLIERS": "Droite", "NIHOUS": "Extrême droite", "SCHIVARDI": "Extrême gauche",
    "HOLLANDE": "Gauche", "MELENCHON": "Gauche", "JOLY": "Gauche", "DUPONT-AIGNAN": "Droite",
    "POUTOU": "Extrême gauche", "ARTHAUD": "Extrême gauche", "CHEMINADE": "Extrême gauche",
    "MACRON": "Centre", "FILLON": "Droite", "HAMON": "Gauche", "LASSALLE": "Centre",
    "ASSELINEAU": "Centre", "ZEMMOUR": "Extrême droite", "PECRESSE": "Droite", "JADOT": "Gauche",
    "HIDALGO": "Gauche", "ROUSSEL": "Gauche",
}
# The six categories of the national view, in display order.
CATEGORIES = ["Extrême gauche", "Gauche", "Centre", "Droite", "Extrême droite", "Autres"]

# Party keyword lists of the share analysis (2017/2022 version).
PARTY_KEYWORDS = {
    "RN": ["LE PEN", "MARINE", "RN", "RASSEMBLEMENT", "NATIONAL"],
    "LREM": ["MACRON", "EMMANUEL", "LREM", "PRESIDENT", "RENAISSANCE", "ENSEMBLE"],
    "LR": ["LES REPUBLICAINS", "REPUBLICAIN", "LR", "PECRESSE", "CIOTTI", "SARKOZY", "FILLON"],
    "LFI": ["MELENCHON", "JEAN-LUC", "LFI", "FRANCE INSOMISE"],
    "PS": ["PS", "SOCIALISTE", "HAMON", "HOLLANDE", "HIDALGO"],
    "ECOLO": ["JADOT", "ECOLOGIE", "VERT", "EELV"],
    "REC": ["DUPONT-AIGNAN", "DUPONTAIGNAN", "RECONQUETE", "ZEMMOUR", "DUPONT AIGNAN"],
    "PCF": ["ROUSSEL", "COMMUNISTE", "PCF"],
    "LO": ["ARTHAUD", "LUTTE OUVRIERE"],
    "AUTRES": [],
}
# Party keyword lists of the vote-count analysis (2002-2022 version).
PARTY_KEYWORDS_HISTORY = {
    "RN": ["LE PEN", "MARINE", "RN", "RASSEMBLEMENT", "NATIONAL", "FN"],
    "LREM": ["MACRON", "EMMANUEL", "LREM", "PRESIDENT", "RENAISSANCE", "ENSEMBLE"],
    "LR": ["LES REPUBLICAINS", "REPUBLICAIN", "LR", "PECRESSE", "CIOTTI", "SARKOZY", "FILLON", "CHIRAC", "RPR", "UMP"],
    "LFI": ["MELENCHON", "JEAN-LUC", "LFI", "FRANCE INSOMISE", "FG"],
    "PS": ["PS", "SOCIALISTE", "HAMON", "HOLLANDE", "HIDALGO", "JOSPIN", "ROYAL"],
    "ECOLO": ["JADOT", "ECOLOGIE", "VERT", "EELV", "MAMERE", "VOYNET", "JOLY"],
    "REC": ["DUPONT-AIGNAN", "DUPONTAIGNAN", "RECONQUETE", "ZEMMOUR", "DUPONT AIGNAN", "DE VILLIERS", "MPF"],
    "PCF": ["ROUSSEL", "COMMUNISTE", "PCF", "HUE", "BUFFET"],
    "LO": ["ARTHAUD", "LUTTE OUVRIERE", "LAGUILLER"],
    "CENTRE": ["BAYROU", "UDF", "MODEM"],
    "AUTRES": [],
}
# Keywords of the right-wing vote share.
RIGHT_KEYWORDS = ["LE PEN", "RN", "RASSEMBLEMENT NATIONAL"]
# Upper bounds of predicted party shares (percent); others 50.
PARTY_CAPS = {"RN": 60.0, "LFI": 50.0, "PS": 20.0}
# Bounds of projections (vote counts; percent of the RN projection).
VOTES_CAP = (0.0, 120000.0)
SHARE_BOUNDS = (10.0, 60.0)
# Expressed votes per election year and first-round shares
# (percent) of the literal vote table.
EXPECTED_EXPRIMES = {2002: 115000, 2007: 112000, 2012: 111000, 2017: 110000, 2022: 108000}
LITERAL_PERCENTAGES = {
    2002: {"CHIRAC": 22.0, "LE PEN": 15.0, "JOSPIN": 16.0, "BAYROU": 7.0, "LAGUILLER": 5.0,
           "CHEVENEMENT": 5.0, "MAMERE": 5.0, "BESANCENOT": 4.0, "HUE": 4.0},
    2007: {"SARKOZY": 27.0, "ROYAL": 25.0, "BAYROU": 18.0, "LE PEN": 10.0, "BESANCENOT": 4.0,
           "BUFFET": 2.0, "VOYNET": 2.0, "DE VILLIERS": 2.0, "LAGUILLER": 1.0},
    2012: {"HOLLANDE": 28.0, "SARKOZY": 25.0, "LE PEN": 15.0, "MELENCHON": 12.0, "BAYROU": 9.0,
           "JOLY": 3.0, "DUPONTAIGNAN": 2.0, "POUTOU": 1.0, "ARTHAUD": 1.0},
    2017: {"MACRON": 25.0, "LE PEN": 18.0, "MELENCHON": 22.0, "FILLON": 18.0, "HAMON": 8.0,
           "DUPONTAIGNAN": 4.5, "LASSALLE": 4.0, "POUTOU": 1.0, "ARTHAUD": 0.6, "ASSELINEAU": 0.9,
           "CHEMINADE": 0.2},
    2022: {"MACRON": 28.0, "LE PEN": 23.0, "MELENCHON": 22.0, "ZEMMOUR": 5.0, "PECRESSE": 4.0,
           "JADOT": 4.0, "HIDALGO": 2.0, "ROUSSEL": 2.0, "ARTHAUD": 1.0, "LASSALLE": 3.0, "POUTOU": 1.0,
           "DUPONTAIGNAN": 5.0},
}

# The headers of a candidate block in result files.
CANDIDATE_BLOCK = ["Sexe", "Nom", "Prénom", "Voix", "% Voix/Ins", "% Voix/Exp"]
# Fixed value: columns before the first block of the positional layout.
COMMON_COLUMNS = 17
ELECTION_FILE = re.compile(r"^Presidentielle-(\d{4})-T(\d)\.csv$", re.IGNORECASE)
CANDIDATE_FIELDS = ["nom", "prenom", "sexe", "voix"]


@dataclass
class LakeConfig:
    """Where files are and which rows to keep (all parameters)."""
    raw_dir: str
    database: str
    out_dir: str | None = None
    department_prefix: str = "13"          # F1 on the stringified code
    unemployment_area: str | None = None   # F1 on `departement`; None keeps all
    election_sep: str = ","
    police_file: str = "statistiques_police.csv"
    chomage_file: str = "chomage.csv"
    pauvrete_file: str = "pauvrete.csv"
    behaviour_file: str = "comportements_vote.csv"
    behaviour_semicolon_files: Sequence[str] = ("comportement_votes_metier.csv", "comportement_votes_lieu.csv")
    # Result files of the two other layouts, by name, with their year.
    numbered_files: Mapping[str, int] = field(default_factory=lambda: {"presidentielle2017.csv": 2017})
    block_files: Mapping[str, int] = field(default_factory=lambda: {"resultats-niveau-reg.csv": 2022})
    region_code: str = "32"                # code of the rows that these files keep


def _file(files: dict[str, str], name: str) -> str | None:
    return files.get(name.lower())


def load_elections(spark: SparkSession, cfg: LakeConfig, files: dict[str, str]) -> dict[int, DataFrame]:
    """Yearly result files → harmonised tables per round (union of years
    with differing columns, U2)."""
    rounds: dict[int, list[DataFrame]] = {}
    for name, path in sorted(files.items()):
        m = ELECTION_FILE.match(name.rsplit("/", 1)[-1])
        if not m:
            continue
        year, tour = int(m.group(1)), int(m.group(2))
        df = P.harmonise(L.read_repeated_blocks(spark, path, cfg.election_sep))
        df = P.parse_decimal_columns(df, ("pourcentage", "taux"))
        df = RW.prefix_filter(df, "code_region", cfg.department_prefix)
        rounds.setdefault(tour, []).append(df.withColumn("annee", F.lit(year)).withColumn("tour", F.lit(tour)))
    return {t: RW.union_missing(dfs) for t, dfs in rounds.items()}


def _candidate_table(long: DataFrame, year: int, code: str | None) -> DataFrame:
    """P8 + P1/P4/P5 + C1/C2/C5 on candidate rows: standard names, numbers,
    the year; rows of one code if one is given (an unreadable code is -1)."""
    long, missing = P.standardise_year(long, year)
    if missing:
        logging.getLogger("civica").warning("year %s lacks the columns %s", year, missing)
    long = P.parse_decimal_columns(P.harmonise(long), ("pourcentage", "taux", "%"))
    long = long.withColumns({c: f for c, f in (
        ("voix", to_number("voix")), ("code_region", fill_sentinel(to_number("code_region", "bigint"), -1))) if c in long.columns})
    if code is not None and "code_region" in long.columns:
        long = long.where(F.col("code_region") == int(code))
    return long.withColumn("annee", F.lit(year))


def numbered_rows(spark: SparkSession, path: str, year: int, code: str | None = None, sep: str = ",",
                  encoding: str = "UTF-8") -> DataFrame:
    """P6 + R3: a results file whose candidate blocks are numbered
    (``Nom.1, Voix.1 …``) as one row per candidate.  A block without a
    number comes first, as number 0; panel numbers are dropped."""
    df = P.light_headers(L.read_repeated_blocks(spark, path, sep, encoding))
    fields = [f for f in CANDIDATE_BLOCK if any(c.startswith(f + ".") for c in df.columns)]
    first = {f: f"{f}.0" for f in [*fields, "N°Panneau"] if f in df.columns}
    if all(f in first for f in fields):
        df = df.withColumnsRenamed(first)
        order = [c for c in df.columns if not c.endswith(".0")]
        df = df.select(*[F.col(f"`{c}`") for c in [*[c for c in df.columns if c.endswith(".0")], *order]])
    return _candidate_table(R.long_by_detect(df, fields), year, code)


def block_rows(spark: SparkSession, path: str, year: int, code: str | None = None, sep: str = ",",
               encoding: str = "UTF-8", common: int = COMMON_COLUMNS) -> DataFrame:
    """P7 + R2: a results file whose candidate blocks repeat the same headers
    by position after ``common`` columns, as one row per candidate."""
    df = L.read_repeated_blocks(spark, path, sep, encoding)
    names = [light_header(c) for c in df.columns[:common]]
    return _candidate_table(P.drop_unnamed(R.long_by_block(df, common, CANDIDATE_BLOCK, common_names=names)), year, code)


def load_lake(spark: SparkSession, cfg: LakeConfig) -> dict[str, str]:
    """§3.1: every CSV of the landing folder → cleaned warehouse tables
    (replaced) and, if ``out_dir`` is set, processed CSV copies (K1)."""
    W.ensure_database(spark, cfg.database)
    files = {p.rsplit("/", 1)[-1].lower(): p for p in L.list_files(spark, cfg.raw_dir)}
    written = {}

    def save(df: DataFrame, table_name: str, partition_by: Sequence[str] = ()):
        t = f"`{cfg.database}`.`{L.table_name(table_name)}`"
        W.replace_table(df, t, partition_by)
        if cfg.out_dir:
            L.write_delimited(spark.table(t), f"{cfg.out_dir}/{L.table_name(table_name)}_processed")
        written[table_name] = t

    candidates = [load(spark, p, year, cfg.region_code, cfg.election_sep)
                  for load, group in ((numbered_rows, cfg.numbered_files), (block_rows, cfg.block_files))
                  for name, year in group.items() if (p := _file(files, name))]
    if candidates:
        save(RW.union_missing(candidates), "candidats_long", ["annee"])
    for tour, df in load_elections(spark, cfg, files).items():
        save(df, f"election_tour_{tour}", ["annee"])          # year-range scans prune partitions
    if p := _file(files, cfg.police_file):
        pol = P.rename_headers(L.read_delimited(spark, p, ";"), lambda c: c.replace("\xa0", " ").strip().lower())
        pol = pol.withColumns({"taux_pour_mille": F.replace(F.col("taux_pour_mille"), F.lit(","), F.lit("."))
                               .try_cast("double")} if "taux_pour_mille" in pol.columns else {})
        pol = RW.prefix_filter(pol, "code_departement", cfg.department_prefix)
        save(pol.withColumn("annee", to_number("annee", "int")), "statistiques_police", ["annee"])
    if p := _file(files, cfg.chomage_file):
        ch = P.drop_unnamed(P.light_headers(L.read_delimited(spark, p, ";")))
        if cfg.unemployment_area:
            ch = RW.prefix_filter(ch, "departement", cfg.unemployment_area)
        quarters = [c for c in ch.columns if c != "departement"]
        save(R.unpivot_quarters(ch, quarters, ids=["departement"], value_col="taux_chomage"), "chomage")
    if p := _file(files, cfg.pauvrete_file):
        pv = L.read_delimited(spark, p, ",")
        save(pv.select(to_number("annee", "int").alias("annee"), to_number("taux").alias("taux")), "pauvrete")
    if p := _file(files, cfg.behaviour_file):
        good, bad = L.repair_decimal_commas(spark, p, lead_fields=2)
        save(good, "comportements_vote")
        save(bad, "comportements_vote_rejects")
    for f in cfg.behaviour_semicolon_files:
        if p := _file(files, f):
            save(P.light_headers(L.read_delimited(spark, p, ";")), f.rsplit(".", 1)[0])
    return written


# ---------------------------------------------------------------------------
# Model job (§3.2)
# ---------------------------------------------------------------------------

@dataclass
class ModelConfig:
    database: str
    years: tuple[int, int] = (2002, 2022)
    top_n: int = 20
    quarter_mode: str = "mean"             # "mean" (one row per year) or "fanout" (×4, as the reference)
    police_na: str = "fill"                # "any" (reference: drop rows), "all", or "fill" (mean-fill)
    police_key: str = "code_departement"   # joined to the election `code_region` (which holds the département)
    max_iter: int = 300
    max_depth: int = 5
    future_years: Sequence[int] = (2027, 2032)
    scenarios: dict = field(default_factory=lambda: dict(MD.SCENARIOS))
    predictions_path: str | None = None


def election_long(spark: SparkSession, cfg: ModelConfig) -> DataFrame:
    """S5 + R1 + J6: candidate rows of the first round, with category."""
    e = W.scan_years(spark.table(f"`{cfg.database}`.election_tour_1"), "annee", *cfg.years)
    ids = [c for c in ("annee", "code_region", "code_commune", "code_b_vote") if c in e.columns]
    long = R.long_by_suffix(e, ids, CANDIDATE_FIELDS, required=["nom", "voix"], index_col="candidat_index")
    long = long.withColumn("code_region", to_number("code_region", "bigint")) \
               .withColumn("voix", to_number("voix"))
    return lookup_with_default(long, "nom", CANDIDATE_CATEGORY, out="categorie", default="Autres")


def feature_frame(spark: SparkSession, cfg: ModelConfig) -> tuple[DataFrame, list[str]]:
    """F6 + W1 + J1-J3 + M9: one row per candidate row with its lag and
    indicators; returns the frame and the police indicator columns."""
    db = cfg.database
    long = election_long(spark, cfg)
    top = RW.top_counts(long, "nom", cfg.top_n)                     # bounded: top_n rows
    long = RW.keep_or_other(long, "nom", top, out="candidat")
    tie = [c for c in ("code_commune", "code_b_vote", "candidat_index", "nom") if c in long.columns]
    # The "AUTRE" bucket of minor candidates is a hot group: the lag is split
    # by (year, first tie column: the commune where there is one), a prefix of
    # the lag order, so no task holds more than one such part of a group.
    split = F.struct("annee", *tie[:1])
    long = lag_within(long, ["code_region", "candidat"], ["annee", *tie], "voix", "groupe_region_candidat_voix",
                      split=split)

    ch = spark.table(f"`{db}`.chomage")
    if cfg.quarter_mode == "fanout":
        long = left_join(long, ch.select("annee", "trimestre", "taux_chomage"), "annee", measure=True)
    else:
        long = left_join(long, ch.groupBy("annee").agg(F.avg("taux_chomage").alias("taux_chomage")), "annee", measure=True)
    long = left_join(long, spark.table(f"`{db}`.pauvrete").select("annee", "taux"), "annee", suffix="_pauvrete",
                     measure=True)

    pol = spark.table(f"`{db}`.statistiques_police")
    indicators = R.pivot_values(pol, "indicateur")                  # bounded by pivotMaxValues
    if indicators:                                                  # no crime rows: no crime features
        piv = R.pivot_mean(pol.withColumn(cfg.police_key, to_number(cfg.police_key, "bigint")),
                           ["annee", cfg.police_key], "indicateur", "taux_pour_mille", indicators)
        if cfg.police_na in ("any", "all"):
            piv = RW.drop_null_rows(piv, indicators, how=cfg.police_na)
        piv = piv.withColumnRenamed(cfg.police_key, "code_region")
        long = left_join(long, piv, ["annee", "code_region"], measure=True)
    long = fill_global_mean(long, ["taux_chomage", "taux", *indicators])
    return RW.drop_null_rows(long, ["groupe_region_candidat_voix"]), indicators


def model_job(spark: SparkSession, cfg: ModelConfig) -> dict:
    """§3.2: features → split → train → evaluate → project future years.

    The feature table is written to the warehouse once and read back: it
    feeds training, scoring, evaluation and the projection, and without a
    cut its lineage would be re-planned (and recomputed) in every branch."""
    feats, indicators = feature_frame(spark, cfg)
    feats_table = f"`{cfg.database}`.features"
    profiles = Profiles()
    W.replace_table(profiles.watch(feats, "features"), feats_table)
    feats = spark.table(feats_table)
    features = ["annee", "groupe_region_candidat_voix", "taux_chomage", "taux", *indicators]
    tie = [c for c in ("code_commune", "code_b_vote", "candidat_index", "nom") if c in feats.columns]
    data = hash_split(feats.withColumn("annee", F.col("annee").cast("double")), ["annee", "code_region", *tie])
    model = MD.train_model(data.where("split = 'train'"), features, "voix", max_iter=cfg.max_iter,
                           max_depth=cfg.max_depth)
    # The model is applied to the feature table once; R² and the majority
    # metrics read the scored table (column-pruned) instead of re-scoring.
    scored_table = f"`{cfg.database}`.scored"
    W.replace_table(profiles.watch(MD.predict(model, data), "scored"), scored_table)
    scored = spark.table(scored_table)
    r2 = EV.r2(scored, "voix", "pred_voix", keys=["split"])
    test = scored.where("split = 'test'")
    pairs = EV.majority_labels(test, ["annee", "code_region"], "categorie", "voix", "pred_voix")
    metrics = EV.class_metrics(pairs, "categorie_true", "categorie_pred")

    # Projection: every known (name, category, region), its latest row.
    cands = RW.distinct_on(feats, ["nom", "categorie", "code_region"])
    latest = latest_row(feats, ["code_region", "candidat"], "annee", ties=tie)
    last = left_join(cands, latest.drop("candidat"), ["nom", "categorie", "code_region"])
    last = group_mean_fill(last, ["nom"], "groupe_region_candidat_voix")
    fut = MD.scenario_frame(last, feats, "annee",
                            {"chomage": ["taux_chomage"], "pauvrete": ["taux"], "police": indicators},
                            scenarios={y: cfg.scenarios.get(y, {}) for y in cfg.future_years})
    # A candidate without a lag gets the training rows' mean.
    fut = fill_global_mean(fut, ["groupe_region_candidat_voix"], source=feats)
    preds = MD.predict(model, fut.withColumn("annee", F.col("annee").cast("double")), floor=0.0) \
              .withColumn("annee", F.col("annee").cast("int"))
    preds = preds.select("annee", "code_region", "nom", "categorie", *features[1:], "pred_voix")
    preds_table = f"`{cfg.database}`.predictions"
    W.replace_table(profiles.watch(preds, "predictions"), preds_table)              # scored once; CSV and totals read the table
    preds = spark.table(preds_table)
    if cfg.predictions_path:
        L.write_delimited(preds, cfg.predictions_path)
    national = MD.national_totals(preds, "annee", "categorie", "pred_voix", CATEGORIES)
    return {"model": model, "scored": scored, "r2": r2, "class_metrics": metrics, "predictions": preds,
            "national": national, "indicators": indicators, "profile": profiles.rows(spark)}


def clip_votes(df: DataFrame, column: str) -> DataFrame:
    """Bound a vote projection."""
    return df.withColumn(column, clip(column, *VOTES_CAP))


# ---------------------------------------------------------------------------
# Party-share, vote-history and right-vote/crime analyses (§3.3, §3.4)
# ---------------------------------------------------------------------------

def _candidate_rows(spark: SparkSession, database: str, years: Sequence[int]) -> DataFrame:
    """Candidate rows of the first round for some years, names normalised
    (X1-X3) for keyword matching."""
    e = spark.table(f"`{database}`.election_tour_1").where(F.col("annee").isin(list(years)))
    long = R.long_by_suffix(e, ["annee"], CANDIDATE_FIELDS, required=["nom", "voix"])
    return long.select("annee", normalise_name("nom").alias("nom"), to_number("voix").alias("voix"))


def party_share_analysis(spark: SparkSession, database: str, years: Sequence[int] = (2017, 2022),
                         future: Sequence[int] = (2027, 2032), percent: bool = False) -> dict:
    """§3.4: party shares per election year (A11 + A12), a quadratic trend
    per party (M3, the residual excluded), caps and floor (M13), shares
    renormalised to 100 with a residual, and the ranking per year (T3).

    ``percent`` takes the percentage column of ``candidats_long`` instead of
    the votes; its yearly sums are checked to lie in 95 to 105 (Q2)."""
    from civica.operators import shares as SH
    from civica.operators import trends as TR
    checks = None
    if percent:
        rows = spark.table(f"`{database}`.candidats_long").where(F.col("annee").isin(list(years))) \
            .select("annee", normalise_name("nom").alias("nom"), F.col("pourcentage_voix_exprimes").alias("voix"))
        checks = range_check(rows, ["annee"], "voix")
    else:
        rows = _candidate_rows(spark, database, years)
    totals = SH.party_totals(rows, ["annee"], "nom", "voix", PARTY_KEYWORDS)
    shares = SH.normalise_shares(totals, ["annee"], "voix")
    fit = TR.quadratic_fit(shares.where(F.col("parti") != "AUTRES"), ["parti"], "annee", "share")
    pred = TR.quadratic_predict(fit, future).select("parti", "annee", "pred")
    capped = SH.apply_caps(pred, "parti", "pred", PARTY_CAPS, 50.0, lo=0.0, floor=1.0)
    final = SH.renormalise_with_residual(capped, ["annee"], "parti", "pred", residual="AUTRES")
    ranking = SH.rank_within(final, ["annee"], "share", ties=["parti"])
    from civica.operators.joins import keyword_match
    unassigned = RW.not_in(rows, "nom", keyword_match(rows, "nom", PARTY_KEYWORDS))
    return {"shares": shares, "predictions": final, "ranking": ranking, "unassigned": unassigned, "range_check": checks}


def literal_vote_history(spark: SparkSession, future: Sequence[int] = (2027, 2032)) -> dict:
    """§3.4 (vote counts): the literal share table → votes (S9, X7) →
    totals per name (A3) → party totals with the history keyword lists
    (A11) → quadratic trend per party, bounded to the vote cap (M14)."""
    from civica.operators import shares as SH
    from civica.operators import trends as TR
    from civica.operators.joins import small_table
    from civica.sources.literal import votes_from_shares
    shares = small_table(spark, [(y, n, p) for y, d in LITERAL_PERCENTAGES.items() for n, p in d.items()],
                         "annee int, nom string, pourcentage double")
    totals = small_table(spark, list(EXPECTED_EXPRIMES.items()), "annee int, exprimes int")
    votes = votes_from_shares(shares, totals, ["annee"]).groupBy("annee", "nom").agg(F.sum("voix").alias("voix"))
    parties = SH.party_totals(votes, ["annee"], "nom", "voix", PARTY_KEYWORDS_HISTORY)
    fit = TR.quadratic_fit(parties.where(F.col("parti") != "AUTRES"), ["parti"], "annee", "voix")
    pred = clip_votes(TR.quadratic_predict(fit, future).select("parti", "annee", "pred"), "pred")
    return {"votes": votes, "parties": parties, "predictions": pred,
            "ranking": SH.rank_within(pred, ["annee"], "pred", ties=["parti"])}


def right_vote_and_crime(spark: SparkSession, database: str, years: Sequence[int] = (2017, 2022),
                         target_year: int = 2027, horizon: int = 4) -> dict:
    """§3.3: right-wing share per year (F7 + A5 + M18) projected by a line
    and a parabola, bounded to ``SHARE_BOUNDS`` (M15); crime indicators
    pivoted by year (R7, F5), their mean change (W5) projected linearly
    (M16), and the per-indicator forecast table (M17)."""
    from civica.operators import shares as SH
    from civica.operators import trends as TR
    from civica.operators.quality import with_min_history
    from civica.operators.windows import pct_change_mean
    rows = _candidate_rows(spark, database, years)
    right = SH.masked_total(rows, ["annee"], "nom", "voix", RIGHT_KEYWORDS, "droite") \
              .join(rows.groupBy("annee").agg(F.sum("voix").alias("total")), "annee") \
              .select(F.lit("droite").alias("s"), "annee", (F.col("droite") * 100 / F.col("total")).alias("votes_droite"))
    lin = TR.linear_predict(TR.linear_fit(right, ["s"], "annee", "votes_droite"), [target_year]) \
            .select(F.lit("linear").alias("model"), "annee", "pred")
    quad = TR.quadratic_predict(TR.quadratic_fit(right, ["s"], "annee", "votes_droite"), [target_year]) \
             .select(F.lit("quadratic").alias("model"), "annee", "pred")
    right_pred = TR.bounded(lin.unionByName(quad), "pred", *SHARE_BOUNDS)

    pol = spark.table(f"`{database}`.statistiques_police") \
               .select(to_number("annee", "int").alias("annee"), "indicateur", "taux_pour_mille")
    indicators = R.pivot_values(pol, "indicateur")
    pivot = RW.drop_all_null_columns(R.pivot_mean(pol, ["annee"], "indicateur", "taux_pour_mille", indicators))
    evolution = pct_change_mean(pol, "indicateur", "annee", "taux_pour_mille") \
        .withColumn("evolution", F.col("evolution") * 100)
    crime_fit = TR.linear_fit(evolution.withColumn("s", F.lit("crimes")), ["s"], "annee", "evolution")
    crime_pred = TR.linear_predict(crime_fit.where(F.col("n") >= 2), [target_year])

    series = with_min_history(pol, ["indicateur"], "taux_pour_mille", 3)
    # The axis that ARIMA numbers its steps on: the last year with a value.
    last = pol.where(F.col("taux_pour_mille").isNotNull()).agg(F.max("annee")).first()[0]
    nxt = [last + h for h in range(1, horizon + 1)] if last is not None else []
    forecasts = None
    if nxt:
        forecasts = TR.linear_predict(TR.linear_fit(series, ["indicateur"], "annee", "taux_pour_mille"), nxt) \
                      .select("indicateur", F.lit("linear").alias("model"), "annee", F.col("pred").alias("value")) \
            .unionByName(TR.quadratic_predict(TR.quadratic_fit(series, ["indicateur"], "annee", "taux_pour_mille"), nxt)
                         .select("indicateur", F.lit("quadratic").alias("model"), "annee", F.col("pred").alias("value"))) \
            .unionByName(TR.arima_forecast(series, "indicateur", "annee", "taux_pour_mille", steps=horizon)
                         .select("indicateur", F.lit("arima").alias("model"), "annee",
                                 F.col("forecast").alias("value")))
    return {"right": right, "right_predictions": right_pred, "crime_pivot": pivot, "evolution": evolution,
            "crime_prediction": crime_pred, "forecasts": forecasts}
