"""The election job end to end on small synthetic lake files that carry
the quirks of real inputs: repeated candidate header blocks, accents,
quoted decimal commas, a BOM, ragged lines, blank trailing headers."""

import math
import os
import random
import uuid

import pytest

from civica.plans import elections as E
from civica.sources import lake as L


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8") as f:
        f.write(("﻿" if bom else "") + text)


CANDS = {2012: ["HOLLANDE", "SARKOZY", "LE PEN", "MÉLENCHON"],
         2017: ["MACRON", "LE PEN", "MÉLENCHON", "FILLON"],
         2022: ["MACRON", "LE PEN", "MÉLENCHON", "ZEMMOUR"]}


def make_lake(root):
    rnd = random.Random(7)
    for year, names in CANDS.items():
        head = ["Code du département", "Libellé du département", "Code de la commune", "Inscrits", "Exprimés",
                "% Abs Ins"]
        for _ in names:
            head += ["Sexe", "Nom", "Prénom", "Voix"]
        lines = [",".join(head)]
        for dep in ("13", "130", "75"):
            for commune in range(1, 7):
                row = [dep, "Dép", str(commune), "1000", "800", f'"{rnd.randint(10, 30)},{rnd.randint(0, 9)}"']
                for n in names:
                    row += ["M", n, "X", str(rnd.randint(50, 400))]
                lines.append(",".join(row))
        _write(f"{root}/Presidentielle-{year}-T1.csv", "\n".join(lines) + "\n")
    pol = ["Code_departement;Code_region;annee;indicateur;unite_de_compte;nombre;taux_pour_mille"]
    for y in (2012, 2017, 2022):
        for ind in ("Homicides", "Vols"):
            pol.append(f"13;93;{y};{ind};Victime;{rnd.randint(10, 90)};0,{rnd.randint(100, 999)}")
    pol.append("75;11;2022;Vols;Victime;5;0,5")
    _write(f"{root}/statistiques_police.csv", "\n".join(pol) + "\n")
    qs = [f"T{q}_{y}" for y in range(2012, 2023) for q in range(1, 5)]
    _write(f"{root}/chomage.csv", "departement;" + ";".join(qs) + ";;;\n13;" +
           ";".join(f"{rnd.uniform(6, 12):.1f}" for _ in qs) + ";1;2;3\n")
    _write(f"{root}/pauvrete.csv", "annee,taux\n" + "\n".join(f"{y},{14 + (y % 3)}.{y % 10}" for y in range(2012, 2023)) + "\n")
    _write(f"{root}/comportements_vote.csv",
           "comportement_de_vote,date,Ensemble,18-29_ans,30-64_ans,65_ans_ou_plus\n"
           "Vote systématique,2002,47,6,31,4,49,1,55,7\n"
           "Vote intermittent,2002,37,17,3,37,2,47,7\n"
           "Abstention,2007,47,2,59,50,2,35,3\n"
           "Bad,2007,1,2\n", bom=True)
    _write(f"{root}/comportement_votes_metier.csv",
           "profession;date;vote_systématique;ensemble\nAgriculteurs;2002;62.6;100.0\n", bom=True)


@pytest.fixture(scope="module")
def lake(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="civica-lake-")
    make_lake(root)
    db = f"civica_test_{uuid.uuid4().hex[:6]}"
    written = E.load_lake(spark, E.LakeConfig(raw_dir=root, database=db, out_dir=f"{root}/processed"))
    return spark, db, written, root


def test_load_lake_tables(lake):
    spark, db, written, root = lake
    e = spark.table(written["election_tour_1"])
    codes = {r[0] for r in e.select("code_region").distinct().collect()}
    assert codes == {"13", "130"}                        # prefix filter keeps 130, drops 75
    assert {"nom", "nom_2", "voix_4", "prenom_3", "annee", "tour"} <= set(e.columns)
    assert dict(e.dtypes)["pourcentage_abstentions_inscrits"] == "double"
    pol = spark.table(written["statistiques_police"])
    assert dict(pol.dtypes)["taux_pour_mille"] == "double" and pol.count() == 6
    ch = spark.table(written["chomage"])
    assert ch.count() == 44 and {"annee", "trimestre", "taux_chomage"} <= set(ch.columns)
    beh = {r["comportement_de_vote"]: r for r in spark.table(written["comportements_vote"]).collect()}
    assert [beh["Vote intermittent"][c] for c in ("Ensemble", "18-29_ans", "30-64_ans", "65_ans_ou_plus")] \
        == [37.0, 17.3, 37.2, 47.7]
    assert [beh["Abstention"][c] for c in ("Ensemble", "18-29_ans", "30-64_ans", "65_ans_ou_plus")] \
        == [47.2, 59.0, 50.2, 35.3]
    assert spark.table(written["comportements_vote_rejects"]).count() == 1
    assert "vote_systématique" in spark.table(written["comportement_votes_metier"]).columns
    assert L.path_exists(spark, f"{root}/processed/election_tour_1_processed")


def test_model_job(lake):
    spark, db, _, root = lake
    out = E.model_job(spark, E.ModelConfig(database=db, max_iter=5, max_depth=3,
                                           predictions_path=f"{root}/predictions"))
    preds = out["predictions"].collect()
    cands = {(r["nom"], r["code_region"]) for r in preds}
    assert {r["annee"] for r in preds} == {2027, 2032}
    assert len(preds) == 2 * len(cands)
    assert all(r["pred_voix"] >= 0 for r in preds)
    assert {r["categorie"] for r in preds if r["nom"] == "MÉLENCHON"} == {"Gauche"}   # accent folded
    r2 = {r["split"]: r["r2"] for r in out["r2"].collect()}
    assert set(r2) <= {"train", "test"} and "train" in r2
    m = out["class_metrics"].first()
    if m["n"] is not None:
        assert 0 <= m["accuracy"] <= 1 and 0 <= m["f1"] <= 1
    seen = {(r["stage"], r["column_name"]): (r["n_rows"], r["n_null"]) for r in out["profile"].collect()}
    assert {s for s, _ in seen} == {"features", "scored", "predictions"}
    assert seen["predictions", "pred_voix"] == (len(preds), 0)
    assert seen["scored", "voix"][0] == out["scored"].count() == seen["features", "voix"][0]
    nat = out["national"]
    assert nat.columns == ["annee", *E.CATEGORIES]
    assert spark.read.option("header", True).csv(f"{root}/predictions").count() == len(preds)
    # 2032 unemployment scenario factor applied to the 2027 means
    by = {(r["nom"], r["code_region"], r["annee"]): r for r in preds}
    k = next(iter(cands))
    assert math.isclose(by[(*k, 2032)]["taux_chomage"], 1.5 * by[(*k, 2027)]["taux_chomage"], rel_tol=1e-9)


def test_unique_header_names():
    assert L.unique_header_names(["Nom", "Voix", "Nom", "Voix", "", "Nom"]) == \
        ["Nom", "Voix", "Nom_2", "Voix_2", "_c4", "Nom_3"]


def test_route_and_table_name():
    assert L.table_name("Election 2017") == "election_2017"
    assert L.route("Police Stat") == "statistiques_police" and L.route("other") is None


def test_party_share_analysis(lake):
    spark, db, _, _ = lake
    out = E.party_share_analysis(spark, db, years=(2012, 2017, 2022))
    shares = out["shares"].collect()
    for y in (2012, 2017, 2022):
        assert math.isclose(sum(r["share"] for r in shares if r["annee"] == y), 100.0)
    got = {(r["annee"], r["parti"]): r["voix"] for r in shares}
    assert got[(2022, "RN")] > 0 and got[(2022, "LFI")] > 0        # "MÉLENCHON" matched after folding
    preds = out["predictions"].collect()
    for y in (2027, 2032):
        ys = [r for r in preds if r["annee"] == y]
        assert math.isclose(sum(r["share"] for r in ys), 100.0, abs_tol=1e-9)
        assert all(r["pred"] is None or 1.0 <= r["pred"] <= E.PARTY_CAPS.get(r["parti"], 50.0) for r in ys)
    assert {r["rang"] for r in out["ranking"].collect() if r["annee"] == 2027} >= {1}
    assert {r["nom"] for r in out["unassigned"].collect()} == set()   # all names belong to a party


def test_literal_vote_history(spark):
    out = E.literal_vote_history(spark)
    v = {(r["annee"], r["nom"]): r["voix"] for r in out["votes"].collect()}
    assert math.isclose(v[(2002, "CHIRAC")], 22.0 * 115000 / 100)
    assert all(0 <= r["pred"] <= 120000 for r in out["predictions"].collect())


def test_right_vote_and_crime(lake):
    spark, db, _, _ = lake
    out = E.right_vote_and_crime(spark, db, years=(2012, 2017, 2022))
    assert all(10 <= r["pred"] <= 60 for r in out["right_predictions"].collect())
    assert set(out["crime_pivot"].columns) == {"annee", "Homicides", "Vols"}
    assert out["evolution"].count() == 3 and out["crime_prediction"].count() == 1
    f = out["forecasts"].collect()
    assert {r["model"] for r in f} == {"linear", "quadratic", "arima"} and {r["annee"] for r in f} == {2023, 2024, 2025, 2026}


def test_land_folder_partitions_by_source(lake):
    spark, _, _, root = lake
    out = L.land_folder(spark, root, f"{root}/landed")
    groups = {k.lower(): v for k, v in out.items()}
    assert len(groups) >= 5                    # one group per distinct header
    elect = [p for k, p in groups.items() if k.startswith("presidentielle")]
    assert elect, groups
    df = spark.read.parquet(elect[0])
    assert "source_file" in df.columns and df.select("source_file").distinct().count() >= 1


def test_year_scan_prunes_partitions(lake):
    import contextlib
    import io
    spark, db, written, _ = lake
    from civica.sources.warehouse import scan_years
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        scan_years(spark.table(written["election_tour_1"]), "annee", 2017, 2022).explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(annee" in plan and "annee#" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_feature_frame_reference_modes(lake):
    spark, db, _, _ = lake
    mean_rows, inds = E.feature_frame(spark, E.ModelConfig(database=db))
    fan_rows, _ = E.feature_frame(spark, E.ModelConfig(database=db, quarter_mode="fanout", police_na="any"))
    assert inds == ["Homicides", "Vols"]
    # the year-only join against quarterly rows multiplies every row by four
    assert fan_rows.count() == 4 * mean_rows.count()
    assert "trimestre" in fan_rows.columns and "trimestre" not in mean_rows.columns


def _layout_files(raw):
    """One file of each of the two other layouts, as shipped: numbered
    headers with panel columns and a first block without a number; repeated
    headers with a no-break space, an unnamed tail and an empty block."""
    head = ["Code du département", "Libellé du département"]
    block = ["N°Panneau", "Sexe", "Nom", "Prénom", "Voix", "% Voix/Ins", "% Voix/Exp"]
    names = [*head, *block, *[f"{b}.{i}" for i in (1, 2) for b in block]]
    rows = [["32", "GERS", "1", "F", "LE PEN", "Marine", "40", '"30,0"', '"40,0"', "2", "M", "MACRON", "Emmanuel", "35", '"25,0"', '"35,0"',
             "3", "M", "Mélenchon", "Jean-Luc", "25", '"20,0"', '"25,0"'],
            ["33", "GIRONDE", "1", "F", "LE PEN", "Marine", "9", '"9,0"', '"9,0"', *[""] * 14], ["x", "?", *[""] * 21]]
    (raw / "Presidentielle2017.csv").write_text("\n".join(",".join(r) for r in [names, *rows]) + "\n", encoding="utf-8")
    common = ["Code de la région", *[f"Commun {i}\u00a0" for i in range(16)]]
    block = ["Sexe", "Nom", "Prénom", "Voix", "% Voix/Ins", "% Voix/Exp"]
    rows = [["32", *["c"] * 16, "M", "MACRON", "Emmanuel", "60", '"50,0"', '"60,0"', "F", "LE PEN", "Marine", "40", '"30,0"', '"40,0"',
             *[""] * 6, ""], ["44", *["c"] * 16, "M", "MACRON", "Emmanuel", "1", '"1,0"', '"1,0"', *[""] * 13]]
    (raw / "resultats-niveau-reg.csv").write_text(
        "\n".join(",".join(r) for r in [[*common, *block * 3, ""], *rows]) + "\n", encoding="utf-8")


def test_both_other_layouts_are_loaded(spark, tmpdir_path):
    import pathlib
    raw = pathlib.Path(tmpdir_path) / "raw"
    raw.mkdir()
    _layout_files(raw)
    db = "civica_layout_test"
    written = E.load_lake(spark, E.LakeConfig(raw_dir=str(raw), database=db))
    t = spark.table(written["candidats_long"])
    got = sorted((r["annee"], r["nom"], r["voix"], r["pourcentage_voix_exprimes"], r["code_region"]) for r in t.collect())
    assert got == [(2017, "LE PEN", 40.0, 40.0, 32), (2017, "MACRON", 35.0, 35.0, 32), (2017, "Mélenchon", 25.0, 25.0, 32),
                   (2022, "LE PEN", 40.0, 40.0, 32), (2022, "MACRON", 60.0, 60.0, 32)]
    out = E.party_share_analysis(spark, db, percent=True)
    assert {(r["annee"], r["total"], r["in_range"]) for r in out["range_check"].collect()} == {(2017, 100.0, True), (2022, 100.0, True)}
    shares = {(r["annee"], r["parti"]): r["share"] for r in out["shares"].collect()}
    assert shares[2017, "RN"] == 40.0 and shares[2022, "LREM"] == 60.0 and shares[2017, "LFI"] == 25.0
    E.W.drop_database(spark, db)
