"""Operators on tiny literal frames: nulls, ties, empty and duplicate
headers, plus brute-force checks against pandas / numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from civica.operators import aggregates as A
from civica.operators import columns as P
from civica.operators import evaluate as EV
from civica.operators import features as FE
from civica.operators import joins as J
from civica.operators import quality as Q
from civica.operators import reshape as R
from civica.operators import rows as RW
from civica.operators import shares as SH
from civica.operators import trends as TR
from civica.operators import windows as W
from civica.functions.text import contains_any
from civica.sources import lake as L
from civica.sources import warehouse as W_


def _key(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


# ---------------------------------------------------------------- columns

def test_rename_collision_error_and_keep_last(spark):
    df = spark.createDataFrame([(1, "a", 2)], "x int, y string, z int")
    with pytest.raises(ValueError):
        P.rename_aliases(df, {"x": "k", "z": "k"})
    out = P.rename_aliases(df, {"x": "k", "z": "k"}, on_collision="keep_last")
    assert out.columns == ["y", "k"] and out.first()["k"] == 2


def test_drop_unnamed_and_resolve_key(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Unnamed: 3` int, _c4 int, code_departement int")
    out = P.resolve_key(P.drop_unnamed(df), ["code_region", "code_departement"], "code_region")
    assert out.columns == ["code_region"]
    with pytest.raises(ValueError):
        P.resolve_key(df, ["nothing"], "code_region")


def test_parse_decimal_columns_only_prefixed_strings(spark):
    df = spark.createDataFrame([("1,5", "2,5", "x")], "pourcentage_a string, taux_b string, nom string")
    out = P.parse_decimal_columns(df).first()
    assert out["pourcentage_a"] == 1.5 and out["taux_b"] == 2.5 and out["nom"] == "x"


def test_block_rename_map():
    m = P.block_rename_map(3, {"Nom": "nom", "Voix": "voix"}, first_suffix=".1")
    assert m == {"Nom.1": "nom", "Voix.1": "voix", "Nom.2": "nom_2", "Voix.2": "voix_2",
                 "Nom.3": "nom_3", "Voix.3": "voix_3"}


# ---------------------------------------------------------------- rows

def test_prefix_filter_keeps_130(spark):
    df = spark.createDataFrame([(13,), (130,), (31,), (None,)], "c int")
    assert rows(RW.prefix_filter(df, "c", "13"), "c") == [(13,), (130,)]


def test_drop_all_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert RW.drop_all_null_columns(df).columns == ["a"]


def test_keep_or_other_and_not_in(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "n string")
    keep = spark.createDataFrame([("A",), ("C",)], "n string")
    assert rows(RW.keep_or_other(df, "n", keep, out="c"), "c") == [("A",), ("AUTRE",), ("AUTRE",), ("C",)]
    assert rows(RW.not_in(df.na.drop(), "n", keep), "n") == [("B",)]


def test_top_counts_tie_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "nom string")
    assert [r["nom"] for r in RW.top_counts(df, "nom", 2).collect()] == ["c", "a"]
    with pytest.raises(ValueError):
        RW.top_counts(df.withColumnRenamed("nom", "n"), "n")


def test_union_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    out = RW.union_missing([a, b])
    assert rows(out, "k", "a", "b") == [(1, "x", None), (2, None, 3.0)]


# ---------------------------------------------------------------- reshape

def test_long_by_suffix_drops_missing_name_or_votes(spark):
    df = spark.createDataFrame([(1, "A", 10, "B", None, None, 5)],
                               "id int, nom string, voix int, nom_2 string, voix_2 int, nom_3 string, voix_3 int")
    assert rows(R.long_by_suffix(df, ["id"], ["nom", "voix"]), "id", "nom", "voix") == [(1, "A", 10)]


def test_long_by_block_ragged_tail_and_presence(spark):
    df = spark.createDataFrame([(1, "A", 10, None, None, "junk")],
                               "id int, a string, b int, c string, d int, e string")
    out = R.long_by_block(df, 1, ["nom", "voix"])
    assert rows(out, "id", "nom", "voix") == [(1, "A", 10)]


def test_long_by_detect_inconsistent_is_empty(spark):
    df = spark.createDataFrame([(1, "A", 10, "B")], "id int, `Nom.1` string, `Voix.1` int, `Nom.2` string")
    out = R.long_by_detect(df, ["Nom", "Voix"])
    assert out.count() == 0 and "candidate_number" in out.columns
    ok = spark.createDataFrame([(1, "A", 10, None, 3)], "id int, `Nom.1` string, `Voix.1` int, `Nom.2` string, `Voix.2` int")
    assert rows(R.long_by_detect(ok, ["Nom", "Voix"]), "id", "candidate_number", "Nom") == [(1, 1, "A")]


def test_unpivot_quarters_then_pivot_identity(spark):
    df = spark.createDataFrame([(1.0, 2.0, None)], "`T1_2002` double, `2002-T2` double, `T3_2002` double")
    long = R.unpivot_quarters(df, df.columns, value_col="v")
    assert rows(long, "annee", "trimestre", "v") == [(2002, 1, 1.0), (2002, 2, 2.0)]
    back = R.pivot_sum(long, ["annee"], "trimestre", "v", [1, 2]).first()
    assert (back["1"], back["2"]) == (1.0, 2.0)


def test_unstack_zero_fill_absent_vs_partial(spark):
    df = spark.createDataFrame([(2027, "A", 1.0), (2032, "B", 2.0)], "y int, c string, v double")
    out = {r["y"]: r for r in R.unstack_zero_fill(df, ["y"], "c", "v", ["A", "B", "Z"]).collect()}
    assert out[2027]["Z"] == 0.0 and out[2032]["Z"] == 0.0       # absent everywhere → 0
    assert out[2032]["A"] is None and out[2027]["B"] is None      # present elsewhere → null


# ---------------------------------------------------------------- joins

def test_left_join_suffix_and_null_safe(spark):
    a = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k int, taux double")
    b = spark.createDataFrame([(None, 9.0), (1, 8.0)], "k int, taux double")
    plain = J.left_join(a, b, "k", suffix="_p")
    assert plain.columns == ["k", "taux", "taux_p"]
    assert rows(plain, "taux", "taux_p") == [(1.0, None), (2.0, 8.0)]
    safe = J.left_join(a, b, "k", suffix="_p", null_safe=True)
    assert rows(safe, "taux", "taux_p") == [(1.0, 9.0), (2.0, 8.0)]


def test_lookup_with_default_folds_accents(spark):
    m = spark.createDataFrame([("MELENCHON", "Gauche"), ("PECRESSE", "Droite")], "k string, v string")
    df = spark.createDataFrame([("MÉLENCHON",), ("Pécresse",), ("X",), (None,)], "n string")
    out = J.lookup_with_default(df, "n", m, "k", "v", out="cat")
    assert rows(out, "n", "cat") == sorted([("MÉLENCHON", "Gauche"), ("Pécresse", "Droite"), ("X", "Autres"),
                                            (None, "Autres")], key=_key)


def test_keyword_match_multi_and_none(spark):
    df = spark.createDataFrame([("red widget",), ("small ring",)], "n string")
    out = J.keyword_match(df, "n", {"R": ["red"], "T": ["widget"], "X": []})
    assert rows(out, "n", "parti") == [("red widget", "R"), ("red widget", "T")]


# ---------------------------------------------------------------- shares

def test_party_totals_residual_and_normalised(spark):
    df = spark.createDataFrame([(1, "LE PEN", 30.0), (1, "MACRON", 50.0), (1, "X", 20.0), (1, None, 5.0)],
                               "y int, n string, v double")
    t = SH.party_totals(df, ["y"], "n", "v", {"RN": ["le pen"], "LREM": ["macron"], "PS": ["hollande"], "AUTRES": []})
    got = dict(rows(t, "parti", "voix"))
    assert got == {"RN": 30.0, "LREM": 50.0, "PS": 0.0, "AUTRES": 25.0}
    s = SH.normalise_shares(t, ["y"], "voix")
    assert math.isclose(sum(r["share"] for r in s.collect()), 100.0)


def test_party_totals_overlap_residual_floor(spark):
    df = spark.createDataFrame([(1, "A B", 10.0)], "y int, n string, v double")
    got = dict(rows(SH.party_totals(df, ["y"], "n", "v", {"P": ["a"], "Q": ["b"]}), "parti", "voix"))
    assert got == {"P": 10.0, "Q": 10.0, "AUTRES": 0.0}


def test_caps_and_renormalise(spark):
    df = spark.createDataFrame([(1, "RN", 80.0), (1, "PS", 25.0), (1, "LO", -3.0)], "y int, p string, v double")
    c = SH.apply_caps(df, "p", "v", {"RN": 60.0, "PS": 20.0}, 50.0)
    assert dict(rows(c, "p", "v")) == {"RN": 60.0, "PS": 20.0, "LO": 1.0}
    r = SH.renormalise_with_residual(c, ["y"], "p", "v", residual="AUTRES")
    got = dict(rows(r, "p", "share"))
    assert math.isclose(got["RN"] + got["PS"] + got["LO"], 100.0) and got["AUTRES"] == 0.0


# ---------------------------------------------------------------- windows

def test_lag_null_only_on_first_row_per_group(spark):
    df = spark.createDataFrame([("a", 2002, 1, 1.0), ("a", 2002, 2, 2.0), ("a", 2007, 3, 3.0), ("b", 2002, 4, 9.0)],
                               "g string, y int, t int, v double")
    out = W.lag_within(df, ["g"], ["y", "t"], "v", "p")
    assert rows(out, "t", "p") == [(1, None), (2, 1.0), (3, 2.0), (4, None)]


def test_latest_row_first_on_ties(spark):
    df = spark.createDataFrame([("a", 2022, 2, 5.0), ("a", 2022, 1, 7.0), ("a", 2017, 0, 9.0)],
                               "g string, y int, t int, v double")
    r = W.latest_row(df, ["g"], "y", ties=["t"]).first()
    assert (r["y"], r["t"], r["v"]) == (2022, 1, 7.0)


def test_argmax_label_tie_smallest_and_skip_null(spark):
    df = spark.createDataFrame([(1, "B", 5.0), (1, "A", 5.0), (1, "C", None), (2, "C", None)], "k int, c string, v double")
    assert rows(W.argmax_label(df, ["k"], "c", "v"), "k", "c") == [(1, "A")]


def test_group_mean_fill_null_key_not_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, None), (None, 3.0)], "g string, v double")
    out = W.group_mean_fill(df, ["g"], "v", out="f")
    assert sorted(r["f"] for r in out.collect() if r["f"] is not None) == [1.0, 1.0, 3.0]


def test_pct_change_mean_matches_pandas(spark):
    rng = np.random.default_rng(1)
    recs = []
    for s in "abc":
        for p in range(10):
            if (s == "b" and p < 3) or (s == "c" and p % 4 == 1):
                continue
            recs.append((s, p, float(rng.uniform(1, 5))))
    recs.append(("a", 4, None))
    df = spark.createDataFrame(recs, "s string, p int, v double")
    got = dict(rows(W.pct_change_mean(df, "s", "p", "v"), "p", "evolution"))
    pdf = pd.DataFrame(recs, columns=["s", "p", "v"])
    piv = pdf.pivot_table(index="p", columns="s", values="v")
    filled = piv.ffill()
    ch = (filled / filled.shift(1) - 1).where(filled.notna())
    want = ch.mean(axis=1).fillna(0)
    for p, v in want.items():
        assert math.isclose(got[p], v, rel_tol=1e-12, abs_tol=1e-12)


def test_last_value(spark):
    df = spark.createDataFrame([("a", 2017, 1.0), ("a", 2022, 2.0)], "s string, y int, v double")
    assert rows(W.last_value(df, ["s"], "y", "v"), "s", "last_value") == [("a", 2.0)]


# ---------------------------------------------------------------- aggregates

def test_fill_global_mean_and_null_counts(spark):
    df = spark.createDataFrame([(1.0, None), (None, "x"), (3.0, None)], "a double, b string")
    assert rows(A.fill_global_mean(df, ["a"]), "a") == [(1.0,), (2.0,), (3.0,)]
    assert dict(rows(A.null_counts(df), "column_name", "n_null")) == {"a": 1, "b": 2}


def test_masked_sum_empty_is_zero(spark):
    df = spark.createDataFrame([("x", 1.0)], "n string, v double")
    assert A.masked_sum(df, "v", F.col("n") == "none").first()["total"] == 0.0


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    r = A.correlation(df, "x", "y").first()
    assert r["corr"] is None and r["n"] == 2


# ---------------------------------------------------------------- trends

def test_quadratic_matches_numpy(spark):
    x = np.array([2002, 2007, 2012, 2017, 2022.0])
    y = np.array([10.0, 12.5, 17.0, 15.0, 18.0])
    pts = [("s", int(a), float(b)) for a, b in zip(x, y)] + [("two", 2017, 20.0), ("two", 2022, 25.0), ("one", 2022, 4.0)]
    fit = TR.quadratic_fit(spark.createDataFrame(pts, "s string, x int, y double"), ["s"], "x", "y")
    got = {(r["s"], r["annee"]): r["pred"] for r in TR.quadratic_predict(fit, [2027, 2032]).collect()}
    want = np.polyval(np.polyfit(x, y, 2), [2027, 2032])
    assert np.allclose([got[("s", 2027)], got[("s", 2032)]], want, rtol=1e-9)
    X = np.array([[2017.0, 2017.0 ** 2], [2022.0, 2022.0 ** 2]])
    w = np.linalg.lstsq(X - X.mean(0), np.array([20.0, 25.0]) - 22.5, rcond=None)[0]
    for t in (2027, 2032):
        assert math.isclose(got[("two", t)], 22.5 + w @ (np.array([t, t * t]) - X.mean(0)), rel_tol=1e-9)
    assert got[("one", 2027)] == 4.0


def test_linear_matches_numpy(spark):
    x = np.array([1.0, 2.0, 4.0]); y = np.array([1.0, 3.0, 4.0])
    df = spark.createDataFrame([("s", float(a), float(b)) for a, b in zip(x, y)], "s string, x double, y double")
    got = TR.linear_predict(TR.linear_fit(df, ["s"], "x", "y"), [10]).first()["pred"]
    assert math.isclose(got, np.polyval(np.polyfit(x, y, 1), 10), rel_tol=1e-12)


def test_arima_short_series_is_null_and_long_runs(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)] + [("b", i, float(i * i % 7)) for i in range(1, 20)],
                               "s string, p int, v double")
    out = {(r["s"], r["step"]): r["forecast"] for r in TR.arima_forecast(df, "s", "p", "v").collect()}
    assert out[("a", 1)] is None                                  # too short: null, not NaN
    assert all(math.isfinite(out[("b", h)]) for h in range(1, 5))


def test_arima_matches_the_grid_by_hand(spark):
    rng = np.random.default_rng(4)
    y = np.cumsum(rng.normal(0, 1, 25))
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "s string, p int, v double")
    d = np.diff(y)
    best = None
    for phi in np.arange(-95, 96, 5) / 100:
        for theta in np.arange(-95, 96, 5) / 100:
            e, sse = 0.0, 0.0
            for t in range(1, len(d)):
                e = d[t] - phi * d[t - 1] - theta * e
                sse += e * e
            best = min(best or (sse, phi, theta, e), (sse, phi, theta, e))
    _, phi, theta, e = best
    move, level, want = phi * d[-1] + theta * e, y[-1], []
    for _ in range(4):
        level += move
        want.append(level)
        move *= phi
    got = TR.arima_forecast(df, "s", "p", "v").orderBy("step").collect()
    assert np.allclose([r["forecast"] for r in got], want) and [r["p"] for r in got] == [25, 26, 27, 28]


def test_arima_steps_follow_the_last_period_of_all(spark):
    rows_ = [("old", y, float(y % 3)) for y in range(2010, 2019)] + [("new", y, float(y % 5)) for y in range(2010, 2025)]
    got = TR.arima_forecast(spark.createDataFrame(rows_, "s string, p int, v double"), "s", "p", "v")
    assert {(r["s"], r["p"]) for r in got.collect()} == {(s, y) for s in ("old", "new") for y in range(2025, 2029)}


def test_arima_constant_series_is_flat(spark):
    df = spark.createDataFrame([("s", i, 5.0) for i in range(12)], "s string, p int, v double")
    assert [r["forecast"] for r in TR.arima_forecast(df, "s", "p", "v").collect()] == [5.0] * 4


# ---------------------------------------------------------------- features

def test_hash_split_disjoint_complete_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = FE.hash_split(df, ["k"])
    b = FE.hash_split(df.repartition(7), ["k"])
    ra, rb = dict(rows(a, "k", "split")), dict(rows(b, "k", "split"))
    assert ra == rb and set(ra.values()) == {"train", "test"}
    share = sum(1 for v in ra.values() if v == "train") / len(ra)
    assert 0.75 < share < 0.85


@pytest.mark.parametrize("data", [
    list(range(60)),
    [1.0] * 500 + [2.0] * 3 + [float(i) for i in range(300)],
    list(np.random.default_rng(3).lognormal(0, 3, 5000)),
])
@pytest.mark.parametrize("accuracy", [10, 100_000])
def test_exact_quantiles_match_numpy(spark, data, accuracy, monkeypatch):
    monkeypatch.setattr(FE, "SKETCH_ACCURACY", accuracy)     # a coarse sketch needs several passes
    df = spark.createDataFrame([(float(v),) for v in data], "x double")
    got = FE.exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    assert np.allclose(got, np.percentile(np.array(data, float), [25, 50, 75]), rtol=1e-12)


@pytest.mark.parametrize("data", [
    [-1.5e308, -1e308, -2.5e307, 2.4, 2.6, 2.4e307, 2.6e307, 1.6e308],
    [1.0, 2.0, 3.0, 4.0, 5.0, math.inf],
    [-math.inf, -math.inf, 1.0, math.inf],
    [*map(float, range(3000)), math.inf],
    [-0.0, 0.0, 5e-324, 1.0],
])
@pytest.mark.parametrize("accuracy", [10, 100_000])
def test_quantiles_of_any_spread(spark, data, accuracy, monkeypatch):
    monkeypatch.setattr(FE, "SKETCH_ACCURACY", accuracy)
    df = spark.createDataFrame([(v, v) for v in [*data, math.nan]] + [(None, 1.0)], "x double, `y.z` double")
    got = FE.order_statistics(df, [(c, p) for c in ("x", "y.z") for p in (0.25, 0.5, 0.75)])
    v = sorted(data)
    for p in (0.25, 0.5, 0.75):
        at = (len(v) - 1) * p
        a, b, w = v[math.floor(at)], v[math.ceil(at)], at - math.floor(at)
        want = a if w == 0 or a == b else a * (1 - w) + b * w
        assert got["x", p] == want or math.isclose(got["x", p], want, rel_tol=1e-12)


def test_quantiles_do_not_depend_on_the_size(spark):
    df = spark.range(60_000).selectExpr("if(id = 7, cast('Infinity' as double), cast(id as double)) as x")
    v = sorted([float(i) for i in range(60_000) if i != 7] + [math.inf])
    got = FE.exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    assert np.allclose(got, [v[int((len(v) - 1) * p)] for p in (0.25, 0.5, 0.75)], atol=1)


def test_robust_scale_zero_iqr(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,), (5.0,), (7.0,)], "x double")   # IQR 0 → scale 1
    assert rows(FE.robust_scale(df, ["x"]), "x_scaled") == [(0.0,), (0.0,), (0.0,), (0.0,), (2.0,)]


# ---------------------------------------------------------------- evaluate

def test_r2_and_mae(spark):
    y = [1.0, 2.0, 3.0, 4.0]; p = [1.1, 1.9, 3.2, 3.7]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    r2 = EV.r2(df, "y", "p").first()["r2"]
    want = 1 - sum((a - b) ** 2 for a, b in zip(y, p)) / sum((a - 2.5) ** 2 for a in y)
    assert math.isclose(r2, want, rel_tol=1e-12)
    assert math.isclose(EV.mae(df, "y", "p").first()["mae"], 0.175, rel_tol=1e-12)


def test_class_metrics_weighted(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    df = spark.createDataFrame(pairs, "t string, p string")
    r = EV.class_metrics(df, "t", "p").first()
    # precision: a 1/1, b 1/3, c 0 (never predicted); recall: a 1/2, b 1, c 0
    prec = (2 * 1.0 + 1 * (1 / 3) + 1 * 0.0) / 4
    f1a, f1b = 2 * 1 * 0.5 / 1.5, 2 * (1 / 3) * 1 / (4 / 3)
    assert math.isclose(r["accuracy"], 0.5) and math.isclose(r["precision"], prec)
    assert math.isclose(r["f1"], (2 * f1a + f1b) / 4)


# ---------------------------------------------------------------- quality

def test_quality_checks(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "fk int")
    audit = dict(rows(Q.constraint_audit([Q.duplicate_keys(parent, ["k"], "pk"),
                                           Q.orphans(child, "fk", parent, "k", "fk")]), "check_name", "n_violations"))
    assert audit == {"pk": 1, "fk": 1}
    s = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 1.0)], "s string, v double")
    assert Q.min_history(s, ["s"], "v", 2).collect()[0]["s"] == "a"
    with pytest.raises(ValueError):
        Q.ensure_not_empty(s.where("false"))
    assert P.require_columns(s, ["s", "nom"]) == ["nom"]
    prof = Q.profile(s, "x").collect()
    assert {r["column_name"]: r["n_null"] for r in prof} == {"s": 0, "v": 1} and prof[0]["n_rows"] == 4


@pytest.mark.parametrize("fine", [False, True])
def test_split_lag_equals_plain_window(spark, fine):
    split = F.struct(F.col("y"), F.floor(F.col("t") / 3)) if fine else "y"
    rng = np.random.default_rng(5)
    recs = [(str(rng.integers(0, 3)) if rng.random() > 0.1 else None, int(rng.integers(2000, 2004)), i,
             float(rng.integers(0, 50)) if rng.random() > 0.1 else None) for i in range(400)]
    recs += [("hot", 2001, 1000 + i, float(i)) for i in range(300)]          # one hot group
    df = spark.createDataFrame(recs, "g string, y int, t int, v double")
    plain = dict(rows(W.lag_within(df, ["g"], ["y", "t"], "v", "p"), "t", "p"))
    split_ = dict(rows(W.lag_within(df, ["g"], ["y", "t"], "v", "p", split=split), "t", "p"))
    assert plain == split_


def test_lookup_dict_folds_and_dedupes(spark):
    df = spark.createDataFrame([("Pécresse",), ("zz",)], "n string")
    out = J.lookup_with_default(df, "n", {"PECRESSE": "Droite", "PÉCRESSE": "X"}, out="c")
    assert rows(out, "n", "c") == [("Pécresse", "Droite"), ("zz", "Autres")]


def test_broadcast_only_with_a_proven_bound(spark):
    big = spark.range(100000)
    assert J.plan_max_rows(big.limit(20)) == 20
    assert J.plan_max_rows(big) is None or J.plan_max_rows(big) > J.BOUNDED_ROWS
    assert J.plan_max_rows(RW.top_counts(big.withColumn("v", F.col("id") % 7), "v", 20)) == 20
    hinted = J.bounded_broadcast(big.limit(20))
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    plain = J.bounded_broadcast(big)
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()


def test_lineage_cut_lands_in_shared_folder(spark):
    from civica.session import cut_lineage, shared_dir
    df = cut_lineage(spark.range(10), name="t")
    paths = df.inputFiles()
    assert paths and all(shared_dir(spark).split("://")[-1] in p for p in paths)
    assert df.count() == 10


def test_constant_series_trends(spark):
    df = spark.createDataFrame([("k", y, 7.0) for y in (2002, 2007, 2012, 2017)], "s string, x int, y double")
    lin = TR.linear_predict(TR.linear_fit(df, ["s"], "x", "y"), [2027]).first()["pred"]
    quad = TR.quadratic_predict(TR.quadratic_fit(df, ["s"], "x", "y"), [2027]).first()["pred"]
    assert math.isclose(lin, 7.0) and math.isclose(quad, 7.0, abs_tol=1e-9)
    assert {r["forecast"] for r in TR.arima_forecast(df, "s", "x", "y").collect()} == {7.0}


def test_operators_on_an_empty_table(spark):
    e = spark.createDataFrame([], "annee int, nom string, voix double, code_region int")
    assert SH.party_totals(e, ["annee"], "nom", "voix", {"RN": ["le pen"]}).count() == 0
    assert A.fill_global_mean(e, ["voix"]).count() == 0
    assert R.unstack_zero_fill(e, ["annee"], "nom", "voix", ["A", "B"]).count() == 0
    assert TR.quadratic_fit(e, ["nom"], "annee", "voix").count() == 0
    assert W.latest_row(e, ["nom"], "annee").count() == 0
    assert W.pct_change_mean(e, "nom", "annee", "voix").count() == 0
    assert FE.exact_quantiles(e, "voix", [0.5]) == [None]
    m = EV.class_metrics(e.select(F.col("nom").alias("t"), F.col("nom").alias("p")), "t", "p").first()
    assert m["accuracy"] is None and m["n"] is None
    assert Q.profile(e, "empty").where("n_rows = 0").count() == 4


def test_long_by_suffix_field_missing_from_first_block(spark):
    df = spark.createDataFrame([(1, "A", 10, "B", 20, "F")],
                               "id int, nom string, voix int, nom_2 string, voix_2 int, sexe_2 string")
    out = R.long_by_suffix(df, ["id"], ["nom", "sexe", "voix"])
    assert rows(out, "nom", "sexe", "voix") == [("A", None, 10), ("B", "F", 20)]


@pytest.mark.parametrize("dtype,prefix", [("int", "1"), ("int", "13"), ("bigint", "9"), ("int", "0"),
                                          ("smallint", "32"), ("bigint", "922"), ("int", "01")])
def test_integer_prefix_ranges_equal_string_prefix(spark, dtype, prefix):
    top = {"smallint": 32767, "int": 2**31 - 1, "bigint": 2**63 - 1}[dtype]
    rng = np.random.default_rng(11)
    vals = [0, 1, 9, 10, 13, 130, 1399, -13, -1, top, -top, 99, 100, 3276, 32767, 9223372036854775807 % (top + 1)]
    vals += [int(v) for v in rng.integers(-top, top, 300, endpoint=True)] + list(range(0, 2000))
    vals = [v for v in vals if -top <= v <= top]
    df = spark.createDataFrame([(v,) for v in vals], f"x {dtype}")
    got = sorted(r["x"] for r in RW.prefix_filter(df, "x", prefix).collect())
    assert got == sorted(v for v in vals if str(v).startswith(prefix))


# ---------------------------------------------------------------- nothing is cut, nothing is guessed

def test_seventy_candidate_blocks(spark):
    names = [f"{f}{'' if i == 1 else f'_{i}'}" for i in range(1, 71) for f in ("nom", "voix")]
    df = spark.createDataFrame([(1, *[f"n{i}" if k % 2 == 0 else str(i) for i, k in ((k // 2, k) for k in range(140))])],
                               ["id", *names])
    assert R.long_by_suffix(df, ["id"], ["nom", "voix"]).count() == 70


def test_numbered_blocks_with_dotted_ids_and_panels(spark):
    df = spark.createDataFrame([("a", 1, "x", 5, 9)], ["Code.dép", "N°Panneau.1", "Nom.1", "Voix.1", "n.o"])
    out = R.long_by_detect(df, ["Nom", "Voix"])
    assert out.columns == ["Code.dép", "n.o", "candidate_number", "Nom", "Voix"] and out.count() == 1
    uneven = spark.createDataFrame([("a", "x", 5, "y")], ["id", "Nom.1", "Voix.1", "Nom.2"])
    none = R.long_by_detect(uneven, ["Nom", "Voix"])
    assert none.count() == 0 and dict(none.dtypes)["Voix"] == "bigint"


def test_latest_row_skips_missing_periods(spark):
    df = spark.createDataFrame([("k", 2020, "a"), ("k", None, "b"), ("k", 2022, "c"), ("n", None, "d")], "k string, y int, v string")
    assert rows(W.latest_row(df, ["k"], "y"), "k", "y", "v") == [("k", 2022, "c")]
    dates = spark.sql("select 'k' k, date'2020-01-01' y, 1 v union all select 'k', date'2021-01-01', 2")
    assert W.latest_row(dates, ["k"], "y").first()["v"] == 2


def test_mean_change_with_a_zero(spark):
    import pandas as pd
    data = [("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 10.0), ("b", 1, 2.0), ("b", 2, 4.0), ("b", 4, 8.0), ("c", 3, 0.0), ("c", 4, 0.0)]
    got = dict(rows(W.pct_change_mean(spark.createDataFrame(data, "s string, p int, v double"), "s", "p", "v"), "p", "evolution"))
    wide = pd.DataFrame(data, columns=["s", "p", "v"]).pivot(index="p", columns="s", values="v").ffill()
    change = (wide / wide.shift(1).replace(0, np.nan) - 1)
    want = change.mean(axis=1).fillna(0)
    assert got == {p: pytest.approx(w) for p, w in want.items()} and got[2] == 1.0


def test_integers_beyond_doubles(spark):
    from civica.functions.numbers import to_int
    df = spark.createDataFrame([("9007199254740993",), ("1e3",), ("x",), (None,)], "s string").select(to_int("s").alias("v"))
    assert [r["v"] for r in df.collect()] == [9007199254740993, 1000, None, None]
    big = spark.createDataFrame([("a", 2**60), ("a", 1), ("b", None)], "k string, v long")
    assert rows(A.group_sums(big, ["k"], {"s": "v"}), "k", "s") == [("a", 2**60 + 1), ("b", 0)]
    assert A.masked_sum(big, "v").first()["total"] == 2**60 + 1


def test_accented_keywords_fold(spark):
    df = spark.createDataFrame([("MÉLENCHON",), ("mélenchon",), ("MELENCHON",)], "n string")
    assert df.where(contains_any("n", ["mélenchon"])).count() == 2


def test_measured_side_is_broadcast_only_when_small(spark):
    small, big = spark.range(10), spark.range(200_000)
    assert "ResolvedHint" in J.measured(small)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in J.measured(big, max_bytes=1000)._jdf.queryExecution().analyzed().toString()


def test_measured_left_join_keeps_every_row(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (1, "q")], "k int, w string")
    assert sorted(rows(J.left_join(a, b, "k", measure=True), "v", "w"), key=str) == \
        sorted(rows(J.left_join(a, b, "k"), "v", "w"), key=str)


def test_standard_year_reports_missing_columns(spark):
    df = spark.createDataFrame([("A", "1,5", "x")], ["Nom", "% Voix/Exp", "Sexe"])
    out, missing = P.standardise_year(df, 2022)
    assert out.columns == ["nom", "pourcentage_voix_exprimes", "Sexe"] and missing == []
    assert P.standardise_year(df.drop("Nom"), 2017)[1] == ["nom"]


def test_routed_load_renames_and_matches_words_anywhere(spark):
    df = spark.createDataFrame([("1,5", "2,5", "3,5")], ["pourcentage_voix_inscrits", "mon_taux", "autre"])
    out = L.prepare_routed(df, "Election 2017")
    r = out.first()
    assert (r["pourcentage_voix_inscrits_election"], r["mon_taux"], r["autre"], r["annee"]) == (1.5, 2.5, "3,5", 2017)


def test_declared_keys_are_audited(spark):
    from civica.sources import warehouse as W
    db = W.ensure_database(spark, "civica_audit_test")
    W.create_schema(spark, db, W.STAR_SCHEMA | W.WIDE_SCHEMA)
    assert dict(spark.table(f"`{db}`.cantons").dtypes)["code_canton"] == "string"
    W.append_table(spark.sql("select 1 code_departement, 'x' libelle_departement, 99 code_region"), f"`{db}`.departements")
    got = dict(rows(W.audit_schema(spark, db, W.STAR_SCHEMA), "check_name", "n_violations"))
    assert got["fk_departements_code_region"] == 1 and sum(got.values()) == 1
    W.drop_database(spark, db)


def test_shared_folder_is_required_off_local_masters(spark):
    from civica import session as SE

    class Fake:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        SE.shared_dir(Fake())


def test_scratch_tables_can_be_removed(spark, tmpdir_path):
    import os
    from civica import session as SE
    df = SE.cut_lineage(spark.range(3), name="gone")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    W_.ensure_database(spark, "civica_gone")
    W_.append_table(spark.range(2), "civica_gone.t")
    kept = W_.ensure_database(spark, "civica_kept", f"{tmpdir_path}/kept")
    assert os.path.exists(path) and SE.clean_scratch(spark) > 0 and not os.path.exists(path)
    assert not spark.catalog.databaseExists("civica_gone") and spark.catalog.databaseExists(kept)
    W_.drop_database(spark, kept)


def test_keyword_index_equals_patterns(spark):
    import random
    from civica.operators.joins import keyword_index_match, keyword_match
    rng = random.Random(3)
    names = [("".join(rng.choice("abcÉ é.-") for _ in range(rng.randint(0, 12))), i) for i in range(300)] + [(None, -1), ("LE PEN", -2), ("le pen", -3)]
    groups = {f"g{i}": ["".join(rng.choice("abé. ") for _ in range(rng.randint(1, 5))) for _ in range(3)] for i in range(60)}
    groups["fn"] = ["Le Pen"]
    df = spark.createDataFrame(names, "nom string, i int")
    table = spark.createDataFrame([(g, k) for g, ks in groups.items() for k in ks] + [("none", None), ("none", "")], "label string, keyword string")
    got = keyword_index_match(df, "nom", table)
    want = keyword_match(df, "nom", groups)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert keyword_index_match(df, "nom", table.limit(0)).count() == 0


def test_ten_thousand_keywords_without_nested_loops(spark):
    from test_plans import physical
    from civica.operators.joins import keyword_index_match
    df = spark.range(20_000).selectExpr("concat('name ', id, ' end') AS nom")
    kw = spark.range(10_000).selectExpr("concat('g', id % 7) AS label", "concat(' ', id + 5000, ' ') AS keyword")
    got = keyword_index_match(df, "nom", kw)
    plan = physical(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == 10_000


def test_append_batch_repeats_and_evolves(spark):
    from civica.sources import warehouse as W
    db = W.ensure_database(spark, "civica_batches_test")
    t = f"`{db}`.t"
    first = spark.createDataFrame([(1, "a")], "id int, x string")
    second = spark.createDataFrame([(2, 2.5)], "id int, y double")
    for df, lot in ((first, "one"), (second, "two"), (first, "one"), (second, "two")):
        W.append_batch(df, t, lot)
    assert sorted(map(tuple, spark.table(t).select("id", "x", "y").collect())) == [(1, "a", None), (2, None, 2.5)]
    with pytest.raises(ValueError):
        W.append_batch(spark.createDataFrame([("z",)], "id string"), t, "three")
    spark.sql(f"DROP DATABASE `{db}` CASCADE")


def test_header_is_read_without_the_data(spark, tmpdir_path, monkeypatch):
    from civica.sources import lake as L
    for i in range(5):
        with open(f"{tmpdir_path}/f{i}.csv", "w", encoding="utf-8") as f:
            f.write("\ufeffa,b\n" + "1,2\n" * 1000 if i else "")
    got = L.header_lines(spark, L.list_files(spark, tmpdir_path))
    assert sorted(got.values()) == ["", "a,b", "a,b", "a,b", "a,b"]
    monkeypatch.setattr(L, "HEADER_BYTES", 3)
    with pytest.raises(ValueError):
        L.first_line(spark, L.list_files(spark, tmpdir_path)[1])


def test_arima_refined_grid_is_not_worse(spark):
    import numpy as np
    from civica.operators.trends import arima_forecast
    rng = np.random.default_rng(4)
    d = np.zeros(60)
    for i in range(1, 60):
        d[i] = 0.43 * d[i - 1] + rng.normal()
    y = np.cumsum(d)
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "s string, t int, v double")

    def css(phi, theta):
        e, out = 0.0, 0.0
        z = np.diff(y)
        for a, b in zip(z[:-1], z[1:]):
            e = b - phi * a - theta * e
            out += e * e
        return out
    rough = [r["forecast"] for r in arima_forecast(df, "s", "t", "v").orderBy("step").collect()]
    fine = [r["forecast"] for r in arima_forecast(df, "s", "t", "v", refine=2).orderBy("step").collect()]
    assert rough != fine
    # The damping of later steps gives phi back.
    phi = [(x[3] - x[2]) / (x[2] - x[1]) for x in (rough, fine)]
    best = [min(css(p, t / 1000) for t in range(-990, 991, 2)) for p in phi]
    assert best[1] <= best[0] and abs(phi[0] * 100 / 5 - round(phi[0] * 100 / 5)) < 1e-6


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_top_counts_pruned_equals_top_counts(spark, buckets):
    # A few heavy values, ties at the floor, many light values, nulls.
    d = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 4 == 1, F.col("id") % 11)
                                 .otherwise(100 + F.col("id") % 1500).cast("string").alias("nom"))
    for n in (1, 5, 11, 20, 5000):
        want = [tuple(r) for r in RW.top_counts(d, "nom", n).collect()]
        assert [tuple(r) for r in RW.top_counts_pruned(d, "nom", n, buckets=buckets).collect()] == want
    assert RW.top_counts_pruned(d.where("nom is null"), "nom", 3).count() == 0
    assert RW.top_counts_pruned(d.limit(0), "nom", 3).count() == 0
    with pytest.raises(ValueError):
        RW.top_counts_pruned(d, "nom", count_col="nom")


def test_top_counts_pruned_rules_light_values_out(spark):
    """With skewed counts only a few values are left to count in full."""
    heavy = spark.range(20_000).select((F.col("id") % 5).alias("v"))
    d = heavy.unionAll(spark.range(1000, 31_000).select(F.col("id").alias("v")))
    top = RW.top_counts_pruned(d, "v", 5)
    assert [r["v"] for r in top.collect()] == [0, 1, 2, 3, 4]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_pivot_sparse_beyond_the_pivot_limit(spark):
    d = spark.range(50_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"), (F.col("id") * 0.5).alias("x"))
    d = d.unionAll(spark.createDataFrame([(0, None, 1.0), (0, 4, None), (0, 4, 10.0), (7, 3, None), (None, 3, 5.0)], "g long, k long, x double"))
    wide = R.pivot_sparse(d, ["g"], "k", "x").cache()
    # 50,000 values: about five blocks of about 10,000, every cell in one of them.
    sizes = wide.where("g = 0").select(F.size("cells")).collect()
    assert len(sizes) >= 5 and sum(r[0] for r in sizes) == 25_000 and max(r[0] for r in sizes) < 11_000
    cells = {(r["g"], r["k"]): r["x"] for r in R.unpivot_sparse(wide, ["g"], "k", "x").collect()}
    assert len(cells) == 50_001 and cells[0, 4] == 6.0 and cells[1, 9] == 4.5 and cells[None, 3] == 5.0
    cols = {r["g"]: (r["four"], r["nine"]) for r in R.sparse_columns(wide, ["g"], {"four": 4, "nine": 9}).collect()}
    assert cols == {0: (6.0, None), 1: (None, 4.5), None: (None, None)}
    small = R.pivot_sparse(d, ["g"], "k", "x", how="sum").where("g is null").first()
    assert small["cells"] == {3: 5.0}
    assert R.pivot_sparse(d.limit(0), ["g"], "k", "x").count() == 0


def test_profiles_count_while_the_write_runs(spark, tmpdir_path):
    d = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "`x.y` int, s string")
    p = Q.Profiles()
    p.watch(d.repartition(2), "one").write.parquet(f"{tmpdir_path}/one")
    p.watch(d.limit(0), "two").write.parquet(f"{tmpdir_path}/two")
    want = [tuple(r) for r in Q.profile(d, "one").collect()] + [tuple(r) for r in Q.profile(d.limit(0), "two").collect()]
    assert [tuple(r) for r in p.rows(spark).collect()] == want
    with pytest.raises(ValueError):
        p.watch(d, "one")


def test_identity_follows_on_and_restarts(spark):
    db = W_.ensure_database(spark, "civica_identity_test")
    try:
        d = spark.range(100, 0, -1, 7).select(F.col("id").alias("k"), F.lit(-1).alias("nr"))
        W_.append_identity(d.limit(0), f"{db}.t", "nr", ["k"])
        assert spark.table(f"{db}.t").count() == 0
        W_.append_identity(d, f"{db}.t", "nr", ["k"])
        W_.append_identity(spark.createDataFrame([(5,), (None,), (5,)], "k long"), f"{db}.t", "nr", ["k"])
        got = sorted((r["nr"], r["k"]) for r in spark.table(f"{db}.t").where("nr <= 100").collect())
        assert got == [(i, i) for i in range(1, 101)]
        late = sorted((r["nr"], r["k"]) for r in spark.table(f"{db}.t").where("nr > 100").collect())
        assert late == [(101, None), (102, 5), (103, 5)]
        W_.truncate_all(spark, db)
        W_.append_identity(d.where("k <= 3"), f"{db}.t", "nr", ["k"])
        assert sorted((r["nr"], r["k"]) for r in spark.table(f"{db}.t").collect()) == [(1, 1), (2, 2), (3, 3)]
    finally:
        W_.drop_database(spark, db)
