"""The histogram booster against a row-by-row learner, and its routing of
missing values."""

import math
import random

import pytest

import __spark_entry__ as E
from civica.operators import booster as B
from civica.operators import model as MD
from civica.plans import carriers as C
from conftest import SF_SMALL


def rows(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.choice([None, *range(8)])
        b = None if rng.random() < 0.3 else rng.uniform(0, 10)
        y = (5.0 if a is None else a * 1.5) + (0.0 if b is None else (4.0 if b > 6 else 1.0)) + rng.choice([0.0, 0.5])
        out.append((i, None if a is None else float(a), b, y))
    return out


def naive(data, borders, rounds, depth, rate, least):
    """Boosting over single rows: every split of every node by brute force."""
    score = {r[0]: sum(r[3] for r in data) / len(data) for r in data}
    spread = sum((r[3] - score[0]) ** 2 for r in data)

    def left(r, s):
        x = r[1 + s[0]]
        return s[2] if x is None else x <= borders[s[0]][s[1]]

    def grow(part, level):
        g = sum(r[3] - score[r[0]] for r in part)
        best, choice = 0.0, None
        if level < depth:
            for f in range(2):
                missing = any(r[1 + f] is None for r in part)
                for k in range(len(borders[f])):
                    for way in (True, False):
                        lo = [r for r in part if left(r, (f, k, way))]
                        if min(len(lo), len(part) - len(lo)) < least or (not missing and way != (2 * len(lo) >= len(part))):
                            continue
                        lg = sum(r[3] - score[r[0]] for r in lo)
                        gain = round((lg ** 2 / len(lo) + (g - lg) ** 2 / (len(part) - len(lo)) - g ** 2 / len(part)) / spread, 9)
                        if gain > best:
                            best, choice = gain, (f, k, way)
        if choice is None:
            return {r[0]: rate * g / len(part) for r in part}
        return grow([r for r in part if left(r, choice)], level + 1) | grow([r for r in part if not left(r, choice)], level + 1)

    for _ in range(rounds):
        add = grow(data, 0)
        score = {i: s + add[i] for i, s in score.items()}
    return score


@pytest.mark.parametrize("rounds, depth, rate", [(1, 2, 1.0), (10, 3, 0.3)])
def test_cells_give_the_trees_of_rows(spark, rounds, depth, rate):
    data = rows()
    df = spark.createDataFrame(data, "id long, a double, b double, y double")
    model = B.fit_booster(df, ["a", "b"], "y", rounds=rounds, depth=depth, rate=rate, bins=12, least=10)
    want = naive(data, model.borders, rounds, depth, rate, 10)
    got = {r["id"]: r["pred_voix"] for r in B.booster_predict(model, df).collect()}
    assert len(model.trees) == rounds and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_missing_values_go_where_they_fit(spark):
    data = [(float(i % 10), 1.0 if i % 10 < 5 else 9.0) for i in range(200)]
    for value, expected_left in ((1.0, True), (9.0, False)):
        df = spark.createDataFrame(data + [(None, value)] * 50 + [(math.nan, value)] * 10, "x double, y double")
        model = B.fit_booster(df, ["x"], "y", rounds=1, depth=1, rate=1.0)
        split = model.trees[0][1]
        assert split.missing_left is expected_left
        scored = B.booster_predict(model, spark.createDataFrame([(None,), (0.0,), (9.0,), (math.nan,)], "x double")).collect()
        assert [round(r["pred_voix"], 9) for r in scored] == [value, 1.0, 9.0, value]


def test_no_split_gives_the_mean_and_empty_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, None)], "x double, y double")
    model = B.fit_booster(df, ["x"], "y", rounds=5)
    assert not model.trees and B.booster_predict(model, df).first()["pred_voix"] == 3.0
    with pytest.raises(ValueError):
        B.fit_booster(df.limit(0), ["x"], "y")


def test_many_rounds_fit_better_and_keep_the_floor(spark):
    df = spark.createDataFrame(rows(300, 2), "id long, a double, b double, y double")
    model = B.fit_booster(df, ["a", "b"], "y", rounds=40, depth=3, rate=0.2, least=5)
    r = B.booster_predict(model, df, floor=3.0).selectExpr("min(pred_voix) AS low", "1 - sum(pow(y - pred_voix, 2)) / (var_pop(y) * count(1)) AS r2").first()
    assert len(model.trees) == 40 and r["low"] >= 3.0 and r["r2"] > 0.9


def test_forest_finds_steps_whatever_rows_it_draws(spark):
    """Values that depend on one feature by steps: every leaf of every tree is
    pure, so the forest gives the steps' values, however rows are drawn."""
    steps = {0.0: 7.0, 1.0: 1.0, 2.0: 12.0, 3.0: 4.0}
    df = spark.createDataFrame([(float(i % 4), steps[i % 4]) for i in range(400)], "x double, y double")
    model = MD.train_model(df, ["x"], "y", kind="forest", max_depth=4, num_trees=5)
    new = spark.createDataFrame([(x,) for x in (*steps, -3.0, 8.0)], "x double")
    got = {r["x"]: round(r["pred_voix"], 9) for r in MD.predict(model, new, floor=2.0).collect()}
    assert got == {0.0: 7.0, 1.0: 2.0, 2.0: 12.0, 3.0: 4.0, -3.0: 7.0, 8.0: 4.0}


def test_forest_query_returns_predictions_and_their_fit(spark):
    got = E.queries()["forest_predict"](spark, SF_SMALL).collect()
    votes = {r["o_orderkey"]: r["voix"] for r in C.votes(spark, SF_SMALL).collect()}
    assert got and all(r["voix"] == votes[r["o_orderkey"]] and r["split"] == "test" for r in got)
    assert len({r["o_orderkey"] for r in got}) == len(got) and len({r["pred_voix"] for r in got}) > 5
    assert all(min(votes.values()) <= r["pred_voix"] <= max(votes.values()) for r in got)
    mean = sum(r["voix"] for r in got) / len(got)
    r2 = 1 - sum((r["voix"] - r["pred_voix"]) ** 2 for r in got) / sum((r["voix"] - mean) ** 2 for r in got)
    assert {round(r["r2_test"], 3) for r in got} == {round(r2, 3)}
