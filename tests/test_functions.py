"""Scalar functions: names, headers, quarter labels, numbers."""

import pytest
from pyspark.sql import functions as F

from civica.functions import numbers as N
from civica.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalise_name_edges(spark):
    rows = [(" Le Pen ",), ("mélenchon",), ("DUPONT-AIGNAN",), ("a   b",), (None,), ("Pécresse",)]
    df = spark.createDataFrame(rows, "v string")
    got = [r["r"] for r in df.select(T.normalise_name("v").alias("r")).collect()]
    # one pass of double blank → single: three blanks become two
    assert got == ["LE PEN", "MELENCHON", "DUPONTAIGNAN", "A  B", "", "PECRESSE"]


def test_lookup_key_folds_accents(spark):
    assert one(spark, T.lookup_key("v"), " Pécresse") == "PECRESSE"


def test_contains_any_null_false(spark):
    df = spark.createDataFrame([("Marine LE PEN",), ("x",), (None,)], "v string")
    got = [r["r"] for r in df.select(T.contains_any("v", ["le pen", "rn"]).alias("r")).collect()]
    assert got == [True, False, False]


def test_year_quarter_both_spellings(spark):
    df = spark.createDataFrame([("2002-T1",), ("T4_2024",), ("_c93",)], "v string")
    y, q = T.year_quarter("v")
    got = [(r[0], r[1]) for r in df.select(y, q).collect()]
    assert got == [(2002, 1), (2024, 4), (None, None)]


@pytest.mark.parametrize("raw,expected", [
    ("Libellé du\xa0département", "libelle_du_departement"),
    (" Inscrits", "_inscrits"),          # strip after blank → "_"
    ("% Abs Ins", "%_abs_ins"),
    ("Blancs-et-nuls", "blancs_et_nuls"),
])
def test_normalise_header(raw, expected):
    assert T.normalise_header(raw) == expected


def test_light_and_unquote_header():
    assert T.light_header("\xa0Nom ") == "Nom"
    assert T.unquote_header(' "Voix" ') == "Voix"


def test_decimal_comma_and_coercion(spark):
    df = spark.createDataFrame([("0,0217852",), ("12",), ("abc",), (None,)], "v string")
    got = [r[0] for r in df.select(N.decimal_comma("v")).collect()]
    assert got == [0.0217852, 12.0, None, None]
    got = [r[0] for r in df.select(N.fill_sentinel(N.to_number("v"), -1.0)).collect()]
    assert got == [-1.0, 12.0, -1.0, -1.0]


def test_to_int_strict_fails_on_null(spark):
    df = spark.createDataFrame([("1",), (None,)], "v string")
    assert [r[0] for r in df.select(N.to_int("v")).collect()] == [1, None]
    with pytest.raises(Exception):
        df.select(N.to_int("v", strict=True)).collect()


def test_clip_floor_keep_null(spark):
    df = spark.createDataFrame([(5.0,), (70.0,), (None,)], "v double")
    assert [r[0] for r in df.select(N.clip("v", 10, 60)).collect()] == [10.0, 60.0, None]
    assert [r[0] for r in df.select(N.floor_at(F.col("v") - 10, 1)).collect()] == [1.0, 60.0, None]


def test_even_grid_matches_linspace(spark):
    import numpy as np
    got = spark.range(1).select(F.explode(N.even_grid(F.lit(2017.0), F.lit(2027.0), 100))).collect()
    assert np.allclose([r[0] for r in got], np.linspace(2017, 2027, 100))


def test_fixed_decimals(spark):
    assert one(spark, N.fixed_decimals("v", 3), 0.5, "v double") == "0.500"


def test_strip_blanks_like_python(spark):
    vals = ["\xa0Le Pen\t", " a ", " x "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(T.strip_blanks("v")).collect()] == [v.strip(T.STRIP_CHARS) for v in vals]
