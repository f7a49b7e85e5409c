"""Property tests: Spark expressions against plain-Python references on
generated inputs (one Spark job per example batch)."""

from hypothesis import given, settings, strategies as st

from civica.functions import text as T
from civica.operators import reshape as R
from civica.operators.joins import fold_key

ALPHABET = "abcdeéèêàâçôùû -ABCDEÉ'\t\xa0"


def py_normalise(s):
    s = "" if s is None else s
    s = s.strip(T.STRIP_CHARS).upper().translate(str.maketrans(T.ACCENTED_UPPER, T.FOLDED_UPPER))
    s = s.replace("-", " ").replace("  ", " ")
    for a, b in T.NAME_ALIASES.items():
        s = s.replace(a, b)
    return s


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)), min_size=1, max_size=30))
def test_normalise_name_matches_python(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = [r[0] for r in df.select(T.normalise_name("v")).collect()]
    assert got == [py_normalise(n) for n in names]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)), min_size=1, max_size=30))
def test_lookup_key_matches_driver_fold(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = [r[0] for r in df.select(T.lookup_key("v")).collect()]
    assert got == [fold_key(n) for n in names]


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.sampled_from([f"T{q}_{y}" for y in (2002, 2003) for q in (1, 2, 3, 4)]),
                       st.floats(-1e6, 1e6, allow_nan=False), min_size=1))
def test_unpivot_then_pivot_is_identity(spark, cells):
    cols = sorted(cells)
    wide = spark.createDataFrame([tuple(cells[c] for c in cols)], ", ".join(f"`{c}` double" for c in cols))
    long = R.unpivot_quarters(wide, cols, value_col="v")
    back = {(r["annee"], r["trimestre"]): r["v"] for r in long.collect()}
    assert back == {(int(c[3:]), int(c[1])): v for c, v in cells.items()}
