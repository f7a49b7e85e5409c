"""Histogram gradient boosting that routes missing values (M6).

The learner is grouped aggregates from end to end.  Features are binned at
quantiles, and rows that fall in the same bins in all features become one
cell (number of rows, sum of labels): the facts are read and shuffled once,
however many rounds follow.  Squared error needs no more than that, so trees
fitted on cells equal trees fitted on rows.  Each level of a tree is one
histogram aggregate over the cells; the driver sees one row per node,
feature and bin, a number fixed by the settings, and chooses the splits.  For
every split both ways of sending the missing values are weighed, so no
imputation is needed.

Scores are one SQL expression, without Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civica.functions.numbers import clip
from civica.operators.quality import ensure_not_empty
from civica.session import cut_lineage

# Relative accuracy of the sketched bin borders.
BORDER_ACCURACY = 100_000
# Trees evaluated as an expression before the cells are written again with their scores.
TREES_PER_WRITE = 8
# Digits of a gain, relative to the spread of the labels, that decide between splits; equal ones go to
# the first feature, then the lowest border, then missing values to the left.
GAIN_DIGITS = 9


@dataclass(frozen=True)
class Split:
    """Rows with ``feature <= border`` go left; missing ones where told."""
    feature: int
    border: int
    missing_left: bool


@dataclass(frozen=True)
class Booster:
    """``trees`` map node numbers (root 1, children 2i and 2i + 1) to a split
    or a leaf value; borders are numbered per feature."""
    features: tuple[str, ...]
    borders: tuple[tuple[float, ...], ...]
    start: float
    trees: tuple[dict, ...]


def _numeric(column: str) -> Column:
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


def quantile_borders(df: DataFrame, features: Sequence[str], bins: int) -> tuple[tuple[float, ...], ...]:
    """Up to ``bins - 1`` distinct values of each feature, one sketch a
    feature in one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(_numeric(f), shares, BORDER_ACCURACY).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return tuple(tuple(sorted(set(q))) if q else () for q in row)


def _bin(x: Column, borders: Sequence[float]) -> Column:
    """How many borders lie below a value, by halving; null stays null."""
    def search(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        return F.when(x <= F.lit(borders[m]), search(a, m)).otherwise(search(m + 1, b))
    return F.when(x.isNotNull(), search(0, len(borders)))


def _walk(tree: dict, goes_left, value, node: int = 1) -> Column:
    """A tree as an expression over its splits and leaves."""
    at = tree[node]
    if not isinstance(at, Split):
        return value(node, at)
    return F.when(goes_left(at), _walk(tree, goes_left, value, 2 * node)).otherwise(_walk(tree, goes_left, value, 2 * node + 1))


def _tree_row(tree: dict, depth: int) -> str:
    """A tree, in SQL, as arrays by node number, constants of a query: the
    plan and its generated code are the same for every tree."""
    at = [tree.get(k) for k in range(2 ** (depth + 1))]
    split = [x if isinstance(x, Split) else None for x in at]
    fields = {"feature": [str(x.feature if x else -1) for x in split], "border": [str(x.border if x else 0) for x in split],
              "missing_left": [str(bool(x and x.missing_left)) for x in split],
              "value": [f"{x!r}D" if isinstance(x, float) else "0.0D" for x in at]}
    return "named_struct(" + ", ".join(f"'{k}', array({', '.join(v)})" for k, v in fields.items()) + ")"


def _node(tree: Column, bins: str, steps: int) -> Column:
    """The node that a row of bins has come to after so many levels."""
    def step(node: Column, _: Column) -> Column:
        f = F.get(tree["feature"], node)
        left = F.coalesce(F.get(F.col(bins), f) <= F.get(tree["border"], node), F.get(tree["missing_left"], node))
        return F.when(f < 0, node).otherwise(2 * node + F.when(left, 0).otherwise(1))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(1), step) if steps else F.lit(1)


def _score(pending: list[dict], depth: int) -> Column:
    """The score of a cell: what is written, and the trees since."""
    if not pending:
        return F.col("score")
    rows = F.expr("array(" + ", ".join(_tree_row(t, depth) for t in pending) + ")")
    return F.aggregate(rows, F.col("score"), lambda s, t: s + F.get(t["value"], _node(t, "b", depth)))


def _best_split(hist: dict[int, dict[int | None, tuple[int, float]]], n_borders: Sequence[int], spread: float,
                penalty: float, least: int) -> tuple[Split, tuple[int, float], tuple[int, float]] | None:
    """The split of one node with the largest gain, and rows and residual sum
    of both sides.  ``hist`` has these by feature and bin (None: missing)."""
    best, choice = 0.0, None
    for f in sorted(hist):
        missing_n, missing_g = hist[f].get(None, (0, 0.0))
        n = sum(x[0] for x in hist[f].values())
        g = sum(x[1] for x in hist[f].values())
        below_n, below_g = 0, 0.0
        for k in range(n_borders[f]):
            add = hist[f].get(k, (0, 0.0))
            below_n, below_g = below_n + add[0], below_g + add[1]
            for left in (True, False):
                ln, lg = (below_n + missing_n, below_g + missing_g) if left else (below_n, below_g)
                if not missing_n and left != (2 * ln >= n):
                    continue  # nothing is missing here: later ones follow the larger side
                if ln < least or n - ln < least:
                    continue
                gain = lg * lg / (ln + penalty) + (g - lg) ** 2 / (n - ln + penalty) - g * g / (n + penalty)
                gain = round(gain / spread, GAIN_DIGITS)
                if gain > best:
                    best, choice = gain, (Split(f, k, left), (ln, lg), (n - ln, g - lg))
    return choice


def fit_booster(df: DataFrame, features: Sequence[str], label: str, rounds: int = 300, depth: int = 3, rate: float = 0.1,
                bins: int = 64, penalty: float = 0.0, least: int = 20) -> Booster:
    """M6: boosted trees of at most ``depth`` levels with at least ``least``
    rows a leaf.  Rows without a label are left out; Q4 guards against an
    empty frame.  Stops when no node of a round can be split."""
    rows = df.where(_numeric(label).isNotNull())
    ensure_not_empty(rows.select(F.col(f"`{label}`")))
    borders = quantile_borders(rows, features, bins)
    binned = rows.select(*[_bin(_numeric(f), borders[i]).alias(f"b{i}") for i, f in enumerate(features)], _numeric(label).alias("y"))
    names = [f"b{i}" for i in range(len(features))]
    cells = cut_lineage(binned.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"),
                                                   F.sum(F.col("y") * F.col("y")).alias("syy")), name="cells")
    n, sy, syy = cells.agg(F.sum("n"), F.sum("sy"), F.sum("syy")).first()
    start = sy / n
    spread = max(syy - sy * sy / n, 1e-300)
    cells = cells.select(F.array(*names).alias("b"), "n", "sy", F.lit(start).alias("score"))
    trees: list[dict] = []
    pending: list[dict] = []
    for _ in range(rounds):
        tree: dict = {1: None}
        sums: dict[int, tuple[int, float]] = {}
        residual = cells.select("b", "n", (F.col("sy") - F.col("n") * _score(pending, depth)).alias("g"))
        for level in range(depth):
            open_ = [k for k in tree if k >= 2 ** level and tree[k] is None]
            if not open_:
                break
            at = residual.select(_node(F.expr(_tree_row(tree, depth)), "b", level).alias("node"), "n", "g", F.posexplode("b").alias("f", "bin"))
            hist: dict[int, dict] = {}
            for r in at.groupBy("node", "f", "bin").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect():
                if r["node"] in open_:
                    hist.setdefault(r["node"], {}).setdefault(r["f"], {})[r["bin"]] = r["n"], r["g"]
            for k in open_:
                found = _best_split(hist[k], [len(b) for b in borders], spread, penalty, least)
                if found:
                    tree[k], sums[2 * k], sums[2 * k + 1] = found
                    tree[2 * k] = tree[2 * k + 1] = None
        if tree[1] is None:
            break
        for k in tree:
            if tree[k] is None:
                tree[k] = rate * sums[k][1] / (sums[k][0] + penalty)
        trees.append(tree)
        pending.append(tree)
        if len(pending) == TREES_PER_WRITE:
            cells = cut_lineage(cells.withColumn("score", _score(pending, depth)), name="cells")
            pending = []
    return Booster(tuple(features), borders, start, tuple(trees))


def booster_score(model: Booster) -> Column:
    """The score of a row as an expression over the features."""
    values = [_numeric(f) for f in model.features]

    def goes_left(s: Split) -> Column:
        return F.coalesce(values[s.feature] <= F.lit(model.borders[s.feature][s.border]), F.lit(s.missing_left))

    parts = [_walk(t, goes_left, lambda _, v: F.lit(v)) for t in model.trees]
    total = F.lit(model.start)
    for p in parts:
        total = total + p
    return total


def booster_predict(model: Booster, df: DataFrame, out: str = "pred_voix", floor: float | None = None) -> DataFrame:
    """M7: score rows; every input column is carried through.  Missing
    features are routed as learnt; a label isn't needed."""
    score = booster_score(model)
    return df.withColumn(out, clip(score, lo=floor) if floor is not None else score)
