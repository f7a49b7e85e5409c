"""Personal data: generated candidates, judged by boosted trees.

Patterns find what is certain (the base spans).  Generators with high recall
propose more: numbers in any grouping, addresses without a dotted host or
with a spelt-out sign.  Per kind, gradient-boosted trees learn from format and
context what base spans look like, and never see the very checks that the
patterns make (the plus, the check digit, the parts' range, the dotted host).
A held-out quarter of the documents calibrates the margin to a probability
and finds the least probability at which ``precision`` of the candidates are
base spans; candidates beyond it that touch no base span are added as
``soft_`` kinds.  Without enough examples, or where no probability reaches
the precision, nothing is added.

Everything covers all documents: borders are exact quantiles, trees are
fitted on every base span and candidate of the other three quarters, the
calibration and its threshold on every one of the held-out quarter.
Candidates that fall in the same bins are one cell; each level of the trees
is an aggregate over cells, and the driver sees sums by node, feature and bin.
Sums are of whole numbers, so the models don't depend on how rows are dealt
over tasks.

Defined cases: a null or empty text has no spans; texts are scanned whole, in
linear time; a repeated row has the same spans again; null ids stay null and
count as one document for the folds; of overlapping candidates the likeliest
is taken, of equally likely ones the first, then the longer; an empty table
gives an empty result; other columns, whatever their names, are ignored or,
by ``redact``, kept.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from civica.llm.common import doc_slices, id_and_text
from civica.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, *(f"soft_{k}" for k in KINDS))
# The rows of a kind and label count together as at most so many (all do count), so that neither label drowns the other.
WEIGHT = 20_000
PRECISION = 0.95
TREES, DEPTH, RATE, BINS, PENALTY = 40, 3, 0.2, 32, 1.0
# Trees that are walked again before the cells are written with their margins.
TREES_PER_WRITE = 8
NEWTON_STEPS = 20

_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
_DIGIT = re.compile(r"[0-9]")

# Generators: numbers with up to three separators between digits, hosts without a dot, "(at)" for the sign.
_NUMBER = re.compile(r"[(]?[0-9](?:[ ().\-/]{0,3}+[0-9])*+")
_PART = re.compile(r"[^ ]+")
_BARE_HOST = re.compile(r"@[A-Za-z0-9-]++(?!\.?[A-Za-z0-9-])")
_SPELT = re.compile(r" ?[\[(] ?at ?[\])] ?([A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]{1,63}){1,5})", re.I | re.A)
_SIGN = re.compile(r"@| ?[\[(] ?at ?[\])] ?", re.I | re.A)
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_RUN = re.compile(r"[0-9]+")
#: Words that stand before such data, in the languages of the corpus.
CUES = {"email": ("mail", "contact", "write", "kontakt", "correo"), "ip": ("ip", "address", "host", "server", "adresse"),
        "card": ("card", "visa", "carte", "karte", "tarjeta"), "phone": ("phone", "tel", "call", "fax", "mobile", "mobil", "telefon")}
FEATURES = ("digits", "chars", "groups", "longest", "first", "final", "spaces", "hyphens", "dots", "parens", "slashes", "distinct",
            "leading", "letters", "local", "before", "after", "cue", "letters_before", "digits_before", "digits_after",
            "line_start", "capitals")
NEAR = 24


def _within_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the patterns' matches, by kind and start.
    Every pattern advances past what it has read, so no run of characters is
    read more than a few times."""
    out = []
    end = seen = 0
    for m in _HOST.finditer(text):
        at = m.start()
        low = max(end, seen, text.rfind("@", seen, at) + 1)
        start = low + len(text[low:at].rstrip(_LOCAL))
        seen = at + 1
        if start < at:
            end = m.end()
            out.append((0, start, end))
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_within_255, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        s = m[0].rstrip(" ().-")
        if len(s) > 3 and 8 <= sum(map(str.isdigit, s)) <= 15:
            out.append((3, m.start(), m.start() + len(s)))
    return out


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of all that may be personal data; they may
    overlap."""
    seen = 0
    for m in _BARE_HOST.finditer(text):
        low = max(seen, text.rfind("@", seen, m.start()) + 1)
        start = low + len(text[low:m.start()].rstrip(_LOCAL))
        seen = m.start() + 1
        if start < m.start():
            yield 0, start, m.end()
    for m in _SPELT.finditer(text):
        low = max(0, m.start() - 64)
        start = low + len(text[low:m.start()].rstrip(_LOCAL))
        if start < m.start():
            yield 0, start, m.end()
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        spans = {m.span()} if m.end() - m.start() <= 40 else set()
        if " " in m[0]:
            spans |= {(m.start() + p.start(), m.start() + p.end()) for p in _PART.finditer(m[0]) if p.end() - p.start() >= 7}
        else:
            spans.add(m.span())
        for a, b in sorted(spans):
            s = text[a:b]
            digits = sum(map(s.count, "0123456789"))
            if _QUAD.fullmatch(s):
                yield 1, a, b
            if 13 <= digits <= 19:
                yield 2, a, b
            if 7 <= digits <= 15:
                yield 3, a, b


def _sort_of(c: str) -> float:
    if not c or c.isspace():
        return 0
    if c.isalpha():
        return 1
    return 2 if c.isdigit() else 3 if c in "\"'=:" else 4


def describe(text: str, kind: int, start: int, end: int) -> list[float]:
    """FEATURES of one span.  A plus before or in front of it isn't shown."""
    if text.startswith("+", start):
        start += 1
    front = start - 1 if start and text[start - 1] == "+" else start
    s, before, after = text[start:end], text[max(0, front - NEAR):front], text[end:end + NEAR]
    runs = [len(r) for r in _RUN.findall(s)] or [0]
    local = len(_SIGN.split(s, maxsplit=1)[0]) if kind == 0 else 0
    words = before.lower().split()
    cue = any(w.strip(".,:;()") in CUES[KINDS[kind]] for w in words[-3:])
    digit = next((c for c in s if c.isdigit()), "0")
    return [sum(runs), end - start, len(runs), max(runs), runs[0], runs[-1], s.count(" "), s.count("-"), s.count(".") if kind else 0,
            s.count("(") + s.count(")"), s.count("/"), len(set(s) & set("0123456789")), float(digit) if digit.isascii() else 0,
            sum(map(str.isalpha, s)), local, _sort_of(before[-1:]), _sort_of(after[:1]), float(cue),
            sum(map(str.isalpha, before)), sum(map(str.isdigit, before)), sum(map(str.isdigit, after)),
            float(not before or before[-1] == "\n"), sum(map(str.isupper, s))]


def judged_spans(text: str) -> list[tuple[int, int, int, bool, list[float]]]:
    """Base spans and the candidates that touch none, with their features."""
    base = base_spans(text)
    out = [(k, a, b, True, describe(text, k, a, b)) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.empty(0, np.int64)
    starts = np.array([a for a, _ in taken], np.int64)
    for k, a, b in candidates(text):
        i = int(np.searchsorted(starts, b))  # base spans that begin before its end
        if i and reach[i - 1] > a:
            continue
        out.append((k, a, b, False, describe(text, k, a, b)))
    return out


# --- boosted trees -----------------------------------------------------------

@dataclass(frozen=True)
class Boosted:
    """Complete trees of equal depth as arrays: per inner node a feature and
    a border (greater goes right), per leaf a value; then the calibration."""
    start: float
    feature: np.ndarray
    border: np.ndarray
    leaf: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0  # of the probability; above 1: nothing passes

    def walk(self, x: np.ndarray, tree: int, levels: int) -> np.ndarray:
        """The node that each row has come to after so many levels."""
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(levels):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.border[tree, node])
        return node

    def added(self, x: np.ndarray, margin: np.ndarray, trees: range) -> np.ndarray:
        """The margin with these trees added, one after the other."""
        inner = self.feature.shape[1]
        for t in trees:
            margin = margin + self.leaf[t, self.walk(x, t, (inner + 1).bit_length() - 1) - inner]
        return margin

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.added(x, np.full(len(x), self.start), range(len(self.leaf)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * self.margin(x) + self.offset)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def unsplit(good: float, bad: float, trees: int, depth: int) -> Boosted:
    """The model before its first split, from the weight of both labels."""
    share = (good + 1) / (good + bad + 2)
    inner = 2 ** depth - 1
    return Boosted(float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                   np.zeros((trees, inner + 1)))


def grain(weight: float) -> float:
    """Gradients are added as whole multiples of its inverse, a power of two:
    sums over rows of this weight are exact, in whatever order."""
    return 2.0 ** min(36, 52 - int(np.ceil(np.log2(weight + 2))))


def histogram(codes: np.ndarray, place: np.ndarray, width: int, margin: np.ndarray, good: np.ndarray, bad: np.ndarray,
              scale: float, bins: int) -> np.ndarray:
    """Gradients and curvatures of the logistic loss, times ``scale``, by
    node, feature and bin.  ``good`` and ``bad`` are a row's weights as either label."""
    p = _logistic(margin)
    g, h = np.rint((bad * p - good * (1 - p)) * scale), np.rint((good + bad) * p * (1 - p) * scale)
    out = np.empty((2, width, codes.shape[1], bins))
    for j in range(codes.shape[1]):
        key = place * bins + codes[:, j]
        out[:, :, j] = [np.bincount(key, v, width * bins).reshape(width, bins) for v in (g, h)]
    return out


def split(model: Boosted, tree: int, level: int, sums: np.ndarray, n_cuts: np.ndarray, rate: float, penalty: float) -> None:
    """Chooses the splits of one level from its histogram (borders are bin
    numbers) and, on the last level, the values of the leaves.  Of equal
    gains the first feature's lowest border is taken."""
    first, (_, width, d, bins) = 2 ** level - 1, sums.shape
    left = sums.cumsum(3)
    right = left[..., -1:] - left
    gain = left[0] ** 2 / (left[1] + penalty) + right[0] ** 2 / (right[1] + penalty) - left[0][..., -1:] ** 2 / (left[1][..., -1:] + penalty)
    gain[:, np.arange(bins) >= n_cuts[:, None]] = -np.inf
    gain = gain.reshape(width, -1)
    k = gain.argmax(1)
    better = gain[np.arange(width), k] > 1e-9
    model.feature[tree, first:first + width][better] = k[better] // bins
    model.border[tree, first:first + width][better] = k[better] % bins
    if first + width == model.feature.shape[1]:
        at = np.where(better, k, bins - 1)  # without a split, all rows go left
        rows = np.arange(width)
        for side, part in enumerate((left, right)):
            g, h = part.reshape(2, width, -1)[:, rows, at]
            model.leaf[tree, 2 * rows + side] = -rate * g / (h + penalty)


def unbinned(model: Boosted, cuts: list[np.ndarray]) -> Boosted:
    """The model with borders as values of the features."""
    border = np.full(model.border.shape, np.inf)
    for i in np.argwhere(np.isfinite(model.border)):
        border[tuple(i)] = cuts[model.feature[tuple(i)]][int(model.border[tuple(i)])]
    return replace(model, border=border)


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS,
          penalty: float = PENALTY, weight: np.ndarray | None = None) -> Boosted:
    """Newton boosting of the logistic loss, of rows in memory.  Values are
    binned at quantiles; each level of a tree takes one histogram of
    gradients per feature.  ``fit_kinds`` does the same of rows in Spark."""
    weight = np.ones(len(y)) if weight is None else weight
    cuts = []
    for column in x.T:
        order = np.argsort(column, kind="stable")
        total = np.cumsum(weight[order])
        cuts.append(np.unique([column[order][np.argmax(total > q * (total[-1] - 1))] for q in np.arange(1, bins) / bins]))
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)  # bin b: x <= cuts[b]
    good, bad = weight * y, weight * (1 - y)
    scale = grain(weight.sum())
    model = unsplit(good.sum(), bad.sum(), trees, depth)
    margin = np.full(len(y), model.start)
    for t in range(trees):
        for level in range(depth):
            place = model.walk(codes, t, level) - (2 ** level - 1)
            sums = histogram(codes, place, 2 ** level, margin, good, bad, scale, bins) / scale
            split(model, t, level, sums, np.array([len(c) for c in cuts]), rate, penalty)
        margin = model.added(codes, margin, range(t, t + 1))
    return unbinned(model, cuts)


def newton_terms(z: np.ndarray, good: np.ndarray, bad: np.ndarray, line: tuple[float, float], total: tuple[float, float]) -> np.ndarray:
    """What each margin adds to the gradient (2) and the curvature (3) of
    Platt's loss.  ``total`` is the weight of both labels over all rows."""
    p = _logistic(line[0] * z + line[1])
    g = (good + bad) * p - good * (total[0] + 1) / (total[0] + 2) - bad / (total[1] + 2)
    h = (good + bad) * p * (1 - p)
    return np.array([g * z, g, h * z * z, h * z, h])


def newton_step(line: tuple[float, float], sums: np.ndarray) -> tuple[float, float]:
    """A weak prior holds separable data."""
    grad = sums[:2] + np.array([line[0] - 1, line[1]])
    slope, offset = np.array(line) - np.linalg.solve(np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + np.eye(2), grad)
    return float(slope), float(offset)


def calibrated(model: Boosted, x: np.ndarray, y: np.ndarray, weight: np.ndarray, precision: float) -> Boosted:
    """Platt scaling of the margin by Newton steps, and the least probability
    from which on at least ``precision`` of the held-out weight is positive;
    of rows in memory, as ``calibrate_kinds`` does of rows in Spark."""
    z, good, bad = model.margin(x), weight * y, weight * (1 - y)
    if good.sum() < 1:
        return model
    line = 1.0, 0.0
    for _ in range(NEWTON_STEPS):
        line = newton_step(line, newton_terms(z, good, bad, line, (good.sum(), bad.sum())).sum(1))
    p = _logistic(line[0] * z + line[1])
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(good[order]) / np.cumsum(weight[order])
    last = np.flatnonzero(np.append(p[order][1:] != p[order][:-1], True) & (share >= precision))  # ties pass together
    return replace(model, slope=line[0], offset=line[1], threshold=float(p[order][last[-1]]) if len(last) else 2.0)


# --- Spark -------------------------------------------------------------------

_SPAN = "struct<kind: int, start: int, end: int, base: boolean, features: array<float>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                                 ("features", pa.list_(pa.float32()))]))


def _span_column(texts: list[str | None]) -> pa.Array:
    rows = [judged_spans(t) if t else [] for t in texts]
    flat = [s for r in rows for s in r]
    ends = np.cumsum([0, *map(len, rows)])
    x = np.array([s[4] for s in flat], np.float32).ravel()
    features = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x, pa.float32()))
    columns = [pa.array([s[i] for s in flat], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.bool_()))]
    spans = pa.StructArray.from_arrays([*columns, features], fields=list(_SPAN_TYPE.value_type))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


def with_candidates(docs: DataFrame, text_col: str, name: str, keep_text: bool) -> DataFrame:
    """The rows with their base spans and candidates in column ``name``."""
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, text_col):
            own = _span_column(part.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in fields], own], names=[*[f.name for f in fields], name])

    return docs.mapInArrow(scan, T.StructType([*fields, T.StructField(name, T._parse_datatype_string(f"array<{_SPAN}>"))]))


def _parts(b: pa.RecordBatch, kinds: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    kind = b.column("kind").to_numpy()
    for k in kinds:
        rows = np.flatnonzero(kind == k)
        if len(rows):
            yield k, rows


def _numbers(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).to_numpy(zero_copy_only=False)


def _codes(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, -1).astype(np.int64)


def _borders(train: DataFrame, weight: dict[tuple[int, bool], float]) -> dict[int, list[np.ndarray]]:
    """Per kind and feature, the distinct values at the exact quantiles of
    all rows' weight.  A window holds the distinct values of one feature,
    which are lengths and counts."""
    by_label = lambda b: F.sum(F.when(F.col("base") == b, 1).otherwise(0)).alias(f"n_{b}")
    values = train.select("kind", "base", F.posexplode("features").alias("j", "value")) \
        .groupBy("kind", "j", "value").agg(by_label(True), by_label(False))
    share = lambda over: sum(F.sum(f"n_{b}").over(over) * F.element_at(
        F.create_map(*[F.lit(x) for (k, l), w in weight.items() if l == b for x in (k, w)]), F.col("kind")) for b in (True, False))
    whole = Window.partitionBy("kind", "j")
    # Quantile i is the first value with more than i / BINS of the weight, less one, up to it.
    reached = F.least(F.lit(BINS - 1.0), F.ceil(BINS * F.col("upto") / F.greatest(F.col("all") - 1, F.lit(1e-9))).cast("double") - 1)
    values = values.select("kind", "j", "value", share(whole.orderBy("value")).alias("upto"), share(whole).alias("all")) \
        .withColumn("reached", reached)
    out = {k: [[] for _ in FEATURES] for k, _ in weight}
    before = F.coalesce(F.lag("reached").over(whole.orderBy("value")), F.lit(0.0))
    for r in values.withColumn("before", before).filter("reached > before").select("kind", "j", "value").collect():
        out[r["kind"]][r["j"]].append(r["value"])
    return {k: [np.sort(np.array(v, np.float64)) for v in columns] for k, columns in out.items()}


def _cells(flat: DataFrame, cuts: dict[int, list[np.ndarray]], models: dict[int, Boosted]) -> DataFrame:
    """Rows that fall in the same bins in all features are one cell: trees
    fitted on cells equal trees fitted on rows."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))
            codes = np.zeros(x.shape, np.uint8)
            for k, rows in _parts(b, cuts):
                codes[rows] = np.stack([np.searchsorted(c, x[rows, j], side="left") for j, c in enumerate(cuts[k])], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("base"), b.column("held"), pa.array(map(bytes, codes), pa.binary())],
                                             names=["kind", "base", "held", "code"])

    start = F.element_at(F.create_map(*[F.lit(x) for k, m in models.items() for x in (k, m.start)]), F.col("kind"))
    return flat.mapInArrow(code, "kind int, base boolean, held boolean, code binary") \
        .groupBy("kind", "base", "held", "code").agg(F.count(F.lit(1)).alias("n")).withColumn("margin", start)


def _level_sums(cells: DataFrame, models: dict[int, Boosted], weight: dict[tuple[int, bool], float], scale: dict[int, float],
                trees: range, level: int) -> dict[int, np.ndarray]:
    """The histogram of one level of tree ``trees.stop`` over all cells that
    aren't held out, per kind; ``trees`` aren't in the cells' margin yet.
    The driver sees one row per node, feature and bin."""
    shape = (2, 2 ** level, len(FEATURES), BINS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(shape) for k in models}
        for b in batches:
            codes, margin, base, n = _codes(b), _numbers(b, "margin"), _numbers(b, "base"), _numbers(b, "n")
            for k, rows in _parts(b, models):
                x, y = codes[rows], base[rows]
                place = models[k].walk(x, trees.stop, level) - (2 ** level - 1)
                total[k] += histogram(x, place, 2 ** level, models[k].added(x, margin[rows], trees), np.where(y, n[rows] * weight[k, True], 0),
                                      np.where(y, 0, n[rows] * weight[k, False]), scale[k], BINS)
        for k, (g, h) in total.items():
            at = np.flatnonzero(h.ravel() + np.abs(g.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(g.ravel()[at].astype(np.int64)),
                                              pa.array(h.ravel()[at].astype(np.int64))], names=["kind", "at", "g", "h"])

    rows = cells.filter("not held").select("kind", "base", "code", "n", "margin").mapInArrow(add, "kind int, at long, g long, h long")
    found = rows.groupBy("kind", "at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    kind, at = found["kind"].to_numpy(), found["at"].to_numpy()
    out = {}
    for k in models:
        own = kind == k
        s = np.zeros((2, shape[1] * shape[2] * shape[3]))
        s[0, at[own]], s[1, at[own]] = found["g"].to_numpy()[own], found["h"].to_numpy()[own]
        out[k] = s.reshape(shape) / scale[k]
    return out


def _with_margin(cells: DataFrame, models: dict[int, Boosted], trees: range) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, margin = _codes(b), _numbers(b, "margin").copy()
            for k, rows in _parts(b, models):
                margin[rows] = models[k].added(codes[rows], margin[rows], trees)
            yield b.set_column(b.schema.get_field_index("margin"), "margin", pa.array(margin))

    return cut_lineage(cells.mapInArrow(add, cells.schema), name="pii-cells")


def calibrate_kinds(margins: DataFrame, models: dict[int, Boosted], precision: float) -> dict[int, Boosted]:
    """``calibrated`` over ``kind, margin, good, bad``, all held-out rows by
    their margin.  A Newton step of all kinds is one aggregate."""
    labels = margins.groupBy("kind").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    totals = {r["kind"]: (float(r["good"]), float(r["bad"])) for r in labels.collect()}
    lines = {k: (1.0, 0.0) for k, (good, _) in totals.items() if good >= 1}
    if not lines:
        return models
    names = ["g0", "g1", "h0", "h1", "h2"]

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, rows in _parts(b, lines):
                parts = newton_terms(*(_numbers(b, c)[rows].astype(np.float64) for c in ("margin", "good", "bad")), lines[k], totals[k])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), k, np.int32)), *map(pa.array, parts)], names=["kind", *names])

    for _ in range(NEWTON_STEPS):
        # Decimal sums are the same in whatever order.
        steps = margins.mapInArrow(terms, "kind int, " + ", ".join(f"{c} double" for c in names)) \
            .groupBy("kind").agg(*[F.sum(F.col(c).cast("decimal(38,12)")).cast("double").alias(c) for c in names]).collect()
        old = dict(lines)
        lines |= {r["kind"]: newton_step(lines[r["kind"]], np.array([r[c] for c in names])) for r in steps}
        if all(np.allclose(lines[k], old[k], rtol=1e-13, atol=1e-13) for k in lines):
            break

    def probability(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, rows in _parts(b, lines):
                p = _logistic(lines[k][0] * _numbers(b, "margin")[rows] + lines[k][1])
                own = b.take(pa.array(rows))
                yield own.set_column(own.schema.get_field_index("margin"), "p", pa.array(p))

    # Sums from the highest probability down, in ranges of it: one row a range goes through the sum over all ranges.
    ranges = cut_lineage(margins.mapInArrow(probability, "kind int, p double, good long, bad long")
                         .groupBy("kind", "p").agg(F.sum("good").alias("good"), F.sum(F.col("good") + F.col("bad")).alias("n"))
                         .repartitionByRange("kind", F.desc("p")).withColumn("range", F.spark_partition_id()), name="pii-ranges")
    over = Window.partitionBy("kind").orderBy("range")
    above = ranges.groupBy("kind", "range").agg(F.sum("good").alias("good"), F.sum("n").alias("n")) \
        .select("kind", "range", *[(F.sum(c).over(over) - F.col(c)).alias(f"{c}_above") for c in ("good", "n")])
    own = Window.partitionBy("kind", "range").orderBy(F.desc("p"))
    share = (F.sum("good").over(own) + F.col("good_above")) / (F.sum("n").over(own) + F.col("n_above"))
    least = {r["kind"]: r["p"] for r in ranges.join(above, ["kind", "range"]).select("kind", "p", share.alias("share"))
             .filter(F.col("share") >= precision).groupBy("kind").agg(F.min("p").alias("p")).collect()}
    return models | {k: replace(models[k], slope=a, offset=b, threshold=least.get(k, 2.0)) for k, (a, b) in lines.items()}


def fit_kinds(rows: DataFrame, name: str, id_col: str, weight: float = WEIGHT, precision: float = PRECISION,
              least: int = 40) -> dict[int, Boosted]:
    """A model per kind with at least ``least`` base spans and one candidate
    to tell them from, fitted on all of them.  Each level of the trees, of all
    kinds, is one aggregate over the cells."""
    fold = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(4))
    flat = rows.select((fold == 0).alias("held"), F.explode(name).alias("s")).select("held", "s.kind", "s.base", "s.features")
    counts = {(r["kind"], r["base"], r["held"]): r["n"] for r in flat.groupBy("kind", "base", "held").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = {(k, b): counts.get((k, b, True), 0) + counts.get((k, b, False), 0) for k in range(len(KINDS)) for b in (True, False)}
    kinds = [k for k in range(len(KINDS)) if n[k, True] >= least and n[k, False]
             and (k, True, False) in counts and (k, False, False) in counts]
    if not kinds:
        return {}
    # Every row counts; the rows of a label together weigh no more than `weight` (and as they are in the calibration).
    each = {(k, b): min(1.0, weight / n[k, b]) for k in kinds for b in (True, False)}
    sums = {(k, b): each[k, b] * counts[k, b, False] for k, b in each}
    scale = {k: grain(sums[k, True] + sums[k, False]) for k in kinds}
    models = {k: unsplit(sums[k, True], sums[k, False], TREES, DEPTH) for k in kinds}
    flat = flat.filter(F.col("kind").isin(kinds))
    cuts = _borders(flat.filter("not held"), each)
    n_cuts = {k: np.array([len(c) for c in cuts[k]]) for k in kinds}
    cells, written = cut_lineage(_cells(flat, cuts, models), name="pii-cells"), 0
    for t in range(TREES):
        if t - written == TREES_PER_WRITE:
            cells, written = _with_margin(cells, models, range(written, t)), t
        for level in range(DEPTH):
            for k, s in _level_sums(cells, models, each, scale, range(written, t), level).items():
                split(models[k], t, level, s, n_cuts[k], RATE, PENALTY)
    cells = _with_margin(cells.filter("held"), models, range(written, TREES))
    label = lambda b: F.sum(F.when(F.col("base") == b, F.col("n")).otherwise(0))
    margins = cut_lineage(cells.groupBy("kind", "margin").agg(label(True).alias("good"), label(False).alias("bad")), name="pii-margins")
    return {k: unbinned(m, cuts[k]) for k, m in calibrate_kinds(margins, models, precision).items()}


def _selected(column: pa.Array, models: dict[int, Boosted]) -> list[list[tuple[int, int, int, float]]]:
    """Per row, (kind number, start, end, probability) of base spans and of
    the candidates that pass, by kind and start."""
    sizes = np.diff(column.offsets.to_numpy())
    spans = column.flatten()
    kind, start, end, base = (spans.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    p = np.where(base, 1.0, -1.0)
    if len(spans):
        x = spans.field(4).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))
        for k, m in models.items():
            rows = np.flatnonzero((kind == k) & ~base)
            if len(rows):
                q = m.probability(x[rows])
                p[rows] = np.where(q >= m.threshold, q, -1.0)
    out, at = [], 0
    for n in sizes.tolist():
        rows = [i for i in range(at, at + n) if p[i] >= 0]
        at += n
        done = [(int(kind[i]), int(start[i]), int(end[i]), 1.0) for i in rows if base[i]]
        taken: list[tuple[int, int]] = []  # disjoint, by start
        for i in sorted((i for i in rows if not base[i]), key=lambda i: (-p[i], start[i], -end[i], kind[i])):
            a, b = int(start[i]), int(end[i])
            k = bisect_left(taken, (b, -1))
            if not k or taken[k - 1][1] <= a:
                taken.insert(k, (a, b))
                done.append((len(KINDS) + int(kind[i]), a, b, float(p[i])))
        out.append(sorted(done))
    return out


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weight: float = WEIGHT,
              precision: float = PRECISION) -> DataFrame:
    """``doc_id, spans``: all personal data of every text, by kind and start.
    Texts are read once; their candidates wait in a table for the models."""
    src = id_and_text(docs, id_col, text_col)
    rows = cut_lineage(with_candidates(src, "text", "found", False), name="pii-candidates")
    models = fit_kinds(rows, "found", "doc_id", weight, precision)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in batches:
            spans = [[{"kind": ALL_KINDS[k], "start": x, "end": y, "score": p} for k, x, y, p in r] for r in _selected(b.column("found"), models)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    return rows.mapInArrow(select, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                   "spans array<struct<kind: string, start: int, end: int, score: double>>")


def pii_report(spans: DataFrame) -> DataFrame:
    """Counts per pattern, the digest of the pattern matches, all spans."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("spans", lambda s: ~s["kind"].startswith("soft_"))
    return spans.select("doc_id", *map(count, KINDS), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("long").alias("n_soft"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weight: float = WEIGHT,
           precision: float = PRECISION) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets;
    overlapping spans are replaced as one.  A null text stays null."""
    name = "_found"
    while name in docs.columns:
        name += "_"
    rows = cut_lineage(with_candidates(docs, text_col, name, True), name="pii-rows")
    models = fit_kinds(rows, name, id_col, weight, precision)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, text_col):
            texts = part.column(text_col).to_pylist()
            for i, found in enumerate(_selected(part.column(name), models)):
                if found:
                    out, end = [], 0
                    for k, a, b, _ in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
                        if a >= end:
                            out += [texts[i][end:a], f"[{ALL_KINDS[k].removeprefix('soft_').upper()}]"]
                        end = max(end, b)
                    texts[i] = "".join([*out, texts[i][end:]])
            at = part.schema.get_field_index(text_col)
            yield part.set_column(at, text_col, pa.array(texts, pa.string()))

    return rows.mapInArrow(clean, rows.schema).drop(name)

