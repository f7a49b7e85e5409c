"""Quality classifier: regularised quadratic discriminant analysis.

Each document becomes a vector of transformed statistics of its text.  Per
class, one grouped aggregate over the labelled rows gives count, sums and
cross products; the class covariance is shrunk towards the pooled one and
its diagonal.  A score is the logistic of the difference of two Gaussian
log-densities (Mahalanobis distances through cached Cholesky factors) plus
the log prior odds.

Defined cases: a null or empty text has the statistics of an empty text and
gets a score; a row whose id or label is null isn't learnt from; a repeated
labelled row counts as often as it occurs; without rows of one class, every
score is the smoothed share of label 1 among the labelled rows; texts of any
length are read whole; a score that equals the threshold is accepted; an empty
table gives an empty result; other columns are ignored, whatever their names,
or kept by ``keep_quality``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.llm.common import (CONTINUATION, SPACE, SYMBOL, ascii_words, byte_class, byte_counts, codes, doc_slices,
                               id_and_text, repeated_windows, sums, utf8)
from civica.session import cut_lineage

_UPPER = byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = byte_class(b"0123456789")
_COMMA, _STOP, _BANG, _PIPE, _LINE = (byte_class(x) for x in (b",;:", b".?", b"!", b"|", b"\n"))

FEW = 10
FEATURES = ("log_words", "word_length", "long_words", "short_words", "upper", "digits", "symbols", "commas", "stops",
            "bangs", "pipes", "distinct", "top_word", "repeated", "dup_lines", "line_words")


def text_features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text.  Shares are square-rooted and counts
    logged, which brings them nearer to normal distributions."""
    raw = utf8(column)
    n = len(raw)
    words, count = ascii_words(raw)
    ends = np.cumsum(count)
    starts = ends - count
    size = np.fromiter(map(len, raw), np.int64, n)
    space, more, symbols, upper, digit, comma, stop, bang, pipe, line = byte_counts(
        column, SPACE, CONTINUATION, SYMBOL, _UPPER, _DIGIT, _COMMA, _STOP, _BANG, _PIPE, _LINE)
    chars = np.maximum(size - more, 1)
    width = np.fromiter(map(len, words), np.int64, len(words))
    word = codes(words)
    doc = np.repeat(np.arange(n), count)
    key = word * n + doc
    pair = pd.factorize(key)[0]
    times = np.bincount(pair, minlength=1)
    owner = np.zeros(len(times), np.int64)
    owner[pair] = doc
    distinct = np.bincount(owner[: len(times)], minlength=n)[:n] if len(words) else np.zeros(n, np.int64)
    top = np.zeros(n, np.int64)
    if len(words):
        np.maximum.at(top, owner, times)
    dup = np.empty(n)
    for i, t in enumerate(raw):
        lines = [x for x in t.split(b"\n") if x.strip()]
        dup[i] = (len(lines) - len(set(lines))) / (len(lines) + 2)
    repeated = sums(repeated_windows(word, count, 3), starts, ends)
    # Shares of few words scatter widely: FEW words (and FEW characters for each) without the trait are added.
    word_share = lambda a: np.sqrt(a / (count + FEW))
    char_share = lambda a: np.sqrt(a / (chars + 6 * FEW))
    return np.column_stack([
        np.log1p(count), np.log((size - space - more + 5 * FEW) / (count + FEW)), word_share(sums(width > 12, starts, ends)),
        word_share(sums(width <= 3, starts, ends)), char_share(upper), char_share(digit), char_share(symbols),
        word_share(comma), word_share(stop), word_share(bang), word_share(pipe), 1 - (count - distinct) / (count + FEW),
        word_share(np.maximum(top - 1, 0)), word_share(repeated), np.sqrt(dup), np.log1p(count / (line + 1))])


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and one double column per feature."""
    src = id_and_text(docs, id_col, text_col)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches):
            x = text_features(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c) for c in x.T)],
                                             names=["doc_id", *FEATURES])

    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{f} double" for f in FEATURES)
    return src.mapInArrow(features, schema)


@dataclass(frozen=True)
class Gaussian:
    mean: np.ndarray
    inverse_factor: np.ndarray  # inverse of the Cholesky factor of the covariance
    log_norm: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.inverse_factor.T
        return self.log_norm - 0.5 * np.einsum("ij,ij->i", z, z)


@dataclass(frozen=True)
class Qda:
    prior: float  # smoothed share of label 1
    good: Gaussian | None
    bad: Gaussian | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.good is None or self.bad is None:
            return np.full(len(x), self.prior)
        logit = self.good.log_density(x) - self.bad.log_density(x) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def fit_qda(features: DataFrame, labels: DataFrame, label_col: str = "label", shrink_pooled: float = 0.1,
            shrink_diagonal: float = 0.05, ridge: float = 1e-4) -> Qda:
    """One aggregate over all labelled rows; the driver gets one row of sums
    per class.  ``labels`` has ``doc_id`` and a 0/1 label; rows of any other
    label are not learnt from."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    rows = (features.join(labels.select("doc_id", F.col(label_col).alias("_label")), "doc_id")
            .filter("_label in (0, 1)").groupBy("_label")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)],
                 *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect())
    stats = {}
    for r in rows:
        n = r["n"]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / n
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / n - mean[i] * mean[j]
        stats[r["_label"]] = (n, mean, cov)
    total = sum(n for n, _, _ in stats.values())
    prior = ((stats[1][0] if 1 in stats else 0) + 1) / (total + 2)
    if len(stats) < 2:
        return Qda(prior, None, None)
    pooled = sum(n * cov for n, _, cov in stats.values()) / total

    def gaussian(n: int, mean: np.ndarray, cov: np.ndarray) -> Gaussian:
        weight = shrink_pooled + (1 - shrink_pooled) * d / (n + d)  # few rows lean on the pooled covariance
        cov = (1 - weight) * cov + weight * pooled
        cov = (1 - shrink_diagonal) * cov + shrink_diagonal * np.diag(np.diag(cov)) + ridge * np.eye(d)
        factor = np.linalg.cholesky(cov)
        return Gaussian(mean, np.linalg.inv(factor), float(-np.log(np.diag(factor)).sum()))

    return Qda(prior, gaussian(*stats[1]), gaussian(*stats[0]))


def score_features(features: DataFrame, model: Qda) -> DataFrame:
    """``doc_id, score``: the probability of label 1."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return features.mapInArrow(scores, f"doc_id {features.schema['doc_id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "label", **options) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``, learnt from ``labels``."""
    features = cut_lineage(quality_features(docs, id_col, text_col), name="quality-features")
    return score_features(features, fit_qda(features, labels, label_col, **options))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "label", **options) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, as they
    are.  The rows are written once beside their statistics, so no text is
    looked at twice or moved between tasks."""
    name = "_statistics"
    while name in docs.columns:
        name += "_"

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, text_col):
            x = text_features(part.column(text_col))
            own = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*part.schema.names, name])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    rows = cut_lineage(docs.mapInArrow(append, schema), name="quality-rows")
    features = rows.select(F.col(f"`{id_col}`").alias("doc_id"), *[F.col(name)[i].alias(f) for i, f in enumerate(FEATURES)])
    model = fit_qda(features, labels, label_col, **options)
    return rows.mapInArrow(keep, rows.schema).drop(name)
