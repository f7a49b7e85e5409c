"""Helpers shared by the training-data operators.

Python runs on Arrow record batches that Spark has partitioned.  A task holds
one slice of a few megabytes of text at a time, whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, null_text: str | None = "") -> DataFrame:
    """The two input columns under fixed names, so that other columns of the
    table can't clash.  A null text becomes ``null_text``."""
    text = F.col(f"`{text_col}`").cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))


def doc_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
               slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of about ``slice_bytes`` of text.  A longer
    text is a slice of its own; no text is ever cut."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.maximum(np.cumsum(size, dtype=np.int64) - 1, 0) // slice_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def ascii_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts, and their number per text.
    ``bytes.split()`` splits at exactly these six characters."""
    flat: list[bytes] = []
    count = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.split()
        count[i] = len(w)
        flat += w
    return flat, count


def codes(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers from 0."""
    if not words:
        return np.empty(0, np.int64)
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[starts[i]:ends[i]] for every i."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def repeated_windows(word: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """For every word, whether it lies in a window of ``size`` words that
    occurs twice or more in its own text (the first one included)."""
    n = len(word)
    hit = np.zeros(n, bool)
    if n < size:
        return hit
    doc = np.repeat(np.arange(len(count)), count)
    key = word
    for k in range(1, size):
        key = pd.factorize(key[: n - k] * (int(word.max()) + 1) + word[k:])[0].astype(np.int64)
    inside = np.flatnonzero(doc[: n - size + 1] == doc[size - 1:])
    if not len(inside):
        return hit
    group = pd.factorize(key[inside] * len(count) + doc[inside])[0]
    twice = inside[np.bincount(group)[group] > 1]
    for k in range(size):
        hit[twice + k] = True
    return hit


def byte_counts(column: pa.Array, *classes: np.ndarray) -> list[np.ndarray]:
    """For each class (a table of 256 truth values), its bytes per text."""
    texts = utf8(column)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(texts), np.uint8)
    return [sums(table[data], ends - size, ends) for table in classes]


def byte_class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


SPACE = byte_class(b" \t\n\x0b\x0c\r")
CONTINUATION = byte_class(bytes(range(0x80, 0xC0)))
SYMBOL = byte_class(b"#*$%&|<>")


def held_out(id_col: str, modulus: int, remainder: int):
    """Whether crc32 of the id, as text, leaves the remainder.  A null id is
    not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
