"""Benchmark decontamination with training suffix arrays.

Each slice of the documents is a shard with its own suffix array over words.
Every suffix of the benchmark texts is binary-searched in every shard; the
matching suffixes give the verbatim matches and where they are.

Only document positions that can begin a match enter the array: words are
numbered by the benchmark's vocabulary, and a match of k words needs k
numbered words of which every neighbouring pair is a neighbouring pair of the
benchmark too.  The array is ordered by as many words as the longest window
has; a longer match is a chain of matches at neighbouring positions, and is
reported at its full length.  Equal windows are searched for once, so a word
that is repeated in a document and in an item makes no pairs of all places.

The benchmark reaches the tasks in blocks, bounded by their text and by the
size of their index.  Each has its own pass over the documents and is dropped
before the next is built; results of blocks are united by row.

Defined cases: a null or text without words has no windows and is never hit;
a benchmark text with fewer words than the window, but not none, is one
window; texts of any length are searched whole, in memory that grows with
their length; of matches at one place items come in the benchmark's order;
repeated rows get the same result (a null or repeated id is a row of its own,
whatever the number of blocks); without documents there are no rows, without a
benchmark nothing is hit; other columns are ignored, whatever their names, or
kept by ``remove_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civica.llm.common import doc_slices, id_and_text, utf8
from civica.session import cut_lineage

#: ASCII other than a-z, A-Z and 0-9 separates words; A-Z is lower-cased.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def text_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SuffixIndex:
    """The suffixes of one block of benchmark texts, ready to be searched for
    in the suffix array of any shard."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        owners: dict[tuple[bytes, ...], list] = {}
        for k, t in items:
            if words := tuple(text_words(t)):
                owners.setdefault(words, []).append(k)
        self.owners = list(owners.values())  # items of equal words are searched for once
        self.number: dict[bytes, int] = {}
        for words in owners:
            for w in words:
                self.number.setdefault(w, len(self.number) + 1)
        rows = [np.array([self.number[w] for w in words], np.int64) for words in owners]
        self.width = max([min(window, len(r)) for r in rows], default=0)
        if not rows:
            return
        # Of every window (all of a shorter text): the item, the place, the number of words.
        self.item = np.concatenate([np.full(max(1, len(r) - window + 1), i) for i, r in enumerate(rows)])
        self.place = np.concatenate([np.arange(max(1, len(r) - window + 1)) for r in rows])
        length = np.minimum(window, np.array([len(r) for r in rows]))[self.item]
        self.least = int(length.min())
        flat = np.concatenate([np.concatenate([r, np.zeros(self.width, np.int64)]) for r in rows])
        start = np.cumsum([0, *[len(r) + self.width for r in rows[:-1]]])[self.item] + self.place
        words = flat[start[:, None] + np.arange(self.width)]
        beyond = np.arange(self.width) >= length[:, None]
        # Windows of equal words share a key; each key is searched for once.
        self.low, one, self.key = np.unique(self.keys(np.where(beyond, 0, words)), return_index=True, return_inverse=True)
        self.high = self.keys(np.where(beyond, 0xFFFFFFFF, words)[one])
        self.length = length[one]
        self.full = self.length == window
        # Windows by key, then by the key of the window before them in their item (-2: none).
        self.before = np.where(self.place > 0, np.append(-2, self.key[:-1]), -2)
        self.by_key = np.lexsort((self.before, self.key))
        self.key_start = np.searchsorted(self.key[self.by_key], np.arange(len(self.low) + 1))
        base = len(self.number) + 1
        self.base = base
        self.pairs = np.unique(np.concatenate([r[:-1] * base + r[1:] for r in rows]))

    @staticmethod
    def keys(words: np.ndarray) -> np.ndarray:
        """Rows of word numbers as byte strings that sort as the rows do."""
        if not words.size:
            return np.empty(len(words), "S1")
        return np.ascontiguousarray(words.astype(">u4")).view(f"S{4 * words.shape[1]}").ravel()

    def candidates(self, code: np.ndarray) -> np.ndarray:
        """Positions where at least ``least`` words could match."""
        if self.least == 1:
            return np.flatnonzero(code)
        pair = code[:-1] * self.base + code[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1) if len(self.pairs) else None
        linked = (self.pairs[at] == pair) & (code[:-1] > 0) & (code[1:] > 0) if at is not None else np.zeros(len(pair), bool)
        # The run of linked pairs that begins at each position.
        stop = np.flatnonzero(~np.append(linked, False))
        run = stop[np.searchsorted(stop, np.arange(len(code)))] - np.arange(len(code))
        return np.flatnonzero(run >= self.least - 1)

    def matches(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key number, document position) of every verbatim match of a window,
        where ``code`` has the numbered words of a shard with zeros between
        texts.  A position has one key of full length at most, and one of each
        shorter length."""
        none = np.empty(0, np.int64)
        if not self.width or not len(code):
            return none, none
        at = self.candidates(code)
        if not len(at):
            return none, none
        padded = np.concatenate([code, np.zeros(self.width, np.int64)])
        suffix = self.keys(padded[at[:, None] + np.arange(self.width)])
        order = np.argsort(suffix, kind="stable")  # the suffix array of the shard
        array = suffix[order]
        first = np.searchsorted(array, self.low, "left")
        last = np.searchsorted(array, self.high, "right")
        count = np.maximum(last - first, 0)
        key = np.repeat(np.arange(len(count)), count)
        entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return key, at[order[entry]]

    def longest(self, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window number, document position, words) of every maximal verbatim
        match, from the matches of keys.

        A maximal match begins where the window before it isn't matched at the
        position before; such beginnings are listed directly, so that a word
        repeated n and m times gives n + m of them and no n * m pairs.  Their
        lengths are found by comparing ranks of stretches of 2, 4, 8 … windows,
        which positions and the windows of the items in question share."""
        full = self.full[key]
        short_window, short_at = _ranges(self.by_key, self.key_start[key[~full]], self.key_start[key[~full] + 1], at[~full])
        words = [self.length[self.key[short_window]]]
        key, at = key[full], at[full]
        order = np.argsort(at)
        key, at = key[order], at[order]
        if not len(at):
            return short_window, short_at, words[0]
        linked = np.append(False, at[1:] == at[:-1] + 1)
        previous = np.where(linked, np.append(-1, key[:-1]), -1)
        lo, hi = self.key_start[key], self.key_start[key + 1]
        # Windows of this key that follow the previous position's key go on, all others begin here.
        sort = self.key[self.by_key] * (len(self.low) + 2) + self.before[self.by_key] + 2
        wanted = key * (len(self.low) + 2) + previous + 2
        skip_lo = np.where(linked, np.searchsorted(sort, wanted, "left"), hi)
        skip_hi = np.where(linked, np.searchsorted(sort, wanted, "right"), hi)
        place = np.arange(len(at))
        w1, p1 = _ranges(self.by_key, lo, skip_lo, place)
        w2, p2 = _ranges(self.by_key, skip_hi, hi, place)
        window, here = np.concatenate([w1, w2]), np.concatenate([p1, p2])
        # One sequence of keys: positions with a gap after each run, then the items in question.
        chosen = np.zeros(len(self.owners), bool)
        chosen[self.item[window]] = True
        own = np.flatnonzero(chosen[self.item])
        gap_doc = np.cumsum(~linked) - 1
        gap_item = np.cumsum(self.place[own] == 0) - 1
        doc_at = place + gap_doc
        item_at = np.full(len(self.key), -1)
        item_at[own] = doc_at[-1] + 2 + np.arange(len(own)) + gap_item
        size = int(item_at[own[-1]]) + 1
        rank = -1 - np.arange(size)  # gaps: like nothing else
        rank[doc_at] = key
        rank[item_at[own]] = self.key[own]
        levels, step = [rank], 1
        while step < int(self.place[own].max()) + 1:
            low = levels[-1] - levels[-1].min()
            after = np.concatenate([low[step:], low.max() + 1 + np.arange(min(step, size))])[:size]
            levels.append(np.unique(low * (int(after.max()) + 1) + after, return_inverse=True)[1])
            step *= 2
        a, b, run = item_at[window], doc_at[here], np.zeros(len(window), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = (a < size) & (b < size)
            same = np.zeros(len(a), bool)
            same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
            a, b, run = a + same * (1 << k), b + same * (1 << k), run + same * (1 << k)
        words.append(run + self.length[self.key[window]] - 1)
        return np.concatenate([short_window, window]), np.concatenate([short_at, at[here]]), np.concatenate(words)


def _ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[low:high]`` of every range, each with the range's tag."""
    count = np.maximum(high - low, 0)
    entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return values[entry], np.repeat(tag, count)


def _shard(index: SuffixIndex, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbered words of a shard, with a zero after each text; where each
    text begins; words per text."""
    number, parts, count = index.number.get, [], np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = text_words(t)
        count[i] = len(words)
        parts += [number(w, 0) for w in words]
        parts.append(0)
    return np.array(parts, np.int64), np.cumsum(count + 1) - count - 1, count


RESULT = "n_words long, hits array<struct<start: long, end: long>>, items array<{item}>, " \
    "longest long, matches array<struct<item: {item}, item_start: long, start: long, words: long>>"


def _united(start: np.ndarray, end: np.ndarray, text: np.ndarray, n: int) -> list[list[tuple[int, int]]]:
    """The spans of each of ``n`` texts, touching ones as one."""
    order = np.lexsort((start, text))
    start, end, text = start[order], end[order], text[order]
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if not len(start):
        return out
    shift = text * (int(end.max()) + 1)  # texts one behind the other, so that one running maximum serves all
    reach = np.maximum.accumulate(end + shift)
    head = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (start[1:] + shift[1:] > reach[:-1])]))
    last = np.append(head[1:], len(start)) - 1
    for t, a, b in zip(text[head].tolist(), start[head].tolist(), (reach[last] - shift[last]).tolist()):
        out[t].append((a, b))
    return out


def _found(index: SuffixIndex, texts: list[bytes]):
    """Words per text, the united spans of matched windows, and (key, text,
    place) of the matches of keys."""
    code, starts, count = _shard(index, texts)
    key, at = index.matches(code)
    text = np.searchsorted(starts, at, "right") - 1
    length = index.length[key] if len(key) else key
    place = at - starts[text] if len(at) else at
    return count, _united(place, place + length, text, len(texts)), key, at, text, starts


def _items(index: SuffixIndex, key: np.ndarray, at: np.ndarray, text: np.ndarray, n: int) -> list[list]:
    """The items with a matched window, per text, in the order of their first."""
    out: list[list] = [[] for _ in range(n)]
    if not len(key):
        return out
    order = np.lexsort((at, key, text))
    key, at, text = key[order], at[order], text[order]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])
    window, entry = _ranges(index.by_key, index.key_start[key[once]], index.key_start[key[once] + 1], np.flatnonzero(once))
    item = index.item[window]
    order = np.lexsort((item, at[entry], text[entry]))
    seen = set()
    for t, i in zip(text[entry][order].tolist(), item[order].tolist()):
        if (t, i) not in seen:
            seen.add((t, i))
            out[t] += index.owners[i]
    return [list(dict.fromkeys(x)) for x in out]


def _scanner(index: SuffixIndex, kind: pa.DataType, places: bool):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    match = pa.list_(pa.struct([("item", kind), ("item_start", pa.int64()), ("start", pa.int64()), ("words", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches):
            n = part.num_rows
            count, hits, key, at, text, starts = _found(index, utf8(part.column("text")))
            longest = np.zeros(n, np.int64)
            matches: list[list] = [[] for _ in range(n)]
            if len(key):
                window, begin, words = index.longest(key, at)
                own = np.searchsorted(starts, begin, "right") - 1
                np.maximum.at(longest, own, words)
                if places:
                    order = np.lexsort((index.place[window], index.item[window], begin))
                    for t, w, p, k in zip(own[order].tolist(), window[order].tolist(), (begin - starts[own])[order].tolist(), words[order].tolist()):
                        matches[t] += [{"item": i, "item_start": int(index.place[w]), "start": p, "words": k} for i in index.owners[index.item[w]]]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(count), pa.array([[{"start": a, "end": b} for a, b in h] for h in hits], span),
                pa.array(_items(index, key, at, text, n), pa.list_(kind)), pa.array(longest), pa.array(matches, match),
            ], names=["doc_id", "n_words", "hits", "items", "longest", "matches"])

    return scan


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int,
                index_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark in blocks of at most ``block_bytes`` of text and
    ``index_bytes`` of index (and one longer item), so that what the driver
    and a task get at once is bounded."""
    # Of a word at most one window: two keys of four bytes a word, and three numbers.
    words = F.regexp_count("text", F.lit(WORD))
    index = F.ceil(words * F.lit((8 * window + 24) * block_bytes / index_bytes))
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .filter("text is not null").withColumn("size", F.greatest(F.octet_length("text"), index).cast("long"))
    total = items.agg(F.sum("size")).first()[0] or 0
    if total <= block_bytes:
        yield [(r["item"], r["text"].encode()) for r in items.collect()]
        return
    blocks = -(-2 * total // block_bytes)
    # Items hashed to buckets, long ones apart; the running size within a bucket cuts its blocks.
    sized = items.withColumn("bucket", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    run = Window.partitionBy("bucket").orderBy("item", "text").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut_lineage(sized.withColumn("block", F.floor((F.sum("size").over(run) - 1) / F.lit(block_bytes)))
                      .drop("size"), name="benchmark-blocks")
    for key in cut.select("bucket", "block").distinct().toLocalIterator():
        rows = cut.filter((F.col("bucket") == key["bucket"]) & (F.col("block") == key["block"])).collect()
        yield [(r["item"], r["text"].encode()) for r in rows]


def _read_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int, index_bytes: int):
    """(the only block or None, all blocks)"""
    blocks = item_blocks(benchmark, item_col, text_col, window, block_bytes, index_bytes)
    first = list(islice(blocks, 2))
    return (first[0] if len(first) == 1 else None), chain(first, blocks)


def suffix_matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   block_bytes: int = 16 << 20, index_bytes: int = 128 << 20, places: bool = True) -> DataFrame:
    """Per document: its words, the word spans covered by windows of the
    benchmark, the items they belong to, the words of the longest verbatim
    match, and, with ``places``, every maximal match (item, place in the item,
    place in the document, words)."""
    only, blocks = _read_blocks(benchmark, item_col, item_text_col, window, block_bytes, index_bytes)
    return _matches(id_and_text(docs, id_col, text_col), only, blocks, window, benchmark.schema[item_col].dataType, places)


def _matches(src: DataFrame, only, blocks, window: int, item_kind, places: bool) -> DataFrame:
    kind = item_kind.simpleString()
    empty = src.sparkSession.createDataFrame([], f"item {kind}").toArrow().schema.field("item").type

    def scan(rows: DataFrame, block) -> DataFrame:
        schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + RESULT.format(item=kind)
        return rows.mapInArrow(_scanner(SuffixIndex(block, window), empty, places), schema)

    if only is not None:
        return scan(src, only)
    # Rows are numbered once, so that every pass means the same row by a number, and written block by block.
    rows = cut_lineage(src.withColumn("row", F.monotonically_increasing_id()), name="suffix-rows")
    numbered = rows.select(F.col("row").alias("doc_id"), "text")
    parts = [cut_lineage(scan(numbered, block), name="suffix-matches") for block in blocks]
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    merged = union.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
                                         F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                                         F.max("longest").alias("longest"), F.flatten(F.collect_list("matches")).alias("matches"))
    step = F.aggregate(
        F.array_sort("hits"), F.array().cast("array<struct<start: long, end: long>>"),
        lambda done, h: F.when(
            (F.size(done) > 0) & (h["start"] <= F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["end"], h["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(h))))
    merged = merged.withColumn("hits", step).withColumnRenamed("doc_id", "row")
    return rows.select("row", "doc_id").join(merged, "row").select("doc_id", "n_words", "hits", "items", "longest", "matches")


def contamination(matches: DataFrame, numerator: int = 1, denominator: int = 20) -> DataFrame:
    """Adds ``n_hit`` (words covered) and ``contaminated``: at least
    numerator/denominator of the words are covered, and one is."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["end"] - h["start"])
    return matches.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(denominator) * F.col("n_hit") >= F.lit(numerator) * F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id",
                        text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                        block_bytes: int = 16 << 20, index_bytes: int = 128 << 20, numerator: int = 1,
                        denominator: int = 20) -> DataFrame:
    """The documents that aren't contaminated, as they are.  Each row is
    judged by its own text, whatever its id.  One block of the benchmark
    filters the rows as they pass; for several the rows are numbered."""
    only, blocks = _read_blocks(benchmark, item_col, item_text_col, window, block_bytes, index_bytes)
    if only is None:
        name = "_row"
        while name in docs.columns:
            name += "_"
        rows = cut_lineage(docs.withColumn(name, F.monotonically_increasing_id()), name="suffix-documents")
        found = _matches(id_and_text(rows, name, text_col), only, blocks, window, benchmark.schema[item_col].dataType, False)
        bad = contamination(found, numerator, denominator).filter("contaminated").select(F.col("doc_id").alias(name))
        return rows.join(bad, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    index = SuffixIndex(only, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, text_col):
            count, hits, *_ = _found(index, utf8(part.column(text_col)))
            n_hit = np.array([sum(b - a for a, b in h) for h in hits], np.int64)
            yield part.filter(pa.array((n_hit == 0) | (denominator * n_hit < numerator * count)))

    return docs.mapInArrow(keep, docs.schema)
