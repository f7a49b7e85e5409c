"""Best-fit packing with a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; full pieces are
sequences of their own.  The others are dealt by hash into blocks of about
``block_items``.  Every block is solved on several islands: a population of
packings evolves by crossover (whole well-filled bins of one parent go into
the other, bins that hold a copy of their documents are dissolved, displaced
documents are best-fitted) and by dissolving badly filled bins.  After each
epoch an island's elite moves to the next island of its block.  A packing
that meets the lower bound can't be improved and ends the block's search.

Bins of a block that stay badly filled are dissolved, and their pieces go to
blocks of the next level, until one block is left or dissolving gains
nothing.  What one task holds is a block, whatever the size of the table.

Defined cases: a null or empty text has the end token only; a text of any
length is encoded whole and cut into pieces; every row is packed, repeated
rows and null ids included; of bins with equal room the latest is taken; an
empty table packs to nothing; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.common import doc_slices, id_and_text
from civica.llm.vocab import TOKEN_SLICE_BYTES, tokenizers_encoder
from civica.session import cut_lineage


@dataclass(frozen=True)
class Search:
    """Settings of the search of one block.  ``slack``: free tokens up to
    which a bin counts as well filled.  ``last_generations``: for the last
    block, whose bins no later level can improve."""

    capacity: int = 1024
    block_items: int = 4096
    islands: int = 2
    epochs: int = 3
    generations: int = 10
    last_generations: int = 150
    population: int = 10
    inject: float = 0.05
    slack: int = 8


def cut_pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((a, capacity) for a in range(first, length, capacity))]


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and
    ``uid``, a number of its own once the rows are written."""
    src = id_and_text(docs, id_col, text_col)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizers_encoder(vocabulary, True)
        uid = TaskContext.get().partitionId() << 36
        end = np.array([end_id], "<u4").tobytes()
        for part in doc_slices(batches, slice_bytes=TOKEN_SLICE_BYTES):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.encode(part.column("text"))):
                ids += end
                for k, (a, n) in enumerate(cut_pieces(len(ids) // 4, capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(memoryview(ids)[4 * a: 4 * (a + n)]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(np.arange(uid, uid + len(row)))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "uid"])
            uid += len(row)
        encoder.forget()

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, uid long")


def lower_bound(size: np.ndarray, capacity: int) -> int:
    return max(-(-int(size.sum()) // capacity), int((2 * size > capacity).sum()))


def best_fit(size: np.ndarray, items: np.ndarray, bin_of: np.ndarray, free: list[int], capacity: int) -> None:
    """Puts ``items``, in their order, into the fullest bin that has room, or
    into a new one; changes ``bin_of`` and ``free``."""
    by_free: dict[int, list[int]] = {}
    mask = 0  # bit f: a bin with f free tokens is at hand
    for b in np.flatnonzero(free).tolist():
        by_free.setdefault(free[b], []).append(b)
    for f in by_free:
        mask |= 1 << f
    for i, s in zip(items.tolist(), size[items].tolist()):
        room = mask >> s
        if room:
            f = s + (room & -room).bit_length() - 1
            bins = by_free[f]
            b = bins.pop()
            if not bins:
                mask &= ~(1 << f)
        else:
            b, f = len(free), capacity
            free.append(capacity)
        bin_of[i] = b
        f -= s
        free[b] = f
        if f:
            by_free.setdefault(f, []).append(b)
            mask |= 1 << f


def tidy(bin_of: np.ndarray) -> np.ndarray:
    """Bins numbered from 0 without gaps, in their order."""
    return (np.cumsum(np.bincount(bin_of) > 0) - 1)[bin_of]


def chosen_bins(bin_of: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Whether each item lies in one of the bins."""
    marked = np.zeros(int(bin_of.max()) + 1, bool)
    marked[bins] = True
    return marked[bin_of]


def fitness(size: np.ndarray, bin_of: np.ndarray, capacity: int) -> float:
    """Mean squared fill of the bins."""
    fill = np.bincount(bin_of, weights=size)
    return float(np.mean((fill / capacity) ** 2))


def exchange(size: np.ndarray, bin_of: np.ndarray, displaced: list[int], free: list[int]) -> list[int]:
    """Displaced items take the place of smaller ones where that fills a bin
    further; changes ``bin_of`` and ``free``, and returns who is displaced
    now.  Each swap raises a bin's fill by what it lowers the displaced sum."""
    waiting = sorted((int(size[i]), i) for i in displaced)
    # Swaps only fill bins: those that are full now need no look.
    open_ = np.flatnonzero((bin_of >= 0) & np.append(np.array(free, np.int64) > 0, False)[bin_of])
    for i, b, own in zip(open_.tolist(), bin_of[open_].tolist(), size[open_].tolist()):
        if not free[b]:
            continue
        k = bisect_right(waiting, (own + free[b], len(size))) - 1
        if k >= 0 and waiting[k][0] > own:
            new, j = waiting.pop(k)
            bin_of[j], bin_of[i] = b, -1
            free[b] -= new - own
            insort(waiting, (own, i))
    return [i for _, i in waiting]


def _refit(size: np.ndarray, bin_of: np.ndarray, displaced: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Exchanges, then best-fits, the displaced items, large ones first (a
    little shuffled)."""
    child = bin_of.copy()
    child[displaced] = -1
    stay = child >= 0
    child[stay] = tidy(child[stay]) if stay.any() else -1
    fill = np.bincount(child[stay], weights=size[stay]).astype(np.int64) if stay.any() else np.empty(0, np.int64)
    free = (capacity - fill).tolist()
    displaced = np.array(exchange(size, child, displaced.tolist(), free), np.int64)
    order = displaced[np.argsort(-size[displaced] * rng.uniform(0.9, 1.1, len(displaced)), kind="stable")]
    best_fit(size, order, child, free, capacity)
    return child


def crossover(size: np.ndarray, giver: np.ndarray, taker: np.ndarray, s: Search, rng) -> np.ndarray:
    """Whole well-filled bins of ``giver`` go into ``taker``."""
    fill = np.bincount(giver, weights=size)
    good = np.flatnonzero(fill >= s.capacity - s.slack)
    if not len(good):
        good = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 10)]
    chosen = rng.choice(good, max(1, int(s.inject * len(good))), replace=False)
    brought = chosen_bins(giver, chosen)
    dissolved = chosen_bins(taker, taker[brought])
    child = taker.copy()
    child[brought] = giver[brought] + taker.max() + 1
    return _refit(size, child, np.flatnonzero(dissolved & ~brought), s.capacity, rng)


def mutate(size: np.ndarray, bin_of: np.ndarray, s: Search, rng) -> np.ndarray:
    """Dissolves the worst bins and a few others."""
    fill = np.bincount(bin_of, weights=size)
    worst = np.argsort(fill, kind="stable")[: max(1, len(fill) // 50)]
    other = rng.choice(len(fill), min(len(fill), max(2, len(fill) // 25)), replace=False)
    return _refit(size, bin_of, np.flatnonzero(chosen_bins(bin_of, np.append(worst, other))), s.capacity, rng)


def evolve(size: np.ndarray, population: list[np.ndarray], s: Search, rng) -> list[np.ndarray]:
    """The population after some generations, best first; without one, it
    begins with best-fit decreasing and shuffled variants of it."""
    bound = lower_bound(size, s.capacity)
    rank = lambda p: (int(p.max()) + 1, -fitness(size, p, s.capacity))
    everything = np.arange(len(size))
    if not population:
        first = np.empty(len(size), np.int64)
        best_fit(size, np.argsort(-size, kind="stable"), first, [], s.capacity)
        population = [first]
    population = sorted(population, key=rank)
    while len(population) < s.population and population[0].max() + 1 > bound:
        population.append(_refit(size, np.full(len(size), -1), everything, s.capacity, rng))
    for _ in range(s.generations):
        if population[0].max() + 1 <= bound:
            return population[:1]
        pick = rng.permutation(len(population))
        children = [crossover(size, population[a], population[b], s, rng) for a, b in zip(pick, np.roll(pick, 1)) if a != b]
        children.append(mutate(size, population[0], s, rng))
        population = sorted([*population, *children], key=rank)[: s.population]
    return population


def _islands(s: Search, epoch: int):
    """One row per block and island: lengths, population and migrants in,
    population and the number of bins out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, bins, done = [], [], []
            for r in batch.to_pylist():
                size = np.array(r["sizes"], np.int64)
                population = [np.array(p, np.int64) for p in [*(r["population"] or []), *(r["migrants"] or [])]]
                rng = np.random.default_rng([r["block"] & 0xFFFFFFFF, r["island"], epoch])
                population = evolve(size, population, s, rng)
                out.append([p.tolist() for p in population])
                bins.append(int(population[0].max()) + 1)
                done.append(bins[-1] <= lower_bound(size, s.capacity))
            keep = [batch.column(c) for c in ("block", "island", "uids", "sizes")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(out, pa.list_(pa.list_(pa.int32()))), pa.array(bins, pa.int32()), pa.array(done)],
                names=["block", "island", "uids", "sizes", "population", "bins", "done"])
        pa.default_memory_pool().release_unused()

    return run


_STATE = "block long, island int, uids array<long>, sizes array<int>, population array<array<int>>, bins int, done boolean"


def solve_blocks(items: DataFrame, blocks: int, s: Search) -> DataFrame:
    """``block, uids, sizes, assignment``: the best packing of each block of
    ``items`` (``uid, length``)."""
    start = items.select(F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block"), "uid", "length") \
        .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("all")) \
        .select("block", F.col("all.uid").alias("uids"), F.col("all.length").cast("array<int>").alias("sizes"))
    none = F.lit(None).cast("array<array<int>>")
    state = cut_lineage(
        start.select("block", F.explode(F.array(*[F.lit(i) for i in range(s.islands)])).alias("island"), "uids", "sizes",
                     none.alias("population"), none.alias("migrants")).mapInArrow(_islands(s, 0), _STATE), name="islands")
    for epoch in range(1, s.epochs):
        settled = state.filter("done").select("block").distinct()
        open_ = state.join(settled, "block", "left_anti")
        if open_.isEmpty():
            break
        elite = open_.select("block", ((F.col("island") + 1) % s.islands).alias("island"),
                             F.slice("population", 1, 1).alias("migrants"))
        moved = open_.join(elite, ["block", "island"]) \
            .select("block", "island", "uids", "sizes", "population", "migrants").mapInArrow(_islands(s, epoch), _STATE)
        state = cut_lineage(state.join(settled, "block", "left_semi").unionByName(moved), name="islands")
    return state.groupBy("block").agg(
        F.min_by(F.struct("uids", "sizes", F.col("population")[0].alias("assignment")), F.struct("bins", "island"))
        .alias("best")).select("block", "best.*")


def place(solved: DataFrame, s: Search) -> DataFrame:
    """``uid, sequence_id, offset, free``: a sequence's id is the smallest
    ``uid`` in it."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                uid, size, bin_of = (np.array(r[c], np.int64) for c in ("uids", "sizes", "assignment"))
                order = np.lexsort((uid, bin_of))
                uid, size, bin_of = uid[order], size[order], bin_of[order]
                first = np.flatnonzero(np.concatenate([[True], bin_of[1:] != bin_of[:-1]]))
                which = np.cumsum(np.concatenate([[False], bin_of[1:] != bin_of[:-1]]))
                before = np.cumsum(size) - size
                fill = np.add.reduceat(size, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), pa.array(uid[first][which]), pa.array(before - before[first][which]),
                     pa.array(s.capacity - fill[which])], names=["uid", "sequence_id", "offset", "free"])

    return solved.mapInArrow(rows, "uid long, sequence_id long, offset long, free long")


def pack(pieces: DataFrame, search: Search = Search()) -> DataFrame:
    """``uid, sequence_id, offset`` of every piece (``uid, length``) of at
    most ``capacity`` tokens."""
    s = search
    full = pieces.filter(F.col("length") == s.capacity)
    placed = [full.select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left = pieces.filter(F.col("length") < s.capacity).select("uid", "length")
    n = left.count()
    while n:
        blocks = -(-n // s.block_items)
        found = cut_lineage(place(solve_blocks(left, blocks, s if blocks > 1 else replace(s, generations=s.last_generations)), s),
                            name="packed")
        loose, again = F.lit(False), 0
        if blocks > 1:
            # Bins with more than the slack free are dissolved; where that is more than half of the pieces, only
            # those with twice, four times, ... the slack, so that each level has at most half of the one before.
            limits = [s.slack << k for k in range(s.capacity.bit_length()) if s.slack << k < s.capacity]
            counts = found.agg(*[F.count_if(F.col("free") > x) for x in limits]).first()
            again, limit = next(((c, x) for c, x in zip(counts, limits) if c <= n // 2), (0, 0))
            loose = F.col("free") > limit
        good = found if not again else found.filter(~loose)
        placed.append(good.select("uid", "sequence_id", "offset"))
        if again:
            left = left.join(found.filter(loose).select("uid"), "uid", "left_semi")
        n = again
    out = placed[0]
    for p in placed[1:]:
        out = out.union(p)
    return out


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                   search: Search = Search()) -> DataFrame:
    """One row per piece of every document: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``."""
    pieces = cut_lineage(token_pieces(docs, vocabulary, end_id, search.capacity, id_col, text_col), name="pieces")
    return pieces.join(pack(pieces.select("uid", "length"), search), "uid").drop("uid")
