"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is indexed by its two halves.  Fingerprints that differ
in at most three bits agree in one half up to one bit, so each half looks up
its own value and the values one bit away (flipping zeros only: of two values
one bit apart, one has the zero).  What the table has there is verified with
the complete distance.  Copies share a fingerprint and count once.

Buckets of up to ``bucket_rows`` members are compared in one task, row by
row, and leave a spanning forest.  Larger buckets are linked through the
values near the other half: two members at most three bits apart meet at a
value that is within one bit of one and two of the other, and all who meet
there are linked to one who is within one bit.  No bucket is cut, and no
bucket is expanded into pairs.  Linked fingerprints become components by
alternating large and small stars.

Defined cases: a null, empty or white-space-only text has fingerprint zero
and is linked like any other; a text of fewer words than the shingle is one
shingle; texts of any length are read whole; a bit that is set in just half of
the shingles is 0; a null id takes part, but is never a component's id while
another id is there; repeated rows are copies; an empty table gives an empty
result; other columns are ignored, whatever their names, or kept by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.llm.common import doc_slices, id_and_text, utf8
from civica.session import cut_lineage

BITS, HALF = 64, 32
MAX_DISTANCE = 3  # what two halves with one flipped bit each can guarantee
HALF_MASK = (1 << HALF) - 1
BLOCK = 1 << 16


def simhash(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        words = t.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[:-1])]
        last = ends[shingle - 1:] or ends[-1:]
        ones = np.zeros(BITS, np.int64)
        for a in range(0, len(last), BLOCK):  # a block of shingles at a time: 64 counters each
            hashes = [digest(joined[x:y], seed) for x, y in zip(starts[a: a + BLOCK], last[a: a + BLOCK])]
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(last), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """``doc_id, fp``: the fingerprint's 64 bits as a long."""
    src = id_and_text(docs, id_col, text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches):
            fp = simhash(utf8(part.column("text")), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return src.mapInArrow(compute, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long")


def _halves(nodes: DataFrame) -> DataFrame:
    """Two rows per fingerprint: the half's number, its value, the other
    half's value."""
    high, low = F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND(F.lit(HALF_MASK))
    both = F.array(F.struct(F.lit(0).alias("half"), high.alias("val"), low.alias("rest")),
                   F.struct(F.lit(1).alias("half"), low.alias("val"), high.alias("rest")))
    return nodes.select("fp", F.explode(both).alias("h")).select("h.*", "fp")


def _flips(value):
    """Each value one bit above: one zero of the half set."""
    powers = F.array(*[F.lit(1 << b).cast("long") for b in range(HALF)])
    return F.transform(F.filter(powers, lambda p: value.bitwiseAND(p) == 0), lambda p: value.bitwiseOR(p))


def _forest(home: np.ndarray, guests: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links of a bucket: its own fingerprints among
    themselves and with its guests."""
    every = np.concatenate([home, guests])
    left = np.ones(len(every), bool)
    a: list[int] = []
    b: list[int] = []
    for root in range(len(home)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            i = stack.pop()
            others = every if i < len(home) else home
            rest = np.flatnonzero(left[: len(others)])
            if not len(rest):
                if i < len(home):
                    return a, b
                continue
            near = rest[np.bitwise_count(others[rest] ^ every[i]) <= distance]
            left[near] = False
            stack += near.tolist()
            a += [int(every[i])] * len(near)
            b += every[near].tolist()
    return a, b


def _bucket_links(distance: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for home, guests in zip(batch.column("home"), batch.column("guests")):
                x, y = (np.asarray(v.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64) for v in (home, guests))
                x, y = _forest(x, y, distance)
                a += x
                b += y
            if a:
                pair = np.array([a, b], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["a", "b"])

    return links


def _hot_links(members: DataFrame, distance: int) -> DataFrame:
    """Links of large buckets through values near the other half.  Of two
    linked members one is within ``inner`` bits of such a value, the other
    within the rest of the distance (a guest has used one bit already)."""
    inner = distance // 2
    masks = {0: [0], 1: [1 << b for b in range(HALF)], 2: [(1 << b) | (1 << c) for b in range(HALF) for c in range(b)]}

    def ball(radius: int):
        return F.array(*[F.lit(m).cast("long") for r in range(radius + 1) for m in masks[r]])

    near = F.when(F.col("home"), ball(distance - inner)).otherwise(ball(distance - 1 - inner))
    met = members.select("half", "val", "fp", "home", "rest", F.explode(near).alias("flip")) \
        .select("half", "val", "fp", "home", F.col("rest").bitwiseXOR(F.col("flip")).alias("at"),
                F.bit_count("flip").alias("far"))
    key = ["half", "val", "at"]
    center = met.filter(F.col("home") & (F.col("far") <= inner)).groupBy(key).agg(F.min("fp").alias("center"))
    return met.join(center, key).filter("fp != center").select(F.col("fp").alias("a"), F.col("center").alias("b")).distinct()


def near_links(nodes: DataFrame, distance: int = MAX_DISTANCE, bucket_rows: int = 32768) -> DataFrame:
    """``a, b``: links between fingerprints of ``nodes`` (distinct ``fp``)
    that connect all which differ in at most ``distance`` bits."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must be 0 to {MAX_DISTANCE}")
    home = _halves(nodes)
    table = home.groupBy("half", "val").agg(F.count(F.lit(1)).alias("_n"))
    guests = home.select("half", F.explode(_flips(F.col("val"))).alias("val"), "rest", "fp") \
        .join(table.select("half", "val"), ["half", "val"], "left_semi")
    members = cut_lineage(home.withColumn("home", F.lit(True)).unionByName(guests.withColumn("home", F.lit(False))),
                          name="simhash-members")
    sizes = members.groupBy("half", "val").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    small = members.join(sizes.filter(F.col("_n") <= bucket_rows).drop("_n"), ["half", "val"]) \
        .groupBy("half", "val").agg(F.collect_list(F.when(F.col("home"), F.col("fp"))).alias("home"),
                                    F.collect_list(F.when(~F.col("home"), F.col("fp"))).alias("guests")) \
        .select("home", "guests").mapInArrow(_bucket_links(distance), "a long, b long")
    large = sizes.filter(F.col("_n") > bucket_rows).drop("_n")
    links = small
    if distance and not large.isEmpty():
        links = links.union(_hot_links(members.join(large, ["half", "val"]), distance))
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: for every linked node the smallest node it reaches,
    by alternating large and small stars until nothing changes."""
    edges = cut_lineage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(),
                        name="star")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        edges = cut_lineage(small, name="star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(h), F.lit(0)),
                           F.coalesce(F.sum(F.pmod(h, F.lit(2_147_483_647))), F.lit(0))).first())


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       distance: int = MAX_DISTANCE, seed: int = 42, bucket_rows: int = 32768) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that each row reaches
    over links of fingerprints at most ``distance`` bits apart."""
    own = cut_lineage(fingerprints(docs, id_col, text_col, shingle, seed), name="simhash")
    nodes = cut_lineage(own.groupBy("fp").agg(F.min("doc_id").alias("least")), name="simhash-nodes")
    roots = components(near_links(nodes.select("fp"), distance, bucket_rows))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    # The root itself has no link of its own, but others may point to it.
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return own.join(found, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             distance: int = MAX_DISTANCE, seed: int = 42, bucket_rows: int = 32768) -> DataFrame:
    """One row of ``docs`` of each component, as it is: one with the smallest
    id, one without an id only where no row of the component has one.  The
    rows are written once beside their fingerprint and a number, and chosen
    by that number, so equal and null ids tell nothing about a row."""
    extra = []
    for name in ("_row", "_fp"):
        while name in docs.columns:
            name += "_"
        extra.append(name)
    row, fp = extra

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, text_col):
            own = pa.array(simhash(utf8(part.column(text_col)), shingle, seed).view(np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*part.schema.names, fp])

    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    schema = T.StructType([*numbered.schema.fields, T.StructField(fp, T.LongType())])
    rows = cut_lineage(numbered.mapInArrow(append, schema), name="simhash-rows")
    key = F.col(f"`{id_col}`")
    first = F.min(F.struct(key.isNull().alias("none"), key.alias("id"), F.col(row).alias("row"))).alias("first")
    nodes = cut_lineage(rows.groupBy(F.col(fp).alias("fp")).agg(first), name="simhash-nodes")
    roots = components(near_links(nodes.select("fp"), distance, bucket_rows))
    kept = nodes.join(roots, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("root", "fp").alias("root")) \
        .agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
