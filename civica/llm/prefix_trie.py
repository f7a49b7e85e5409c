"""Conversation prefix trie: z-fast tries of slices, merged by prefix digest.

Every prefix of a conversation has a digest, made from the digest before it
and the turn.  A task inserts its conversations, a batch at a time, in a
z-fast trie: compacted nodes are hashed at the two-fattest depth of their
edge, a fat binary search over the depths finds the node where a conversation
leaves the trie, and there a leaf is added or an edge is split.  The edges,
expanded, are one row a prefix and task, so copies and common beginnings are
counted before anything is shuffled.  Rows of one digest are one node.

Sums over subtrees take no pass per depth.  A node belongs to its smallest
member; what a conversation owns is the end of its own path, summed by one
window, and the total of that end goes to the prefixes above it, which are
owned by others: never more rows than there are turns.

Defined cases: a null role or text is empty; turns of equal number come in
the order of their role and of a digest of role and text; a repeated row is
another turn; a row with a null id is part of no conversation; an empty table
has no nodes, not even a root; texts of any length count whole; other columns
are ignored, whatever their names.  A conversation longer than a slice is
handled in pieces.  The ids that end at one node are hashed as a stream, from
pieces that other tasks have sorted and joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from civica.session import cut_lineage

#: The digest of no turns.
ROOT = bytes(16)
#: Rows that one trie is built from.
SLICE_ROWS = 50_000
#: Bytes of joined ids that one task hands on at a time.
PIECE_BYTES = 1 << 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] with the most trailing zeros."""
    return high & -1 << (low ^ high).bit_length() - 1


class Node:
    """An edge of the compacted trie and the node below it: prefixes of
    lengths (low, high] of ``path``."""

    __slots__ = ("low", "high", "path", "words", "above", "children", "ends", "least")

    def __init__(self, low: int, high: int, path: list[bytes], words: list[int]):
        self.low, self.high, self.path, self.words = low, high, path, words
        self.above: Node | None = None
        self.children: dict[bytes, Node] = {}
        self.ends, self.least = 0, None

    def handle(self) -> bytes:
        return self.path[two_fattest(self.low, self.high) - 1]


class ZFastTrie:
    """Paths are lists of prefix digests, the root's first; lengths count
    them, so the root alone has length one."""

    def __init__(self):
        self.top: dict[bytes, Node] = {}
        self.handles: dict[bytes, Node] = {}

    def exit_node(self, path: list[bytes]) -> tuple[Node | None, Node | None]:
        """The deepest node whose whole path begins ``path``, and the node
        below it into whose edge ``path`` goes on, if there is one."""
        low, high, above = 0, len(path), None
        while low < high:
            f = two_fattest(low, high)
            node = self.handles.get(path[f - 1])
            if node is None:
                high = f - 1
            elif node.high <= len(path) and node.path[node.high - 1] == path[node.high - 1]:
                low, above = node.high, node
            else:
                return node.above, node
        below = above.children if above else self.top
        return above, below.get(path[low]) if low < len(path) else None

    def _add(self, above: Node | None, node: Node) -> Node:
        node.above = above
        (above.children if above else self.top)[node.path[node.low]] = node
        self.handles[node.handle()] = node
        return node

    def insert(self, path: list[bytes], words: list[int], count: int, least) -> None:
        above, out = self.exit_node(path)
        if out is not None:  # the path leaves inside an edge: split it there
            low, high = out.low + 1, min(out.high, len(path))
            while low < high:
                middle = (low + high + 1) // 2
                if out.path[middle - 1] == path[middle - 1]:
                    low = middle
                else:
                    high = middle - 1
            del self.handles[out.handle()]
            upper = self._add(above, Node(out.low, low, out.path, out.words))
            out.low = low
            self._add(upper, out)
            above = upper
        if above is None or above.high < len(path):
            above = self._add(above, Node(above.high if above else 0, len(path), path, words))
        above.ends += count
        if above.least is None or least < above.least:
            above.least = least

    def insert_batch(self, batch: list[tuple[object, list[bytes], list[int]]]) -> None:
        """Equal conversations are inserted once."""
        same: dict[bytes, list] = {}
        for conv, path, words in batch:
            entry = same.setdefault(path[-1], [path, words, 0, conv])
            entry[2] += 1
            entry[3] = min(entry[3], conv)
        for path, words, count, least in same.values():
            self.insert(path, words, count, least)

    def expand(self) -> Iterator[tuple[int, bytes, bytes | None, int, int, object]]:
        """(depth, digest, parent's digest, words, members, smallest) of every prefix."""
        order = list(self.top.values())
        for node in order:
            order += node.children.values()
        totals: dict[int, tuple[int, object]] = {}
        for node in reversed(order):
            n, least = node.ends, node.least
            for c in node.children.values():
                m, x = totals[id(c)]
                n += m
                least = x if least is None or x < least else least
            totals[id(node)] = n, least
        for node in order:
            n, least = totals[id(node)]
            for d in range(node.low, node.high):
                yield d, node.path[d], node.path[d - 1] if d else None, node.words[d], n, least


def turn_symbols(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``conv, place, symbol, words``: the turns in order, from 1, without
    their texts."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    role, text = F.col("role"), F.col("text")
    symbol = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    flat = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                       empty(role_col).alias("role"), empty(text_col).alias("text")).filter("conv IS NOT NULL")
    narrow = flat.select("conv", "turn", "role", symbol.alias("symbol"),
                         F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "symbol")
    return narrow.select("conv", F.row_number().over(order).cast("long").alias("place"), "symbol", "words")


def prefix_paths(turns: DataFrame) -> DataFrame:
    """``conv, depth, digest, parent, words, last``: every prefix of every
    conversation, the empty one first.  A conversation without turns has a
    row with a null symbol."""
    conv_type = turns.schema["conv"].dataType

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "depth", "digest", "parent", "words", "last"]
        types = [None, pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        out: list[list] = [[] for _ in names]

        def emit(row: tuple) -> None:
            for column, x in zip(out, row):
                column.append(x)

        conv, row, started = None, None, False
        for b in batches:
            types[0] = b.column("conv").type
            for c, symbol, words in zip(*(b.column(x).to_pylist() for x in ("conv", "symbol", "words"))):
                if not started or c != conv:
                    if started:
                        emit((*row, True))
                    conv, started, row = c, True, (c, 0, ROOT, None, 0)
                if symbol is not None:
                    emit((*row, False))
                    row = (c, row[1] + 1, hashlib.md5(row[2] + symbol).digest(), row[2], words)
            if len(out[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=names)
                out = [[] for _ in names]
        if started:
            emit((*row, True))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=names)

    schema = T.StructType([T.StructField("conv", conv_type), T.StructField("depth", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("parent", T.BinaryType()), T.StructField("words", T.LongType()), T.StructField("last", T.BooleanType())])
    return turns.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("place")).drop("place").mapInArrow(paths, schema)


def _slice_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths, in order, to the nodes of one trie a slice.  What is left of a
    conversation that began before this slice is one edge of its own."""
    names = ["depth", "digest", "parent", "words", "n", "conv"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), None]
    batch: list[tuple] = []
    loose: list[tuple] = []
    held = 0
    conv, path, words = None, [], []
    within = False  # whether the rows of this conversation so far begin at the root

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal batch, loose, held
        trie = ZFastTrie()
        trie.insert_batch(batch)
        rows = [*trie.expand(), *loose]
        batch, loose, held = [], [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for b in batches:
        types[5] = b.column("conv").type
        for c, depth, digest, parent, w in zip(*(b.column(x).to_pylist() for x in ("conv", "depth", "digest", "parent", "words"))):
            if depth == 0 or c != conv:
                if path:
                    batch.append((conv, path, words))
                conv, path, words, within = c, [], [], depth == 0
                if held >= SLICE_ROWS:
                    yield from flush()
            held += 1
            if within:
                path.append(digest)
                words.append(w)
            else:
                loose.append((depth, digest, parent, w, 1, c))
            if held >= 2 * SLICE_ROWS:  # a conversation longer than a slice goes on loose
                if path:
                    batch.append((conv, path, words))
                path, words, within = [], [], False
                yield from flush()
    if path:
        batch.append((conv, path, words))
    yield from flush()


def merged_nodes(paths: DataFrame) -> DataFrame:
    """``depth, digest, parent, words, n, conv``: every distinct prefix with
    its number of members and the smallest."""
    schema = T.StructType([paths.schema[c] for c in ("depth", "digest", "parent", "words")]
                          + [T.StructField("n", T.LongType()), paths.schema["conv"]])
    local = paths.select("conv", "depth", "digest", "parent", "words").mapInArrow(_slice_nodes, schema)
    return local.groupBy("depth", "digest", "parent", "words").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, first, ids, size = None, None, [], 0
    rows: list[tuple] = []
    conv_type = None

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), conv_type, pa.string()))],
                                          names=["digest", "conv", "ids"])

    for b in batches:
        conv_type = b.column("conv").type
        for d, c in zip(b.column("digest").to_pylist(), b.column("conv").to_pylist()):
            if ids and (d != digest or size >= PIECE_BYTES):
                rows.append((digest, first, ",".join(ids)))
                ids, size = [], 0
                if len(rows) >= 1000:
                    yield emit()
                    rows = []
            if not ids:
                digest, first = d, c
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        rows.append((digest, first, ",".join(ids)))
    if rows:
        yield emit()


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, total = None, None
    for b in batches:
        digests, sums = [], []
        for d, ids in zip(b.column("digest").to_pylist(), b.column("ids").to_pylist()):
            if d != now:
                if total:
                    digests.append(now)
                    sums.append(total.hexdigest())
                now, total = d, hashlib.sha256(ids.encode())
            else:
                total.update(b"," + ids.encode())
        if digests:
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sums)], names=["digest", "ends_sha256"])
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([total.hexdigest()])], names=["digest", "ends_sha256"])


def ending_digests(paths: DataFrame) -> DataFrame:
    """``digest, ends_sha256``: of the ids, ascending, of the conversations
    that end at a prefix."""
    ends = paths.filter("last").select("digest", "conv")
    pieces = ends.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv") \
        .mapInArrow(_id_pieces, T.StructType([*ends.schema.fields, T.StructField("ids", T.StringType())]))
    return pieces.repartition("digest").sortWithinPartitions("digest", "conv") \
        .mapInArrow(_id_digests, "digest binary, ends_sha256 string")


def trie_nodes(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row a node of the trie of ``turns`` (as ``turn_symbols`` gives
    them): its smallest member, depth, the parent's smallest member, and the
    sums over members, children and subtree; ``digest`` names the prefix."""
    paths = cut_lineage(prefix_paths(turns), name="trie-paths")
    nodes = cut_lineage(merged_nodes(paths), name="trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "digest", "left").fillna(0, ["n_children"]) \
        .withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")) \
        .withColumn("saved", (F.col("n") - 1) * F.col("words"))
    owner = Window.partitionBy("conv")
    below = owner.orderBy(F.desc("depth"))
    owned = cut_lineage(counted.select("digest", "depth", "parent", "conv", "n", "n_children", F.min("depth").over(owner).alias("top"),
                                       F.sum("leaf").over(below).alias("leaves"), F.sum("saved").over(below).alias("saved")), name="trie-owned")
    totals = owned.filter("depth = top AND top > 0").select("conv", "top", "leaves", "saved")
    handed = paths.select("conv", "depth", "digest").join(totals, "conv").filter("depth < top") \
        .groupBy("digest").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    # Only the first node that a conversation owns has a parent that another owns.
    first = owned.filter("depth = top AND top > 0").select("digest", "parent")
    above = owned.select(F.col("digest").alias("parent"), F.col("conv").alias("above"))
    parents = first.join(above, "parent").select("digest", "above")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    out = owned.join(handed, "digest", "left").join(parents, "digest", "left").join(ending_digests(paths), "digest", "left")
    return out.select(
        F.col("conv").alias(conv_col), "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv")).alias(f"parent_{conv_col}"),
        F.col("n").alias("n_convs"), "n_children", (F.col("leaves") + zero("more_leaves")).alias("n_leaves"),
        (F.col("saved") + zero("more_saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        F.lower(F.hex("digest")).alias("digest"))


def conversation_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """The nodes of the trie of a table of turns."""
    return trie_nodes(turn_symbols(rows, conv_col, turn_col, role_col, text_col), conv_col)


def rebuilt(turns: DataFrame) -> DataFrame:
    """The conversations of the contract: each begins with the first h turns
    of the conversation whose id is the next lower multiple of 20, and goes on
    with its own turns after its first h."""
    t = cut_lineage(turns, name="trie-turns")
    base = F.col("conv") - F.col("conv") % 20
    share = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h")
    convs = t.filter("place = 1").select("conv", base.alias("base"), share)
    head = t.filter("place <= 3 AND conv % 20 = 0").select(F.col("conv").alias("base"), "place", "symbol", "words")
    shared = convs.join(head, "base").filter("place <= h").select("conv", "place", "symbol", "words")
    own = t.withColumn("h", share).filter("place > h").select("conv", "place", "symbol", "words")
    none = [F.lit(None).cast(t.schema[c].dataType).alias(c) for c in ("symbol", "words")]
    return shared.unionAll(own).unionAll(convs.select("conv", F.lit(0).cast("long").alias("place"), *none))
