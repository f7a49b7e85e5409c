"""Token files: static range asymmetric numeral coding of token ids.

One frequency table, counted over all documents and scaled to a power of
two, is shared by every block.  A block holds whole documents in ascending
id order and is coded on its own: its tokens run through ``LANES``
interleaved coder states, one row of tokens at a time.  Every
``CHECKPOINT`` rows the states and the place in the code are kept, so that a
block can be decoded from several places at once.  Each block carries a
CRC-32 of its code, lengths and checkpoints, which is verified before
decoding.

A token file is a folder: ``model`` (one row: the table) and ``blocks`` (one
row per block, ``part`` and ``block`` in document order), both Parquet, so
any store that Spark writes to will do.

Defined cases: a null or empty text has the end token only; documents with a
null id come first; repeated ids keep a row each, in order of their tokens;
a text of any length is encoded whole, in one block; an empty table gives a
file without blocks; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civica.llm.common import doc_slices, id_and_text
from civica.llm.vocab import TOKEN_SLICE_BYTES, tokenizers_encoder
from civica.session import cut_lineage

LANES, CHECKPOINT, BITS, BLOCK_TOKENS = 2048, 256, 20, 1 << 20
LOW = np.uint64(1 << 31)  # states are in [LOW, LOW << 32)
WORD = np.uint64(32)


class Table:
    """Frequencies that sum to ``1 << bits``, with none lost: every symbol
    that occurs has at least one."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray, bits: int = BITS):
        self.symbols, self.bits = np.asarray(symbols, np.int64), bits
        self.freq = np.asarray(freq, np.uint64)
        self.cum = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.index = np.zeros(int(self.symbols.max(initial=0)) + 1, np.uint32)
        self.index[self.symbols] = np.arange(len(self.symbols))

    @staticmethod
    def scaled(count: np.ndarray, bits: int = BITS) -> np.ndarray:
        total, whole = int(count.sum()), 1 << bits
        if len(count) > whole // 2:
            raise ValueError(f"{len(count)} symbols need more than {bits} bits")
        freq = np.maximum(1, (count.astype(np.float64) / total * whole).astype(np.int64))
        order = np.argsort(-freq, kind="stable")
        gap = whole - int(freq.sum())
        if gap >= 0:
            freq[order[0]] += gap
        while gap < 0:
            give = np.minimum(freq[order] // 4, -gap)
            taken = np.minimum(np.cumsum(give), -gap)
            freq[order] -= np.diff(taken, prepend=0)
            gap = whole - int(freq.sum())
        return freq


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, checkpoint: int = CHECKPOINT) -> tuple[bytes, bytes]:
    """(code, checkpoints) of the ids: 32-bit words in decoding order; and
    per checkpoint the place of its next word and all states."""
    rows = -(-len(ids) // lanes)
    fill = int(np.argmax(table.freq))  # the last row is filled up with the cheapest symbol
    sym = np.full(rows * lanes, fill, np.uint32)
    sym[: len(ids)] = table.index[ids]
    sym = sym.reshape(rows, lanes)
    bits = np.uint64(table.bits)
    top = np.uint64(63 - table.bits)
    x = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    n = 0
    marks: list[tuple[int, np.ndarray]] = []
    for t in range(rows - 1, -1, -1):
        f, c = table.freq[sym[t]], table.cum[sym[t]]
        over = x >= (f << top)
        if over.any():
            out = x[over]
            words.append(out.astype(np.uint32))
            n += len(out)
            x[over] = out >> WORD
        q = x // f
        x = (q << bits) + (x - q * f) + c
        if t % checkpoint == 0:
            marks.append((n, x.copy()))
    code = np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""
    kept = b"".join(np.uint64(n - at).astype("<u8").tobytes() + state.astype("<u8").tobytes() for at, state in reversed(marks))
    return code, kept


def decode_rows(code: np.ndarray, checkpoints: np.ndarray, table: Table, rows: int, first: int, last: int,
                lanes: int = LANES, checkpoint: int = CHECKPOINT) -> np.ndarray:
    """The tokens of the rows from checkpoint ``first`` up to ``last``."""
    mark = checkpoints[first]
    at, x = int(mark[0]), mark[1:].copy()
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    begin, end = first * checkpoint, min(rows, last * checkpoint)
    out = np.empty((end - begin, lanes), np.uint32)
    for t in range(end - begin):
        slot = x & mask
        s = table.slot[slot]
        out[t] = s
        x = table.freq[s] * (x >> bits) + slot - table.cum[s]
        under = x < LOW
        k = int(np.count_nonzero(under))
        if k:
            x[under] = (x[under] << WORD) | code[at: at + k]
            at += k
    return table.symbols[out.ravel()]


def decode_block(code: bytes, checkpoints: bytes, n: int, table: Table, lanes: int = LANES,
                 checkpoint: int = CHECKPOINT) -> np.ndarray:
    rows = -(-n // lanes)
    if not rows:
        return np.empty(0, np.int64)
    marks = np.frombuffer(checkpoints, "<u8").reshape(-1, lanes + 1)
    words = np.frombuffer(code, "<u4").astype(np.uint64)
    return decode_rows(words, marks, table, rows, 0, len(marks), lanes, checkpoint)[:n]


def checksum(lengths: np.ndarray, checkpoints: bytes, code: bytes) -> int:
    return zlib.crc32(code, zlib.crc32(checkpoints, zlib.crc32(np.asarray(lengths, "<u4").tobytes())))


def _width(vocabulary: str, end_id: int, spaces: bool) -> int:
    """Bytes that hold any id."""
    largest = max(tokenizers_encoder(vocabulary, spaces).tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    return 2 if largest <= 1 << 16 else 4


def _tokens(docs: DataFrame, vocabulary: str, end_id: int, spaces: bool, id_col: str, text_col: str, width: int) -> DataFrame:
    """``doc_id, n, ids`` (compressed ids by planes of bytes) of every
    document, and at the end of each task a row without a count of tokens but
    with its histogram of ids."""
    src = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        encoder = tokenizers_encoder(vocabulary, spaces)
        end = np.array([end_id], "<u4").tobytes()
        count = np.zeros(0, np.int64)
        kind = None
        for part in doc_slices(batches, slice_bytes=TOKEN_SLICE_BYTES):
            kind = part.schema.field("doc_id").type
            size, data, every = [], [], []
            for ids in encoder.encode(part.column("text")):
                own = np.frombuffer(ids + end, "<u4")
                every.append(own)
                size.append(len(own))
                data.append(press(np.ascontiguousarray(own.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()))
            more = np.bincount(np.concatenate(every), minlength=len(count))
            more[: len(count)] += count
            count = more
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(data, pa.binary())],
                                             names=["doc_id", "n", "ids"])
        encoder.forget()
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.array([press(count.astype("<i8").tobytes())], pa.binary())],
                names=["doc_id", "n", "ids"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n long, ids binary")


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    for b in batches:
        for data in b.column("ids").to_pylist():
            count = np.frombuffer(zstandard.decompress(data), "<i8")
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["id", "n"])


def _blocks(table: Table, block_tokens: int, width: int):
    """Sorted documents of one range in, blocks out."""
    def block(part: int, number: int, kind: pa.DataType, ids: list, lengths: list[int], tokens: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(tokens)
        code, marks = encode_block(every, table)
        row = {"part": part, "block": number, "doc_ids": ids, "lengths": lengths, "n_tokens": len(every), "code": code,
               "checkpoints": marks, "crc32": checksum(np.array(lengths), marks, code)}
        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(kind)),
                            ("lengths", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("code", pa.binary()),
                            ("checkpoints", pa.binary()), ("crc32", pa.int64())])
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        part, number, size = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        lengths: list[int] = []
        tokens: list[np.ndarray] = []
        kind = None
        for b in batches:
            kind = b.schema.field("doc_id").type
            for key, n, data in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "ids"))):
                planes = np.frombuffer(unpress(data), np.uint8).reshape(width, -1)
                ids.append(key)
                lengths.append(n)
                tokens.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel())
                size += n
                if size >= block_tokens:
                    yield block(part, number, kind, ids, lengths, tokens)
                    number, size, ids, lengths, tokens = number + 1, 0, [], [], []
        if ids:
            yield block(part, number, kind, ids, lengths, tokens)

    return run


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, spaces: bool, id_col: str = "doc_id",
                      text_col: str = "text", block_tokens: int = BLOCK_TOKENS, bits: int = BITS) -> None:
    """Encodes every text, appends ``end_id``, and writes the token file at
    ``path``, in ascending order of the ids."""
    spark = docs.sparkSession
    width = _width(vocabulary, end_id, spaces)
    tokens = cut_lineage(_tokens(docs, vocabulary, end_id, spaces, id_col, text_col, width), name="tokens")
    # One row per id of the vocabulary that occurs: bounded by the vocabulary.
    count = tokens.filter("n is null").select("ids").mapInArrow(_histograms, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    symbols = np.array([r["id"] for r in count], np.int64)
    freq = Table.scaled(np.array([r["n"] for r in count], np.int64), bits) if count else np.empty(0, np.int64)
    spark.createDataFrame([(bits, [int(s) for s in symbols], [int(f) for f in freq])],
                          "bits int, symbols array<int>, freq array<int>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    schema = f"part int, block int, doc_ids array<{kind}>, lengths array<int>, n_tokens long, code binary, " \
        "checkpoints binary, crc32 long"
    tokens.filter("n is not null").repartitionByRange(F.col("doc_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", "ids") \
        .mapInArrow(_blocks(Table(symbols, freq, bits), block_tokens, width), schema) \
        .write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document,
    decoded from the file.  A block whose checksum fails is an error."""
    model = spark.read.parquet(f"{path}/model").first()
    table = Table(np.array(model["symbols"], np.int64), np.array(model["freq"], np.int64), model["bits"])
    blocks = spark.read.parquet(f"{path}/blocks")
    # Tokens before each part (one row a part), and before each block of its part.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = blocks.select("part", "block", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block"))
                                          - F.col("n_tokens")).alias("inside"))
    start = own.join(parts, "part").select("part", "block", (F.col("inside") + F.col("before")).alias("base"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in ("part", "block", "lengths", "n_tokens", "code", "checkpoints", "crc32")}
                lengths = np.array(r["lengths"], np.int64)
                if checksum(lengths, r["checkpoints"], r["code"]) != r["crc32"]:
                    raise ValueError(f"{path}: checksum of block {r['part']}/{r['block']} fails")
                ids = decode_block(r["code"], r["checkpoints"], r["n_tokens"], table).astype("<u4")
                ends = np.cumsum(lengths)
                begin = ends - lengths
                data = memoryview(ids).cast("B")
                crc = [zlib.crc32(data[4 * a: 4 * e]) for a, e in zip(begin.tolist(), ends.tolist())]
                n = len(lengths)
                out = [pa.array(np.full(n, r["part"], np.int32)), pa.array(np.full(n, r["block"], np.int32)),
                       b.column("doc_ids")[i].values, pa.array(begin), pa.array(lengths), pa.array(crc, pa.int64())]
                names = ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(begin, ends[-1:]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"part int, block int, doc_id {kind}, inside long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = blocks.mapInArrow(decode, schema).join(start, ["part", "block"])
    return found.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
