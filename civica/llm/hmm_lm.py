"""Hidden Markov language model.

Latent states emit classes of words: each frequent word is a class of its
own, other words share a class by their ending, and a word is drawn from its
class by smoothed counts.  Baum-Welch expectations are summed within each
task and across partitions by one aggregate per iteration; the scaled
forward recursion gives the exact likelihood of every whole text.

The corpus is read once and written as shards: the words of some megabytes
of text, numbered, and their token sequences.  Words are dealt by hash to
buckets, which add up the counts of all shards and answer each shard with
the counts of its own words.  The driver holds the states' parameters and
what is bounded by settings: class sums and the words with at least
``1 / max_frequent`` of the tokens.

Training sequences are neighbouring segments of ``segment`` tokens, so that
long and short texts take equal steps; every training token is in one.  The
state that begins a text and the one that a later segment begins with are
learnt apart, and whole texts are scored from the first.

Defined cases: a null or empty text is the end token alone; a text of any
length is scored whole, from its beginning; a null id isn't held out; repeated
rows are learnt from and scored as often as they occur; of equally frequent
words the lesser comes first; without training rows every state is uniform
over the classes; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.common import doc_slices, id_and_text, utf8
from civica.session import cut_lineage

#: The end token; no word holds white space.
END = b"\n"


@dataclass(frozen=True)
class HmmSettings:
    """``ending``: bytes of a word's end that choose its class out of
    ``classes``.  ``bucket_bytes``: text per bucket of words."""

    states: int = 6
    iterations: int = 4
    max_frequent: int = 8192
    classes: int = 2048
    ending: int = 3
    segment: int = 64
    shard_bytes: int = 5 << 20
    bucket_bytes: int = 32 << 20
    batch: int = 2048
    prior: float = 50.0
    seed: int = 7


@dataclass
class Hmm:
    """``emit`` has a row per class: the end, the endings, the frequent words."""

    tokens: int
    distinct: int
    frequent: dict[bytes, int]
    class_tokens: np.ndarray
    class_words: np.ndarray
    settings: HmmSettings
    start: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: State of a segment that goes on within a text.
    resume: np.ndarray = field(default_factory=lambda: np.empty(0))
    move: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    emit: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))

    def word_classes(self, words: list[bytes]) -> np.ndarray:
        get, n, k = self.frequent.get, self.settings.classes, self.settings.ending
        crc = zlib.crc32
        return np.fromiter((c if (c := get(w)) is not None else 1 + crc(w[-k:]) % n for w in words), np.int64, len(words))


# ---- shards ---------------------------------------------------------------

_SHARD = "shard long, doc_ids array<{id}>, held array<boolean>, lengths array<int>, tokens binary, words array<binary>, " \
    "train array<long>, n_train long"


def _pack(values: np.ndarray) -> bytes:
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _sharder(buckets: int, s: HmmSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for part in doc_slices(batches, slice_bytes=s.shard_bytes):
            flat: list[bytes] = []
            lengths = np.empty(part.num_rows, np.int64)
            for i, t in enumerate(utf8(part.column("text"))):
                words = t.lower().split()
                lengths[i] = len(words) + 1
                flat += words
                flat.append(END)
            coded = pa.array(flat, pa.binary()).dictionary_encode()
            words = coded.dictionary.to_pylist()
            # Words in the order of their buckets, so that a bucket's words are neighbours.
            bucket = _buckets(words, buckets)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            tokens = place[coded.indices.to_numpy(zero_copy_only=False)]
            held = part.column("held").to_numpy(zero_copy_only=False)
            learnt = np.repeat(~held.astype(bool), lengths)
            train = np.bincount(tokens[learnt], minlength=len(words))
            row = {"shard": [shard], "doc_ids": [part.column("doc_id")], "held": [part.column("held")],
                   "lengths": [lengths.astype(np.int32)], "tokens": [_pack(tokens)],
                   "words": [coded.dictionary.take(pa.array(order))], "train": [train],
                   "n_train": [int(train.sum())]}
            kinds = {"shard": pa.int64(), "doc_ids": pa.list_(part.schema.field("doc_id").type), "held": pa.list_(pa.bool_()),
                     "lengths": pa.list_(pa.int32()), "tokens": pa.binary(), "words": pa.list_(pa.binary()),
                     "train": pa.list_(pa.int64()), "n_train": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) if not isinstance(v[0], (pa.Array, np.ndarray)) else
                                              pa.ListArray.from_arrays(pa.array([0, len(v[0])], pa.int32()), pa.array(v[0]))
                                              for k, v in row.items()], names=list(row))
            shard += 1

    return run


def _buckets(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))


def _deal(buckets: int):
    """One row per shard and bucket that has words of it: the words (which
    lie in bucket order) and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, train = b.column("words")[i].values, b.column("train")[i].values
                bucket = _buckets(words.to_pylist(), buckets)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                offsets = pa.array(np.append(first, len(bucket)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[first].astype(np.int32)), pa.array(np.full(len(first), b.column("shard")[i].as_py())),
                     pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, train)],
                    names=["bucket", "shard", "words", "train"])

    return run


_ANSWER = "shard long, bucket int, counts array<long>, words array<binary>, classes array<int>, class_tokens array<long>, " \
    "class_words array<long>"


def _bucket_counter(frequent_from: float, s: HmmSettings):
    """Adds up a bucket's counts.  The answers to the shards, and one row
    (shard null) with its frequent words and the sums of its other classes."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        words = table.column("words").combine_chunks()
        train = table.column("train").combine_chunks()
        flat = pc.list_flatten(words).dictionary_encode()
        index = flat.indices.to_numpy(zero_copy_only=False)
        count = np.zeros(len(flat.dictionary), np.int64)
        np.add.at(count, index, pc.list_flatten(train).to_numpy(zero_copy_only=False))
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
        names = flat.dictionary.to_pylist()
        often = np.flatnonzero(count >= max(frequent_from, 1))
        frequent = [i for i in often.tolist() if names[i] != END]
        end = [i for i in range(len(names)) if names[i] == END]
        rare = count > 0
        rare[often] = False
        rare[end] = False
        own = np.fromiter((1 + zlib.crc32(names[i][-s.ending:]) % s.classes for i in np.flatnonzero(rare).tolist()), np.int64)
        n_tokens = np.bincount(own, weights=count[rare], minlength=s.classes + 1).astype(np.int64)
        n_words = np.bincount(own, minlength=s.classes + 1)
        if end:
            n_tokens[0], n_words[0] = count[end[0]], int(count[end[0]] > 0)
        used = np.flatnonzero(n_words)
        n = table.num_rows
        none = pa.nulls(n, pa.list_(pa.int64()))
        answers = [table.column("shard").combine_chunks(), table.column("bucket").combine_chunks(),
                   pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(count[index])),
                   pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.list_(pa.int32())), none, none]
        sums = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([count[frequent].tolist()], pa.list_(pa.int64())),
                pa.array([[names[i] for i in frequent]], pa.list_(pa.binary())), pa.array([used.tolist()], pa.list_(pa.int32())),
                pa.array([n_tokens[used].tolist()], pa.list_(pa.int64())), pa.array([n_words[used].tolist()], pa.list_(pa.int64()))]
        columns = ["shard", "bucket", "counts", "words", "classes", "class_tokens", "class_words"]
        return pa.concat_tables([pa.Table.from_arrays(answers, names=columns), pa.Table.from_arrays(sums, names=columns)])

    return run


# ---- recursions -----------------------------------------------------------

def forward(classes: np.ndarray, lengths: np.ndarray, model: Hmm) -> np.ndarray:
    """Natural log-likelihood of every sequence; ``classes`` has them one
    after another.  All sequences take a step together, longest first."""
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    live = np.searchsorted(-size, -np.arange(int(size[0])) if len(size) else np.empty(0), "left")
    total = np.zeros(len(size))
    a = None
    for t, n in enumerate(live.tolist()):
        e = model.emit[classes[begin[:n] + t]]
        a = model.start * e if t == 0 else (a[:n] @ model.move) * e
        scale = a.sum(1)
        a /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(size))
    out[order] = total
    return out


def expectations(classes: np.ndarray, lengths: np.ndarray, model: Hmm,
                 begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions, and the log-likelihood, of
    sequences of at most a segment.  The first row of the starts is of those
    that begin a text (``begins``; all by default), the second of the others."""
    k = len(model.start)
    begins = np.ones(len(lengths), bool) if begins is None else begins
    starts, moves = np.zeros((2, k)), np.zeros((k, k))
    emits = np.zeros((len(model.emit), k))
    order = np.argsort(-lengths, kind="stable")
    begin_all, size_all = (np.cumsum(lengths) - lengths)[order], lengths[order]
    likelihood = 0.0
    for at in range(0, len(order), model.settings.batch):
        begin, size = begin_all[at: at + model.settings.batch], size_all[at: at + model.settings.batch]
        fresh = begins[order[at: at + model.settings.batch]]
        first = np.broadcast_to(model.start, (len(fresh), k)).copy()
        if not fresh.all():
            first[~fresh] = model.resume
        live = [int(n) for n in np.searchsorted(-size, -np.arange(int(size[0])), "left")]
        alpha, emitted, scales, seen = [], [], [], []
        for t, n in enumerate(live):
            c = classes[begin[:n] + t]
            e = model.emit[c]
            a = first * e if t == 0 else (alpha[-1][:n] @ model.move) * e
            scale = a.sum(1)
            a /= scale[:, None]
            likelihood += float(np.log(scale).sum())
            alpha.append(a)
            emitted.append(e)
            scales.append(scale)
            seen.append(c)
        gamma: list[np.ndarray] = [np.empty(0)] * len(live)
        beta = np.ones((live[-1], k))
        for t in range(len(live) - 1, -1, -1):
            g = alpha[t].copy()
            g[: len(beta)] *= beta
            gamma[t] = g
            if t:
                # Sequences that end at t - 1 have beta one there.
                weighted = emitted[t] / scales[t][:, None]
                weighted[: len(beta)] *= beta
                moves += alpha[t - 1][: len(weighted)].T @ weighted
                beta_before = np.ones((live[t - 1], k))
                beta_before[: len(weighted)] = weighted @ model.move.T
                beta = beta_before
        starts[0] += gamma[0][fresh].sum(0)
        starts[1] += gamma[0][~fresh].sum(0)
        every, which = np.concatenate(gamma), np.concatenate(seen)
        for j in range(k):
            emits[:, j] += np.bincount(which, weights=every[:, j], minlength=len(emits))
    return starts, moves * model.move, emits, likelihood


def segments(lengths: np.ndarray, segment: int) -> np.ndarray:
    """Lengths of the segments that the sequences are cut into."""
    whole = lengths // segment
    rest = lengths % segment
    n = whole + (rest > 0)
    out = np.full(int(n.sum()), segment, np.int64)
    last = (np.cumsum(n) - 1)[rest > 0]
    out[last] = rest[rest > 0]
    return out


def beginnings(lengths: np.ndarray, segment: int) -> np.ndarray:
    """Which of these segments begin a sequence."""
    n = -(-lengths // segment)
    out = np.zeros(int(n.sum()), bool)
    out[(np.cumsum(n) - n)[n > 0]] = True
    return out


def _shard_tokens(b: pa.RecordBatch, i: int, model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class of each word, tokens, lengths, held) of a shard."""
    own = model.word_classes(b.column("words")[i].values.to_pylist())
    return (own, _unpack(b.column("tokens")[i].as_py()), b.column("lengths")[i].values.to_numpy().astype(np.int64),
            b.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool))


def _expect(model: Hmm):
    """One row per class, start and move of a task's expected counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.start)
        starts, moves, emits, likelihood = np.zeros((2, k)), np.zeros((k, k)), np.zeros((len(model.emit), k)), 0.0
        size = model.settings.segment
        for b in batches:
            for i in range(b.num_rows):
                own, tokens, lengths, held = _shard_tokens(b, i, model)
                learnt = tokens[np.repeat(~held, lengths)]
                if len(learnt):
                    texts = lengths[~held]
                    got = expectations(own[learnt], segments(texts, size), model, beginnings(texts, size))
                    starts += got[0]
                    moves += got[1]
                    emits += got[2]
                    likelihood += got[3]
        used = np.flatnonzero(emits.sum(1))
        key = np.concatenate([[-3 - k], -1 - np.arange(k + 2), used]).astype(np.int32)
        rows = np.vstack([np.full(k, likelihood / k), starts, moves, emits[used]])
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(c) for c in rows.T)], names=["key", *(f"c{j}" for j in range(k))])

    return run


def train(shards: DataFrame, model: Hmm) -> list[float]:
    """Baum-Welch: one pass over the shards and one aggregate an iteration.
    Changes the model; returns the log-likelihood before each iteration."""
    s, k = model.settings, model.settings.states
    rng = np.random.default_rng(s.seed)
    weight = (model.class_tokens + 1.0) / (model.class_tokens + 1.0).sum()
    model.start = model.resume = np.full(k, 1 / k)
    model.move = np.full((k, k), 0.1 / max(k - 1, 1)) if k > 1 else np.ones((1, 1))
    if k > 1:
        np.fill_diagonal(model.move, 0.9)
    model.emit = weight[:, None] * rng.gamma(1.0, 1.0, (len(weight), k)).clip(0.05) if k > 1 else weight[:, None]
    model.emit = model.emit / model.emit.sum(0)
    history = []
    columns = [f"c{j}" for j in range(k)]
    used = shards.select("lengths", "held", "tokens", "words")
    for _ in range(s.iterations if model.tokens else 0):
        rows = used.mapInArrow(_expect(model), "key int, " + ", ".join(f"{c} double" for c in columns)) \
            .groupBy("key").agg(*[F.sum(c).alias(c) for c in columns]).collect()
        emits, moves, starts = np.zeros_like(model.emit), np.zeros((k, k)), np.zeros((2, k))
        for r in rows:
            values = np.array(r[1:])
            if r["key"] >= 0:
                emits[r["key"]] = values
            elif r["key"] >= -2:
                starts[-1 - r["key"]] = values
            elif r["key"] >= -2 - k:
                moves[-3 - r["key"]] = values
            else:
                history.append(float(values.sum()))
        model.start, model.resume = (starts + 1) / (starts + 1).sum(1, keepdims=True)
        model.move = (moves + 1) / (moves + 1).sum(1, keepdims=True)
        emits += s.prior * weight[:, None]
        model.emit = emits / emits.sum(0)
    return history


def _scorer(model: Hmm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = -np.log10(model.tokens + model.distinct + 1)
        room = -np.log10(model.class_tokens + model.class_words + 1)
        room[0] = 0
        room[1 + model.settings.classes:] = 0
        for b in batches:
            for i in range(b.num_rows):
                own, tokens, lengths, held = _shard_tokens(b, i, model)
                answers = sorted(zip(b.column("buckets")[i].as_py(), b.column("answers")[i]), key=lambda x: x[0])
                count = np.concatenate([a.values.to_numpy() for _, a in answers])
                ends = np.cumsum(lengths)
                log_count = np.log10(count + 1.0)
                # A word within its class: alone in it, or by smoothed counts.
                inside = np.where((own > 0) & (own <= model.settings.classes), log_count + room[own], 0.0)
                add = lambda v: np.add.reduceat(v[tokens], ends - lengths)
                score = forward(own[tokens], lengths, model) / np.log(10) + add(inside)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_ids")[i].values, pa.array(held), pa.array(lengths), pa.array(add((count > 0).astype(np.int64))),
                     pa.array(np.full(n, model.tokens)), pa.array(add(log_count + base)), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def hmm_scores(docs: DataFrame, held, id_col: str = "doc_id", text_col: str = "text",
               settings: HmmSettings = HmmSettings()) -> DataFrame:
    """Scores every row of ``docs``; rows where ``held`` (a condition over
    ``doc_id``) is true aren't learnt from.  ``base_score`` is the add-one
    unigram's log10 probability, ``score`` the model's."""
    s = settings
    src = id_and_text(docs, id_col, text_col).withColumn("held", held)
    kind = src.schema["doc_id"].dataType.simpleString()
    size = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // s.bucket_bytes))
    shards = cut_lineage(src.mapInArrow(_sharder(buckets, s), _SHARD.format(id=kind)), name="hmm-shards")
    tokens = shards.agg(F.sum("n_train")).first()[0] or 0
    answers = cut_lineage(
        shards.select("shard", "words", "train")
        .mapInArrow(_deal(buckets), "bucket int, shard long, words array<binary>, train array<long>")
        .groupBy("bucket").applyInArrow(_bucket_counter(tokens / s.max_frequent, s), _ANSWER), name="hmm-counts")
    sums = answers.filter("shard is null")
    frequent = sums.select(F.explode(F.arrays_zip("words", "counts")).alias("f")).select("f.words", "f.counts") \
        .orderBy(F.desc("counts"), "words").collect()  # at most max_frequent
    class_rows = sums.select(F.explode(F.arrays_zip("classes", "class_tokens", "class_words")).alias("c")) \
        .groupBy("c.classes").agg(F.sum("c.class_tokens"), F.sum("c.class_words")).collect()  # at most classes + 1
    first = 1 + s.classes
    class_tokens, class_words = (np.zeros(first + len(frequent), np.int64) for _ in range(2))
    for c, n, v in class_rows:
        class_tokens[c], class_words[c] = n, v
    for i, (_, n) in enumerate(frequent):
        class_tokens[first + i], class_words[first + i] = n, 1
    model = Hmm(tokens, int(class_words.sum()), {bytes(w): first + i for i, (w, _) in enumerate(frequent)} | {END: 0},
                class_tokens, class_words, s)
    train(shards, model)
    replies = answers.filter("shard is not null").groupBy("shard") \
        .agg(F.collect_list(F.struct("bucket", "counts")).alias("a")) \
        .select("shard", F.col("a.bucket").alias("buckets"), F.col("a.counts").alias("answers"))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return shards.drop("train", "n_train").join(replies, "shard").mapInArrow(_scorer(model), schema)
