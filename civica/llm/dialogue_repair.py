"""Conversation structure repair: grammar-compressed dynamic programming.

A row becomes one symbol (its role and its fault), a conversation a sequence
of symbols.  Re-Pair replaces the pairs that occur most by rules, over the
distinct sequences of many conversations; each rule has one min-plus matrix
over the states of the wanted role pattern ``(s?(ua)+)?``, the product of the
matrices of its two symbols, with the edits of each entry as a rope.  Rules
are evaluated once, bottom-up, for all conversations that use them.

Two edit lists that lead from one state to different states over the same
rows are never prefixes of one another, as each ends with the edit of a row
and inserts stand before a row.  So the order of two joined lists follows
from the order of their first parts, then of their second parts, and a matrix
needs the rank of its entries in a row instead of their texts.

Defined cases: a null role or text is one space (the query's wish); a null
id is one conversation; rows of equal turn come in the order of their role
and of a digest of role and text, so ties have one result; a repeated row is
a duplicate; an empty or white text is a blank row; texts of any length are
hashed as a stream; an empty table has no conversations; other columns of the
table are ignored, whatever their names.  A task reads the rows of a
conversation in order and holds one slice of symbols and the edits of the
conversation at hand, which are one cell of the result, never its rows.  Its
digest is sequential, so one conversation is one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Letters of distinct sequences that one grammar is built from, and of a sequence worked on at a time.
SLICE_LETTERS = 1 << 16
SPACES = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP_ROLE = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
NEXT_ROLE = (USER, USER, ASSISTANT, USER)  # where a re-roled or inserted turn leads
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: A row's letter: role initial (x: another), upper case if truncated; d: it must go.
LETTERS = "suaxSUAXd"
#: Trailing inserts that complete a conversation, by state.
ENDING = ("", "II", "I", "")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
INFO = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

# A matrix: for each state before, for each state after, (cost, rank in the row, rope) or None.


def _ranked(rows: list[list[tuple | None]]) -> list[list[tuple | None]]:
    """(cost, sort key, rope) entries with the key replaced by its rank."""
    out = []
    for row in rows:
        order = {q: i for i, q in enumerate(sorted((q for q in range(4) if row[q]), key=lambda q: row[q][1]))}
        out.append([(e[0], order[q], e[2]) if e else None for q, e in enumerate(row)])
    return out


def letter_matrix(letter: str) -> list[list[tuple | None]]:
    """All ways past one row: up to two inserts, then its own edit."""
    late = TRUNCATED if letter.isupper() else 0
    rows = []
    for p in range(4):
        best: list[tuple | None] = [None] * 4
        state = p
        for inserts in range(3):
            ways = [(DELETE, "D", state)]
            if letter != "d":
                ways.append((REROLE + late, "R", NEXT_ROLE[state]))
                if (letter.lower(), state) in KEEP_ROLE:
                    ways.append((late, "K", KEEP_ROLE[letter.lower(), state]))
            for cost, edit, q in ways:
                way = (cost + INSERT * inserts, "I" * inserts + edit)
                if best[q] is None or way < best[q][:2]:
                    best[q] = (*way, way[1])
            state = NEXT_ROLE[state]
        rows.append(best)
    return _ranked(rows)


def _step(before: list[tuple | None], after: list[list[tuple | None]]) -> list[tuple | None]:
    """A row of a matrix times a matrix; ropes are pairs of ropes."""
    out: list[tuple | None] = [None] * 4
    for q in range(4):
        best = None
        for m in range(4):
            x, y = before[m], after[m][q]
            if x and y and (best is None or (x[0] + y[0], x[1]) < best[:2]):
                best = (x[0] + y[0], x[1], y[1], (x[2], y[2]))
        if best:
            out[q] = (best[0], best[1:3], best[3])
    return out


def product(a: list, b: list) -> list[list[tuple | None]]:
    return _ranked([_step(row, b) for row in a])


def rope_text(rope) -> str:
    out, stack = [], [rope]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack += (x[1], x[0])
    return "".join(out)


def re_pair(sequences: list[bytes]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules and the sequences written with them.  Symbols below
    ``len(LETTERS)`` are letters, the others rules in order.  Every round
    replaces the most frequent pairs, as long as no symbol is in two of them,
    until no pair occurs twice."""
    table = np.full(256, -1, np.int64)
    table[list(LETTERS.encode())] = np.arange(len(LETTERS))
    s = table[np.frombuffer(b"\n".join(sequences) + b"\n", np.uint8)]
    rules: list[tuple[int, int]] = []
    while len(s) > 1:
        a, b = s[:-1], s[1:]
        new_run = np.concatenate([[True], a[1:] != a[:-1]])
        place = np.arange(len(a))
        start = np.maximum.accumulate(np.where(new_run, place, 0))
        fits = (a >= 0) & (b >= 0) & ((a != b) | ((place - start) % 2 == 0))
        size = len(LETTERS) + len(rules)
        at = place[fits]
        key, which, count = np.unique(a[at] * size + b[at], return_inverse=True, return_counts=True)
        used = np.zeros(size, bool)
        name = np.full(len(key), -1, np.int64)
        for i in np.argsort(-count, kind="stable"):
            if count[i] < 2:
                break
            x, y = divmod(int(key[i]), size)
            if not used[x] and not used[y]:
                used[x] = used[y] = True
                name[i] = len(LETTERS) + len(rules)
                rules.append((x, y))
        if not used.any():
            break
        chosen = name[which] >= 0
        s = s.copy()
        s[at[chosen]] = name[which][chosen]
        s = np.delete(s, at[chosen] + 1)
    ends = np.flatnonzero(s < 0)
    return rules, [s[i:j] for i, j in zip([0, *(ends[:-1] + 1)], ends)]


BEGIN: list[tuple | None] = [(0, 0, ""), None, None, None]


def run_grammar(sequences: list[bytes], before: dict[int, list] | None = None) -> list[list[tuple | None]]:
    """The vector of (cost, rank, rope) by state after each sequence, from
    ``before`` where a sequence goes on from earlier rows, else from the start."""
    rules, coded = re_pair(sequences)
    matrix = [letter_matrix(x) for x in LETTERS]
    for x, y in rules:
        matrix.append(product(matrix[x], matrix[y]))
    out = []
    for i, symbols in enumerate(coded):
        v = (before or {}).get(i, BEGIN)
        for x in symbols.tolist():
            v = _ranked([_step(v, matrix[x])])[0]
        out.append(v)
    return out


def finish(vector: list[tuple | None]) -> tuple[int, str]:
    """Cost and edits of the cheapest way that ends well, the least of ties."""
    ways = [(v[0] + INSERT * len(ENDING[q]), v[1], q) for q, v in enumerate(vector) if v]
    cost, _, q = min(ways)
    return cost, rope_text(vector[q][2]) + ENDING[q]


class _Tally:
    """Counts and letters of one conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.letters, self.vector = conv, bytearray(), None
        self.fault = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.last = self.low = self.turn = None

    def add(self, turn, kind: str, fault: int) -> None:
        if self.last is not None and self.last + kind not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = kind
        if turn is not None and turn != self.turn:
            self.turn = turn
            self.turns += 1
            if self.low is None:
                self.low = turn
        self.fault[fault] += 1
        self.letters += b"d" if fault in (1, 2) else (kind.upper() if fault == 3 else kind).encode()

    def info(self, cost: int) -> tuple:
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        return (gaps, *self.fault[1:], self.illegal, cost)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``conv, turn, kind, fault`` (fault -1: no row, the
    conversation alone) to one row of counts, cost and edits a conversation."""
    waiting: dict[bytes, list[_Tally]] = {}
    held = 0
    now: _Tally | None = None
    conv_type = None

    def flush() -> pa.RecordBatch:
        found = run_grammar(list(waiting))
        done = [(t.conv, *t.info(c), a) for (c, a), ts in zip(map(finish, found), waiting.values()) for t in ts]
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), *(pa.array(c, pa.int64()) for c in columns[1:-1]),
                                           pa.array(columns[-1], pa.string())], names=["conv", *INFO, "audit"])

    def close(t: _Tally) -> Iterator[pa.RecordBatch]:
        nonlocal held
        if t.vector is not None:  # longer than a slice: earlier parts are folded already
            cost, audit = finish(run_grammar([bytes(t.letters)], {0: t.vector})[0])
            row = (t.conv, *t.info(cost), audit)
            types = [conv_type, *[pa.int64()] * len(INFO), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x], y) for x, y in zip(row, types)], names=["conv", *INFO, "audit"])
            return
        same = waiting.setdefault(bytes(t.letters), [])
        held += 8 + (0 if same else len(t.letters))
        t.letters = bytearray()
        same.append(t)
        if held >= SLICE_LETTERS * 8:
            yield flush()
            waiting.clear()
            held = 0

    for b in batches:
        conv_type = b.column("conv").type
        for conv, turn, kind, fault in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "kind", "fault"))):
            if now is None or now.conv != conv:
                if now is not None:
                    yield from close(now)
                now = _Tally(conv)
            if fault >= 0:
                now.add(turn, kind, fault)
                if len(now.letters) >= SLICE_LETTERS:
                    v = run_grammar([bytes(now.letters)], {0: now.vector} if now.vector else None)[0]
                    now.vector = [(x[0], x[1], rope_text(x[2])) if x else None for x in v]
                    now.letters = bytearray()
    if now is not None:
        yield from close(now)
    if waiting:
        yield flush()


def repaired_roles(audit: str, row_kinds: Iterator[str]) -> Iterator[tuple[str, str | None]]:
    """(edit, new role) in order: None for a kept role.  ``row_kinds`` is read
    once for every edit but an insert."""
    state = START
    for edit in audit:
        kind = None if edit == "I" else next(row_kinds)
        if edit == "D":
            yield edit, None
        elif edit == "K":
            state = KEEP_ROLE[kind, state]
            yield edit, None
        else:
            state = NEXT_ROLE[state]
            yield edit, ROLE_OF[state]


def _kind(role: bytes) -> str:
    first = role[:1].decode("latin-1")
    return first if first in ("s", "u", "a") else "x"


class _Writer:
    """Applies the edits of one conversation to its rows as they come."""

    def __init__(self, audit: str):
        self.kind = "x"
        self.edits = repaired_roles(audit, iter(lambda: self.kind, None))

    def inserts(self) -> Iterator[tuple[str, bytes, bytes]]:
        """Past the last row."""
        for edit, role in self.edits:
            yield edit, role.encode(), b""

    def row(self, role: bytes, text: bytes) -> Iterator[tuple[str, bytes, bytes]]:
        self.kind = _kind(role)
        for edit, new in self.edits:
            if edit == "I":
                yield edit, new.encode(), b""
                continue
            if edit != "D":
                yield edit, new.encode() if new else role, text
            return


def _sorted_rows(info: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's edits, then its rows in order."""
    blank = {f.name: F.lit(None).cast(f.dataType) for f in [*info.schema.fields, *rows.schema.fields]}
    names = list(blank)
    both = info.select(F.lit(0).alias("tag"), *[F.col(c) if c in info.columns else blank[c].alias(c) for c in names]).unionAll(
        rows.select(F.lit(1).alias("tag"), *[F.col(c) if c in rows.columns else blank[c].alias(c) for c in names]))
    return both.repartition("conv").sortWithinPartitions("conv", "tag", F.asc_nulls_first("turn"), "role", "key")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, bytes, bytes]]]]:
    """For each conversation in turn, (its id, counts and edits) beside the repaired turns so far, as (new conversation or None, turns)."""
    writer = None
    for b in batches:
        info = list(zip(*(b.column(c).to_pylist() for c in ("conv", *INFO, "audit"))))
        tags = b.column("tag").to_pylist()
        roles = b.column("role").cast(pa.binary()).to_pylist()
        texts = b.column("text").cast(pa.binary()).to_pylist()
        for tag, head, role, text in zip(tags, info, roles, texts):
            if tag == 0:
                if writer:
                    yield None, writer.inserts()
                writer = _Writer(head[-1])
                yield head, iter(())
            else:
                yield None, writer.row(role, text)
    if writer:
        yield None, writer.inserts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_type = None

    def typed() -> Iterator[pa.RecordBatch]:
        nonlocal conv_type
        for b in batches:
            conv_type = b.column("conv").type
            yield b

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        types = [conv_type, *[pa.int64()] * len(INFO), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv", *INFO, "audit", "repaired_sha256"])

    done: list[tuple] = []
    head, digest, some = None, None, False
    for new, turns in _walk(typed()):
        if new is not None:
            if head is not None:
                done.append((*head, digest.hexdigest()))
                if len(done) >= 1000:
                    yield emit(done)
                    done = []
            head, digest, some = new, hashlib.sha256(), False
        for _, role, text in turns:
            if some:
                digest.update(b"\n")
            some = True
            digest.update(role + b":")
            digest.update(text)
    if head is not None:
        done.append((*head, digest.hexdigest()))
    if done:
        yield emit(done)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, place, done, conv_type = None, 0, [], None

    def typed() -> Iterator[pa.RecordBatch]:
        nonlocal conv_type
        for b in batches:
            conv_type = b.column("conv").type
            yield b

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        types = [conv_type, pa.int64(), pa.string(), pa.binary(), pa.binary()]
        a = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([*a[:3], a[3].cast(pa.string()), a[4].cast(pa.string())], names=["conv", "position", "edit", "role", "text"])

    size = 0
    for new, turns in _walk(typed()):
        if new is not None:
            conv, place = new[0], 0
        for edit, role, text in turns:
            done.append((conv, place, edit, role, text))
            place += 1
            size += len(text) + 50
        if size > 4 << 20:
            yield emit(done)
            done, size = [], 0
    if done:
        yield emit(done)


def _order_key(role: Column, text: Column) -> Column:
    """A digest of role and text; the length keeps their border."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def _prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    one_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    out = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                      one_space(role_col).alias("role"), one_space(text_col).alias("text"))
    return out.withColumn("key", _order_key(F.col("role"), F.col("text")))


def conversation_edits(prepared: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """``conv``, the counts, the cost and the edits.  No text is moved: the
    rows of a conversation are brought together without it."""
    body = F.rtrim("text", F.lit(SPACES))
    fault = F.when(body == "", 1).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    first = F.substring("role", 1, 1)
    narrow = prepared.select("conv", "turn", "role", "key", F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("kind"), fault.alias("own"))
    seen = F.row_number().over(Window.partitionBy("conv", "key").orderBy(F.asc_nulls_first("turn")))
    rows = narrow.withColumn("seen", seen).select(
        "conv", "turn", "role", "key", "kind", F.when(F.col("own") == 1, 1).when(F.col("seen") > 1, 2).otherwise(F.col("own")).alias("fault"))
    if also is not None:
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[1:-1]]
        rows = rows.unionAll(also.select(also.columns[0], *absent, F.lit(-1)))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "key").drop("role", "key")
    schema = T.StructType([T.StructField("conv", prepared.schema["conv"].dataType), *[T.StructField(c, T.LongType()) for c in INFO],
                           T.StructField("audit", T.StringType())])
    return ordered.mapInArrow(_edits, schema)


def repair_report(rows: DataFrame, also: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: gaps in its turns, faults, cost, edits
    (``audit``) and the SHA-256 of its repaired turns, ``role:text`` by line.
    ``also`` has ids, in its first column, of conversations to report even
    without rows."""
    p = _prepared(rows, conv_col, turn_col, role_col, text_col)
    info = conversation_edits(p, also)
    schema = T.StructType([*info.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    return _sorted_rows(info, p).mapInArrow(_digests, schema).withColumnRenamed("conv", conv_col)


def repaired_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The repaired conversations: id, position, edit, role and text."""
    p = _prepared(rows, conv_col, turn_col, role_col, text_col)
    schema = T.StructType([p.schema["conv"], T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return _sorted_rows(conversation_edits(p), p).mapInArrow(_turns, schema).withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with the faults the contract asks for, and the ids
    of the rows that it drops."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    cut = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), cut.alias("cut"))
    text = F.when(F.col("cut") == 1, "").when(F.col("cut") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("cut") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("cut") == 4, "user").otherwise(F.col("role"))
    kept = marked.filter("cut <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))
    return kept.drop("copy"), marked.filter("cut = 0").select("conv_id")
