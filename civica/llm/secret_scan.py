"""Secret scans: patterns, and a token-efficiency test for random strings.

A tokenizer's merges are learnt from running text, so words take few tokens
and random strings take many.  A string whose characters-per-token ratio is
low, and that is no digest, UUID or known string, is reported as ``random``:
whole, or the parts of it between separators that are long enough.

Defined cases: a null or empty text has no spans; texts of any length are
scanned whole, in time that grows with their length and not with the square of
their spans; a repeated row gets the same spans again; spans of equal start
come in the order of KINDS; offsets are code points, the end is exclusive;
null ids stay null; an empty table gives an empty result; other columns are
ignored, whatever their names, or kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.common import doc_slices, id_and_text
from civica.llm.vocab import tiktoken_encoding

KINDS = ("assign", "access", "hex", "random")
# re.A keeps the case folding of the key words to ASCII letters.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I | re.A)
_UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I | re.A)
_PART = re.compile(r"[^+/_=-]+")
# Where a UUID stands between separators.
_UUID_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){_UUID.pattern}(?![A-Za-z0-9])", re.I | re.A)

SPANS = "array<struct<kind: string, start: int, end: int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, not sorted.

    ``AKIA…`` and hex runs that are too short can't hold a longer match, so
    their length is part of the pattern; an assignment is filtered after
    matching."""
    out = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return out


def is_known(s: str, known: frozenset[str]) -> bool:
    """Digests by their length, UUIDs, and strings whose SHA-256 is on the
    caller's list."""
    if _DIGEST.fullmatch(s) or _UUID.fullmatch(s):
        return True
    return bool(known) and hashlib.sha256(s.encode()).hexdigest() in known


def _unknown(s: str, known: frozenset[str]) -> Iterator[tuple[int, int]]:
    """The stretches of a run between the known strings in it, which stand
    between separators."""
    if is_known(s, known):
        return
    skip = [m.span() for m in _UUID_INSIDE.finditer(s)]
    skip += [m.span() for m in _PART.finditer(s) if is_known(m[0], known)]
    a = 0
    for x, y in sorted(skip):
        yield a, x
        a = y
    yield a, len(s)


def scan_text(text: str, encode, pattern: re.Pattern, max_ratio: float, known: frozenset[str],
              min_length: int = 16) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all secrets, sorted.  A run is judged
    whole, and where that finds nothing, part by part: words around a secret
    raise the ratio of the whole."""
    base = sorted(base_spans(text))
    found = list(base)
    starts = [x for x, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # the farthest end of the spans so far

    def random(a: int, b: int) -> bool:
        before = bisect_left(starts, b)  # spans that begin before the end
        return b - a >= min_length and not (before and reach[before - 1] > a) and b - a < max_ratio * len(encode(text[a:b]))

    for m in pattern.finditer(text):
        for a, b in _unknown(m[0], known):
            a, b = a + m.start(), b + m.start()
            if random(a, b):
                found.append((a, 3, b))
            else:
                found += [(p.start(), 3, p.end()) for p in _PART.finditer(text, a, b) if p.end() - p.start() < b - a and random(*p.span())]
    return sorted(found)


def secret_spans(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 min_length: int = 16, max_ratio: float = 2.0, known_digests: Iterable[str] = ()) -> DataFrame:
    """``doc_id, spans``: every secret of every text, by start and kind.

    ``vocabulary`` is a tiktoken rank file and ``pattern`` its splitting
    pattern; ``known_digests`` are SHA-256 sums of strings to leave alone.
    A random span that overlaps a pattern's match is that match."""
    known = frozenset(known_digests)
    run = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{min_length},}}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken_encoding(vocabulary, pattern).encode_ordinary
        runs = re.compile(run)
        for part in doc_slices(batches):
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan_text(t, encode, runs, max_ratio, known, min_length)]
                    for t in part.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    src = id_and_text(docs, id_col, text_col)
    return src.mapInArrow(scan, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def span_text(spans):
    """``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def secret_report(spans: DataFrame) -> DataFrame:
    """Counts per pattern, the digest of the pattern matches, all spans."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return spans.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"), count("random").alias("n_random"))


def redact(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", mark: str = "[REDACTED]",
           min_length: int = 16, max_ratio: float = 2.0, known_digests: Iterable[str] = (),
           length_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with every secret span of the text replaced by
    ``mark``; other columns stay, but for ``length_col``, which gets the new
    length.  Overlapping spans are replaced as one.  A null text stays null."""
    known = frozenset(known_digests)
    run = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{min_length},}}"
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken_encoding(vocabulary, pattern).encode_ordinary
        runs = re.compile(run)
        for part in doc_slices(batches, text_col):
            texts = part.column(text_col).to_pylist()
            changed = {}
            for i, t in enumerate(texts):
                if t and (spans := scan_text(t, encode, runs, max_ratio, known, min_length)):
                    out, end = [], 0
                    for a, _, b in spans:
                        if a >= end:
                            out += [t[end:a], mark]
                        end = max(end, b)
                    texts[i] = "".join([*out, t[end:]])
                    changed[i] = len(texts[i])
            columns = list(part.columns)
            if changed:
                columns[names.index(text_col)] = pa.array(texts, pa.string())
                if length_col:
                    k = names.index(length_col)
                    sizes = columns[k].to_pylist()
                    for i, n in changed.items():
                        sizes[i] = n
                    columns[k] = pa.array(sizes, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(clean, docs.schema)
