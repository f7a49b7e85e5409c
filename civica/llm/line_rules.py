"""Line-first cleaning of texts.

Each line is judged alone by punctuation, navigation and boilerplate rules;
lines that fail are removed; a document that loses too much of its text goes.
Document statistics (repeated lines, repeated word windows, symbols) reject
a document before that.

Defined cases: a null or empty text has no words, no lines to judge and is
not kept (it has fewer than ``min_words`` words); white-space-only lines are
never removed; of several rules that a line fails the first counts; repeated
rows get the same verdict; texts of any length are read whole; null ids stay
null; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.common import (CONTINUATION, SPACE, SYMBOL, ascii_words, byte_counts, codes, doc_slices, id_and_text,
                               repeated_windows, sums, utf8)

BOILERPLATE = ("all rights reserved", "click here", "cookie policy", "cookies", "enable javascript", "javascript must",
               "log in", "lorem ipsum", "privacy policy", "read more", "sign in", "sign up", "subscribe to",
               "terms of service", "terms of use")
SEPARATORS = "|»›·•→←"
LINE_END = r"""[.!?…:;。！？][)\]}"'’”»]*$"""
INNER_PUNCTUATION = r"[.!?,;:…。！？、，]"
_END, _INNER = re.compile(LINE_END), re.compile(INNER_PUNCTUATION)
_SEPARATOR = re.compile(f"[{re.escape(SEPARATORS)}]")


@dataclass(frozen=True)
class LineRules:
    """``min_line_words``: a line of fewer words without any punctuation is a
    heading or a menu entry.  ``max_loss``: share of the characters that a
    document may lose."""

    min_words: int = 50
    max_repeat_percent: int = 50
    window: int = 3
    min_line_words: int = 3
    max_separators: int = 2
    max_loss: float = 0.5
    boilerplate: tuple[str, ...] = BOILERPLATE


def line_fails(line: str, rules: LineRules) -> str | None:
    """The first rule that a line with a word fails, or None."""
    if len(_SEPARATOR.findall(line)) > rules.max_separators:
        return "navigation"
    low = line.lower()
    if any(p in low for p in rules.boilerplate):
        return "boilerplate"
    if not _END.search(line.rstrip()) and (not _INNER.search(line) or len(line.split()) < rules.min_line_words):
        return "punctuation"
    return None


def clean_text(text: str, rules: LineRules) -> tuple[str, dict[str, int], int, int]:
    """The text without its failing lines, failures by rule, and characters
    other than line ends before and after."""
    kept, failed, before, after = [], {"punctuation": 0, "navigation": 0, "boilerplate": 0}, 0, 0
    for line in text.split("\n"):
        before += len(line)
        why = line_fails(line, rules) if line.strip() else None
        if why:
            failed[why] += 1
        else:
            kept.append(line)
            after += len(line)
    return "\n".join(kept), failed, before, after


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules(),
               with_text: bool = True) -> DataFrame:
    """Per document its statistics, the lines failed by rule, the share of
    text lost, the verdict, and (``with_text``) the cleaned text."""
    src = id_and_text(docs, id_col, text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches):
            column = part.column("text")
            raw = utf8(column)
            words, count = ascii_words(raw)
            ends = np.cumsum(count)
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            space, more, symbols = byte_counts(column, SPACE, CONTINUATION, SYMBOL)
            repeat = sums(repeated_windows(codes(words), count, rules.window), ends - count, ends)
            dup = np.empty(len(raw), np.int64)
            for i, t in enumerate(raw):
                lines = [x for x in t.split(b"\n") if x.strip()]
                dup[i] = len(lines) - len(set(lines))
            failed_base = (count < rules.min_words) | (100 * repeat > rules.max_repeat_percent * count)
            cleaned = [clean_text(t, rules) for t in column.to_pylist()]
            before = np.array([c[2] for c in cleaned], np.int64)
            after = np.array([c[3] for c in cleaned], np.int64)
            lost = np.where(before > 0, 1 - after / np.maximum(before, 1), 0.0)
            out = {"doc_id": part.column("doc_id"), "n_words": count, "word_chars": size - space - more,
                   "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": failed_base,
                   "kept": ~failed_base & (lost <= rules.max_loss), "lost": lost}
            out |= {f"n_{k}": np.array([c[1][k] for c in cleaned], np.int64)
                    for k in ("punctuation", "navigation", "boilerplate")}
            if with_text:
                out["cleaned"] = pa.array([c[0] for c in cleaned], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in out.values()],
                                             names=list(out))

    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, " \
        "n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, lost double, n_punctuation long, " \
        "n_navigation long, n_boilerplate long" + (", cleaned string" if with_text else "")
    return src.mapInArrow(judge, schema)


def keep_clean(docs: DataFrame, **options) -> DataFrame:
    """Ids and cleaned texts of the documents that stay."""
    return line_rules(docs, **options).filter("kept").select("doc_id", F.col("cleaned").alias("text"))
