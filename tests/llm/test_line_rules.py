import re
from collections import Counter

import pytest

from civica.llm import line_rules as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 200 else len(lines) - len(set(lines))
    triple = list(zip(w, w[1:], w[2:]))
    times = Counter(triple)
    hit = {i + k for i, t in enumerate(triple) if times[t] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_match_brute_force(docs, texts):
    rows = L.line_rules(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            assert tuple(r[c] for c in COLUMNS) == brute(texts[r["doc_id"]]), r["doc_id"]


def test_base_failure_is_never_kept(docs):
    assert not [r for r in L.line_rules(docs).collect() if r["base_failed"] and r["kept"]]


@pytest.mark.parametrize("line, rule", [
    ("Home | News | Sport | Contact", "navigation"), ("Please read our Privacy Policy.", "boilerplate"),
    ("Main menu", "punctuation"), ("A sentence without an end, but with a comma", None),
    ("A whole sentence.", None), ("Quoted “end.”", None), ("終わり。", None)])
def test_rules_judge_single_lines(line, rule):
    assert L.line_fails(line, L.LineRules()) == rule


def test_document_that_loses_too_much_goes(llm):
    good = "\n".join(f"Sentence {i} of clean text{i} has its{i} own words{i}." for i in range(10))
    menu = "\n".join(f"Home{i} | News{i} | Sport{i} | Contact{i} | More{i} | Links{i} | Terms{i}" for i in range(10))
    df = llm.createDataFrame([(1, good), (2, menu), (3, good + "\n" + menu[:200])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.line_rules(df).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3)] == [True, False, True]
    assert got[3]["cleaned"].startswith(good) and "|" not in got[3]["cleaned"].split("\n")[0]
    assert got[1]["cleaned"] == good and got[1]["lost"] == 0
    assert {r["doc_id"] for r in L.keep_clean(df).collect()} == {1, 3}


def test_empty_table(no_docs):
    assert L.line_rules(no_docs).count() == 0
