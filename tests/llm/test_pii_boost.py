import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from civica.llm import pii_boost as P
from tests.llm.conftest import prose


def brute(text):
    out = []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2:
                total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if k == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_patterns_match_brute_force():
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice("a1+.@ -(9é") for _ in range(rng.randint(0, 40)))
        assert P.base_spans(t) == brute(t), t
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111", "x4111111111111111 5", "0" * 19]
    for t in [*cards, "256.1.1.1 000255.1.1.1 1.2.3.4.5.6.7.8", "a@b.c_d@e.f@g.h", "+1 (017) 555-7713.. +12345678+1", ""]:
        assert P.base_spans(t) == brute(t), t


@pytest.mark.parametrize("unit", ["1", "a", "1.", "@a.b", "+1 ", "a@", " ", "+1(", "1 ", "0.0.0.", "a.b@c ", "(at)a"])
def test_long_runs_take_linear_time(unit):
    def seconds(n):
        began = time.perf_counter()
        P.judged_spans(unit * (n // len(unit)))
        return time.perf_counter() - began
    seconds(1000)
    assert seconds(200_000) < 0.2 + 30 * seconds(20_000)


def test_boosted_trees_learn_and_are_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = P.calibrated(P.boost(x[:2000], y[:2000]), x[2000:], y[2000:], np.ones(2000), 0.95)
    p = m.probability(x[2000:])
    assert np.mean((p > 0.5) == y[2000:]) > 0.97
    passed = p >= m.threshold
    assert y[2000:][passed].mean() >= 0.95 and passed.sum() > 800
    noise = P.calibrated(P.boost(x[:2000], rng.integers(0, 2, 2000).astype(float)), x[2000:], rng.integers(0, 2, 2000).astype(float), np.ones(2000), 0.95)
    assert (noise.probability(x) >= noise.threshold).mean() < 0.05


def planted(n=600):
    """Phones after 'call', a few without the plus; other numbers elsewhere."""
    rng = random.Random(8)
    rows, soft = [], {}
    for i in range(n):
        phone = f"1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        if i % 40 == 7:
            text = f"{prose(rng, 30)} call {phone} now"
            soft[i] = (text.index(phone), text.index(phone) + len(phone))
        elif i % 2:
            text = f"{prose(rng, 30)} call +{phone} now"
        else:
            text = f"{prose(rng, 30)} order {rng.randint(10**7, 10**9)} of part {rng.randint(10**7, 10**9)}"
        rows.append((i, text, "x", 0))
    return rows, soft


def test_soft_spans_are_found_and_other_numbers_left(llm):
    rows, soft = planted()
    df = llm.createDataFrame(rows, "doc_id long, text string, spans string, found int")
    got = {r["doc_id"]: r["spans"] for r in P.pii_spans(df, precision=0.9).collect()}
    assert len(got) == len(rows)
    found = {i: (s["start"], s["end"]) for i, spans in got.items() for s in spans if s["kind"] == "soft_phone"}
    assert len(set(found.items()) & set(soft.items())) >= 0.8 * len(soft)
    assert not set(found) - set(soft)
    text = {r["doc_id"]: r["text"] for r in P.redact(df, precision=0.9).collect()}
    assert all("[PHONE]" in text[i] and "555-" not in text[i] for i in found)
    assert text[0] == rows[0][1]


def judged(llm, n=600):
    """Spans of two kinds with overlapping features, a kind too rare to be
    learnt, a null id, repeated rows; and the same rows in memory."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        spans = []
        for kind in (1, 3):
            for j in range(8):
                base = j < 3
                x = rng.integers(0, 6, len(P.FEATURES)).astype(float)
                x[kind] = rng.integers(0, 60) + 25 * base
                spans.append((kind, j, j + 1, base, x.tolist()))
        rows.append((None if i % 50 == 3 else i, spans + [(0, 0, 1, True, [1.0] * len(P.FEATURES))] * (i < 9)))
    rows += rows[:40]
    df = llm.createDataFrame(rows, f"doc_id long, found array<{P._SPAN}>")
    held = dict(df.selectExpr("doc_id", "pmod(xxhash64(cast(doc_id as string)), 4) = 0").distinct().collect())
    return df, [(held[i], *s) for i, spans in rows for s in spans]


def test_models_come_from_every_candidate(llm, monkeypatch):
    """Label weights of an eighth and less: the trees, the calibration and
    the threshold are those of all rows, however these are dealt."""
    monkeypatch.setattr(P, "TREES", P.TREES_PER_WRITE + 1)  # once beyond the writing of the margins
    df, flat = judged(llm)
    weight, precision = 240.0, 0.8  # 1/8 of 1,920 base spans, 3/40 of 3,200 others
    got = P.fit_kinds(df.repartition(1), "found", "doc_id", weight, precision)
    assert set(got) == {1, 3}
    for kind, m in got.items():
        rows = [r for r in flat if r[1] == kind]
        held, y, x = np.array([r[0] for r in rows]), np.array([float(r[4]) for r in rows]), np.array([r[5] for r in rows])
        assert (y.sum(), len(y)) == (1920, 5120) and 0 < held.sum() < len(y)
        each = np.where(y == 1, weight / y.sum(), weight / (1 - y).sum())
        want = P.calibrated(P.boost(x[~held], y[~held], trees=P.TREES, weight=each[~held]), x[held], y[held], np.ones(held.sum()), precision)
        assert np.allclose(m.probability(x), want.probability(x), atol=1e-6)
        assert m.threshold == pytest.approx(want.threshold, abs=1e-6) and m.threshold < 1
        passed = m.probability(x[held]) >= m.threshold
        assert y[held][passed].mean() >= precision and passed.sum() > 100
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = llm.conf.get(coalesce)
    llm.conf.set(coalesce, "false")  # several ranges of probabilities
    try:
        again = P.fit_kinds(df.repartition(7), "found", "doc_id", weight, precision)
    finally:
        llm.conf.set(coalesce, before)
    for kind, m in got.items():
        for name in ("start", "feature", "border", "leaf", "slope", "offset", "threshold"):
            assert np.array_equal(getattr(m, name), getattr(again[kind], name)), name


def test_thresholds_over_ranges_of_probabilities(llm):
    """Sums go on from range to range, per kind; equal probabilities pass
    together; a kind without examples keeps its model."""
    rng = np.random.default_rng(6)
    model = P.unsplit(1, 1, 1, 1)
    z = {k: np.round(rng.normal(size=3000), 2) for k in (0, 2)}
    y = {k: (rng.random(3000) < 1 / (1 + np.exp(-3 * v))).astype(int) for k, v in z.items()}
    rows = [(k, float(a), int(b), 1 - int(b)) for k in z for a, b in zip(z[k], y[k])] + [(3, 0.5, 0, 2)]
    margins = llm.createDataFrame(rows, "kind int, margin double, good long, bad long").groupBy("kind", "margin") \
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = llm.conf.get(coalesce)
    llm.conf.set(coalesce, "false")
    try:
        got = P.calibrate_kinds(margins, {0: model, 2: model, 3: model}, 0.9)
    finally:
        llm.conf.set(coalesce, before)
    assert got[3] is model
    for k in z:
        p = 1 / (1 + np.exp(-(got[k].slope * z[k] + got[k].offset)))
        passing = [v for v in np.unique(p) if y[k][p >= v].mean() >= 0.9]
        assert got[k].threshold == pytest.approx(min(passing), abs=1e-12) and got[k].slope > 2


def test_edge_cases(docs, no_docs, texts):
    rows = P.pii_report(P.pii_spans(docs)).collect()
    assert len(rows) == len(texts) + 2
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" and r["n_soft"] == 0 for r in rows)
    assert P.pii_report(P.pii_spans(no_docs)).count() == 0
    assert P.redact(docs).select(docs.columns).exceptAll(docs).count() == 0


def test_report_joins_kinds_in_order(llm):
    t = "é a@b.cd 1.2.3.4; +1 (017) 555-7713; 4111111111111111"
    r, = P.pii_report(P.pii_spans(llm.createDataFrame([(None, t)], "doc_id long, text string"))).collect()
    want = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in brute(t))
    assert r["spans"] == want and r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
