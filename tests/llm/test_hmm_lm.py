import itertools
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from civica.llm import hmm_lm as H
from civica.llm.common import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def is_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def model(k=3, n=5, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    s = H.HmmSettings(states=k, segment=4, batch=3)
    m = H.Hmm(1, 1, {}, np.ones(n), np.ones(n), s)
    m.start, m.move, m.emit = norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((n, k)), 0)
    return m


def paths(seq, m):
    """(path, probability) of every path of states."""
    for path in itertools.product(range(len(m.start)), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for a, b, x in zip(path, path[1:], seq[1:]):
            p *= m.move[a, b] * m.emit[x, b]
        yield path, p


def test_forward_is_the_sum_over_paths():
    m = model()
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, 5, n) for n in (1, 6, 3, 3, 2)]
    got = H.forward(np.concatenate(seqs), np.array([len(s) for s in seqs]), m)
    want = [math.log(sum(p for _, p in paths(s, m))) for s in seqs]
    assert np.allclose(got, want)


@pytest.mark.parametrize("begins", [[True] * 7, [True, False, True, False, False, True, False]])
def test_expectations_are_the_sums_over_paths(begins):
    m = model()
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 5, n) for n in (4, 1, 3, 4, 2, 2, 1)]
    begins = np.array(begins)
    m.resume = np.array([0.2, 0.7, 0.1])
    starts, moves, emits, likelihood = H.expectations(np.concatenate(seqs), np.array([len(s) for s in seqs]), m, begins)
    want_s, want_m, want_e, total = np.zeros((2, 3)), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for s, fresh in zip(seqs, begins):
        own = m if fresh else replace(m, start=m.resume)
        z = sum(p for _, p in paths(s, own))
        total += math.log(z)
        for path, p in paths(s, own):
            want_s[0 if fresh else 1, path[0]] += p / z
            for a, b in zip(path, path[1:]):
                want_m[a, b] += p / z
            for x, a in zip(s, path):
                want_e[x, a] += p / z
    assert np.allclose(starts, want_s) and np.allclose(moves, want_m) and np.allclose(emits, want_e)
    assert math.isclose(likelihood, total)


def test_segments_cover_every_token():
    lengths = np.array([1, 4, 5, 8, 11])
    assert H.segments(lengths, 4).tolist() == [1, 4, 4, 1, 4, 4, 4, 4, 3]
    assert H.beginnings(lengths, 4).tolist() == [True, True, True, False, True, False, True, False, False]


SETTINGS = H.HmmSettings(states=3, iterations=3, max_frequent=20, classes=16, shard_bytes=2000, bucket_bytes=10_000)


@pytest.fixture(scope="module")
def scored(llm, docs):
    return [r.asDict() for r in H.hmm_scores(docs, held_out("doc_id", 7, 2), settings=SETTINGS).collect()]


def test_counts_and_base_match_brute_force(docs, texts, scored):
    every = [(r["doc_id"], tokens(r["text"])) for r in docs.collect()]
    count = Counter(t for k, w in every if not is_held(k) for t in w)
    n, v = sum(count.values()), len(count)
    assert len(scored) == len(every)
    by = {r["doc_id"]: r for r in scored}
    for k, w in every:
        r = by[k]
        assert r["held_out"] == is_held(k) and r["n_tokens"] == len(w) and r["train_tokens"] == n
        assert r["n_known"] == sum(count[t] > 0 for t in w)
        assert math.isclose(r["base_score"], sum(math.log10((count[t] + 1) / (n + v + 1)) for t in w), rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_training_raises_the_likelihood(llm, docs):
    history = []
    own = H.train

    def keep(shards, m):
        history.extend(own(shards, m))
        assert np.isclose(m.emit.sum(0), 1).all() and np.isclose(m.move.sum(1), 1).all()
        # Within a class the known words and one unknown word share all mass.
        return history

    H.train = keep
    try:
        H.hmm_scores(docs, F.lit(False), settings=H.HmmSettings(states=3, iterations=5, max_frequent=20, classes=16, prior=0.0)).count()
    finally:
        H.train = own
    assert len(history) == 5 and all(b > a - 1e-6 * abs(a) for a, b in zip(history, history[1:]))


def test_order_matters_and_held_out_beats_unigram(llm):
    rng = random.Random(0)
    langs = [[f"{p}{i}" for i in range(25)] for p in "abc"]
    rows = []
    for i in range(300):
        w = rng.choice(langs)
        rows.append((i, " ".join(rng.choice(w) for _ in range(40))))
    mixed = [w for _, t in rows[:40] for w in t.split()]
    rng.shuffle(mixed)
    rows += [(1000 + i, " ".join(mixed[40 * i: 40 * i + 40])) for i in range(20)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    got = H.hmm_scores(df, F.expr("doc_id % 7 = 2 or doc_id >= 1000"),
                       settings=H.HmmSettings(states=4, iterations=12, segment=16, max_frequent=500)).collect()
    clean = [r["score"] - r["base_score"] for r in got if r["held_out"] and r["doc_id"] < 1000]
    noise = [r["score"] - r["base_score"] for r in got if r["doc_id"] >= 1000]
    assert np.mean(clean) > 5 and np.mean(clean) > np.mean(noise) + 5


def test_no_training_rows_and_empty_table(llm, docs, no_docs):
    got = H.hmm_scores(docs, F.lit(True), settings=SETTINGS).collect()
    assert all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in got)
    assert H.hmm_scores(no_docs, F.lit(False), settings=SETTINGS).count() == 0


def test_start_is_learnt_at_beginnings_alone(llm):
    """Texts longer than a segment that open with one word: only it begins a text."""
    rows = [(i, "open " + "a b c " * 20) for i in range(40)]
    models = []
    own = H.train

    def keep(shards, m):
        models.append(m)
        return own(shards, m)

    H.train = keep
    try:
        H.hmm_scores(llm.createDataFrame(rows, "doc_id long, text string"), F.lit(False),
                     settings=H.HmmSettings(states=4, iterations=30, segment=7, max_frequent=500, classes=4, prior=0.1)).count()
    finally:
        H.train = own
    m = models[0]
    first = m.frequent[b"open"]
    assert m.start @ m.emit[first] > 0.8 and m.resume @ m.emit[first] < 0.1
