import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civica.llm import qda_quality as Q
from civica.llm.common import held_out
from llm.conftest import prose


@pytest.fixture(scope="module")
def labelled(llm):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(rng, rng.randint(5, 150))
        if bad:
            text = rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: " ".join([t.split()[0]] * 80),
                               lambda t: t.replace(" ", "%%% $$$ ")])(text)
        rows.append((i, text, i, "s"))
        labels.append((i, int(not bad)))
    docs = llm.createDataFrame(rows, "doc_id long, text string, label int, source string")
    return docs, llm.createDataFrame(labels, "doc_id long, label int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    learn = labels.withColumn("h", held_out("doc_id", 5, 0)).filter("not h").drop("h")
    scores = Q.quality_scores(docs, learn)
    got = scores.join(labels, "doc_id").filter(held_out("doc_id", 5, 0)).collect()
    assert len(got) > 40
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([(r["score"] >= 0.3) == (r["label"] == 1) for r in got]) > 0.95


def test_log_density_is_the_gaussians(labelled):
    docs, labels = labelled
    features = Q.quality_features(docs)
    model = Q.fit_qda(features, labels, shrink_pooled=0.0, shrink_diagonal=0.0, ridge=1e-3)
    x = np.array([[r[f] for f in Q.FEATURES] for r in features.orderBy("doc_id").collect()])
    y = np.arange(len(x)) % 4 != 0
    d = x.shape[1]
    for mask, g in ((y, model.good), (~y, model.bad)):
        n = mask.sum()
        own = np.cov(x[mask].T, bias=True)
        pooled = (y.sum() * np.cov(x[y].T, bias=True) + (~y).sum() * np.cov(x[~y].T, bias=True)) / len(x)
        w = d / (n + d)
        cov = (1 - w) * own + w * pooled + 1e-3 * np.eye(d)
        diff = x - x[mask].mean(0)
        want = -0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1]
        assert np.allclose(g.log_density(x), want, rtol=1e-6, atol=1e-6)


def test_edge_texts_get_scores(docs, labelled):
    scores = Q.quality_scores(docs, labelled[1])
    got = scores.collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)


def test_one_class_or_none(docs, no_docs, llm):
    none = llm.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in Q.quality_scores(docs, none).collect()} == {0.5}
    one = llm.createDataFrame([(6, 1), (8, 1), (None, 0), (20, None), (21, 7)], "doc_id long, label int")
    assert {r["score"] for r in Q.quality_scores(docs, one).collect()} == {4 / 5}  # document 6 is there twice
    assert Q.quality_scores(no_docs, one).count() == 0


def test_keep_quality_returns_rows_as_they_are(labelled):
    docs, labels = labelled
    model = Q.fit_qda(Q.quality_features(docs), labels)
    kept = Q.keep_quality(docs, labels, 0.3)
    assert kept.columns == docs.columns
    scores = Q.score_features(Q.quality_features(docs), model).filter("score >= 0.3")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scores.collect()}
    assert 0 < len(kept.collect()) < docs.count()
    assert kept.join(docs, ["doc_id", "text", "label", "source"], "left_anti").count() == 0


def test_features_do_not_depend_on_neighbours(docs):
    together = {r["doc_id"]: r for r in Q.quality_features(docs.filter("doc_id > 2").coalesce(1)).collect()}
    apart = {r["doc_id"]: r for r in Q.quality_features(docs.filter("doc_id > 2").repartition(20, F.col("doc_id"))).collect()}
    assert together == apart


def plain_features(text):
    """The sixteen statistics of one text, counted plainly."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, chars = len(words), max(len(text), 1)
    size = [len(w.encode()) for w in words]
    times = Counter(words)
    triples = list(zip(words, words[1:], words[2:]))
    often = Counter(triples)
    repeated = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    among = lambda s: sum(text.count(c) for c in s)
    share = lambda a: math.sqrt(a / (n + Q.FEW))
    by_char = lambda a: math.sqrt(a / (chars + 6 * Q.FEW))
    return {
        "log_words": math.log1p(n), "word_length": math.log((sum(map(len, words)) + 5 * Q.FEW) / (n + Q.FEW)),
        "long_words": share(sum(s > 12 for s in size)), "short_words": share(sum(s <= 3 for s in size)),
        "upper": by_char(len(re.findall("[A-Z]", text))), "digits": by_char(len(re.findall("[0-9]", text))),
        "symbols": by_char(among("#*$%&|<>")), "commas": share(among(",;:")), "stops": share(among(".?")),
        "bangs": share(among("!")), "pipes": share(among("|")), "distinct": 1 - (n - len(times)) / (n + Q.FEW),
        "top_word": share(max([*times.values(), 1]) - 1), "repeated": share(len(repeated)),
        "dup_lines": math.sqrt((len(lines) - len(set(lines))) / (len(lines) + 2)),
        "line_words": math.log1p(n / (text.count("\n") + 1))}


def test_statistics_match_a_plain_count(docs, labelled):
    for df in (docs, labelled[0].limit(60)):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        for r in Q.quality_features(df).collect():
            want = plain_features(texts[r["doc_id"]])
            assert {f: round(r[f], 9) for f in Q.FEATURES} == {f: round(v, 9) for f, v in want.items()}, r["doc_id"]
