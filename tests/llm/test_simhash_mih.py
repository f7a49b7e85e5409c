import random

import numpy as np
import pytest
import xxhash

from civica.llm import simhash_mih as M


def brute_fp(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", words)]
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance=3):
    """The smallest id reachable, per id."""
    ids = sorted(fps)
    least = {i: i for i in ids}
    for i in ids:
        if least[i] != i:
            continue
        stack = [i]
        while stack:
            a = stack.pop()
            for b in ids:
                if least[b] == b and b != i and (fps[a] ^ fps[b]).bit_count() <= distance:
                    least[b] = i
                    stack.append(b)
    return least


def test_fingerprints_match_brute_force(docs, texts):
    got = M.simhash_components(docs).withColumn("hex", M.fingerprint_hex("fp")).collect()
    assert len(got) == docs.count()
    fps = {k: brute_fp(t) for k, t in texts.items()}
    least = brute_components(fps)
    for r in got:
        if r["doc_id"] is not None:
            assert int(r["hex"], 16) == fps[r["doc_id"]] and len(r["hex"]) == 16
            assert r["component_id"] == least[r["doc_id"]]


def cluster(rng, centers, each, flips):
    out = []
    for _ in range(centers):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return out + [0, (1 << 64) - 1, 1 << 63, 7]


def fp_frame(llm, values):
    rows = [(int(np.uint64(v).astype(np.int64)),) for v in sorted(set(values))]
    return llm.createDataFrame(rows, "fp long")


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket_rows", [32768, 2])
def test_links_connect_what_brute_force_connects(llm, distance, bucket_rows):
    rng = random.Random(distance)
    values = cluster(rng, 4, 25, 6)
    frame = fp_frame(llm, values)
    links = M.near_links(frame, distance, bucket_rows)
    rows = links.collect()
    assert all(((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= distance for r in rows)
    fps = {r["fp"]: r["fp"] & ((1 << 64) - 1) for r in frame.collect()}
    want = brute_components(fps, distance)
    got = {r["node"]: r["root"] for r in M.components(links).collect()}
    assert {k: got.get(k, k) for k in fps} == want


def test_dense_bucket_stays_linear(llm):
    rng = random.Random(9)
    frame = fp_frame(llm, cluster(rng, 1, 600, 4))
    links = M.near_links(frame)
    assert links.count() < 40 * frame.count()


def test_components_of_chains_and_stars(llm):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(5, 5), (-3, -9), (300, 200), (250, 300)]
    rng = random.Random(0)
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in M.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 130))
    assert got[-3] == -9 and got[300] == 200 and got[250] == 200 and 5 in got and 0 not in got
    assert M.components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_of_each_group(docs, texts, no_docs, llm):
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns
    least = brute_components({k: brute_fp(t) for k, t in texts.items()})
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(least.values())) and ids.count(None) == 1
    assert M.keep_one(no_docs).count() == 0
    same = llm.createDataFrame([(3, "a b c d"), (3, "a b c d"), (2, "a b c d"), (None, "a b c d"), (9, "q w e r t y")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in M.keep_one(same).collect()) == [2, 9]


def test_half_bits_rule():
    assert M.simhash([b"", b"A  b\tc", b"a b c"], 3, 42).tolist()[1:] == [brute_fp("a b c")] * 2
    assert M.simhash([b""], 3, 42)[0] == 0


def test_equal_and_null_ids_keep_a_row_of_every_component(llm):
    a, b, c, e = (" ".join(f"{k}{i}" for i in range(60)) for k in "abce")
    rows = [(1, a, 1), (1, b, 2), (1, a, 3), (None, c, 4), (None, c, 5), (None, b, 6), (None, e, 7), (2, e, 8), (5, a, 9)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, _row long").repartition(3)
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r["text"][0], r["doc_id"]) if r["doc_id"] is not None else (r["text"][0], 0) for r in kept.collect())
    assert got == [("a", 1), ("b", 1), ("c", 0), ("e", 2)]
