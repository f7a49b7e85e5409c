import random
import re

import numpy as np
import pytest

from civica.llm import suffix_decontam as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    """(n_words, n_hit, items) per document, by comparing every window."""
    out = []
    for _, text in docs:
        w = words(text)
        hit, found = set(), set()
        for key, other in items:
            v = words(other)
            size = min(window, len(v))
            for i in range(len(v) - size + 1 if size else 0):
                for j in range(len(w) - size + 1):
                    if w[j: j + size] == v[i: i + size]:
                        hit |= set(range(j, j + size))
                        found.add(key)
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)] + ["Été", "ÉTÉ", "niño", "a_b", "x1"]
    make = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, make(rng.randint(1, 40))) for i in range(25)] + [(100, None), (101, ""), (102, "..."), (103, "unique"), (104, "w1 w2")]
    items.append((105, items[3][1]))  # a repeated item
    docs = []
    for i in range(60):
        text = make(rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            _, t = rng.choice(items[:25])
            w = t.split()
            a = rng.randint(0, len(w) - 1)
            text += rng.choice([" ", "\n", ", "]) + " ".join(w[a: a + rng.randint(1, 40)]).upper().replace("É", "É")
            text += " " + make(3)
        docs.append((i, text))
    docs += [(200, None), (201, ""), (202, "unique"), (202, "unique"), (203, items[0][1] + " . " + items[0][1]), (None, items[1][1])]
    return docs, items


def result(df):
    return [(r["n_words"], r["n_hit"], sorted(r["items"])) for r in df.collect()]


@pytest.mark.parametrize("window", [13, 4])
def test_same_as_comparing_every_window(llm, corpus, window):
    docs, items = corpus
    got = S.contamination(S.suffix_matches(llm.createDataFrame(docs, "doc_id long, text string").coalesce(1),
                                           llm.createDataFrame(items, "item_id long, text string"), window=window))
    assert sorted(result(got)) == sorted(brute(docs, items, window))


def test_blocks_of_the_benchmark_give_the_same(llm, corpus):
    docs, items = [d for d in corpus[0] if d[0] is not None and d[0] != 202], corpus[1]
    d = llm.createDataFrame(docs, "doc_id long, text string")
    b = llm.createDataFrame(items, "item_id long, text string")
    got = S.contamination(S.suffix_matches(d, b, block_bytes=300))
    assert sorted(result(got)) == sorted(brute(docs, items))


def test_longest_matches_and_their_places(llm):
    item = " ".join(f"v{i}" for i in range(30))
    text = "before " + " ".join(f"v{i}" for i in range(5, 25)) + " after " + " ".join(f"v{i}" for i in range(12))
    row = S.suffix_matches(llm.createDataFrame([(1, text)], "doc_id long, text string"),
                           llm.createDataFrame([("q", item)], "item_id string, text string")).first()
    assert [tuple(m) for m in row["matches"]] == [("q", 5, 1, 20)]
    assert [tuple(h) for h in row["hits"]] == [(1, 21)]


def test_shards_do_not_change_the_result(llm, corpus, monkeypatch):
    docs, items = corpus
    index = S.SuffixIndex([(k, t.encode()) for k, t in items if t is not None], 13)
    texts = [(t or "").encode() for _, t in docs]
    code, starts, _ = S._shard(index, texts)
    whole = set(zip(*(x.tolist() for x in index.matches(code))))
    parts = set()
    for i, t in enumerate(texts):
        own, _, _ = S._shard(index, [t])
        w, at = index.matches(own)
        parts |= set(zip(w.tolist(), (at + starts[i]).tolist()))
    assert whole == parts


def test_removal_keeps_clean_rows_and_columns(llm, docs, no_docs):
    bench = llm.createDataFrame([(1, "one"), (2, "line one line one line one")], "item_id long, text string")
    kept = S.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {4, 5, 15} & set(ids) and {1, 2, 3, 8, None} <= set(ids)
    assert S.remove_contaminated(no_docs, bench).count() == 0
    assert S.remove_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_twentieth_is_contaminated(llm):
    bench = llm.createDataFrame([(1, "hit")], "item_id long, text string")
    rows = [(1, "hit " + "x " * 19), (2, "hit " + "x " * 20)]
    got = S.contamination(S.suffix_matches(llm.createDataFrame(rows, "doc_id long, text string"), bench))
    assert {r["doc_id"]: r["contaminated"] for r in got.select("doc_id", "contaminated").collect()} == {1: True, 2: False}


def test_keys_sort_as_rows():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 70000, (500, 3))
    keys = S.SuffixIndex.keys(rows)
    order = np.argsort(keys, kind="stable")
    assert [tuple(r) for r in rows[order].tolist()] == sorted(tuple(r) for r in rows.tolist())


def test_null_and_equal_ids_are_rows_of_their_own(llm):
    items = [(i, " ".join(f"q{i}x{j}" for j in range(20))) for i in range(8)]
    docs = [(None, items[0][1]), (None, "clean words only"), (None, items[1][1] + " " + items[2][1]), (7, items[3][1]),
            (7, "another clean text"), (7, items[3][1]), (8, None)]
    d = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = llm.createDataFrame(items, "item_id long, text string")
    one, many = S.suffix_matches(d, b), S.suffix_matches(d, b, block_bytes=300)
    assert sorted(result(S.contamination(one))) == sorted(result(S.contamination(many))) == sorted(brute(docs, items))
    by_index = S.suffix_matches(d, b, index_bytes=6000)
    assert sorted(result(S.contamination(by_index))) == sorted(brute(docs, items))


def test_blocks_are_bounded_by_their_index(llm):
    b = llm.createDataFrame([(i, "a b c d e f g h i j k l m n") for i in range(40)], "item_id long, text string")
    blocks = list(S.item_blocks(b, "item_id", "text", 13, 16 << 20, 10 * 14 * 128))
    assert sum(map(len, blocks)) == 40 and max(map(len, blocks)) <= 11


def test_removal_judges_each_row_by_its_own_text(llm):
    items = [(i, " ".join(f"q{i}x{j}" for j in range(20))) for i in range(8)]
    docs = [(None, items[0][1], 1), (None, "clean words only", 2), (7, items[3][1], 3), (7, "another clean text", 4), (8, None, 5)]
    d = llm.createDataFrame(docs, "doc_id long, text string, _row long").repartition(3)
    b = llm.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_bytes": 300}):
        kept = S.remove_contaminated(d, b, **options)
        assert kept.columns == d.columns and sorted(r["_row"] for r in kept.collect()) == [2, 4, 5]


def test_repeated_words_make_no_pairs_of_all_places():
    import tracemalloc
    from civica.llm import suffix_decontam as S
    index = S.SuffixIndex([("x", b"a " * 2000), ("y", b"a " * 2000), ("z", b"a b " * 30)], 13)
    texts = [b"a " * 200_000, b"c " + b"a " * 100 + b"c " + b"a " * 3000, b"a b " * 500, b"a " * 12]
    tracemalloc.start()
    count, hits, key, at, text, starts = S._found(index, texts)
    window, begin, words = index.longest(key, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30
    own = starts.searchsorted(begin, "right") - 1
    assert [int(words[own == t].max(initial=0)) for t in range(4)] == [2000, 2000, 60, 0]
    assert hits == [[(0, 200_000)], [(1, 101), (102, 3102)], [(0, 1000)], []]
    assert S._items(index, key, at, text, 4) == [["x", "y"], ["x", "y"], ["z"], []]


def test_maximal_matches_equal_comparing_all_places():
    import random
    from civica.llm import suffix_decontam as S
    rng = random.Random(6)
    for _ in range(60):
        window = rng.randint(1, 4)
        items = [tuple(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(4)]
        texts = [tuple(rng.choice("abc") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        index = S.SuffixIndex([(i, " ".join(x).encode()) for i, x in enumerate(items)], window)
        _, _, key, at, text, starts = S._found(index, [" ".join(t).encode() for t in texts])
        got = set()
        if len(key):
            for w, p, n in zip(*map(lambda x: x.tolist(), index.longest(key, at))):
                t = int(starts.searchsorted(p, "right")) - 1
                got |= {(t, i, int(index.place[w]), p - int(starts[t]), n) for i in index.owners[index.item[w]]}
        want = set()
        for t, x in enumerate(texts):
            for i, y in enumerate(items):
                for a in range(len(y)):
                    for p in range(len(x)):
                        n = 0
                        while a + n < len(y) and p + n < len(x) and y[a + n] == x[p + n]:
                            n += 1
                        whole = a == 0 or p == 0 or y[a - 1] != x[p - 1]
                        if whole and n >= min(window, len(y)):
                            want.add((t, i, a, p, n))
        assert got == want
