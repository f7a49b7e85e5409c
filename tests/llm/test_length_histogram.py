import public_tokenizers

from civica.llm import length_histogram as H
from civica.llm.vocab import tiktoken_encoding

VOCAB, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def lengths(docs):
    encode = tiktoken_encoding(VOCAB, PATTERN).encode_ordinary
    return sorted(len(encode(r["text"] or "")) for r in docs.collect())


def test_suffix_sums_match_brute_force(docs):
    want = lengths(docs)
    rows = H.suffix_sums(H.length_histogram(docs, VOCAB, PATTERN), group=7).collect()
    assert sorted(r["length"] for r in rows) == sorted(set(want))
    for r in rows:
        n = r["length"]
        assert r["n_docs"] == want.count(n) and r["n_tokens"] == n * want.count(n)
        assert r["docs_at_least"] == sum(x >= n for x in want) and r["tokens_at_least"] == sum(x for x in want if x >= n)
        assert r["all_docs"] == len(want) and r["all_tokens"] == sum(want)
        assert r["tokens_if_cut"] == sum(min(x, n) for x in want)
        assert r["share_that_fits"] == sum(x <= n for x in want) / len(want)


def test_truncated_totals_and_quantiles(docs):
    want = lengths(docs)
    sums = H.suffix_sums(H.length_histogram(docs, VOCAB, PATTERN)).cache()
    limits = [0, 1, 5, 33, 64, 1000, 10**6]
    got = {r["context"]: (r["docs_cut"], r["total_tokens"]) for r in H.truncated_totals(sums, [*limits, 5]).collect()}
    assert got == {n: (sum(x > n for x in want), sum(min(x, n) for x in want)) for n in limits}
    quantiles = H.length_quantiles(sums, [0.1, 0.5, 0.99, 1.0])
    for q, n in quantiles.items():
        assert sum(x <= n for x in want) >= q * len(want) > sum(x < n for x in want)


def test_empty_table(no_docs):
    sums = H.suffix_sums(H.length_histogram(no_docs, VOCAB, PATTERN))
    assert sums.count() == 0
    assert [tuple(r) for r in H.truncated_totals(sums, [8]).collect()] == [(8, 0, 0)]
    assert H.length_quantiles(sums, [0.5]) == {0.5: None}


def test_long_white_runs_end_no_task(llm):
    from civica.llm.vocab import ordinary_ids
    encoding = tiktoken_encoding(VOCAB, PATTERN)
    for white in (" ", "\n", "\t", " \n", "　", "\xa0 "):
        for n in (4095, 4096, 5000):
            run = (white * n)[:n]
            for t in (run, run + "a", "a" + run, f"a.{run}b {run}\nc", f"{run}é{run}"):
                assert ordinary_ids(encoding, t) == encoding.encode_ordinary(t)
    long = [" " * 1_000_000, "\t" * 1_000_000 + "x", "a" + "\n" * 1_000_000]
    df = llm.createDataFrame([(t,) for t in long], "text string")
    assert H.length_histogram(df, VOCAB, PATTERN).agg({"n_docs": "sum"}).first()[0] == 3
