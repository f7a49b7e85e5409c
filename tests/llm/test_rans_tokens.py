import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civica.llm import rans_tokens as R
from civica.session import scratch_path

VOCAB = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def written(llm, docs):
    path = scratch_path(llm, "test-tokens")
    R.write_token_files(docs, path, VOCAB, 1, False, block_tokens=500)
    return path


def test_round_trip(llm, docs, texts, written):
    t = Tokenizer.from_file(VOCAB)
    t.encode_special_tokens = True
    rows = sorted(R.read_token_files(llm, written).collect(), key=lambda r: r["start"])
    assert len(rows) == docs.count()
    keys = [r["doc_id"] for r in rows]
    assert keys[0] is None and keys[1:] == sorted([*texts, 6])
    at = 0
    for r in rows:
        text = "a text without an id, and some words." if r["doc_id"] is None else texts[r["doc_id"]] or ""
        want = [*t.encode(text, add_special_tokens=False).ids, 1]
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["start"] == at
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        at += len(want)


def test_checksum_is_verified(llm, written):
    bad = scratch_path(llm, "test-bad")
    llm.read.parquet(f"{written}/model").write.parquet(f"{bad}/model")
    llm.read.parquet(f"{written}/blocks").withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        R.read_token_files(llm, bad).count()


def test_empty_table(llm, no_docs):
    path = scratch_path(llm, "test-none")
    R.write_token_files(no_docs, path, VOCAB, 1, False)
    assert R.read_token_files(llm, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 64, 65, 1000, 5000])
@pytest.mark.parametrize("symbols", [1, 2, 300])
def test_codec(n, symbols):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.2, n) % symbols) * 7
    every, count = np.unique(np.arange(symbols) * 7, return_counts=True)
    count = count + np.bincount(np.searchsorted(every, ids), minlength=len(every))
    table = R.Table(every, R.Table.scaled(count, 12), 12)
    assert table.freq.sum() == 1 << 12 and table.freq.min() >= 1
    code, marks = R.encode_block(ids, table, lanes=8, checkpoint=16)
    assert (R.decode_block(code, marks, n, table, lanes=8, checkpoint=16) == ids).all()
    rows = -(-n // 8)
    states = np.frombuffer(marks, "<u8").reshape(-1, 9)
    words = np.frombuffer(code, "<u4").astype(np.uint64)
    for k in range(len(states)):  # every checkpoint is a place to begin
        part = R.decode_rows(words, states, table, rows, k, k + 1, lanes=8, checkpoint=16)
        want = ids[k * 128: (k + 1) * 128]
        assert (part[: len(want)] == want).all()


def test_code_is_near_the_entropy():
    rng = np.random.default_rng(0)
    ids = rng.zipf(1.3, 200_000) % 20_000
    every, count = np.unique(ids, return_counts=True)
    table = R.Table(every, R.Table.scaled(count))
    p = count / count.sum()
    code, _ = R.encode_block(ids, table)
    assert len(code) * 8 / len(ids) < 1.01 * -(p * np.log2(p)).sum()


def test_scaling_keeps_rare_symbols():
    count = np.array([10**12, *[1] * 2000])
    freq = R.Table.scaled(count, 12)
    assert freq.sum() == 4096 and freq.min() == 1
    with pytest.raises(ValueError):
        R.Table.scaled(np.ones(3000, np.int64), 12)
