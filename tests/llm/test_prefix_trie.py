import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa

from civica.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, digest string, n int, words string"


def brute(sequences: dict[int, tuple]) -> list[tuple]:
    members, below = defaultdict(list), defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in below[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in below[p])
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if sequences[c] == p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


def frame(llm, sequences):
    rows = [(c, t, role, text, "x", 1, "y") for c, s in sequences.items() for t, (role, text) in enumerate(s)]
    return llm.createDataFrame(rows, SCHEMA)


def test_z_fast_trie_counts_every_prefix():
    rng = random.Random(1)
    for _ in range(400):
        trie, want, names = P.ZFastTrie(), Counter(), {}
        for batch in range(2):
            rows = []
            for i in range(rng.randint(1, 6)):
                s = tuple(rng.randint(0, 1) for _ in range(rng.randint(0, 9)))
                path = [repr(s[:d]).encode() for d in range(len(s) + 1)]
                names.update({repr(s[:d]).encode(): s[:d] for d in range(len(s) + 1)})
                want.update(s[:d] for d in range(len(s) + 1))
                rows.append((10 * batch + i, path, [0] * len(path)))
            trie.insert_batch(rows)
        assert Counter({names[x[1]]: x[4] for x in trie.expand()}) == want
        # One handle a node, at the depth of its edge with the most trailing zeros.
        for digest, node in trie.handles.items():
            f = max(range(node.low + 1, node.high + 1), key=lambda n: n & -n)
            assert node.path[f - 1] == digest


def test_nodes_match_brute_force(llm):
    rng = random.Random(2)
    turns = [("user", "a b"), ("assistant", "c"), ("user", ""), ("", " d\te\x0bf "), ("user", "é")]
    sequences = {c: tuple(rng.choice(turns[: 2 + c % 4]) for _ in range(rng.randint(1, 6))) for c in range(0, 400, 3)}
    for c in range(1000, 1080):  # copies
        sequences[c] = sequences[0] * 3
    assert nodes(P.conversation_trie(frame(llm, sequences))) == brute(sequences)


def test_rebuilt_conversations_match_brute_force(llm):
    rng = random.Random(3)
    own = {c: tuple((rng.choice(["user", "system"]), f"t{rng.randint(0, 3)} w") for _ in range(rng.randint(1, 5)))
           for c in range(90) if c % 7 and c != 40}
    made = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - c % 20, ())[:h] + s[h:]
    assert any(not s for s in made.values()) and 40 not in own
    df = frame(llm, own)
    assert nodes(P.trie_nodes(P.rebuilt(P.turn_symbols(df)))) == brute(made)


def test_nulls_ties_repeats_long_texts_and_empty_tables(llm):
    long = "w " * 300_000
    rows = [(1, None, None, None), (1, 0, "user", long), (1, 0, "assistant", "x"), (2, 5, "", ""), (2, 6, "assistant", "x"),
            (2, 7, "user", long), (3, 1, "user", "b"), (3, 1, "user", "b"), (None, 0, "user", "lost")]
    df = llm.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    same = (("", ""), ("assistant", "x"), ("user", long))
    assert nodes(P.conversation_trie(df)) == brute({1: same, 2: same, 3: (("user", "b"),) * 2})
    assert P.conversation_trie(df.limit(0)).count() == 0


def test_slices_and_long_conversations_merge_to_the_same(monkeypatch):
    rng = random.Random(4)
    rows = []
    for c in range(60):
        digest, parent = P.ROOT, None
        for d in range(rng.choice([3, 8, 200])):
            rows.append((c, d, digest, parent, d))
            parent, digest = digest, hashlib.md5(digest + bytes([rng.randint(0, 1) if d < 4 else c])).digest()
    names = ["conv", "depth", "digest", "parent", "words"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    def merged():
        total, least = Counter(), {}
        for b in P._slice_nodes(iter([batch.slice(i, 70) for i in range(0, len(rows), 70)])):
            for r in b.to_pylist():
                key = (r["depth"], r["digest"], r["parent"], r["words"])
                total[key] += r["n"]
                least[key] = min(least.get(key, r["conv"]), r["conv"])
        return total, least
    whole = merged()
    assert sum(whole[0].values()) == len(rows)
    monkeypatch.setattr(P, "SLICE_ROWS", 50)
    assert merged() == whole


def test_ids_are_hashed_in_pieces(llm, monkeypatch):
    ids = list(range(5000))
    paths = llm.createDataFrame([(i, bytes([i % 2]) * 16, True) for i in ids] + [(9999, b"z" * 16, False)], "conv long, digest binary, last boolean")
    got = {bytes(r["digest"]): r["ends_sha256"] for r in P.ending_digests(paths).collect()}
    want = {bytes([k]) * 16: hashlib.sha256(",".join(str(i) for i in ids if i % 2 == k).encode()).hexdigest() for k in (0, 1)}
    assert got == want
