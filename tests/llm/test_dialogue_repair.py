import hashlib
import itertools
import random
import re
import zlib

from civica.llm import dialogue_repair as D

INITIAL = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}


def all_edits(letters: str):
    """Every edit list with at most two inserts in a row, as (cost, audit) by brute force."""
    def go(i, state):
        for n in range(3):
            q = state
            for _ in range(n):
                q = D.NEXT_ROLE[q]
            pre = "I" * n
            if i == len(letters):
                if q in (D.START, D.ASSISTANT):
                    yield 2 * n, pre
                continue
            late = letters[i].isupper()
            ways = [(3, "D", q)]
            if letters[i] != "d":
                ways.append((2 + late, "R", D.NEXT_ROLE[q]))
                if (letters[i].lower(), q) in D.KEEP_ROLE:
                    ways.append((late, "K", D.KEEP_ROLE[letters[i].lower(), q]))
            for cost, edit, after in ways:
                for c, rest in go(i + 1, after):
                    yield 2 * n + cost + c, pre + edit + rest
    return min(go(0, D.START))


def test_grammar_matches_every_edit_list():
    short = ["".join(x) for n in range(4) for x in itertools.product(D.LETTERS, repeat=n)]
    rng = random.Random(2)
    some = rng.sample(short, 250) + ["".join(rng.choices(D.LETTERS, k=5)) for _ in range(12)]
    for letters, vector in zip(some, D.run_grammar([x.encode() for x in some])):
        assert D.finish(vector) == all_edits(letters), letters


def step_by_step(letters: str):
    """The same programme row by row, comparing whole texts."""
    best = {D.START: (0, "")}
    for x in letters:
        new = {}
        for p, (cost, audit) in best.items():
            for q, e in enumerate(D.letter_matrix(x)[p]):
                if e:
                    way = (cost + e[0], audit + e[2])
                    new[q] = min(way, new.get(q, way))
        best = new
    return min((c + 2 * len(D.ENDING[q]), a + D.ENDING[q]) for q, (c, a) in best.items())


def test_long_sequences_and_parts_give_the_same():
    rng = random.Random(3)
    for letters in ["ua" * 700, "".join(rng.choices(D.LETTERS, k=900)), "U" * 500, "d" * 300, "suA" * 200]:
        whole = D.run_grammar([letters.encode(), b"ua"])[0]
        assert D.finish(whole) == step_by_step(letters)
        half = D.run_grammar([letters[:333].encode()])[0]
        half = [(e[0], e[1], D.rope_text(e[2])) if e else None for e in half]
        assert D.finish(D.run_grammar([letters[333:].encode()], {0: half})[0]) == D.finish(whole)


def test_rules_give_back_their_sequences():
    rng = random.Random(4)
    sequences = ["".join(rng.choices("sua", k=rng.randint(0, 40))).encode() for _ in range(200)] + [b"u" * 101, b""]
    rules, coded = D.re_pair(sequences)

    def expand(x):
        return D.LETTERS[x] if x < len(D.LETTERS) else "".join(map(expand, rules[x - len(D.LETTERS)]))
    assert ["".join(map(expand, c.tolist())).encode() for c in coded] == sequences
    assert rules and sum(map(len, coded)) < sum(map(len, sequences)) / 2


SCHEMA = "conv_id long, turn long, role string, text string, audit string, kind int, key string"


def report(llm, rows):
    df = llm.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return {r["conv_id"]: r for r in D.repair_report(df).collect()}


def test_edge_rows(llm):
    long = "word " * 200_000 + "."
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 3, "assistant", "Yes."), (1, None, "system", "S!"),
            (2, 0, None, None), (2, 1, "user", ""), (2, 2, "user", " \t\n"),
            (3, 5, "user", long), (3, 9, "tool", "a?"),
            (None, 0, "user", "no id"), (None, None, "assistant", "No id."),
            (4, 2, "user", "b."), (4, 2, "user", "b."), (4, 2, "assistant", "a.")]
    got = report(llm, rows)
    assert set(got) == {1, 2, 3, 4, None}
    r = got[1]
    assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"]) == (1, 0, 1, 0, 1, 3, "KKKD")
    assert r["repaired_sha256"] == hashlib.sha256(b"system:S!\nuser:Hi.\nassistant:Yes.").hexdigest()
    assert (got[2]["blank"], got[2]["audit"], got[2]["repaired_sha256"]) == (3, "DDD", hashlib.sha256(b"").hexdigest())
    assert (got[3]["gaps"], got[3]["audit"], got[3]["cost"]) == (3, "KR", 2)
    assert got[3]["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:a?".encode()).hexdigest()
    assert (got[None]["gaps"], got[None]["illegal"], got[None]["truncated"]) == (0, 0, 1)
    assert (got[4]["duplicate"], got[4]["gaps"]) == (1, 0)  # assistant first: equal turns go by role


def test_empty_table_and_ids_without_rows(llm):
    none = llm.createDataFrame([], SCHEMA)
    assert D.repair_report(none).count() == 0
    ids = llm.createDataFrame([(7,), (7,)], "conv_id long")
    r, = D.repair_report(none, ids).collect()
    assert (r["conv_id"], r["gaps"], r["cost"], r["audit"]) == (7, 0, 0, "") and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_conversation_longer_than_a_slice(llm, monkeypatch):
    rng = random.Random(6)
    roles = rng.choices(["user", "assistant", "system", "tool"], k=5000)
    df = llm.createDataFrame([(1, i, r, f"{i}" + rng.choice([".", ""])) for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    r, = D.repair_report(df).collect()
    monkeypatch.setattr(D, "SLICE_LETTERS", 512)  # in this process only: the generator itself
    import pyarrow as pa
    p = D._prepared(df, "conv_id", "turn", "role", "text").orderBy("turn").collect()
    kind = [D._kind(x["role"].encode()) for x in p]
    fault = [0 if x["text"][-1] == "." else 3 for x in p]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 5000), pa.array(list(range(5000))), pa.array(kind), pa.array(fault)], names=["conv", "turn", "kind", "fault"])
    cut, = pa.Table.from_batches(D._edits(iter([batch.slice(0, 3000), batch.slice(3000)]))).to_pylist()
    assert cut["audit"] == r["audit"] and cut["cost"] == r["cost"] and r["cost"] > 0


def test_repaired_turns_follow_the_pattern(llm):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(list(INITIAL.values())), rng.choice(["", "x.", f"{t}", f"{t}!"])) for c in range(40) for t in range(rng.randint(0, 9))]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = {}
    for r in sorted(D.repaired_turns(df).collect(), key=lambda r: (r["conv_id"], r["position"])):
        by.setdefault(r["conv_id"], []).append(r)
    sums = {r["conv_id"]: r for r in D.repair_report(df).collect()}
    for c, report in sums.items():
        turns = by.get(c, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0] for t in turns))
        text = "\n".join(f"{t['role']}:{t['text']}" for t in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == report["repaired_sha256"]
        assert report["audit"].replace("D", "") == "".join(t["edit"] for t in turns)


def test_damage(llm):
    rows = [(c, t, None if t == 3 else "assistant", None if t == 4 else "A. b? c!") for c in range(30) for t in range(6)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept, dropped = D.damaged(df)
    want, lost = [], []
    for c, t, role, text in rows:
        role, text, k = role or " ", text if text is not None else " ", zlib.crc32(f"{c}:{t}".encode()) % 20
        if k == 0:
            lost.append(c)
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want += [(c, t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    assert sorted(map(tuple, kept.collect())) == sorted(want)
    assert sorted(r[0] for r in dropped.collect()) == sorted(lost)
