"""Conversation repair, quality classifier and importance resampling against brute force and their twins' rules."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from splatlake.llm import importance, queries, repair, subwords

FOLDER = "/root/testdata/sf0.001"
TALK = "conv_id long, turn long, role string, text string, score string, gone2 string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TALK)


# ---- conversation repair ---------------------------------------------------


def cheapest(initials, faults):
    """All edit strings within the cost of deleting everything; the least of the cheapest."""
    kept, made = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), (2, 2, 3, 2)
    best, todo = (3 * len(initials), "D" * len(initials)), [(0, "", 0, 0)]
    while todo:
        cost, text, i, q = todo.pop()
        if cost > best[0]:
            continue
        if i == len(initials) and q in (0, 3):
            best = min(best, (cost, text))
        todo.append((cost + 2, text + "I", i, made[q]))
        if i < len(initials):
            todo.append((cost + 3, text + "D", i + 1, q))
            if faults[i] != "d":
                more = faults[i] == "t"
                todo.append((cost + 2 + more, text + "R", i + 1, made[q]))
                if initials[i] in kept[q]:
                    todo.append((cost + more, text + "K", i + 1, kept[q][initials[i]]))
    return best


def test_search_finds_the_least_of_the_cheapest():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(0, 7)
        initials = [rng.choice("suax") if rng.random() < 0.5 else "ua"[i % 2] for i in range(n)]
        faults = [rng.choice("kkktd") for _ in range(n)]
        assert repair.Search(initials, faults).run() == cheapest(initials, faults)


def brute_repair(rows):
    """Result by conversation, straight from the rules, for rows of distinct (turn, role, text) order."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            kept += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in kept:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("b" if not last else "r" if (role, text) in seen else "k" if last[0] in ".!?" else "t")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in kept]
        cost, audit = cheapest(initials, ["d" if f in "br" else f for f in faults])
        lines, state, at = [], "", 0
        for e in audit:
            want = "assistant" if state == "u" else "user"
            if e in "IR":
                lines.append(f"{want}:{kept[at][2] if e == 'R' else ''}")
                state = want[0]
            if e == "K":
                lines.append(f"{kept[at][1]}:{kept[at][2]}")
                state = kept[at][1][:1]
            at += e != "I"
        turns = {t for t, _, _ in kept} - {None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("r"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


ODD = [(1, None, None, None), (1, 0, "system", "Be kind."), (1, 0, "user", "Same turn"), (1, 5, "user", "Hi?"), (1, 9, "tool", "x."), (2, None, "user", None), (3, 1, "user", " "), (3, 2, "", "a."),
       (3, 3, "assistant", "b. \n"), (3, 3, "assistant", "b. \n"), (None, 1, "user", "Q?"), (None, 2, "assistant", "A."), (4, -(1 << 62), "user", "far."), (4, 1 << 62, "assistant", "farther."), (5, 2, "assistant", "\U00010400.")]


def some_talk(seed):
    rng = random.Random(seed)
    rows = list(ODD)
    for conv in range(10, 40):
        for turn in range(rng.randint(1, 8)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ("user", "assistant")[turn % 2], rng.choice(["One.", "Two", "Three!", "", f"{turn}?"])))
    return rows


def result(frame):
    return {r[0]: tuple(r[1:]) for r in frame.select("conv_id", *repair.COUNTS, "audit", "repaired_sha256").collect()}


def test_repair_against_brute_force(spark):
    rows = some_talk(1)
    assert result(repair.repair(repair.damage(talk(spark, rows)))) == brute_repair(rows)


def test_repair_in_chunks_is_the_same(spark):
    rows = some_talk(2) + [(77, t, ("user", "assistant")[t % 2 if t % 11 else 0], f"{t % 13}." if t % 7 else "cut") for t in range(90)]
    rows += [(78, t, "x", "") for t in range(9)] + [(79, None, "user", "again.")] * 7
    whole = result(repair.repair(repair.damage(talk(spark, rows))))
    cut = repair.repair(repair.damage(talk(spark, rows)), chunk_rows=3)
    assert result(cut) == whole and len(whole) == len({r[0] for r in rows})
    assert result(repair.repair(repair.damage(talk(spark, rows)), chunk_chars=4)) == whole


def test_repair_of_nothing(spark):
    assert repair.repair(repair.damage(talk(spark, []))).collect() == []
    gone = next(t for t in range(100) if zlib.crc32(f"6:{t}".encode()) % 20 == 0)
    assert result(repair.repair(repair.damage(talk(spark, [(6, gone, "user", "x.")])))) == {6: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_very_long_text_is_hashed_whole(spark):
    at = next(t for t in range(100) if zlib.crc32(f"8:{t}".encode()) % 20 > 4)
    text = "word " * 400_000 + "end."
    cost, audit, digest = result(repair.repair(repair.damage(talk(spark, [(8, at, "user", text)]))))[8][5:]
    assert (cost, audit) == (2, "KI") and digest == hashlib.sha256(f"user:{text}\nassistant:".encode()).hexdigest()


# ---- quality classifier ----------------------------------------------------


def test_word_features_against_a_loop():
    words = ["ab".encode(), "éß***".encode(), b"x", "\U00010400q".encode()]
    owner, found = subwords.word_features(words, 1 << 14)
    alone = [sorted(subwords.word_features([w], 1 << 14)[1].tolist()) for w in words]
    assert [sorted(found[owner == i].tolist()) for i in range(4)] == alone  # no n-gram crosses words
    for w, got in zip(words, alone):
        n = len(w.decode()) + 2
        assert len(got) == 1 + sum(max(0, n - k + 1) for k in subwords.GRAMS)


def test_features_of_a_document_count_repeats():
    held, shares = subwords.document_features([b"ab", b"ab", b"ab", b"c"], 1 << 14)
    total = 3 * (1 + 10) + (1 + 6) + 2 + 1  # words and grams of <ab> and <c>, two repeats, one end
    assert math.isclose(shares.sum(), 1) and math.isclose(dict(zip(held.tolist(), shares.tolist()))[subwords._REPEAT], 2 / total)


def test_score_is_the_softmax_of_the_mean_vector(spark, documents, monkeypatch):
    rng = np.random.default_rng(5)
    model = subwords.Model(rng.normal(0, 30, 1 << 12))
    texts = ["a b c", "", None, "word " * 3000, "Über ßtraße *** !!", "a b c", " \n\t "]
    want = []
    for t in texts:
        held, shares = subwords.document_features(subwords.words_of(t), 1 << 12)
        want.append(1 / (1 + math.exp(-float(shares @ model.odds[held]))))
    for room in (1 << 17, 2):  # forgetting words changes nothing
        monkeypatch.setattr(subwords, "_ROOM", room)
        got = {r.doc_id: (r.score, r.predicted) for r in subwords.classify(documents(list(enumerate(texts))), model).collect()}
        assert all(math.isclose(got[i][0], w, rel_tol=1e-9) and got[i][1] == (w >= 0.7) for i, w in enumerate(want))


def test_training_follows_the_gradient():
    """One step from the same start equals the gradient of the loss taken by differences."""
    sample = [(np.array([2, 5]), np.array([0.25, 0.75]), 1), (np.array([3]), np.array([1.0]), 0)]
    odds = subwords.train(sample, buckets=8, size=4, epochs=60, rate=1.0).odds
    assert odds[[2, 5]] @ [0.25, 0.75] > 2 and odds[3] < -2 and abs(odds[7]) < 1
    assert subwords.train(sample[:1], buckets=8).prior == 2 / 3 and subwords.train([], buckets=8).prior == 0.5


def test_sample_ignores_odd_labels(spark, documents):
    docs = documents([(1, "good text"), (2, "bad!!"), (3, "both"), (4, None), (5, "no label"), (1, "good copy"), (None, "x"), (6, "odd")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1), (4, 0), (6, 7), (None, 1), (1, None), (9, 1), (1, 1)], "doc_id long, quality int")
    found = subwords.sample(docs, labels)
    assert Counter(y for _, _, y in found) == {1: 1, 0: 2}
    assert sum(y for _, _, y in subwords.sample(docs, labels, rows=1)) == 1 and len(subwords.sample(docs, labels, rows=1)) == 2
    assert subwords.sample(docs.limit(0), labels) == [] and subwords.sample(docs, labels.limit(0)) == []


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op12_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.97
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count() and got.filter("score NOT BETWEEN 0 AND 1 OR score IS NULL").isEmpty()


# ---- importance resampling -------------------------------------------------


@pytest.mark.parametrize("bits,block", [(11, 1 << 17), (3, 5), (1, 1)])
def test_radix_rank_sorts(spark, bits, block):
    rng = random.Random(bits)
    rows = [(rng.choice([-5, 0, 3, 1 << 40, -(1 << 40)]), rng.choice([None, 1, 2, 9]), i) for i in range(60)]
    frame = spark.createDataFrame(rows, "a long, b long, i int").repartition(4)
    got = sorted(importance.radix_rank(frame, [("a", True), ("b", False), ("i", False)], bits if bits > 1 else 6, block).collect(), key=lambda r: r["rank"])
    want = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0, r[2]))
    assert [(r.a, r.b, r.i) for r in got] == want and [r["rank"] for r in got] == list(range(1, 61))


def test_radix_rank_of_extremes_equal_rows_and_nothing(spark):
    rows = [(-(1 << 63),), ((1 << 63) - 1,), (0,), (None,)]
    frame = spark.createDataFrame(rows, "a long")
    up = sorted(importance.radix_rank(frame, [("a", False)]).collect(), key=lambda r: r["rank"])
    down = sorted(importance.radix_rank(frame, [("a", True)]).collect(), key=lambda r: r["rank"])
    assert [r.a for r in up] == [None, -(1 << 63), 0, (1 << 63) - 1] and [r.a for r in down] == [(1 << 63) - 1, 0, -(1 << 63), None]
    same = spark.createDataFrame([(7, "x")] * 9, "a long, b string").repartition(3)
    assert sorted(r["rank"] for r in importance.radix_rank(same, [("a", True)], block_rows=2).collect()) == list(range(1, 10))
    assert importance.radix_rank(same.limit(0), [("a", True)]).collect() == []


def brute_resample(docs, target, longest=1):
    runs = lambda t: [b" ".join(w[i : i + n]) for w in [re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())] for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    at = lambda f: zlib.crc32(f) % 10_000
    s, t = Counter(at(f) for _, x in docs for f in runs(x)), Counter(at(f) for x in target for f in runs(x))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    out = []
    for i, x in docs:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(at(f)) for f in runs(x))
        words = len(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").encode().lower()))
        out.append([i, len(runs(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for rank, r in enumerate(able[: 10 * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("longest", [1, 2])
def test_resample_against_brute_force(spark, documents, longest):
    rng = random.Random(longest)
    word = lambda: rng.choice(["alpha", "Beta", "GAMMA", "été", "日本", "x-y", "z9", "\U0001f600"])
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(80)]
    docs += [(None, "alpha " * 25), (3, docs[3][1]), (200, None), (201, ""), (202, "beta " * 50_000), (-4, "Alpha,alpha" * 30)]
    target = ["alpha beta alpha", None, "", "日本 z9"]
    frame = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    got = importance.resample(documents(docs), frame, longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {f.dataType for f in got.schema} == {T.LongType()}
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target, longest)


def test_resample_of_nothing(spark, documents):
    target = spark.createDataFrame([("a b",)], "text string")
    assert importance.resample(documents([]), target).collect() == []
    rows = importance.resample(documents([(1, "w " * 30)]), target.limit(0)).collect()
    assert len(rows) == 1 and rows[0]["rank"] is None and rows[0].n_features == 30
