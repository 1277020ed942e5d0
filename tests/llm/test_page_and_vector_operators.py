"""Archives, URL filters and vector searches against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from splatlake.llm import dual_tree, multiprobe, urls, warc

HTML = [(1, "http://a/", None), (2, None, ""), (3, "u\r\nX: y", "x" * 1000), (4, "u", "x" * 1000), (4, "u", "x" * 1000), (5, "u", "short"), (6, "u", "short"),
        (7, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 60), (8, "u", "é\n" * 800), (9, "u", "é\n" * 800), (None, "u", "é\n" * 800), (10, "u", "\n" * 200_000), (11, "u", "😀\ud7ff\u2028\x00" * 500)]


def test_archive_round_trip(spark):
    got = warc.archive(spark.createDataFrame(HTML, "page_id long, url string, html string")).collect()
    first = {}
    for i, _, h in HTML:
        if len((h or "").encode()) >= 1000 and i is not None:
            first[h] = max(i, first.get(h, i))
    seen = []
    for r in got:
        seen.append((r.key, r.payload_bytes, r.digest, r.record_type, r.refers_to_key))
    want, used = [], set()
    for i, _, h in HTML:
        raw = (h or "").encode()
        original = h not in first or (i == first[h] and h not in used)
        used |= {h} if i == first.get(h) else set()
        want.append((None if i is None else str(i), len(raw), hashlib.sha1(raw).hexdigest(), "response" if original else "revisit", None if original else str(first[h])))
    assert sorted(seen, key=str) == sorted(want, key=str)
    assert all(hashlib.sha1(r.payload).hexdigest() == r.digest for r in got if r.record_type == "response")
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_cut_archive_is_an_error():
    lines = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nabc\r\n\r\n".split(b"\n")
    with pytest.raises(ValueError):
        list(warc._records(lines))


def test_rules_and_hosts(spark):
    rows = [(1, None), (2, "no scheme/x"), (3, "http://Sub.EXAMPLE.org/es/1?x#y"), (4, "https://example.org/en/12#z"), (5, "http://badexample.org/es/"), (6, "http://a.com/de/x"), (7, "http://a.com"),
            (8, "http://a.com?q=/de/"), (9, "ftp://x://y/z"), (10, "http://É.com/fr/" + "a/" * 500), (11, "http://a.com//de/")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [(got[i].host, got[i].rule, got[i].verdict) for i in range(1, 10)] == [
        ("", None, "allow"), ("", None, "allow"), ("sub.example.org", "example.org/es/", "block"), ("example.org", "example.org/en/1", "block"), ("badexample.org", "org/", "allow"),
        ("a.com", "com/de/", "block"), ("a.com", None, "allow"), ("a.com", None, "allow"), ("x:", None, "allow")]
    assert (got[3].path, got[8].path, got[11].path, got[10].verdict) == ("/es/1", "", "//de/", "allow")
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def brute_judge(rows, support=urls.SUPPORT, strength=urls.STRENGTH, prior=urls.PRIOR, alike=urls.ALIKE):
    """(template, verdict) by (host, path), from the rules and the tree, in plain Python."""
    ruled = {}
    for _, url in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        ruled[host, path] = max(fits)[1] if fits else None
    names = {k: ("", "") for k in ruled}
    for level in range(max((k[1].removeprefix("/").count("/") + 1 for k in ruled), default=0)):
        here = {k: k[1].removeprefix("/").split("/")[level] for k in ruled if k[1].removeprefix("/").count("/") >= level}
        below = Counter((k[0], names[k][1], seg) for k, seg in here.items())
        names |= {k: (names[k][1], names[k][1] + "/" + (seg if below[k[0], names[k][1], seg] >= support else "*")) for k, seg in here.items()}
    stats = {}
    for k, (parent, template) in names.items():
        cell = stats.setdefault((k[0], parent, template), [0, 0])
        cell[0] += ruled[k] == "block"
        cell[1] += ruled[k] is not None
    smooth = lambda cells, towards: (sum(c[0] for c in cells) + strength * towards) / (sum(c[1] for c in cells) + strength)
    purity = {}
    for host, parent in {k[:2] for k in stats}:
        own = sorted((k for k in stats if k[:2] == (host, parent)), key=lambda k: (stats[k][0] / max(1, stats[k][1]), k[2]))
        branches = [[own[0]]]
        for before, k in zip(own, own[1:]):
            (b0, n0), (b1, n1) = stats[before], stats[k]
            cut = (n1 > 0) != (n0 > 0)
            if n0 and n1:
                pool = (b0 + b1) / (n0 + n1)
                cut = abs(b1 / n1 - b0 / n0) / max(math.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n0)), 1e-9) > alike
            branches.append([k]) if cut else branches[-1].append(k)
        for branch in branches:
            for k in branch:
                below = smooth([c for j, c in stats.items() if j[1] == parent], prior)
                purity[k] = smooth([stats[j] for j in branch], smooth([c for j, c in stats.items() if j[1:] == k[1:]], below))
    return {k: (t, ruled[k] or ("block" if purity[k[0], parent, t] > urls.REJECT else "allow")) for k, (parent, t) in names.items()}


def test_tree_and_verdicts_against_brute_force(spark):
    rng = random.Random(8)
    hosts = ["a.com", "b.com", "m.a.com", "c.net", "d.net", "e.org", "example.org"]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['de', 'fr', 'en', 'es', str(i)])}" + "".join(f"/{rng.choice(['a', 'b', str(rng.randint(0, 60))])}" for _ in range(rng.randint(0, 3))) + rng.choice(["", "/", "?q"])) for i in range(900)]
    rows += [(2000 + i, "http://deep.net/" + "x/" * 12 + str(i)) for i in range(6)] + [(3000, None), (3001, ""), (3002, rows[0][1]), (3000, None)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, template string")
    got = urls.judge(frame).collect()
    want = brute_judge(rows)
    assert len(got) == len(rows) and all((r.template, r.verdict) == want[r.host, r.path] for r in got)
    assert want["deep.net", "/" + "x/" * 12 + "3"][0] == "/x" * 12 + "/*"


@pytest.mark.parametrize("share", [100, 300])
def test_a_verdict_does_not_depend_on_the_size_of_its_host(spark, share):
    """/de/ is blocked on many hosts by rule, so it is blocked where no rule fits, be it 1 % or 3 % of the host."""
    rows = [(i * 100 + j, f"http://h{i}.com/de/{j}") for i in range(20) for j in range(20)] + [(5000 + j, f"http://h.net/de/{j}") for j in range(share)]
    rows += [(10_000 + j, f"http://h.net/{j % 97}/{j}") for j in range(10_000 - share)]
    got = {r.template: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).filter("host = 'h.net'").collect()}
    assert got["/de/*"] == "block" and got["/5/*"] == "allow"


def vectors(n, dim, seed):
    x = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    x[5] = x[3]; x[40:60] = x[7]; x[8] = 0
    return [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[1].tolist()), (n, None), (n + 1, [None] * dim), (n + 2, [float("nan")] * dim), (n + 3, [float("inf")] + [0.0] * (dim - 1)),
                                                         (3, x[3].tolist()), (n + 4, [1.0] * 3), (n + 5, [])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")


def exact(rows, every, k, score, skip):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and not (skip and not any(v)):
            kept[i] = np.array(v, np.float64)
    out = set()
    for q in (q for q in kept if q % every == 0):
        near = sorted((-score(kept[q], x), i) for i, x in kept.items() if i != q and len(x) == len(kept[q]))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(near)}
    return out


def test_dual_tree_is_exact(spark):
    rows = vectors(700, 6, 1)
    got = {tuple(r) for r in dual_tree.search(frame(spark, rows), F.col("vec_id") % 5 == 0, 20).collect()}
    assert got == exact(rows, 5, 20, lambda a, b: int(np.floor(64 * a) @ np.floor(64 * b)), False)
    assert dual_tree.search(frame(spark, []), F.lit(True)).count() == 0


def test_dual_tree_prunes():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(600, 2)) + c for c in ([0, 0], [500, 0], [0, 500])])
    seen = []
    worst = np.full(1, (x @ [1.0, 0.0]).max() - 5)
    dual_tree.dual(np.array([[1.0, 0.0]]), x, worst, lambda a, b: seen.append(len(b)))
    assert 0 < sum(seen) < len(x) / 2


def test_multiprobe_recall_and_scores(spark):
    rows = vectors(900, 16, 3)
    got = multiprobe.search(frame(spark, rows), F.col("vec_id") % 5 == 0, 5).collect()
    want = exact(rows, 5, 5, lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), True)
    pairs = {(q, i) for q, _, i, _ in want}
    assert len({(r.query_id, r.vec_id) for r in got} & pairs) >= 0.9 * len(pairs)
    kept = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and None not in v}
    for r in got:
        a, b = kept[r.query_id], kept[r.vec_id]
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), rel=1e-12) and r.query_id != r.vec_id
    assert sorted(r["rank"] for r in got if r.query_id == 40) == [1, 2, 3, 4, 5] and {r.vec_id for r in got if r.query_id == 40} == {7, 41, 42, 43, 44}
    assert multiprobe.search(frame(spark, []), F.lit(True)).count() == 0


def recall(spark, x, every):
    """Share of the true 5 nearest found, for the queries of the hot cluster (the first third of rows) and for the others."""
    got = {}
    for r in multiprobe.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), F.col("vec_id") % every == 0, 5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    x = x.astype(np.float64) / np.linalg.norm(x, axis=1, keepdims=True)
    hits = {True: [], False: []}
    for q in range(0, len(x), every):
        cos = x @ x[q]
        cos[q] = -2
        assert len(got[q]) == 5
        hits[q < len(x) // 3].append(len(got[q] & set(np.argsort(-cos)[:5].tolist())) / 5)
    return np.mean(hits[True]), np.mean(hits[False])


@pytest.mark.parametrize("spread", [0.3, 0.02])
def test_multiprobe_recall_with_a_hot_cluster(spark, spread):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 64)).astype(np.float32)
    x[:1000] = x[0] + spread * rng.normal(size=(1000, 64))
    assert min(recall(spark, x, 20)) >= 0.9


def test_multiprobe_finds_k_rows_of_a_rare_length(spark, monkeypatch):
    """Where sample and buckets hold too few rows, all rows of that length are looked at."""
    monkeypatch.setattr(multiprobe, "SAMPLE", 2)
    monkeypatch.setattr(multiprobe, "FIRST", 1)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(6).normal(size=(300, 32)).astype(np.float32))] + [(400 + i, [float(i == j) for j in range(8)]) for i in range(7)]
    got = multiprobe.search(frame(spark, rows), F.col("vec_id").isin(0, 400), 5).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == [(q, n) for q in (0, 400) for n in range(1, 6)]
