"""Packing, shingle join, language model, licenses, language and mixing against plain Python."""

import math
import random
import re
import textwrap
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from splatlake.llm import katz, language, licenses, mixing, ngram_join, packing
from splatlake.llm.queries import bucket, vocabulary

ODD = [(1, None), (2, ""), (3, "  \n "), (4, "word"), (4, "word"), (None, "a b c d e f"), (None, None), (5, "É ß İstanbul 漢字 😀 \x00 <|endoftext|> don't"), (6, "x " * 30_000)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) + str(rng.randint(0, 300)) for _ in range(n))


# --- packing ---------------------------------------------------------------------------------------


def test_fill_uses_every_piece_and_wastes_little():
    rng = random.Random(3)
    counts = Counter(rng.randint(1, 2048) for _ in range(3000))
    used, windows = Counter(), 0
    for times, uses in packing.fill(dict(counts), 2048):
        assert sum(k * n for k, n in uses) <= 2048
        windows += times
        used.update({k: n * times for k, n in uses})
    assert used == counts
    assert windows <= 1.02 * sum(k * n for k, n in counts.items()) / 2048
    tail = {k: n for k, n in counts.items() if k <= 1024}  # without pieces of more than half a window next to nothing is wasted
    assert sum(times for times, _ in packing.fill(tail, 2048)) <= math.ceil(sum(k * n for k, n in tail.items()) / 2048) + 1


def test_fill_finds_the_closest_sum():
    assert packing.fill({7: 1, 5: 2, 4: 1, 3: 1}, 10) == [(1, [(7, 1), (3, 1)]), (1, [(5, 2)]), (1, [(4, 1)])]
    assert packing.fill({}, 10) == []


def test_pack_round_trip(spark, documents):
    from tokenizers import Tokenizer

    rows = ODD + [(10 + i, prose(i, 37 * i)) for i in range(40)]
    pieces = packing.tokenise(documents(rows), vocabulary())
    packed = packing.pack(pieces.withColumn("extra", F.lit(1))).toPandas()
    whole = Tokenizer.from_file(vocabulary())
    want = Counter((i, tuple(whole.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows)
    total = sum(len(ids) * n for (_, ids), n in want.items())
    assert packed.length.sum() == total
    for _, g in packed.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
    assert packed.sequence_id.nunique() <= math.ceil(total / 2048) + 2
    one = packed[(packed.doc_id == 6)].sort_values("start")
    assert np.frombuffer(b"".join(one.ids), "<u4").tolist() == list(next(k[1] for k in want if k[0] == 6))
    back = packing.sequences(packing.pack(pieces)).toPandas()
    assert back.tokens.sum() == total and all(len(i) == 4 * (n if n & (n - 1) == 0 else 2048) for n, i in zip(back.tokens, back.ids))


def test_pack_of_nothing(spark, documents):
    assert packing.pack(packing.tokenise(documents([]), vocabulary())).count() == 0


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    whole, encode = Tokenizer.from_file(vocabulary()), packing.encoder(vocabulary())
    for text in ["I'm It'S 'll x'LL", "Größe naïve ÀÉ ǅ Σίσυφος ΣΑΣ ﬁ", "é á̧ ́x", "1a2 ½ ª × ÷ \x1cq  z", "<|startoftext|>a<|endoftext|> <| |>", "日本 😀!", ""]:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


# --- shingle join ----------------------------------------------------------------------------------


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def test_components_equal_brute_force(spark, documents):
    rng, rows, n = random.Random(5), list(ODD), 100
    passage = prose("shared", 60)
    for base in range(12):
        words = prose(base, rng.choice([4, 5, 6, 9, 40, 150, 400])).split()
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 3, 6])):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["New"], [copy[at].upper(), "x"]])
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + i, f"{prose(f'p{i}', 50)} {passage}") for i in range(40)]
    rows += [(200 + n + i, " ".join(passage.split()[: 60 - i % 14])) for i in range(30)]  # a long chain within one hot bucket
    got = ngram_join.jaccard_components(documents(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 37, 400, 5001])
def test_zone_overlap_is_a_lower_bound(n):
    rng = random.Random(n)
    least = ngram_join.zone_overlap(n, 80)
    for _ in range(60):
        m = rng.randint(-(-80 * n // 100), 100 * n // 80)
        both = -(-80 * (n + m) // 180)
        if both > min(n, m):
            continue
        pool = rng.sample(range(1 << 40), n + m - both)
        a, b = set(pool[:n]), set(pool[n - both:])
        za, zb = (set(sorted(s)[: ngram_join.zone_size(len(s), 80)]) for s in (a, b))
        assert len(za & zb) >= least


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_slice_of_few_words(n):
    """A slice may hold fewer words in all than a shingle; each text's tokens do not depend on its slice."""
    text = prose("few", n)
    alone = ngram_join.shingle_sets([text], ngram_join.WordHashes())[0]
    assert len(alone) == len(shingles(text))
    assert alone.tolist() == ngram_join.shingle_sets([prose("more", 50), text, None], ngram_join.WordHashes())[1].tolist()
    assert alone.tolist() == ngram_join.shingle_sets([prose("more", 50), text], ngram_join.WordHashes(), together=1)[1].tolist()


def test_table_of_one_short_document(spark, documents):
    got = ngram_join.jaccard_components(documents([(7, "two words")])).collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [(7, 1, 7)]


def test_shingle_join_drops_its_shuffles(spark, documents, monkeypatch):
    """Disk holds one step's shuffles at a time, whenever the driver collects its garbage; bitmaps are written once, and not per bucket."""
    name, tables = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(name)
    monkeypatch.setattr(ngram_join, "durable", lambda df, real=ngram_join.durable: tables.append(df.columns) or real(df))
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    held = lambda: {f.name for d in top for f in Path(str(d)).rglob("shuffle_*.data")}
    already = held()
    rows = [(i, f"{prose(i // 3, 80)} {prose('shared', 12)}" + " more" * (i % 3)) for i in range(60)]
    out = ngram_join.jaccard_components(documents(rows))
    until = time.time() + 20
    while held() - already and time.time() < until:
        time.sleep(0.2)
    assert not held() - already
    assert spark.conf.get(name) == before
    assert [c for c in tables if "bits" in c] == [["key", "n", "bits"]]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str) == brute(rows)


def test_no_documents(spark, documents):
    assert ngram_join.jaccard_components(documents([])).count() == 0


# --- language model --------------------------------------------------------------------------------


def katz_brute(rows, train):
    texts = [(t or "").encode().lower().split() + [b"\0end"] for _, t in rows]
    c1 = Counter(w for x, k in zip(texts, train) if k for w in x)
    c2 = Counter(p for x, k in zip(texts, train) if k for p in zip([b"\0start", *x], x))
    n, kinds = sum(c1.values()), len(c1)

    def law(c):
        ones = Counter(c.values())
        d = katz.discounts([ones.get(r, 0) for r in range(1, katz.CUT + 2)])
        return lambda x: d[x] * x if x <= katz.CUT else x - katz.REST

    f1, f2 = law(c1), law(c2)
    mass = sum(map(f1, c1.values()))
    unknown = max(1 - mass / n, 1 / (n + kinds + 1)) if n else 1
    p1 = lambda w: (1 - unknown) * f1(c1[w]) / mass if w in c1 else unknown
    left, seen = Counter(), Counter()
    for (v, w), c in c2.items():
        left[v] += c - f2(c)
        seen[v] += p1(w)
    of = {**c1, b"\0start": c1[b"\0end"]}

    def p(v, w):
        if (v, w) in c2:
            return f2(c2[v, w]) / of[v]
        return left[v] / of[v] / (1 - seen[v]) * p1(w) if of.get(v) else p1(w)

    total = [p(v, b"\0never") + sum(p(v, w) for w in c1) for v in [*[v for v in c1 if v != b"\0end"][:5], b"\0start"]] if n else []
    return [(d, not k, len(x), sum(w in c1 for w in x), n, sum(math.log10((c1[w] + 1) / (n + kinds + 1)) for w in x), sum(math.log10(p(v, w)) for v, w in zip([b"\0start", *x], x)))
            for (d, _), x, k in zip(rows, texts, train)], total


@pytest.mark.parametrize("rows", [ODD + [(10 + i, " ".join(prose(i, 60).split()[:30] * 2)) for i in range(50)], [], [(9, "only held out")]])
def test_katz_equals_brute_force(spark, documents, rows):
    train = [zlib.crc32(str(d).encode() if d is not None else b"") % 7 != 2 and d != 9 for d, _ in rows]
    want, total = katz_brute(rows, train)
    got = [tuple(r) for r in katz.score(documents(rows), (bucket(F.col("doc_id"), 7) != 2) & (F.coalesce("doc_id", F.lit(0)) != 9)).collect()]
    assert len(got) == len(want) and all(abs(t - 1) < 1e-9 for t in total)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-5, abs=1e-9)


# --- licenses --------------------------------------------------------------------------------------


def license_blocks(words):
    """(block, template) of every run of words that meets a template, and the labels found, by looking at every run."""
    pairs = [list(dict.fromkeys(zip(w, w[1:]))) for w in (re.findall("[a-z0-9]+", t.lower()) for _, t in licenses.TEMPLATES)]
    found = set()
    for t, (label, notice) in enumerate(licenses.TEMPLATES):
        own, reach = set(pairs[t]), math.ceil(1.25 * len(re.findall("[A-Za-z0-9]+", notice)))
        for i in range(len(words)):
            run = words[i:i + reach]
            here = set(zip(run, run[1:]))
            rivals = [own - set(p) for k, p in enumerate(pairs) if licenses.TEMPLATES[k][0] != label and 100 * len(own & set(p)) >= 80 * len(own) and own - set(p)]
            if 100 * len(own & here) >= 80 * len(own) and all(r & here for r in rivals):
                found.add((i, t))
    return found


def license_row(d, text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    at = [(i, label) for p, label in licenses.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    base = sorted({x for _, x in at})
    labels = sorted(set(base) | {licenses.TEMPLATES[t][0] for _, t in license_blocks(words)})
    return (d, len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(base), ",".join(labels))


def check_licenses(frame, rows):
    result, matches = licenses.scan(frame)
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in result.collect())
    assert got == Counter(license_row(d, t) for d, t in rows)
    return matches


def test_licenses(spark, documents):
    rng = random.Random(4)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()})
    rows = ODD + [(20, "Released under the MIT-license, mit\nLICENSE."), (21, "See the GNU General Public License version 3. apache license"), (22, "licensed under CC BY-NC 4.0!\nnothing"),
                  (23, "commit license permit licenses"), (24, "Redistribution and use in source and binary forms, with or without modifications, is permitted"), (25, "the MIT \u212Aicense mit licens\u00e9")]
    rows += [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(300))) for i in range(5)]  # scattered words are no notice
    for i in range(60):  # notices with words lost, added or changed, next to each other
        parts = []
        for _ in range(rng.randint(1, 3)):
            words = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(words))
                words[k:k + rng.randint(0, 1)] = rng.choice([[], ["other"], [rng.choice(vocabulary)]])
            parts.append(" ".join(words))
        rows.append((200 + i, prose(i, rng.randint(0, 5)) + rng.choice([" ", "\n", ". "]).join(parts)))
    check_licenses(documents(rows), rows)
    assert licenses.scan(documents([]))[0].collect() == [] and licenses.scan(documents([]))[1].collect() == []


def test_blocks_are_those_of_brute_force(spark, documents):
    text = prose(1, 30) + " " + licenses.TEMPLATES[0][1] + " " + licenses.TEMPLATES[8][1] + " " + prose(2, 9)
    words = re.findall("[a-z0-9]+", text.lower())
    heads = {w for w in range(len(words))}
    found = {(r.block, r.template) for r in licenses.scan(documents([(1, text)]))[1].collect()}
    want = {x for x in license_blocks(words) if x[0] in heads}
    assert found <= want and {t for _, t in found} == {t for _, t in want} == {0, 8}


# Text, and the labels it must get beyond those of its phrases: each variant exactly its own.
VARIANTS = [("This text is under the GNU General Public License, version 3.", ""), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY-SA 4.0.", "cc-by-sa"), ("Licensed under CC BY-ND 4.0.", ""),
            ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"), ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
            ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", ""), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ""),
            ("Licensed under the GNU Lesser General Public License", "lgpl"), ("Licensed under the Apache License, Version 2.0", ""), ("Licensed under the Apache License. Das ist nicht mit dem anderen, released the under", ""),
            ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "")]


def test_every_variant_gets_its_own_label(spark, documents):
    rows = [(i, prose(i, 20) + "\n" + t + "\n" + prose(i + 50, 20)) for i, (t, _) in enumerate(VARIANTS)]
    got = {r.doc_id: (set(r.labels.split(",")) - set(r.base_labels.split(","))) - {""} for r in licenses.scan(documents(rows))[0].collect()}
    assert got == {i: {x for x in label.split(",") if x} for i, (_, label) in enumerate(VARIANTS)}
    check_licenses(documents(rows), rows)


@pytest.mark.parametrize("width", [12, 60])
def test_wrapped_notices(spark, documents, width):
    """Line breaks, comment signs and blank lines within a notice do not hide it, and it gets no label but its own."""
    rows, want = [], {}
    for i, (label, notice) in enumerate(licenses.TEMPLATES):
        for j, sep in enumerate(["\n", "\r\n", "\n # ", "\n\n"]):
            for k, before in enumerate(["", prose(i, 7 * j + 20) + "\n"]):
                d = 100 * i + 10 * j + k
                rows.append((d, before + sep.join(textwrap.wrap(notice, width, break_long_words=False)) + "\n" + prose(d, 70)))
                want[d] = label
    result, matches = licenses.scan(documents(rows))
    assert all(set(r.labels.split(",")) == {want[r.doc_id]} | set(r.base_labels.split(",")) - {""} and r.score == 1.0 for r in result.collect())
    assert {(r.doc_id, r.template) for r in matches.filter("containment = 1").collect()} >= {(d, d // 100) for d in want}


# --- language --------------------------------------------------------------------------------------


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = bucket(F.col("doc_id"), 4) == 2
    model = language.fit(*language.sample(docs.filter(~held)))
    got = language.identify(docs.filter(held).withColumn("score", F.lit("clash")), model).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.9 and got.score.between(0, 1).all()


def test_language_edges(spark, documents):
    model = language.fit(["the cat and the dog", "der Hund und die Katze"], ["en", "de"])
    got = language.identify(documents(ODD + [(30, "12 34 !"), (31, "und der die das und")]), model).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) and (r.lang_pred != "und" or r.score == 0)
    assert next(r for r in got if r.doc_id == 31).lang_pred == "de"
    empty = language.fit([], [])
    assert {r.lang_pred for r in language.identify(documents(ODD), empty).collect()} == {"und"}


def test_language_sample(spark):
    rows = [(i, "short words " + str(i), "en") for i in range(300)] + [(1000 + i, "lange Worte " * 5000 + "Ende", "de") for i in range(20)] + [(2000, None, "en"), (2001, "12 34", "en"), (2002, "sans langue", None), (2003, "bon", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held, langs = language.sample(docs, size=30)
    assert {g: langs.count(g) for g in set(langs)} == {"en": 10, "de": 10, "fr": 1}
    whole = [x.tolist() for x in language.presence(rows[300][1])]
    assert all([x.tolist() for x in h] == whole for h, g in zip(held, langs) if g == "de")  # to the last word
    assert language.sample(docs.filter("lang IS NULL")) == ([], []) and sorted(set(language.sample(docs, size=1)[1])) == ["de", "en", "fr"]


def loop_grams(text, n):
    """The set of n-grams, by hand."""
    text = "\0" + re.sub(r"\0+", "\0", "".join(c if c.isalpha() else "\0" for c in text.lower())).strip("\0") + "\0"
    return {text[i:i + n] for i in range(len(text) - n + 1)} if text.strip("\0") else set()


def test_kernel_against_sets_of_ngrams():
    texts = ["Der Hund, die Katze!", "the cat", "Ελληνικά γράμματα", "𐐔𐐯 words", "日本語 テキスト", "a", "x1y2"]
    model = language.fit(texts, [str(i) for i in range(len(texts))], landmarks=len(texts))
    got = language.kernel(model, [language.presence(t) for t in [*texts, "...", "the Hund"]])
    order = [texts.index(t) for t in sorted(texts, key=lambda t: str(texts.index(t)))]
    for i, t in enumerate([*texts, "...", "the Hund"]):
        for j, landmark in enumerate(texts[k] for k in order):
            want = sum(len(loop_grams(t, n) & loop_grams(landmark, n)) / math.sqrt(max(1, len(loop_grams(t, n))) * len(loop_grams(landmark, n))) for n in (1, 2, 3)) / 3
            assert math.isclose(got[i, j], want, rel_tol=1e-5, abs_tol=1e-6)


def test_languages_of_many_scripts(spark):
    """Fourteen made-up languages in seven scripts, one beyond the basic plane: each is told from the others of its script."""
    starts = {"latin": 0x61, "greek": 0x3b1, "cyrillic": 0x430, "hebrew": 0x5d0, "armenian": 0x561, "devanagari": 0x915, "deseret": 0x10428}
    rng = random.Random(6)
    rows = []
    for script, start in starts.items():
        for half in (0, 1):
            words = ["".join(chr(start + rng.randrange(22)) for _ in range(rng.randint(2, 6))) for _ in range(60)]
            rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(40)), f"{script}{half}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = bucket(F.col("doc_id"), 4) == 2
    got = language.identify(docs.filter(held), language.fit(*language.sample(docs.filter(~held)))).toPandas()
    right = (got.lang == got.lang_pred).groupby(got.lang).mean()
    assert len(right) == 14 and right.min() > 0.95
    many = spark.createDataFrame([(i, chr(0x4e00 + i) * 3, f"l{i}") for i in range(300)], "doc_id long, text string, lang string")
    assert (lambda p: (p.lang == p.lang_pred).mean())(language.identify(many, language.fit(*language.sample(many))).toPandas()) > 0.95  # no limit to languages


# --- mixing ----------------------------------------------------------------------------------------


def test_rake_meets_targets(spark):
    rng = random.Random(1)
    rows = [(f"s{i}", f"l{j}", f"t{k}", rng.randint(1, 1000)) for i in range(4) for j in range(3) for k in range(2)] + [("s9", "l0", "t0", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    goal = spark.createDataFrame([("s0", 5.0), ("s1", 1.0), ("s2", 1.0), ("s3", 3.0)], "category string, share double")
    got = mixing.rake(cells, {"source": goal}, passes=40).toPandas()
    got["mass"] = got.tokens * got.weight
    share = got.groupby("source").mass.sum() / got.mass.sum()
    assert share.to_dict() == pytest.approx({"s0": 0.5, "s1": 0.1, "s2": 0.1, "s3": 0.3, "s9": 0.0}, abs=1e-5)
    for d in ("lang", "topic"):
        seen = got.groupby(d).tokens.sum() ** mixing.TEMPERATURE
        assert (got.groupby(d).mass.sum() / got.mass.sum()).to_dict() == pytest.approx((seen / seen.sum()).to_dict(), abs=1e-5)
    p = mixing.scale(mixing.rake(cells, {"source": goal}, passes=40), 0.6).toPandas()
    assert (p.tokens * p.probability).sum() == pytest.approx(0.6 * p.tokens.sum(), rel=1e-9) and p.probability.between(0, 1).all()


@pytest.mark.parametrize("local", [mixing.LOCAL_CELLS, 0])
def test_rake_goes_on_until_margins_fit(spark, local):
    """Sources of nearly one language each settle slowly."""
    leak = 3 if local else 40  # fewer rounds where each is a Spark job
    rows = [("s0", "l0", "t", 100_000), ("s0", "l1", "t", leak), ("s1", "l1", "t", 1000), ("s1", "l0", "t", leak), ("s2", "l0", "t", 900), ("s2", "l1", "t", 900)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    goals = {"source": [("s0", 0.3), ("s1", 0.5), ("s2", 0.2)], "lang": [("l0", 0.55), ("l1", 0.45)]}
    got = mixing.rake(cells, {d: spark.createDataFrame(g, "category string, share double") for d, g in goals.items()}, local=local).toPandas()
    got["mass"] = got.tokens * got.weight / got.tokens.sum()
    for d, g in goals.items():
        assert got.groupby(d).mass.sum().to_dict() == pytest.approx(dict(g), rel=2e-6)
    assert got.misfit.max() <= mixing.TOLERANCE


def test_rake_tells_margins_that_cannot_be_met(spark):
    cells = spark.createDataFrame([("s0", "l0", "t", 10), ("s1", "l1", "t", 10)], "source string, lang string, topic string, tokens long")
    goals = {"source": [("s0", 0.3), ("s1", 0.7)], "lang": [("l0", 0.6), ("l1", 0.4)]}
    with pytest.warns(UserWarning, match="do not meet"):
        got = mixing.rake(cells, {d: spark.createDataFrame(g, "category string, share double") for d, g in goals.items()}).collect()
    assert all(r.misfit == pytest.approx(1.0) for r in got)  # 0.6 where 0.3 is wanted


def test_mix_keeps_every_row(spark, documents):
    got = mixing.mix(documents(ODD).union(documents([(50, "other words here")], source=None, lang=None))).collect()
    assert len(got) == len(ODD) + 1 and all(r.probability is not None for r in got)
    assert mixing.mix(documents([])).count() == 0
