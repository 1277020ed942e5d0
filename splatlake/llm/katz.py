"""Katz backoff language model over words, trained and scored in blocks of documents.

A token's probability is the discounted share of its bigram where training has it, else the backoff
weight of its context times the discounted share of the word, else the mass Good-Turing
leaves for unknown words (one event).  Weights are normalised exactly: for
every context the seen and the backed-off probabilities sum to 1.

Documents are gathered in blocks of bounded size.  A block asks for the corpus counts of each of its distinct
words and bigrams once; requests meet by ranges of the 64-bit hash, where they are
summed over the training documents, and answers come back in the order of the request.
Nothing is sent per token, and no table is ever held whole by one task.  Of all blocks that hold a bigram one
owns it and adds it to its context's sums, from which the backoff weights are made, again by hash ranges.
Counts (level, part) and backoff weights (part) are kept in partitioned tables.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, durable, mix64, words_of

BLOCK_TOKENS = 2_000_000  # of a block; one longer document is a block of its own
PART_ENTRIES = 1_000_000  # requests that meet in one task, about
CUT = 5  # counts up to here are discounted by Good-Turing
REST = 0.05  # subtracted from larger counts, so that every context has mass to back off with
END, START = np.uint64(0x0A11CE5ED0C5E9D1), np.uint64(0x5EEDBEEFCAFEF00D)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _bigrams(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(mix64(v) * _STEP + w)


def _squeeze(sorted_hashes: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, byte plane by byte plane."""
    return np.ascontiguousarray(np.diff(sorted_hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def discounts(ones: list[int]) -> np.ndarray:
    """d_r for r = 0 to CUT from the numbers of n-grams seen 1 to CUT + 1 times; absolute discounting where Good-Turing has no valid value."""
    d = np.ones(CUT + 1)
    n = [0, *ones]
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    far = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        turing = ((r + 1) * n[r + 1] / (r * n[r]) - far) / (1 - far) if n[r] and far < 1 else 0.0
        d[r] = turing if 0 < turing < 1 else (r - min(max(absolute, REST), 0.95)) / r
    return d


def _discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c <= CUT, d[np.minimum(c, CUT)] * c, c - REST)


class Block:
    """The stored form of a block, opened: its words, stream and distinct bigrams."""

    def __init__(self, words: bytes, stream: bytes, sizes, train):
        self.words = np.frombuffer(words, np.uint64)  # sorted
        self.stream = np.frombuffer(zlib.decompress(stream), np.int32)
        self.sizes, self.train = np.array(sizes, np.int64), np.array(train, bool)
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        first = np.zeros(len(self.stream), bool)
        first[np.concatenate([[0], np.cumsum(self.sizes)[:-1]])] = True
        self.context = np.where(first, np.int32(-1), np.concatenate([self.stream[:1], self.stream[:-1]]))
        seen = self.words[self.context]
        seen[first] = START
        seen = _bigrams(seen, self.words[self.stream])
        self.pairs, at, pair = np.unique(seen, return_index=True, return_inverse=True)
        self.at, self.pair = at.astype(np.int32), pair.astype(np.int32)
        self.live = self.train[self.doc]


def blocks(docs: DataFrame, train, limit: int = BLOCK_TOKENS) -> DataFrame:
    """docs(doc_id, text) gathered as (block, ids, sizes, train, words, stream)."""
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        hashes, number, held = WordHashes(), 0, 0
        ids, flags, rows = [], [], []

        def close():
            nonlocal number, held
            lists = np.concatenate(rows)
            words, stream = np.unique(lists, return_inverse=True)
            out = pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() << 32 | number]), pa.array([ids], pa.list_(pa_kind)), pa.array([[len(r) for r in rows]], pa.list_(pa.int64())),
                 pa.array([flags], pa.list_(pa.bool_())), pa.array([words.tobytes()], pa.binary()), pa.array([zlib.compress(stream.astype(np.int32).tobytes(), 1)], pa.binary())],
                ["block", "ids", "sizes", "train", "words", "stream"])
            number, held = number + 1, 0
            return out

        for b in batches:
            pa_kind = b.column(0).type
            for i, text, flag in zip(*(c.to_pylist() for c in b.columns)):
                row = np.append(hashes(words_of(text)), END)
                if held and held + len(row) > limit:
                    yield close()
                    ids, flags, rows = [], [], []
                ids.append(i)
                flags.append(flag)
                rows.append(row)
                held += len(row)
        if rows:
            yield close()

    schema = f"block long, ids array<{kind.simpleString()}>, sizes array<long>, train array<boolean>, words binary, stream binary"
    return docs.select("doc_id", "text", train.alias("train")).mapInArrow(run, schema)


def _parted(hashes: np.ndarray, parts: int):
    """(part, slice) of sorted hashes by ranges of the hash."""
    edges = np.searchsorted(hashes, np.array([(i << 64) // parts for i in range(1, parts)], np.uint64))
    edges = np.concatenate([[0], edges, [len(hashes)]]).tolist()
    return [(p, slice(a, b)) for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


def _ask(parts: int):
    names = ["level", "part", "block", "hashes", "counts"]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                x = Block(row["words"], row["stream"], row["sizes"], row["train"])
                for level, keys, of in ((1, x.words, x.stream), (2, x.pairs, x.pair)):
                    counts = np.bincount(of[x.live], minlength=len(keys)).astype(np.int32)
                    cut = _parted(keys, parts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([level] * len(cut)), pa.array([p for p, _ in cut]), pa.array([row["block"]] * len(cut)), pa.array([_squeeze(keys[s]) for _, s in cut], pa.binary()),
                         pa.array([counts[s].tobytes() for _, s in cut], pa.binary())], names)

    return run


def _answer(key, table):
    """Corpus counts in each request's order, negative where the block owns the n-gram; block -1 brings statistics."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    hashes = [_unsqueeze(r["hashes"]) for r in rows]
    counts = np.concatenate([np.frombuffer(r["counts"], np.int32) for r in rows]).astype(np.int64)
    keys, where = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(where, counts, len(keys)).astype(np.int64)
    owner = np.full(len(keys), len(where))
    live = np.flatnonzero(counts)
    np.minimum.at(owner, where[live], live)
    out = total[where]
    out[owner[total > 0]] *= -1
    level, part = key[0].as_py(), key[1].as_py()
    seen = total[total > 0]
    stats = np.concatenate([[len(seen), seen.sum()], np.bincount(np.minimum(seen, CUT + 2), minlength=CUT + 3)[1 : CUT + 2]]).astype(np.int64)
    ends = np.cumsum([len(h) for h in hashes])
    pieces = [zlib.compress(out[e - len(h) : e].tobytes(), 1) for h, e in zip(hashes, ends)]
    return pa.table({"level": [level] * (len(rows) + 1), "part": [part] * (len(rows) + 1), "block": [-1] + [r["block"] for r in rows], "payload": pa.array([stats.tobytes()] + pieces, pa.binary())})


def _score(stats: dict[int, np.ndarray], parts: int):
    """Scores of a block's documents, less what backs off; sums of owned contexts; uses of backed-off contexts."""
    kinds, tokens = (int(x) for x in stats[1][:2])
    d1, d2 = (discounts(stats[i][2 : CUT + 3].tolist()) for i in (1, 2))
    mass = float(stats[1][-1])  # discounted counts of all words
    unknown = max(1 - mass / tokens, 1 / (tokens + kinds + 1)) if tokens else 1.0

    def run(key, state, answers):
        row = state.to_pylist()[0]
        x = Block(row["words"], row["stream"], row["sizes"], row["train"])
        got = {1: [], 2: []}
        for r in sorted(answers.select(["level", "part", "payload"]).to_pylist(), key=lambda r: r["part"]):
            got[r["level"]].append(np.frombuffer(zlib.decompress(r["payload"]), np.int64))
        uni, bi = np.abs(np.concatenate(got[1])), np.concatenate(got[2])
        own, bi = bi < 0, np.abs(bi)
        with np.errstate(divide="ignore"):
            p1 = np.where(uni > 0, (1 - unknown) * _discounted(uni, d1) / max(mass, 1e-300), unknown)
            base = np.log10((uni + 1) / (tokens + kinds + 1))
            ends = uni[np.searchsorted(x.words, END)]
            before = np.append(uni, ends)  # a context's count; the start of a text is the last
            pair_w, pair_v = x.stream[x.at], np.where(x.context[x.at] < 0, len(uni), x.context[x.at])
            seen = bi > 0
            log = np.where(seen, np.log10(np.where(seen, _discounted(bi, d2), 1)) - np.log10(np.maximum(before[pair_v], 1)), np.log10(p1[pair_w]))
        back = ~seen & (before[pair_v] > 0)
        n = len(x.sizes)
        per = lambda w: np.bincount(x.doc, w, n)
        # Sums of contexts over the bigrams that this block owns: what is left, and the words seen.
        names = np.append(x.words, START)
        left = np.bincount(pair_v[own], (bi - _discounted(bi, d2))[own], len(names))
        words = np.bincount(pair_v[own], p1[pair_w[own]], len(names))
        use = np.flatnonzero(back[x.pair])
        context, times = np.unique(pair_v[x.pair[use]].astype(np.int64) * n + x.doc[use], return_counts=True)
        context, doc = context // n, context % n
        out = {c: [] for c in ("kind", "part", "block", "a", "b", "c", "d")}

        def put(kind, part, a, b, c, d):
            for k, v in zip(out, (kind, part, row["block"], a, b, c, d)):
                out[k].append(v)

        put(0, 0, per(log[x.pair]).tobytes(), per(base[x.stream]).tobytes(), per((uni > 0)[x.stream]).astype(np.int64).tobytes(), None)
        held = np.flatnonzero(left > 0)
        held = held[np.argsort(names[held], kind="stable")]
        for p, s in _parted(names[held], parts):
            i = held[s]
            put(1, p, _squeeze(names[i]), left[i].astype(np.float32).tobytes(), words[i].astype(np.float32).tobytes(), before[i].astype(np.int64).tobytes())
        order = np.argsort(names[context], kind="stable")
        context, doc, times = context[order], doc[order], times[order]
        for p, s in _parted(names[context], parts):
            put(2, p, _squeeze(names[context[s]]), doc[s].astype(np.int32).tobytes(), times[s].astype(np.int32).tobytes(), None)
        return pa.table({"kind": out["kind"], "part": out["part"], "block": out["block"], **{c: pa.array(out[c], pa.binary()) for c in "abcd"}})

    return run, kinds, tokens


def _weigh(key, table):
    """Backoff weights of the contexts of a hash range (kind 3), and what they add to each document (kind 4)."""
    rows = table.to_pylist()
    sums, uses = [r for r in rows if r["kind"] == 1], [r for r in rows if r["kind"] == 2]
    out = {"kind": [], "block": [], "a": [], "b": []}
    if sums:
        names, where = np.unique(np.concatenate([_unsqueeze(r["a"]) for r in sums]), return_inverse=True)
        join = lambda c, t: np.concatenate([np.frombuffer(r[c], t) for r in sums])
        left, words = (np.bincount(where, join(c, np.float32), len(names)) for c in "bc")
        count = np.zeros(len(names), np.int64)
        count[where] = join("d", np.int64)
        weight = np.log10(left / count) - np.log10(1 - words)
        out = {"kind": [3], "block": [-1], "a": [_squeeze(names)], "b": [weight.tobytes()]}
        for r in uses:
            doc, times = np.frombuffer(r["b"], np.int32), np.frombuffer(r["c"], np.int32)
            add = times * weight[np.searchsorted(names, _unsqueeze(r["a"]))]
            ids, at = np.unique(doc, return_inverse=True)
            for c, v in zip(out, (4, r["block"], ids.astype(np.int64).tobytes(), np.bincount(at, add, len(ids)).tobytes())):
                out[c].append(v)
    return pa.table({"kind": pa.array(out["kind"], pa.int64()), "block": pa.array(out["block"], pa.int64()), "a": pa.array(out["a"], pa.binary()), "b": pa.array(out["b"], pa.binary())})


def score(docs: DataFrame, train) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs(doc_id, text).

    `train` is a condition on docs that selects the training rows.  Tokens are words after
    lower-casing A-Z, then one end.  A null or empty text is the end alone.  n_known counts tokens
    that training has; base_score is the add-one unigram log10 probability, score the model's.  Without any training
    rows both are 0.  Repeated rows count and are scored each for itself.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    state = durable(blocks(docs, train))
    total = state.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    parts = max(8, -(-total // PART_ENTRIES))
    asked = state.mapInArrow(_ask(parts), "level long, part long, block long, hashes binary, counts binary")
    answers = durable(asked.groupBy("level", "part").applyInArrow(_answer, "level long, part long, block long, payload binary"))
    stats = {1: np.zeros(CUT + 3, np.int64), 2: np.zeros(CUT + 3, np.int64)}
    for level, i, n in (answers.filter("block = -1").select("level", "payload").mapInArrow(_sum_stats, "level long, i long, n long").groupBy("level", "i").agg(F.sum("n")).collect()):
        stats[level][i] = n
    # Discounted mass of all words: counts above CUT lose REST each.
    d1 = discounts(stats[1][2:].tolist())
    few = sum(int(stats[1][1 + r]) * r for r in range(1, CUT + 1))
    many = int(stats[1][0]) - sum(int(stats[1][1 + r]) for r in range(1, CUT + 1))
    mass = sum(int(stats[1][1 + r]) * r * d1[r] for r in range(1, CUT + 1)) + (int(stats[1][1]) - few) - REST * many
    run, _, tokens = _score({1: np.append(stats[1].astype(np.float64), mass), 2: stats[2].astype(np.float64)}, parts)
    partial = durable(state.groupBy("block").cogroup(answers.filter("block >= 0").groupBy("block")).applyInArrow(
        run, "kind long, part long, block long, a binary, b binary, c binary, d binary"))
    weights = durable(partial.filter("kind > 0").groupBy("part").applyInArrow(_weigh, "kind long, block long, a binary, b binary"))
    lines = state.select("block", F.lit(-1).cast("long").alias("kind"), "ids", "sizes", "train", F.lit(None).cast("binary").alias("a"), F.lit(None).cast("binary").alias("b"), F.lit(None).cast("binary").alias("c"))
    none = lambda t: F.lit(None).cast(t)
    more = partial.filter("kind = 0").select("block", "kind", none(f"array<{kind}>"), none("array<long>"), none("array<boolean>"), "a", "b", "c").union(
        weights.filter("kind = 4").select("block", "kind", none(f"array<{kind}>"), none("array<long>"), none("array<boolean>"), "a", "b", none("binary")))

    def finish(key, table):
        rows = table.to_pylist()
        head = next(r for r in rows if r["kind"] == -1)
        main = next(r for r in rows if r["kind"] == 0)
        value = np.frombuffer(main["a"]).copy()
        for r in rows:
            if r["kind"] == 4:
                value[np.frombuffer(r["a"], np.int64)] += np.frombuffer(r["b"])
        n = len(value)
        at = [i for i, r in enumerate(rows) if r["kind"] == -1][0]
        ids = table.column("ids").combine_chunks()[at].values
        return pa.table({"doc_id": ids, "held_out": pa.array([not t for t in head["train"]], pa.bool_()), "n_tokens": pa.array(head["sizes"], pa.int64()),
                         "n_known": np.frombuffer(main["c"], np.int64), "train_tokens": pa.array([tokens] * n, pa.int64()), "base_score": np.frombuffer(main["b"]), "score": value})

    return lines.union(more).groupBy("block").applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _sum_stats(batches):
    for b in batches:
        rows = [(r["level"], i, n) for r in b.to_pylist() for i, n in enumerate(np.frombuffer(r["payload"], np.int64).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), ()))], ["level", "i", "n"])
