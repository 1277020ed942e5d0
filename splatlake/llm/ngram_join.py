"""Exact Jaccard join of documents on word shingles by several global token orders.

A pair that reaches the threshold shares tokens among the first tokens of both sets
under *every* total order of the tokens.  The orders are used in turn:

1. Hash order picks each set's zone (its first z(n) tokens).  Two sets of Jaccard
   similarity t share at least c(n) tokens of their zones.
2. Frequency order (rarest first, ties by hash) picks the first z(n) - c(n) + 1 tokens
   of the zone; these alone are indexed, so passages that many documents share
   are indexed only for documents that hold little else.
3. Candidates must also agree on parity bitmaps (a lower bound of the symmetric
   difference) and share prefix tokens under further hash orders before the
   full sets are compared.

Only components are asked for, so a bucket is first compared with one central member;
pairs of its members are looked at only where they are still in different
components.  Every filter is a necessary condition: no link between two components is lost.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, Window as W

from .common import WordHashes, components, dropped_shuffles, durable, mix64, small_batches, words_of

WORDS, PERCENT = 5, 80
BITS = 1024  # of a parity bitmap
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # further hash orders
_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1 << 14)
def prefix_size(n: int, percent: int) -> int:
    """Tokens of a set of n that must hold a shared one, under any order."""
    return n - -(-percent * n // 100) + 1


def zone_size(n: int, percent: int) -> int:
    return min(n, prefix_size(n, percent) + n // 10 + 1)


@lru_cache(1 << 14)
def zone_overlap(n: int, percent: int) -> int:
    """Tokens that the zones of a set of n and of any set similar to it share at least."""
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1, dtype=np.int64)
    both = -(-percent * (n + m) // (100 + percent))  # smallest overlap that reaches the threshold
    z = np.minimum(m, m - -(-percent * m // 100) + 1 + m // 10 + 1)
    return max(1, int(np.minimum(zone_size(n, percent) - n + both, z - m + both).min()))


def shingle_sets(texts, hashes: WordHashes, words: int = WORDS, together: int = 256) -> list[np.ndarray]:
    """Sorted 64-bit tokens of the distinct shingles of each text, empty without words; `together` texts are split at a time."""
    return [s for lo in range(0, len(texts), together) for s in _shingle_sets(texts[lo : lo + together], hashes, words)]


def _shingle_sets(texts, hashes: WordHashes, words: int) -> list[np.ndarray]:
    lists = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    if not sizes.sum():
        return [np.zeros(0, np.uint64)] * len(lists)
    h = hashes([w for x in lists for w in x])
    run = np.zeros(len(h), np.uint64)
    for k in range(min(words, len(h))):  # the slice may hold fewer words than a shingle
        run[: len(h) - k] = run[: len(h) - k] * _STEP + h[k:]
    run = mix64(run)
    out, at = [], 0
    for n in sizes.tolist():
        if n >= words:
            out.append(np.unique(run[at : at + n - words + 1]))
        elif n:
            one = np.uint64(n)
            for x in h[at : at + n]:
                one = mix64(np.array([one], np.uint64) * _STEP + x)[0]
            out.append(np.array([one], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def _key(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def _parity(tokens: np.ndarray) -> bytes:
    odd = np.bincount((tokens & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, key, n, zone, parity) per document; zone and parity once per task for documents of equal sets."""

    def run(batches):
        hashes, seen = WordHashes(), set()
        for batch in batches:
            ids, rows = batch.column(0), shingle_sets(batch.column(1).to_pylist(), hashes, words)
            key, n, zone, parity = [], [], [], []
            for tokens in rows:
                k = _key(tokens) if len(tokens) else None
                key.append(k)
                n.append(len(tokens))
                fresh = k is not None and k not in seen
                if fresh:
                    seen.add(k)
                zone.append(_signed(tokens[: zone_size(len(tokens), percent)]) if fresh else None)
                parity.append(_parity(tokens) if fresh else None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(zone, pa.list_(pa.int64())), pa.array(parity, pa.binary())],
                                             ["doc_id", "key", "n", "zone", "parity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key long, n long, zone array<long>, parity binary")


def _index(sig: DataFrame, percent: int) -> DataFrame:
    """(token, key, n, weight): the rarest zone tokens of each distinct set, those no other set has left out."""
    rule = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    zone = F.least("n", rule + F.floor(F.col("n") / 10) + 1)
    post = sig.filter("zone IS NOT NULL").select(F.explode("zone").alias("token"), "key", "n")
    post = post.repartition("token").dropDuplicates(["token", "key", "n"])  # the shuffle on the token serves all three steps
    shared = durable(post.withColumn("df", F.count("*").over(W.partitionBy("token"))).filter("df > 1"))
    mine = W.partitionBy("key", "n")

    def keep(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([zone_overlap(n, percent) for n in b.column(0).to_pylist()], pa.int64())], ["n", "least"])

    least = shared.select("n").distinct().mapInArrow(keep, "n long, least long")
    ranked = (shared.withColumn("alone", zone - F.count("*").over(mine)).withColumn("weight", F.sum("df").over(mine))
              .withColumn("at", F.row_number().over(mine.orderBy("df", "token"))))
    return durable(ranked.join(least, "n").filter(F.col("alone") + F.col("at") <= zone - F.col("least") + 1).select("token", "key", "n", "weight"))


def _fits(a: str, b: str, percent: int):
    """Length filter on two set sizes."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _close(percent: int):
    """Parity filter: bits that differ are tokens that differ."""
    words = [F.expr(f"bit_count(pa[{i}] ^ pb[{i}])") for i in range(BITS // 64)]
    both = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))
    return sum(words[1:], words[0]) <= F.col("na") + F.col("nb") - 2 * both


def _parities(sig: DataFrame) -> DataFrame:
    """(key, n, bits): a parity bitmap as longs, once per distinct set."""
    part = lambda i: F.conv(F.hex(F.substring("parity", F.lit(8 * i + 1), F.lit(8))), 16, -10).cast("long")
    one = sig.filter("parity IS NOT NULL").groupBy("key", "n").agg(F.first("parity").alias("parity"))
    return one.select("key", "n", F.array(*[part(i) for i in range(BITS // 64)]).alias("bits"))


def _sets(docs: DataFrame, keys: DataFrame, sig: DataFrame, words: int) -> DataFrame:
    """(key, n, tokens) of the wanted sets, from one document of each."""
    one = sig.filter("key IS NOT NULL").groupBy("key", "n").agg(F.min("doc_id").alias("doc_id")).join(keys, ["key", "n"], "left_semi")
    ids = one.select(F.col("doc_id").alias("_want")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_want")), "left_semi").select("text")

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            rows = [t for t in shingle_sets(b.column(0).to_pylist(), hashes, words) if len(t)]
            yield pa.RecordBatch.from_arrays([pa.array([_key(t) for t in rows], pa.int64()), pa.array([len(t) for t in rows], pa.int64()),
                                              pa.array([t.tobytes() for t in rows], pa.binary())], ["key", "n", "tokens"])

    return durable(texts.mapInArrow(run, "key long, n long, tokens binary").join(one.select("key", "n"), ["key", "n"], "left_semi").dropDuplicates(["key", "n"]))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, na, b, nb) whose sets reach the threshold."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("key").alias(side), F.col("n").alias(f"n{side}"), F.col("tokens").alias(f"t{side}")), [side, f"n{side}"])

    def prefix(tokens, order):
        turned = np.sort(mix64(tokens ^ np.uint64(order)))
        return turned[: prefix_size(len(tokens), percent)]

    def linked(x, y):
        for order in ORDERS:
            if not len(np.intersect1d(prefix(x, order), prefix(y, order), assume_unique=True)):
                return False
        k = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * k >= percent * (len(x) + len(y) - k)

    def run(batches):
        for b in batches:
            ta, tb = (b.column(b.schema.get_field_index(c)) for c in ("ta", "tb"))
            keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in zip(ta, tb)]
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "na", "b", "nb"])

    return durable(pairs.mapInArrow(run, "a long, na long, b long, nb long"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of docs(doc_id, text).

    component_id is the smallest doc_id reachable over links of Jaccard similarity
    percent/100 or more between sets of distinct `words`-word shingles.  A text of fewer
    words is one shingle; a null or empty text has none and is linked with nothing.
    Rows of equal texts are linked, also rows of equal doc_id; each row gets its own
    result row.  A null doc_id counts as larger than all others.  Other columns are ignored.
    """
    with small_batches(docs.sparkSession), dropped_shuffles(docs.sparkSession):  # every step below with Python or a shuffle in it is written out
        sig, least = _components(docs.select("doc_id", "text"), words, percent)
    out = sig.select("doc_id", "n", "key").join(least, ["key", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _components(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signatures, and (key, n, component_id) of every distinct set."""
    sig = durable(signatures(docs, words, percent))
    index = _index(sig, percent)
    bits = durable(_parities(sig))

    # Each bucket against its most central member.  Bitmaps are wide and go with pairs, not with buckets.
    hub = index.groupBy("token").agg(F.max(F.struct("weight", "key", "n")).alias("hub"))
    star = (index.join(hub, "token").filter("NOT (key = hub.key AND n = hub.n)")
            .select(F.col("hub.key").alias("a"), F.col("hub.n").alias("na"), F.col("key").alias("b"), F.col("n").alias("nb")))
    star = star.filter(_fits("na", "nb", percent)).distinct()
    for side in ("b", "a"):
        star = star.join(bits.select(F.col("key").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"p{side}")), [side, f"n{side}"])
    star = durable(star.filter(_close(percent)).select("a", "na", "b", "nb"))
    wanted = star.select(F.col("a").alias("key"), F.col("na").alias("n")).union(star.select("b", "nb")).distinct()
    links = _verify(star, _sets(docs, wanted, sig, words), percent)
    found = components(_edges(links))

    # Members of a bucket that are still apart.
    node = F.struct("key", "n")
    rows = index.withColumn("node", node).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = rows.join(rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token"), "token", "left_semi")
    rows = durable(rows.select("token", "key", "n", "component")).join(bits, ["key", "n"])
    a = rows.select("token", F.col("key").alias("a"), F.col("n").alias("na"), F.col("bits").alias("pa"), F.col("component").alias("ca"))
    b = rows.select("token", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("pb"), F.col("component").alias("cb"))
    apart = (F.col("ca") != F.col("cb")) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    rest = a.join(b, (a.token == b.token) & apart & _fits("na", "nb", percent) & _close(percent)).select("a", "na", "b", "nb").distinct()
    done = star.union(star.select("b", "nb", "a", "na"))
    rest = durable(rest.join(done, ["a", "na", "b", "nb"], "left_anti"))
    if not rest.isEmpty():
        wanted = rest.select(F.col("a").alias("key"), F.col("na").alias("n")).union(rest.select("b", "nb")).distinct()
        found = components(_edges(links.union(_verify(rest, _sets(docs, wanted, sig, words), percent))))

    low = (sig.filter("key IS NOT NULL").groupBy(node.alias("node")).agg(F.min("doc_id").alias("least"))
           .join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    return sig, durable(low.groupBy("component").agg(F.min("least").alias("component_id")).join(low.select("component", "node"), "component").select("node.key", "node.n", "component_id"))


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.struct(F.col("a").alias("key"), F.col("na").alias("n")).alias("a"), F.struct(F.col("b").alias("key"), F.col("nb").alias("n")).alias("b"))
