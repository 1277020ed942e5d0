"""Packing token streams into fixed windows by minimum bin slack.

Documents are cut at whole windows; what remains of each is shorter than a window.
A plan needs only how many pieces of each length there are (at most `window` numbers,
whatever the corpus), so it is made once for the whole corpus: a bitset of reachable
sums, one per length, tells which multiset of remaining lengths fills a window
closest to capacity; walking the bitsets back gives the counts, and the
pattern is used for as many windows as the counts allow.  Pieces then find their place by
their rank among the pieces of their length.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T, Window as W

from .common import durable

WINDOW = 2048
END = 1  # closes every document
ROOM = 1 << 18  # words and word parts that a worker remembers

_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class WordEncoder:
    """Token ids of texts, word by word.

    The tokenizer drops white space and never merges across it, so a text's ids are
    those of its words, and words come again and again.  Words of ASCII and Latin-1 letters are split
    into the tokenizer's own word parts first; all others go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            letters = part if part.isascii() else "".join(chr(b) if 33 <= b < 127 or 161 <= b < 173 or b > 173 else chr(_SHIFTED[b]) for b in part.encode())
            ids = np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()
            if len(self.parts) < ROOM:
                self.parts[part] = ids
        return ids

    def word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self._part, _PARTS.findall(unicodedata.normalize("NFC", text).lower())))
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.words
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            own = {}
            for w in set(words).difference(known):
                own[w] = self.word(w)
            if len(known) + len(own) < ROOM:
                known.update(own)
                return b"".join(map(known.__getitem__, words))
            own.update((w, known[w]) for w in set(words) if w in known)
            return b"".join(map(own.__getitem__, words))


# Bytes that a byte-level vocabulary writes as other characters: the unprintable ones, in order, from 256 on.
_SHIFTED = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenise(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids) of docs(doc_id, text), cut at whole windows.

    ids holds the piece's token ids as little-endian unsigned 32-bit numbers.  A null or
    empty text is the end id alone.  Each row is a document of its own, also where a doc_id repeats or is null.
    """

    def run(batches):
        encode, closing = encoder(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            row, start, length, total, ids = [], [], [], [], []

            def piece():
                out = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, total)), pa.array(ids, pa.binary())],
                                                 ["doc_id", "start", "length", "doc_tokens", "ids"])
                for x in (row, start, length, total, ids):
                    x.clear()
                return out

            for i, text in enumerate(batch.column(1)):
                data = encode(text.as_py()) + closing
                n = len(data) // 4
                for at in range(0, n, window):
                    part = data[4 * at : 4 * (at + window)]
                    row.append(i); start.append(at); length.append(len(part) // 4); total.append(n); ids.append(part)
                if len(ids) >= 4096:
                    yield piece()
            yield piece()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")


def fill(counts: dict[int, int], window: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum-bin-slack plan: (windows, [(length, pieces in each)]) until every piece is used.

    Every pattern holds the longest piece left.  The rest comes from a bounded subset-sum
    over bitsets, from short to long, walked back from the sum closest to capacity and taking
    long pieces first.
    """
    left, plan = {k: v for k, v in sorted(counts.items()) if v}, []
    while left:
        longest = next(reversed(left))
        room = window - longest
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for k, have in left.items():
            if k > room or reach == mask:
                break
            have = min(have - (k == longest), room // k)
            steps.append((k, have, reach))
            step = 1
            while have > 0:
                use = min(step, have)
                reach |= (reach << (use * k)) & mask
                have -= use
                step *= 2
        at, uses = reach.bit_length() - 1, {longest: 1}
        for k, have, before in reversed(steps):
            n = next(n for n in range(min(have, at // k), -1, -1) if before >> (at - n * k) & 1)
            if n:
                uses[k] = uses.get(k, 0) + n
                at -= n * k
        times = min(left[k] // n for k, n in uses.items())
        plan.append((times, sorted(uses.items(), reverse=True)))
        for k, n in uses.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _places(plan) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length: (first rank, ranks, uses per window, first window, offset), in rank order."""
    places, used, window = {}, {}, 0
    for times, uses in plan:
        offset = 0
        for length, n in uses:
            first = used.get(length, 0)
            places.setdefault(length, []).append((first, n * times, n, window, offset))
            used[length] = first + n * times
            offset += n * length
        window += times
    return places


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """pieces with sequence_id and offset: windows of at most `window` tokens with little padding.

    pieces needs a column length (1 to window) and keeps its others, save `sequence_id`,
    `offset` and names that begin with `_pack`.  An empty table gives an empty table.
    The rows are written out once, so that ranks hold when tasks are run again.
    """
    pieces = durable(pieces.drop("sequence_id", "offset").withColumn("_pack_part", F.spark_partition_id()).withColumn("_pack_row", F.monotonically_increasing_id()))
    sizes = durable(pieces.groupBy("length", "_pack_part").agg(F.count("*").alias("_pack_n")))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_pack_n").alias("n")).collect()}  # `window` rows at most
    if counts and not 0 < min(counts) <= max(counts) <= window:
        raise ValueError(f"piece lengths must lie between 1 and {window}")
    segment = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("first", "ranks", "uses", "window", "offset")]))
    plan = pieces.sparkSession.createDataFrame(list(_places(fill(counts, window)).items()), T.StructType([T.StructField("length", T.LongType()), T.StructField("_pack_plan", segment)]))
    before = sizes.select("length", "_pack_part", (F.sum("_pack_n").over(W.partitionBy("length").orderBy("_pack_part")) - F.col("_pack_n")).alias("_pack_before"))
    rank = F.col("_pack_before") + F.row_number().over(W.partitionBy("_pack_part", "length").orderBy("_pack_row")) - 1
    ranked = pieces.join(before, ["length", "_pack_part"]).withColumn("_pack_rank", rank).join(F.broadcast(plan), "length")  # `window` rows at most
    own = ranked.withColumn("_pack_own", F.element_at(F.filter("_pack_plan", lambda s: (s["first"] <= F.col("_pack_rank")) & (F.col("_pack_rank") < s["first"] + s["ranks"])), 1))
    k = F.col("_pack_rank") - F.col("_pack_own.first")
    own = own.withColumn("sequence_id", F.col("_pack_own.window") + F.floor(k / F.col("_pack_own.uses")))
    own = own.withColumn("offset", F.col("_pack_own.offset") + F.pmod(k, F.col("_pack_own.uses")) * F.col("length"))
    return own.select(*[c for c in pieces.columns if not c.startswith("_pack")], "sequence_id", "offset")


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """(sequence_id, tokens, ids) with each window's ids joined in order and padded, unless it is a power of two long."""
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_own"))
    ids = F.aggregate("_own", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    full = F.when(F.expr("bit_count(tokens)") == 1, F.col("tokens")).otherwise(window)
    padding = F.unhex(F.repeat(F.lit(np.array([pad], "<u4").tobytes().hex()), (full - F.col("tokens")).cast("int")))
    return rows.select("sequence_id", "tokens", F.concat(ids, padding).alias("ids"))
