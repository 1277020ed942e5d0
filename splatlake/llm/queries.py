"""The registered query of each operator, over whole tables, and its DuckDB twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import dual_tree, importance, katz, language, licenses, mixing, multiprobe, ngram_join, packing, repair, subwords, urls, warc
from .common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def bucket(key, n: int):
    """crc32 of the key's text, modulo n."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


@query
def op1_packing(spark, d):
    pieces = packing.tokenise(table(spark, d, "documents", "doc_id", "text"), vocabulary())
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(pieces)


@query
def op2_warc(spark, d):
    pages = table(spark, d, "pages", "page_id", "url", "html")
    back, kind = warc.archive(pages), pages.schema["page_id"].dataType
    return back.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", F.coalesce(F.sha1("payload"), "digest").alias("payload_digest"), "record_type",
                       F.col("refers_to_key").cast(kind).alias("refers_to"))


@query
def op3_ngram_jaccard(spark, d):
    return ngram_join.jaccard_components(table(spark, d, "documents", "doc_id", "text"))


@query
def op4_katz(spark, d):
    return katz.score(table(spark, d, "documents", "doc_id", "text"), bucket(F.col("doc_id"), 7) != 2)


@query
def op5_multiprobe(spark, d):
    return multiprobe.search(table(spark, d, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query
def op6_url_filter(spark, d):
    return urls.judge(table(spark, d, "pages", "page_id", "url"))


@query
def op7_licenses(spark, d):
    return licenses.scan(table(spark, d, "documents", "doc_id", "text"))[0]


@query
def op8_language_id(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    held_out = bucket(F.col("doc_id"), 4) == 2
    model = language.fit(*language.sample(docs.filter(~held_out)))
    out = language.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_mixing(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "source", "lang")
    return mixing.mix(docs).select("doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "sampled")


@query
def op10_dual_tree(spark, d):
    return dual_tree.search(table(spark, d, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


ORACLES["op10_dual_tree"] = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v::DOUBLE[], e.v::DOUBLE[])::BIGINT AS score FROM e q, e WHERE q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""


@query
def op11_conversation_repair(spark, d):
    return repair.repair(repair.damage(table(spark, d, "conversations", "conv_id", "turn", "role", "text")))


@query
def op12_quality(spark, d):
    docs, labels = table(spark, d, "documents", "doc_id", "text"), table(spark, d, "labels", "doc_id", "quality")
    held_out = bucket(F.col("doc_id"), 4) == 2
    model = subwords.train(subwords.sample(docs.filter(~held_out), labels))
    return subwords.classify(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op13_importance(spark, d):
    return importance.resample(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "text"))


def crc32_sql(text: str) -> str:
    """DuckDB spelling of the unsigned crc32 of a text's UTF-8 bytes."""
    one = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda k, i: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END, xor(c, b))"
    spelt = f"hex(encode({text}))"
    byte = f"('0x' || substr({spelt}, 2 * i + 1, 2))::BIGINT"
    return f"xor(list_reduce(list_transform(range(length({spelt}) // 2), lambda i: {byte}), lambda c, b: {one}, 4294967295::BIGINT), 4294967295::BIGINT)"


# Damaged rows in order, then a walk over them that keeps, for each conversation and role state (0 start, 1 system, 2 user, 3 assistant), the cheapest
# and least string of edits together with the repaired text. `ins` says what up to two insertions lead to.
ORACLES["op11_conversation_repair"] = f"""WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit FROM conversations),
dmg AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy FROM src WHERE hit <> 0) t),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, role[1] AS r FROM dmg),
flt AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'r' WHEN right(bare, 1) IN ('.', '!', '?') THEN 'k' ELSE 't' END AS fault, lag(r) OVER (PARTITION BY conv_id ORDER BY pos) || r AS pair FROM ord),
ins(st, m, mid, added) AS (VALUES (0, 0, 0, ''), (0, 1, 2, chr(10) || 'user:'), (0, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 0, 1, ''), (1, 1, 2, chr(10) || 'user:'),
  (1, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 0, 2, ''), (2, 1, 3, chr(10) || 'assistant:'), (3, 0, 3, ''), (3, 1, 2, chr(10) || 'user:')),
op(mid, e, r, nxt, c, name) AS (SELECT mid, 'D', NULL::VARCHAR, mid, 3, NULL::VARCHAR FROM (VALUES (0), (1), (2), (3)) m(mid) UNION ALL
  SELECT * FROM (VALUES (0, 'K', 's', 1, 0, NULL::VARCHAR), (0, 'K', 'u', 2, 0, NULL::VARCHAR), (1, 'K', 'u', 2, 0, NULL::VARCHAR), (2, 'K', 'a', 3, 0, NULL::VARCHAR), (3, 'K', 'u', 2, 0, NULL::VARCHAR),
    (0, 'R', NULL::VARCHAR, 2, 2, 'user'), (1, 'R', NULL::VARCHAR, 2, 2, 'user'), (2, 'R', NULL::VARCHAR, 3, 2, 'assistant'), (3, 'R', NULL::VARCHAR, 2, 2, 'user')) k),
walk AS (SELECT conv_id, 0::BIGINT AS pos, 0 AS st, {{'c': 0::BIGINT, 'a': '', 'x': ''}} AS best FROM (SELECT DISTINCT conv_id FROM conversations) t
  UNION ALL SELECT w.conv_id, f.pos, o.nxt, min({{'c': w.best.c + 2 * i.m + o.c + CASE WHEN o.e <> 'D' AND f.fault = 't' THEN 1 ELSE 0 END, 'a': w.best.a || repeat('I', i.m) || o.e,
    'x': w.best.x || i.added || CASE WHEN o.e = 'D' THEN '' ELSE chr(10) || coalesce(o.name, f.role) || ':' || f.text END}})
  FROM walk w JOIN flt f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1 JOIN ins i ON i.st = w.st JOIN op o ON o.mid = i.mid
  WHERE o.e = 'D' OR f.fault IN ('k', 't') AND (o.r IS NULL OR o.r = f.r) GROUP BY w.conv_id, f.pos, o.nxt),
cnt AS (SELECT s.conv_id, count(f.pos) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'r') AS duplicate, count_if(fault = 't') AS truncated,
  count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT DISTINCT conv_id FROM conversations) s LEFT JOIN flt f ON f.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY s.conv_id),
fin AS (SELECT w.conv_id, min({{'c': w.best.c + 2 * i.m, 'a': w.best.a || repeat('I', i.m), 'x': w.best.x || i.added}}) AS best
  FROM walk w JOIN cnt c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = c.n JOIN ins i ON i.st = w.st WHERE i.mid IN (0, 3) GROUP BY w.conv_id)
SELECT c.conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated, illegal::BIGINT AS illegal, best.c AS cost, best.a AS audit,
  sha256(substr(best.x, 2)) AS repaired_sha256 FROM cnt c JOIN fin ON fin.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLES["op13_importance"] = f"""WITH wd AS (SELECT 0 AS kind, row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
  UNION ALL SELECT 1, 0, NULL, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') FROM benchmark),
ft AS (SELECT kind, row, word, count(*) AS n FROM (SELECT kind, row, unnest(words) AS word FROM wd) t GROUP BY ALL),
bk AS (SELECT word, {crc32_sql("word")} % 10000 AS b FROM (SELECT DISTINCT word FROM ft) t),
cn AS (SELECT b, sum(CASE WHEN kind = 0 THEN n ELSE 0 END)::DOUBLE AS s, sum(CASE WHEN kind = 1 THEN n ELSE 0 END)::DOUBLE AS t FROM ft JOIN bk USING (word) GROUP BY b),
tt AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM cn),
gn AS (SELECT b, floor(1000 * ln((cn.t + 1) * (tt.s + 10000) / ((cn.s + 1) * (tt.t + 10000))))::BIGINT AS g FROM cn, tt),
wt AS (SELECT row, sum(n * g)::BIGINT AS weight FROM ft JOIN bk USING (word) JOIN gn USING (b) WHERE kind = 0 GROUP BY row),
sc AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM wd LEFT JOIN wt USING (row) WHERE kind = 0),
rk AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) END AS place, 10 * count_if(n_features >= 20) OVER () // 100 AS draw FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= draw THEN place END AS rank FROM rk"""
