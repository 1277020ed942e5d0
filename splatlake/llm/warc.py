"""WARC archives of pages: writing, reading, and revisit records for payloads seen before.

Records are text, so Spark's own text writer makes the archives: one row per record, the
record separator as the line separator, gzip as the codec, and its commit protocol for
lost tasks.  The reader streams lines and follows Content-Length, so a payload may hold anything.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import durable, shared_path

LEAST = 1000  # payload bytes from which copies become revisits
DATE = "2024-01-01T00:00:00Z"
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 8 << 20
COLUMNS = "record_type string, record_id string, key string, uri string, digest string, payload_bytes long, refers_to string, refers_to_key string"


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; control characters would end the line, so they are percent-encoded."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(BREAK)), F.lit(""))


def write_records(records: DataFrame, path: str, date: str = DATE, per_file: int = 20_000) -> None:
    """Write records(record_type, record_id, key, uri, digest, payload, payload_bytes, refers_to, refers_to_key) as gzipped WARC/1.1 files.

    Responses carry an HTTP header and the payload (binary); revisits the HTTP header alone.
    """
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(BREAK * 2))
    revisit = F.col("record_type") == "revisit"
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit(f"WARC/1.1{BREAK}"), _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("uri")), _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), _header("WARC-Profile", F.when(revisit, PROFILE)),
        _header("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), "refers_to", F.lit(">")))), _header("X-Refers-To-Key", F.when(revisit, F.col("refers_to_key"))), _header("X-Record-Key", F.col("key")),
        _header("Content-Type", F.lit("application/http; msgtype=response")), _header("Content-Length", size.cast("string")), F.lit(BREAK))
    body = F.when(revisit, "").otherwise(F.col("payload").cast("string"))
    (records.select(F.concat(head, http, body).alias("record")).write.option("lineSep", BREAK * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def _records(lines):
    """(headers, block) of each record in a stream of lines that end in a line feed."""
    lines = iter(lines)
    for line in lines:
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = {}
        for line in lines:
            if line in (b"\r", b""):
                break
            name, _, value = line.rstrip(b"\r").partition(b":")
            head[name.decode().lower()] = value.strip().decode("utf-8", "surrogateescape")
        length = int(head["content-length"])
        parts, have = [], 0
        while have < length + 4:
            line = next(lines, None)
            if line is None:
                raise ValueError("an archive ends within a record")
            parts.append(line)
            have += len(line) + 1
        data = b"\n".join(parts) + b"\n"
        if len(data) != length + 4 or not data.endswith(b"\r\n\r\n"):
            raise ValueError(f"record {head.get('warc-record-id')} is longer than it says")
        yield head, data[:length]


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of gzipped archives below path; payload (binary) is null for revisits, and left out if not wanted.

    A digest other than the one a response's payload has, or a cut archive, is an error.
    """
    import hashlib

    schema = COLUMNS + (", payload binary" if payload else "")
    kinds = [pa.string()] * 5 + [pa.int64()] + [pa.string()] * 2 + [pa.binary()] * payload
    names = [c.split()[0] for c in schema.split(", ")]

    def row(head, block):
        http, _, body = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
        if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"record {head['warc-record-id']} does not have the payload it names")
        refers = head.get("warc-refers-to")
        return (kind, head["warc-record-id"].strip("<>"), head.get("x-record-key"), head.get("warc-target-uri"), digest, size, refers and refers.strip("<>"), head.get("x-refers-to-key"),
                *([body if kind == "response" else None] if payload else []))

    def run(batches):
        rows, held = [], 0
        for head, block in _records(line for b in batches for line in b.column(0).to_pylist()):
            rows.append(row(head, block))
            held += 400 + len(block)
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary")).mapInArrow(run, schema)


def pages_to_records(pages: DataFrame) -> DataFrame:
    """One response per row of pages(page_id, url, html); a null html is an empty payload, a null url has no target header."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return pages.select(F.lit("response").alias("record_type"), F.concat(F.lit("urn:uuid:"), F.expr("uuid()")).alias("record_id"), F.col("page_id").cast("string").alias("key"),
                        F.col("url").alias("uri"), F.sha1(payload).alias("digest"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.lit(None).cast("string").alias("refers_to"), F.lit(None).cast("string").alias("refers_to_key"))


def revisits(headers: DataFrame, least: int = LEAST, key_type: str = "long") -> DataFrame:
    """(record_id, refers_to, refers_to_key) of the records that repeat another's payload.

    Headers meet by digest and length.  The original is the record of the largest key (then record id);
    only payloads of two or more records are joined back, so unique ones move once.
    """
    same = headers.filter(F.col("payload_bytes") >= least).select("digest", "payload_bytes", "record_id", F.col("key").cast(key_type).alias("k"), "key")
    first = same.groupBy("digest", "payload_bytes").agg(F.max(F.struct("k", "record_id", "key")).alias("top"), F.count("*").alias("copies")).filter("copies > 1")
    back = same.join(first, ["digest", "payload_bytes"]).filter("record_id <> top.record_id")
    return back.select("record_id", F.col("top.record_id").alias("refers_to"), F.col("top.key").alias("refers_to_key"))


def deduplicate(spark: SparkSession, source: str, target: str, least: int = LEAST, key_type: str = "long") -> None:
    """Read the archives at source and write them to target with repeated payloads as revisit records and all headers anew."""
    again = durable(revisits(read_records(spark, source, payload=False), least, key_type))
    rows = read_records(spark, source).drop("refers_to", "refers_to_key", "record_type").join(again, "record_id", "left")
    write_records(rows.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")), target)


def archive(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write pages as archives, deduplicate them, and read the result back: one row per record.

    Repeated rows and rows of equal or null page_id are records of their own.
    """
    spark, raw, final = pages.sparkSession, shared_path(pages.sparkSession), shared_path(pages.sparkSession)
    write_records(pages_to_records(pages), raw)
    deduplicate(spark, raw, final, least, pages.schema["page_id"].dataType.simpleString())
    return read_records(spark, final)
