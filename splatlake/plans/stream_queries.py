"""Streaming operators in batch and streaming form, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..functions.scaling import shared_path
from ..operators import pixels as P
from ..streaming.frame_gate import stream_frame_gate
from ..streaming.run import run_available
from ..streaming.stall import stall_detect, stream_stalls
from . import fixtures as X
from .fixtures import oracle
from .frame_queries import CHAIN, PIX
from .registry import query

HALF_DAY = 43200
GAPS = """gap AS (SELECT job_id, lag(ts) OVER (PARTITION BY job_id ORDER BY ts, event_id) AS since, ts AS until FROM progress)"""


@query("stall_detect", oracle(f"""SELECT job_id, kind, since, until, round(s, 6) AS seconds FROM (SELECT job_id, 'progress' AS kind, since, until, (epoch_us(until) - epoch_us(since)) / 1e6 AS s FROM gap WHERE since IS NOT NULL
    UNION ALL SELECT job_id, 'load', start_ts, first, (epoch_us(first) - epoch_us(start_ts)) / 1e6 FROM (SELECT job_id, min(ts) AS first, TIMESTAMP '2024-01-01 00:00:00' AS start_ts FROM progress GROUP BY job_id) f) t WHERE s > {HALF_DAY}""", GAPS, views="progress"))
def _(spark, d):
    events = X.progress(spark, d)
    starts = events.select("job_id").distinct().withColumn("start_ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = stall_detect(events, HALF_DAY, HALF_DAY, starts)
    return rows.withColumn("seconds", r6("seconds"))


@query("stream_stalls", oracle(f"""SELECT job_id, since FROM gap WHERE since IS NOT NULL AND epoch_us(until) - epoch_us(since) > {HALF_DAY}000000
    UNION ALL SELECT job_id, last FROM (SELECT job_id, max(ts) AS last FROM progress GROUP BY job_id) t WHERE epoch_us(last) + {HALF_DAY}000000 < (SELECT max(epoch_us(ts)) FROM progress)""", GAPS, views="progress"))
def _(spark, d):
    """Silences between events, and jobs still silent when the stream's watermark ends."""
    events = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/events*.parquet")
    rows = events.select(F.col("user_id").alias("job_id"), "ts")
    found = run_available(stream_stalls(rows, HALF_DAY))
    return found.withColumn("since", F.col("since").cast("timestamp_ntz"))


@query("stream_frame_gate", oracle("SELECT scene_id, CAST(raw_index AS BIGINT) AS raw_index, kept, round(frame_diff, 6) AS frame_diff FROM chn", PIX,
                                   "lad(pass_no, pass, ms, md) AS (VALUES (0, 'strict', 5200.0::DOUBLE, 0.1205::DOUBLE))", CHAIN, views="frames8"))
def _(spark, d):
    """Frames arrive as files in sequence order, a few per trigger."""
    path = shared_path(spark)
    frames = P.frame_health(X.frames8(spark, d))
    frames.withColumn("slice", F.floor(F.col("raw_index") / 20)).repartitionByRange(4, "slice").drop("slice").sortWithinPartitions("raw_index").write.parquet(path)
    stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 8).parquet(path)
    rows = run_available(stream_frame_gate(stream, 5200.0, 0.1205))
    return rows.select("scene_id", "raw_index", "kept", r6("frame_diff").alias("frame_diff"))
