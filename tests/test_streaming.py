"""Streaming operators against their batch forms."""

import time

import numpy as np
import pandas as pd

from splatlake.operators import frames as G
from splatlake.streaming.frame_gate import stream_frame_gate
from splatlake.streaming.run import run_available
from splatlake.streaming.stall import stall_detect


def test_late_frames_are_dropped_and_order_gives_the_batch_result(spark, folder):
    rng = np.random.default_rng(8)
    n = 30
    pdf = pd.DataFrame({"scene_id": 1, "raw_index": range(n), "width": 3, "height": 2, "pixels": [rng.integers(0, 256, 6).tolist() for _ in range(n)],
                        "brightness": 120.0, "contrast": 30.0, "clipped_ratio": 0.0, "sharpness": 50.0})
    frames = spark.createDataFrame(pdf)
    batch = {r["raw_index"]: r["kept"] for r in G.near_dup_gate(frames, [(0, "strict", 10.0, 0.3)]).collect()}
    # three files in order, then one that comes too late
    for at, part in enumerate((pdf[:10], pdf[10:20], pdf[20:], pdf[5:7])):
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(f"{folder}/in{at}")
    stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in*")
    rows = run_available(stream_frame_gate(stream, 10.0, 0.3)).collect()
    assert len(rows) == n and {r["raw_index"]: r["kept"] for r in rows} == batch


def test_state_of_an_idle_scene_is_dropped(spark, folder):
    """A second run of the same stream, after the delay, takes a low index again; with a long delay it is late."""
    from splatlake.streaming.run import use_rocksdb

    use_rocksdb(spark)
    shot = lambda i: pd.DataFrame({"scene_id": 1, "raw_index": [i], "width": 2, "height": 1, "pixels": [[i, 255 - i]], "brightness": 120.0, "contrast": 30.0, "clipped_ratio": 0.0, "sharpness": 50.0})
    for name, idle, pause, want in (("short", 1.0, 2.5, [3, 9]), ("long", 600.0, 0.0, [9])):
        frames = spark.createDataFrame(shot(9)).coalesce(1)
        frames.write.mode("append").parquet(f"{folder}/{name}")
        stream = spark.readStream.schema(frames.schema).parquet(f"{folder}/{name}")

        def run():
            (stream_frame_gate(stream, 10.0, 0.0, idle_seconds=idle).writeStream.format("parquet").outputMode("append").trigger(once=True)
             .option("checkpointLocation", f"{folder}/{name}-progress").start(f"{folder}/{name}-out").awaitTermination())

        run()
        time.sleep(pause)
        spark.createDataFrame(shot(3)).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        run()
        assert sorted(r.raw_index for r in spark.read.parquet(f"{folder}/{name}-out").collect()) == want


def test_stall_detect_open_end_and_disabled(spark):
    ts = pd.to_datetime(["2024-01-01 00:00:10", "2024-01-01 00:00:20", "2024-01-01 00:05:00"])
    events = spark.createDataFrame(pd.DataFrame({"job_id": [1, 1, 1], "event_id": [1, 2, 3], "ts": ts}))
    rows = stall_detect(events, 60, as_of=pd.Timestamp("2024-01-01 00:10:00").to_pydatetime()).collect()
    assert sorted((r["kind"], r["until"] is None) for r in rows) == [("progress", False), ("progress", True)]
    assert stall_detect(events, 0).count() == 0
    starts = spark.createDataFrame(pd.DataFrame({"job_id": [1], "start_ts": pd.to_datetime(["2023-12-31 23:00:00"])}))
    assert [r["kind"] for r in stall_detect(events, 0, 60, starts).collect()] == ["load"]
