"""Frame gate on an arriving stream: exposure, blur, then difference to the last kept frame."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.frames import EXPOSURE, exposure_ok
from ..operators.pixels import _array, channels_of, frame_distance


class _LastKept(StatefulProcessor):
    """State per scene: the last kept frame and the highest index seen; earlier indexes are dropped as late."""

    def __init__(self, min_diff: float, idle_ms: int | None):
        self.min_diff, self.idle_ms = min_diff, idle_ms

    def init(self, handle) -> None:
        self.kept = handle.getValueState("kept", "pixels binary, width int, height int, channels int", self.idle_ms)
        self.seen = handle.getValueState("seen", "raw_index bigint", self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = _array(*self.kept.get()) if self.kept.exists() else None
        high = self.seen.get()[0] if self.seen.exists() else -1
        out = []
        arrived = pd.concat(list(rows)).sort_values("raw_index")
        for index, *shot in zip(arrived["raw_index"], arrived["pixels"], arrived["width"], arrived["height"], arrived["channels"]):
            if index <= high:
                continue
            high = int(index)
            image = _array(*shot)
            diff = None if last is None else frame_distance(last, image)
            keep = diff is None or diff >= self.min_diff
            out.append((key[0], high, keep, diff))
            if keep:
                last = image
        if last is not None:  # written again although unchanged, which starts its time anew
            self.kept.update((last.astype("uint8").tobytes(), last.shape[1], last.shape[0], last.shape[2] if last.ndim > 2 else 1))
        self.seen.update((high,))
        yield pd.DataFrame(out, columns=["scene_id", "raw_index", "kept", "frame_diff"])

    def close(self) -> None:
        pass


def stream_frame_gate(frames: DataFrame, min_sharpness: float, min_frame_diff: float, band: dict | None = None, idle_seconds: float | None = None) -> DataFrame:
    """Fate of every frame that passes the exposure and blur gates; frames carry the health metrics, `pixels`, width, height and, for colour, channels.

    On input that arrives in order the kept set is that of the batch gate. With `idle_seconds` the state of a scene that sends no
    frame for so long is dropped, and a later frame of it begins a new sequence; without, it stays. With it Spark goes on with
    empty batches, so an availableNow trigger does not end: run it continuously, or one batch at a time. Needs the RocksDB state store.
    The frames that one scene sends within one trigger are put in order in memory, so bound the trigger (`maxFilesPerTrigger`).
    """
    good = frames.filter(exposure_ok(**(band or EXPOSURE))).filter(F.col("sharpness") >= min_sharpness).select("scene_id", "raw_index", "pixels", "width", "height", channels_of(frames).alias("channels"))
    scene_type = dict(frames.dtypes)["scene_id"]
    return good.groupBy("scene_id").transformWithStateInPandas(
        _LastKept(min_frame_diff, None if idle_seconds is None else int(1000 * idle_seconds)), f"scene_id {scene_type}, raw_index bigint, kept boolean, frame_diff double", "Append",
        "None" if idle_seconds is None else "ProcessingTime")
