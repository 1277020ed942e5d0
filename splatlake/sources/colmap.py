"""Binary sparse-model files as tables; a large file is read by several tasks.

Records have variable length.  A first pass walks a large file once, in constant memory, and cuts it into
byte ranges at record starts; small files are one range.  The tasks of the second pass read a range each, find its record
starts, and take all fields of all records out of the bytes at once as Arrow columns and lists.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.scaling import durable
from ..operators.sfm import PARAM_COUNTS

RANGE_BYTES = 32 << 20  # a range is cut after the record that reaches this size
BLOCK_BYTES = 8 << 20  # read at once while a file is walked
ROWS = 20_000  # records of one batch
TASKS = 10_000  # tasks of one pass at most
CAMERAS = "scene_id string, camera_id bigint, model_id int, width bigint, height bigint, params array<double>"
IMAGES = ("scene_id string, image_id bigint, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id bigint, "
          "name string, points2d array<struct<x:double,y:double,point3d_id:bigint>>")
POINTS = ("scene_id string, point_id bigint, x double, y double, z double, red smallint, green smallint, blue smallint, error double, "
          "track array<struct<image_id:int,point2d_idx:int>>")


@dataclass(frozen=True)
class Shape:
    """The fixed start of a record, whether a NUL-ended name follows, and the items at its end."""

    head: tuple
    named: bool
    item: tuple
    model: str | None = None  # field that tells the number of items, where no count stands before them

    @property
    def size(self) -> int:
        return np.dtype(list(self.head)).itemsize

    @property
    def width(self) -> int:
        return np.dtype(list(self.item)).itemsize


POSE = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")
CAMERA_SHAPE = Shape((("camera_id", "<u4"), ("model_id", "<i4"), ("width", "<i8"), ("height", "<i8")), False, (("params", "<f8"),), "model_id")
IMAGE_SHAPE = Shape((("image_id", "<u4"), *[(n, "<f8") for n in POSE], ("camera_id", "<u4")), True, (("x", "<f8"), ("y", "<f8"), ("point3d_id", "<i8")))
POINT_SHAPE = Shape((("point_id", "<u8"), ("x", "<f8"), ("y", "<f8"), ("z", "<f8"), ("red", "u1"), ("green", "u1"), ("blue", "u1"), ("error", "<f8")), False,
                    (("image_id", "<i4"), ("point2d_idx", "<i4")))


def _step(data, at: int, shape: Shape) -> tuple[int, int, int] | None:
    """(end of the name, items, end) of the record at `at`, None where the bytes do not reach its end."""
    name_end = at + shape.size
    if name_end > len(data):
        return None
    if shape.named:
        name_end = data.find(b"\0", name_end)
        if name_end < 0:
            return None
    start = name_end + shape.named
    if shape.model:
        items = PARAM_COUNTS[int.from_bytes(data[at + 4 : at + 8], "little", signed=True)]
    else:
        if start + 8 > len(data):
            return None
        items = int.from_bytes(data[start : start + 8], "little")
        start += 8
    end = start + items * shape.width
    return (name_end, items, end) if end <= len(data) else None


def _reach(data, at: int, shape: Shape) -> int | None:
    """End of the record at `at` from its count alone, even where its items lie beyond the bytes."""
    start = at + shape.size
    if shape.named:
        start = data.find(b"\0", start) + 1 if start <= len(data) else 0
        if start == 0:
            return None
    if start + 8 > len(data):
        return None
    return start + 8 + int.from_bytes(data[start : start + 8], "little") * shape.width


def _cut(stream, shape: Shape, limit: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, records) of the ranges of one file, walked block by block; items are stepped over unread."""
    first, size = stream.read(8), stream.size()
    if len(first) < 8:
        raise EOFError("file ended inside a record")
    left = int.from_bytes(first, "little")
    at, start, records = 8, 8, 0
    data, base = b"", 8
    while left:
        end = _reach(data, at - base, shape) if at - base <= len(data) else None
        if end is None:  # the record's own start is not here yet
            base = at
            stream.seek(at)
            data = stream.read(BLOCK_BYTES)
            while (end := _reach(data, 0, shape)) is None:  # a name longer than a block, or the end of the file
                more = stream.read(BLOCK_BYTES)
                if not more:
                    raise EOFError("file ended inside a record")
                data += more
        at, left, records = base + end, left - 1, records + 1
        if at > size:
            raise EOFError("file ended inside a record")
        if at - start >= limit or not left:
            yield start, at, records
            start, records = at, 0


def _decode(data: bytes, records: int, shape: Shape) -> Iterator[dict]:
    """Columns of the records that follow each other in `data`, ROWS at a time: fields by name, `name`, and `items` as (offsets, fields)."""
    at = 0
    flat = np.frombuffer(data, np.uint8)
    head, item = np.dtype(list(shape.head)), np.dtype(list(shape.item))
    while records:
        n = min(ROWS, records)
        starts, ends, counts = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        tails = np.empty(n, np.int64)
        for k in range(n):
            found = _step(data, at, shape)
            if found is None:
                raise EOFError("file ended inside a record")
            starts[k], (ends[k], counts[k], at) = at, found
            tails[k] = at - counts[k] * item.itemsize
        rows = flat[starts[:, None] + np.arange(head.itemsize)].reshape(-1).view(head)
        out = {f: rows[f] for f in head.names}
        if shape.named:
            out["name"] = [data[s + head.itemsize : e].decode("utf-8") for s, e in zip(starts.tolist(), ends.tolist())]
        offsets = np.concatenate([[0], counts.cumsum()])
        spot = np.repeat(tails - offsets[:-1] * item.itemsize, counts) + np.arange(offsets[-1]) * item.itemsize
        out["items"] = offsets, flat[spot[:, None] + np.arange(item.itemsize)].reshape(-1).view(item)
        yield out
        records -= n


def _read(spark: SparkSession, root: str, file_name: str, schema: str, shape: Shape, items: str, range_bytes: int | None = None) -> DataFrame:
    limit = RANGE_BYTES if range_bytes is None else range_bytes
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", file_name).load(root)
             .select("path", "length"))  # contents are not read here

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, length in zip(pdf["path"], pdf["length"]):
                rows = [(8, length, -1)]
                if length > limit and not shape.model:
                    system, inner = fs.FileSystem.from_uri(path)
                    with system.open_input_file(inner) as stream:
                        rows = list(_cut(stream, shape, limit))
                yield pd.DataFrame([(path, *r) for r in rows], columns=["path", "start", "end", "records"])

    wanted = StructType.fromDDL(schema)
    kinds = to_arrow_schema(wanted)

    def parse(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end, records in zip(*[c.to_pylist() for c in batch.columns]):
                system, inner = fs.FileSystem.from_uri(path)
                scene = re.sub(r"/sparse(/\d+)?$", "", inner.rsplit("/", 1)[0]).rsplit("/", 1)[-1]
                with system.open_input_file(inner) as stream:
                    if records < 0:
                        first = stream.read(8)
                        if len(first) < 8:
                            raise EOFError("file ended inside a record")
                        records = int.from_bytes(first, "little")
                    stream.seek(start)
                    data = stream.read(end - start)
                for columns in _decode(data, records, shape):
                    offsets, found = columns.pop("items")
                    columns["scene_id"] = [scene] * len(offsets[:-1])
                    arrays = []
                    for field in kinds:
                        if field.name == items:
                            inside = field.type.value_type
                            values = (pa.StructArray.from_arrays([pa.array(found[f.name]).cast(f.type) for f in inside], fields=list(inside)) if pa.types.is_struct(inside)
                                      else pa.array(found[found.dtype.names[0]]).cast(inside))
                            arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=field.type))
                        else:
                            values = columns[field.name]
                            arrays.append(pa.array(values.view(np.int64) if isinstance(values, np.ndarray) and values.dtype == np.uint64 else values).cast(field.type))
                    yield pa.RecordBatch.from_arrays(arrays, names=kinds.names)

    ranges = durable(_spread(files, "path").mapInPandas(index, "path string, start long, end long, records long"))
    return _spread(ranges, "path", "start").mapInArrow(parse, wanted)


def _spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows that each mean a file or a range to read, dealt to a task each: a given number of partitions, as the adaptive planner would join such few bytes."""
    return rows.repartition(max(1, min(rows.count(), TASKS)), *by)


def read_cameras(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "cameras.bin", CAMERAS, CAMERA_SHAPE, "params")


def read_images(spark: SparkSession, root: str, range_bytes: int | None = None) -> DataFrame:
    return _read(spark, root, "images.bin", IMAGES, IMAGE_SHAPE, "points2d", range_bytes)


def read_points(spark: SparkSession, root: str, range_bytes: int | None = None) -> DataFrame:
    return _read(spark, root, "points3D.bin", POINTS, POINT_SHAPE, "track", range_bytes)
