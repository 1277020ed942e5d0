"""Fixed-width splat files (`.ply`, `.splat`) as Spark data sources.

Record files split like text files: a task takes a byte range, reads the short
header itself, and turns the records that start inside its range into Arrow batches, of the columns asked for only.
`read_ply` surveys the headers in a job; the driver lists files and sees the distinct layouts.

    read_ply(spark, folder, columns=["x", "y", "z"]); ply_counts(spark, folder)

Option `scenes` (a JSON list of scene ids) leaves the files of other scenes unopened.  It is an option because a filter pushed into a
Python source stays with the frame in Spark 4.1, so that a later query on it would lose rows.

Both formats add `scene_id` (file stem, or the folder of a written scene), `part`
(file name; parts of a scene follow each other in name order) and `ordinal`
(position of the record in its file).
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SPLIT_BYTES = 64 << 20
BATCH_ROWS = 65536
PART_BYTES = 64 << 20  # records that a writing task holds
RENAMES_AT_ONCE = 64
HEADERS_PER_TASK = 64

# Property types of the vertex element, with their little-endian layout.
PLY_TYPES = {"char": "i1", "uchar": "u1", "short": "<i2", "ushort": "<u2", "int": "<i4", "uint": "<u4", "float": "<f4", "double": "<f8"}
# The 32-byte splat record.
SPLAT_FIELDS = (("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("sx", "<f4"), ("sy", "<f4"), ("sz", "<f4"),
                ("red", "u1"), ("green", "u1"), ("blue", "u1"), ("alpha", "u1"), ("rot_u8_0", "u1"), ("rot_u8_1", "u1"), ("rot_u8_2", "u1"), ("rot_u8_3", "u1"))

# Spark has no unsigned types, so those widen.
_SPARK = {"i1": T.ByteType(), "u1": T.ShortType(), "i2": T.ShortType(), "u2": T.IntegerType(), "i4": T.IntegerType(), "u4": T.LongType(),
          "f4": T.FloatType(), "f8": T.DoubleType()}
_ARROW = {"i1": pa.int8(), "u1": pa.int16(), "i2": pa.int16(), "u2": pa.int32(), "i4": pa.int32(), "u4": pa.int64(), "f4": pa.float32(), "f8": pa.float64()}
_NUMPY = {"i1": np.int8, "u1": np.int16, "i2": np.int16, "u2": np.int32, "i4": np.int32, "u4": np.int64, "f4": np.float32, "f8": np.float64}
_WRITE = {T.ByteType(): "char", T.ShortType(): "short", T.IntegerType(): "int", T.FloatType(): "float", T.DoubleType(): "double"}


class HeaderError(ValueError):
    """The file is no PLY file of this kind."""


def parse_header(stream, name: str) -> tuple[np.dtype, int, int]:
    """Record layout, record count and start of the first record of an open PLY file."""
    elements, pending, used = [], b"", 0  # [name, count, fields or None where a list makes the width vary]
    while True:
        end = pending.find(b"\n")
        if end < 0:
            block = stream.read(4096)
            if not block:
                raise HeaderError(f"{name}: no end_header before the end of the file")
            pending += block
            continue
        words, pending = pending[:end].decode("ascii", "replace").split(), pending[end + 1:]
        used += end + 1
        if not words:
            continue
        if words[0] == "end_header":
            break
        if words[0] == "format" and words[1:2] != ["binary_little_endian"]:
            raise HeaderError(f"{name}: only binary little-endian files can be read, not {' '.join(words[1:])}")
        if words[0] == "element" and len(words) >= 3:
            elements.append([words[1], int(words[2]), []])
        elif words[0] == "property" and elements:
            if len(words) == 3 and words[1] in PLY_TYPES and elements[-1][2] is not None:
                elements[-1][2].append((words[2], PLY_TYPES[words[1]]))
            elif elements[-1][0] == "vertex":
                raise HeaderError(f"{name}: a vertex cannot have the property {' '.join(words[1:])}")
            else:
                elements[-1][2] = None
    for element, count, fields in elements:
        if element == "vertex":
            return np.dtype(fields), count, used
        if fields is None and count:
            raise HeaderError(f"{name}: lists of element {element} stand before the vertices")
        used += count * np.dtype(fields or []).itemsize  # other elements of fixed width are stepped over
    raise HeaderError(f"{name}: no element vertex")


def _files(path: str, ending: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return system, [info]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    below = system.get_file_info(fs.FileSelector(root, recursive=True))
    keep = [f for f in below if f.type == fs.FileType.File and f.path.lower().endswith(ending) and not posixpath.basename(f.path).startswith(("_", "."))]
    return system, sorted(keep, key=lambda f: f.path)


def _scene_of(path: str) -> str:
    folder = re.search(r"scene_id=([^/]+)/[^/]*$", path)
    return folder.group(1) if folder else posixpath.splitext(posixpath.basename(path))[0]


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _RecordReader(DataSourceReader):
    def __init__(self, root: str, schema: T.StructType, kind: str, split: int, cut: bool = False, scenes: set | None = None):
        self.root, self.schema, self.kind, self.split, self.cut, self.scenes = root, schema, kind, split, cut, scenes

    def partitions(self):
        _, files = _files(self.root, f".{self.kind}")
        return [ByteRange(f.path, at, min(at + self.split, f.size)) for f in files if self.scenes is None or _scene_of(f.path) in self.scenes
                for at in range(0, max(1, f.size), self.split)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), "")
        names = [f.name for f in self.schema.fields]
        with system.open_input_file(partition.path) as stream:
            if self.kind == "ply":
                layout, count, skip = parse_header(stream, partition.path)
            else:
                layout, skip = np.dtype(list(SPLAT_FIELDS)), 0
                count = stream.size() // layout.itemsize
            width = layout.itemsize
            there = (stream.size() - skip) // width
            if there < count and not self.cut:
                raise HeaderError(f"{partition.path} names {count} records and holds {there}; option truncated=true reads what is there")
            count = min(count, there)
            first = max(0, -(-(partition.start - skip) // width))
            last = min(count, max(0, -(-(partition.end - skip) // width)))
            scene = _scene_of(partition.path)
            for at in range(first, last, BATCH_ROWS):
                n = min(BATCH_ROWS, last - at)
                stream.seek(skip + at * width)
                rows = np.frombuffer(stream.read(n * width), dtype=layout)
                columns = []
                for name, field in zip(names, self.schema.fields):
                    if name == "scene_id":
                        columns.append(pa.array([scene] * n, pa.string()))
                    elif name == "part":
                        columns.append(pa.array([posixpath.basename(partition.path)] * n, pa.string()))
                    elif name == "ordinal":
                        columns.append(pa.array(np.arange(at, at + n, dtype=np.int64)))
                    elif name in layout.names:
                        code = {v.typeName(): k for k, v in _SPARK.items()}[field.dataType.typeName()]  # the table's type, which may be wider than the file's
                        columns.append(pa.array(rows[name].astype(_NUMPY[code]), _ARROW[code]))
                    else:
                        columns.append(pa.nulls(n, _ARROW[{v.typeName(): k for k, v in _SPARK.items()}[field.dataType.typeName()]]))
                yield pa.RecordBatch.from_arrays(columns, names=names)


@dataclass
class PartFiles(WriterCommitMessage):
    files: list

    def __init__(self, files: list):
        self.files = files


class _RecordWriter(DataSourceArrowWriter):
    """Every task writes part files of the scenes it holds; names follow the partition order, and the order within it.

    At most PART_BYTES of records wait in a task: beyond that the scene with most of them becomes a part, so memory does not grow with the
    partition. Parts are written under an attempt's own hidden name and renamed on commit, many at a time, so a
    retried or speculative task leaves nothing behind that a reader would pick up.
    """

    def __init__(self, root: str, schema: T.StructType, kind: str, part_bytes: int = PART_BYTES):
        self.root, self.kind, self.job, self.part_bytes = root, kind, uuid.uuid4().hex[:12], part_bytes
        self.columns = [f for f in schema.fields if f.name not in ("scene_id", "part", "ordinal")]
        self.has_scene = "scene_id" in schema.names
        if kind == "ply":
            self.lines, layout = [], []
            for f in self.columns:
                if f.dataType not in _WRITE:
                    raise ValueError(f"column {f.name}: PLY has no type for {f.dataType.simpleString()}")
                self.lines.append(f"property {_WRITE[f.dataType]} {f.name}")
                layout.append((f.name, PLY_TYPES[_WRITE[f.dataType]]))
            self.layout = layout
        else:
            missing = [n for n, _ in SPLAT_FIELDS if n not in schema.names]
            if missing:
                raise ValueError(f"splat records need {missing}")
            self.layout = list(SPLAT_FIELDS)

    def _system(self):
        return fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), self.root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartFiles:
        from pyspark import TaskContext
        context = TaskContext.get()
        system, root = self._system()
        layout = np.dtype(self.layout)
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        numbers: dict[str, int] = {}
        written, held = [], 0

        def flush(scene: str) -> int:
            blocks, size = waiting.pop(scene), sizes.pop(scene)
            folder = posixpath.join(root, f"scene_id={scene}") if self.has_scene else root
            system.create_dir(folder, recursive=True)
            count, number = size // layout.itemsize, numbers.get(scene, 0)
            numbers[scene] = number + 1
            final = posixpath.join(folder, f"part-{context.partitionId():05d}" + (f"_{number:06d}" if number else "") + f".{self.kind}")
            temp = posixpath.join(folder, f"_{self.job}-{context.partitionId()}-{context.attemptNumber()}-{uuid.uuid4().hex[:6]}")
            with system.open_output_stream(temp) as out:
                if self.kind == "ply":
                    out.write(("\n".join(["ply", "format binary_little_endian 1.0", f"element vertex {count}", *self.lines, "end_header"]) + "\n").encode("ascii"))
                for block in blocks:
                    out.write(block)
            written.append((temp, final, scene, count))
            return size

        for batch in iterator:
            table = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            scenes = np.array(table["scene_id"].cast(pa.string()).to_pylist(), dtype=object) if self.has_scene else np.array([""] * batch.num_rows, dtype=object)
            records = np.empty(batch.num_rows, dtype=layout)
            for n, code in self.layout:
                records[n] = table[n].to_numpy(zero_copy_only=False)
            for scene in dict.fromkeys(scenes):
                block = records[scenes == scene].tobytes()
                waiting.setdefault(scene, []).append(block)
                sizes[scene] = sizes.get(scene, 0) + len(block)
                held += len(block)
            while held > self.part_bytes:
                held -= flush(max(sizes, key=sizes.get))
        for scene in list(waiting):
            flush(scene)
        return PartFiles(written)

    def commit(self, messages) -> None:
        system, root = self._system()
        system.create_dir(root, recursive=True)
        parts = [p for m in messages if m is not None for p in m.files]
        with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
            list(pool.map(lambda p: system.move(p[0], p[1]), parts))
        listing = [{"path": final, "scene_id": scene, "count": count} for _, final, scene, count in parts]
        with system.open_output_stream(posixpath.join(root, "_parts.json")) as out:
            out.write(json.dumps(listing).encode("utf-8"))

    def abort(self, messages) -> None:
        system, _ = self._system()
        for m in messages:
            for temp, _, _, _ in (m.files if m is not None else []):
                if system.get_file_info(temp).type == fs.FileType.File:
                    system.delete_file(temp)


class _RecordSource(DataSource):
    kind = ""

    def schema(self) -> T.StructType:
        layout = self._layout()
        return T.StructType([T.StructField("scene_id", T.StringType()), T.StructField("part", T.StringType()), T.StructField("ordinal", T.LongType()),
                             *[T.StructField(n, _SPARK[layout[n].str[1:]]) for n in layout.names]])

    def _root(self) -> str:
        if not self.options.get("path"):
            raise ValueError("a path is needed")
        return self.options["path"]

    def reader(self, schema: T.StructType):
        return _RecordReader(self._root(), schema, self.kind, int(self.options.get("splitBytes", SPLIT_BYTES)), self.options.get("truncated", "false").lower() == "true",
                             set(json.loads(self.options["scenes"])) if self.options.get("scenes") else None)

    def writer(self, schema: T.StructType, overwrite: bool):
        return _RecordWriter(self._root(), schema, self.kind, int(self.options.get("partBytes", PART_BYTES)))


class PlySource(_RecordSource):
    kind = "ply"

    @classmethod
    def name(cls) -> str:
        return "ply"

    def _layout(self) -> np.dtype:
        system, files = _files(self._root(), ".ply")
        if not files:
            raise FileNotFoundError(f"no .ply file below {self._root()}")

        def header(file) -> np.dtype:
            with system.open_input_file(file.path) as stream:
                return parse_header(stream, file.path)[0]

        with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
            return common_layout(pool.map(header, files))


def common_layout(layouts) -> np.dtype:
    """All fields of the given layouts in order of appearance, each as wide as any file has it."""
    fields: dict[str, np.dtype] = {}
    for layout in layouts:
        for name in layout.names:
            wide = np.promote_types(fields.get(name, layout[name]), layout[name])
            fields[name] = wide if wide.str[1:] in _SPARK else np.dtype("<f8")
    return np.dtype(list(fields.items()))


class SplatSource(_RecordSource):
    kind = "splat"

    @classmethod
    def name(cls) -> str:
        return "splat"

    def _layout(self) -> np.dtype:
        return np.dtype(list(SPLAT_FIELDS))


def register(spark: SparkSession) -> None:
    for source in (PlySource, SplatSource):
        spark.dataSource.register(source)


def ply_headers(spark: SparkSession, path: str) -> DataFrame:
    """(origin, scene_id, part, vertices, fields) of every PLY file, from the headers alone, read by tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][lL][yY]").load(path).select("path")

    def read(batches):
        for pdf in batches:
            rows = []
            for origin in pdf["path"]:
                system, inner = fs.FileSystem.from_uri(origin)
                with system.open_input_file(inner) as stream:
                    layout, count, _ = parse_header(stream, inner)
                rows.append((origin, _scene_of(inner), posixpath.basename(inner), count, " ".join(f"{n}:{layout[n].str}" for n in layout.names)))
            yield pd.DataFrame(rows, columns=["origin", "scene_id", "part", "vertices", "fields"])

    # a header each is little work, so the scan's own tasks are shared out by the number of files
    return files.repartition(max(1, min(files.count() // HEADERS_PER_TASK + 1, 10_000))).mapInPandas(read, "origin string, scene_id string, part string, vertices long, fields string")


def ply_counts(spark: SparkSession, path: str) -> DataFrame:
    """Vertices of each scene as its files' headers name them; no record is read."""
    return ply_headers(spark, path).groupBy("scene_id").agg(F.sum("vertices").alias("point_count"), F.count("*").alias("parts"))


def read_ply(spark: SparkSession, path: str, columns=None, scenes=None) -> DataFrame:
    """PLY files as rows; with `columns` only these file columns, next to scene_id, part and ordinal, are built, with `scenes` only these scenes' files opened.

    Files may differ in their columns: a column is as wide as any file has it and null where a file lacks it.
    """
    register(spark)
    layouts = ply_headers(spark, path).groupBy("fields").agg(F.min("origin").alias("origin")).orderBy("origin").collect()  # distinct layouts only
    if not layouts:
        raise FileNotFoundError(f"no .ply file below {path}")
    layout = common_layout(np.dtype([tuple(f.rsplit(":", 1)) for f in r["fields"].split(" ")]) for r in layouts)
    names = layout.names if columns is None else list(columns)
    missing = [c for c in names if c not in layout.names]
    if missing:
        raise ValueError(f"no file below {path} has {missing}")
    schema = T.StructType([T.StructField("scene_id", T.StringType()), T.StructField("part", T.StringType()), T.StructField("ordinal", T.LongType()),
                           *[T.StructField(n, _SPARK[layout[n].str[1:]]) for n in names]])
    reader = spark.read.format("ply").schema(schema)
    return (reader if scenes is None else reader.option("scenes", json.dumps(list(scenes)))).load(path)


def read_splat(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("splat").load(path)


def as_splats(raw: DataFrame) -> DataFrame:
    """Rename file columns to the library's raw splat columns and add `point_id`; 32-bit floats become doubles."""
    names = {"opacity": "opacity_raw", **{f"scale_{i}": f"scale_raw_{i}" for i in range(3)}}
    wide = [F.col(f.name).cast("double") if isinstance(f.dataType, T.FloatType) else F.col(f.name) for f in raw.schema.fields]
    # file order is the order of these ids
    point_id = F.concat_ws(":", "part", F.format_string("%012d", "ordinal"))
    return raw.select(point_id.alias("point_id"), *[c.alias(names.get(n, n)) for c, n in zip(wide, raw.columns)])


def write_ply(df: DataFrame, path: str) -> None:
    """Any scalar columns as PLY part files, by scene when there is a scene_id.

    A partition becomes one part per scene, so `coalesce(1)` gives single files.
    """
    register(df.sparkSession)
    df.write.format("ply").mode("append").save(path)


def _layout62(rows: DataFrame, normal: float, opacity, scales, quats) -> DataFrame:
    have = set(rows.columns)
    rest = [F.coalesce(F.get(F.col("f_rest"), F.lit(i)), F.lit(0.0)) if "f_rest" in have else F.lit(0.0) for i in range(45)]
    dc = [F.col(f"f_dc_{i}") if "f_dc_0" in have else F.lit(0.5) for i in range(3)]
    named = [*[(a, F.col(a)) for a in "xyz"], ("nx", F.lit(normal)), ("ny", F.lit(0.0)), ("nz", F.lit(0.0)), *[(f"f_dc_{i}", c) for i, c in enumerate(dc)],
             *[(f"f_rest_{i}", c) for i, c in enumerate(rest)], ("opacity", opacity), *[(f"scale_{i}", c) for i, c in enumerate(scales)], *[(f"rot_{i}", c) for i, c in enumerate(quats)]]
    return rows.select("scene_id", *[c.cast("float").alias(n) for n, c in named])


def standard_columns(splats: DataFrame) -> DataFrame:
    """The 62 float columns with raw opacity logits and log scales; normals are zero."""
    return _layout62(splats, 0.0, F.col("opacity_raw"), [F.col(f"scale_raw_{i}") for i in range(3)], [F.col(f"rot_{i}") for i in range(4)])


def web_columns(decoded: DataFrame) -> DataFrame:
    """The 62 float columns with decoded opacity and scales; normals are (1, 0, 0)."""
    return _layout62(decoded, 1.0, F.col("opacity"), [F.col(c) for c in ("sx", "sy", "sz")], [F.col(f"rot_{i}") for i in range(4)])


def splat_records(splats: DataFrame, max_splats: int = 0, keys=("scene_id",), id_col: str = "point_id") -> DataFrame:
    """Quantised splat records with their back-to-front `depth` (already capped to the most opaque ones)."""
    from ..operators import encodings as E, splats as S
    rows = S.default_splat_fields(E.decode(splats, keys))
    if max_splats > 0:
        rows = S.top_opacity(rows, max_splats, keys, id_col).drop("opacity_rank")
    rows = S.depth_keys(rows, keys)
    if "r" not in rows.columns:
        rows = S.sh_to_rgb(rows)
    rows = S.quat_to_u8(S.rgba_to_u8(S.normalize_quat(rows)))
    bytes_ = {"red": "red_u8", "green": "green_u8", "blue": "blue_u8", "alpha": "alpha_u8"}
    return rows.select(*keys, id_col, "depth", *[F.col(c).cast("float").alias(c) for c in ("x", "y", "z", "sx", "sy", "sz")],
                       *[F.col(v).alias(k) for k, v in bytes_.items()], *[f"rot_u8_{i}" for i in range(4)])


def write_splat(splats: DataFrame, path: str, max_splats: int = 0, id_col: str = "point_id") -> None:
    """`.splat` part files per scene; read in name order, the parts run from far to near."""
    register(splats.sparkSession)
    order = [F.col("scene_id"), F.col("depth").desc(), F.col(id_col)]
    rows = splat_records(splats, max_splats, id_col=id_col).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select("scene_id", *[n for n, _ in SPLAT_FIELDS]).write.format("splat").mode("append").save(path)
