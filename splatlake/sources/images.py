"""Image folders as frame tables, through Spark's own image and binary-file sources."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.order_stats import ranked
from ..functions.scaling import attach, durable

# File name endings of the two image sets.
IMAGE_SUFFIXES = ("png", "jpg", "jpeg")
WIDE_SUFFIXES = IMAGE_SUFFIXES + ("bmp", "tif", "tiff")
FILES_AT_ONCE = 50_000  # frames picked and numbered by one branch of a decoding plan
RUNS_AT_ONCE = 2_000  # runs of files next to each other that one branch names


def suffix_is(path: str, suffixes) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*suffixes)


def list_images(spark: SparkSession, root: str, suffixes=IMAGE_SUFFIXES) -> DataFrame:
    """Path (also as an escaped `uri`), name and size of the image files below a folder; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return (files.select("path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime").filter(suffix_is("path", suffixes))
            .withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1)))


def _written(listing: DataFrame) -> DataFrame:
    """A listing, written once; a scan has a task for every 32 files or so, far too many for the few bytes that each would write."""
    return durable(listing.coalesce(4 * listing.sparkSession.sparkContext.defaultParallelism))


def _plain(c: Column) -> Column:
    return F.regexp_replace(c, "^file:/+", "file:/")


def list_frames(spark: SparkSession, root: str, suffixes=IMAGE_SUFFIXES, child: str = "images") -> DataFrame:
    """Image files as numbered frames: scene_id (folder below root), raw_index (by name), name, origin, uri, bytes; no file is opened.

    A folder that has a `child` folder with images is a scene made of those; its other folders
    (masks, for one) are none. Files are numbered before they are opened, so an unreadable one leaves a gap.
    """
    below = r"^.*?\Q" + re.sub("^file:/+", "/", root).rstrip("/") + r"\E/?"
    listed = list_images(spark, root, suffixes).select(_plain(F.col("path")).alias("origin"), "uri", "name", F.col("length").alias("bytes"))
    listed = listed.withColumn("_folder", F.regexp_replace(F.regexp_extract("origin", "^(.*)/[^/]+$", 1), below, ""))
    listed = listed.withColumn("_child", F.regexp_extract("_folder", "([^/]*)$", 1) == child)
    listed = _written(listed.withColumn("_above", F.regexp_replace("_folder", "/?[^/]*$", "")))  # read four times below
    scenes = listed.filter("_child").select(F.col("_above").alias("_scene")).distinct()
    other = listed.filter("NOT _child")
    other = other.join(scenes, other["_above"] == scenes["_scene"], "left_anti").join(scenes, F.col("_folder") == scenes["_scene"], "left_anti").withColumn("scene_id", F.col("_folder"))
    kept = listed.filter("_child").withColumn("scene_id", F.col("_above")).unionByName(other)
    own = F.regexp_extract(_plain(F.lit(root)), "([^/]+)/*$", 1)
    kept = kept.select(F.when(F.col("scene_id") == "", own).otherwise(F.col("scene_id")).alias("scene_id"), "name", "origin", "uri", "bytes")
    return ranked(kept, ["scene_id"], ["name", "origin"]).withColumn("raw_index", (F.col("ordinal") - 1).cast("int")).drop("ordinal")


def _runs(known: DataFrame, root: str, at_once: int) -> DataFrame:
    """Wanted files (`uri`) as runs of at most `at_once` that lie next to each other among all files below `root`: lo, hi, files."""
    files = known.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    placed = ranked(_written(files.select(F.lit(0).alias("_all"), F.col("_metadata.file_path").alias("uri"))), ["_all"], ["uri"], "_file")
    wanted = ranked(attach(placed, known.select("uri"), ["uri"], "left_semi", isolate=False), ["_all"], ["uri"], "_at")
    runs = wanted.groupBy(F.col("_file") - F.col("_at"), F.floor((F.col("_at") - 1) / at_once))
    return runs.agg(F.min("uri").alias("lo"), F.max("uri").alias("hi"), F.count("*").alias("files")).select("lo", "hi", "files")


def _batches(runs, at_once: int):
    """Group sorted runs: each batch has at most `at_once` files in at most RUNS_AT_ONCE runs, which its predicate must name."""
    batch, held = [], 0
    for r in runs:
        if batch and (held + r["files"] > at_once or len(batch) == RUNS_AT_ONCE):
            yield batch
            batch, held = [], 0
        batch.append(r)
        held += r["files"]
    if batch:
        yield batch


def _any(tests: list[Column]) -> Column:
    """Disjunction as a balanced tree, so that its depth stays small."""
    while len(tests) > 1:
        tests = [reduce(or_, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def decode_frames(frames: DataFrame, root: str, at_once: int = FILES_AT_ONCE) -> DataFrame:
    """Put width, height, channels and pixels (blue-green-red bytes) in place of the `uri` of listed frames; no other file below `root` is opened.

    Files are picked by their path before the scan, `at_once` in one branch of the plan, and the numbers come to the pixels by a broadcast of
    those few rows; so pixels are never shuffled, whatever the number of frames. Frames that cannot be decoded are left out.
    Files that follow each other are picked by the first and last path, single ones by name: every task carries what a branch
    names, so a whole folder costs its tasks two paths.  Only these pass through the driver's Python.
    """
    spark = frames.sparkSession
    image = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)
    decoded = image.select(F.col("_metadata.file_path").alias("uri"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("pixels"))
    columns = [c for c in frames.columns if c not in ("uri", "raw_index")] + ["width", "height", "channels", "pixels"] + ["raw_index"] * ("raw_index" in frames.columns)
    known = durable(frames.orderBy("uri"))
    branch = lambda picked, part: decoded.filter(picked).join(F.broadcast(part), "uri").select(*columns)
    branches = []
    for batch in _batches(_runs(known, root, at_once).orderBy("lo").toLocalIterator(), at_once):
        single = [r["lo"] for r in batch if r["files"] == 1]
        picked = _any([F.col("uri").between(r["lo"], r["hi"]) for r in batch if r["files"] > 1] + [F.col("uri").isin(single)] * bool(single))
        branches.append(branch(picked, known.filter(F.col("uri").between(batch[0]["lo"], batch[-1]["hi"]))))
    return reduce(DataFrame.unionByName, branches or [branch(F.lit(False), known)])


def read_frames(spark: SparkSession, root: str, suffixes=IMAGE_SUFFIXES, child: str = "images", max_frames: int | None = None) -> DataFrame:
    """Decoded frames: scene_id, name, origin, width, height, channels, pixels, raw_index, as `list_frames` numbers them.

    With `max_frames` only every ceil(n / max_frames)-th file of a scene is opened, and `frame_count` tells how many there are.
    """
    from ..operators.frames import frame_stride_sample

    listed = list_frames(spark, root, suffixes, child).drop("bytes")
    if max_frames is not None:
        listed = durable(listed)
        counts = listed.groupBy("scene_id").agg(F.count("*").alias("frame_count"))
        listed = attach(frame_stride_sample(listed, max_frames), counts, ["scene_id"])
    return decode_frames(listed, root)


def unreadable_count(listed: DataFrame, decoded: DataFrame, keys=("scene_id",), path: str = "path") -> DataFrame:
    """Listed and unreadable (listed but not decoded) files per scene."""
    seen = decoded.select(*keys, path).distinct().withColumn("_ok", F.lit(True))
    rows = listed.join(seen, [*keys, path], "left")
    return rows.groupBy(*keys).agg(F.count("*").alias("listed"), F.count_if(F.col("_ok").isNull()).alias("unreadable"))
