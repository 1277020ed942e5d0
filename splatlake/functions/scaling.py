"""Size checks that decide between the one-task and the spread-out form of an operator.

Every operator that could pile a whole scene into one task (a sort inside a
window, an exact percentile map) or ship a table to every executor (a broadcast)
asks here first.  Small inputs are told by the optimizer's own size estimate, so no
job runs; for others the groups are counted, and only the hot ones go the long way.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

ONE_TASK_BYTES = 64 << 20  # whole input below this: no group can be large
BROADCAST_BYTES = 16 << 20
PACKED = 16  # the estimate counts files as they are stored, which may be so many times smaller than their rows
ONE_TASK_ROWS = 2_000_000  # rows of one group above this: the group is spread out
SALTS = 32
_UNKNOWN = 1 << 60


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"spark.splatlake.{name}", str(default)))


def plan_bytes(df: DataFrame) -> int | None:
    """Optimizer estimate of the plan's output size, None when it has none."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # remote session: no plan handle
        return None
    return None if size >= _UNKNOWN else size


def makes_rows(df: DataFrame) -> bool:
    """Whether a step of the plan can make more rows than it reads, which the optimizer's estimate does not count."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except AttributeError:  # remote session: no plan handle
        return True
    return re.search(r"^[\s:|+-]*(Generate|Expand|MapIn\w+|FlatMap\w+|MapPartitions\w*) ", plan, re.M) is not None


def hot_groups(df: DataFrame, keys) -> DataFrame | None:
    """Keys of the groups too large for one task, None when every group fits.

    An input whose whole estimate is small has none, and no job runs.  Otherwise one
    pass counts rows per group (partial counts, so a hot group costs nothing extra).
    """
    size = plan_bytes(df)
    if size is not None and size <= _setting(df, "oneTaskBytes", ONE_TASK_BYTES):
        return None
    limit = _setting(df, "oneTaskRows", ONE_TASK_ROWS)
    hot = durable(df.groupBy(*keys).count().filter(F.col("count") > limit).drop("count"))
    return None if hot.isEmpty() else hot


@dataclass(frozen=True)
class Groups:
    """Keys of the groups too large for one task (None when every group fits) and whether there are others."""

    keys: tuple
    hot: DataFrame | None
    rest: bool


def groups_of(df: DataFrame, keys) -> Groups:
    """Like hot_groups, and tells from the same pass whether any group is not hot; rows that lack a key count as such."""
    keys = tuple(keys)
    size = plan_bytes(df)
    if size is not None and size <= _setting(df, "oneTaskBytes", ONE_TASK_BYTES):
        return Groups(keys, None, True)
    large = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys], F.col("count") > _setting(df, "oneTaskRows", ONE_TASK_ROWS))
    marks = durable(df.groupBy(*keys).count().select(F.when(large, F.struct(*keys)).alias("_hot")).distinct())  # all other groups are one row
    hot = marks.filter("_hot IS NOT NULL").select("_hot.*")
    if hot.isEmpty():
        return Groups(keys, None, True)
    return Groups(keys, hot, not marks.filter("_hot IS NULL").isEmpty())


def shared_path(spark) -> str:
    """A fresh path below the folder that the cluster names for checkpoints; executors must reach it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/splatlake/{uuid.uuid4().hex}"


@contextmanager
def setting(spark, name: str, value):
    """Set a configuration while eager steps run; the session's own comes back."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dropped_shuffles(spark):
    """Eager steps drop their shuffle files when they end, not when the driver happens to collect its garbage; the session's own setting comes back.

    Only for frames that run once: one that runs again would make its shuffles anew.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def durable(df: DataFrame, **options) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    Unlike an RDD checkpoint this computes the rows once, keeps them columnar and
    gives the reader exact file sizes.  `options` are the writer's.
    """
    path = shared_path(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(table: DataFrame, grown: bool = False) -> tuple[DataFrame, bool]:
    """The table and whether it may be broadcast; a doubtful one is written out, its rows counted.

    The optimizer's estimate is trusted where it lies far below the limit and no step of the plan makes rows, as an explode,
    which it takes to add none.  `grown` says that it is not to be trusted at all.  Files are compressed, so what is written counts as rows times row width.
    """
    limit = _setting(table, "broadcastBytes", BROADCAST_BYTES)
    size = None if grown or makes_rows(table) else plan_bytes(table)
    if size is not None and size * PACKED <= limit:
        return table, True
    table = durable(table)
    return table, rows_fit(table, table.count())


def rows_fit(table: DataFrame, rows: int) -> bool:
    """Whether so many rows of the table may be broadcast."""
    try:
        width = int(table._jdf.schema().defaultSize())
    except AttributeError:  # remote session: no plan handle
        return False
    return rows * width <= _setting(table, "broadcastBytes", BROADCAST_BYTES)


def attach(df: DataFrame, table: DataFrame, keys, how: str = "left", grown: bool = False, isolate: bool = True) -> DataFrame:
    """Equi-join a per-key table onto rows whose keys may be badly skewed (left, inner, semi and anti joins).

    A table that is small for certain is broadcast.  Otherwise rows per key are counted: the few keys too hot for one task
    meet their part of the table by a broadcast, all others by sorting, so every row moves once and nothing is copied.
    Only where a hot key's part of the table is itself large, this part is copied over SALTS slices of the key's rows.
    `isolate` is turned off where no key can be hot; the adaptive planner still splits a partition that turns out large.
    """
    keys = list(keys)
    table, small = small_side(table, grown)
    if small:
        return df.join(F.broadcast(table), keys, how)
    plain = lambda rows: rows.join(table.hint("merge"), keys, how)
    hot = hot_groups(df, keys) if isolate else None
    if hot is None:
        return plain(df)
    hot = F.broadcast(hot)  # at most one key for every oneTaskRows rows
    part, small = small_side(table.join(hot, keys, "left_semi"), grown=True)
    rows = df.join(hot, keys, "left_semi")
    if small:
        heated = rows.join(F.broadcast(part), keys, how)
    else:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)).cast("int")
        copies = part.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        heated = rows.withColumn("_salt", salt).join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
    return plain(df.join(hot, keys, "left_anti")).unionByName(heated)
