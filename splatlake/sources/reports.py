"""JSON reports, file listings and aligned-scene tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Gates of a benchmark list that does not name its own.
GATES = dict(mobile_sog_mb=12.0, min_points=120_000, min_score=85)

EXTRACTION = ("raw_count bigint, selected_count bigint, min_frames bigint, min_span double, selected_pass string, relaxed boolean, projection string, "
              "passes array<struct<name:string,selected_raw_index_coverage:double,temporal_thinned_count:bigint>>")
SR_MANIFEST = ("requested_mode string, effective_mode string, sr_model string, scale int, effective_scale array<double>, status string, error string, "
               "output_size array<bigint>, model_preflight struct<ok:boolean,needs_download:boolean,weights_exist:boolean>")
SR_STRATEGY = "mode string, model string, scale int, reason string, sr_risk_flags array<string>"
COLMAP = ("ok boolean, camera_model string, selected_camera_model string, registered_images bigint, image_count bigint, registered_ratio double, points3d bigint, "
          "meets_quality_target boolean")
TRAINING = "best_psnr double, last_loss double, elapsed_sec double, gaussians_final bigint"
INPUT_QUALITY = "verdict struct<score:bigint,problems:array<string>>"


def read_reports(spark: SparkSession, root: str, file_name: str, schema: str, key: str = "run_id", depth: int = 1) -> DataFrame:
    """One row per report file; text that is no JSON reads as a row of NULLs, a missing file as no row.

    The key is the folder `depth` levels above the file. The schema is always given, never inferred.
    """
    wanted = T.StructType.fromDDL(schema)
    rows = (spark.read.schema(wanted).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
            .option("pathGlobFilter", file_name).json(root))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 - depth)
    return rows.select(F.url_decode(folder).alias(key), *wanted.names)


def write_reports(df: DataFrame, path: str, key: str = "scene_id") -> None:
    """One folder per key with its report as JSON text."""
    body = F.to_json(F.struct(*[c for c in df.columns if c != key]), {"pretty": "true", "ignoreNullFields": "false"})
    df.select(F.col(key), body.alias("value")).write.partitionBy(key).option("lineSep", "\n").text(path)


def read_scene_list(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark scenes with their gates; missing gates take the defaults, a missing name the output's last part."""
    schema = ("scenes array<struct<name:string,output:string,notes:string>>, gates struct<mobile_sog_mb:double,min_points:bigint,min_score:bigint>")
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("scenes").alias("s"), "gates")
    base = F.regexp_extract("s.output", r"([^/]+)/*$", 1)
    return rows.select(F.coalesce("s.name", base).alias("name"), F.col("s.output").alias("output"), F.coalesce("s.notes", F.lit("")).alias("notes"),
                       *[F.coalesce(f"gates.{g}", F.lit(v)).alias(g) for g, v in GATES.items()])


def list_files(spark: SparkSession, root: str, key: str = "delivery") -> DataFrame:
    """Name, size and time of every file below each folder of `root`; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    inside = F.substr("path", F.instr("path", root.rstrip("/").split("://")[-1]) + F.lit(len(root.rstrip("/").split("://")[-1]) + 1))
    rows = files.withColumn("_in", inside)
    return rows.select(F.regexp_extract("_in", r"^([^/]+)/", 1).alias(key), F.regexp_replace("_in", r"^[^/]+/", "").alias("path"),
                       F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).withColumn("name", F.col("path"))


def write_scene_data(views: DataFrame, points: DataFrame, scales: DataFrame, path: str) -> None:
    """Aligned scenes as three Parquet tables; views and points are laid out by scene."""
    for name, rows in (("views", views), ("points3d", points)):
        rows.write.mode("overwrite").partitionBy("scene_id").parquet(f"{path}/{name}")
    scales.write.mode("overwrite").parquet(f"{path}/scales")


def read_scene_data(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{path}/{n}") for n in ("views", "points3d", "scales"))
