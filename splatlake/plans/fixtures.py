"""Named inputs over the benchmark tables, each in a Spark and a DuckDB spelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.order_stats import ranked

# DuckDB spellings, used as common table expressions by the oracle queries.
VIEWS = {
    "splats_emb": """SELECT CAST(label AS INT) AS scene_id, vec_id AS point_id,
       4*CAST(embedding[1] AS DOUBLE) AS x, 4*CAST(embedding[2] AS DOUBLE) AS y, 4*CAST(embedding[3] AS DOUBLE) AS z,
       8*CAST(embedding[4] AS DOUBLE) AS opacity_raw,
       2*CAST(embedding[5] AS DOUBLE)-3.5 AS scale_raw_0, 2*CAST(embedding[6] AS DOUBLE)-3.5 AS scale_raw_1,
       2*CAST(embedding[7] AS DOUBLE)-3.5 AS scale_raw_2,
       CAST(embedding[8] AS DOUBLE) AS rot_0, CAST(embedding[9] AS DOUBLE) AS rot_1,
       CAST(embedding[10] AS DOUBLE) AS rot_2, CAST(embedding[11] AS DOUBLE) AS rot_3,
       4*CAST(embedding[12] AS DOUBLE) AS f_dc_0, 4*CAST(embedding[13] AS DOUBLE) AS f_dc_1,
       4*CAST(embedding[14] AS DOUBLE) AS f_dc_2
       FROM embeddings""",
    "splats_li": """SELECT CAST(l_suppkey % 8 AS INT) AS scene_id,
       concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice*100) AS BIGINT)) AS point_id,
       (l_quantity-25.5)/25 AS x, (l_extendedprice-52950)/52050 AS y, (l_discount-0.05)*20 AS z,
       (l_tax-0.03)*100 AS opacity_raw,
       l_discount*10-4 AS scale_raw_0, l_tax*10-4 AS scale_raw_1, l_quantity/50-4.5 AS scale_raw_2
       FROM lineitem""",
    "frames8": """SELECT CAST(label AS INT) AS scene_id,
       CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id)-1 AS INT) AS raw_index, 8 AS width, 8 AS height,
       list_transform(embedding, lambda v: CAST(greatest(0, least(255, floor((CAST(v AS DOUBLE)+0.5)*255))) AS INT)) AS pixels
       FROM embeddings""",
    "frame_stats": """SELECT user_id AS scene_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)-1 AS INT) AS raw_index,
       value AS sharpness, 2.55e0*k AS brightness, CAST(k % 40 AS DOUBLE) AS contrast, (k % 97)/97.0e0 AS clipped_ratio
       FROM (SELECT *, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events) t""",
    "runs": """SELECT o_orderkey AS run_id, o_custkey AS sweep_id,
       CASE o_orderstatus WHEN 'F' THEN 'off' WHEN 'O' THEN 'resize' ELSE 'model' END AS effective_mode,
       CASE WHEN o_orderkey % 7 = 0 THEN 'model' WHEN o_orderstatus='F' THEN 'off' WHEN o_orderstatus='O' THEN 'resize'
            ELSE 'model' END AS requested_mode,
       CAST(floor(o_totalprice) AS BIGINT) % 120 AS selected_count,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 64 END AS target_frames,
       (CAST(floor(o_totalprice/10) AS BIGINT) % 101)/100.0e0 AS span,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (CAST(floor(o_totalprice/7) AS BIGINT) % 101)/100.0e0 END AS registered_ratio,
       CAST(floor(o_totalprice/3) AS BIGINT) % 101 AS score, CAST(floor(o_totalprice) AS BIGINT) AS point_count,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 20+(o_orderkey % 150)/10.0e0 END AS best_psnr,
       CAST(o_orderkey % 600 AS DOUBLE) AS train_sec, (CAST(floor(o_totalprice/3) AS BIGINT) % 101) >= 40 AS ok
       FROM orders""",
    "cameras_fx": """SELECT p_partkey AS camera_id, CAST(p_partkey % 7 AS INT) AS model_id, 640+16*p_size AS width,
       360+9*p_size AS height, p_retailprice AS f0, p_retailprice*(1+(p_partkey % 5)*0.25e0) AS f1,
       (640+16*p_size)*(0.40e0+(p_partkey % 9)*0.05e0) AS cx, (360+9*p_size)*0.5e0 AS cy
       FROM part""",
    "progress": "SELECT user_id AS job_id, event_id, ts FROM events",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def splats_emb(spark, sf_dir) -> DataFrame:
    e = lambda i: F.element_at("embedding", i).cast("double")
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("int").alias("scene_id"), F.col("vec_id").alias("point_id"),
        (4 * e(1)).alias("x"), (4 * e(2)).alias("y"), (4 * e(3)).alias("z"), (8 * e(4)).alias("opacity_raw"),
        *[(2 * e(5 + i) - 3.5).alias(f"scale_raw_{i}") for i in range(3)],
        *[e(8 + i).alias(f"rot_{i}") for i in range(4)],
        *[(4 * e(12 + i)).alias(f"f_dc_{i}") for i in range(3)])


def splats_li(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_suppkey % 8 AS INT) AS scene_id",
        "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice*100) AS BIGINT)) AS point_id",
        "(l_quantity-25.5)/25 AS x", "(l_extendedprice-52950)/52050 AS y", "(l_discount-0.05)*20 AS z",
        "(l_tax-0.03)*100 AS opacity_raw", "l_discount*10-4 AS scale_raw_0", "l_tax*10-4 AS scale_raw_1",
        "l_quantity/50-4.5 AS scale_raw_2")


def frames8(spark, sf_dir) -> DataFrame:
    pixel = lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((v.cast("double") + 0.5) * 255))).cast("int")
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("int").alias("scene_id"), "vec_id", F.transform("embedding", pixel).alias("pixels"))
    return ranked(rows, ["scene_id"], ["vec_id"]).select(
        "scene_id", (F.col("ordinal") - 1).cast("int").alias("raw_index"),
        F.lit(8).alias("width"), F.lit(8).alias("height"), "pixels")


def frame_stats(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("scene_id"), "ts", "event_id", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))
    return ranked(rows, ["scene_id"], ["ts", "event_id"]).select(
        "scene_id", (F.col("ordinal") - 1).cast("int").alias("raw_index"), F.col("value").alias("sharpness"),
        (F.lit(2.55) * F.col("k")).alias("brightness"), (F.col("k") % 40).cast("double").alias("contrast"),
        ((F.col("k") % 97) / 97.0).alias("clipped_ratio"))


def runs(spark, sf_dir) -> DataFrame:
    return spark.sql(f"{VIEWS['runs']}".replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


def cameras_fx(spark, sf_dir) -> DataFrame:
    return spark.sql(VIEWS["cameras_fx"].replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))


def progress(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), "event_id", "ts")


def oracle(select: str, *steps: str, views=()) -> str:
    """Assemble an oracle query: fixture views first, then the given CTE steps."""
    names = [views] if isinstance(views, str) else list(views)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + list(steps)
    return ("WITH RECURSIVE " + ",\n".join(ctes) + "\n" if ctes else "") + select
