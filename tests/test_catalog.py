"""The registered queries: entry point, names, and a few against their twins."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["decode_opacity", "diagnose_emb", "voxel_components_26", "cluster_clean_report", "recommend_run", "action_items", "validate_delivery",
                                  "extract_page_assets", "choose_pass", "near_dup_gate", "build_views", "init_scale_knn", "read_ply", "stall_detect"])
def test_query_equals_twin(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def same_as_twin(spark, name, folder, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    df, result = entry.queries()[name](spark, str(folder)), con.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_stride_sample_ends_with_the_last_row(spark, tmp_path):
    """299 * (342 / 299) is a little less than 342 in doubles."""
    duckdb.sql(f"""COPY (SELECT i AS l_orderkey, 1 AS l_partkey, 8 AS l_suppkey, 1 AS l_linenumber, 1e0 AS l_quantity, 1e3 AS l_extendedprice, 0e0 AS l_discount, 0e0 AS l_tax
        FROM range(343) t(i)) TO '{tmp_path}/lineitem.parquet'""")
    same_as_twin(spark, "stride_sample", tmp_path, "lineitem")


def test_web_columns_are_single_precision(spark, tmp_path):
    duckdb.sql(f"""COPY (SELECT i AS vec_id, CAST(i % 8 AS INT) AS label, list_transform(range(16), lambda j: CAST((hash(i * 16 + j) % 1000003) / 1000003e0 - 0.5e0 AS FLOAT)) AS embedding
        FROM range(30000) t(i)) TO '{tmp_path}/embeddings.parquet'""")
    same_as_twin(spark, "write_ply_web", tmp_path, "embeddings")
