"""Run a stream over what is there and read its result back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scaling import shared_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """The state API of the stateful operators needs this state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def run_available(stream: DataFrame) -> DataFrame:
    """Process all input present, writing results and progress below the shared folder."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    path = shared_path(spark)
    query = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", f"{path}/progress").start(f"{path}/out"))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")
