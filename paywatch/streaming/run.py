"""Running a stream over what has arrived, into a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paywatch.session import scratch_path


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_to_table(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Process everything available; return the finished rows as a batch table."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def latest_to_table(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Like `append_to_table` for update mode: every batch's changed rows, each
    batch in its own folder, so that a repeated batch replaces itself."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.option("basePath", path).parquet(path)
