"""Reading and writing the tables: CSV for exchange, Parquet for work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywatch.schema import FEATURES, IMPORTANCES, RAW, SCORED

# Seconds may carry a fraction when reading and always do when writing.
CSV_READ_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CSV_WRITE_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"

DAY = "txn_date"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    with_day: bool = False,
) -> DataFrame:
    """Read with a fixed schema, bound by name, in the schema's column order.

    Spark binds a CSV schema by position, so the header is read first and the
    schema put into its order. Columns the schema does not name are left out;
    ones it names and the file lacks are an error. So are files of one folder whose
    headers differ, and values that do not have their column's type.
    """
    found = spark.read.option("header", True).format(fmt).load(path)
    header = found.columns
    missing = [name for name in schema.fieldNames() if name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns: {missing}")
    if fmt != "csv":
        day = [DAY] if with_day and DAY in header else []
        return found.select(*[F.col(f.name).cast(f.dataType) for f in schema], *day)

    known = {field.name: field for field in schema}
    in_file = T.StructType(
        [known.get(name, T.StructField(name, T.StringType(), True)) for name in header]
    )
    df = (
        spark.read.option("header", True)
        .option("timestampNTZFormat", CSV_READ_TIME)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .schema(in_file)
        .csv(path)
    )
    # An empty text, quoted or not, is a missing value.
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema
        ]
    )


def read_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, RAW, fmt)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, FEATURES, fmt)


def read_scored(
    spark: SparkSession, path: str, fmt: str = "parquet", with_day: bool = False
) -> DataFrame:
    """`with_day` keeps the day folder's column, by which `of_days` prunes folders."""
    return read_table(spark, path, SCORED, fmt, with_day)


def read_importances(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, IMPORTANCES, fmt)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    by_day: bool = False,
    sort_by: str = "sender_vpa",
) -> None:
    """Write, replacing what is there.

    `by_day` lays the rows out in one folder per day, sorted inside each file so
    that Parquet's min/max can skip row groups for a sender. The rebalance hint
    keeps files of an even size: small days are merged, a large day is spread
    over several tasks.
    """
    if by_day:
        dated = df.withColumn(DAY, F.to_date("timestamp"))
        spread = dated.hint("rebalance", F.col(DAY))
        writer = spread.sortWithinPartitions(DAY, sort_by).write.partitionBy(DAY)
    else:
        writer = df.write
    writer = writer.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", CSV_WRITE_TIME)
    writer.format(fmt).save(path)


def write_lookup_table(
    scored: DataFrame, path: str, senders: int = 1_000_000, row_group_bytes: int | None = None
) -> None:
    """Write a scored table so that payments are found by day, tier, flag or sender.

    Folders by day and tier are skipped by name. Inside them rows lie by flag, then sender,
    so that row groups without a flagged payment are skipped by their range, and those that
    cannot hold a sender by their range or, where it spans the sender, by a Bloom filter made
    for `senders` distinct ones a row group. Each lookup is a plain filter, see
    `operations.of_days`, `of_tier`, `flagged` and `of_sender`.

    A row without a tier lies in a folder of its own; one without a sender is found by no sender.
    """
    lacking = [name for name in ("timestamp", "risk_tier", "fraud_flag", "sender_vpa") if name not in scored.columns]
    if lacking:
        raise ValueError(f"A lookup table needs columns: {lacking}")
    dated = scored.withColumn(DAY, F.to_date("timestamp"))
    spread = dated.hint("rebalance", F.col(DAY), F.col("risk_tier"))
    writer = (
        spread.sortWithinPartitions(DAY, "risk_tier", "fraud_flag", "sender_vpa")
        .write.mode("overwrite")
        .partitionBy(DAY, "risk_tier")
        .option("parquet.bloom.filter.enabled#sender_vpa", "true")
        .option("parquet.bloom.filter.expected.ndv#sender_vpa", str(senders))
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def read_lookup_table(spark: SparkSession, path: str) -> DataFrame:
    """The table with its day and tier, by whose folders filters prune."""
    shape = T.StructType([*SCORED, T.StructField(DAY, T.DateType())])
    return spark.read.schema(shape).parquet(path).select(*shape.fieldNames())


def register_transactions(scored: DataFrame, name: str = "transactions") -> None:
    """Make a scored table known to `spark.sql` under `name`.

    `timestamp` is a keyword: quote it with backticks in SQL text.
    """
    scored.createOrReplaceTempView(name)
