"""Small helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.session import scratch_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS = 1_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The white space that separates words and is stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python by the thousand at most.

    The default of 10,000 rows a batch is meant for narrow rows; so many long texts are held
    several times over by the executor and its worker.
    """
    rows = int(spark.conf.get(BATCH_ROWS, "10000"))
    if rows <= 0 or rows > TEXTS:
        spark.conf.set(BATCH_ROWS, str(TEXTS))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, lineage cut."""
    return stored_at(frame, scratch_path(frame.sparkSession, label))


def stored_at(frame: DataFrame, path: str) -> DataFrame:
    """The same under a given path, which the caller may drop when nothing reads it any more.

    Nothing reads the shuffles of the write once it is done, so Spark may delete their files.
    """
    spark = frame.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def let(value: Column, body) -> Column:
    """body(value) with `value` evaluated once, even where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_row(frame: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as the struct `row` beside new columns, so that no name can clash."""
    return frame.select(F.struct(*[frame[c] for c in frame.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])
