"""Parquet writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# The folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Hashes as text, of which facts hold two a row, shrink by half with it and hardly with the default codec.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def laid_out(rows: DataFrame, partition: str, cluster: Sequence[str] = (), ranged: bool = False) -> DataFrame:
    """Rows dealt over files and sorted inside them.

    Without `ranged` Spark sizes the files, and all files of a value that needs several span all
    cluster values. With it, rows are dealt by ranges of partition and cluster columns, so a reader
    that wants one account opens the file or two that hold it. A hash of the row settles equal
    values, so that one that holds most rows is cut over several files too. Ranges are found on a
    sample of the rows, which runs their last stage twice: give rows that are stored.
    """
    if not ranged or not cluster:
        return rows.hint("rebalance", partition).sortWithinPartitions(partition, *cluster)
    others = [c for c in rows.columns if c != partition]
    order = [F.col(partition), *[F.col(c) for c in cluster]]
    return rows.repartitionByRange(*order, F.xxhash64(*others)).sortWithinPartitions(*order)


def write_partitioned(
    rows: DataFrame,
    path: str,
    partition: str,
    cluster: Sequence[str] = (),
    append: bool = False,
    ranged: bool = False,
) -> int:
    """Write by partition, replacing only the partitions that receive rows.

    With `ranged` the files of one partition value hold ranges of the cluster columns, see
    `laid_out`. The rebalance hint lets Spark size the output files and split a partition value
    that holds most of the rows over several tasks. Sorting by the partition first and
    the cluster columns next keeps the cluster order inside each file, which is what
    makes row-group statistics useful. Returns the number of rows written, taken during
    the write.
    """
    written = Observation()
    (
        laid_out(rows, partition, cluster, ranged)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.partitionBy(partition)
        .option("partitionOverwriteMode", "dynamic")
        .mode("append" if append else "overwrite")
        .parquet(path)
    )
    return written.get["rows"]


def rebuild(rows: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()) -> None:
    """Replace a whole table.

    The new contents are written beside the old ones and take their place when they are
    complete, so a job that fails while writing leaves the table as it was.
    """
    spark = rows.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    # Readers of the parent folder skip names that begin with an underscore.
    beside = f"{parent or '.'}/_new-{name.replace('=', '-')}-{uuid.uuid4().hex}"
    if partition is None:
        laid_out = rows.sortWithinPartitions(*cluster) if cluster else rows
        laid_out.write.parquet(beside)
    else:
        laid_out = rows.hint("rebalance", partition).sortWithinPartitions(partition, *cluster)
        laid_out.write.partitionBy(partition).parquet(beside)
    drop_folder(spark, path)
    written, files = _folder(spark, beside)
    target, _ = _folder(spark, path)
    if not files.rename(written, target):
        raise OSError(f"{beside} could not take the place of {path}")
    spark.catalog.refreshByPath(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def _folder(spark: SparkSession, path: str):
    """A path and the file system Spark reads it from."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def partition_folders(spark: SparkSession, path: str, partition: str, complete: bool = False) -> list[str]:
    """The values a table's folders name, without reading data; none if there is no table.

    `complete` leaves out folders whose own write did not reach its end.
    """
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [entry.getPath() for entry in files.listStatus(folder) if entry.isDirectory()]
    return sorted(
        p.getName().split("=", 1)[1]
        for p in found
        if p.getName().startswith(f"{partition}=") and (not complete or files.exists(marker(p, "_SUCCESS")))
    )


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Iterable[Any]) -> None:
    """Delete partition directories."""
    for value in values:
        name = NO_VALUE if value is None else str(value)
        folder, files = _folder(spark, f"{path}/{partition}={name}")
        files.delete(folder, True)
    spark.catalog.refreshByPath(path)


def as_view(rows: DataFrame, name: str) -> DataFrame:
    rows.createOrReplaceTempView(name)
    return rows


def dry_run(rows: DataFrame, sample: int = 5) -> dict[str, Any]:
    """What a write would produce: its row count and a few rows, in one execution."""
    counted = Observation()
    observed = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    # Ordering makes the preview deterministic and keeps the plan reading every row.
    preview = observed.orderBy(*rows.columns).limit(sample).collect()
    return {"rows": counted.get["rows"], "preview": [r.asDict() for r in preview]}
