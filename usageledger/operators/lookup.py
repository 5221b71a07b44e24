"""Joins that stay balanced when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above 1/HOT_PARTS of all rows, so there are fewer than HOT_PARTS of them;
# that bound is what makes broadcasting the hot-key list safe at any table size.
HOT_PARTS = 1000
# Groups below this many rows never hurt a task, whatever their share.
HOT_FLOOR = 200_000


def hot_keys(rows: DataFrame, key: str, floor: int = HOT_FLOOR, parts: int = HOT_PARTS) -> DataFrame:
    """Keys holding more than 1/parts of the rows and more than `floor` rows.

    `_pieces` says into how many pieces of about `floor` rows each has to be cut.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.where(
        (F.col("_n") > floor) & (F.col("_n") * parts > total.scalar())
    ).select(key, F.ceil(F.col("_n") / max(floor, 1)).cast("int").alias("_pieces"))


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Sequence[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join `rows` to a dimension with one row per key.

    `hot` comes from `hot_keys`, which bounds its rows. Rows of a hot key are dealt over
    its pieces by a hash of `spread_by`, and the one dimension row of that key is
    repeated once per piece. Rows without a key match nothing, so the whole hash deals
    them out instead of their meeting in one task. The hash depends on the row alone: a
    recomputed task deals the same way.

    No size is guessed for the dimension; Spark broadcasts it only when its statistics
    or its measured shuffle size are below the session's threshold.
    """
    dealt_by = F.xxhash64(*spread_by)
    if hot is None:
        dealt = rows.withColumn("_slice", F.when(F.col(key).isNull(), dealt_by).otherwise(F.lit(0)))
        copies = dimension.withColumn("_slice", F.lit(0).cast("bigint"))
    else:
        marks = F.broadcast(hot.select(key, "_pieces"))
        dealt = (
            rows.join(marks, key, "left")
            .withColumn(
                "_slice",
                F.when(F.col(key).isNull(), dealt_by)
                .when(F.col("_pieces").isNotNull(), F.pmod(dealt_by, F.col("_pieces")))
                .otherwise(F.lit(0)),
            )
            .drop("_pieces")
        )
        last_piece = F.coalesce(F.col("_pieces") - 1, F.lit(0)).cast("bigint")
        copies = (
            dimension.join(marks, key, "left")
            .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)))
            .drop("_pieces")
        )
    return dealt.join(copies, [key, "_slice"], "left").drop("_slice")


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent and how many child rows carry each.

    The child is counted per key first, so the join sees one row per key however the
    rows are spread; NULL keys are not references. Repeated parent keys are folded for
    the same reason.
    """
    used = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count("*").alias("row_count"))
    )
    known = parent.select(F.col(parent_key).alias(foreign_key)).distinct()
    return used.join(known, foreign_key, "left_anti")
