"""Additive schema change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def append_evolving(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    """Stack both; a column one side lacks is NULL there, none is ever dropped."""
    return existing.unionByName(arriving, allowMissingColumns=True)


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Pick the declared columns by name, cast them, and ignore the others."""
    present = set(rows.columns)
    return rows.select(*[
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ])


def schema_drift(rows: DataFrame, expected: StructType) -> DataFrame:
    """Differences between a table's columns and its declaration; reads no data."""
    actual = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    declared = {f.name: f.dataType.simpleString() for f in expected.fields}
    found = []
    for name in sorted(actual.keys() | declared.keys()):
        want, have = declared.get(name), actual.get(name)
        if want != have:
            change = "added" if want is None else "missing" if have is None else "type_changed"
            found.append((name, change, want, have))
    return rows.sparkSession.createDataFrame(
        found, "column_name string, change string, expected_type string, actual_type string"
    )
