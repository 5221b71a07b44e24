"""Landed files: CSV extracts, JSON records, run-result documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from usageledger.operators.evolve import conform
from usageledger.schemas import RUN_RESULTS


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Declared columns of a CSV with a header; '' is NULL, quotes are doubled.

    Columns are matched by name, so extra or reordered file columns do no harm and a
    missing one is NULL. Values are cast afterwards: a malformed one fails the job.
    `multi_line` allows line breaks inside quotes, but a file is then read by one task.
    """
    text = (
        spark.read.option("header", True)
        .option("nullValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return conform(text, schema)


def read_records(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Landed JSON records, one per line; an empty extract is an error."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        records = reader.json(path)
    except AnalysisException as reason:
        # A folder without a single file has no fields to be found.
        if reason.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise ValueError(f"no records under {path}") from None
        raise
    if not records.columns or records.isEmpty():
        raise ValueError(f"no records under {path}")
    return records


def read_run_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Whole-file JSON documents, one per run; many runs may be landed as one document per line instead."""
    return spark.read.schema(RUN_RESULTS).option("multiLine", multi_line).json(path)
