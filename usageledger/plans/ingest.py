"""Landing of subscription payloads, run results and source extracts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usageledger.functions.columns import last_segment, moment
from usageledger.functions.nested import flatten
from usageledger.schemas import SOURCE_TABLES
from usageledger.sinks.files import append, exists, rebuild
from usageledger.sources.landed import read_csv, read_records, read_run_results
from usageledger.sources.tables import parse_day

# Values that do not fit the type of their column in the raw table.
UNFIT = "_unfit"


def flatten_payload(
    records: DataFrame, run_date: str | date, loaded_at: datetime | Column | None = None
) -> DataFrame:
    """Nested API records as flat columns, with the columns that tell where they came from."""
    return flatten(records).withColumns({
        "_loaded_at": moment(loaded_at),
        "_source_system": F.lit("stripe"),
        "_pipeline_run_date": F.lit(parse_day(run_date)),
    })


def ingest_subscriptions(
    spark: SparkSession,
    landed_path: str,
    raw_path: str,
    run_date: str | date,
    schema: StructType | str | None = None,
) -> int:
    """Append landed records to the raw table; an empty load is an error.

    Rows are counted while they are written. Without a `schema` Spark reads the extract
    once more to find its fields; new ones become new columns, and readers of the raw
    table merge the file schemas. A column keeps the type it has in the table: see
    `fit_table`.
    """
    loaded = Observation()
    rows = flatten_payload(read_records(spark, landed_path, schema), run_date)
    if exists(spark, raw_path):
        rows = fit_table(rows, spark.read.option("mergeSchema", True).parquet(raw_path).schema)
    append(rows.observe(loaded, F.count(F.lit(1)).alias("rows")), raw_path)
    if loaded.get["rows"] == 0:
        raise ValueError("no rows were written")
    return loaded.get["rows"]


def fit_table(rows: DataFrame, table: StructType) -> DataFrame:
    """Columns with the types the table already has, so that every reader can merge them.

    A value that the table's type cannot hold becomes NULL there and is kept as text in
    the JSON column `_unfit`, by column name; the column exists only if some type differs.
    """
    kinds = {f.name: f.dataType for f in table.fields}
    fitted, unfit = {}, []
    for field in rows.schema.fields:
        kind = kinds.get(field.name)
        if kind is None or kind == field.dataType or field.name == UNFIT:
            continue
        given = F.col(f"`{field.name}`")
        value = given.try_cast(kind)
        # A cast that cannot be undone, such as 1.5 to 1, has lost something too.
        lost = given.isNotNull() & ~F.coalesce(value.try_cast(field.dataType) == given, F.lit(False))
        fitted[field.name] = F.when(~lost, value)
        unfit.append(F.when(lost, given.cast("string")).alias(field.name))
    if not fitted:
        return rows
    kept = F.to_json(F.struct(*unfit))
    return rows.withColumns({**fitted, UNFIT: F.when(kept != F.lit("{}"), kept)})


def run_result_rows(
    documents: DataFrame, run_date: str | date, run_at: datetime | Column | None = None
) -> DataFrame:
    """One monitoring row per node of every run document."""
    nodes = documents.select("metadata", F.explode("results").alias("node"))
    return nodes.select(
        F.lit(parse_day(run_date)).alias("run_date"),
        moment(run_at).alias("pipeline_run_at"),
        F.col("node.unique_id").alias("node_id"),
        F.coalesce(last_segment("node.unique_id"), F.lit("")).alias("node_name"),
        F.col("node.status").alias("status"),
        F.round(F.coalesce("node.execution_time", F.lit(0.0)), 2).alias("execution_time_s"),
        F.coalesce("node.adapter_response.rows_affected", F.lit(0)).alias("rows_affected"),
        F.coalesce("node.message", F.lit("")).alias("message"),
        F.col("metadata.invocation_id").alias("invocation_id"),
        F.col("metadata.dbt_version").alias("dbt_version"),
    )


def record_run_results(
    spark: SparkSession, documents_path: str, monitoring_path: str, run_date: str | date, multi_line: bool = True
) -> int:
    """Append the nodes of landed run documents to the monitoring table."""
    stored = Observation()
    rows = run_result_rows(read_run_results(spark, documents_path, multi_line), run_date)
    append(rows.observe(stored, F.count(F.lit(1)).alias("rows")), monitoring_path)
    return stored.get["rows"]


def read_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The source tables from `raw_<table>.csv` files."""
    return {
        name: read_csv(spark, f"{folder.rstrip('/')}/raw_{name}.csv", schema)
        for name, schema in SOURCE_TABLES.items()
    }


def land_extracts(spark: SparkSession, folder: str, base: str) -> None:
    """Load the CSV extracts as the typed raw tables below `base`, replacing them."""
    for name, rows in read_extracts(spark, folder).items():
        rebuild(rows, f"{base.rstrip('/')}/raw_{name}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, by name."""
    parts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in tables.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.orderBy("table_name")


def expensive_jobs(jobs: DataFrame, since: datetime | Column, top: int = 10) -> DataFrame:
    """The finished queries that read the most, created at or after `since`."""
    return (
        jobs.where(
            (F.col("creation_time") >= moment(since))
            & (F.col("job_type") == "QUERY")
            & (F.col("state") == "DONE")
        )
        .orderBy(F.col("total_bytes_processed").desc(), "job_id")
        .limit(top)
        .select(
            "job_id", "query", "user_email",
            (F.col("total_bytes_processed") / 1024 / 1024 / 1024).alias("gb_processed"),
            (F.col("total_slot_ms") / 1000 / 60).alias("slot_minutes"),
            "creation_time",
        )
    )
