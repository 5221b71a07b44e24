"""Jobs from the command line: `python -m usageledger <job> ...` or spark-submit."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from usageledger import fixed_values as fv
from usageledger.operators.checks import ChecksFailed, require_passing
from usageledger.operators.retention import expire_path
from usageledger.plans import billing_run, ingest, quality, usage, usage_index
from usageledger.session import build_session, pin_utc, size_shuffles
from usageledger.sinks import versions
from usageledger.sources.tables import parse_day
from usageledger.streaming import decode, lake


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="usageledger", description=__doc__)
    parser.add_argument(
        "--input-gb", type=float, help="size of the input, to choose the shuffle width"
    )
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, summary: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=summary)
        for path in paths:
            added.add_argument(path)
        return added

    daily = job("usage-daily", "raw", "target", summary="metrics of the event days a load day touches")
    daily.add_argument("--date", help="load day, yesterday by default")
    daily.add_argument("--single-load", action="store_true", help="only that load's events")
    daily.add_argument("--timestamps-final", action="store_true")
    daily.add_argument("--loaded-since")

    backfill = job("usage-backfill", "raw", "target", summary="metrics of a range of load days")
    backfill.add_argument("--start-date", required=True)
    backfill.add_argument("--end-date", required=True)
    backfill.add_argument("--batch-days", type=int, default=1)
    backfill.add_argument("--dry-run", action="store_true")
    backfill.add_argument("--append", action="store_true")

    recent = job("usage-recent", "raw", "target", summary="recompute the last event days")
    recent.add_argument("--as-of", required=True)
    recent.add_argument("--days", type=int, default=fv.LOOKBACK_DAYS)
    recent.add_argument("--loaded-since")

    billing = job("billing", "base", summary="staging, history, facts and reports below a folder")
    billing.add_argument("--run-at", type=datetime.fromisoformat)
    billing.add_argument("--full-refresh", action="store_true")

    checks = job("quality", "base", summary="volume, reconciliation and freshness checks")
    checks.add_argument("--date")
    checks.add_argument("--as-of", type=datetime.fromisoformat)

    load = job("usage-load", "raw", "state", summary="bring metrics with an event index forward by a load")
    load.add_argument("--date", help="first load day, default yesterday")
    load.add_argument("--until", help="last load day, default the first")

    payload = job("ingest-subscriptions", "landed", "raw", summary="flatten and append landed records")
    payload.add_argument("--date")
    results = job("run-results", "documents", "table", summary="append run results to monitoring")
    results.add_argument("--date")
    job("load-extracts", "folder", "base", summary="load the CSV extracts as raw tables")

    expire = job("expire", "path", summary="drop old partitions")
    expire.add_argument("--as-of", required=True)
    expire.add_argument("--days", type=int, default=fv.RAW_RETENTION_DAYS)
    expire.add_argument("--partition", default="load_date")

    for name, summary in (("events-to-lake", "broker to hour folders"), ("events-to-raw", "broker to raw table")):
        stream = job(name, "servers", "topic", "path", summary=summary)
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--json", action="store_true", help="values are JSON, not framed Avro")
        stream.add_argument("--drain", action="store_true", help="stop when caught up")
    return parser


def _day(text: str | None) -> date:
    return parse_day(text) if text else datetime.now(timezone.utc).date()


def _checks(spark: SparkSession, base: str, day: str | None, as_of: datetime | None) -> list[dict]:
    table = {
        name: spark.read.parquet(f"{base}/{name}")
        for name in ("raw/raw_subscriptions", "staging/stg_subscriptions", "reporting/rpt_subscription_monthly")
    }
    raw, staged, monthly = table.values()
    facts = versions.read(spark, f"{base}/transform/fct_subscriptions")
    suite = quality.quality_suite(
        raw, staged, facts, {"rpt_subscription_monthly": (monthly, "_loaded_at")}, _day(day), as_of
    )
    require_passing(suite)
    return [row.asDict() for row in suite.collect()]


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    """Run one job and return what it reports."""
    pin_utc(spark)
    if args.input_gb:
        size_shuffles(spark, int(args.input_gb * 1024**3))
    match args.job:
        case "usage-daily":
            day = args.date or _day(None) - timedelta(days=1)
            return usage.run_usage_daily(
                spark, args.raw, args.target, day, not args.single_load,
                args.timestamps_final, args.loaded_since,
            )
        case "usage-backfill":
            return usage.run_usage_backfill(
                spark, args.raw, args.target, args.start_date, args.end_date,
                args.batch_days, args.dry_run, args.append,
            )
        case "usage-load":
            day = args.date or _day(None) - timedelta(days=1)
            return usage_index.load_days(spark, args.raw, args.state, day, args.until)
        case "usage-recent":
            return usage.run_recent_days(
                spark, args.raw, args.target, args.as_of, args.days, args.loaded_since
            )
        case "billing":
            at = args.run_at or datetime.now(timezone.utc)
            return sorted(billing_run.run_billing(spark, args.base, at, args.full_refresh))
        case "quality":
            return _checks(spark, args.base, args.date, args.as_of)
        case "ingest-subscriptions":
            return ingest.ingest_subscriptions(spark, args.landed, args.raw, _day(args.date))
        case "run-results":
            return ingest.record_run_results(spark, args.documents, args.table, _day(args.date))
        case "load-extracts":
            return ingest.land_extracts(spark, args.folder, args.base)
        case "expire":
            return expire_path(spark, args.path, parse_day(args.as_of), args.days, args.partition)
        case _:
            decoder = decode.decode_json if args.json else decode.decode_avro
            events = decode.decode_messages(
                decode.read_broker(spark, args.servers, args.topic), decoder
            )
            sink = lake.events_to_lake if args.job == "events-to-lake" else lake.events_to_raw
            seconds = None if args.drain else fv.FLUSH_SECONDS
            sink(events, args.path, args.checkpoint, seconds).awaitTermination()
            return None


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments().parse_args(argv)
    session = spark or build_session(f"usageledger-{args.job}")
    try:
        print(json.dumps({"job": args.job, "result": run(session, args)}, default=str))
        return 0
    except (ChecksFailed, ValueError) as refused:
        print(json.dumps({"job": args.job, "error": str(refused)}), file=sys.stderr)
        return 1
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    sys.exit(main())
