"""``python -m snapdemand adopt|ingest|build|weekly|report``; run it with spark-submit on a cluster.

``--raw`` is the folder of the published days, ``--out`` of ``build`` and ``--models`` of ``report`` that of the warehouse.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdemand import sinks
from snapdemand.plans import ingest, report, skill_demand, warehouse
from snapdemand.quality import checks
from snapdemand.session import SETTINGS
from snapdemand.sources import config, files
from snapdemand.sources.payloads import PAYLOAD_SCHEMA
from snapdemand.store import Store


def _adopt(spark: SparkSession, a: argparse.Namespace) -> int:
    """Publishes snapshots that lie in plain folders by day."""
    sinks.write_days(Store(spark, a.raw), files.read_snapshots(spark, a.folder))
    return 0


def _ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    listed = config.read_config(spark, a.companies)
    companies = listed.select(
        F.from_json("entry", "map<string,string>")["key"].alias("company_key"), F.col("position").alias("source_order"))
    payloads = spark.read.schema(PAYLOAD_SCHEMA).parquet(a.payloads)
    details = spark.read.schema("source_system string, url string, json string").parquet(a.details) if a.details else None
    summary = ingest.ingest_day(payloads, companies, Store(spark, a.raw), a.date, details)
    entries = summary.select(F.inline("companies"))
    entries.groupBy("status").agg(F.count("*").alias("companies"), F.sum("rows").alias("postings")).orderBy("status").show()
    entries.where("status = 'error'").select("key", "error").show(1000, truncate=False)
    return 0 if checks.check_any_rows(summary).isEmpty() else 1


def _csv(spark: SparkSession, path: str | None, schema: str) -> DataFrame | None:
    return files.read_dictionary(spark, path, schema) if path else None


def _build(spark: SparkSession, a: argparse.Namespace) -> int:
    days = sinks.read_days(Store(spark, a.raw))
    failures = warehouse.publish(
        days, files.read_dictionary(spark, a.skills), files.read_rules(spark, a.rules),
        config.config_to_dimension(config.read_config(spark, a.companies)), Store(spark, a.out),
        _csv(spark, a.tag_cases, "text string, skill string, should_match boolean"),
        _csv(spark, a.label_cases, "title string, role_family string, seniority string"),
        buckets=int(a.buckets) if a.buckets else None)
    failures.groupBy("check", "severity").agg(F.count("*").alias("rows"), F.min("key").alias("first")).show(100, truncate=False)
    if a.now:
        late = checks.check_freshness(days, "date", F.lit(a.now).cast("timestamp_ntz"))
        late.show(truncate=False)
    return 0 if failures.where("severity = 'error'").isEmpty() else 1


def _weekly(spark: SparkSession, a: argparse.Namespace) -> int:
    weekly = skill_demand.skill_demand_weekly(sinks.read_days(Store(spark, a.raw)), files.read_dictionary(spark, a.skills))
    sinks.write_ordered(weekly, a.out, ["week_start", "skill"])
    return 0


def _report(spark: SparkSession, a: argparse.Namespace) -> int:
    models = Store(spark, a.models)
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    sinks.write_document(report.report_document(
        models.read("mart_skill_demand_weekly"), models.read("fct_postings"), models.read("dim_company"),
        sinks.read_summaries(Store(spark, a.raw)), now), a.out)
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="snapdemand", description=__doc__)
    commands = ap.add_subparsers(required=True)
    for run, needed, optional in (
        (_adopt, ("folder", "raw"), ()),
        (_ingest, ("date", "companies", "payloads", "raw"), ("details",)),
        (_build, ("raw", "skills", "rules", "companies", "out"), ("tag-cases", "label-cases", "now", "buckets")),
        (_weekly, ("raw", "skills", "out"), ()),
        (_report, ("models", "raw", "out"), ()),
    ):
        command = commands.add_parser(run.__name__.lstrip("_"))
        for name in needed:
            command.add_argument(f"--{name}", required=True)
        for name in optional:
            command.add_argument(f"--{name}")
        command.set_defaults(run=run)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("snapdemand").config(map=SETTINGS).getOrCreate()
    return args.run(spark, args)


if __name__ == "__main__":
    raise SystemExit(main())
