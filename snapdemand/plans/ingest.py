"""One day's ingest: landed payloads in, one day partition and one run summary out."""

from __future__ import annotations

import time
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.operators.snapshots import dedupe_first, known_keys, status
from snapdemand.session import scratch_dir
from snapdemand.sinks import read_described, read_summaries, write_day, write_table
from snapdemand.sources.payloads import (
    ORDER, SPECS, PayloadSpec, attach_details, description, listed_postings, parse_payloads, site_totals,
)
from snapdemand.store import Store

KEYS = ("source_system", "posting_id")


def company_status(parsed: DataFrame) -> DataFrame:
    """Per company: did any response fail, why (the first reason by name), and did any site report more rows than were read."""
    failed = parsed.groupBy("company_key").agg(F.min("error").alias("error"), F.lit(False).alias("truncated"))
    cut = site_totals(parsed).select("company_key", F.lit(None).cast("string").alias("error"), "truncated")
    return failed.unionByName(cut).groupBy("company_key").agg(
        F.min("error").alias("error"), F.max("truncated").alias("truncated")).withColumn("failed", F.col("error").isNotNull())


def collect_postings(parsed: DataFrame, statuses: DataFrame) -> DataFrame:
    """The day's postings without those of failed companies; a posting found twice counts once."""
    failed = statuses.where("failed").select("company_key")
    found = listed_postings(parsed.where(~F.col("failed"))).join(failed, "company_key", "left_anti")
    return dedupe_first(found, KEYS, (*ORDER, "url"))


def with_descriptions(
    today: DataFrame, described: DataFrame, details: DataFrame | None, specs: Mapping[str, PayloadSpec] = SPECS
) -> DataFrame:
    """Descriptions are stored on the first day they are known, and never again; missing ones come from details.

    The markup of a known posting is not even looked at. Adds ``describe_error``: the posting still wants a description
    and its detail response was of no use. ``described`` is the index of keys that earlier days describe; no text of
    theirs is read. The condition on the system lets Spark thin the index by a Bloom filter of today's keys, once it
    is large. ``today`` is laid out by key already, so the join shuffles the index only.
    """
    unknown = F.col("_known").isNull()
    listed = today.where(F.col("source_system").isin(*specs))
    marked = listed.join(known_keys(described, KEYS), list(KEYS), "left").withColumn(
        "description", F.when(unknown, description(specs)))
    if details is None:
        filled = marked.withColumn("detail_failed", F.lit(False))
    else:
        filled = attach_details(marked, details, specs, unknown)
    return filled.select(*model.POSTING_FIELDS, F.col("detail_failed").alias("describe_error"))


def summarise_run(
    postings: DataFrame, statuses: DataFrame, companies: DataFrame, day: str, started_at: str, duration_s: float
) -> DataFrame:
    """The run summary: one row. Every configured company has an entry, in the config's order, rows or not.

    ``companies`` is (company_key, source_order). Postings are counted per company first, so a company that holds a
    third of them is one row in the joins.
    """
    counts = postings.groupBy("company_key").agg(
        F.count("*").alias("rows"), F.count_if("describe_error").alias("describe_errors"))
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    entries = (
        companies.join(counts, "company_key", "left").join(statuses, "company_key", "left")
        .select(
            "source_order",
            F.col("company_key").alias("key"),
            status(F.coalesce("rows", zero), F.coalesce("failed", no)).alias("status"),
            F.coalesce("rows", zero).alias("rows"),
            "error",
            F.coalesce("describe_errors", zero).alias("describe_errors"),
            F.coalesce("truncated", no).alias("truncated"),
            F.lit(None).cast("double").alias("duration_s"))
    )
    fields = ("key", "status", "rows", "error", "describe_errors", "truncated", "duration_s")
    collected = F.array_sort(F.collect_list(F.struct("source_order", *fields)))
    return entries.agg(F.coalesce(F.sum("rows"), zero).alias("rows"), collected.alias("c")).select(
        F.lit(day).alias("date"), F.lit(started_at).alias("started_at"),
        F.lit(duration_s).cast("double").alias("duration_s"), "rows",
        F.transform("c", lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias("companies"))


def ingest_day(
    payloads: DataFrame, companies: DataFrame, store: Store, day: str, details: DataFrame | None = None,
    specs: Mapping[str, PayloadSpec] = SPECS,
) -> DataFrame:
    """Publishes the day's postings and summary in one step and returns the summary.

    Of the days published so far, only the index of described keys is read, and of it only earlier days, so a rerun gives
    the same result. The day is staged in a written table once: postings and summary both read that.
    """
    spark = payloads.sparkSession
    started, clock = datetime.now(timezone.utc).isoformat(), time.monotonic()
    parsed = write_table(parse_payloads(payloads, specs), scratch_dir(spark, "parsed"))
    statuses = write_table(company_status(parsed), scratch_dir(spark, "status"))
    described = read_described(store).where(F.col("date") < F.lit(day).cast("date"))
    filled = with_descriptions(collect_postings(parsed, statuses), described, details, specs)
    staged = write_table(filled, scratch_dir(spark, "day"))
    summary = summarise_run(staged, statuses, companies, day, started, round(time.monotonic() - clock, 2))
    write_day(store, day, staged.drop("describe_error"), summary)
    return read_summaries(store).where(F.col("date") == day)
