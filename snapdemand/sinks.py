"""Writers. All of them can be repeated: a rerun replaces exactly what it writes. Days are replaced as a whole, see ``store``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.store import Store

POSTINGS, DESCRIBED, SUMMARIES = "postings", "described", "summaries"
#: writes a table of the given name and returns it as read back
Writer = Callable[[DataFrame, str], DataFrame]


def write_days(store: Store, snapshots: DataFrame, date: str = "date") -> None:
    """Publishes all days of a snapshot table at once, each with the index of the keys it describes."""
    version = store.stage()
    fields = [c for c in snapshots.columns if c != date]
    written = version.write(snapshots.select(*fields, F.col(date).cast("date").alias("date")), POSTINGS, by=["date"])
    version.write(_described(written).select("source_system", "posting_id", "date"), DESCRIBED, by=["date"])
    days = written.groupBy(F.col("date").cast("string").alias("day")).agg(F.count("description").alias("described"))
    store.publish(version, {  # the calendar bounds the days
        f"date={r['day']}": [POSTINGS, *([DESCRIBED] if r["described"] else [])] for r in days.collect()})


def write_day(store: Store, day: str, postings: DataFrame, summary: DataFrame | None = None) -> None:
    """Replaces one day: its postings, the index of the keys it describes and its run summary change together.

    An empty table leaves an empty file with the schema, not the old rows. Other days keep their files.
    """
    version, part = store.stage(), f"date={day}"
    written = version.write(postings, POSTINGS, part)
    version.write(_described(written).select("source_system", "posting_id"), DESCRIBED, part)
    if summary is not None:
        version.write(summary.coalesce(1), SUMMARIES, part, kind="json")
    store.publish(version, {part: [POSTINGS, DESCRIBED, *([] if summary is None else [SUMMARIES])]})


def _described(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("description").isNotNull())


def read_days(store: Store) -> DataFrame:
    """All published days; filter on ``date`` to skip whole days."""
    return store.read(POSTINGS, model.SNAPSHOT_SCHEMA)


def read_described(store: Store) -> DataFrame:
    """(source_system, posting_id, date) of every description stored so far: no text is read to know them."""
    return store.read(DESCRIBED, model.DESCRIBED_SCHEMA)


def read_summaries(store: Store) -> DataFrame:
    """The run summaries of all days that have one."""
    return store.read(SUMMARIES, model.RUN_SUMMARY_SCHEMA, kind="json")


def write_table(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Replaces a model's Parquet table and returns it as read back, which also cuts the plan."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def into(root: str) -> Writer:
    """Writes tables below one folder, each replacing the one before."""
    return lambda df, name: write_table(df, f"{root}/{name}")


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """Files in total order: a range per file, so a small mart is one file and a large one is sorted by all cores."""
    df.orderBy(*order).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row table with one JSON text."""
    document.coalesce(1).write.mode("overwrite").text(path)

