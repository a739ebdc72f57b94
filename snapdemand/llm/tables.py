"""Helpers that the operators share: scratch tables in the shared folder and keys of rows."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where a local session names none, one is set for it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "llm-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here, a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart, should ids repeat."""
    return F.xxhash64(F.col(text))


def of_small_hash(df: DataFrame, column: str, rows: int) -> DataFrame:
    """The rows whose hash of ``column`` is low enough for somewhat more than ``rows`` of them; all if there are few.

    Done before a limit in that order, it keeps tasks from sending ``rows`` rows each.
    """
    n = df.count()
    if n <= 2 * rows:
        return df
    return df.where(F.xxhash64(column) < F.lit(int(-(1 << 63) + (1 << 64) * 1.5 * rows / n)))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
