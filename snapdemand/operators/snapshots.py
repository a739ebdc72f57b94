"""Building one day's snapshot out of its sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_sources(spark: SparkSession, parts: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """All parts under one fixed schema; an empty table when there are none."""
    shaped = [p.select(*[F.col(f.name).cast(f.dataType) for f in schema]) for p in parts]
    return reduce(DataFrame.unionAll, shaped) if shaped else spark.createDataFrame([], schema)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order. Copies are combined inside each task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def known_keys(described: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of an index of described keys, each once, marked ``_known``; ``described`` must hold earlier days only."""
    return described.select(*keys).distinct().withColumn("_known", F.lit(True))


def store_once(
    today: DataFrame, described: DataFrame, keys: Sequence[str], value: str, otherwise: Column | None = None
) -> DataFrame:
    """Empties ``value`` where an earlier day has stored it; else keeps it, or takes ``otherwise`` when null.

    ``described`` is the index of keys whose value earlier days hold, so the values themselves are not read.
    """
    kept = F.col(value) if otherwise is None else F.coalesce(F.col(value), otherwise)
    return (
        today.join(known_keys(described, keys), list(keys), "left")
        .withColumn(value, F.when(F.col("_known").isNull(), kept))
        .select(*today.columns)
    )


def status(rows: Column, failed: Column) -> Column:
    """'error' for a failed source, else 'ok' or 'empty' by its number of rows."""
    return F.when(failed, "error").when(rows > 0, "ok").otherwise("empty")
