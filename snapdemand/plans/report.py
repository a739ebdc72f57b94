"""The report: one JSON document out of the marts, facts, dimension and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.operators import rank


def _listed(df: DataFrame, order: Sequence[Column]) -> Column:
    """A short dataset as a scalar array of its rows, in order."""
    columns = df.columns
    # each dataset here is a top-k, or one row per label: a handful of rows
    rows = F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*columns).alias("r")))
    return df.agg(F.transform(F.array_sort(rows), lambda x: x["r"])).scalar()


def report_document(
    weekly: DataFrame, facts: DataFrame, dimension: DataFrame, summaries: DataFrame, generated_at: str,
    scopes: Sequence[str] = tuple(model.SCOPES),
) -> DataFrame:
    """One row, one column ``json``."""
    spark: SparkSession = weekly.sparkSession
    down = -F.col("open_postings")
    top = rank.top_tags(weekly)

    def top_of(scope: str) -> Column:
        rows = top.where(F.col("role_scope") == scope).select("skill", "category", "open_postings", "share")
        return _listed(rows, [down, F.col("skill")]).alias(scope)

    def groups(column: str) -> Column:
        return _listed(rank.open_by(facts, column), [down, F.col(column)])

    trend = rank.trend(weekly).agg(F.map_from_entries(F.collect_list(F.struct("skill", "series")))).scalar()
    covered = rank.coverage(facts, dimension).select(F.struct("companies", "companies_tracked", "postings_open"))
    healthy = rank.health(summaries).select(F.struct("*"))
    document = F.struct(
        F.lit(generated_at).alias("generated_at"),
        covered.scalar().alias("coverage"),
        rank.latest_week(weekly).cast("string").alias("skills_week_start"),
        F.struct(*[top_of(s) for s in scopes]).alias("skills_this_week"),
        F.struct(rank.week_axis(weekly).cast("array<string>").alias("weeks"),
                 trend.alias("series")).alias("skill_trend"),
        groups("role_family").alias("roles"),
        groups("seniority").alias("seniority"),
        _listed(rank.top_companies(facts, dimension), [down, F.col("name")]).alias("top_companies"),
        healthy.scalar().alias("health"),
    )
    return spark.range(1).select(F.to_json(document, {"ignoreNullFields": "false"}).alias("json"))
