"""Report datasets: top-k, trends, group counts, coverage and source health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapdemand import model


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of every group, all groups in one pass.

    Spark keeps only k rows per group and task before it shuffles, so the size of a group does not matter.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def latest_week(weekly: DataFrame) -> Column:
    return weekly.agg(F.max("week_start")).scalar()


def top_tags(weekly: DataFrame, k: int = model.TOP_TAGS) -> DataFrame:
    """The most wanted tags of the latest week in each scope, ties by name."""
    latest = weekly.where(F.col("week_start") == latest_week(weekly))
    return top_k(latest, ["role_scope"], [F.desc("open_postings"), F.asc("skill")], k, rank="rank")


def trend_names(weekly: DataFrame, scope: str = model.TREND_SCOPE, k: int = model.TREND_TAGS) -> DataFrame:
    """The k tags most wanted in the latest week of one scope."""
    return (
        weekly.where((F.col("week_start") == latest_week(weekly)) & (F.col("role_scope") == scope))
        .orderBy(F.desc("open_postings"), F.asc("skill")).limit(k).select("skill")
    )


def trend_rows(weekly: DataFrame, names: DataFrame, scope: str = model.TREND_SCOPE) -> DataFrame:
    """All weeks of the named tags in one scope."""
    return weekly.where(F.col("role_scope") == scope).join(F.broadcast(names), "skill", "left_semi").select(
        "week_start", "skill", "open_postings")


def week_axis(weekly: DataFrame) -> Column:
    """Every week of the mart, ascending, as a scalar array."""
    return weekly.agg(F.array_sort(F.collect_set("week_start"))).scalar()


def trend(
    weekly: DataFrame, scope: str = model.TREND_SCOPE, k: int = model.TREND_TAGS
) -> DataFrame:
    """Per named tag one array of counts along the week axis; a week without the tag counts 0."""
    names = trend_names(weekly, scope, k)
    per_tag = trend_rows(weekly, names, scope).groupBy("skill").agg(
        F.map_from_entries(F.collect_list(F.struct("week_start", "open_postings"))).alias("_by_week"))
    return (
        per_tag.withColumn("weeks", week_axis(weekly))
        .withColumn("series", F.transform(
            "weeks", lambda w: F.coalesce(F.try_element_at("_by_week", w), F.lit(0).cast("bigint"))))
        .drop("_by_week")
    )


def open_by(facts: DataFrame, column: str) -> DataFrame:
    """Open entities per value of a column, largest first."""
    return (
        facts.where("is_open").groupBy(column).agg(F.count("*").alias("open_postings"))
        .orderBy(F.desc("open_postings"), F.asc(column))
    )


def top_companies(facts: DataFrame, dimension: DataFrame, key: str = "company_key", name: str = "name",
                  k: int = model.TOP_COMPANIES) -> DataFrame:
    """The companies with most open entities; counted per key before the dimension is joined."""
    per_key = facts.where("is_open").groupBy(key).agg(F.count("*").alias("_n"))
    return (
        per_key.join(dimension.select(key, name), key)
        .groupBy(name).agg(F.sum("_n").alias("open_postings"))
        .orderBy(F.desc("open_postings"), F.asc(name)).limit(k)
    )


def coverage(facts: DataFrame, dimension: DataFrame, key: str = "company_key") -> DataFrame:
    """Companies with open entities, companies tracked, open entities: one row."""
    open_per_key = facts.where("is_open").groupBy(key).agg(F.count("*").alias("_n"))
    return open_per_key.agg(
        F.count(key).alias("companies"), F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("postings_open"),
    ).select("companies", dimension.agg(F.count("*")).scalar().alias("companies_tracked"), "postings_open")


def latest_summary(summaries: DataFrame) -> DataFrame:
    """The run summary of the last date: at most one row."""
    return summaries.agg(F.max_by(F.struct("*"), "date").alias("s")).where("s is not null").select("s.*")


def source_statuses(summaries: DataFrame) -> DataFrame:
    """One row per run date and source."""
    return summaries.select("date", "started_at", F.explode("companies").alias("c")).select(
        "date", "started_at", "c.*")


def health(summaries: DataFrame) -> DataFrame:
    """When the last run started, its rows, and which sources gave rows, none, or failed: one row."""
    def keys(status: str) -> Column:
        return F.transform(F.filter("companies", lambda c: c["status"] == status), lambda c: c["key"])

    return summaries.agg(F.max_by(F.struct("started_at", "rows", "companies"), "date").alias("s")).select(
        F.col("s.started_at").alias("last_run"),
        F.coalesce("s.rows", F.lit(0).cast("bigint")).alias("rows"),
        F.coalesce("s.companies", F.array().cast(_COMPANIES)).alias("companies"),
    ).select(
        "last_run", "rows", F.size(keys("ok")).alias("sources_ok"),
        keys("empty").alias("sources_empty"), keys("error").alias("sources_failed"))


_COMPANIES = ("array<struct<key:string,status:string,rows:bigint,error:string,describe_errors:bigint,"
              "truncated:boolean,duration_s:double>>")
