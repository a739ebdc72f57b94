"""Demand marts: how many open entities mention a tag, per week and scope; how many are open and new, per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapdemand import model
from snapdemand.functions.dates import week_start

Scopes = Mapping[str, Sequence[str]]


def scopes_of(family: Column, scopes: Scopes) -> Column:
    """The scopes a family belongs to; empty for a family that no scope lists."""
    by_family: dict[str, list[str]] = {}
    for scope, families in scopes.items():
        for f in families:
            by_family.setdefault(f, []).append(scope)
    none = F.array().cast("array<string>")
    if not by_family:
        return none
    table = F.create_map(*[x for f, s in by_family.items()
                           for x in (F.lit(f), F.array(*[F.lit(v) for v in s]))])
    return F.coalesce(F.try_element_at(table, family), none)


def expand_scopes(df: DataFrame, family: str, scopes: Scopes, into: str = "role_scope") -> DataFrame:
    """Each row once per scope of its family."""
    return df.withColumn(into, F.explode(scopes_of(F.col(family), scopes)))


def _weeks(obs: DataFrame, key: str, day: str) -> DataFrame:
    """The weeks a key was seen in: a set no longer than the calendar, so one shuffle on the key serves the join."""
    return obs.groupBy(key).agg(F.collect_set(week_start(F.col(day))).alias("_weeks"))


def weekly_counts(entities: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per week, ``by`` and tag, out of one row per entity with arrays ``_weeks`` and ``tags``.

    A null tag stands for the entity itself, so its count is the number of entities whatever tags they have.
    """
    whole = F.array(F.lit(None).cast("struct<skill:string,category:string>"))
    return (
        entities.select(*by, "_weeks", F.explode(F.concat(whole, "tags")).alias("_tag"))
        .select(*by, "_tag", F.explode("_weeks").alias("week_start"))
        .groupBy("week_start", *by, F.col("_tag.skill").alias("skill"), F.col("_tag.category").alias("category"),
                 F.col("_tag").isNull().alias("_is_total"))
        .agg(F.count("*").alias("open_postings"))
    )


def shares(counts: DataFrame, within: Sequence[str]) -> DataFrame:
    """Turns counts with total rows into shares. A window here holds one row per dictionary entry."""
    group = Window.partitionBy(*within)
    total = F.max(F.when(F.col("_is_total"), F.col("open_postings"))).over(group)
    return (
        counts.withColumn("_total", total)
        .where(~F.col("_is_total"))
        .withColumn("share", F.col("open_postings").cast("double") / F.col("_total"))
        .drop("_total", "_is_total")
    )


def weekly_demand(
    obs: DataFrame,
    facts: DataFrame,
    tags: DataFrame,
    scopes: Scopes = model.SCOPES,
    key: str = "posting_key",
    day: str = "collected_date",
    family: str = "role_family",
) -> DataFrame:
    """Per week, scope and tag: open entities with the tag, and their share of all open entities of the scope.

    Each input is shuffled once, on the key. Counts are made per family first; scopes are expanded on the counts, which
    is the same sum because an entity has one family.
    """
    tag_sets = tags.groupBy(key).agg(F.collect_set(F.struct("skill", "category")).alias("tags"))
    entities = (
        facts.select(key, family)
        .join(_weeks(obs, key, day), key)
        .join(tag_sets, key, "left")
        .withColumn("tags", F.coalesce("tags", F.array().cast("array<struct<skill:string,category:string>>")))
    )
    return scoped_demand(entities, scopes, family)


def scoped_demand(entities: DataFrame, scopes: Scopes = model.SCOPES, family: str = "role_family") -> DataFrame:
    """``weekly_demand`` for entities that already carry ``_weeks`` and ``tags``."""
    by_scope = (
        expand_scopes(weekly_counts(entities, [family]), family, scopes)
        .groupBy("week_start", "skill", "category", "role_scope", "_is_total")
        .agg(F.sum("open_postings").alias("open_postings"))
    )
    return shares(by_scope, ["week_start", "role_scope"]).select(
        "week_start", "skill", "category", "role_scope", "open_postings", "share")


def weekly_demand_unscoped(
    obs: DataFrame, tags: DataFrame, key: str = "posting_key", day: str = "collected_date"
) -> DataFrame:
    """The scope of all entities without a family map. Equal to scope 'all' while every family is listed there."""
    tag_sets = tags.groupBy(key).agg(F.collect_set(F.struct("skill", "category")).alias("tags"))
    entities = _weeks(obs, key, day).join(tag_sets, key, "left").withColumn(
        "tags", F.coalesce("tags", F.array().cast("array<struct<skill:string,category:string>>")))
    return shares(weekly_counts(entities, []), ["week_start"]).select(
        "week_start", "skill", "category", "open_postings", "share")


def dense_grid(rows: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Every row of ``rows`` with every distinct ``value``; meant for short lists such as families.

    The list is a scalar subquery, so no cartesian join is planned.
    """
    listed = values.agg(F.collect_set(value)).scalar()
    return rows.withColumn(value, F.explode(listed))


def daily_demand(
    obs: DataFrame,
    facts: DataFrame,
    key: str = "posting_key",
    day: str = "collected_date",
    family: str = "role_family",
) -> DataFrame:
    """Per day with any row and family ever seen: entities seen that day, and entities first seen that day."""
    seen_days = obs.groupBy(key).agg(F.collect_set(day).alias("_days"))
    entities = facts.select(key, family, "first_seen").join(seen_days, key, "left")
    days = obs.select(F.col(day).alias("day")).distinct()
    return daily_cells(entities, family, days)


def daily_cells(entities: DataFrame, family: str, days: DataFrame | None = None) -> DataFrame:
    """``daily_demand`` for entities that already carry the days they were seen on, ``_days``.

    Seen, new and empty cells are added up in one aggregation instead of two joins onto the grid.
    """
    def cell(is_open: int, is_new: int, in_grid: int) -> list[Column]:
        return [F.lit(v).cast("bigint").alias(c) for c, v in
                (("_open", is_open), ("_new", is_new), ("_grid", in_grid))]

    seen = entities.select(F.explode("_days").alias("day"), family, *cell(1, 0, 0))
    new = entities.select(F.col("first_seen").alias("day"), family, *cell(0, 1, 0))
    if days is None:
        days = entities.select(F.explode("_days").alias("day")).distinct()
    empty = dense_grid(days, entities, family).select("day", family, *cell(0, 0, 1))
    return (
        seen.unionByName(new).unionByName(empty)
        .groupBy("day", family)
        .agg(F.sum("_open").alias("open_postings"), F.sum("_new").alias("new_postings"), F.max("_grid").alias("_grid"))
        .where(F.col("_grid") == 1)
        .drop("_grid")
    )
