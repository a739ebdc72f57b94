"""One row per entity out of its daily rows.

Every function here is one grouped aggregation: rows of a key are combined inside each task before the single shuffle
on the key, so a key that holds a large part of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand.functions.dates import span_days


def _order(day: str, tie: Sequence[str]) -> Column:
    return F.struct(day, *tie)


def latest_row(df: DataFrame, keys: Sequence[str], day: str, tie: Sequence[str] = ()) -> DataFrame:
    """Each key's row of its latest day; among rows of one day the highest ``tie`` wins."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), _order(day, tie)).alias("_row"))
        .select(*keys, "_row.*")
    )


def latest_value(df: DataFrame, keys: Sequence[str], day: str, value: str, tie: Sequence[str] = ()) -> DataFrame:
    """Each key's latest non-null value; keys without one are left out."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(value, _order(day, tie)).alias(value))
    )


def entity_state(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    attrs: Sequence[str],
    earliest: Sequence[str] = (),
    kept: Sequence[str] = (),
    tie: Sequence[str] = (),
    sets: dict[str, Column] | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Everything the models need to know of an entity, in one aggregation.

    ``attrs`` come from the latest row, ``earliest`` are minima over all rows, ``kept`` are latest non-null values,
    which may stem from another row than ``attrs``. ``sets`` are distinct values such as the weeks or days an entity
    was seen on; use them only for values bounded by the calendar. ``rows`` names a column for the number of rows.
    """
    sets, counted = sets or {}, [] if rows is None else [F.count("*").alias(rows)]
    order = _order(day, tie)
    return (
        df.groupBy(*keys)
        .agg(
            F.max_by(F.struct(*attrs), order).alias("_row"),
            *[F.min(c).alias(c) for c in earliest],
            *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in kept],
            F.min(day).alias("first_seen"),
            F.max(day).alias("last_seen"),
            *[F.collect_set(c).alias(name) for name, c in sets.items()],
            *counted,
        )
        .select(*keys, "_row.*", *earliest, *kept, "first_seen", "last_seen", *sets, *([rows] if rows else []))
    )


def with_openness(state: DataFrame, latest_day: Column) -> DataFrame:
    """Adds ``is_open`` (seen on ``latest_day``) and ``days_open``."""
    return state.withColumns({
        "is_open": F.col("last_seen") == latest_day,
        "days_open": span_days(F.col("first_seen"), F.col("last_seen")),
    })


def latest_day(df: DataFrame, day: str) -> Column:
    """The last day of the whole table, as a scalar subquery over that one column."""
    return df.agg(F.max(day)).scalar()


def lifecycle(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    attrs: Sequence[str],
    earliest: Sequence[str] = (),
    tie: Sequence[str] = (),
    last_day: Column | None = None,
) -> DataFrame:
    """First and last day seen, openness and latest attributes of each entity.

    An entity is open when it was seen on the last day of the whole table, so a source that failed on that day looks
    closed. That day is a scalar subquery over ``df``; give ``last_day`` where a cheaper one is at hand, such as the
    maximum of a partition column.
    """
    state = entity_state(df, keys, day, attrs, earliest, tie=tie)
    return with_openness(state, latest_day(df, day) if last_day is None else last_day)
