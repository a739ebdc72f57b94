"""Checks that return the offending rows as (check, severity, key, detail); no row means the check passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import Entry, Rule, matches
from snapdemand.operators.classify import classify


def _failures(df: DataFrame, check: str, key: Column, detail: Column, severity: str | Column = "error") -> DataFrame:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(F.lit(check).alias("check"), level.alias("severity"),
                     key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def _joined(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def check_unique(df: DataFrame, columns: Sequence[str], check: str = "unique") -> DataFrame:
    """Values that occur more than once, with their number. Null values are no duplicates."""
    copies = df.dropna(subset=list(columns)) if len(columns) == 1 else df
    copies = copies.groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1")
    return _failures(copies, check, _joined(columns), F.col("_n"))


def check_not_null(df: DataFrame, column: str, keys: Sequence[str], check: str = "not_null") -> DataFrame:
    return _failures(df.where(F.col(column).isNull()), check, _joined(keys), F.lit(column))


def check_accepted(df: DataFrame, column: str, values: Sequence, check: str = "accepted_values") -> DataFrame:
    """Values outside the list, with their number; null is accepted."""
    others = df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("_n"))
    return _failures(others, check, F.col(column), F.col("_n"))


def check_fk(df: DataFrame, column: str, parent: DataFrame, parent_column: str, check: str = "relationships") -> DataFrame:
    """Values missing in the parent, with their number of rows; null is accepted.

    Rows are counted per value before the join, so a value that fills a third of the table is one row in it.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    missing = values.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")
    return _failures(missing, check, F.col(column), F.col("_n"))


def check_rows(df: DataFrame, condition: Column, keys: Sequence[str], detail: Column,
               check: str, severity: str = "error") -> DataFrame:
    """Rows for which the condition holds; a null condition passes."""
    return _failures(df.where(condition), check, _joined(keys), detail, severity)


def check_no_future(facts: DataFrame, bound: str, key: str = "posting_key", severity: str = "error") -> DataFrame:
    """Posted after the day in column ``bound``."""
    return check_rows(facts, F.col("posted_date") > F.col(bound), [key],
                      F.concat_ws(" > ", F.col("posted_date").cast("string"), F.col(bound).cast("string")),
                      f"posted_after_{bound}", severity)


def check_share(weekly: DataFrame, check: str = "share_range") -> DataFrame:
    return check_rows(weekly, (F.col("share") < 0) | (F.col("share") > 1),
                      ["week_start", "skill", "role_scope"], F.col("share").cast("decimal(18,9)"), check)


def check_latest_has_rows(expected: DataFrame, df: DataFrame, day: str, check: str = "latest_has_rows") -> DataFrame:
    """Names of ``expected`` (one column) without any row on the latest day of ``df``; all of them when it is empty."""
    name = expected.columns[0]
    seen = df.where(F.col(day) == df.agg(F.max(day)).scalar()).select(name).distinct()
    return _failures(expected.join(seen, name, "left_anti"), check, F.col(name), F.lit("latest run has no rows"))


def check_run_has_rows(df: DataFrame, day: str, check: str = "latest_has_rows") -> DataFrame:
    """One row when the latest day is empty, which only happens when the whole table is."""
    found = df.agg(F.count(day).alias("_n"))
    return _failures(found.where("_n = 0"), check, F.lit("all"), F.lit("latest run has no rows"))


def check_golden_tags(cases: DataFrame, dictionary: Sequence[Entry], check: str = "golden_tags") -> DataFrame:
    """Cases (text, skill, should_match) that a pattern of that skill gets wrong; unknown skills are not checked."""
    got = F.filter(F.array(*[
        F.when(F.col("skill") == e.skill, matches(F.col("text"), e.pattern)) for e in dictionary]),
        lambda hit: hit != F.col("should_match"))
    wrong = cases.withColumn("_wrong", F.explode(got))
    return _failures(wrong, check, F.col("text"), F.concat_ws("=", "skill", F.col("should_match").cast("string")))


def check_golden_labels(cases: DataFrame, rules: Sequence[Rule], text: str = "title",
                        defaults: dict[str, str] = model.RULE_DEFAULTS, check: str = "golden_labels") -> DataFrame:
    """Cases (text and one expected column per field) that the rules label differently."""
    expected = cases.withColumnsRenamed({f: f"_want_{f}" for f in defaults})
    got = classify(expected, text, rules, defaults)
    differs = reduce(Column.__or__, [F.col(f) != F.col(f"_want_{f}") for f in defaults])
    return _failures(got.where(differs), check, F.col(text), F.concat(
        F.concat_ws("/", *[f"_want_{f}" for f in defaults]), F.lit(" got "), F.concat_ws("/", *defaults)))


def check_freshness(df: DataFrame, loaded_at: str, now: Column, warn_days: int = model.WARN_AFTER_DAYS,
                    error_days: int = model.ERROR_AFTER_DAYS, check: str = "freshness", by: str | None = None) -> DataFrame:
    """One row when the newest load is older than the limits, or with ``by`` one for each of its values whose newest is.

    ``now`` is a parameter, so runs can be repeated.
    """
    newest = df.groupBy(*([by] if by else [])).agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("_at"))
    age = newest.withColumn("_s", F.timestamp_diff("SECOND", F.col("_at"), now))
    late = age.where(F.col("_s") > warn_days * 86_400)
    return _failures(late, check, F.col(by or "_at"), F.floor(F.col("_s") / 3600),
                     F.when(F.col("_s") > error_days * 86_400, "error").otherwise("warn"))


def check_truncation(totals: DataFrame, keys: Sequence[str], check: str = "truncation") -> DataFrame:
    """Sites of ``totals`` (``sources.payloads.site_totals``) that reported more rows than were read."""
    cut = totals.where("truncated")
    return _failures(cut, check, _joined(keys), F.concat_ws(" of ", F.col("read").cast("string"), F.col("reported").cast("string")), "warn")


def check_any_rows(summaries: DataFrame, check: str = "run_gate") -> DataFrame:
    """Runs in which every source together gave no row."""
    return _failures(summaries.where(F.coalesce("rows", F.lit(0)) == 0), check, F.col("date"),
                     F.lit("no source gave a row"))


def check_same_rows(left: DataFrame, right: DataFrame, check: str = "same_rows") -> DataFrame:
    """Rows of one side without an equal row on the other, copies counted."""
    columns = left.columns
    sided = left.withColumn("_side", F.lit(1)).unionAll(right.select(*columns).withColumn("_side", F.lit(-1)))
    diff = sided.groupBy(*columns).agg(F.sum("_side").alias("_diff")).where("_diff <> 0")
    return _failures(diff, check, _joined(columns), F.when(F.col("_diff") > 0, "left only").otherwise("right only"))


def check_agree(left: DataFrame, right: DataFrame, keys: Sequence[str], exact: Sequence[str], close: Sequence[str],
                tolerance: float = 1e-9, check: str = "agree") -> DataFrame:
    """Keys for which two implementations differ: missing on one side, unequal, or further apart than the tolerance."""
    a = left.select(*keys, F.struct(*exact, *close).alias("_a"))
    b = right.select(*keys, F.struct(*exact, *close).alias("_b"))
    same = [F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")) for c in exact]
    same += [F.coalesce(F.abs(F.col(f"_a.{c}") - F.col(f"_b.{c}")) <= tolerance,
                        F.col(f"_a.{c}").isNull() & F.col(f"_b.{c}").isNull()) for c in close]
    equal = reduce(Column.__and__, same, F.col("_a").isNotNull() & F.col("_b").isNotNull())
    why = F.when(F.col("_a").isNull(), "missing left").when(F.col("_b").isNull(), "missing right").otherwise("differs")
    return _failures(a.join(b, list(keys), "full").where(~equal), check, _joined(keys), why)


def all_failures(*results: DataFrame) -> DataFrame:
    """The failures of several checks as one table."""
    return reduce(DataFrame.unionByName, results)
