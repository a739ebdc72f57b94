"""Labels of texts by priority-ordered rules.

Rules, like dictionary entries, become expressions: the first matching rule is the first true branch, so ranking needs
neither a join nor a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import Rule, matches


def first_rule(text: Column, field: str, rules: Sequence[Rule]) -> Column:
    """The value of the matching rule with the lowest priority, by value among equals; null when none matches."""
    ordered = sorted((r for r in rules if r.field == field), key=lambda r: (r.priority, r.value))
    if not ordered:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(matches(text, r.pattern), F.lit(r.value)) for r in ordered])


def classify(
    df: DataFrame, text: str, rules: Sequence[Rule], defaults: dict[str, str] = model.RULE_DEFAULTS
) -> DataFrame:
    """Adds one column per field in ``defaults``; a text no rule matches gets the default."""
    return df.withColumns({
        field: F.coalesce(first_rule(F.col(text), field, rules), F.lit(default))
        for field, default in defaults.items()})


def matching_rules(df: DataFrame, keys: Sequence[str], text: str, rules: Sequence[Rule]) -> DataFrame:
    """Every rule a text matches, ranked per key and field: (keys, field, priority, value, rn)."""
    ordered = sorted(rules, key=lambda r: (r.field, r.priority, r.value))
    rows = [
        F.when(matches(F.col(text), r.pattern),
               F.struct(F.lit(r.field).alias("field"), F.lit(r.priority).alias("priority"),
                        F.lit(r.value).alias("value")))
        for r in ordered]
    hits = df.select(*keys, F.array_compact(F.array(*rows)).alias("_hits"))
    return (
        hits.select(*keys, "_hits", F.posexplode_outer("_hits").alias("_pos", "_hit"))
        .where(F.col("_hit").isNotNull())
        .select(*keys, "_hit.*", (F.col("_pos") - F.size(F.filter(
            "_hits", lambda h: h["field"] < F.col("_hit")["field"])) + 1).alias("rn"))
    )
