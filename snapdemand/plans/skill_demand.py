"""The weekly mart for all entities straight from raw snapshots: a second way to the same numbers.

It shares nothing with ``plans.warehouse`` but the cleaning of single values: entities are grouped here, tags come from
a join with the dictionary as a table instead of expressions, totals from a join instead of rows among the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.dates import to_day
from snapdemand.functions.regex import Entry
from snapdemand.functions.text import blank_to_null, trim_zs
from snapdemand.operators.dictionary import tag_by_table
from snapdemand.session import scratch_dir
from snapdemand.sinks import write_table
from snapdemand.sources.files import constants


def skill_demand_weekly(raw: DataFrame, dictionary: Sequence[Entry] | DataFrame) -> DataFrame:
    """week_start, skill, category, open_postings, share over raw snapshot rows; a null in an id makes no posting of its own.

    Raw is read once: one aggregation per posting gives its latest title, its latest description and the weeks it was
    seen in, a set that the calendar bounds. The dictionary may be a table of any size.
    """
    spark, seen = raw.sparkSession, F.struct("day", "title")
    rows = raw.select(
        F.when(F.col("source_system").isNotNull() & F.col("posting_id").isNotNull(), F.struct("source_system", "posting_id")).alias("posting"),
        trim_zs(F.col("title")).alias("title"), blank_to_null(F.col("description")).alias("told"),
        to_day(F.col("collected_at")).alias("day"))
    postings = rows.groupBy("posting").agg(
        F.max_by("title", seen).alias("title"), F.max_by("told", F.when(F.col("told").isNotNull(), seen)).alias("told"),
        F.collect_set(F.date_trunc("week", "day").cast("date")).alias("weeks"))
    text = F.concat("title", F.lit(" "), F.coalesce("told", F.lit("")))
    numbered = write_table(
        postings.select(F.monotonically_increasing_id().alias("n"), text.alias("text"), "weeks"), scratch_dir(spark, "postings"))
    table = dictionary if isinstance(dictionary, DataFrame) else constants(
        spark, [(e.skill, e.category, e.pattern) for e in dictionary], model.DICTIONARY_SCHEMA)
    weeks = numbered.select("n", F.explode("weeks").alias("week_start"))
    sizes = weeks.groupBy("week_start").agg(F.count("*").alias("size"))
    tagged = tag_by_table(numbered, ["n"], "text", table).join(weeks, "n").groupBy("week_start", "skill", "category").agg(
        F.count("*").alias("open_postings"))
    return tagged.join(sizes, "week_start").select(
        "week_start", "skill", "category", "open_postings", (F.col("open_postings") / F.col("size")).alias("share"))
