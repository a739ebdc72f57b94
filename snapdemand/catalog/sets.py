"""SET1-SET3: unions and in-day deduplication over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdemand.catalog.base import query
from snapdemand.catalog.views import OBS_E, obs_e
from snapdemand.operators.snapshots import union_sources
from snapdemand.quality.checks import all_failures, check_accepted, check_unique


@query("SET1_union_failures", """
SELECT 'status' AS check, 'error' AS severity, o_orderstatus AS key, CAST(count(*) AS VARCHAR) AS detail
FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 3
UNION ALL
SELECT 'customer', 'error', CAST(o_custkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM orders GROUP BY o_custkey
HAVING count(*) > 1""")
def set1(t):
    return all_failures(check_accepted(t.orders, "o_orderstatus", ["O", "F"], "status"),
                        check_unique(t.orders, ["o_custkey"], "customer"))


@query("SET2_union_sources", """
SELECT event_type AS source, CAST(event_id AS VARCHAR) AS id, CAST(value AS VARCHAR) AS value FROM events""")
def set2(t):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "id", "value")])
    # one part per source that the table names, and one that has no row
    sources = [r[0] for r in t.events.select("event_type").distinct().collect()] + ["refund"]
    parts = [t.events.where(F.col("event_type") == s).select(
        F.col("event_type").alias("source"), F.col("event_id").alias("id"), "value") for s in sources]
    return union_sources(t.spark, parts, schema)


@query("SET3_dedupe_first", f"WITH {OBS_E} SELECT * FROM obs_e")
def set3(t):
    return obs_e(t)
