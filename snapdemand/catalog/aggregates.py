"""AGG1-AGG10: aggregations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdemand.catalog.base import query
from snapdemand.catalog.products import facts
from snapdemand.catalog.views import FACTS, LATEST, OBS_E, STG, obs_e, stg
from snapdemand.functions.dates import week_start
from snapdemand.operators.demand import weekly_demand_unscoped


@query("AGG1_seen", f"""
WITH {STG} SELECT posting_key, min(collected_date) AS first_seen, max(collected_date) AS last_seen,
                  min(posted_date) AS posted_date FROM stg GROUP BY 1""")
def agg1(t):
    return stg(t).groupBy("posting_key").agg(
        F.min("collected_date").alias("first_seen"), F.max("collected_date").alias("last_seen"),
        F.min("posted_date").alias("posted_date"))


@query("AGG2_max_by", f"WITH {LATEST} SELECT posting_key, title FROM latest")
def agg2(t):
    return stg(t).groupBy("posting_key").agg(F.max_by("title", F.struct("collected_date", "url")).alias("title"))


@query("AGG3_count", f"WITH {FACTS} SELECT role_family, seniority, count(*) AS n FROM facts GROUP BY ALL")
def agg3(t):
    return facts(t).groupBy("role_family", "seniority").agg(F.count("*").alias("n"))


@query("AGG4_count_distinct", """
SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL""")
def agg4(t):
    return t.events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.count_distinct("user_id").alias("users"))


@query("AGG5_global_counts", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders")
def agg5(t):
    return t.orders.agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("AGG6_global_max", "SELECT CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem")
def agg6(t):
    return t.lineitem.agg(F.max(F.col("l_shipdate").cast("date")).alias("last_day"))


STATUSES = """
statuses AS (
  SELECT role_family AS key, day, CASE WHEN count(*) FILTER (WHERE value > 200) > 0 THEN 'error'
                                  WHEN count(*) > 50 THEN 'ok' ELSE 'empty' END AS status FROM obs_e GROUP BY ALL)"""


@query("AGG7_by_status", f"""
WITH {OBS_E}, {STATUSES}
SELECT day, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'empty') AS empty,
       count(*) FILTER (WHERE status = 'error') AS failed,
       array_to_string(list_sort(list(key) FILTER (WHERE status = 'error')), ',') AS failed_keys
FROM statuses GROUP BY day""")
def agg7(t):
    # the list of a day holds sources, of which there are as many as event types
    statuses = obs_e(t).groupBy("day", F.col("role_family").alias("key")).agg(
        F.when(F.count_if(F.col("value") > 200) > 0, "error").when(F.count("*") > 50, "ok").otherwise("empty").alias("status"))
    failed = F.sort_array(F.collect_set(F.when(F.col("status") == "error", F.col("key"))))
    return statuses.groupBy("day").agg(
        *[F.count_if(F.col("status") == s).alias(n) for s, n in (("ok", "ok"), ("empty", "empty"), ("error", "failed"))],
        F.nullif(F.array_join(failed, ","), F.lit("")).alias("failed_keys"))


@query("AGG8_sum", """
SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1""")
def agg8(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.sum("l_linenumber").alias("lines"))


@query("AGG9_distinct", """
SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, user_id FROM events""")
def agg9(t):
    return t.events.select(week_start(F.col("ts").cast("date")).alias("week_start"), "event_type", "user_id").distinct()


@query("AGG10_share", f"""
WITH {OBS_E},
in_week AS (SELECT DISTINCT CAST(date_trunc('week', day) AS DATE) AS week_start, posting_key FROM obs_e),
tags AS (SELECT DISTINCT posting_key, 'over ' || CAST(floor(value / 20) AS INTEGER) * 20 AS skill, 'v' AS category
         FROM obs_e WHERE value >= 20)
SELECT week_start, skill, category, count(*) AS open_postings, CAST(count(*) AS DOUBLE) / any_value(total) AS share
FROM in_week JOIN tags USING (posting_key)
JOIN (SELECT week_start, count(*) AS total FROM in_week GROUP BY 1) USING (week_start)
GROUP BY week_start, skill, category""")
def agg10(t):
    seen = obs_e(t)
    tags = seen.where("value >= 20").select(
        "posting_key", F.concat(F.lit("over "), (F.floor(F.col("value") / 20) * 20).cast("string")).alias("skill"),
        F.lit("v").alias("category")).distinct()
    return weekly_demand_unscoped(seen, tags, day="day")
