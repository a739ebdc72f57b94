"""FIL1-FIL9: filters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.catalog.base import query
from snapdemand.catalog.products import facts, saved_weekly
from snapdemand.catalog.scalars import PLACE_TEXTS, placed
from snapdemand.catalog.views import FACTS, LATEST, STG, WEEKLY, stg
from snapdemand.functions.places import in_region, many_places
from snapdemand.operators import rank
from snapdemand.operators.lifecycle import latest_row

KEEP = f"regexp_matches(coalesce(nullif(location, ''), title, ''), '{model.KEEP_PATTERN}', 'i')"


@query("FIL1_in_region", f"""
WITH {PLACE_TEXTS}, titled AS (
  SELECT o_orderkey, location, 'Cairo ' || (o_orderkey % 2) AS title FROM placed)
SELECT o_orderkey, location FROM titled WHERE {KEEP}""")
def fil1(t):
    title = F.concat(F.lit("Cairo "), (F.col("o_orderkey") % 2).cast("string"))
    return placed(t).where(in_region(F.col("location"), title)).select("o_orderkey", "location")


@query("FIL2_many_places", f"""
WITH {STG} SELECT posting_key, url, location FROM stg
WHERE regexp_full_match(location, '[0-9]+ Locations') OR {KEEP}""")
def fil2(t):
    where = F.col("location")
    return stg(t).where(many_places(where) | in_region(where, F.col("title"))).select("posting_key", "url", "location")


@query("FIL3_described", f"""
WITH {STG} SELECT posting_key, collected_date, description_clean FROM stg WHERE description_clean IS NOT NULL""")
def fil3(t):
    return stg(t).where(F.col("description_clean").isNotNull()).select("posting_key", "collected_date", "description_clean")


@query("FIL4_open", f"WITH {FACTS} SELECT posting_key, company_key, last_seen FROM facts WHERE is_open")
def fil4(t):
    return facts(t).where("is_open").select("posting_key", "company_key", "last_seen")


@query("FIL5_latest_week_of_scope", f"""
WITH {WEEKLY} SELECT skill, category, open_postings, share FROM weekly
WHERE week_start = (SELECT max(week_start) FROM weekly) AND role_scope = 'tech'""")
def fil5(t):
    rows = saved_weekly(t)
    return rows.where((F.col("week_start") == rank.latest_week(rows)) & (F.col("role_scope") == "tech")).select(
        "skill", "category", "open_postings", "share")


@query("FIL6_in_list", f"""
WITH {WEEKLY}, listed AS (
  SELECT skill FROM weekly WHERE role_scope = 'tech' AND week_start = (SELECT max(week_start) FROM weekly)
  ORDER BY open_postings DESC, skill LIMIT 10)
SELECT week_start, skill, open_postings FROM weekly WHERE role_scope = 'tech' AND skill IN (SELECT skill FROM listed)""")
def fil6(t):
    rows = saved_weekly(t)
    return rank.trend_rows(rows, rank.trend_names(rows))


@query("FIL7_rank_one", f"WITH {LATEST} SELECT posting_key, title, collected_date FROM latest")
def fil7(t):
    return latest_row(stg(t).select("posting_key", "title", "collected_date", "url"), ["posting_key"],
                      "collected_date", ["url"]).drop("url")


@query("FIL8_null_tolerant", f"""
WITH {FACTS} SELECT posting_key, posted_date, last_seen FROM facts WHERE NOT coalesce(posted_date > first_seen, false)""")
def fil8(t):
    late = F.coalesce(F.col("posted_date") > F.col("first_seen"), F.lit(False))
    return facts(t).where(~late).select("posting_key", "posted_date", "last_seen")


@query("FIL9_having", "SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def fil9(t):
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n")).where("n > 1")
