"""WIN1-WIN3, TOP1-TOP5, RSH1-RSH3: latest rows, ranks and reshaping over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdemand.catalog.base import query
from snapdemand.catalog.products import facts, saved_weekly, weekly
from snapdemand.catalog.views import (
    DIMENSION, FACTS, LATEST, OBS_E, ROLES, RULES, RULES_SQL, SKILLS, WEEKLY, dimension, obs_e, stg,
)
from snapdemand.operators import rank
from snapdemand.operators.classify import matching_rules
from snapdemand.operators.demand import daily_demand
from snapdemand.operators.lifecycle import latest_row, latest_value
from snapdemand.session import scratch_dir
from snapdemand.sinks import write_ordered
from snapdemand.sources.files import with_position


@query("WIN1_latest_row", f"WITH {LATEST} SELECT * FROM latest")
def win1(t):
    return latest_row(stg(t), ["posting_key"], "collected_date", ["url"])


@query("WIN2_latest_value", f"WITH {SKILLS} SELECT posting_key, told FROM texts")
def win2(t):
    return latest_value(stg(t), ["posting_key"], "collected_date", "description_clean").select(
        "posting_key", F.col("description_clean").alias("told"))


@query("WIN3_ranked_rules", f"""
WITH {RULES_SQL}
SELECT p_partkey, field, priority, value,
       CAST(row_number() OVER (PARTITION BY p_partkey, field ORDER BY priority, value) AS INTEGER) AS rn
FROM part JOIN rules ON regexp_matches(p_name, pattern, 'i')""")
def win3(t):
    return matching_rules(t.part, ["p_partkey"], "p_name", RULES)


@query("TOP1_tags_per_scope", f"""
WITH {WEEKLY} SELECT week_start, role_scope, skill, open_postings FROM weekly
QUALIFY row_number() OVER (PARTITION BY week_start, role_scope ORDER BY open_postings DESC, skill) <= 3""")
def top1(t):
    return rank.top_k(weekly(t), ["week_start", "role_scope"], [F.desc("open_postings"), F.asc("skill")], 3).select(
        "week_start", "role_scope", "skill", "open_postings")


@query("TOP2_companies", f"""
WITH {FACTS}, {DIMENSION}
SELECT name, count(*) AS open_postings FROM facts JOIN dimension USING (company_key) WHERE is_open
GROUP BY name ORDER BY open_postings DESC, name LIMIT 10""")
def top2(t):
    return rank.top_companies(facts(t), dimension(t))


@query("TOP3_trend_of_top", f"""
WITH {WEEKLY}, named AS (
  SELECT skill FROM weekly WHERE role_scope = 'all' AND week_start = (SELECT max(week_start) FROM weekly)
  ORDER BY open_postings DESC, skill LIMIT 4)
SELECT week_start, skill, open_postings FROM weekly JOIN named USING (skill) WHERE role_scope = 'all'""")
def top3(t):
    rows = saved_weekly(t)
    return rank.trend_rows(rows, rank.trend_names(rows, "all", 4), "all")


@query("TOP4_group_counts", f"""
WITH {FACTS} SELECT seniority, count(*) AS open_postings FROM facts WHERE is_open GROUP BY 1 ORDER BY 2 DESC, 1""")
def top4(t):
    return rank.open_by(facts(t), "seniority")


@query("TOP5_total_order", f"""
WITH {WEEKLY} SELECT week_start, skill, open_postings, row_number() OVER (ORDER BY open_postings DESC, week_start, skill) AS position
FROM weekly WHERE role_scope = 'all'""")
def top5(t):
    """The order is a column: each row's place in the files it was written to."""
    path = scratch_dir(t.spark, "order")
    rows = weekly(t).where("role_scope = 'all'").select("week_start", "skill", "open_postings")
    write_ordered(rows, path, [F.desc("open_postings"), "week_start", "skill"])
    return with_position(t.spark, path)


@query("RSH1_aligned_series", f"""
WITH {WEEKLY}, named AS (
  SELECT skill FROM weekly WHERE role_scope = 'tech' AND week_start = (SELECT max(week_start) FROM weekly)
  ORDER BY open_postings DESC, skill LIMIT 10),
cells AS (
  SELECT n.skill, a.week_start, coalesce(w.open_postings, 0) AS n
  FROM named AS n CROSS JOIN (SELECT DISTINCT week_start FROM weekly) AS a
  LEFT JOIN weekly AS w ON w.skill = n.skill AND w.week_start = a.week_start AND w.role_scope = 'tech')
SELECT skill, string_agg(n, ',' ORDER BY week_start) AS series, CAST(count(*) AS INTEGER) AS weeks FROM cells GROUP BY 1""")
def rsh1(t):
    return rank.trend(saved_weekly(t)).select(
        "skill", F.array_join(F.col("series").cast("array<string>"), ",").alias("series"), F.size("weeks").alias("weeks"))


@query("RSH2_dense_daily", f"""
WITH {OBS_E}, seen AS (
  SELECT posting_key, role_family, min(day) AS first, unnest(list_distinct(list(day))) AS day FROM obs_e GROUP BY posting_key, role_family),
axes AS (SELECT unnest(list_distinct(list(day))) AS day, families FROM obs_e, (SELECT list_distinct(list(role_family)) AS families FROM obs_e) GROUP BY families)
SELECT a.day, a.role_family, count(s.posting_key) AS open_postings, count(*) FILTER (s.day = s.first) AS new_postings
FROM (SELECT day, unnest(families) AS role_family FROM axes) AS a LEFT JOIN seen AS s ON s.day = a.day AND s.role_family = a.role_family
GROUP BY ALL""")
def rsh2(t):
    seen = obs_e(t)
    firsts = seen.groupBy("posting_key", "role_family").agg(F.min("day").alias("first_seen"))
    return daily_demand(seen, firsts, day="day")


@query("RSH3_pivot", f"""
WITH {ROLES}
SELECT posting_key, [x.value for x in found if x.field = 'role_family'][1] AS role_family,
       [x.value for x in found if x.field = 'seniority'][1] AS seniority
FROM hits WHERE len(found) > 0""")
def rsh3(t):
    latest = latest_row(stg(t).select("posting_key", "title", "collected_date", "url"), ["posting_key"],
                        "collected_date", ["url"])
    best = matching_rules(latest, ["posting_key"], "title", RULES).where("rn = 1")
    return best.groupBy("posting_key").pivot("field", ["role_family", "seniority"]).agg(F.first("value"))
