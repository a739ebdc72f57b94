"""MOD1-MOD12: the products users see, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.catalog.base import Tables, query
from snapdemand.catalog.views import (
    BRIDGE, DAILY, DIMENSION, EVENT_SCOPES, EVENT_SCOPES_SQL, FACTS, LIFE, OBS_E, PART_DICTIONARY, ROLES, RULES, RULES_SQL,
    SKILLS, STG, WEEKLY, benchmark_words, dimension, last_day_l, obs_e, raw_l, stg,
)
from snapdemand.operators import rank
from snapdemand.operators.demand import daily_cells, daily_demand, scoped_demand, weekly_demand
from snapdemand.operators.dictionary import classify_by_table
from snapdemand.operators.lifecycle import lifecycle
from snapdemand.operators.tagging import explode_tags
from snapdemand.plans import warehouse as w
from snapdemand.plans.skill_demand import skill_demand_weekly
from snapdemand.session import scratch_dir
from snapdemand.sinks import write_table
from snapdemand.sources.files import constants


def facts(t: Tables, cleaned: DataFrame | None = None) -> DataFrame:
    return w.posting_facts(stg(t) if cleaned is None else cleaned, RULES, last_day=last_day_l(t))


def bridge(t: Tables) -> DataFrame:
    return explode_tags(entity_table(t), ["posting_key", "company_key"])


def entity_table(t: Tables) -> DataFrame:
    return w.entities(stg(t), PART_DICTIONARY, RULES)


def weekly(t: Tables) -> DataFrame:
    return scoped_demand(entity_table(t))


def saved_weekly(t: Tables) -> DataFrame:
    """The weekly mart as a written table, for reports that read it several times."""
    return write_table(weekly(t), scratch_dir(t.spark, "weekly"))


@query("MOD1_stg_postings", f"WITH {STG} SELECT * FROM stg")
def mod1(t):
    return stg(t)


@query("MOD2_lifecycle", f"WITH {LIFE} SELECT * FROM life")
def mod2(t):
    return w.posting_lifecycle(stg(t), last_day_l(t))


@query("MOD2_lifecycle_events", f"""
WITH {OBS_E},
latest AS (SELECT * FROM obs_e QUALIFY row_number() OVER (PARTITION BY posting_key ORDER BY day DESC) = 1)
SELECT posting_key, l.user_id, l.value, first_seen, last_seen,
       last_seen = (SELECT max(day) FROM obs_e) AS is_open, last_seen - first_seen + 1 AS days_open
FROM latest AS l JOIN (SELECT posting_key, min(day) AS first_seen, max(day) AS last_seen FROM obs_e GROUP BY 1)
USING (posting_key)""")
def mod2_events(t):
    return lifecycle(obs_e(t), ["posting_key"], "day", ["user_id", "value"])


@query("MOD3_roles", f"WITH {ROLES} SELECT * FROM roles")
def mod3(t):
    return w.posting_roles(stg(t), RULES)


@query("MOD3_large_rules", """
WITH rules AS (
  SELECT word, CASE WHEN length(word) % 2 = 0 THEN 'role_family' ELSE 'seniority' END AS field, 20 - length(word) AS priority,
         CASE WHEN length(word) > 6 THEN 'x-' || word ELSE word END AS value
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM benchmark)),
said AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[0-9a-z_]+')) AS word FROM documents),
won AS (SELECT doc_id, field, arg_min(value, (priority, value)) AS value FROM said JOIN rules USING (word) GROUP BY ALL)
SELECT d.doc_id, coalesce(f.value, 'other') AS role_family, coalesce(s.value, 'mid') AS seniority FROM documents AS d
LEFT JOIN won AS f ON f.doc_id = d.doc_id AND f.field = 'role_family' LEFT JOIN won AS s ON s.doc_id = d.doc_id AND s.field = 'seniority'""")
def mod3_large(t):
    """A rule for each word of the benchmark, thousands: the longest word wins, ties by value."""
    word, size = F.col("word"), F.length("word")
    rules = benchmark_words(t).select(
        F.when(size % 2 == 0, "role_family").otherwise("seniority").alias("field"), (20 - size).alias("priority"),
        F.concat(F.lit("\\b"), word, F.lit("\\b")).alias("pattern"),
        F.when(size > 6, F.concat(F.lit("x-"), word)).otherwise(word).alias("value"))
    return classify_by_table(t.documents, ["doc_id"], "text", rules)


@query("MOD3_rules_table", f"""
WITH {RULES_SQL},
hits AS (SELECT p_partkey, field, arg_min(value, (priority, value)) AS value FROM part, rules
         WHERE regexp_matches(p_name, pattern, 'i') GROUP BY ALL)
SELECT p_partkey, coalesce(any_value(value) FILTER (field = 'role_family'), 'other') AS role_family,
       coalesce(any_value(value) FILTER (field = 'seniority'), 'mid') AS seniority
FROM part LEFT JOIN hits USING (p_partkey) GROUP BY p_partkey""")
def mod3_table(t):
    """The example rules as a table: patterns of every kind."""
    rules = constants(t.spark, [(r.field, r.priority, r.pattern, r.value) for r in RULES], model.RULES_SCHEMA)
    return classify_by_table(t.part, ["p_partkey"], "p_name", rules)


@query("MOD4_skills", f"WITH {SKILLS} SELECT * FROM skills")
def mod4(t):
    return w.posting_skills(stg(t), PART_DICTIONARY)


@query("MOD5_dim_company", f"WITH {DIMENSION} SELECT company_key, name, industry, source_system FROM dimension")
def mod5(t):
    return dimension(t)


@query("MOD6_fct_postings", f"WITH {FACTS} SELECT * FROM facts")
def mod6(t):
    return facts(t)


@query("MOD6_from_models", f"WITH {FACTS} SELECT * FROM facts")
def mod6_models(t):
    cleaned = stg(t)
    return w.fct_postings(w.posting_lifecycle(cleaned, last_day_l(t)), w.posting_roles(cleaned, RULES))


@query("MOD7_fct_posting_skills", f"WITH {BRIDGE} SELECT * FROM bridge")
def mod7(t):
    return bridge(t)


@query("MOD7_from_models", f"WITH {BRIDGE} SELECT * FROM bridge")
def mod7_models(t):
    cleaned = stg(t)
    return w.fct_posting_skills(w.posting_skills(cleaned, PART_DICTIONARY), facts(t, cleaned))


@query("MOD8_skill_demand_weekly", f"WITH {WEEKLY} SELECT * FROM weekly")
def mod8(t):
    return weekly(t)


@query("MOD8_from_models", f"WITH {WEEKLY} SELECT * FROM weekly")
def mod8_models(t):
    cleaned = stg(t)
    return weekly_demand(cleaned, facts(t, cleaned), bridge(t))


@query("MOD8_event_demand", f"""
WITH {OBS_E}, {EVENT_SCOPES_SQL},
users AS (
  SELECT posting_key, role_family, list_distinct(list(CAST(date_trunc('week', day) AS DATE))) AS weeks,
         list_distinct(list(if(value >= 20, 'high', 'low'))) AS levels FROM obs_e GROUP BY ALL),
members AS (
  SELECT *, count(*) OVER (PARTITION BY week_start, role_scope) AS size
  FROM (SELECT *, unnest(weeks) AS week_start FROM users) JOIN scopes USING (role_family))
SELECT week_start, skill, role_family AS category, role_scope, count(*) AS open_postings, count(*) / CAST(max(size) AS DOUBLE) AS share
FROM (SELECT *, unnest(levels) AS skill FROM members) GROUP BY ALL""")
def mod8_events(t):
    seen = obs_e(t)
    families = seen.select("posting_key", "role_family").distinct()
    tags = seen.select("posting_key", F.when(F.col("value") >= 20, "high").otherwise("low").alias("skill"),
                       F.col("role_family").alias("category")).distinct()
    return weekly_demand(seen, families, tags, EVENT_SCOPES, day="day")


@query("MOD9_role_demand_daily", f"WITH {DAILY} SELECT * FROM daily")
def mod9(t):
    days = entity_table(t).select("role_family", "first_seen", "_days")
    return daily_cells(write_table(days, scratch_dir(t.spark, "days")), "role_family")


@query("MOD9_from_models", f"WITH {DAILY} SELECT * FROM daily")
def mod9_models(t):
    cleaned = stg(t)
    return daily_demand(cleaned, facts(t, cleaned))


@query("MOD10_weekly_unscoped", f"""
WITH {SKILLS},
weeks AS (
  SELECT *, count(*) OVER (PARTITION BY week_start) AS size
  FROM (SELECT posting_key, unnest(list_distinct([CAST(date_trunc('week', d) AS DATE) for d in days])) AS week_start FROM grouped))
SELECT week_start, skill, category, count(*) AS open_postings, count(*) / CAST(max(size) AS DOUBLE) AS share
FROM weeks JOIN skills USING (posting_key) GROUP BY week_start, skill, category""")
def mod10(t):
    return skill_demand_weekly(raw_l(t), PART_DICTIONARY)


@query("MOD11_top_tags", f"""
WITH {WEEKLY}
SELECT role_scope, skill, category, week_start, open_postings, share,
       CAST(row_number() OVER (PARTITION BY role_scope ORDER BY open_postings DESC, skill) AS INTEGER) AS rank
FROM weekly WHERE week_start = (SELECT max(week_start) FROM weekly)
QUALIFY rank <= 15""")
def mod11_top(t):
    return rank.top_tags(saved_weekly(t))


@query("MOD11_trend", f"""
WITH {WEEKLY},
named AS (
  SELECT skill FROM weekly WHERE role_scope = 'tech' AND week_start = (SELECT max(week_start) FROM weekly)
  ORDER BY open_postings DESC, skill LIMIT 10),
axis AS (SELECT DISTINCT week_start FROM weekly)
SELECT n.skill, a.week_start, coalesce(w.open_postings, 0) AS open_postings
FROM named AS n CROSS JOIN axis AS a
LEFT JOIN weekly AS w ON w.skill = n.skill AND w.week_start = a.week_start AND w.role_scope = 'tech'""")
def mod11_trend(t):
    series = rank.trend(saved_weekly(t))
    return series.select("skill", F.explode(F.arrays_zip("weeks", "series")).alias("c")).select(
        "skill", F.col("c.weeks").alias("week_start"), F.col("c.series").alias("open_postings"))


@query("MOD11_coverage", f"""
WITH {FACTS}, {DIMENSION}
SELECT count(DISTINCT company_key) AS companies, (SELECT count(*) FROM dimension) AS companies_tracked,
       count(*) AS postings_open
FROM facts WHERE is_open""")
def mod11_coverage(t):
    return rank.coverage(facts(t), dimension(t))


@query("MOD11_groups", f"""
WITH {FACTS}
SELECT 'role_family' AS label, role_family AS value, count(*) AS open_postings FROM facts WHERE is_open GROUP BY 2
UNION ALL
SELECT 'seniority', seniority, count(*) FROM facts WHERE is_open GROUP BY 2""")
def mod11_groups(t):
    rows = facts(t)
    parts = [rank.open_by(rows, c).select(F.lit(c).alias("label"), F.col(c).alias("value"), "open_postings")
             for c in ("role_family", "seniority")]
    return parts[0].unionByName(parts[1])
