"""QA1-QA15: checks over whole tables. Each finds rows: the given tables break these expectations on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdemand.catalog.base import query
from snapdemand.catalog.payloads import supplier_config, workday_payloads
from snapdemand.catalog.products import bridge, facts, weekly
from snapdemand.catalog.scans import SUMMARIES, event_summaries
from snapdemand.catalog.views import (
    BRIDGE, DOC_DICTIONARY, FACTS, OBS_E, RULES, RULES_SQL, STG, WEEKLY, dictionary_sql,
    obs_e, raw_l, stg,
)
from snapdemand.plans.skill_demand import skill_demand_weekly
from snapdemand.catalog.views import PART_DICTIONARY
from snapdemand.quality import checks as qa
from snapdemand.sources.config import config_problems, config_to_dimension
from snapdemand.sources.payloads import SPECS, parse_payloads, site_totals


def failures(check: str, key: str, detail: str, rest: str, severity: str = "'error'") -> str:
    return (f"SELECT '{check}' AS check, {severity} AS severity, CAST({key} AS VARCHAR) AS key, "
            f"CAST({detail} AS VARCHAR) AS detail {rest}")


@query("QA1_unique", failures("unique", "nullif(p_name, 'red ring')", "count(*)",
                              "FROM part WHERE p_name <> 'red ring' GROUP BY nullif(p_name, 'red ring') HAVING count(*) > 1"))
def qa1(t):
    return qa.check_unique(t.part.select(F.nullif("p_name", F.lit("red ring")).alias("name")), ["name"])


@query("QA2_not_null", f"WITH {STG} " + failures(
    "not_null", "posting_key || '|' || collected_date", "'posted_date'", "FROM stg WHERE posted_date IS NULL"))
def qa2(t):
    return qa.check_not_null(stg(t), "posted_date", ["posting_key", "collected_date"])


@query("QA3_accepted_values", f"WITH {FACTS} " + failures(
    "accepted_values", "seniority", "count(*)", "FROM facts WHERE seniority NOT IN ('mid', 'intern') GROUP BY seniority"))
def qa3(t):
    return qa.check_accepted(facts(t), "seniority", ["mid", "intern"])


@query("QA4_relationships", failures(
    "relationships", "doc_id", "count(*)",
    "FROM documents AS d WHERE NOT EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = d.doc_id) GROUP BY doc_id"))
def qa4(t):
    return qa.check_fk(t.documents, "doc_id", t.labels, "doc_id")


@query("QA5_unique_per_day", failures(
    "unique_per_day", "event_type || '|' || user_id || '|' || CAST(ts AS DATE)", "count(*)",
    "FROM events GROUP BY event_type, user_id, CAST(ts AS DATE) HAVING count(*) > 1"))
def qa5(t):
    days = t.events.select("event_type", "user_id", F.col("ts").cast("date").alias("day"))
    return qa.check_unique(days, ["event_type", "user_id", "day"], "unique_per_day")


@query("QA6_unique_bridge", f"WITH {BRIDGE} " + failures(
    "unique_bridge", "company_key || '|' || skill", "count(*)",
    "FROM bridge GROUP BY company_key, skill HAVING count(*) > 1"))
def qa6(t):
    return qa.check_unique(bridge(t), ["company_key", "skill"], "unique_bridge")


def dated(t):
    """Facts whose posting day is moved on by ten years for some companies, so that the checks find rows."""
    moved = F.when(F.col("company_key").endswith("7"), F.add_months("posted_date", 120)).otherwise(F.col("posted_date"))
    return facts(t).withColumn("posted_date", moved)


DATED_FACTS = FACTS + """,
dated AS (SELECT posting_key, first_seen, last_seen, CAST(CASE WHEN company_key LIKE '%7'
            THEN posted_date + INTERVAL 120 MONTH ELSE posted_date END AS DATE) AS posted_date FROM facts)"""


@query("QA7_no_future", f"WITH {DATED_FACTS} " + failures(
    "posted_after_last_seen", "posting_key", "posted_date || ' > ' || last_seen", "FROM dated WHERE posted_date > last_seen")
    + " UNION ALL " + failures(
    "posted_after_first_seen", "posting_key", "posted_date || ' > ' || first_seen",
    "FROM dated WHERE posted_date > first_seen", "'warn'"))
def qa7(t):
    rows = dated(t)
    return qa.all_failures(qa.check_no_future(rows, "last_seen"),
                           qa.check_no_future(rows, "first_seen", severity="warn"))


@query("QA8_share_range", f"WITH {WEEKLY} " + failures(
    "share_range", "week_start || '|' || skill || '|' || role_scope", "CAST(share * 2 AS DECIMAL(18, 9))",
    "FROM weekly WHERE share * 2 < 0 OR share * 2 > 1"))
def qa8(t):
    doubled = weekly(t).withColumn("share", F.col("share") * 2)
    return qa.check_share(doubled)


@query("QA9_latest_has_rows", f"WITH {OBS_E} " + failures(
    "latest_has_rows", "user_id", "'latest run has no rows'",
    "FROM (SELECT DISTINCT user_id FROM events) AS u WHERE user_id NOT IN "
    "(SELECT user_id FROM obs_e WHERE day = (SELECT max(day) FROM obs_e))"))
def qa9(t):
    listed = t.events.select("user_id").distinct()
    return qa.all_failures(qa.check_latest_has_rows(listed, obs_e(t), "day"), qa.check_run_has_rows(obs_e(t), "day"))


@query("QA10_golden_cases", f"""
WITH {dictionary_sql(DOC_DICTIONARY)}, {RULES_SQL},
cases AS (SELECT doc_id || ': ' || text AS text, 'license' AS skill, lang = 'en' AS should_match FROM documents),
given AS (
  SELECT p_partkey, p_name, p_type, field, list(value ORDER BY priority, value) FILTER (regexp_matches(p_name, pattern, 'i')) AS won
  FROM part, rules GROUP BY ALL),
labels_got AS (
  SELECT p_name, if(p_type = 'ECONOMY', 'ai_ml', 'other') AS want_family, 'mid' AS want_level,
    coalesce(any_value(won[1]) FILTER (field = 'role_family'), 'other') AS family,
    coalesce(any_value(won[1]) FILTER (field = 'seniority'), 'mid') AS level FROM given GROUP BY p_partkey, p_name, p_type)
""" + failures("golden_tags", "text", "c.skill || '=' || should_match",
               "FROM cases AS c JOIN dictionary AS d ON d.skill = c.skill WHERE regexp_matches(text, pattern, 'i') <> should_match")
    + " UNION ALL " + failures(
        "golden_labels", "p_name", "want_family || '/' || want_level || ' got ' || family || '/' || level",
        "FROM labels_got WHERE family <> want_family OR level <> want_level"))
def qa10(t):
    cases = t.documents.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(": "), "text").alias("text"), F.lit("license").alias("skill"),
        (F.col("lang") == "en").alias("should_match"))
    titles = t.part.select(
        F.col("p_name").alias("title"), F.when(F.col("p_type") == "ECONOMY", "ai_ml").otherwise("other").alias("role_family"),
        F.lit("mid").alias("seniority"))
    return qa.all_failures(qa.check_golden_tags(cases, DOC_DICTIONARY), qa.check_golden_labels(titles, RULES))


@query("QA11_freshness", """
SELECT 'freshness' AS check, CASE WHEN s > 2 * 86400 THEN 'error' ELSE 'warn' END AS severity, source AS key,
       CAST(s // 3600 AS VARCHAR) AS detail
FROM (SELECT event_type AS source, date_diff('second', max(CAST(ts AS DATE)), TIMESTAMP '2024-02-01 06:00:00') AS s
      FROM events GROUP BY 1)
WHERE s > 86400""")
def qa11(t):
    now = F.lit("2024-02-01 06:00:00").cast("timestamp_ntz")
    return qa.check_freshness(t.events.withColumn("day", F.col("ts").cast("date")), "day", now, by="event_type")


@query("QA12_truncation", failures(
    "truncation", "'workday|' || p_brand", "2 * count(*) || ' of ' || max(p_size * 5)",
    "FROM part GROUP BY p_brand HAVING max(p_size * 5) > 2 * count(*)", "'warn'"))
def qa12(t):
    """Responses that report five times as many postings: what was read is what the parser counted."""
    payloads = workday_payloads(t, total=F.col("p_size") * 5)
    totals = site_totals(parse_payloads(payloads, {"workday": SPECS["workday"]}))
    return qa.check_truncation(totals, ["source_system", "company_key"])


@query("QA13_run_gate", f"""WITH {SUMMARIES} """ + failures(
    "run_gate", "day", "'no source gave a row'",
    "FROM (SELECT day, sum(n) AS n FROM summaries WHERE kind = 'import' GROUP BY 1) WHERE n = 0"))
def qa13(t):
    only = event_summaries(t).select("date", F.aggregate(
        F.filter("companies", lambda c: c["key"] == "import"), F.lit(0).cast("bigint"), lambda a, c: a + c["rows"]).alias("rows"))
    return qa.check_any_rows(only)


@query("QA14_config", """
SELECT 'one_known_system' AS check, 'error' AS severity, 'C' || s_suppkey AS key, 'jibe' AS detail
FROM supplier WHERE s_suppkey % 3 = 2
UNION ALL
SELECT 'same_rows', 'error', 'C' || s_suppkey || '|' || s_name || '|' || CASE s_suppkey % 3 WHEN 0 THEN 'workday' WHEN 1 THEN 'lever'
         ELSE 'jibe' END, 'left only' FROM supplier WHERE s_nationkey = 3""")
def qa14(t):
    entries = supplier_config(t)
    named = config_to_dimension(entries).select("company_key", "name", "source_system", "industry")
    listed = named.where("industry <> 'I3'").drop("industry")
    return qa.all_failures(config_problems(entries, ["workday", "lever"]),
                           qa.check_same_rows(named.drop("industry"), listed))


@query("QA15_agreement", f"""
WITH {WEEKLY}, both_ways AS (SELECT week_start, skill, category FROM weekly WHERE role_scope = 'all'),
tech AS (SELECT week_start, skill, category, open_postings FROM weekly WHERE role_scope = 'tech')
SELECT 'agree' AS check, 'error' AS severity, a.week_start || '|' || a.skill AS key,
       CASE WHEN t.skill IS NULL THEN 'missing right' ELSE 'differs' END AS detail
FROM weekly AS a LEFT JOIN tech AS t ON t.week_start = a.week_start AND t.skill = a.skill
WHERE a.role_scope = 'all' AND (t.skill IS NULL OR t.open_postings <> a.open_postings
  OR abs(a.share - (SELECT any_value(w.share) FROM weekly AS w WHERE w.role_scope = 'tech'
                    AND w.week_start = a.week_start AND w.skill = a.skill)) > 1e-9)""")
def qa15(t):
    """The unscoped mart against scope 'tech' of the other: they differ wherever a posting is in no tech family."""
    other = weekly(t).where("role_scope = 'tech'")
    return qa.check_agree(skill_demand_weekly(raw_l(t), PART_DICTIONARY), other, ["week_start", "skill"],
                          ["category", "open_postings"], ["share"])


@query("QA15_two_ways", f"""
WITH {WEEKLY} SELECT week_start, skill, open_postings FROM weekly WHERE role_scope = 'all'""")
def qa15_same(t):
    """Rows of the unscoped mart that the scoped one confirms: all of them."""
    ours = skill_demand_weekly(raw_l(t), PART_DICTIONARY)
    scoped = weekly(t).where("role_scope = 'all'")
    wrong = qa.check_agree(ours, scoped, ["week_start", "skill"], ["category", "open_postings"], ["share"])
    keyed = ours.withColumn("key", F.concat_ws("|", F.col("week_start").cast("string"), "skill"))
    return keyed.join(wrong.select("key"), "key", "left_anti").select("week_start", "skill", "open_postings")
