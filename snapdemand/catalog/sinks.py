"""SNK1-SNK6 and MOD12: writers and the daily ingest, as round trips of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdemand import sinks
from snapdemand.catalog.base import Tables, query
from snapdemand.catalog.joins import described_index
from snapdemand.catalog.payloads import obj, payload, text
from snapdemand.catalog.products import facts, weekly
from snapdemand.catalog.scans import RAW_E, SUMMARIES, event_summaries, published_days, raw_e
from snapdemand.catalog.views import (
    DAILY_TAIL, DIMENSION, OBS_E, PART_DICTIONARY, RULES, STG, WEEKLY, dimension, obs_e, raw_l, stg,
)
from snapdemand.operators.rank import health, source_statuses
from snapdemand.operators.snapshots import store_once
from snapdemand.plans.ingest import ingest_day
from snapdemand.plans.report import report_document
from snapdemand.plans.warehouse import build
from snapdemand.session import scratch_dir
from snapdemand.sources.files import with_position
from snapdemand.store import Store


@query("SNK1_overwrite_day", f"""
WITH {RAW_E} SELECT date, source_system, posting_id, url FROM raw_e
WHERE date <> DATE '2024-01-10' AND (date <> DATE '2024-01-20' OR source_system = 'click')""")
def snk1(t):
    store = published_days(t)
    rows = raw_e(t).drop("date")
    sinks.write_day(store, "2024-01-10", rows.where("false"))
    sinks.write_day(store, "2024-01-20", rows.where("collected_at = '2024-01-20' and source_system = 'click'"))
    return sinks.read_days(store).select("date", "source_system", "posting_id", "url")


@query("SNK2_store_once", f"""
WITH {STG}, told AS (
  SELECT source_system, posting_id, min(collected_date) AS first FROM stg GROUP BY ALL),
known AS (SELECT DISTINCT source_system, posting_id FROM stg JOIN part ON CAST(p_partkey AS VARCHAR) = posting_id
          WHERE collected_date < DATE '1995-02-01' AND p_size % 5 > 0)
SELECT s.source_system, s.posting_id, s.collected_date,
       CASE WHEN k.posting_id IS NULL THEN coalesce(s.description_clean, 'detail of ' || s.posting_id) END AS description
FROM stg AS s LEFT JOIN (SELECT DISTINCT source_system, posting_id FROM stg
                         WHERE description_clean IS NOT NULL AND collected_date < DATE '1995-02-01') AS k
  ON k.source_system = s.source_system AND k.posting_id = s.posting_id
WHERE s.collected_date >= DATE '1995-02-01'""")
def snk2(t):
    rows = stg(t).select("source_system", "posting_id", "collected_date", F.col("description_clean").alias("description"))
    border = F.lit("1995-02-01").cast("date")
    described = described_index(t, stg(t)).where(F.col("collected_date") < border)
    return store_once(rows.where(F.col("collected_date") >= border), described, ["source_system", "posting_id"], "description",
                      F.concat(F.lit("detail of "), "posting_id"))


@query("SNK3_run_summary", f"""
WITH {SUMMARIES} SELECT kind AS key, status, n AS rows FROM summaries WHERE day = (SELECT max(day) FROM summaries)""")
def snk3(t):
    """A day is published with its summary, then again with a new one: both switch together."""
    store = Store(t.spark, scratch_dir(t.spark, "summary"))
    summaries, rows = event_summaries(t), raw_e(t)
    day = rows.agg(F.max("collected_at")).first()[0]
    today, latest = rows.where(F.col("collected_at") == day).drop("date"), summaries.where(F.col("date") == day)
    sinks.write_day(store, day, today.where("false"), latest.withColumn("rows", F.lit(0).cast("bigint")))
    sinks.write_day(store, day, today, latest)
    return source_statuses(sinks.read_summaries(store)).select("key", "status", "rows")


@query("SNK4_warehouse_tables", f"""
WITH {WEEKLY}{DAILY_TAIL}, {DIMENSION}
SELECT 'fct_postings' AS model, company_key AS key, count(*) AS n FROM facts GROUP BY 2
UNION ALL SELECT 'fct_posting_skills', skill, count(*) FROM bridge GROUP BY 2
UNION ALL SELECT 'mart_skill_demand_weekly', role_scope, CAST(sum(open_postings) AS BIGINT) FROM weekly GROUP BY 2
UNION ALL SELECT 'mart_role_demand_daily', role_family, CAST(sum(open_postings + 1000 * new_postings) AS BIGINT) FROM daily GROUP BY 2
UNION ALL SELECT 'dim_company', name || '/' || industry, count(*) FROM dimension GROUP BY 2""")
def snk4(t):
    models = build(raw_l(t), PART_DICTIONARY, RULES, dimension(t), sinks.into(scratch_dir(t.spark, "warehouse")))

    def counts(df: DataFrame, name: str, key: str, n) -> DataFrame:
        return df.groupBy(F.col(key).alias("key")).agg(n.alias("n")).select(F.lit(name).alias("model"), "key", "n")

    return (
        counts(models.fct_postings, "fct_postings", "company_key", F.count("*"))
        .unionByName(counts(models.fct_posting_skills, "fct_posting_skills", "skill", F.count("*")))
        .unionByName(counts(models.mart_skill_demand_weekly, "mart_skill_demand_weekly", "role_scope",
                            F.sum("open_postings")))
        .unionByName(counts(models.mart_role_demand_daily, "mart_role_demand_daily", "role_family",
                            F.sum(F.col("open_postings") + 1000 * F.col("new_postings"))))
        .unionByName(counts(models.dim_company.withColumn("who", F.concat_ws("/", "name", "industry")), "dim_company", "who", F.count("*"))))


@query("SNK5_report_document", f"""
WITH {WEEKLY}, {DIMENSION}, {SUMMARIES},
newest AS (SELECT max(week_start) AS w FROM weekly), axis AS (SELECT DISTINCT week_start FROM weekly),
named AS (SELECT skill FROM weekly, newest WHERE week_start = w AND role_scope = 'tech' ORDER BY open_postings DESC, skill LIMIT 10),
series AS (SELECT n.skill, a.week_start, coalesce(open_postings, 0) AS n FROM named AS n CROSS JOIN axis AS a
  LEFT JOIN weekly AS w ON w.skill = n.skill AND w.week_start = a.week_start AND role_scope = 'tech'),
last_run AS (SELECT * FROM summaries WHERE day = (SELECT max(day) FROM summaries)), opened AS (SELECT * FROM facts WHERE is_open)
SELECT 'generated_at' AS section, '' AS key, '2024-02-01T00:00:00+00:00' AS value
UNION ALL SELECT 'coverage', 'companies', CAST(count(DISTINCT company_key) AS VARCHAR) FROM opened
UNION ALL SELECT 'coverage', 'companies_tracked', CAST(count(*) AS VARCHAR) FROM dimension
UNION ALL SELECT 'coverage', 'postings_open', CAST(count(*) AS VARCHAR) FROM opened
UNION ALL SELECT 'skills_week_start', '', CAST(w AS VARCHAR) FROM newest
UNION ALL (SELECT 'skills_this_week', role_scope || ':' || skill || '/' || category, CAST(open_postings AS VARCHAR) FROM weekly, newest
  WHERE week_start = w QUALIFY row_number() OVER (PARTITION BY role_scope ORDER BY open_postings DESC, skill) <= 15)
UNION ALL SELECT 'skill_trend', '', string_agg(week_start, ',' ORDER BY week_start) FROM axis
UNION ALL SELECT 'skill_trend', skill, string_agg(n, ',' ORDER BY week_start) FROM series GROUP BY skill
UNION ALL SELECT 'roles', role_family, CAST(count(*) AS VARCHAR) FROM opened GROUP BY role_family
UNION ALL SELECT 'seniority', seniority, CAST(count(*) AS VARCHAR) FROM opened GROUP BY seniority
UNION ALL (SELECT 'top_companies', name, CAST(count(*) AS VARCHAR) FROM opened JOIN dimension USING (company_key)
  GROUP BY name ORDER BY count(*) DESC, name LIMIT 10)
UNION ALL SELECT 'health', 'last_run', any_value(CAST(day AS VARCHAR)) || 'T06:00:00' FROM last_run
UNION ALL SELECT 'health', 'rows', CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) FROM last_run
UNION ALL SELECT 'health', 'ok', CAST(count(*) FILTER (status = 'ok') AS VARCHAR) FROM last_run
UNION ALL SELECT 'health', 'empty', coalesce(string_agg(kind, ',' ORDER BY kind) FILTER (status = 'empty'), '') FROM last_run
UNION ALL SELECT 'health', 'failed', coalesce(string_agg(kind, ',' ORDER BY kind) FILTER (status = 'error'), '') FROM last_run""")
def snk5(t):
    """All nine sections of the document as read back from the file, a row for each figure."""
    # every dataset of the document is small; the marts behind them are written once and read by each
    folder = scratch_dir(t.spark, "report")
    document = report_document(
        sinks.write_table(weekly(t), f"{folder}/weekly"), sinks.write_table(facts(t), f"{folder}/facts"), dimension(t),
        event_summaries(t), "2024-02-01T00:00:00+00:00")
    sinks.write_document(document, f"{folder}/document")
    counts = "array<struct<{} string, open_postings bigint>>".format
    schema = (
        "generated_at string, coverage map<string, bigint>, skills_week_start string, skills_this_week map<string, "
        "array<struct<skill string, category string, open_postings bigint>>>, skill_trend struct<weeks array<string>, "
        f"series map<string, array<bigint>>>, roles {counts('role_family')}, seniority {counts('seniority')}, "
        f"top_companies {counts('name')}, health struct<last_run string, rows bigint, sources_ok int, "
        "sources_empty array<string>, sources_failed array<string>>")
    read = t.spark.read.text(f"{folder}/document").select(F.from_json("value", schema).alias("d")).select("d.*")

    def entry(section: str, key, value):
        key = F.lit(key) if isinstance(key, str) else key
        return F.struct(F.lit(section).alias("section"), key.alias("key"), value.cast("string").alias("value"))

    def joined(values):
        return F.array_join(values.cast("array<string>"), ",")

    def counted(section: str, name: str):
        return F.transform(section, lambda r: entry(section, r[name], r["open_postings"]))

    week = F.flatten(F.transform(F.map_entries("skills_this_week"), lambda s: F.transform(s["value"], lambda r: entry(
        "skills_this_week", F.concat(s["key"], F.lit(":"), r["skill"], F.lit("/"), r["category"]), r["open_postings"]))))
    run = F.col("health")
    rows = F.concat(
        F.array(entry("generated_at", "", F.col("generated_at")), entry("skills_week_start", "", F.col("skills_week_start")),
                entry("skill_trend", "", joined(F.col("skill_trend.weeks"))), entry("health", "last_run", run["last_run"]),
                entry("health", "rows", run["rows"]), entry("health", "ok", run["sources_ok"]),
                entry("health", "empty", joined(run["sources_empty"])), entry("health", "failed", joined(run["sources_failed"]))),
        F.transform(F.map_entries("coverage"), lambda e: entry("coverage", e["key"], e["value"])), week,
        F.transform(F.map_entries("skill_trend.series"), lambda e: entry("skill_trend", e["key"], joined(e["value"]))),
        counted("roles", "role_family"), counted("seniority", "seniority"), counted("top_companies", "name"))
    return read.select(F.inline(rows))


@query("SNK6_ordered_file", f"""
WITH {WEEKLY} SELECT week_start, skill, role_scope, open_postings, share,
       row_number() OVER (ORDER BY week_start, skill, role_scope) AS position FROM weekly""")
def snk6(t):
    path = scratch_dir(t.spark, "ordered")
    sinks.write_ordered(weekly(t).drop("category"), path, ["week_start", "skill", "role_scope"])
    return with_position(t.spark, path)


@query("MOD11_health", f"""
WITH {SUMMARIES}, latest AS (SELECT * FROM summaries WHERE day = (SELECT max(day) FROM summaries))
SELECT any_value(CAST(day AS VARCHAR)) || 'T06:00:00' AS last_run, CAST(sum(n) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE status = 'ok') AS INTEGER) AS sources_ok,
       string_agg(kind, ',' ORDER BY kind) FILTER (WHERE status = 'empty') AS sources_empty,
       string_agg(kind, ',' ORDER BY kind) FILTER (WHERE status = 'error') AS sources_failed FROM latest""")
def mod11_health(t):
    return health(event_summaries(t)).withColumns({
        c: F.array_join(c, ",") for c in ("sources_empty", "sources_failed")})


# --- MOD12 ------------------------------------------------------------------------------------------------------
# Each event is one landed response. Clicks come from a board with texts, signups and views from systems whose texts
# need a second response, purchases from one without texts; errors do not parse, and 'idle' gave no response at all.

DAY = "2024-02-01"
SYSTEM = {"click": "greenhouse", "view": "workday", "signup": "smartrecruiters", "purchase": "phenom", "error": "jibe"}


def landed(t: Tables) -> DataFrame:
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    title = F.concat(F.lit("Giza "), user)
    documents = {
        "click": (obj(jobs=F.array(obj(
            id=F.col("user_id"), title=title, location=obj(name=text()), first_published=text(), updated_at=text(),
            absolute_url=F.concat(F.lit("https://b/"), event),
            content=F.when(F.col("value") > 5, F.concat(F.lit("&lt;p&gt;text &amp;amp; "), event, F.lit("&lt;/p&gt;")))))),
            {"board": F.lit("b")}),
        "view": (obj(total=F.lit(1), jobPostings=F.array(obj(
            title=title, externalPath=F.concat(F.lit("/job/x_"), user), locationsText=F.lit("2 Locations"), postedOn=text()))),
            {"host": F.lit("w.example.com"), "tenant": F.lit("w"), "site": F.lit("s")}),
        "signup": (obj(totalFound=F.lit(10**9), content=F.array(obj(
            id=user, name=title, releasedDate=text(), location=obj(fullLocation=F.lit("Cairo"))))), {"company": F.lit("S")}),
        "purchase": (obj(refineSearch=obj(totalHits=F.lit(1), data=obj(jobs=F.array(
            obj(jobId=user, title=title, cityStateCountry=F.when(F.col("user_id") % 2 == 0, "Dubai").otherwise("Giza"),
                location=text(), postedDate=text()))))), {"host": F.lit("p")}),
        "error": (obj(totalCount=F.lit(1), jobs=F.lit("not a list")), {"host": F.lit("j")}),
    }
    parts = [
        payload(t.events.where(F.col("event_type") == kind), SYSTEM[kind], F.lit(kind), config, document, DAY,
                F.col("event_id")).withColumn("source_order", F.lit(i))
        for i, (kind, (document, config)) in enumerate(documents.items())]
    return reduce(DataFrame.unionByName, parts)


def landed_details(t: Tables) -> DataFrame:
    """Second responses: every third user has none, every third has one that does not parse."""
    users = t.events.select("user_id").distinct().where("user_id % 3 > 0")
    user, good = F.col("user_id").cast("string"), F.col("user_id") % 3 == 1
    views = users.select(
        F.lit("workday").alias("source_system"),
        F.concat(F.lit("https://w.example.com/wday/cxs/w/s/job/x_"), user).alias("url"),
        F.when(good, F.to_json(obj(jobPostingInfo=obj(jobDescription=F.concat(F.lit("<p>view "), user, F.lit("</p>"))))))
        .otherwise("{").alias("json"))
    sections = F.concat(F.lit('{"jobAd": {"sections": {"b": {"text": "<b>signup</b>"}, "a": {"title": "t", "text": "'), user,
                        F.lit('"}}}}'))
    signups = users.select(
        F.lit("smartrecruiters").alias("source_system"),
        F.concat(F.lit("https://api.smartrecruiters.com/v1/companies/S/postings/"), user).alias("url"),
        F.when(good, sections).otherwise("{").alias("json"))
    return views.unionByName(signups)


def ingest_events(t: Tables) -> tuple[DataFrame, Store]:
    """Runs the ingest of ``DAY`` on top of earlier days; the summary and the published days."""
    store = Store(t.spark, scratch_dir(t.spark, "raw"))
    earlier = obs_e(t).where("role_family in ('click', 'view', 'signup')").select(
        F.create_map(*[F.lit(x) for p in SYSTEM.items() for x in p])[F.col("role_family")].alias("source_system"),
        F.col("role_family").alias("company_key"),
        F.when(F.col("role_family") == "click", F.concat(F.lit("b:"), F.col("user_id").cast("string")))
        .when(F.col("role_family") == "view", F.concat(F.lit("w:"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string")).alias("posting_id"),
        text("t").alias("title"), text("Giza").alias("location"), text("").alias("posted_raw"), text("u").alias("url"),
        F.when(F.col("value") > 60, "known").alias("description"), F.col("day").cast("string").alias("collected_at"),
        F.col("day").alias("date"))
    sinks.write_days(store, earlier)
    companies = t.spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("company_key"), F.lit(i).alias("source_order")) for i, k in enumerate((*SYSTEM, "idle"))
    ])).alias("c")).select("c.*")
    return ingest_day(landed(t), companies, store, DAY, landed_details(t)), store


INGESTED = OBS_E + """,
known AS (SELECT DISTINCT role_family, user_id FROM obs_e WHERE value > 60),
users AS (
  SELECT DISTINCT event_type AS company_key, user_id FROM events
  WHERE event_type NOT IN ('error') AND (event_type <> 'purchase' OR user_id % 2 = 1)),
clicked AS (
  SELECT user_id, arg_min(event_id, event_id) AS event_id, arg_min(value, event_id) AS value FROM events
  WHERE event_type = 'click' GROUP BY 1),
day_rows AS (
  SELECT u.company_key, u.user_id, k.user_id IS NOT NULL AS is_known,
         CASE WHEN k.user_id IS NULL AND u.user_id % 3 = 1 AND u.company_key = 'view' THEN 'view ' || u.user_id
              WHEN k.user_id IS NULL AND u.user_id % 3 = 1 AND u.company_key = 'signup' THEN 'signup ' || u.user_id
              WHEN k.user_id IS NULL AND u.company_key = 'click' AND c.value > 5 THEN 'text & ' || c.event_id
         END AS description,
         u.company_key IN ('view', 'signup') AND k.user_id IS NULL AND u.user_id % 3 <> 1 AS describe_error
  FROM users AS u LEFT JOIN known AS k ON k.role_family = u.company_key AND k.user_id = u.user_id
  LEFT JOIN clicked AS c ON c.user_id = u.user_id)"""


@query("MOD12_ingest_day", f"""
WITH {INGESTED}
SELECT company_key, CASE company_key WHEN 'click' THEN 'b:' WHEN 'view' THEN 'w:' WHEN 'purchase' THEN 'p:' ELSE '' END
       || user_id AS posting_id, 'Giza ' || user_id AS title,
       description FROM day_rows""")
def mod12(t):
    _, store = ingest_events(t)
    day = sinks.read_days(store).where(F.col("date") == F.lit(DAY).cast("date"))
    return day.select("company_key", "posting_id", "title", "description")


@query("MOD12_run_summary", f"""
WITH {INGESTED}
SELECT key, status, coalesce(n, 0) AS rows, coalesce(errors, 0) AS describe_errors, key = 'signup' AS truncated
FROM (VALUES ('click', 'ok'), ('view', 'ok'), ('signup', 'ok'), ('purchase', 'ok'), ('error', 'error'), ('idle', 'empty'))
  AS v(key, status)
LEFT JOIN (SELECT company_key AS key, count(*) AS n, count(*) FILTER (WHERE describe_error) AS errors FROM day_rows GROUP BY 1)
USING (key)""")
def mod12_summary(t):
    summary, _ = ingest_events(t)
    return source_statuses(summary).select("key", "status", "rows", "describe_errors", "truncated")
