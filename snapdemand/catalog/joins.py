"""JN1-JN13: joins over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.catalog.base import query
from snapdemand.catalog.products import facts
from snapdemand.catalog.views import (
    BRIDGE_TAIL, DIMENSION, DOC_DICTIONARY, FACTS, OBS_E, RULES, RULES_SQL, SCOPES_SQL, SKILLS, STG,
    benchmark_words, dictionary_sql, dimension, obs_e, stg,
)
from snapdemand.operators.classify import first_rule, matching_rules
from snapdemand.operators.demand import dense_grid, expand_scopes
from snapdemand.operators.dictionary import tag_by_table
from snapdemand.operators.lifecycle import latest_row, latest_value
from snapdemand.operators.snapshots import known_keys
from snapdemand.operators.tagging import tag
from snapdemand.plans.warehouse import posting_skills
from snapdemand.catalog.views import PART_DICTIONARY
from snapdemand.quality.checks import check_latest_has_rows
from snapdemand.session import scratch_dir
from snapdemand.sinks import write_table
from snapdemand.sources.files import constants, read_dictionary


@query("JN1_regex_join", f"""
WITH {dictionary_sql(DOC_DICTIONARY)}
SELECT DISTINCT doc_id, skill, category FROM documents JOIN dictionary ON regexp_matches(text, pattern, 'i')""")
def jn1(t):
    """The given table is one row group or two, so its texts are dealt out before they are tested."""
    return tag(t.documents, ["doc_id"], "text", DOC_DICTIONARY, t.tasks)


def dictionary_table(t):
    """The example dictionary as a file, read as a user's own."""
    path = scratch_dir(t.spark, "skills")
    entries = constants(t.spark, [(e.skill, e.category, e.pattern) for e in DOC_DICTIONARY], model.DICTIONARY_SCHEMA)
    entries.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return read_dictionary(t.spark, path)


@query("JN1_dictionary_table", f"""
WITH {dictionary_sql(DOC_DICTIONARY)}
SELECT skill, any_value(category) AS category, count(*) AS docs, CAST(sum(doc_id) AS BIGINT) AS ids
FROM (SELECT DISTINCT doc_id, skill, category FROM documents, dictionary WHERE regexp_matches(text, pattern, 'i')) GROUP BY skill""")
def jn1_table(t):
    return tag_by_table(t.documents, ["doc_id"], "text", dictionary_table(t)).groupBy("skill").agg(
        F.any_value("category").alias("category"), F.count("*").alias("docs"), F.sum("doc_id").alias("ids"))


@query("JN1_large_dictionary", """
WITH asked AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS skill FROM benchmark),
said AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[0-9a-z_]+')) AS skill FROM documents)
SELECT skill, left(skill, 1) AS category, count(*) AS docs FROM said JOIN asked USING (skill) GROUP BY skill""")
def jn1_large(t):
    """All words of the benchmark as a dictionary: thousands of entries."""
    words = benchmark_words(t).withColumnRenamed("word", "skill")
    boundary = F.lit("\\b")
    entries = words.select("skill", F.left("skill", F.lit(1)).alias("category"),
                                      F.concat(boundary, "skill", boundary).alias("pattern"))
    return tag_by_table(t.documents, ["doc_id"], "text", entries).groupBy("skill", "category").agg(F.count("*").alias("docs"))


@query("JN2_equi", f"""
WITH {FACTS}{BRIDGE_TAIL}
SELECT s.posting_key, skill, f.company_key, f.last_seen FROM skills AS s JOIN facts AS f ON f.posting_key = s.posting_key""")
def jn2(t):
    cleaned = stg(t)
    return posting_skills(cleaned, PART_DICTIONARY).join(facts(t, cleaned), "posting_key").select(
        "posting_key", "skill", "company_key", "last_seen")


@query("JN3_left_with_residual", f"""
WITH {RULES_SQL}, hits AS (
  SELECT p_partkey, field, value, row_number() OVER (PARTITION BY p_partkey, field ORDER BY priority, value) AS rn
  FROM part JOIN rules ON regexp_matches(p_name, pattern, 'i'))
SELECT p.p_partkey, f.value AS role_family, s.value AS seniority FROM part AS p
LEFT JOIN hits AS f ON f.p_partkey = p.p_partkey AND f.field = 'role_family' AND f.rn = 1
LEFT JOIN hits AS s ON s.p_partkey = p.p_partkey AND s.field = 'seniority' AND s.rn = 1""")
def jn3(t):
    best = matching_rules(t.part, ["p_partkey"], "p_name", RULES).where("rn = 1")
    wide = best.groupBy("p_partkey").pivot("field", ["role_family", "seniority"]).agg(F.min("value"))
    return t.part.select("p_partkey").join(wide, "p_partkey", "left")


@query("JN4_left_description", f"""
WITH {SKILLS} SELECT posting_key, title, told FROM latest LEFT JOIN texts USING (posting_key)""")
def jn4(t):
    cleaned = stg(t)
    titles = latest_row(cleaned.select("posting_key", "title", "url", "collected_date"), ["posting_key"],
                        "collected_date", ["url"])
    told = latest_value(cleaned, ["posting_key"], "collected_date", "description_clean")
    return titles.join(told, "posting_key", "left").select("posting_key", "title", F.col("description_clean").alias("told"))


@query("JN5_grid", """
SELECT day, event_type FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
CROSS JOIN (SELECT DISTINCT event_type FROM events)""")
def jn5(t):
    days = t.events.select(F.col("ts").cast("date").alias("day")).distinct()
    return dense_grid(days, t.events, "event_type")


@query("JN6_grid_counts", """
WITH big AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE value > 40 GROUP BY ALL),
     small AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE value < 2 GROUP BY ALL)
SELECT d.day, e.event_type, coalesce(big.n, 0) AS big, coalesce(small.n, 0) AS small
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) AS d CROSS JOIN (SELECT DISTINCT event_type FROM events) AS e
LEFT JOIN big ON big.day = d.day AND big.event_type = e.event_type
LEFT JOIN small ON small.day = d.day AND small.event_type = e.event_type""")
def jn6(t):
    events = t.events.withColumn("day", F.col("ts").cast("date"))
    grid = dense_grid(events.select("day").distinct(), events, "event_type")

    def counted(condition, name):
        return events.where(condition).groupBy("day", "event_type").agg(F.count("*").alias(name))

    joined = grid.join(counted("value > 40", "big"), ["day", "event_type"], "left").join(
        counted("value < 2", "small"), ["day", "event_type"], "left")
    return joined.na.fill(0, ["big", "small"])


@query("JN7_scope_expansion", f"""
WITH {FACTS}, {SCOPES_SQL}
SELECT posting_key, role_scope FROM facts JOIN scopes USING (role_family)""")
def jn7(t):
    return expand_scopes(facts(t), "role_family", model.SCOPES).select("posting_key", "role_scope")


@query("JN8_using", f"""
WITH {FACTS}, {DIMENSION}
SELECT posting_key, name, industry FROM facts JOIN dimension USING (company_key)""")
def jn8(t):
    return facts(t).join(dimension(t), "company_key").select("posting_key", "name", "industry")


@query("JN9_scalar_subquery", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""")
def jn9(t):
    return t.lineitem.where(F.col("l_shipdate") == t.lineitem.agg(F.max("l_shipdate")).scalar()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("JN10_first_rule", f"""
WITH {RULES_SQL}, met AS (
  SELECT p_partkey, field, list(value ORDER BY priority, value) FILTER (regexp_matches(p_name, pattern, 'i')) AS given
  FROM part, rules GROUP BY ALL)
SELECT p_partkey, coalesce(any_value(given[1]) FILTER (field = 'role_family'), 'other') AS role_family,
       coalesce(any_value(given[1]) FILTER (field = 'seniority'), 'mid') AS seniority FROM met GROUP BY p_partkey""")
def jn10(t):
    return t.part.select("p_partkey", *[
        F.coalesce(first_rule(F.col("p_name"), field, RULES), F.lit(default)).alias(field)
        for field, default in model.RULE_DEFAULTS.items()])


@query("JN11_not_exists", f"""
WITH {OBS_E}
SELECT 'latest_has_rows' AS check, 'error' AS severity, CAST(user_id AS VARCHAR) AS key,
       'latest run has no rows' AS detail
FROM (SELECT DISTINCT user_id FROM events) AS u
WHERE NOT EXISTS (SELECT 1 FROM obs_e AS o WHERE o.user_id = u.user_id AND day = (SELECT max(day) FROM obs_e))""")
def jn11(t):
    return check_latest_has_rows(t.events.select("user_id").distinct(), obs_e(t), "day")


@query("JN12_known_before", f"""
WITH {STG}, known AS (
  SELECT DISTINCT source_system, posting_id FROM stg WHERE description_clean IS NOT NULL AND collected_date < DATE '1995-03-01')
SELECT s.source_system, s.posting_id, s.collected_date, k.posting_id IS NOT NULL AS known
FROM stg AS s LEFT JOIN known AS k ON k.source_system = s.source_system AND k.posting_id = s.posting_id
WHERE collected_date >= DATE '1995-03-01'""")
def jn12(t):
    cleaned = stg(t)
    border = F.lit("1995-03-01").cast("date")
    keys = ["source_system", "posting_id"]
    described = described_index(t, cleaned)
    known = known_keys(described.where(F.col("collected_date") < border), keys)
    later = cleaned.where(F.col("collected_date") >= border)
    return later.join(known, keys, "left").select(
        *keys, "collected_date", F.coalesce("_known", F.lit(False)).alias("known"))


def described_index(t, cleaned):
    """The index of described keys by day, written once: what joins with it reads keys only."""
    described = cleaned.where("description_clean is not null").select("source_system", "posting_id", "collected_date")
    return write_table(described, scratch_dir(t.spark, "described"))


@query("JN13_without_parent", """
SELECT doc_id, lang FROM documents AS d WHERE NOT EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = d.doc_id)""")
def jn13(t):
    return t.documents.join(t.labels.select("doc_id"), "doc_id", "left_anti").select("doc_id", "lang")
