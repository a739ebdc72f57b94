"""SCL1-SCL28: column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdemand.catalog.base import query
from snapdemand.catalog.html_sql import html_text_sql, unescape_sql
from snapdemand.catalog.views import (
    DOC_DICTIONARY, OBS_E, RAW_L, RULES, RULES_SQL, SKILLS, city_sql, dictionary_sql, obs_e, raw_l, stg, when_sql,
)
from snapdemand.functions import dates, html, places, regex, text
from snapdemand.operators.dictionary import compiled, matches_column
from snapdemand.operators.snapshots import status
from snapdemand.operators.tagging import tag
from snapdemand.plans.warehouse import posting_texts
from snapdemand.sources.files import constants

ZS = "chr(160) || chr(8195) || chr(12288)"


def padded(t):
    """Names between all kinds of spaces; some are blank, some null."""
    pad = chr(160) + chr(8195) + chr(12288)
    return t.customer.select("c_custkey", F.when(F.col("c_nationkey") % 7 == 0, " " + pad)
                             .when(F.col("c_nationkey") % 7 == 1, F.lit(None))
                             .otherwise(F.concat(F.lit(" " + pad), "c_name", F.lit("\t" + pad + " "))).alias("padded"))


PADDED = f"""
padded AS (
  SELECT c_custkey, CASE WHEN c_nationkey % 7 = 0 THEN ' ' || {ZS} WHEN c_nationkey % 7 = 1 THEN NULL
                         ELSE ' ' || {ZS} || c_name || chr(9) || {ZS} || ' ' END AS padded FROM customer)"""


@query("SCL1_trim", f"WITH {PADDED} SELECT c_custkey, trim(padded) AS trimmed, length(trim(padded)) AS n FROM padded")
def scl1(t):
    trimmed = text.trim_zs(F.col("padded"))
    return padded(t).select("c_custkey", trimmed.alias("trimmed"), F.length(trimmed).cast("bigint").alias("n"))


@query("SCL2_plain_spaces",
       f"WITH {RAW_L} SELECT url, trim(replace(location, chr(160), ' ')) AS location FROM raw_l")
def scl2(t):
    return raw_l(t).select("url", text.plain_spaces(F.col("location")).alias("location"))


@query("SCL3_entity_key", """
SELECT o_orderkey, nullif(o_orderstatus, 'P') || ':' || CAST(o_custkey AS VARCHAR) AS key FROM orders""")
def scl3(t):
    return t.orders.select("o_orderkey", text.entity_key(
        F.nullif("o_orderstatus", F.lit("P")), F.col("o_custkey").cast("string")).alias("key"))


@query("SCL4_to_day", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       TRY_CAST(CASE l_linenumber WHEN 1 THEN 'soon' WHEN 2 THEN '2001-02-30' WHEN 3 THEN NULL
                ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS DATE) AS day FROM lineitem""")
def scl4(t):
    written = F.when(F.col("l_linenumber") == 1, "soon").when(F.col("l_linenumber") == 2, "2001-02-30").when(
        F.col("l_linenumber") > 3, F.col("l_shipdate").cast("date").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.to_day(written).alias("day"))


@query("SCL5_blank_to_null", f"WITH {PADDED} SELECT c_custkey, nullif(trim(padded), '') AS clean FROM padded")
def scl5(t):
    return padded(t).select("c_custkey", text.blank_to_null(F.col("padded")).alias("clean"))


PLACE_TEXTS = """
placed AS (
  SELECT o_orderkey, CASE o_custkey % 9
    WHEN 0 THEN 'Alexandria or Cairo ' || o_orderpriority WHEN 1 THEN 'OLD CAIRO gate' WHEN 2 THEN 'Alex port'
    WHEN 3 THEN 'Smart Village gate ' || o_clerk WHEN 4 THEN 'Aswan, EGYPT' WHEN 5 THEN '6th of October mall'
    WHEN 6 THEN 'Dubai' WHEN 7 THEN '' ELSE NULL END AS location FROM (SELECT *, o_orderstatus AS o_clerk FROM orders))"""


@query("SCL6_canonical_place", f"WITH {PLACE_TEXTS} SELECT o_orderkey, {city_sql('location')} AS city FROM placed")
def scl6(t):
    return placed(t).select("o_orderkey", places.canonical_place(F.col("location")).alias("city"))


def placed(t):
    kind = F.col("o_custkey") % 9
    return t.orders.select(
        "o_orderkey", "o_orderpriority",
        F.when(kind == 0, F.concat(F.lit("Alexandria or Cairo "), "o_orderpriority"))
        .when(kind == 1, "OLD CAIRO gate").when(kind == 2, "Alex port")
        .when(kind == 3, F.concat(F.lit("Smart Village gate "), "o_orderstatus")).when(kind == 4, "Aswan, EGYPT")
        .when(kind == 5, "6th of October mall").when(kind == 6, "Dubai").when(kind == 7, "").alias("location"))


DATED = """
dated AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE o_orderkey % 14
    WHEN 0 THEN 'Posted Today' WHEN 1 THEN '  posted yesterday ' WHEN 2 THEN 'Posted ' || o_custkey || ' Days Ago'
    WHEN 3 THEN 'POSTED 1 DAY AGO' WHEN 4 THEN 'Posted 30+ Days Ago' WHEN 5 THEN ' Posted 3 Days Ago'
    WHEN 6 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    WHEN 7 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T23:59:59.000-11:00'
    WHEN 8 THEN '2001-02-30' WHEN 9 THEN CAST(epoch_ms(o_orderdate) + 86399999 AS VARCHAR)
    WHEN 10 THEN strftime(o_orderdate, '%B   %d,  %Y') WHEN 11 THEN strftime(o_orderdate, '%b %d, %Y x')
    WHEN 12 THEN '' ELSE NULL END AS raw FROM orders)"""


@query("SCL7_parse_when", f"WITH {DATED} SELECT o_orderkey, {when_sql('raw', 'day')} AS posted FROM dated")
def scl7(t):
    kind, day = F.col("o_orderkey") % 14, F.col("o_orderdate").cast("date")
    raw = (
        F.when(kind == 0, "Posted Today").when(kind == 1, "  posted yesterday ")
        .when(kind == 2, F.concat(F.lit("Posted "), F.col("o_custkey").cast("string"), F.lit(" Days Ago")))
        .when(kind == 3, "POSTED 1 DAY AGO").when(kind == 4, "Posted 30+ Days Ago").when(kind == 5, " Posted 3 Days Ago")
        .when(kind == 6, day.cast("string")).when(kind == 7, F.concat(day.cast("string"), F.lit("T23:59:59.000-11:00")))
        .when(kind == 8, "2001-02-30")
        .when(kind == 9, (F.unix_date(day).cast("bigint") * 86_400_000 + 86_399_999).cast("string"))
        .when(kind == 10, F.date_format(day, "MMMM   dd,  yyyy")).when(kind == 11, F.date_format(day, "MMM dd, yyyy 'x'"))
        .when(kind == 12, ""))
    return t.orders.select("o_orderkey", day.alias("day"), raw.alias("raw")).select(
        "o_orderkey", dates.parse_when(F.col("raw"), F.col("day")).alias("posted"))


PATTERN = r"\b(the|und)\s+[a-m]\w*\b|license\.?$"


@query("SCL8_matches", f"SELECT doc_id, regexp_matches(text, '{PATTERN}', 'i') AS hit FROM documents")
def scl8(t):
    return t.documents.select("doc_id", regex.matches(F.col("text"), PATTERN).alias("hit"))


@query("SCL8_pattern_column", f"""
WITH {RULES_SQL}
SELECT p_partkey, count(*) FILTER (regexp_matches(p_name, pattern, 'i')) AS hits, count(*) AS tests FROM part, rules GROUP BY p_partkey""")
def scl8_column(t):
    """The pattern is a column: each row is tested with its own."""
    rules = compiled(constants(t.spark, [(r.pattern,) for r in RULES], "pattern string")).select("_java")
    listed = rules.agg(F.collect_list("_java").alias("patterns"))  # a literal table of eight rows
    rows = t.part.join(F.broadcast(listed)).select("p_partkey", "p_name", F.explode("patterns").alias("java"))
    return rows.groupBy("p_partkey").agg(
        F.count_if(matches_column(F.col("p_name"), F.col("java"))).alias("hits"), F.count("*").alias("tests"))


@query("SCL9_first_match", r"SELECT doc_id, regexp_extract(text, '[A-Z]\w+\s+(of|de|der)\s+\w+') AS found FROM documents")
def scl9(t):
    return t.documents.select("doc_id", regex.first_match(
        F.col("text"), r"[A-Z]\w+\s+(of|de|der)\s+\w+").alias("found"))


@query("SCL10_squeeze", r"SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS squeezed FROM documents")
def scl10(t):
    return t.documents.select("doc_id", regex.squeeze(F.col("text")).alias("squeezed"))


@query("SCL11_regex_dialect", f"""
WITH {dictionary_sql(DOC_DICTIONARY)}
SELECT skill, count(*) AS docs FROM documents JOIN dictionary ON regexp_matches(text, pattern, 'i') GROUP BY skill""")
def scl11(t):
    return tag(t.documents, ["doc_id"], "text", DOC_DICTIONARY, t.tasks).groupBy("skill").agg(F.count("*").alias("docs"))


@query("SCL12_searchable", f"""
WITH {SKILLS} SELECT posting_key, title || ' ' || coalesce(told, '') AS text
FROM latest LEFT JOIN texts USING (posting_key)""")
def scl12(t):
    return posting_texts(stg(t))


@query("SCL13_defaults", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'other') AS status,
       coalesce(nullif(o_custkey, 1), 0) AS customer FROM orders""")
def scl13(t):
    return t.orders.select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("other")).alias("status"),
        F.coalesce(F.nullif("o_custkey", F.lit(1)), F.lit(0)).alias("customer"))


@query("SCL14_first_non_blank", """
SELECT o_orderkey, coalesce(
  nullif(CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN NULL ELSE o_orderstatus END, ''),
  nullif(CASE WHEN o_custkey % 3 = 0 THEN '' ELSE o_orderpriority END, ''), '') AS first FROM orders""")
def scl14(t):
    a = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    b = F.when(F.col("o_custkey") % 3 == 0, "").otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", text.first_non_blank(a, b).alias("first"))


@query("SCL15_html_to_text", f"SELECT page_id, {html_text_sql('html')} AS text FROM pages")
def scl15(t):
    return t.pages.select("page_id", html.html_to_text(F.col("html")).alias("text"))


@query("SCL16_unescape", f"SELECT page_id, {unescape_sql('html')} AS html FROM pages")
def scl16(t):
    return t.pages.select("page_id", html.unescape_entities(F.col("html")).alias("html"))


@query("SCL17_join_distinct", """
SELECT p_partkey, array_to_string(list_distinct_in_order, '; ') AS joined FROM (
  SELECT p_partkey, list_filter(a, lambda x, i: x IS NOT NULL AND list_position(a, x) = i) AS list_distinct_in_order
  FROM (SELECT p_partkey, [split_part(p_name, ' ', 1), p_type, CASE WHEN p_size % 2 = 0 THEN p_brand END,
                           split_part(p_name, ' ', 2), p_type, p_brand] AS a FROM part))""")
def scl17(t):
    parts = F.array(F.split_part("p_name", F.lit(" "), F.lit(1)), "p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")),
                    F.split_part("p_name", F.lit(" "), F.lit(2)), "p_type", "p_brand")
    return t.part.select("p_partkey", text.join_distinct(parts).alias("joined"))


@query("SCL18_keep_items", """
SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: regexp_matches(w, 'tion|ment', 'i')), ' ') AS kept
FROM documents""")
def scl18(t):
    return t.documents.select("doc_id", F.array_join(text.keep_items(F.split("text", " "), "tion|ment"), " ").alias("kept"))


@query("SCL19_sections_text", """
SELECT p_partkey, p_name || ' ' || coalesce(nullif(p_brand, 'Brand#7'), '') || ' ' || p_type AS text FROM part""")
def scl19(t):
    return t.part.select("p_partkey", text.sections_text(
        F.array("p_name", F.nullif("p_brand", F.lit("Brand#7")), "p_type")).alias("text"))


@query("SCL20_epoch_day", """
SELECT event_id, CAST(ts AS DATE) AS of_seconds, CAST(ts AS DATE) AS of_millis,
       CASE WHEN event_type = 'error' THEN '' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS as_text FROM events""")
def scl20(t):
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return t.events.select(
        "event_id", dates.epoch_date(seconds, "s").alias("of_seconds"),
        dates.epoch_date(seconds * 1000 + 999, "ms").alias("of_millis"),
        dates.epoch_text(F.when(F.col("event_type") == "error", 0).otherwise(seconds), "s").alias("as_text"))


@query("SCL21_url_parts", r"""
SELECT page_id, regexp_extract(url, '^\w+://([^/?#:]+)', 1) AS host,
       regexp_extract(url, '([^/]*)$', 1) AS last, 'https://' || regexp_extract(url, '^\w+://([^/?#:]+)', 1) || '/' || page_id AS built
FROM pages""")
def scl21(t):
    host = F.try_parse_url("url", F.lit("HOST"))
    return t.pages.select(
        "page_id", host.alias("host"), text.last_token(F.col("url"), "/").alias("last"),
        F.concat(F.lit("https://"), host, F.lit("/"), F.col("page_id").cast("string")).alias("built"))


@query("SCL22_prefix", "SELECT doc_id, left(text, 10) AS head FROM documents")
def scl22(t):
    return t.documents.select("doc_id", text.prefix(F.col("text"), 10).alias("head"))


@query("SCL23_week_start", """
SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week_start FROM events""")
def scl23(t):
    return t.events.select("event_id", dates.week_start(F.col("ts").cast("date")).alias("week_start"))


@query("SCL24_span_days", """
SELECT l_partkey, CAST(max(l_shipdate) AS DATE) - CAST(min(l_shipdate) AS DATE) + 1 AS days FROM lineitem GROUP BY 1""")
def scl24(t):
    day = F.col("l_shipdate").cast("date")
    return t.lineitem.groupBy("l_partkey").agg(F.min(day).alias("a"), F.max(day).alias("b")).select(
        "l_partkey", dates.span_days(F.col("a"), F.col("b")).alias("days"))


@query("SCL25_ratio", """
SELECT o_custkey, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS share FROM orders GROUP BY 1""")
def scl25(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("a"), F.count("*").alias("b")).select(
        "o_custkey", (F.col("a").cast("double") / F.col("b")).alias("share"))


@query("SCL26_is_latest", f"""
WITH {OBS_E} SELECT posting_key, day, day = (SELECT max(day) FROM obs_e) AS is_latest FROM obs_e""")
def scl26(t):
    seen = obs_e(t)
    return seen.select("posting_key", "day", (
        F.col("day") == t.events.agg(F.max(F.col("ts").cast("date"))).scalar()).alias("is_latest"))


@query("SCL27_age_hours", """
SELECT event_id, date_diff('second', ts, TIMESTAMP '2024-01-31 00:00:00') // 3600 AS hours,
       date_diff('second', ts, TIMESTAMP '2024-01-31 00:00:00') // 3600 > 36 AS stale
FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def scl27(t):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    hours = dates.age_hours(F.date_trunc("second", "ts").cast("timestamp_ntz"), now)
    return t.events.select("event_id", hours.alias("hours"), (hours > 36).alias("stale"))


@query("SCL28_status", f"""
WITH {OBS_E}
SELECT day, kind, CASE WHEN kind = 'refund' THEN 'error' WHEN coalesce(n, 0) > 0 THEN 'ok' ELSE 'empty' END AS status
FROM (SELECT DISTINCT day FROM obs_e) CROSS JOIN (VALUES ('click'), ('signup'), ('import'), ('refund')) AS k(kind)
LEFT JOIN (SELECT day, role_family AS kind, count(*) AS n FROM obs_e WHERE value > 5 GROUP BY ALL) USING (day, kind)""")
def scl28(t):
    kinds = F.array(*[F.lit(k) for k in ("click", "signup", "import", "refund")])
    seen = obs_e(t)
    grid = seen.select("day").distinct().withColumn("kind", F.explode(kinds))
    counts = seen.where("value > 5").groupBy("day", F.col("role_family").alias("kind")).agg(F.count("*").alias("n"))
    return grid.join(counts, ["day", "kind"], "left").select(
        "day", "kind", status(F.coalesce("n", F.lit(0)), F.col("kind") == "refund").alias("status"))
