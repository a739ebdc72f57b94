"""Snapshot views over the given tables, in Spark and in SQL.

``obs_e``  one row per event type, user and day out of ``events``.
``raw_l``  postings out of ``lineitem`` and ``part``: a part is a posting, a ship day a collection day. Titles, places,
           dates and descriptions take every notation the cleaning knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.catalog.base import Tables
from snapdemand.functions.regex import Entry, Rule
from snapdemand.operators.snapshots import dedupe_first
from snapdemand.plans.warehouse import staging

PART_DICTIONARY = [
    Entry("Widget", "shape", r"\bwidget\b"),
    Entry("Gear", "shape", r"\bgears?\b"),
    Entry("Fastener", "shape", r"\b(bolt|rod)\b"),
    Entry("Ring", "shape", r"\bring\b"),
    Entry("Ring", "shape", r"\bred ring\b"),
    Entry("Warm", "look", r"\b(red|hot)\b"),
    Entry("Cold", "look", r"\bcold\b"),
    Entry("Old anvil", "look", r"\bold\s+anvil\b"),
    Entry("Low brand", "brand", r"\bbrand#\d\b"),
    Entry("Spare", "brand", r"(^|[,;#0-9])\s*spare\s*([,;]|$)"),
    Entry("Economy", "line", r"\becono\w+"),
    Entry("Promo", "line", r"\bpromo\b"),
]
RULES = [
    Rule("role_family", 10, r"\b(widget|gizmo)s?\b", "data_engineering"),
    Rule("role_family", 20, r"\bgear\b|\bbolt$", "ai_ml"),
    Rule("role_family", 30, r"\b(ring|rod)\b", "data_analysis"),
    Rule("role_family", 40, r"\b(red|blue)\b", "software"),
    Rule("role_family", 40, r"\banvil\b", "other"),
    Rule("seniority", 10, r"\bsmall\b", "intern"),
    Rule("seniority", 20, r"\bsenior\b", "senior"),
    Rule("seniority", 30, r"\bjunior\b", "junior"),
]
DOC_DICTIONARY = [
    Entry("the", "article", r"\bthe\b"),
    Entry("a", "article", r"\ban?\b"),
    Entry("der", "article", r"\b(der|die|das)\b"),
    Entry("la", "article", r"\b(la|le|les)\b"),
    Entry("and", "joiner", r"\b(and|und|et)\b"),
    Entry("que", "joiner", r"\bque\b"),
    Entry("or", "joiner", r"\bor\b"),
    Entry("that", "joiner", r"\bthat\b"),
    Entry("of", "place", r"\bof\b"),
    Entry("from", "place", r"\b(from|von)\b"),
    Entry("with", "place", r"\bwith\b"),
    Entry("by", "place", r"\bby\b"),
    Entry("in", "place", r"\bin (the|this|that)\b"),
    Entry("zu", "place", r"\bzu\b"),
    Entry("was", "verb", r"\b(is|was|are|be)\b"),
    Entry("mente", "ending", r"\w+mente\b"),
    Entry("tion", "ending", r"tion\."),
    Entry("license", "legal", r"\blicen[sc]ed?\b"),
    Entry("apache", "legal", r"\bapache license\b"),
    Entry("mit", "legal", r"\bmit license\b"),
    Entry("gnu", "legal", r"\bgnu (general|lesser)\b"),
    Entry("version", "legal", r"\bversion\s+\d"),
    Entry("all caps", "noise", r"\bci!!"),
    Entry("token", "noise", r"\btoken\s*="),
    Entry("number", "noise", r"\b\d{3}[-. ]\d{4}\b"),
    Entry("mail", "noise", r"[\w.]+@[\w.]+"),
    Entry("full stop", "noise", r"(^|[,;])\s*the\s*([,;.]|$)"),
    Entry("accent", "noise", r"\bé\w"),
]


def values(rows: list[tuple]) -> str:
    """A SQL VALUES list."""
    def one(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows) + ")"


def dictionary_sql(entries: list[Entry], name: str = "dictionary") -> str:
    return f"{name} AS (SELECT * FROM {values([(e.skill, e.category, e.pattern) for e in entries])} " \
           "AS v(skill, category, pattern))"


RULES_SQL = ("rules AS (SELECT * FROM " + values([(r.field, r.priority, r.pattern, r.value) for r in RULES])
             + " AS v(field, priority, pattern, value))")
SCOPES_SQL = ("scopes AS (SELECT * FROM " + values([(s, f) for s, fs in model.SCOPES.items() for f in fs])
              + " AS v(role_scope, role_family))")
EVENT_SCOPES = {
    "all": ("click", "view", "purchase", "error", "signup"),
    "buying": ("purchase", "signup"),
    "looking": ("click", "view"),
}
EVENT_SCOPES_SQL = ("scopes AS (SELECT * FROM " + values([(s, f) for s, fs in EVENT_SCOPES.items() for f in fs])
                    + " AS v(role_scope, role_family))")


def benchmark_words(t: Tables) -> DataFrame:
    """The benchmark's words of three letters and more, each once: thousands."""
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    return t.benchmark.select(F.explode(found).alias("word")).distinct()


# --- obs_e ------------------------------------------------------------------------------------------------------

OBS_E = """
obs_e AS (
  SELECT event_type || ':' || user_id AS posting_key, event_type AS role_family, CAST(ts AS DATE) AS day,
         event_id, user_id, value
  FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY event_id) = 1)"""


def obs_e(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")).alias("posting_key"),
        F.col("event_type").alias("role_family"), F.col("ts").cast("date").alias("day"),
        "event_id", "user_id", "value")
    return dedupe_first(rows, ["posting_key", "day"], ["event_id"])


# --- raw_l ------------------------------------------------------------------------------------------------------

RAW_L = """
kept_l AS (
  SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS day
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                             ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1),
raw_l AS (
  SELECT p_type AS source_system, 'C' || l_suppkey AS company_key, CAST(l_partkey AS VARCHAR) AS posting_id,
         '  ' || CASE l_returnflag WHEN 'A' THEN 'Senior ' WHEN 'R' THEN 'Junior ' ELSE '' END
              || p_name || chr(160) AS title,
         CASE l_linenumber
           WHEN 1 THEN 'Old Cairo gate' WHEN 2 THEN 'Nasr City' || chr(160)
           WHEN 3 THEN chr(160) || '6th of October mall' WHEN 4 THEN 'Aswan, Egypt'
           WHEN 5 THEN 'Alex or Giza' WHEN 6 THEN '4 Locations' ELSE '' END AS location,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE
         CASE l_orderkey % 10
           WHEN 0 THEN 'Posted Today' WHEN 1 THEN 'POSTED YESTERDAY '
           WHEN 2 THEN 'Posted ' || CAST(l_quantity AS INTEGER) || ' Days Ago'
           WHEN 3 THEN 'posted 30+ days ago' WHEN 4 THEN CAST(day - 3 AS VARCHAR)
           WHEN 5 THEN CAST(day AS VARCHAR) || 'T10:15:00.000+03:00'
           WHEN 6 THEN CAST(epoch_ms(CAST(day AS TIMESTAMP)) + 4000000 AS VARCHAR)
           WHEN 7 THEN strftime(day, '%B  %-d, %Y') WHEN 8 THEN '' ELSE 'not a date' END END AS posted_raw,
         'https://example.com/' || l_orderkey || '/' || l_linenumber AS url,
         CASE WHEN day = min(day) OVER (PARTITION BY l_partkey) THEN
           CASE WHEN p_size % 5 = 0 THEN '   ' ELSE ' ' || p_type || ' ' || p_brand || ' spare, part' END
         END AS description,
         CAST(day AS VARCHAR) AS collected_at
  FROM kept_l JOIN part ON p_partkey = l_partkey)"""


def raw_l(t: Tables) -> DataFrame:
    """Rows are dealt out by their keys before each step that sorts them, to more tasks the more of them there are."""
    tasks = t.tasks_for(t.lineitem)
    lines = t.lineitem.select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("day"), "l_orderkey", "l_linenumber", "l_suppkey",
        "l_quantity", "l_returnflag")
    kept = dedupe_first(lines.repartition(tasks, "l_partkey", "day"), ["l_partkey", "day"],
                        ["l_orderkey", "l_linenumber", "l_suppkey"])
    # both sides of the join below are dealt out alike, else Spark takes the number of the one that is not
    first = lines.groupBy("l_partkey").agg(F.min("day").alias("_first")).repartition(tasks, "l_partkey")
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_brand", "p_size")
    # both sides grow with the data, so neither is to be broadcast
    rows = kept.repartition(tasks, "l_partkey").join(part.join(first, "l_partkey").hint("merge"), "l_partkey")

    nbsp, day = F.lit(chr(160)), F.col("day")
    level = F.when(F.col("l_returnflag") == "A", "Senior ").when(F.col("l_returnflag") == "R", "Junior ").otherwise("")
    places = {1: F.lit("Old Cairo gate"), 2: F.concat(F.lit("Nasr City"), nbsp),
              3: F.concat(nbsp, F.lit("6th of October mall")), 4: F.lit("Aswan, Egypt"),
              5: F.lit("Alex or Giza"), 6: F.lit("4 Locations")}
    notations = [
        F.lit("Posted Today"), F.lit("POSTED YESTERDAY "),
        F.concat(F.lit("Posted "), F.col("l_quantity").cast("int").cast("string"), F.lit(" Days Ago")),
        F.lit("posted 30+ days ago"), F.date_sub(day, 3).cast("string"),
        F.concat(day.cast("string"), F.lit("T10:15:00.000+03:00")),
        (F.unix_date(day).cast("bigint") * 86_400_000 + 4_000_000).cast("string"),
        F.date_format(day, "MMMM  d, yyyy"), F.lit("")]
    return rows.select(
        F.col("p_type").alias("source_system"),
        F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("company_key"),
        F.col("l_partkey").cast("string").alias("posting_id"),
        F.concat(F.lit("  "), level, F.col("p_name"), nbsp).alias("title"),
        _case(F.col("l_linenumber"), places, F.lit("")).alias("location"),
        F.when(F.col("l_linenumber") != 7, _case(
            F.col("l_orderkey") % 10, dict(enumerate(notations)), F.lit("not a date"))).alias("posted_raw"),
        F.concat(F.lit("https://example.com/"), F.col("l_orderkey").cast("string"), F.lit("/"),
                 F.col("l_linenumber").cast("string")).alias("url"),
        F.when(day == F.col("_first"), F.when(F.col("p_size") % 5 == 0, "   ").otherwise(
            F.concat(F.lit(" "), "p_type", F.lit(" "), "p_brand", F.lit(" spare, part")))).alias("description"),
        day.cast("string").alias("collected_at"),
    )


def last_day_l(t: Tables) -> Column:
    """The last collection day of ``raw_l``, read off the one column it comes from."""
    return t.lineitem.agg(F.max(F.col("l_shipdate").cast("date"))).scalar()


def _case(selector: Column, branches: dict[int, Column], otherwise: Column) -> Column:
    chosen = None
    for value, result in branches.items():
        chosen = (F if chosen is None else chosen).when(selector == value, result)
    return chosen.otherwise(otherwise)


# --- staging and models over raw_l ------------------------------------------------------------------------------

PLACE_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in model.PLACES.items()) + "}"


def city_sql(column: str) -> str:
    return (f"coalesce({PLACE_MAP}[regexp_extract(lower({column}), '{'|'.join(model.PLACES)}')], "
            f"CASE WHEN regexp_matches({column}, 'egypt', 'i') THEN '{model.COUNTRY_BUCKET}' END)")


def when_sql(raw: str, day: str) -> str:
    """Each notation is cut out by a pattern of its own, which leaves nothing of any other; the first that gives a date holds."""
    month_first = rf"regexp_extract({raw}, '^[A-Za-z]+\s+[0-9]{{1,2}},\s+[0-9]{{4}}$')"
    return rf"""coalesce(
           {day} - coalesce(MAP {{'posted today': 0, 'posted yesterday': 1}}[lower(trim({raw}))],
                            TRY_CAST(regexp_extract({raw}, '^posted ([0-9]+)[+]? days? ago$', 1, 'i') AS INTEGER)),
           TRY_CAST(regexp_extract({raw}, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) AS DATE),
           CAST(epoch_ms(TRY_CAST(regexp_extract({raw}, '^[0-9]{{12,13}}$') AS BIGINT)) AS DATE),
           CAST(try_strptime(array_to_string(regexp_extract_all({month_first}, '[A-Za-z]+|[0-9]+'), ' '), '%B %d %Y') AS DATE))"""


STG = RAW_L + f""",
stg AS (
  SELECT source_system, company_key, posting_id, concat_ws(':', source_system, posting_id) AS posting_key,
         trim(title) AS title, place AS location, {city_sql("place")} AS city,
         {when_sql("posted_raw", "day")} AS posted_date, url,
         CASE WHEN trim(description) <> '' THEN trim(description) END AS description_clean, day AS collected_date
  FROM (SELECT *, trim(translate(location, chr(160), ' ')) AS place, CAST(collected_at AS DATE) AS day FROM raw_l))"""

# one group per posting: its rows, newest first, as a list of structs, and the days it was seen on
GROUPED = STG + """,
grouped AS (
  SELECT posting_key, list(s ORDER BY collected_date DESC, url DESC) AS all_rows, min(posted_date) AS posted_date,
         list_sort(list_distinct(list(collected_date))) AS days
  FROM stg AS s GROUP BY posting_key)"""

LATEST = GROUPED + """,
latest AS (SELECT unnest(all_rows[1]) FROM grouped)"""

LIFE = LATEST + """,
life AS (
  SELECT posting_key, all_rows[1].company_key AS company_key, all_rows[1].title AS title, all_rows[1].city AS city,
         all_rows[1].url AS url, posted_date, days[1] AS first_seen, days[-1] AS last_seen,
         days[-1] = max(days[-1]) OVER () AS is_open, date_diff('day', days[1], days[-1]) + 1 AS days_open
  FROM grouped)"""

ROLES_TAIL = f""",
{RULES_SQL},
hits AS (
  SELECT posting_key, list(struct_pack(field := field, value := value) ORDER BY priority, value)
           FILTER (regexp_matches(title, pattern, 'i')) AS found
  FROM latest, rules GROUP BY posting_key),
roles AS (
  SELECT posting_key, coalesce([x.value for x in found if x.field = 'role_family'][1], 'other') AS role_family,
         coalesce([x.value for x in found if x.field = 'seniority'][1], 'mid') AS seniority FROM hits)"""
ROLES = LATEST + ROLES_TAIL

SKILLS_TAIL = f""",
{dictionary_sql(PART_DICTIONARY)},
texts AS (
  SELECT posting_key, told[1] AS told
  FROM (SELECT posting_key, [r.description_clean for r in all_rows if r.description_clean IS NOT NULL] AS told FROM grouped)
  WHERE len(told) > 0),
skills AS (
  SELECT posting_key, skill, any_value(category) AS category
  FROM (SELECT posting_key, concat_ws(' ', title, coalesce(told, '')) AS text FROM latest LEFT JOIN texts USING (posting_key)), dictionary
  WHERE regexp_matches(text, pattern, 'i') GROUP BY posting_key, skill)"""
SKILLS = LATEST + SKILLS_TAIL

FACTS = LIFE + ROLES_TAIL + """,
facts AS (FROM life JOIN roles USING (posting_key))"""
BRIDGE_TAIL = SKILLS_TAIL + """,
bridge AS (SELECT posting_key, company_key, skill, category FROM facts JOIN skills USING (posting_key))"""
BRIDGE = FACTS + BRIDGE_TAIL

# a posting's weeks come from its list of days; the size of a week and scope is counted over all of its postings
WEEKLY = BRIDGE + f""",
{SCOPES_SQL},
members AS (
  SELECT *, count(*) OVER (PARTITION BY week_start, role_scope) AS size
  FROM (SELECT posting_key, role_family, unnest(list_distinct([CAST(date_trunc('week', d) AS DATE) for d in days])) AS week_start
        FROM grouped JOIN roles USING (posting_key)) JOIN scopes USING (role_family)),
weekly AS (
  SELECT week_start, skill, category, role_scope, count(*) AS open_postings, count(*) / CAST(max(size) AS DOUBLE) AS share
  FROM members JOIN skills USING (posting_key) GROUP BY week_start, skill, category, role_scope)"""

DAILY_TAIL = """,
by_day AS (
  SELECT day, role_family, count(*) AS n, count(*) FILTER (day = first_seen) AS fresh
  FROM (SELECT posting_key, days[1] AS first_seen, unnest(days) AS day FROM grouped) JOIN roles USING (posting_key) GROUP BY ALL),
daily AS (
  SELECT day, role_family, CAST(coalesce(sum(n), 0) AS BIGINT) AS open_postings, CAST(coalesce(sum(fresh), 0) AS BIGINT) AS new_postings
  FROM (FROM by_day UNION ALL SELECT a.day, b.role_family, 0, 0 FROM by_day AS a, (SELECT DISTINCT role_family FROM facts) AS b)
  GROUP BY ALL)"""
DAILY = FACTS + DAILY_TAIL

DIMENSION = """
dimension AS (
  SELECT 'C' || s_suppkey AS company_key, n_name AS name, r_name AS industry, 'workday' AS source_system
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def stg(t: Tables) -> DataFrame:
    return staging(raw_l(t))


def dimension(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("company_key"),
        F.col("n_name").alias("name"), F.col("r_name").alias("industry"), F.lit("workday").alias("source_system"))
