"""SRC1-SRC8: sources, each over data written from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdemand.catalog.base import Tables, query
from snapdemand.catalog.payloads import supplier_config
from snapdemand.catalog.views import OBS_E, SCOPES_SQL, obs_e, values
from snapdemand.operators import rank
from snapdemand.operators.demand import dense_grid
from snapdemand.operators.snapshots import status
from snapdemand.session import scratch_dir
from snapdemand import model
from snapdemand.sinks import read_described, write_days
from snapdemand.sources.config import config_to_dimension
from snapdemand.sources.files import (
    constants, earlier_days, read_dictionary, read_glob, read_run_summaries, read_snapshots,
)
from snapdemand.store import Store

RAW_E = OBS_E + """,
raw_e AS (
  SELECT role_family AS source_system, 'U' || user_id % 10 AS company_key, CAST(user_id AS VARCHAR) AS posting_id,
         role_family || ' by ' || user_id AS title, 'Cairo' AS location, 'Posted Today' AS posted_raw,
         'e/' || event_id AS url, CASE WHEN value > 20 THEN 'event ' || event_id END AS description,
         CAST(day AS VARCHAR) AS collected_at, day AS date FROM obs_e)"""


def raw_e(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    return obs_e(t).select(
        F.col("role_family").alias("source_system"),
        F.concat(F.lit("U"), (F.col("user_id") % 10).cast("string")).alias("company_key"), user.alias("posting_id"),
        F.concat("role_family", F.lit(" by "), user).alias("title"), F.lit("Cairo").alias("location"),
        F.lit("Posted Today").alias("posted_raw"), F.concat(F.lit("e/"), F.col("event_id").cast("string")).alias("url"),
        F.when(F.col("value") > 20, F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("description"),
        F.col("day").cast("string").alias("collected_at"), F.col("day").alias("date"))


def written_days(t: Tables) -> str:
    """All snapshot days of ``raw_e``, written as hive partitions; the folder's path."""
    root = scratch_dir(t.spark, "raw")
    raw_e(t).write.partitionBy("date").option("compression", "zstd").parquet(root)
    return root


@query("SRC1_hive_scan", f"WITH {RAW_E} SELECT * FROM raw_e")
def src1(t):
    read_snapshots(t.spark, written_days(t), view="raw_postings")
    return t.spark.table("raw_postings")


@query("SRC2_glob_scan", f"""
WITH {RAW_E} SELECT source_system, company_key, count(*) AS n, count(description) AS described FROM raw_e GROUP BY ALL""")
def src2(t):
    return read_glob(t.spark, f"{written_days(t)}/date=*/*.parquet").groupBy("source_system", "company_key").agg(
        F.count("*").alias("n"), F.count("description").alias("described"))


@query("SRC3_dictionary_csv", r"""
SELECT CAST(p_partkey AS VARCHAR) || ' "' || p_name || '"' AS skill, p_type AS category,
       '\b' || replace(p_name, ' ', '\s+') || '\b|"' || p_brand || '", \.net' AS pattern FROM part""")
def src3(t):
    path = scratch_dir(t.spark, "dictionary")
    pattern = F.concat(F.lit(r"\b"), F.replace("p_name", F.lit(" "), F.lit(r"\s+")), F.lit(r'\b|"'), F.col("p_brand"),
                       F.lit(r'", \.net'))
    rows = t.part.select(
        F.concat(F.col("p_partkey").cast("string"), F.lit(' "'), "p_name", F.lit('"')).alias("skill"),
        F.col("p_type").alias("category"), pattern.alias("pattern"))
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return read_dictionary(t.spark, path)


def published_days(t: Tables) -> Store:
    """All snapshot days of ``raw_e``, published with their index of described keys."""
    store = Store(t.spark, scratch_dir(t.spark, "days"))
    write_days(store, raw_e(t))
    return store


@query("SRC4_earlier_days", f"""
WITH {RAW_E} SELECT DISTINCT source_system, posting_id FROM raw_e
WHERE description IS NOT NULL AND date < DATE '2024-01-15'""")
def src4(t):
    """By the index beside each day: no text of an earlier day is read."""
    earlier = earlier_days(read_described(published_days(t)), F.lit("2024-01-15").cast("date"))
    return earlier.select("source_system", "posting_id").distinct()


def event_summaries(t: Tables) -> DataFrame:
    """One run summary per day: the table's sources, one without rows, one that failed. Small: days x sources."""
    seen = obs_e(t)
    kinds = t.events.select(F.col("event_type").alias("key")).union(constants(t.spark, [("import",), ("broken",)], "key string"))
    grid = dense_grid(seen.select("day").distinct(), kinds, "key")
    counts = seen.groupBy("day", F.col("role_family").alias("key")).agg(F.count("*").alias("n"))
    rows = F.coalesce("n", F.lit(0).cast("bigint"))
    broken = F.col("key") == "broken"
    entry = F.struct(
        "key", status(rows, broken).alias("status"), rows.alias("rows"), F.when(broken, "no answer").alias("error"),
        F.lit(0).cast("bigint").alias("describe_errors"), F.lit(False).alias("truncated"),
        F.lit(1.5).alias("duration_s"))
    return grid.join(counts, ["day", "key"], "left").groupBy("day").agg(
        F.sum(rows).alias("rows"), F.sort_array(F.collect_list(entry)).alias("companies")).select(
        F.col("day").cast("string").alias("date"), F.concat(F.col("day").cast("string"), F.lit("T06:00:00")).alias("started_at"),
        F.lit(9.5).alias("duration_s"), "rows", "companies")


SUMMARIES = OBS_E + """,
summaries AS (
  SELECT day, kind, CASE WHEN kind = 'broken' THEN 'error' WHEN coalesce(n, 0) > 0 THEN 'ok' ELSE 'empty' END AS status,
         coalesce(n, 0) AS n
  FROM (SELECT DISTINCT day FROM obs_e)
  CROSS JOIN (SELECT DISTINCT event_type AS kind FROM events UNION ALL VALUES ('import'), ('broken')) AS k
  LEFT JOIN (SELECT day, role_family AS kind, count(*) AS n FROM obs_e GROUP BY ALL) USING (day, kind))"""


def written_summaries(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "summaries")
    days = event_summaries(t).withColumn("d", F.col("date"))
    days.repartition("d").write.partitionBy("d").json(root)
    return read_run_summaries(t.spark, root)


@query("SRC5_run_summaries", f"""
WITH {SUMMARIES} SELECT CAST(day AS VARCHAR) AS date, kind AS key, status, n AS rows FROM summaries""")
def src5(t):
    return rank.source_statuses(written_summaries(t)).select("date", "key", "status", "rows")


@query("SRC6_config_rows", """
SELECT 'C' || s_suppkey AS company_key, s_name AS name, 'I' || s_nationkey AS industry,
       CASE s_suppkey % 3 WHEN 0 THEN 'workday' WHEN 1 THEN 'lever' ELSE 'jibe' END AS source_system FROM supplier""")
def src6(t):
    return config_to_dimension(supplier_config(t))


@query("SRC7_inline_table", f"""
WITH {SCOPES_SQL}, families AS (SELECT DISTINCT role_family FROM scopes),
typed AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'ai_ml' WHEN 'PROMO' THEN 'software' ELSE 'other' END
            AS role_family FROM part)
SELECT role_scope, count(*) AS parts FROM typed JOIN scopes USING (role_family) GROUP BY 1""")
def src7(t):
    scopes = constants(t.spark, [(s, f) for s, fs in model.SCOPES.items() for f in fs],
                       "role_scope string, role_family string")
    family = F.when(F.col("p_type") == "ECONOMY", "ai_ml").when(F.col("p_type") == "PROMO", "software").otherwise("other")
    counts = t.part.groupBy(family.alias("role_family")).agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(scopes), "role_family").groupBy("role_scope").agg(F.sum("n").alias("parts"))


WORDS = [("red", "warm"), ("hot", "warm"), ("blue", "cool"), ("cold", "cool"), ("new", "age"), ("old", "age")]


@query("SRC8_literal_table", f"""
SELECT p_partkey, kind FROM part JOIN {values(WORDS)} AS v(word, kind) ON word = split_part(p_name, ' ', 1)""")
def src8(t):
    words = constants(t.spark, WORDS, "word string, kind string")
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    return t.part.select("p_partkey", first.alias("word")).join(F.broadcast(words), "word").select("p_partkey", "kind")
