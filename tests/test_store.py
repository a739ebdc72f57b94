"""Published versions, and the gate before them."""

import datetime
import glob
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapdemand import model, sinks
from snapdemand.functions.regex import Entry, Rule
from snapdemand.operators.snapshots import known_keys
from snapdemand.plans import warehouse
from snapdemand.quality import audit
from snapdemand.store import WHOLE, Store

SCHEMA = "a string, date date"


def days(store):
    return sorted((str(r.date), r.a) for r in store.read("p", SCHEMA).collect())


@pytest.fixture
def store(spark, tmp_path):
    found = Store(spark, str(tmp_path / "store"))
    version = found.stage()
    version.write(spark.sql("SELECT 'x' AS a, DATE'2026-10-01' AS date UNION ALL SELECT 'y', DATE'2026-10-02'"), "p", by=["date"])
    found.publish(version, {"date=2026-10-01": ["p"], "date=2026-10-02": ["p"]})
    return found


def test_nothing_published_is_an_empty_table(spark, tmp_path):
    empty = Store(spark, str(tmp_path / "none"))
    assert empty.current() == {} and empty.read("p", SCHEMA).collect() == []
    with pytest.raises(ValueError):
        empty.read("p")


def test_a_version_is_invisible_until_it_is_published(spark, store):
    version = store.stage()
    version.write(spark.sql("SELECT 'z' AS a"), "p", "date=2026-10-02")
    assert days(store) == [("2026-10-01", "x"), ("2026-10-02", "y")]
    store.publish(version, {"date=2026-10-02": ["p"]})
    assert days(store) == [("2026-10-01", "x"), ("2026-10-02", "z")]


def test_a_write_that_dies_half_way_leaves_the_old_rows(spark, store):
    version, dies = store.stage(), F.raise_error(F.lit("disk is gone"))
    rows = spark.range(100).repartition(4).select(F.when(F.col("id") < 90, "new").otherwise(dies.cast("string")).alias("a"))
    with pytest.raises(PySparkException):
        version.write(rows, "p", "date=2026-10-02")
    assert days(store) == [("2026-10-01", "x"), ("2026-10-02", "y")]
    assert [tuple(r) for r in store.read("p", SCHEMA).where("date < DATE'2026-10-02'").select("a").collect()] == [("x",)]


def test_all_tables_of_a_part_switch_together(spark, store):
    version = store.stage()
    version.write(spark.sql("SELECT 'z' AS a"), "p", "date=2026-10-02")
    version.write(spark.sql("SELECT 1 AS n"), "q", "date=2026-10-02")
    store.publish(version, {"date=2026-10-02": ["p", "q"]})
    assert store.read("q", "n int, date date").count() == 1
    later = store.stage()
    later.write(spark.sql("SELECT 'w' AS a"), "p", "date=2026-10-02")
    store.publish(later, {"date=2026-10-02": ["p"]})  # a version without q: q is gone from that day
    assert store.read("q", "n int, date date").count() == 0 and days(store)[1] == ("2026-10-02", "w")
    assert len(glob.glob(f"{store.root}/log/*.json")) == 3


def test_days_known_and_summaries_change_in_one_step(spark, tmp_path):
    root = Store(spark, str(tmp_path / "raw"))
    row = ("s", "c", "1", "t", "l", "p", "u", "text", "2026-10-01")
    given = spark.createDataFrame([row], model.POSTING_SCHEMA)
    summary = spark.createDataFrame([("2026-10-01", "t", 1.0, 1, [])], model.RUN_SUMMARY_SCHEMA)
    sinks.write_day(root, "2026-10-01", given, summary)
    assert [(r.posting_id, r.date) for r in sinks.read_described(root).collect()] == [("1", datetime.date(2026, 10, 1))]
    assert sinks.read_summaries(root).first().rows == 1
    sinks.write_day(root, "2026-10-01", given.where("false"), summary.withColumn("rows", F.lit(0).cast("bigint")))
    assert sinks.read_days(root).count() == 0 and sinks.read_described(root).count() == 0
    assert [r.rows for r in sinks.read_summaries(root).collect()] == [0]


def test_earlier_texts_are_not_read_and_a_filter_thins_the_index(spark, tmp_path):
    root, keys = Store(spark, str(tmp_path / "raw")), ["source_system", "posting_id"]
    rows = [("s", "c", str(i), "t", "l", "p", "u", "text", "x", datetime.date(2026, 10, 1 + i % 3)) for i in range(30)]
    sinks.write_days(root, spark.createDataFrame(rows, model.SNAPSHOT_SCHEMA))
    today = sinks.read_days(root).where("date = DATE'2026-10-03'").where(F.col("source_system").isin("s", "t")).select(*keys)
    limits = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        described = sinks.read_described(root).where("date < DATE'2026-10-03'")
        joined = today.join(known_keys(described, keys), keys, "left")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("_known").count() == 0 and joined.count() == 10
    finally:
        for k in limits:
            spark.conf.unset(k)
    assert "might_contain" in text and "description" not in text


ENTRIES = [("Kafka", "data", r"\bkafka\b"), ("Go", "lang", r"\bgo\b")]
RULES = [("role_family", 1, "data", "data_engineering")]


def warehouse_of(spark, store, postings, entries=ENTRIES, rules=RULES, **options):
    raw = spark.createDataFrame([("s", "c", i, t, "Cairo", posted, "u", None, day) for i, t, posted, day in postings], model.POSTING_SCHEMA)
    dimension = spark.createDataFrame([("c", "Co", "x", "s")], model.DIMENSION_SCHEMA)
    found = warehouse.publish(
        raw, spark.createDataFrame(entries, model.DICTIONARY_SCHEMA), spark.createDataFrame(rules, model.RULES_SCHEMA), dimension, store,
        **options)
    return sorted((r.check, r.severity, r.key) for r in found.collect())


GOOD = [("1", "Kafka data", "", "2026-10-01"), ("1", "Kafka data", "", "2026-10-02"), ("2", "Clerk", "", "2026-10-02")]


def test_thirty_one_expectations():
    names = [e.name for e in audit.expectations([], [])] + ["golden"]
    assert len(names) == len(set(names)) == 31


def test_a_good_build_is_published_and_read_back(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    assert warehouse_of(spark, store, GOOD) == []
    assert sorted(r.posting_key for r in store.read("fct_postings").collect()) == ["s:1", "s:2"]
    assert store.read("mart_skill_demand_weekly").count() > 0 and store.read("failures").count() == 0


@pytest.mark.parametrize("broken, check", [
    ({"postings": [*GOOD, ("2", "Clerk", "", "2026-10-02")]}, "staging_unique_per_day"),
    ({"postings": [*GOOD, ("3", "Clerk", "2026-12-01", "2026-10-02")]}, "posted_after_last_seen"),
    ({"postings": [*GOOD, ("3", "Clerk", "", None)]}, "staging_day_not_null"),
    ({"postings": []}, "latest_run_has_rows"),
    ({"entries": [*ENTRIES, ("Go", "lang", r"\bgolang\b")]}, "skills_unique"),
    ({"entries": [*ENTRIES, ("R", None, r"\br\b")]}, "skills_category_not_null"),
    ({"rules": [*RULES, ("shoe_size", 1, "x", "44")]}, "rules_field_accepted"),
    ({"rules": [("role_family", 1, "data", "astronaut")]}, "roles_family_accepted"),
])
def test_a_failing_check_leaves_the_old_version_published(spark, tmp_path, broken, check):
    store = Store(spark, str(tmp_path / "w"))
    warehouse_of(spark, store, GOOD)
    before = store.current()
    found = warehouse_of(spark, store, **{"postings": GOOD, **broken})
    assert check in [name for name, severity, _ in found if severity == "error"]
    assert store.current() == before and store.read("fct_postings").count() == 2


def test_facts_and_bridge_in_buckets_join_without_an_exchange(spark, tmp_path):
    plain, store = Store(spark, str(tmp_path / "plain")), Store(spark, str(tmp_path / "it's in buckets"))
    postings = [*GOOD, *[(str(i), "Kafka and Go data", "", "2026-10-02") for i in range(10, 60)]]
    tables = ("fct_postings", "fct_posting_skills", "mart_skill_demand_weekly", "mart_role_demand_daily")
    assert warehouse_of(spark, plain, postings) == warehouse_of(spark, store, postings, buckets=4) == []
    for t in tables:
        assert sorted(map(repr, store.read(t).collect())) == sorted(map(repr, plain.read(t).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = [warehouse.fct_posting_skills(s.read("fct_posting_skills").drop("company_key"), s.read("fct_postings")) for s in (store, plain)]
        plans = [j._jdf.queryExecution().executedPlan().toString() for j in joined]
        assert "Exchange" not in plans[0] and plans[0].count("Bucketed: true") == 2 and "Exchange" in plans[1]
        assert joined[0].count() == joined[1].count() == store.read("fct_posting_skills").count() == 101
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    version = store.current()[WHOLE][0]
    for t in warehouse.BUCKETED:  # another session without this catalogue
        spark.sql(f"DROP TABLE `{t}_{version.replace('-', '_')}`")
    for t in tables:
        assert sorted(map(repr, store.read(t).collect())) == sorted(map(repr, plain.read(t).collect()))


def test_a_later_version_in_buckets_replaces_the_one_before(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    warehouse_of(spark, store, GOOD, buckets=2)
    refused = warehouse_of(spark, store, [*GOOD, ("2", "Clerk", "", "2026-10-02")], buckets=2)
    assert "staging_unique_per_day" in [name for name, _, _ in refused] and store.read("fct_postings").count() == 2
    warehouse_of(spark, store, [*GOOD, ("3", "Clerk", "", "2026-10-02")], buckets=3)
    assert store.read("fct_postings").count() == 3


def test_a_warning_does_not_stop_a_build(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    late = [("1", "Data", "2026-10-02", "2026-10-01"), ("1", "Data", "2026-10-02", "2026-10-03")]
    assert warehouse_of(spark, store, late) == [("posted_after_first_seen", "warn", "s:1")]
    assert list(store.current()) == [WHOLE] and store.read("failures").count() == 1


def test_golden_cases_gate_too(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    tags = spark.createDataFrame([("Kafka, Go", "Go", True), ("going", "Go", True)], "text string, skill string, should_match boolean")
    labels = spark.createDataFrame([("Data clerk", "data_engineering", "mid"), ("Clerk", "software", "mid")],
                                   "title string, role_family string, seniority string")
    found = warehouse_of(spark, store, GOOD, tag_cases=tags, label_cases=labels)
    assert found == [("golden_labels", "error", "Clerk"), ("golden_tags", "error", "going")] and store.current() == {}


def test_single_row_checks_cost_no_second_scan(spark, tmp_path):
    """Where all metrics are 0, only grouped checks are left to run."""
    expected = audit.expectations([Entry(*e) for e in ENTRIES], [Rule(*r) for r in RULES])
    watch = audit.Audit(expected)
    raw = spark.createDataFrame([("s", "c", i, t, "Cairo", p, "u", None, d) for i, t, p, d in GOOD], model.POSTING_SCHEMA)
    dimension = spark.createDataFrame([("c", "Co", "x", "s")], model.DIMENSION_SCHEMA)
    write = watch.writer(sinks.into(str(tmp_path / "t")))
    warehouse.build(raw, [Entry(*e) for e in ENTRIES], [Rule(*r) for r in RULES], dimension, write, watch=watch.watched)
    assert watch.failures().count() == 0
    assert {e.name for e in expected if e.broken is not None and e.table in watch.tables} == {k for k, v in watch.broken.items() if v == 0}
    json.dumps(watch.broken)
