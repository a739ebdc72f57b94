"""The contract of the query catalogue, and the plans of its main queries."""

import os
import re

import pytest

import __spark_entry__ as entry
from snapdemand import catalog

SMALL = "/root/testdata/sf0.001"
IDS = (
    [f"SRC{i}" for i in range(1, 9)] + [f"NRM{i}" for i in range(1, 14)] + [f"SCL{i}" for i in range(1, 29)]
    + [f"FIL{i}" for i in range(1, 10)] + [f"JN{i}" for i in range(1, 14)] + [f"AGG{i}" for i in range(1, 11)]
    + [f"WIN{i}" for i in range(1, 4)] + [f"TOP{i}" for i in range(1, 6)] + [f"SET{i}" for i in range(1, 4)]
    + [f"RSH{i}" for i in range(1, 4)] + [f"SNK{i}" for i in range(1, 7)] + [f"MOD{i}" for i in range(1, 13)]
    + [f"QA{i}" for i in range(1, 16)])


def test_every_operator_has_a_query_with_sql():
    found = {re.match(r"[A-Z]+\d+", n)[0] for n in catalog.QUERIES}
    assert set(IDS) - found == set()
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.SQL) <= set(entry.oracle_sql())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
@pytest.mark.parametrize("name", ["MOD2_lifecycle", "MOD3_roles", "MOD4_skills", "MOD8_skill_demand_weekly", "MOD8_from_models",
                                  "JN1_regex_join", "JN10_first_rule", "QA4_relationships", "SNK2_store_once"])
def test_no_cartesian_join_no_window_over_entities_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_tagging_and_labels_do_not_shuffle(spark):
    from snapdemand.catalog.base import Tables
    from snapdemand.catalog.views import DOC_DICTIONARY, RULES
    from snapdemand.operators.classify import classify
    from snapdemand.operators.tagging import tag

    t = Tables(spark, SMALL)
    assert "Exchange" not in plan(tag(t.documents, ["doc_id"], "text", DOC_DICTIONARY))
    assert "Exchange" not in plan(classify(t.part, "p_name", RULES))


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_flagship(spark):
    assert entry.entry(spark).columns == ["week_start", "skill", "category", "role_scope", "open_postings", "share"]


def test_days_are_pruned(spark, tmp_path):
    from pyspark.sql import functions as F

    from snapdemand import model
    from snapdemand.plans.warehouse import staging
    from snapdemand.sources.files import earlier_days, read_snapshots

    row = tuple("x" for _ in model.POSTING_FIELDS)
    for day in ("2026-10-01", "2026-10-02"):
        spark.createDataFrame([row], model.POSTING_SCHEMA).write.parquet(f"{tmp_path}/date={day}")
    rows = earlier_days(staging(read_snapshots(spark, str(tmp_path))), F.lit("2026-10-02").cast("date"))
    text = plan(rows.select("posting_key"))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ < ", text)
    assert "ReadSchema: struct<source_system:string,posting_id:string>" in text
    assert rows.count() == 1
