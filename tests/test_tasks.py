"""Rows of the snapshot view are dealt out to more tasks the more of them there are."""

import datetime
import re

from snapdemand.catalog import base
from snapdemand.catalog.views import raw_l


def test_tasks_grow_with_rows(spark, tmp_path, rows, monkeypatch):
    first = datetime.datetime(1994, 5, 2)
    lines = [(1 + i % 7, 1 + i % 3, i, 1 + i % 4, float(i % 9), "ARN"[i % 3], first + datetime.timedelta(i % 5)) for i in range(200)]
    lines += [(None, 1, 1, 1, 1.0, "A", first), (99, 1, 1, 1, 1.0, "A", first), (1, 1, 1, 1, 1.0, "A", None)]
    spark.createDataFrame(lines, "l_partkey bigint, l_suppkey bigint, l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
                                 "l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, f"part {k}", "TYPE", "Brand#1", k) for k in (*range(1, 8), None)],
                          "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    t = base.Tables(spark, str(tmp_path))
    assert t.tasks_for(t.lineitem) == t.tasks
    few = rows(raw_l(t))
    assert len(few) == 7 * 5 + 1

    monkeypatch.setattr(base, "ROWS", 10)
    many = raw_l(t)
    plan = many._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(l_partkey#\d+L(, day#\d+)?, (\d+)\), REPARTITION_BY_NUM", plan)
    assert [n for day, n in dealt if day] == ["21"] and [n for day, n in dealt if not day] == ["21", "21"]
    assert rows(many) == few
