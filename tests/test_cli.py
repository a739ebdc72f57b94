"""From landed payloads to the report, by the command line."""

import json

from snapdemand.__main__ import main
from tests.test_ingest import board, landed


def test_two_days_from_payloads_to_report(spark, tmp_path, capsys):
    def path(name):
        return str(tmp_path / name)

    (tmp_path / "companies.json").write_text(json.dumps([
        {"key": "a", "name": "Alpha", "industry": "x", "greenhouse": {"board": "brd"}},
        {"key": "b", "name": "Beta", "industry": "y", "lever": {"site": "s"}}]))
    (tmp_path / "skills.csv").write_text("skill,category,pattern\nKafka,data,\\bkafka\\b\n")
    (tmp_path / "rules.csv").write_text('field,priority,pattern,value\nrole_family,10,"\\bcairo\\b",software\n')
    for i, day in enumerate(("2026-10-07", "2026-10-08")):
        landed(spark, ("greenhouse", "a", 0, board((1, "Kafka"), (2 + i, "other"))), day=day).write.parquet(path(f"landed{i}"))
        code = main(["ingest", "--date", day, "--companies", path("companies.json"), "--payloads", path(f"landed{i}"),
                     "--raw", path("raw")])
        assert code == 0
    assert "ok|1|2" in capsys.readouterr().out.replace(" ", "")
    (tmp_path / "cases.csv").write_text('text,skill,should_match\n"Kafka, Go",Kafka,true\nkafkaesque,Kafka,false\n')
    assert main(["build", "--raw", path("raw"), "--skills", path("skills.csv"), "--rules", path("rules.csv"),
                 "--companies", path("companies.json"), "--out", path("models"), "--tag-cases", path("cases.csv")]) == 0
    assert main(["weekly", "--raw", path("raw"), "--skills", path("skills.csv"), "--out", path("weekly")]) == 0
    weekly = spark.read.parquet(path("weekly")).collect()
    assert [(r.skill, r.open_postings, r.share) for r in weekly] == [("Kafka", 1, 1 / 3)]
    assert main(["report", "--models", path("models"), "--raw", path("raw"), "--out", path("report")]) == 0
    report = json.loads(spark.read.text(path("report")).first().value)
    assert report["coverage"] == {"companies": 1, "companies_tracked": 2, "postings_open": 2}
    assert report["health"]["sources_empty"] == ["b"]
    assert report["roles"] == [{"role_family": "software", "open_postings": 2}]
