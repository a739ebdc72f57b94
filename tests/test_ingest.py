"""Payload readers, the daily ingest, writers and config."""

import datetime
import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from snapdemand import model, sinks
from snapdemand.operators.snapshots import dedupe_first, store_once, union_sources
from snapdemand.plans.ingest import ingest_day
from snapdemand.plans.report import report_document
from snapdemand.plans.warehouse import build
from snapdemand.quality import checks as qa
from snapdemand.sources import files
from snapdemand.sources.config import config_problems, config_to_dimension, read_config, site_configs
from snapdemand.sources.payloads import PAYLOAD_SCHEMA, SPECS, attach_details, normalise, parse_payloads, site_totals
from snapdemand.store import Store

CONFIG = {"host": "h.example.com", "tenant": "ten", "site": "careers", "board": "brd", "account": "acc",
          "company": "Cmp", "job_url": "https://o.example.com/job/"}

# One response per system with the fields missing, null or blank that real ones leave out.
RESPONSES = {
    "workday": {"total": 3, "jobPostings": [
        {"title": "A", "externalPath": "/job/Cairo/A_b_R1", "locationsText": "3 Locations", "postedOn": None},
        {"title": "Giza baker", "externalPath": None, "locationsText": None},
        {"title": "B", "externalPath": "/x", "locationsText": "Paris"}]},
    "smartrecruiters": {"totalFound": 9, "content": [
        {"id": "1", "name": "Cairo job", "releasedDate": None, "location": None},
        {"id": "2", "name": "B", "releasedDate": "2026-09-28T00:00:00Z", "location": {"fullLocation": "Giza, Egypt"}}]},
    "oracle_cloud": {"items": [{"TotalJobsCount": 1, "requisitionList": [
        {"Id": 77, "Title": "T", "PostedDate": "2026-09-07", "PrimaryLocation": "GIZA, Egypt"}]}]},
    "eightfold": {"data": {"count": 1, "positions": [
        {"id": 5, "name": "N", "locations": ["Cairo,Egypt", "Paris", "Maadi,Cairo"], "postedTs": 1790640000,
         "positionUrl": "/careers/job/5"},
        {"id": 6, "name": "N", "locations": None, "postedTs": None, "positionUrl": "/x"}]}},
    "jibe": {"totalCount": 1, "jobs": [{"data": {"slug": 468, "title": "T", "full_location": "", "city": "Minya",
             "country": "Egypt", "posted_date": "2026-09-07T01:02:03", "description": "<b>Over</b>view"}}]},
    "phenom": {"refineSearch": {"totalHits": 500, "data": {"jobs": [
        {"jobId": "9", "title": "T", "cityStateCountry": "", "location": "Alexandria", "postedDate": None}]}}},
    "amazon": {"hits": 1, "jobs": [
        {"id_icims": "3", "title": "T", "location": "EG, Luxor", "country_code": "EGY", "posted_date": "March  5, 2026",
         "job_path": "/en/jobs/3", "description": None}]},
    "greenhouse": {"jobs": [
        {"id": 4, "title": " T ", "location": {"name": " Cairo "}, "first_published": "", "updated_at": "2026-09-02",
         "absolute_url": "https://g/4", "content": "&lt;p&gt;R&amp;amp;D&lt;/p&gt;"}]},
    "lever": [
        {"id": "u1", "text": "T ", "categories": {"location": " Remote", "allLocations": ["Giza", "Remote", ""]},
         "createdAt": 1712345600000, "description": "<p>a</p>", "lists": [{"text": "Need", "content": "<li>x</li>"}],
         "additional": None, "hostedUrl": "https://l/u1"},
        {"id": "u2", "text": "Cairo", "categories": None, "createdAt": 0, "hostedUrl": "https://l/u2"}],
    "ashby": {"jobs": [
        {"id": "a1", "title": "T", "location": "HQ", "secondaryLocations": None,
         "address": {"postalAddress": {"addressCountry": "Egypt"}}, "publishedAt": "2026-09-28T10:15:00.000+00:00",
         "jobUrl": "https://a/1", "descriptionHtml": "<p> </p>", "descriptionPlain": "plain"}]},
    "workable": {"jobs": [
        {"shortcode": "S1", "title": "T", "city": "Cairo", "country": "Egypt", "locations": [], "published_on": "2026-09-28",
         "url": "https://w/1", "description": "<br>"}]},
}
# system -> (posting_id, title, location, posted_raw, url, description) per kept row
EXPECTED = {
    "workday": [
        ("ten:/job/Cairo/A", None, None, None, None, None)],
    "smartrecruiters": [
        ("1", "Cairo job", "", "", "https://jobs.smartrecruiters.com/Cmp/1", None),
        ("2", "B", "Giza, Egypt", "2026-09-28", "https://jobs.smartrecruiters.com/Cmp/2", None)],
    "oracle_cloud": [("h.example.com:77", "T", "GIZA, Egypt", "2026-09-07", "https://o.example.com/job/77", None)],
    "eightfold": [("h.example.com:5", "N", "Cairo,Egypt; Maadi,Cairo", "2026-09-29",
                   "https://h.example.com/careers/job/5", None)],
    "jibe": [("h.example.com:468", "T", "Minya, Egypt", "2026-09-07", "https://h.example.com/main/jobs/468", "Over view")],
    "phenom": [("h.example.com:9", "T", "Alexandria", "", "https://h.example.com/global/en/job/9", None)],
    "amazon": [("3", "T", "EG, Luxor, Egypt", "March  5, 2026", "https://www.amazon.jobs/en/jobs/3", None)],
    "greenhouse": [("brd:4", "T", "Cairo", "2026-09-02", "https://g/4", "R&D")],
    "lever": [("u1", "T", "Remote; Giza", "2024-04-05", "https://l/u1", "a Need x"),
              ("u2", "Cairo", "", "", "https://l/u2", None)],
    "ashby": [("a1", "T", "HQ, Egypt", "2026-09-28T10:15:00.000+00:00", "https://a/1", "plain")],
    "workable": [("acc:S1", "T", "Cairo, Egypt", "2026-09-28", "https://w/1", None)],
}
EXPECTED["workday"] = [
    ("ten:R1", "A", "3 Locations", "", "https://h.example.com/en-US/careers/job/Cairo/A_b_R1", None),
    ("ten:", "Giza baker", "", "", "https://h.example.com/en-US/careers", None)]


def landed(spark, *responses, day="2026-10-08"):
    """(system, company, order, json text or object)"""
    return spark.createDataFrame(
        [(s, c, o, 1, CONFIG, j if isinstance(j, str) else json.dumps(j), day) for s, c, o, j in responses], PAYLOAD_SCHEMA)


@pytest.mark.parametrize("system", sorted(SPECS))
def test_each_system_maps_its_own_fields(spark, system):
    df = normalise(landed(spark, (system, "co", 0, RESPONSES[system])), SPECS[system])
    got = [tuple(r) for r in df.orderBy("position").select(
        "posting_id", "title", "location", "posted_raw", "url", "description").collect()]
    assert got == EXPECTED[system]
    assert df.select("source_system", "company_key", "collected_at").distinct().collect() == [(system, "co", "2026-10-08")]


def test_all_systems_in_one_pass(spark):
    parsed = parse_payloads(landed(spark, *[(s, s, 0, r) for s, r in RESPONSES.items()], ("unknown", "u", 0, {})), SPECS)
    got = {r.source_system: (r.failed, len(r.postings or [])) for r in parsed.collect()}
    assert got == {**{s: (False, len(e)) for s, e in EXPECTED.items()}, "unknown": (True, 0)}
    cut = {r.source_system for r in site_totals(parsed).where("truncated").collect()}
    assert cut == {"smartrecruiters", "phenom"}


@pytest.mark.parametrize("system", sorted(SPECS))
def test_broken_responses_are_marked(spark, system):
    parsed = parse_payloads(landed(spark, (system, "co", 0, "{not json"), (system, "co", 0, "[" if system != "lever" else "3")), SPECS)
    assert [r.failed for r in parsed.collect()] == [True, True]


def companies(spark, *keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "company_key string, source_order int")


def board(*jobs):
    return {"jobs": [{"id": i, "title": f"Cairo {i}", "absolute_url": f"https://g/{i}", "content": c} for i, c in jobs]}


def run(spark, folder, day, *responses, details=None, keys=("a", "b", "idle")):
    store = Store(spark, f"{folder}/raw")
    summary = ingest_day(landed(spark, *responses, day=day), companies(spark, *keys), store, day, details).first()
    written = {r.posting_id: r.description for r in sinks.read_days(store).where(
        F.col("date") == F.lit(day).cast("date")).collect()}
    return summary, written


def test_ingest_isolates_failures_and_counts_copies_once(spark, tmp_path):
    summary, written = run(
        spark, tmp_path, "2026-10-08", ("greenhouse", "a", 0, board((1, "x"), (1, "y"))), ("jibe", "b", 1, "{"),
        ("greenhouse", "b", 1, board((7, "lost with its company"))))
    assert written == {"brd:1": "x"}
    assert [(c.key, c.status, c.rows, c.truncated) for c in summary.companies] == [
        ("a", "ok", 1, False), ("b", "error", 0, False), ("idle", "empty", 0, False)]
    assert (summary.date, summary.rows) == ("2026-10-08", 1)


def test_description_is_stored_once(spark, tmp_path):
    run(spark, tmp_path, "2026-10-07", ("greenhouse", "a", 0, board((1, "old"))))
    _, second = run(spark, tmp_path, "2026-10-08", ("greenhouse", "a", 0, board((1, "again"), (2, "new"))))
    assert second == {"brd:1": None, "brd:2": "new"}
    _, third = run(spark, tmp_path, "2026-10-09", ("greenhouse", "a", 0, board((1, "again"), (2, "again"))))
    assert third == {"brd:1": None, "brd:2": None}


def test_rerun_replaces_its_day_only_and_ignores_it(spark, tmp_path):
    run(spark, tmp_path, "2026-10-07", ("greenhouse", "a", 0, board((1, "old"))))
    before = {f: open(f, "rb").read() for f in glob.glob(f"{tmp_path}/raw/postings/*/date=2026-10-07/*.parquet")}
    assert before
    run(spark, tmp_path, "2026-10-08", ("greenhouse", "a", 0, board((2, "x"), (3, "y"))))
    _, again = run(spark, tmp_path, "2026-10-08", ("greenhouse", "a", 0, board((3, "y"))))
    assert again == {"brd:3": "y"}
    assert {f: open(f, "rb").read() for f in before} == before


def test_details_fill_missing_descriptions(spark, tmp_path):
    base = "https://h.example.com/wday/cxs/ten/careers/job/x_"
    details = spark.createDataFrame([
        ("workday", base + "R1", json.dumps({"jobPostingInfo": {"jobDescription": "<p>one</p>"}})),
        ("workday", base + "R2", "{")], "source_system string, url string, json string")
    jobs = {"total": 3, "jobPostings": [
        {"title": "Cairo", "externalPath": f"/job/x_R{i}", "locationsText": "Giza"} for i in (1, 2, 3)]}
    summary, written = run(spark, tmp_path, "2026-10-08", ("workday", "a", 0, jobs), details=details)
    assert written == {"ten:R1": "one", "ten:R2": None, "ten:R3": None}
    assert summary.companies[0].describe_errors == 2 and summary.companies[0].status == "ok"
    later, written = run(spark, tmp_path, "2026-10-09", ("workday", "a", 0, jobs), details=details)
    assert written == {"ten:R1": None, "ten:R2": None, "ten:R3": None} and later.companies[0].describe_errors == 2


def test_only_postings_that_want_a_detail_meet_the_details(spark):
    base = "https://h.example.com/wday/cxs/ten/careers/job/x_"
    body = json.dumps({"jobPostingInfo": {"jobDescription": "<p>one</p>"}})
    details = spark.createDataFrame([("workday", base + "R1", body), ("workday", base + "R3", "{"), ("workday", base + "R5", body)],
                                    "source_system string, url string, json string")
    given = [  # what it holds, whether it wants more, what it holds then, whether that failed
        ("workday", "R1", None, True, "one", False), ("workday", "R2", None, True, None, True), ("workday", "R3", None, True, None, True),
        ("workday", "R4", "own", True, "own", False), ("workday", "R5", None, False, None, False), ("workday", "R1", None, None, None, False),
        ("greenhouse", "R1", None, True, None, False)]
    postings = spark.createDataFrame(
        [(s, f"ten:{i}", f"https://h.example.com/site/careers/job/x_{i}", d, w, n) for n, (s, i, d, w, *_) in enumerate(given)],
        "source_system string, posting_id string, url string, description string, wanted boolean, n int")
    filled = attach_details(postings, details, SPECS, F.col("wanted"))
    assert filled.columns == ["source_system", "posting_id", "url", "wanted", "n", "description", "detail_failed"]
    got = {r.n: (r.description, r.detail_failed) for r in filled.collect()}
    assert got == {n: (d, f) for n, (*_, d, f) in enumerate(given)}
    outer = filled._jdf.queryExecution().optimizedPlan()
    while outer.children().size() < 2:
        outer = outer.children().head()
    branches = [outer.children().apply(i).toString() for i in range(2)]
    assert outer.nodeName() == "Union" and ["Join" in b for b in branches] == [False, True]


def test_an_empty_day_keeps_the_schema(spark, tmp_path):
    summary, written = run(spark, tmp_path, "2026-10-08", ("greenhouse", "a", 0, {"jobs": []}))
    assert written == {} and summary.rows == 0
    stored = glob.glob(f"{tmp_path}/raw/postings/*/date=2026-10-08/*.parquet")
    assert pq.read_schema(stored[0]).names == list(model.POSTING_FIELDS)
    assert qa.check_any_rows(sinks.read_summaries(Store(spark, f"{tmp_path}/raw"))).count() == 1


def test_day_files_are_zstd(spark, tmp_path):
    row = spark.createDataFrame([tuple("x" for _ in model.POSTING_FIELDS)], model.POSTING_SCHEMA)
    sinks.write_day(Store(spark, str(tmp_path)), "2026-10-08", row.coalesce(1))
    stored = glob.glob(f"{tmp_path}/postings/*/date=2026-10-08/*.parquet")[0]
    assert pq.ParquetFile(stored).metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_missing_folder_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_glob(spark, f"{tmp_path}/none/*.parquet").count()


def test_dictionary_csv_keeps_quotes_and_backslashes(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('skill,category,pattern\nViol,string,"\\bviol\\b|""viol"", x"\nGong,drum,\\bgong\\b\n')
    want = [("Viol", "string", '\\bviol\\b|"viol", x'), ("Gong", "drum", "\\bgong\\b")]
    table = files.read_dictionary(spark, str(path))
    assert [tuple(r) for r in table.collect()] == want
    assert [(e.skill, e.category, e.pattern) for e in files.load_entries(table)] == want


def test_union_of_nothing_is_empty_with_schema(spark):
    empty = union_sources(spark, [], model.POSTING_SCHEMA)
    assert empty.count() == 0 and empty.columns == list(model.POSTING_FIELDS)


def test_dedupe_and_store_once(spark, rows):
    today = spark.createDataFrame([("s", "1", "b", 2), ("s", "1", "a", 1), ("t", "1", "c", 1), ("s", "2", None, 1)],
                                  "s string, id string, text string, n int")
    first = dedupe_first(today, ["s", "id"], ["n"])
    described = spark.createDataFrame([("t", "1", 1), ("t", "1", 2)], "s string, id string, day int")
    assert rows(store_once(first, described, ["s", "id"], "text", F.lit("detail")), "s", "id", "text") == [
        ("s", "1", "a"), ("s", "2", "detail"), ("t", "1", None)]


def test_config(spark, tmp_path, rows):
    entries = [
        {"key": "a", "name": "A", "industry": "x", "lever": {"site": "s"}},
        {"key": "b", "name": "B", "industry": "y", "workday": [{"host": "h1"}, {"host": "h2"}]},
        {"key": "b", "name": "C", "industry": "y", "lever": {}, "jibe": {}}, {"key": "d", "name": "D", "industry": "z"},
        {"key": "e", "name": "E", "industry": "z", "fax": {"n": "1"}}]
    path = tmp_path / "companies.json"
    path.write_text(json.dumps(entries))
    config = read_config(spark, str(path))
    assert rows(config_to_dimension(config), "company_key", "source_system")[:2] == [("a", "lever"), ("b", "workday")]
    assert rows(site_configs(config).where("company_key = 'b' and source_system = 'workday'"), "site", F.col("config")["host"]) == [
        (0, "h1"), (1, "h2")]
    assert rows(config_problems(config, ["lever", "workday", "jibe"]), "check", "key") == [
        ("one_known_system", "b"), ("one_known_system", "d"), ("one_known_system", "e"), ("unique_company", "b")]


def test_report_document(spark, tmp_path):
    raw = spark.createDataFrame([
        ("s", "c", "1", "Data Engineer", "Cairo", "Posted Today", "u", "Kafka </p>", "2026-10-08"),
        ("s", "c", "2", "Clerk", "Giza", "", "u", None, "2026-10-01")], model.POSTING_SCHEMA)
    from snapdemand.functions.regex import Entry, Rule
    dimension = spark.createDataFrame([("c", "Co", "x", "s"), ("d", "De", "x", "s")], model.DIMENSION_SCHEMA)
    models = build(raw, [Entry("Kafka", "data", r"\bkafka\b")], [Rule("role_family", 1, "data", "data_engineering")],
                   dimension, sinks.into(str(tmp_path / "w")))
    summaries = spark.createDataFrame([
        ("2026-10-07", "t0", 1.0, 5, []),
        ("2026-10-08", "t1", 1.0, 1, [("c", "ok", 1, None, 0, False, None), ("d", "error", 0, "x", 0, False, None)])],
        model.RUN_SUMMARY_SCHEMA)
    document = report_document(models.mart_skill_demand_weekly, models.fct_postings, models.dim_company, summaries, "now")
    got = json.loads(document.first().json)
    assert got["coverage"] == {"companies": 1, "companies_tracked": 2, "postings_open": 1}
    assert got["skills_this_week"]["tech"] == [{"skill": "Kafka", "category": "data", "open_postings": 1, "share": 1.0}]
    assert got["skill_trend"] == {"weeks": ["2026-10-05"], "series": {"Kafka": [1]}}
    assert got["top_companies"] == [{"name": "Co", "open_postings": 1}]
    assert got["health"] == {"last_run": "t1", "rows": 1, "sources_ok": 1, "sources_empty": [], "sources_failed": ["d"]}
    none = report_document(models.mart_skill_demand_weekly, models.fct_postings, models.dim_company,
                           summaries.where("false"), "now")
    assert json.loads(none.first().json)["health"]["last_run"] is None


def test_checks_of_empty_and_null_inputs(spark):
    empty = spark.createDataFrame([], "d date, k string")
    assert qa.check_run_has_rows(empty, "d").count() == 1
    assert qa.check_latest_has_rows(spark.createDataFrame([("x",)], "k string"), empty, "d").count() == 1
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert qa.check_unique(nulls, ["k"]).count() == 0
    assert qa.check_accepted(nulls, "k", ["a"]).count() == 0
    assert qa.check_fk(nulls, "k", spark.createDataFrame([("a",)], "p string"), "p").count() == 0
    late = spark.createDataFrame([(datetime.date(2026, 10, 8),)], "d date")
    now = F.lit("2026-10-09 12:00:00").cast("timestamp_ntz")
    assert [r.severity for r in qa.check_freshness(late, "d", now).collect()] == ["warn"]
    assert qa.check_freshness(late, "d", F.lit("2026-10-08 12:00:00").cast("timestamp_ntz")).count() == 0


#: the fields that name and title a posting, by system
NAMED = {"smartrecruiters": ("id", "name"), "oracle_cloud": ("Id", "Title"), "eightfold": ("id", "name"), "jibe": ("slug", "title"),
         "phenom": ("jobId", "title"), "amazon": ("id_icims", "title"), "greenhouse": ("id", "title"), "lever": ("id", "text"),
         "ashby": ("id", "title"), "workable": ("shortcode", "title")}


def test_a_posting_without_id_or_title_fails_its_response(spark):
    rows, want = [], {}
    for i, (system, fields) in enumerate(NAMED.items()):
        text = json.dumps(RESPONSES[system])
        for j, field in enumerate((None, *fields)):
            broken = text.replace(f'"{field}":', '"gone":') if field else text
            rows.append((system, f"{system}-{field}", i, j, CONFIG, broken, "2026-10-02"))
            want[f"{system}-{field}"] = field is not None
    parsed = parse_payloads(spark.createDataFrame(rows, PAYLOAD_SCHEMA), SPECS).select("company_key", "failed", "postings").collect()
    assert {r.company_key: r.failed for r in parsed} == want
    assert all((r.postings is None) == r.failed for r in parsed)


@pytest.mark.parametrize("system, old, new, reason", [
    ("greenhouse", '"title": " T "', '"title": {"x": 1}', "jobs.title holds object"),
    ("lever", '"text": "T "', '"text": 5', "text holds bigint"),
    ("workday", '"locationsText": "Paris"', '"locationsText": ["Paris"]', "jobPostings.locationsText holds array"),
    ("ashby", '"location": "HQ"', '"location": true', "jobs.location holds boolean"),
    ("smartrecruiters", '"id": "1"', '"id": {"n": 1}', "content.id holds object"),
])
def test_something_else_where_a_text_belongs_fails_its_company_with_the_reason(spark, tmp_path, system, old, new, reason):
    text = json.dumps(RESPONSES[system])
    assert old in text
    summary, written = run(spark, tmp_path, "2026-10-08", (system, "a", 0, text.replace(old, new)), ("greenhouse", "b", 1, board((1, "x"))))
    assert [(c.key, c.status, c.error) for c in summary.companies] == [("a", "error", reason), ("b", "ok", None), ("idle", "empty", None)]
    assert written == {"brd:1": "x"}
    assert normalise(landed(spark, (system, "a", 0, text.replace(old, new))), SPECS[system]).count() == 0


def test_reasons_of_failed_responses(spark):
    got = {r.company_key: r.error for r in parse_payloads(landed(
        spark, ("fax", "f", 0, {}), ("jibe", "j", 0, "{"), ("phenom", "p", 0, {}), ("greenhouse", "g", 0, {"jobs": [{"id": 1}]}),
        ("greenhouse", "n", 0, board((1, None)))), SPECS).collect()}
    assert got == {"f": "the system is unknown", "j": "the response does not parse, or lacks its list",
                   "p": "the response does not parse, or lacks its list", "g": None, "n": None}


@pytest.mark.parametrize("system", ["greenhouse", "workday", "lever"])
def test_a_response_is_parsed_once_and_markup_is_read_only_where_there_is_some(spark, tmp_path, system):
    landed(spark, (system, "a", 0, RESPONSES[system])).write.parquet(str(tmp_path / "landed"))
    rows = normalise(spark.read.schema(PAYLOAD_SCHEMA).parquet(str(tmp_path / "landed")), SPECS[system])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") == 1
