"""NRM1-NRM13: vendor payloads built from the given tables, one response per row, parsed back to postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.catalog.base import Tables, query
from snapdemand.catalog.html_sql import html_text_sql
from snapdemand.sources.config import site_configs
from snapdemand.sources.payloads import SPECS, attach_details, normalise

DAY = "2026-10-08"
KEEP = f"regexp_matches(coalesce(nullif(location, ''), title, ''), '{model.KEEP_PATTERN}', 'i')"
PLACE = ("CASE p_size % 5 WHEN 0 THEN 'Cairo, Egypt' WHEN 1 THEN '4 Locations' WHEN 2 THEN 'Dubai' "
         "WHEN 3 THEN NULL ELSE 'Giza' END")
PAGE_PLACE = "CASE page_id % 4 WHEN 0 THEN ' Cairo ' WHEN 1 THEN 'Dubai' WHEN 2 THEN NULL ELSE 'Minya' END"


def place() -> Column:
    kind = F.col("p_size") % 5
    return (F.when(kind == 0, "Cairo, Egypt").when(kind == 1, "4 Locations").when(kind == 2, "Dubai")
            .when(kind == 4, "Giza"))


def page_place() -> Column:
    kind = F.col("page_id") % 4
    return F.when(kind == 0, " Cairo ").when(kind == 1, "Dubai").when(kind == 3, "Minya")


def obj(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def text(value: str | None = None) -> Column:
    return F.lit(value).cast("string")


def payload(df: DataFrame, system: str, company: Column, config: dict[str, Column], document: Column,
            day: str = DAY, page: Column | None = None) -> DataFrame:
    settings = [x for k, v in config.items() for x in (F.lit(k), v)]
    return df.select(
        F.lit(system).alias("source_system"), company.alias("company_key"), F.lit(0).alias("source_order"),
        (F.lit(1) if page is None else page.cast("int")).alias("page"), F.create_map(*settings).alias("config"),
        F.to_json(document, {"ignoreNullFields": "false"}).alias("json"), F.lit(day).alias("collected_at"))


def postings(df: DataFrame, system: str) -> DataFrame:
    return normalise(df, SPECS[system]).select(*model.POSTING_FIELDS)


def final_sql(system: str, rows: str, extra: str = "", keep: str = KEEP) -> str:
    return f"""
WITH j AS ({rows})
SELECT '{system}' AS source_system, company_key, posting_id, title, location, posted_raw, url, description,
       '{DAY}' AS collected_at
FROM j WHERE {keep}{extra}"""


def part_id() -> Column:
    return F.col("p_partkey").cast("string")


BRAND = "replace(p_brand, '#', '')"


def brand() -> Column:
    return F.replace("p_brand", F.lit("#"), F.lit(""))


def workday_payloads(t: Tables, total: Column | None = None) -> DataFrame:
    first = obj(title=F.col("p_name"), externalPath=F.concat(F.lit("/job/a_b/"), "p_type", F.lit("_R"), part_id()),
                locationsText=place(), postedOn=F.concat(F.lit("Posted "), F.col("p_size").cast("string"), F.lit(" Days Ago")))
    second = obj(title=F.concat(F.lit("Alexandria "), "p_name"), externalPath=F.concat(F.lit("/job/S"), part_id()),
                 locationsText=text(), postedOn=text())
    return payload(t.part, "workday", F.col("p_brand"),
                   {"host": F.concat(brand(), F.lit(".example.com")), "tenant": brand(), "site": F.lit("Careers")},
                   obj(total=(F.col("p_size") if total is None else total).cast("bigint"), jobPostings=F.array(first, second)))


@query("NRM1_workday", final_sql("workday", f"""
  SELECT p_brand AS company_key, {BRAND} || ':R' || p_partkey AS posting_id, p_name AS title,
         coalesce({PLACE}, '') AS location, 'Posted ' || p_size || ' Days Ago' AS posted_raw,
         'https://' || {BRAND} || '.example.com/en-US/Careers/job/a_b/' || p_type || '_R' || p_partkey AS url,
         CAST(NULL AS VARCHAR) AS description FROM part
  UNION ALL
  SELECT p_brand, {BRAND} || ':/job/S' || p_partkey, 'Alexandria ' || p_name, '', '',
         'https://' || {BRAND} || '.example.com/en-US/Careers/job/S' || p_partkey, NULL FROM part""",
    keep=f"({KEEP} OR regexp_full_match(location, '[0-9]+ Locations'))"))
def nrm1(t):
    return postings(workday_payloads(t), "workday")


@query("NRM2_smartrecruiters", final_sql("smartrecruiters", f"""
  SELECT p_brand AS company_key, 'A' || p_partkey AS posting_id, p_name AS title, coalesce({PLACE}, '') AS location,
         '2026-09-28' AS posted_raw,
         'https://jobs.smartrecruiters.com/' || {BRAND} || '/A' || p_partkey AS url, CAST(NULL AS VARCHAR) AS description
  FROM part
  UNION ALL
  SELECT p_brand, 'B' || p_partkey, 'Egypt ' || p_name, '', '',
         'https://jobs.smartrecruiters.com/' || {BRAND} || '/B' || p_partkey, NULL FROM part"""))
def nrm2(t):
    first = obj(id=F.concat(F.lit("A"), part_id()), name=F.col("p_name"), releasedDate=F.lit("2026-09-28T10:00:00.000Z"),
                location=obj(fullLocation=place()))
    second = obj(id=F.concat(F.lit("B"), part_id()), name=F.concat(F.lit("Egypt "), "p_name"), releasedDate=text(),
                 location=F.lit(None).cast("struct<fullLocation:string>"))
    return postings(payload(t.part, "smartrecruiters", F.col("p_brand"), {"company": brand()},
                            obj(totalFound=F.lit(2), content=F.array(first, second))), "smartrecruiters")


@query("NRM3_oracle_cloud", final_sql("oracle_cloud", f"""
  SELECT p_brand AS company_key, {BRAND} || ':' || p_partkey AS posting_id, p_name AS title,
         coalesce({PLACE}, '') AS location, '2026-09-07' AS posted_raw, 'https://o.example.com/job/' || p_partkey AS url,
         CAST(NULL AS VARCHAR) AS description FROM part"""))
def nrm3(t):
    row = obj(Id=F.col("p_partkey"), Title=F.col("p_name"), PostedDate=F.lit("2026-09-07"), PrimaryLocation=place())
    return postings(payload(
        t.part, "oracle_cloud", F.col("p_brand"), {"host": brand(), "job_url": F.lit("https://o.example.com/job/")},
        obj(items=F.array(obj(TotalJobsCount=F.lit(9), requisitionList=F.array(row))))), "oracle_cloud")


@query("NRM4_eightfold", final_sql("eightfold", f"""
  SELECT o_orderpriority AS company_key, 'h:' || o_orderkey AS posting_id, 'Order ' || o_custkey || ' Giza' AS title,
         array_to_string(list_filter(['Cairo,' || o_orderstatus, 'Dubai', 'Maadi,Egypt'],
                                     lambda x: regexp_matches(x, '{model.KEEP_PATTERN}', 'i')
                                               AND o_custkey % 3 > 0 AND (o_custkey % 3 = 1 OR x NOT LIKE 'Maadi%')), '; ') AS location,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS posted_raw,
         'https://h/careers/' || o_orderkey AS url, CAST(NULL AS VARCHAR) AS description FROM orders"""))
def nrm4(t):
    cairo = F.concat(F.lit("Cairo,"), "o_orderstatus")
    kind = F.col("o_custkey") % 3
    where = F.when(kind == 1, F.array(cairo, F.lit("Dubai"), F.lit("Maadi,Egypt"))).when(
        kind == 2, F.array(cairo, F.lit("Dubai")))
    seconds = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86_400 + 3_600
    row = obj(id=F.col("o_orderkey"), name=F.concat(F.lit("Order "), F.col("o_custkey").cast("string"), F.lit(" Giza")),
              locations=where, postedTs=F.when(F.col("o_orderstatus") != "P", seconds),
              positionUrl=F.concat(F.lit("/careers/"), F.col("o_orderkey").cast("string")))
    return postings(payload(t.orders, "eightfold", F.col("o_orderpriority"), {"host": F.lit("h")},
                            obj(data=obj(count=F.lit(1), positions=F.array(row)))), "eightfold")


@query("NRM5_jibe", final_sql("jibe", f"""
  SELECT 'pages' AS company_key, 'jibe.example.com:' || page_id AS posting_id, 'Page Cairo ' || page_id AS title,
         CASE WHEN page_id % 3 = 0 THEN 'Minya, Egypt' WHEN page_id % 3 = 1 THEN 'Tanta, Egypt' ELSE ', ' END AS location,
         CASE WHEN page_id % 2 = 0 THEN '2026-09-07' ELSE '' END AS posted_raw,
         'https://jibe.example.com/main/jobs/' || page_id AS url, {html_text_sql('html')} AS description FROM pages"""))
def nrm5(t):
    kind = F.col("page_id") % 3
    row = obj(data=obj(
        slug=F.col("page_id"), title=F.concat(F.lit("Page Cairo "), F.col("page_id").cast("string")),
        full_location=F.when(kind == 0, "Minya, Egypt").when(kind == 1, ""), city=F.when(kind == 1, "Tanta"),
        country=F.when(kind == 1, "Egypt"), posted_date=F.when(F.col("page_id") % 2 == 0, "2026-09-07T00:00:00"),
        description=F.col("html")))
    return postings(payload(t.pages, "jibe", F.lit("pages"), {"host": F.lit("jibe.example.com")},
                            obj(totalCount=F.lit(1), jobs=F.array(row))), "jibe")


@query("NRM6_phenom", final_sql("phenom", f"""
  SELECT p_brand AS company_key, 'ph:' || p_partkey AS posting_id, p_name || ' Cairo' AS title,
         CASE WHEN p_size % 3 = 0 THEN 'Giza, ' || p_type WHEN p_size % 3 = 1 THEN coalesce({PLACE}, '') ELSE '' END AS location,
         '2026-06-01' AS posted_raw, 'https://ph/global/en/job/' || p_partkey AS url,
         CAST(NULL AS VARCHAR) AS description FROM part"""))
def nrm6(t):
    kind = F.col("p_size") % 3
    row = obj(jobId=part_id(), title=F.concat("p_name", F.lit(" Cairo")),
              cityStateCountry=F.when(kind == 0, F.concat(F.lit("Giza, "), "p_type")).when(kind == 1, ""),
              location=F.when(kind == 1, place()), postedDate=F.lit("2026-06-01T00:00:00.000+0000"))
    return postings(payload(t.part, "phenom", F.col("p_brand"), {"host": F.lit("ph")},
                            obj(refineSearch=obj(totalHits=F.lit(1), data=obj(jobs=F.array(row))))), "phenom")


@query("NRM7_amazon", final_sql("amazon", f"""
  SELECT 'pages' AS company_key, 'a' || page_id AS posting_id, 'Job ' || page_id AS title,
         CASE page_id % 4 WHEN 0 THEN 'EG, Cairo' WHEN 1 THEN 'EG, Luxor, Egypt' WHEN 2 THEN 'AE, Dubai'
              ELSE ', Egypt' END AS location,
         CASE WHEN page_id % 3 = 0 THEN '' ELSE 'March  5, 2026' END AS posted_raw,
         'https://www.amazon.jobs/en/jobs/' || page_id AS url, {html_text_sql('html')} AS description FROM pages"""))
def nrm7(t):
    kind = F.col("page_id") % 4
    row = obj(id_icims=F.concat(F.lit("a"), F.col("page_id").cast("string")),
              title=F.concat(F.lit("Job "), F.col("page_id").cast("string")),
              location=F.when(kind == 0, "EG, Cairo").when(kind == 1, "EG, Luxor").when(kind == 2, "AE, Dubai"),
              country_code=F.when(kind == 2, text()).otherwise("EGY"),
              posted_date=F.when(F.col("page_id") % 3 != 0, "March  5, 2026"),
              job_path=F.concat(F.lit("/en/jobs/"), F.col("page_id").cast("string")), description=F.col("html"))
    return postings(payload(t.pages, "amazon", F.lit("pages"), {"country": F.lit("EGY")},
                            obj(hits=F.lit(1), jobs=F.array(row))), "amazon")


def escaped(html: str | Column) -> Column:
    out = F.replace(html, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("NRM8_greenhouse", final_sql("greenhouse", f"""
  SELECT 'pages' AS company_key, 'board:' || page_id AS posting_id, 'Cairo job' AS title,
         trim(coalesce({PAGE_PLACE}, '')) AS location,
         CASE page_id % 3 WHEN 0 THEN '2026-09-01T00:00:00Z' WHEN 1 THEN '2026-09-02' ELSE '' END AS posted_raw,
         url, nullif({html_text_sql('html')}, '') AS description FROM pages"""))
def nrm8(t):
    kind = F.col("page_id") % 3
    row = obj(id=F.col("page_id"), title=F.lit(" Cairo job\t"), location=obj(name=page_place()),
              first_published=F.when(kind == 0, "2026-09-01T00:00:00Z").when(kind == 1, ""),
              updated_at=F.when(kind == 1, "2026-09-02"), absolute_url=F.col("url"), content=escaped("html"))
    return postings(payload(t.pages, "greenhouse", F.lit("pages"), {"board": F.lit("board")},
                            obj(jobs=F.array(row))), "greenhouse")


LEVER_HTML = ("html || CASE WHEN page_id % 2 = 0 THEN '<div>Needs</div><ul><li>' || url || '</li></ul><div></div><ul></ul>' "
              "ELSE '' END || CASE WHEN page_id % 5 = 0 THEN '' ELSE '<p>more &amp; more</p>' END")


@query("NRM9_lever", final_sql("lever", f"""
  SELECT 'pages' AS company_key, 'L' || page_id AS posting_id, 'Job' AS title,
         CASE page_id % 3 WHEN 0 THEN 'Remote; Cairo; Giza' WHEN 1 THEN 'Cairo' ELSE 'Paris' END AS location,
         CASE WHEN page_id % 4 = 0 THEN '' ELSE '2024-04-05' END AS posted_raw,
         url, nullif({html_text_sql(LEVER_HTML)}, '') AS description FROM pages"""))
def nrm9(t):
    kind = F.col("page_id") % 3
    sections = F.array(obj(text=F.lit("Needs"), content=F.concat(F.lit("<li>"), "url", F.lit("</li>"))),
                       obj(text=text(), content=text()))
    row = obj(
        id=F.concat(F.lit("L"), F.col("page_id").cast("string")), text=F.lit(" Job "),
        categories=obj(
            location=F.when(kind == 0, "Remote").when(kind == 1, " Cairo ").otherwise("Paris"),
            allLocations=F.when(kind == 0, F.array(F.lit(""), F.lit("Cairo"), F.lit("Remote "), F.lit("Giza")))
            .when(kind == 1, F.array(F.lit("Cairo")))),
        createdAt=F.when(F.col("page_id") % 4 == 0, 0).otherwise(F.lit(1712345600000)),
        description=F.col("html"), lists=F.when(F.col("page_id") % 2 == 0, sections),
        additional=F.when(F.col("page_id") % 5 != 0, "<p>more &amp; more</p>"), hostedUrl=F.col("url"))
    return postings(payload(t.pages, "lever", F.lit("pages"), {"site": F.lit("s")}, F.array(row)), "lever")


@query("NRM10_ashby", final_sql("ashby", f"""
  SELECT 'pages' AS company_key, 'U' || page_id AS posting_id, 'Job' AS title,
         CASE page_id % 3 WHEN 0 THEN 'HQ; Cairo' WHEN 1 THEN 'HQ, Egypt' ELSE 'HQ' END AS location,
         '2026-09-28T10:15:00.000+00:00' AS posted_raw, url,
         CASE WHEN page_id % 4 = 0 THEN 'plain ' || url ELSE nullif({html_text_sql('html')}, '') END AS description
  FROM pages"""))
def nrm10(t):
    kind = F.col("page_id") % 3
    others = F.array(obj(location=F.lit("Cairo ")), obj(location=text()), obj(location=F.lit("HQ")))
    row = obj(
        id=F.concat(F.lit("U"), F.col("page_id").cast("string")), title=F.lit("Job "), location=F.lit("HQ"),
        secondaryLocations=F.when(kind == 0, others),
        address=F.when(kind == 1, obj(postalAddress=obj(addressCountry=F.lit("Egypt")))),
        publishedAt=F.lit("2026-09-28T10:15:00.000+00:00"), jobUrl=F.col("url"),
        descriptionHtml=F.when(F.col("page_id") % 4 != 0, F.col("html")).otherwise("<p></p>"),
        descriptionPlain=F.concat(F.lit("plain "), "url"))
    return postings(payload(t.pages, "ashby", F.lit("pages"), {"board": F.lit("b")},
                            obj(jobs=F.array(row))), "ashby")


@query("NRM11_workable", final_sql("workable", f"""
  SELECT 'pages' AS company_key, 'acc:W' || page_id AS posting_id, 'Job' AS title,
         CASE page_id % 3 WHEN 0 THEN 'Cairo, Egypt; Egypt' WHEN 1 THEN 'Giza' ELSE 'Tunis, Tunisia' END AS location,
         '2026-09-28' AS posted_raw, url, nullif({html_text_sql('html')}, '') AS description FROM pages"""))
def nrm11(t):
    kind = F.col("page_id") % 3
    cairo = obj(city=F.lit("Cairo"), country=F.lit("Egypt"))
    places = F.array(cairo, obj(city=F.lit(""), country=F.lit("Egypt")), cairo)
    row = obj(
        shortcode=F.concat(F.lit("W"), F.col("page_id").cast("string")), title=F.lit("Job"),
        city=F.when(kind == 1, "Giza").otherwise("Tunis"), country=F.when(kind != 1, "Tunisia"),
        locations=F.when(kind == 0, places).when(kind == 1, F.slice(places, 1, 0)),
        published_on=F.lit("2026-09-28"), url=F.col("url"), description=F.col("html"))
    return postings(payload(t.pages, "workable", F.lit("pages"), {"account": F.lit("acc")},
                            obj(jobs=F.array(row))), "workable")


@query("NRM12_details", f"""
WITH j AS (
  SELECT p_partkey, p_size % 7 AS kind, {BRAND} || ':R' || p_partkey AS posting_id, p_name, p_type, p_name AS title,
         coalesce({PLACE}, '') AS location FROM part)
SELECT posting_id, CASE WHEN kind > 1 THEN p_type || ' & ' || p_name END AS description, kind <= 1 AS detail_failed
FROM j WHERE {KEEP} OR regexp_full_match(location, '[0-9]+ Locations')
UNION ALL
SELECT replace(p_brand, '#', '') || ':/job/S' || p_partkey, NULL, true FROM part""")
def nrm12(t):
    url = F.concat(F.lit("https://"), brand(), F.lit(".example.com/wday/cxs/"), brand(), F.lit("/Careers/job/a_b/"),
                   "p_type", F.lit("_R"), part_id())
    html = F.concat(F.lit("<h1>"), "p_type", F.lit("</h1> &amp; <p>"), "p_name", F.lit("</p>"))
    good = F.to_json(obj(jobPostingInfo=obj(jobDescription=html)))
    details = t.part.where(F.col("p_size") % 7 != 0).select(
        F.lit("workday").alias("source_system"), url.alias("url"), F.when(F.col("p_size") % 7 == 1, '{"jobPostingInfo": {"jobDescr').otherwise(good).alias("json"))
    listed = postings(workday_payloads(t), "workday")
    return attach_details(listed, details, SPECS).select("posting_id", "description", "detail_failed")


def supplier_config(t: Tables) -> DataFrame:
    """Config entries: the system key holds one site or a list of them."""
    kind = F.col("s_suppkey") % 3
    meta = {"key": F.concat(F.lit("C"), F.col("s_suppkey").cast("string")), "name": F.col("s_name"),
            "industry": F.concat(F.lit("I"), F.col("s_nationkey").cast("string"))}
    site = obj(host=F.concat(F.lit("h"), F.col("s_suppkey").cast("string")), site=F.lit("a"))
    other = obj(host=F.concat(F.lit("h"), F.col("s_suppkey").cast("string")), site=F.lit("b"))
    entry = (F.when(kind == 0, F.to_json(obj(**meta, workday=F.array(site, other))))
             .when(kind == 1, F.to_json(obj(**meta, lever=site)))
             .otherwise(F.to_json(obj(**meta, jibe=F.array(site)))))
    return t.supplier.select(F.col("s_suppkey").alias("position"), entry.alias("entry"))


@query("NRM13_site_configs", """
SELECT 'C' || s_suppkey AS company_key, CASE s_suppkey % 3 WHEN 0 THEN 'workday' WHEN 1 THEN 'lever' ELSE 'jibe' END
         AS source_system, site, 'h' || s_suppkey AS host, CASE site WHEN 0 THEN 'a' ELSE 'b' END AS name
FROM supplier JOIN (VALUES (0), (1)) AS v(site) ON site = 0 OR s_suppkey % 3 = 0""")
def nrm13(t):
    return site_configs(supplier_config(t)).select(
        "company_key", "source_system", "site", F.col("config")["host"].alias("host"), F.col("config")["site"].alias("name"))
