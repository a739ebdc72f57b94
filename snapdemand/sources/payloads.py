"""Canonical postings out of landed vendor payloads.

Input: one row per landed response, ``PAYLOAD_SCHEMA``. Each system is a ``PayloadSpec``: the JSON fields that are read,
where its rows are, and one expression per canonical field. Parsing is one ``from_json`` with an explicit schema, so only
the named fields are built. Texts are parsed as VARIANT, which keeps what they are in JSON: an object, a list or a number
where a text belongs is an error and not its own notation. A response that does not parse is reported with the reason,
it does not stop the job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdemand import model
from snapdemand.functions.dates import epoch_text
from snapdemand.functions.html import html_to_text, unescape_entities
from snapdemand.functions.places import in_region, many_places
from snapdemand.functions.regex import matches
from snapdemand.functions.text import (
    entity_key, first_non_blank, join_distinct, keep_items, last_token, or_empty, prefix, sections_text, strip,
    stripped_places,
)

PAYLOAD_SCHEMA = (
    "source_system string, company_key string, source_order int, page int, "
    "config map<string,string>, json string, collected_at string"
)
ORDER = ("source_order", "page", "position")
_CORRUPT = "_corrupt"


@dataclass(frozen=True)
class PayloadSpec:
    system: str
    schema: str
    rows: Callable[[Column], Column]
    posting: Callable[[Column, Callable[[str], Column]], dict[str, Column]]
    total: Callable[[Column], Column] | None = None
    rows_required: bool = False
    keep: Callable[[Column, Column], Column] = in_region
    escaped: bool = False
    blank_is_null: bool = True
    detail: Callable[[Column, Column], Column] | None = None
    detail_schema: str = ""
    detail_html: Callable[[Column], Column] | None = None
    #: fields that name a posting: a number will do, it is only ever printed
    ids: frozenset[str] = frozenset({"id", "Id", "slug", "jobId", "id_icims", "shortcode"})


# Fixed values, here and in SPECS: the systems' field names, hosts and URL forms.


def _named(location: Column, is_home: Column) -> Column:
    """Appends the country to a location that does not show it."""
    return F.when(is_home & ~matches(location, model.KEEP_PATTERN),
                  F.concat(location, F.lit(f", {model.COUNTRY_NAME}"))).otherwise(location)


def _workday(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    path = or_empty(j["externalPath"])
    return {
        "posting_id": entity_key(site("tenant"), last_token(path, "_")),
        "title": or_empty(j["title"]),
        "location": or_empty(j["locationsText"]),
        "posted_raw": or_empty(j["postedOn"]),
        "url": F.concat(F.lit("https://"), site("host"), F.lit("/en-US/"), site("site"), path),
    }


def _workday_detail(posting_id: Column, url: Column) -> Column:
    tenant = F.substring_index(posting_id, ":", 1)
    path = F.regexp_extract(url, r"^https://[^/]+/[^/]+(/.*)$", 1)
    return F.concat(F.lit("https://"), F.try_parse_url(url, F.lit("HOST")), F.lit("/wday/cxs/"), tenant, path)


def _smartrecruiters(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "posting_id": j["id"],
        "title": j["name"],
        "location": or_empty(j["location"]["fullLocation"]),
        "posted_raw": prefix(or_empty(j["releasedDate"])),
        "url": F.concat(F.lit("https://jobs.smartrecruiters.com/"), site("company"), F.lit("/"), j["id"]),
    }


def _smartrecruiters_detail(posting_id: Column, url: Column) -> Column:
    company = F.substring_index(F.substring_index(url, "/", -2), "/", 1)
    return F.concat(F.lit("https://api.smartrecruiters.com/v1/companies/"), company, F.lit("/postings/"), posting_id)


def _oracle_cloud(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "posting_id": entity_key(site("host"), j["Id"]),
        "title": j["Title"],
        "location": or_empty(j["PrimaryLocation"]),
        "posted_raw": or_empty(j["PostedDate"]),
        "url": F.concat(site("job_url"), j["Id"]),
    }


def _eightfold(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    kept = keep_items(F.coalesce(j["locations"], F.array().cast("array<string>")), model.KEEP_PATTERN)
    return {
        "posting_id": entity_key(site("host"), j["id"]),
        "title": j["name"],
        "location": F.array_join(kept, "; "),
        "posted_raw": epoch_text(j["postedTs"], "s"),
        "url": F.concat(F.lit("https://"), site("host"), j["positionUrl"]),
    }


def _jibe(row: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    j = row["data"]
    city_country = F.concat(or_empty(j["city"]), F.lit(", "), or_empty(j["country"]))
    return {
        "posting_id": entity_key(site("host"), j["slug"]),
        "title": j["title"],
        "location": F.coalesce(F.nullif(j["full_location"], F.lit("")), city_country),
        "posted_raw": prefix(or_empty(j["posted_date"])),
        "url": F.concat(F.lit("https://"), site("host"), F.lit("/main/jobs/"), j["slug"]),
        "html": j["description"],
    }


def _phenom(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "posting_id": entity_key(site("host"), j["jobId"]),
        "title": j["title"],
        "location": first_non_blank(j["cityStateCountry"], j["location"]),
        "posted_raw": prefix(or_empty(j["postedDate"])),
        "url": F.concat(F.lit("https://"), site("host"), F.lit("/global/en/job/"), j["jobId"]),
    }


def _amazon(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "posting_id": j["id_icims"],
        "title": j["title"],
        "location": _named(or_empty(j["location"]), j["country_code"].eqNullSafe(model.COUNTRY_CODE)),
        "posted_raw": or_empty(j["posted_date"]),
        "url": F.concat(F.lit("https://www.amazon.jobs"), j["job_path"]),
        "html": j["description"],
    }


def _greenhouse(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "posting_id": entity_key(site("board"), j["id"]),
        "title": strip(j["title"]),
        "location": strip(or_empty(j["location"]["name"])),
        "posted_raw": first_non_blank(j["first_published"], j["updated_at"]),
        "url": j["absolute_url"],
        "html": j["content"],
    }


def _lever(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    lists = F.coalesce(j["lists"], F.array().cast("array<struct<text:string,content:string>>"))
    parts = F.flatten(F.transform(lists, lambda s: F.array(s["text"], s["content"])))
    places = F.concat(F.array(j["categories"]["location"]),
                      F.coalesce(j["categories"]["allLocations"], F.array().cast("array<string>")))
    return {
        "posting_id": j["id"],
        "title": strip(j["text"]),
        "location": join_distinct(stripped_places(places)),
        "posted_raw": epoch_text(j["createdAt"], "ms"),
        "url": j["hostedUrl"],
        # any tag keeps the texts of two parts apart
        "html": F.array_join(F.concat(F.array(j["description"]), parts, F.array(j["additional"])), "<br>"),
    }


def _ashby(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    others = F.transform(
        F.coalesce(j["secondaryLocations"], F.array().cast("array<struct<location:string>>")),
        lambda s: s["location"])
    where = join_distinct(stripped_places(F.concat(F.array(j["location"]), others)))
    country = j["address"]["postalAddress"]["addressCountry"]
    return {
        "posting_id": j["id"],
        "title": strip(j["title"]),
        "location": _named(where, country.eqNullSafe(model.COUNTRY_NAME)),
        "posted_raw": or_empty(j["publishedAt"]),
        "url": j["jobUrl"],
        "html": j["descriptionHtml"],
        "plain": j["descriptionPlain"],
    }


def _workable(j: Column, site: Callable[[str], Column]) -> dict[str, Column]:
    own = F.array(F.struct(j["city"].alias("city"), j["country"].alias("country")))
    places = F.when(F.size(j["locations"]) > 0, j["locations"]).otherwise(own)
    shown = F.transform(places, lambda p: F.array_join(
        F.filter(F.array(p["city"], p["country"]), lambda x: x != ""), ", "))
    return {
        "posting_id": entity_key(site("account"), j["shortcode"]),
        "title": strip(j["title"]),
        "location": join_distinct(shown),
        "posted_raw": or_empty(j["published_on"]),
        "url": j["url"],
        "html": j["description"],
    }


SPECS: dict[str, PayloadSpec] = {s.system: s for s in (
    PayloadSpec(
        "workday",
        "total bigint, jobPostings array<struct<title string, externalPath string, locationsText string, "
        "postedOn string>>",
        rows=lambda d: d["jobPostings"], total=lambda d: d["total"], posting=_workday,
        keep=lambda location, title: in_region(location, title) | many_places(location),
        detail=_workday_detail, detail_schema="jobPostingInfo struct<jobDescription string>",
        detail_html=lambda d: d["jobPostingInfo"]["jobDescription"]),
    PayloadSpec(
        "smartrecruiters",
        "totalFound bigint, content array<struct<id string, name string, releasedDate string, "
        "location struct<fullLocation string>>>",
        rows=lambda d: d["content"], total=lambda d: d["totalFound"], posting=_smartrecruiters,
        detail=_smartrecruiters_detail, detail_schema="jobAd struct<sections map<string, struct<text string>>>",
        detail_html=lambda d: sections_text(F.transform(F.map_values(d["jobAd"]["sections"]), lambda s: s["text"]))),
    PayloadSpec(
        "oracle_cloud",
        "items array<struct<TotalJobsCount bigint, requisitionList array<struct<Id string, Title string, "
        "PostedDate string, PrimaryLocation string>>>>",
        rows=lambda d: F.get(d["items"], F.lit(0))["requisitionList"],
        total=lambda d: F.get(d["items"], F.lit(0))["TotalJobsCount"], posting=_oracle_cloud, rows_required=True),
    PayloadSpec(
        "eightfold",
        "data struct<count bigint, positions array<struct<id string, name string, locations array<string>, "
        "postedTs bigint, positionUrl string>>>",
        rows=lambda d: d["data"]["positions"], posting=_eightfold),
    PayloadSpec(
        "jibe",
        "totalCount bigint, jobs array<struct<data struct<slug string, title string, full_location string, "
        "city string, country string, posted_date string, description string>>>",
        rows=lambda d: d["jobs"], total=lambda d: d["totalCount"], posting=_jibe, blank_is_null=False),
    PayloadSpec(
        "phenom",
        "refineSearch struct<totalHits bigint, data struct<jobs array<struct<jobId string, title string, "
        "cityStateCountry string, location string, postedDate string>>>>",
        rows=lambda d: d["refineSearch"]["data"]["jobs"], total=lambda d: d["refineSearch"]["totalHits"],
        posting=_phenom, rows_required=True),
    PayloadSpec(
        "amazon",
        "hits bigint, jobs array<struct<id_icims string, title string, location string, country_code string, "
        "posted_date string, job_path string, description string>>",
        rows=lambda d: d["jobs"], total=lambda d: d["hits"], posting=_amazon, blank_is_null=False),
    PayloadSpec(
        "greenhouse",
        "jobs array<struct<id string, title string, location struct<name string>, first_published string, "
        "updated_at string, absolute_url string, content string>>",
        rows=lambda d: d["jobs"], posting=_greenhouse, escaped=True),
    PayloadSpec(
        "lever",
        "array<struct<id string, text string, categories struct<location string, allLocations array<string>>, "
        "createdAt bigint, description string, lists array<struct<text string, content string>>, "
        "additional string, hostedUrl string>>",
        rows=lambda d: d, posting=_lever, rows_required=True),
    PayloadSpec(
        "ashby",
        "jobs array<struct<id string, title string, location string, "
        "secondaryLocations array<struct<location string>>, "
        "address struct<postalAddress struct<addressCountry string>>, publishedAt string, jobUrl string, "
        "descriptionHtml string, descriptionPlain string>>",
        rows=lambda d: d["jobs"], posting=_ashby),
    PayloadSpec(
        "workable",
        "jobs array<struct<shortcode string, title string, city string, country string, "
        "locations array<struct<city string, country string>>, published_on string, url string, "
        "description string>>",
        rows=lambda d: d["jobs"], posting=_workable),
)}


_SHORT = ("posting_id", "title", "location", "posted_raw", "url")
_TEXTS = ("html", "plain")


def _type(spec: PayloadSpec) -> T.DataType:
    return T.DataType.fromDDL(spec.schema)


def _open(kind: T.DataType) -> T.DataType:
    """The same type with VARIANT for every text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _open(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_open(kind.elementType))
    return T.VariantType() if isinstance(kind, T.StringType) else kind


def _typed(value: Column, kind: T.DataType) -> Column:
    """The value with texts for VARIANTs."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_typed(value[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    return F.variant_get(value, "$", "string") if isinstance(kind, T.StringType) else value


def _wrong(value: Column, kind: T.DataType, ids: frozenset[str], path: str = "") -> Column:
    """Says of the first text that is none what it is instead; null if all are texts or null."""
    none = F.lit(None).cast("string")
    if isinstance(kind, T.StructType):
        return F.coalesce(none, *[_wrong(value[f.name], f.dataType, ids, f"{path}.{f.name}") for f in kind])
    if isinstance(kind, T.ArrayType):
        reasons = F.transform(value, lambda x: _wrong(x, kind.elementType, ids, path))
        return F.get(F.array_compact(reasons), F.lit(0))
    if not isinstance(kind, T.StringType):
        return none
    found = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    fine = ["STRING", "VOID", *(["BIGINT"] if path.rpartition(".")[2] in ids else [])]
    return F.when(~found.isin(*fine), F.concat(F.lit(f"{path.lstrip('.')} holds "), F.lower(found)))


def document(spec: PayloadSpec, json: Column) -> Column:
    """The response, parsed once, with VARIANT for texts; see ``kept_postings`` and ``wrong_type``."""
    kind = _open(_type(spec))
    if isinstance(kind, T.ArrayType):
        return F.from_json(json, kind)
    return F.from_json(json, T.StructType([*kind.fields, T.StructField(_CORRUPT, T.StringType())]),
                       {"columnNameOfCorruptRecord": _CORRUPT})


def wrong_type(spec: PayloadSpec, doc: Column) -> Column:
    """Why a parsed response is of no use: the first field that holds something else than a text; null if there is none."""
    return _wrong(doc, _type(spec), spec.ids)


def is_broken(spec: PayloadSpec, doc: Column) -> Column:
    """The response is no such JSON, or lacks its list of rows."""
    broken = doc.isNull()
    if not spec.schema.startswith("array"):
        broken = broken | doc[_CORRUPT].isNotNull()
    return broken | spec.rows(doc).isNull() if spec.rows_required else broken


def rows_read(spec: PayloadSpec, doc: Column) -> Column:
    return F.coalesce(F.size(spec.rows(doc)), F.lit(0)).cast("bigint")


def rows_reported(spec: PayloadSpec, doc: Column) -> Column:
    return spec.total(doc) if spec.total else F.lit(None).cast("bigint")


def kept_postings(spec: PayloadSpec, doc: Column, config: Column) -> Column:
    """The response's postings of the kept region: an array of (position, short fields, html, plain)."""
    def canonical(row: Column, position: Column) -> Column:
        fields = spec.posting(row, lambda name: F.try_element_at(config, F.lit(name)))
        texts = [fields.get(n, F.lit(None)).cast("string").alias(n) for n in _TEXTS]
        posting = F.struct(position.alias("position"), *[fields[n].alias(n) for n in _SHORT], *texts)
        return F.when(spec.keep(fields["location"], fields["title"]), posting)

    return F.array_compact(F.transform(spec.rows(_typed(doc, _type(spec))), canonical))


def listed_postings(responses: DataFrame, postings: str = "postings") -> DataFrame:
    """One row per posting of responses that carry their array of postings; texts still as markup.

    ``inline`` would make the optimiser test the array beforehand, and so parse the response twice.
    """
    return responses.select(
        "source_system", "company_key", "collected_at", "source_order", "page", F.inline_outer(postings)
    ).where("position IS NOT NULL")


def description(specs: Mapping[str, PayloadSpec]) -> Column:
    """The text of a listed posting. One expression for all systems, as HTML is the costly part."""
    def is_one_of(flagged: list[str]) -> Column:
        return F.col("source_system").isin(flagged) if flagged else F.lit(False)

    escaped = is_one_of([s.system for s in specs.values() if s.escaped])
    blank_stays = is_one_of([s.system for s in specs.values() if not s.blank_is_null])
    text = html_to_text(F.when(escaped, unescape_entities(F.col("html"))).otherwise(F.col("html")))
    other = F.nullif("plain", F.lit(""))
    return F.when(blank_stays | (text != ""), text).otherwise(other)


def has_text(spec: PayloadSpec) -> bool:
    """Whether responses of the system carry descriptions themselves."""
    return bool({*_TEXTS} & {*spec.posting(F.lit(None), lambda name: F.lit(None))})


def normalise(payloads: DataFrame, spec: PayloadSpec) -> DataFrame:
    """Canonical postings, with the columns of ``ORDER``, of one system's responses that parse."""
    doc = F.col("_doc")
    parsed = payloads.where(F.col("source_system") == spec.system).withColumn("_doc", document(spec, F.col("json")))
    fine = ~is_broken(spec, doc) & wrong_type(spec, doc).isNull()
    listed = listed_postings(parsed.withColumn("postings", F.when(fine, kept_postings(spec, doc, F.col("config")))))
    text = description({spec.system: spec}) if has_text(spec) else F.lit(None).cast("string")
    return listed.withColumn("description", text).select(*model.POSTING_FIELDS, *ORDER)


def parse_payloads(payloads: DataFrame, specs: Mapping[str, PayloadSpec]) -> DataFrame:
    """All systems in one pass: per response ``failed``, ``error`` (why), ``reported``, ``read`` and its kept ``postings``.

    A response is parsed by the schema of its own system only; one of an unknown system counts as failed, and so does one
    with something else where a text belongs, or with a kept posting that has no id or no title.
    """
    def own(spec: PayloadSpec, value: Column) -> Column:
        return F.when(F.col("source_system") == spec.system, value)

    def doc(spec: PayloadSpec) -> Column:
        return F.col(f"_doc_{spec.system}")

    every = list(specs.values())
    parsed = payloads.withColumns({f"_doc_{s.system}": own(s, document(s, F.col("json"))) for s in every})
    known = F.coalesce(F.col("source_system").isin(*specs), F.lit(False))
    broken = F.coalesce(*[own(s, is_broken(s, doc(s))) for s in every], F.lit(False))
    reason = (F.when(~known, "the system is unknown").when(broken, "the response does not parse, or lacks its list")
              .otherwise(F.coalesce(*[own(s, wrong_type(s, doc(s))) for s in every])))
    found = parsed.withColumn("error", reason).select(
        "source_system", "company_key", "source_order", "page", "config", "collected_at", "error",
        F.coalesce(*[own(s, rows_reported(s, doc(s))) for s in every]).alias("reported"),
        F.coalesce(*[own(s, rows_read(s, doc(s))) for s in every]).alias("read"),
        F.when(F.col("error").isNull(), F.coalesce(
            *[own(s, kept_postings(s, doc(s), F.col("config"))) for s in every])).alias("postings"))
    # a posting without its id or title would be told from others by nothing: its response is of no use
    lacking = F.exists("postings", lambda p: p["posting_id"].isNull() | p["title"].isNull())
    found = found.withColumn("error", F.coalesce("error", F.when(lacking, "a posting lacks its id or title")))
    failed = F.col("error").isNotNull()
    return found.withColumn("failed", failed).withColumn("postings", F.when(~failed, F.col("postings")))


def site_totals(parsed: DataFrame) -> DataFrame:
    """Per company and site of parsed responses: rows reported, rows read, and whether more were reported."""
    return (
        parsed.where(~F.col("failed"))
        .groupBy("source_system", "company_key", F.col("config").cast("string").alias("site"))
        .agg(F.max("reported").alias("reported"), F.sum("read").alias("read"))
        .withColumn("truncated", F.coalesce(F.col("reported") > F.col("read"), F.lit(False)))
    )


def detail_texts(details: DataFrame, specs: Mapping[str, PayloadSpec]) -> DataFrame:
    """(_detail_url, _good, _text) out of detail responses (source_system, url, json), all systems in one pass."""
    corrupt = {"columnNameOfCorruptRecord": _CORRUPT}
    with_details = [s for s in specs.values() if s.detail]

    def own(spec: PayloadSpec, value: Column) -> Column:
        return F.when(F.col("source_system") == spec.system, value)

    def doc(spec: PayloadSpec) -> Column:
        return F.col(f"_doc_{spec.system}")

    parsed = details.withColumns({
        f"_doc_{s.system}": own(s, F.from_json("json", f"{s.detail_schema}, {_CORRUPT} string", corrupt))
        for s in with_details})
    return parsed.select(
        F.col("url").alias("_detail_url"),
        F.coalesce(*[own(s, doc(s).isNotNull() & doc(s)[_CORRUPT].isNull()) for s in with_details]).alias("_good"),
        F.coalesce(*[own(s, s.detail_html(doc(s))) for s in with_details]).alias("_html"),
    ).select("_detail_url", "_good", html_to_text(F.col("_html")).alias("_text"))


def detail_url(specs: Mapping[str, PayloadSpec]) -> Column:
    """Where a posting's detail response was asked for; null for systems without one."""
    return F.coalesce(*[
        F.when(F.col("source_system") == s.system, s.detail(F.col("posting_id"), F.col("url")))
        for s in specs.values() if s.detail])


def attach_details(postings: DataFrame, details: DataFrame, specs: Mapping[str, PayloadSpec],
                   wanted: Column | None = None) -> DataFrame:
    """Fills missing descriptions, where ``wanted``, from detail responses (source_system, url, json).

    Adds ``detail_failed``: a description was wanted and its response is missing or does not parse. Only postings that
    want one meet the details; all others stay where they lie. Details are unique by URL, and so are the postings
    after ``dedupe_first``: no key of this join is hot.
    """
    url = detail_url(specs)
    # the URL first: it is null for systems without details, whose markup is then not turned to text for this test
    wants = url.isNotNull() & (F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))) & F.col("description").isNull()
    own = [c for c in postings.columns if c != "description"]
    good = F.coalesce("_good", F.lit(False))
    filled = postings.where(wants).withColumn("_detail_url", url).join(detail_texts(details, specs), "_detail_url", "left").select(
        *own, F.when(good, F.col("_text")).alias("description"), (~good).alias("detail_failed"))
    return postings.where(~wants).select(*own, "description", F.lit(False).alias("detail_failed")).unionByName(filled)
