"""The warehouse: staging, lifecycle, labels, tags, facts and marts.

``build`` reads the snapshots once and shuffles them once: one aggregation per entity yields its lifecycle, its latest
row, its latest description and the weeks and days it was seen. Labels and tags are expressions on that row, and both
marts count arrays of it. The entity table is written, so the models after it read a table and a lost executor costs
no second scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.dates import parse_when, to_day, week_start
from snapdemand.functions.places import canonical_place
from snapdemand.functions.regex import Entry, Rule
from snapdemand.functions.text import blank_to_null, entity_key, plain_spaces, searchable, trim_zs
from snapdemand.operators.classify import classify
from snapdemand.operators.demand import Scopes, daily_cells, scoped_demand
from snapdemand.operators.lifecycle import entity_state, latest_day, latest_row, lifecycle, with_openness
from snapdemand.operators.tagging import explode_tags, tag, with_tags
from snapdemand.quality.audit import FAILURES, Audit, expectations
from snapdemand.sinks import Writer
from snapdemand.sources.files import load_entries, load_rules
from snapdemand.store import WHOLE, Store

KEY, DAY = "posting_key", "collected_date"
ATTRS = ("company_key", "title", "city", "url")
FACT_COLUMNS = (KEY, *ATTRS, "posted_date", "first_seen", "last_seen", "is_open", "days_open", "role_family",
                "seniority")
#: of one row, or one per dictionary entry, for each key
BUCKETED = ("entities", "fct_postings", "fct_posting_skills")


def staging(raw: DataFrame, places: dict[str, str] = model.PLACES) -> DataFrame:
    """Cleaned snapshot rows. The partition column ``date`` is kept when there is one, for pruning by day."""
    cleaned = raw.withColumns({
        "title": trim_zs(F.col("title")),
        "location": plain_spaces(F.col("location")),
        DAY: to_day(F.col("collected_at")),
    })
    return cleaned.select(
        "source_system", "company_key", "posting_id",
        entity_key(F.col("source_system"), F.col("posting_id")).alias(KEY),
        "title", "location",
        canonical_place(F.col("location"), places).alias("city"),
        parse_when(F.col("posted_raw"), F.col(DAY)).alias("posted_date"),
        "url",
        blank_to_null(F.col("description")).alias("description_clean"),
        DAY,
        *[c for c in ("date",) if c in raw.columns],
    )


def posting_lifecycle(stg: DataFrame, last_day: Column | None = None) -> DataFrame:
    return lifecycle(stg, [KEY], DAY, ATTRS, earliest=["posted_date"], tie=["url"], last_day=last_day).select(
        KEY, *ATTRS, "posted_date", "first_seen", "last_seen", "is_open", "days_open")


def posting_roles(stg: DataFrame, rules: Sequence[Rule], defaults: dict[str, str] = model.RULE_DEFAULTS) -> DataFrame:
    latest = latest_row(stg.select(KEY, "title", DAY), [KEY], DAY, tie=["title"])
    return classify(latest, "title", rules, defaults).select(KEY, *defaults)


def posting_texts(stg: DataFrame) -> DataFrame:
    """The text tags are looked for in: the latest title and the latest description, maybe of different days."""
    state = entity_state(stg, [KEY], DAY, ["title"], kept=["description_clean"], tie=["title"])
    return state.select(KEY, searchable(F.col("title"), F.col("description_clean")).alias("text"))


def posting_skills(stg: DataFrame, dictionary: Sequence[Entry]) -> DataFrame:
    return tag(posting_texts(stg), [KEY], "text", dictionary)


def fct_postings(life: DataFrame, roles: DataFrame) -> DataFrame:
    return life.join(roles, KEY).select(*FACT_COLUMNS)


def posting_facts(stg: DataFrame, rules: Sequence[Rule], defaults: dict[str, str] = model.RULE_DEFAULTS,
                  last_day: Column | None = None) -> DataFrame:
    """``fct_postings`` in one pass: labels are expressions on the latest title, so there is nothing to join."""
    life = posting_lifecycle(stg, last_day)
    return classify(life, "title", rules, defaults).select(*FACT_COLUMNS)


def fct_posting_skills(skills: DataFrame, facts: DataFrame) -> DataFrame:
    return skills.join(facts.select(KEY, "company_key"), KEY).select(KEY, "company_key", "skill", "category")


def entities(
    stg: DataFrame, dictionary: Sequence[Entry], rules: Sequence[Rule],
    defaults: dict[str, str] = model.RULE_DEFAULTS,
) -> DataFrame:
    """One row per entity with everything the facts and marts need, in one pass over the snapshots."""
    state = entity_state(
        stg, [KEY], DAY, ATTRS, earliest=["posted_date"], kept=["description_clean"], tie=["url"],
        sets={"_weeks": week_start(F.col(DAY)), "_days": F.col(DAY)}, rows="_rows")
    text = searchable(F.col("title"), F.col("description_clean"))
    return with_tags(classify(state, "title", rules, defaults).withColumn("_text", text), "_text", dictionary).drop(
        "_text", "description_clean")


def facts_of(table: DataFrame) -> DataFrame:
    """The posting facts out of a written entity table; its own last day is the last day of the snapshots."""
    return with_openness(table.drop("_weeks", "_days", "_rows", "tags"), latest_day(table, "last_seen")).select(*FACT_COLUMNS)


@dataclass(frozen=True)
class Models:
    stg_postings: DataFrame
    dim_company: DataFrame
    fct_postings: DataFrame
    fct_posting_skills: DataFrame
    mart_skill_demand_weekly: DataFrame
    mart_role_demand_daily: DataFrame


def build(
    raw: DataFrame, dictionary: Sequence[Entry], rules: Sequence[Rule], dimension: DataFrame, write: Writer,
    scopes: Scopes = model.SCOPES, places: dict[str, str] = model.PLACES,
    defaults: dict[str, str] = model.RULE_DEFAULTS, watch: Writer = lambda df, name: df,
) -> Models:
    """Rebuilds every model with ``write(rows, name)`` and returns them; staging stays a view.

    ``watch(staging, name)`` may add metrics to the one pass over the snapshots.
    """
    stg = staging(raw, places)
    table = write(entities(watch(stg, "stg_postings"), dictionary, rules, defaults), "entities")
    return Models(
        stg_postings=stg,
        dim_company=write(dimension.select("company_key", "name", "industry", "source_system"), "dim_company"),
        fct_postings=write(facts_of(table), "fct_postings"),
        fct_posting_skills=write(explode_tags(table, [KEY, "company_key"]), "fct_posting_skills"),
        mart_skill_demand_weekly=write(scoped_demand(table, scopes), "mart_skill_demand_weekly"),
        mart_role_demand_daily=write(
            daily_cells(table.select("role_family", "first_seen", "_days"), "role_family"), "mart_role_demand_daily"),
    )


def publish(
    raw: DataFrame, skills: DataFrame, rules: DataFrame, dimension: DataFrame, out: Store,
    tag_cases: DataFrame | None = None, label_cases: DataFrame | None = None, buckets: int | None = None, **options,
) -> DataFrame:
    """Builds a new version of the warehouse in ``out``, checks it, and publishes it unless a check of severity error fails.

    Returns the failures, (check, severity, key, detail), which are a table of the version too. What was published before
    stays readable until the moment the new version is, and after a failure. With ``buckets``, entities, facts and bridge
    are written in so many buckets of their key, and join on it without an exchange; choose as many as keep a bucket of
    the entities at some hundred MB.
    """
    entries, ordered = load_entries(skills), load_rules(rules)
    version = out.stage()
    audit = Audit(expectations(entries, ordered, tag_cases, label_cases))

    def store(df: DataFrame, name: str) -> DataFrame:
        return version.write_buckets(df, name, KEY, buckets) if buckets and name in BUCKETED else version.write(df, name)

    write = audit.writer(store)
    write(skills, "skills")
    write(rules, "title_rules")
    build(raw, entries, ordered, dimension, write, watch=audit.watched, **options)
    none = out.spark.createDataFrame([], FAILURES)
    found = audit.failures()
    failures = version.write(none if found is None else found, "failures")
    if failures.where("severity = 'error'").isEmpty():
        out.publish(version, {WHOLE: [t for t in audit.tables if t != "stg_postings"] + ["failures"]})
    return failures
