"""Write, audit, publish: expectations about tables, most of them decided by the write itself.

An expectation about single rows (a null, a value outside a list, a condition) is a metric that Spark counts while it
writes the table, so it costs no second scan. Expectations about several rows (unique, relationships) are grouped
checks on the staged tables. Only where a metric is not 0 are the offending rows looked up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import Entry, Rule
from snapdemand.quality import checks
from snapdemand.sinks import Writer

FAILURES = "check string, severity string, key string, detail string"


@dataclass(frozen=True)
class Expectation:
    """``failures`` gives the offending rows of the tables written so far; ``broken`` holds for a row of ``table`` that is one."""

    name: str
    table: str
    failures: Callable[[dict[str, DataFrame]], DataFrame]
    broken: Column | None = None


def not_null(name: str, table: str, column: str, keys: Sequence[str]) -> Expectation:
    return Expectation(name, table, lambda t: checks.check_not_null(t[table], column, keys, name), F.col(column).isNull())


def accepted(name: str, table: str, column: str, values: Sequence[str]) -> Expectation:
    return Expectation(name, table, lambda t: checks.check_accepted(t[table], column, values, name), ~F.col(column).isin(*values))


def unique(name: str, table: str, columns: Sequence[str]) -> Expectation:
    return Expectation(name, table, lambda t: checks.check_unique(t[table], columns, name))


def relates(name: str, table: str, column: str, parent: str) -> Expectation:
    return Expectation(name, table, lambda t: checks.check_fk(t[table], column, t[parent], column, name))


def each(name: str, table: str, broken: Column, keys: Sequence[str], detail: Column, severity: str = "error") -> Expectation:
    return Expectation(name, table, lambda t: checks.check_rows(t[table], broken, keys, detail, name, severity), broken)


def _day(name: str) -> Column:
    return F.concat_ws(" > ", F.col("posted_date").cast("string"), F.col(name).cast("string"))


def expectations(
    dictionary: Sequence[Entry], rules: Sequence[Rule], tag_cases: DataFrame | None = None, label_cases: DataFrame | None = None,
    scopes: dict = model.SCOPES, families: Sequence[str] = model.SCOPES["all"], seniorities: Sequence[str] = model.SENIORITIES,
    defaults: dict[str, str] = model.RULE_DEFAULTS,
) -> list[Expectation]:
    """What has to hold before the warehouse is published.

    Lifecycle and labels are columns of one table, ``entities``, so their expectations are about that. A day that holds a
    posting twice shows there too: the posting then has more rows than days. ``tag_cases`` is (text, skill, should_match),
    ``label_cases`` (title and one column for each field).
    """
    key, bridge, weekly = "posting_key", "fct_posting_skills", "mart_skill_demand_weekly"
    day = ["week_start", "skill", "role_scope"]
    found = [
        unique("skills_unique", "skills", ["skill"]),
        *[not_null(f"skills_{c}_not_null", "skills", c, ["skill"]) for c in ("skill", "category", "pattern")],
        accepted("rules_field_accepted", "title_rules", "field", list(defaults)),
        not_null("staging_key_not_null", "stg_postings", key, ["source_system", "posting_id"]),
        not_null("staging_day_not_null", "stg_postings", "collected_date", [key]),
        each("staging_unique_per_day", "entities", F.col("_rows") > F.size("_days"), [key],
             F.concat_ws(" rows on ", F.col("_rows").cast("string"), F.size("_days").cast("string"))),
        Expectation("latest_run_has_rows", "entities", lambda t: checks.check_run_has_rows(t["entities"], "last_seen", "latest_run_has_rows")),
        unique("lifecycle_unique", "entities", [key]),
        not_null("lifecycle_key_not_null", "entities", key, [key]),
        unique("roles_unique", "entities", [key]),
        not_null("roles_key_not_null", "entities", key, [key]),
        accepted("roles_family_accepted", "entities", "role_family", families),
        accepted("roles_seniority_accepted", "entities", "seniority", seniorities),
        each("skills_listed_once", "entities", F.size("tags") > F.size(F.array_distinct(F.transform("tags", lambda x: x["skill"]))), [key],
             F.array_join(F.transform("tags", lambda x: x["skill"]), ",")),
        unique("company_unique", "dim_company", ["company_key"]),
        not_null("company_key_not_null", "dim_company", "company_key", ["name"]),
        unique("postings_unique", "fct_postings", [key]),
        not_null("postings_key_not_null", "fct_postings", key, [key]),
        not_null("postings_company_not_null", "fct_postings", "company_key", [key]),
        relates("postings_company_known", "fct_postings", "company_key", "dim_company"),
        not_null("bridge_key_not_null", bridge, key, ["skill"]),
        not_null("bridge_skill_not_null", bridge, "skill", [key]),
        relates("bridge_company_known", bridge, "company_key", "dim_company"),
        unique("bridge_unique", bridge, [key, "skill"]),
        accepted("weekly_scope_accepted", weekly, "role_scope", list(scopes)),
        each("share_in_range", weekly, (F.col("share") < 0) | (F.col("share") > 1), day, F.col("share")),
        each("posted_after_last_seen", "fct_postings", F.col("posted_date") > F.col("last_seen"), [key], _day("last_seen")),
        each("posted_after_first_seen", "fct_postings", F.col("posted_date") > F.col("first_seen"), [key], _day("first_seen"), "warn"),
    ]
    if tag_cases is not None:
        found.append(Expectation("golden_tags", "skills", lambda t: checks.check_golden_tags(tag_cases, dictionary)))
    if label_cases is not None:
        found.append(Expectation("golden_labels", "title_rules", lambda t: checks.check_golden_labels(label_cases, rules, defaults=defaults)))
    return found


@dataclass
class Audit:
    """Counts broken rows while tables are written, then says what failed."""

    expected: Sequence[Expectation]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    broken: dict[str, int | None] = field(default_factory=dict)
    _open: list[tuple[list[Expectation], Observation]] = field(default_factory=list)

    def watched(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` with a metric for each expectation about its single rows; they are counted when it is first computed."""
        rows = [e for e in self.expected if e.table == table and e.broken is not None]
        self.tables.setdefault(table, df)
        if not rows:
            return df
        seen = Observation()
        self._open.append((rows, seen))
        return df.observe(seen, *[F.count_if(e.broken).alias(e.name) for e in rows])

    def writer(self, write: Writer) -> Writer:
        """``write`` that watches what it writes and remembers the written table."""
        def watching(df: DataFrame, table: str) -> DataFrame:
            written = write(self.watched(df, table), table)
            self.tables[table] = written
            self._collect()
            return written
        return watching

    def _collect(self) -> None:
        for rows, seen in self._open:
            try:
                counted = seen.get
            except Py4JJavaError:  # a table that the optimiser knows to be empty has no metrics
                counted = {}
            self.broken |= {e.name: counted.get(e.name) for e in rows}
        self._open = []

    def failures(self) -> DataFrame | None:
        """The offending rows of all expectations that fail or that no metric decides; None if there are none of these."""
        self._collect()
        open_ = [e for e in self.expected if e.table in self.tables and (e.broken is None or self.broken.get(e.name) != 0)]
        return checks.all_failures(*[e.failures(self.tables) for e in open_]) if open_ else None

