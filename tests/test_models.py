"""The models against plain Python over generated snapshots, and the cases that such rows reach too rarely."""

import datetime
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import Entry, Rule
from snapdemand.operators import rank
from snapdemand.operators.classify import matching_rules
from snapdemand.operators.demand import daily_demand, scoped_demand, weekly_demand, weekly_demand_unscoped
from snapdemand.operators.dictionary import tag_by_table
from snapdemand.operators.lifecycle import latest_row, latest_value
from snapdemand.operators.snapshots import dedupe_first
from snapdemand.operators.tagging import tag
from snapdemand.plans import warehouse as w
from snapdemand.plans.skill_demand import skill_demand_weekly
from snapdemand.quality import checks as qa

STG = ("posting_key string, company_key string, title string, city string, url string, posted_date date, "
       "description_clean string, collected_date date")
FIRST = datetime.date(2031, 3, 3)
INSTRUMENTS = [Entry(n, "wind" if i % 2 else "string", rf"\b{n}\b") for i, n in enumerate(["cello", "oboe", "lute", "tuba"])]
INSTRUMENTS += [Entry("horn", "wind", r"\b(french|alpine) horn\b"), Entry("lute", "string", r"\btheorbo\b")]
RULES = [Rule("role_family", 5, r"\bconductor\b", "software"), Rule("role_family", 7, r"\bscore", "ai_ml"),
         Rule("role_family", 7, r"\bstage\b", "data_analysis"), Rule("seniority", 1, r"\bchief\b", "senior"),
         Rule("seniority", 2, r"\bpupil\b", "intern")]
WORDS = "cello oboe lute tuba theorbo french alpine horn conductor score stage chief pupil hall choir".split()


def history(seed, postings=40, days=24):
    """(key, title, description, day, posted) of postings seen on some days each."""
    rng, rows = random.Random(seed), []
    for p in range(postings):
        for d in sorted(rng.sample(range(days), rng.randint(1, 6))):
            said = " ".join(rng.choices(WORDS, k=3)) if rng.random() < 0.4 else None
            posted = FIRST + datetime.timedelta(rng.randint(-9, d)) if rng.random() < 0.5 else None
            rows.append((f"p{p}", " ".join(rng.choices(WORDS, k=rng.randint(0, 3))).title(), said, FIRST + datetime.timedelta(d), posted))
    return rows


def stg(spark, rows):
    return spark.createDataFrame([(k, "c", t, "Giza", "u", p, d, on) for k, t, d, on, p in rows], STG)


class Plain:
    """The models of a history, row by row."""

    def __init__(self, rows):
        self.days = defaultdict(set)
        newest, told, posted = {}, {}, defaultdict(list)
        for k, t, d, on, p in sorted(rows, key=lambda r: r[3]):
            self.days[k].add(on)
            newest[k] = t
            posted[k] += [p] if p else []
            if d is not None:
                told[k] = d
        end = max(on for _, _, _, on, _ in rows)
        self.life = [(k, newest[k], min(posted[k], default=None), min(s), max(s), max(s) == end, (max(s) - min(s)).days + 1)
                     for k, s in self.days.items()]
        text = {k: f"{newest[k]} {told.get(k, '')}".lower() for k in newest}
        self.skills = {(k, e.skill, e.category) for k in text for e in INSTRUMENTS if re.search(e.pattern, text[k])}
        self.labels = {k: tuple(self._label(newest[k].lower(), f) for f in ("role_family", "seniority")) for k in newest}
        self.first = {k: min(s) for k, s in self.days.items()}

    @staticmethod
    def _label(title, field):
        won = [(r.priority, r.value) for r in RULES if r.field == field and re.search(r.pattern, title)]
        return min(won)[1] if won else model.RULE_DEFAULTS[field]

    def weekly(self, scopes):
        members = defaultdict(set)
        for k, seen in self.days.items():
            for day in seen:
                for scope, families in scopes.items():
                    if families is None or self.labels[k][0] in families:
                        members[day - datetime.timedelta(day.weekday()), scope].add(k)
        out = []
        for (week, scope), keys in members.items():
            counts = defaultdict(int)
            for k, skill, category in self.skills:
                counts[skill, category] += k in keys
            out += [(week, s, c, scope, n, n / len(keys)) for (s, c), n in counts.items() if n]
        return sorted(out)

    def daily(self):
        days = {d for s in self.days.values() for d in s}
        families = {f for f, _ in self.labels.values()}
        return sorted((d, f, sum(d in self.days[k] and self.labels[k][0] == f for k in self.days),
                       sum(self.first[k] == d and self.labels[k][0] == f for k in self.days)) for d in days for f in families)


@pytest.fixture(scope="module", params=[11, 12])
def both(request, spark):
    rows = history(request.param)
    return stg(spark, rows).cache(), Plain(rows)


def test_lifecycle(both, rows):
    table, plain = both
    got = rows(w.posting_lifecycle(table), "posting_key", "title", "posted_date", "first_seen", "last_seen", "is_open", "days_open")
    assert got == sorted(plain.life, key=repr)


def test_tags_by_expressions_and_by_a_table(both, rows, spark):
    table, plain = both
    assert rows(w.posting_skills(table, INSTRUMENTS)) == sorted(plain.skills)
    listed = spark.createDataFrame([(e.skill, e.category, e.pattern) for e in INSTRUMENTS], model.DICTIONARY_SCHEMA)
    assert rows(tag_by_table(w.posting_texts(table), ["posting_key"], "text", listed)) == sorted(plain.skills)


def test_labels(both, rows):
    table, plain = both
    assert rows(w.posting_roles(table, RULES)) == sorted((k, *v) for k, v in plain.labels.items())


def parts(both, spark):
    table, plain = both
    facts = spark.createDataFrame([(k, v[0], plain.first[k]) for k, v in plain.labels.items()],
                                  "posting_key string, role_family string, first_seen date")
    tags = spark.createDataFrame(sorted(plain.skills), "posting_key string, skill string, category string")
    return table.select("posting_key", "collected_date"), facts, tags


def test_weekly_marts(both, rows, spark):
    seen, facts, tags = parts(both, spark)
    got = rows(weekly_demand(seen, facts, tags), "week_start", "skill", "category", "role_scope", "open_postings", "share")
    assert sorted(got) == both[1].weekly(model.SCOPES)
    got = rows(weekly_demand_unscoped(seen, tags), "week_start", "skill", "category", "open_postings", "share")
    assert sorted(got) == sorted(r[:3] + r[4:] for r in both[1].weekly({"": None}))
    assert [t for _, t in weekly_demand(seen, facts, tags).dtypes] == ["date", "string", "string", "string", "bigint", "double"]


def test_a_family_that_no_scope_lists_counts_in_the_unscoped_mart_only(both, spark):
    seen, facts, tags = parts(both, spark)
    assert weekly_demand(seen, facts.withColumn("role_family", F.lit("brass band")), tags).isEmpty()
    assert not weekly_demand_unscoped(seen, tags).isEmpty()


def test_daily_mart_has_every_cell(both, rows, spark):
    seen, facts, _ = parts(both, spark)
    never = spark.createDataFrame([("unseen", facts.first().role_family, FIRST - datetime.timedelta(40))], facts.schema)
    got = rows(daily_demand(seen, facts.union(never)), "day", "role_family", "open_postings", "new_postings")
    assert sorted(got) == both[1].daily()


def test_latest_values(both, rows):
    table, _ = both
    want = {}
    for r in sorted(table.collect(), key=lambda r: r.collected_date):
        if r.description_clean is not None:
            want[r.posting_key] = r.description_clean
    assert rows(latest_value(table, ["posting_key"], "collected_date", "description_clean")) == sorted(want.items())


def test_rules_of_one_priority_are_ranked_by_value(spark, rows):
    df = spark.createDataFrame([("k", "Stage Score")], "k string, t string")
    assert rows(matching_rules(df, ["k"], "t", RULES), "value", "rn") == [("ai_ml", 1), ("data_analysis", 2)]


def test_letters_that_fold_onto_ascii(spark, rows):
    long_s, kelvin = chr(0x17F), chr(0x212A)
    entries = [Entry("sk", "x", r"\bsky\b"), Entry("k", "x", r"\bk9\b")]
    texts = [("plain", "SKY!"), ("inside", f"s{kelvin}y"), ("edge", f"{long_s}ky"), ("after a letter", f"x{long_s}ky"),
             ("two", f"k9 {kelvin}9"), ("none", "skype"), ("null", None)]
    df = spark.createDataFrame(texts, "k string, t string")
    got = rows(tag(df, ["k"], "t", entries), "k", "skill")
    assert got == [("after a letter", "sk"), ("inside", "sk"), ("plain", "sk"), ("two", "k")]
    listed = spark.createDataFrame([(e.skill, e.category, e.pattern) for e in entries], model.DICTIONARY_SCHEMA)
    assert rows(tag_by_table(df, ["k"], "t", listed), "k", "skill") == got
    assert tag(df, ["k"], "t", []).isEmpty() and tag_by_table(df, ["k"], "t", listed.limit(0)).isEmpty()


def test_one_hot_key_and_copies(spark):
    """A third of all rows under one key: one row per key comes out, with exact counts."""
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.date_add(F.lit(FIRST), (F.col("id") % 50).cast("int")).alias("d"), F.col("id"))
    assert latest_row(hot, ["k"], "d", ["id"]).count() == 2001
    newest = max((i % 50, i) for i in range(0, 3000, 3))
    assert latest_row(hot, ["k"], "d", ["id"]).where("k = 'hot'").first().id == newest[1]
    assert dedupe_first(hot, ["k"], ["id"]).where("k = 'hot'").first().id == 0


def test_both_ways_to_the_unscoped_mart_agree_and_a_difference_is_told(spark):
    rows = [("s", "c", k, f" {t} ", "Cairo", "", "u", d, str(on)) for k, t, d, on, _ in history(13, 12)]
    raw = spark.createDataFrame(rows, "source_system string, company_key string, posting_id string, title string, "
                                "location string, posted_raw string, url string, description string, collected_at string")
    everything = {"all": tuple({*model.SCOPES["all"], "software", "ai_ml", "data_analysis", "other"})}
    scoped = scoped_demand(w.entities(w.staging(raw), INSTRUMENTS, RULES), everything)
    ours, by, same = skill_demand_weekly(raw, INSTRUMENTS), ["week_start", "skill"], ["category", "open_postings"]
    n = ours.count()
    assert n > 10 and qa.check_agree(ours, scoped, by, same, ["share"]).count() == 0
    assert qa.check_agree(ours, scoped.withColumn("share", F.col("share") + 1e-6), by, same, ["share"]).count() == n


@pytest.mark.parametrize("k", [1, 2, 4])
def test_top_k(spark, rows, k):
    given = [(g, f"n{i}", (i * 7 + ord(g)) % 4) for g in "ab" for i in range(9)]
    got = rows(rank.top_k(spark.createDataFrame(given, "g string, name string, n int"), ["g"], [F.desc("n"), F.asc("name")], k), "g", "name", "n")
    assert got == sorted(x for g in "ab" for x in sorted((r for r in given if r[0] == g), key=lambda r: (-r[2], r[1]))[:k])


def test_trend_has_a_value_for_every_week(spark):
    weeks = [FIRST + datetime.timedelta(7 * i) for i in range(4)]
    rows = [(weeks[0], "oboe", "wind", "tech", 4), (weeks[3], "oboe", "wind", "tech", 1), (weeks[2], "lute", "string", "tech", 9),
            (weeks[3], "lute", "string", "tech", 2), (weeks[1], "lute", "string", "all", 8)]
    mart = spark.createDataFrame(rows, "week_start date, skill string, category string, role_scope string, open_postings bigint")
    assert {r.skill: r.series for r in rank.trend(mart).collect()} == {"oboe": [4, 0, 0, 1], "lute": [0, 0, 9, 2]}
