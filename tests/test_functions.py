import datetime
import html as stdlib_html
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions import dates, html, places, text

NBSP, IDEOGRAPHIC = chr(0xA0), chr(0x3000)
DAY = datetime.date(2027, 5, 19)


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x"))).first()[0]


def table(spark, cases, fn):
    """The results of ``fn`` over the first items of all cases, beside what is wanted."""
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [(x, got[i], want) for i, (x, want) in enumerate(cases) if got[i] != want]


def test_every_notation_of_many_days_is_read_back(spark):
    rng, cases = random.Random(1), []
    for _ in range(300):
        day = DAY - datetime.timedelta(rng.randint(0, 900))
        back = (DAY - day).days
        at = datetime.datetime.combine(day, datetime.time(rng.randint(0, 23), rng.randint(0, 59)), datetime.timezone.utc)
        cases += [
            (rng.choice(["posted {} days ago", "POSTED {} DAYS AGO", "Posted {}+ Days Ago", "posted {} day ago"]).format(back), day),
            (day.isoformat() + rng.choice(["", "T00:00:00Z", "T23:59:59.999-12:00", " whatever"]), day),
            (str(int(at.timestamp()) * 1000 + rng.randint(0, 999)), day),
            (day.strftime("%B") + " " * rng.randint(1, 3) + str(day.day) + "," + " " * rng.randint(1, 3) + str(day.year), day),
            (day.strftime("%B").lower() + day.strftime(" %d, %Y"), day)]
    cases += [(word, DAY - datetime.timedelta(n)) for n, w in enumerate(["today", "yesterday"])
              for word in (f"posted {w}", f"{NBSP}POSTED {w.upper()}{NBSP}", f"  Posted {w.title()} ")]
    assert table(spark, cases, lambda c: dates.parse_when(c, F.lit(DAY))) == []


def test_what_is_no_date_is_null(spark):
    broken = ["", "soon", "posted tomorrow", "posted -1 days ago", "posted 2 weeks ago", "posted 5 days ago.", "\tposted 5 days ago",
              "posted 5 days ago\n", f"posted {10 ** 12} days ago", "2027-13-01", "2027-04-31", "27-04-01", "x2027-04-01",
              "1" * 11, "1" * 14, "1" * 12 + " ", "Sept 3, 2027", "April 31, 2027", "April 3 2027", "3 April, 2027", "April 3, 27", None]
    assert table(spark, [(b, None) for b in broken], lambda c: dates.parse_when(c, F.lit(DAY))) == []


def leftmost_city(where):
    """The city of the place name that comes first; the country's bucket if only the country is named."""
    low = (where or "").lower()
    found = [(low.index(name), i) for i, name in enumerate(model.PLACES) if name in low]
    if found:
        return list(model.PLACES.values())[min(found)[1]]
    return model.COUNTRY_BUCKET if model.COUNTRY_NAME.lower() in low else None


def test_the_first_place_named_decides(spark):
    rng, names = random.Random(2), list(model.PLACES)
    texts = [None, "", "Lyon", model.COUNTRY_NAME.upper(), f"Lyon, {model.COUNTRY_NAME}", *names, *(f"x{n.upper()}y" for n in names)]
    for _ in range(200):
        texts.append(rng.choice([" / ", ", ", "", " near "]).join(
            rng.choice([*names, "Lyon", "harbour", model.COUNTRY_NAME]).title() for _ in range(rng.randint(1, 4))))
    assert table(spark, [(t, leftmost_city(t)) for t in texts], places.canonical_place) == []


def test_region_asks_the_title_only_without_a_location(spark):
    home = next(iter(model.PLACES)).title()
    pairs = [(a, b) for a in (home, "Lyon", "", None) for b in (f"Baker in {home}", "Baker", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(places.in_region(F.col("a"), F.col("b"))).collect()]
    assert got == [home in (a or b or "") for a, b in pairs]


def test_many_places(spark):
    yes = [f"{n} {word}" for n in (2, 17, 305) for word in ("locations", "Locations", "LOCATIONS")]
    no = ["locations", "two locations", "2 locations!", "in 2 locations", "2 locations\n", None]
    assert table(spark, [(t, True) for t in yes] + [(t, False) for t in no], places.many_places) == []


def test_trim_takes_space_separators_only(spark):
    assert one(spark, f" {NBSP}{IDEOGRAPHIC}a b\t{NBSP}", text.trim_zs) == "a b\t"
    assert one(spark, f"a{NBSP}b{NBSP}", text.plain_spaces) == "a b"
    assert one(spark, f" {NBSP}", text.blank_to_null) is None
    assert one(spark, "\t\n", text.blank_to_null) == "\t\n"


def test_keys_are_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(text.entity_key(F.col("x"), F.col("y"))).collect()] == ["a:b", None]
    assert [r[0] for r in df.select(text.searchable(F.col("x"), F.col("y"))).collect()] == ["a b", "a "]


def test_ordered_distinct_join(spark):
    got = one(spark, ["b", None, "a", "b", ""], text.join_distinct, "array<string>")
    assert got == "b; a; "
    assert one(spark, [" b ", None, "", "a", "b"], lambda c: text.join_distinct(text.stripped_places(c)), "array<string>") == "b; a"


@pytest.mark.parametrize("markup, plain", [
    ("<li>Tea &amp; Milk</li><p>قهوة</p>", "Tea & Milk قهوة"), (None, None), ("", ""),
    ("a<b>b</b>c", "a b c"), ("<script>var t='</p>';</script>x<style>p{}</style>y<!-- c > d -->z", "x y z"),
    ("<a title='x>y'>t</a>", "t"), ("a < b", "a < b"), ("<p>x<br/>y</p ><p", "x y"),
    ("<!DOCTYPE html>  hi \n there  <template><p>no</p></template>", "hi \n there"), ("<scripty>keep</scripty>", "keep"),
    ("<style>p</style><script>q</script>r", "r"), ("it's <i>don't</i>", "it's don't"), (f"<p>{NBSP}a&nbsp;</p>", "a"),
])
def test_html_to_text(spark, markup, plain):
    assert one(spark, markup, html.html_to_text) == plain


def test_entities_like_the_standard_library(spark):
    samples = ["a &amp; b", "&ampx", "&lt;p&gt;", "&#65;&#x42;&#x1F600;", "&#128;", "&#0;", "&#xD800;", "&#99999999999;",
               "&hellip;&hellip", "&notit;", "&notin;", "&unknown;", "&", "&&", "& &amp;amp;", "x&copy", "&#1;", "&#xFDD0;",
               "&am", "&frac12x", "&NotEqualTilde;", "&;", "&#;", "&#x;", "&eacute;&Eacute"]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    for r in df.select("x", html.unescape_entities(F.col("x")).alias("y")).collect():
        assert r.y == stdlib_html.unescape(r.x), r.x


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="&#;xampltgquo123 ", max_size=14), min_size=1, max_size=60))
def test_entities_of_random_texts(spark, samples):
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = {r.x: r.y for r in df.select("x", html.unescape_entities(F.col("x")).alias("y")).collect()}
    assert got == {s: stdlib_html.unescape(s) for s in samples}


def test_week_and_span(spark):
    df = spark.sql("select date'2026-09-27' sunday, date'2026-09-28' monday")
    r = df.select(dates.week_start(F.col("sunday")), dates.week_start(F.col("monday")),
                  dates.span_days(F.col("sunday"), F.col("monday"))).first()
    assert tuple(r) == (datetime.date(2026, 9, 21), datetime.date(2026, 9, 28), 2)


def test_epoch_text(spark):
    df = spark.createDataFrame([(1712345600000,), (0,), (None,)], "x bigint")
    assert [r[0] for r in df.select(dates.epoch_text(F.col("x"), "ms")).collect()] == ["2024-04-05", "", ""]
