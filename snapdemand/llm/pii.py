"""Personal data: generators propose spans, boosted trees weigh their format and context, thresholds select.

What the trees learn is not the check that a candidate passes, but what the words before candidates say of them: "born"
speaks for a date of birth, "order" against a number being personal. The trees see format and signs, never these words,
so what they learn from candidates with such a word holds for those without.

Everything here is DataFrame expressions. Only the table of distinct feature vectors and their counts, whose size the bins
bound, reaches the driver, where the trees are fitted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, fit
from .spans import cut_out, let, scanned
from .tables import fresh, written

#: share of output that must be right, at the threshold of its kind
PRECISION = 0.8
#: characters before a candidate that are its context
CONTEXT = 24
#: odds by which a word before a candidate speaks for or against it
CUE = 20.0
#: candidates that what is known of a kind beforehand counts as, when its threshold is set
PRIOR = 4.0

_LOCAL = "A-Za-z0-9._%+-"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """13 to 19 digits, the last of which is the Luhn check digit."""
    d = _digits(value)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), lambda i: F.substr(F.reverse(d), i, F.lit(1)).cast("int"))
    doubled = F.transform(each, lambda n, i: F.when(i % 2 == 0, n).otherwise(2 * n - F.when(n > 4, 9).otherwise(0)))
    return F.when(F.length(d).between(13, 19), F.aggregate(doubled, F.lit(0), lambda a, n: a + n) % 10 == 0).otherwise(False)


def _octets(value: Column) -> Column:
    """Every part is 255 at most, leading zeros aside."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.coalesce(F.when(p != "", p.cast("int")), F.lit(0)) <= 255).otherwise(False))


def _iban(value: Column) -> Column:
    """Country and check digits moved behind the rest and letters read as 10 to 35, the number is 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    codes = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substr(turned, i, F.lit(1))))
    rest = F.aggregate(codes, F.lit(0), lambda a, c: F.when(c >= 65, a * 100 + c - 55).otherwise(a * 10 + c - 48) % 97)
    return rest == 1


def _ipv6(value: Column) -> Column:
    """Eight groups, or one gap and three to seven groups; some digit."""
    groups = F.size(F.filter(F.split(value, ":"), lambda g: g != ""))
    gaps = F.regexp_count(value, F.lit("::"))
    whole = (gaps == 0) & (groups == 8) & ~value.startswith(":")
    return (whole | ((gaps == 1) & ~value.contains(":::") & groups.between(3, 7))) & value.rlike("[0-9]")


def _birth(value: Column) -> Column:
    """A day from 1900 on; of two numbers up to 31, one is a month."""
    parts = F.transform(F.split(value, "[/.-]"), lambda p: p.cast("int"))
    first = F.length(F.regexp_extract(value, "^[0-9]+", 0)) == 4
    year, a, b = F.when(first, parts[0]).otherwise(parts[2]), parts[1], F.when(first, parts[2]).otherwise(parts[0])
    return year.between(1900, 2029) & a.between(1, 31) & b.between(1, 31) & (F.least(a, b) <= 12)


@dataclass(frozen=True)
class Kind:
    """A generator: ``may`` is a cheap test that holds for every text with a match, ``check`` decides on a match.

    ``cue`` are words that speak for this kind when they stand before a match. ``doubt`` are the odds, before any document
    is seen, that a match which passes its check is something else: with check digits, how often others pass by chance.
    """

    name: str
    pattern: str
    may: Callable[[Column], Column]
    check: Callable[[Column], Column]
    cue: str
    base: bool = False
    doubt: float = 0.05


def _numeric(text: Column) -> Column:
    return text.rlike("[0-9]")


_MAIL = "mail|e-mail|email|contact|reach|write"
_CALL = "tel|phone|call|fax|mobile|cell|dial"
_CARD = "card|visa|mastercard|credit|debit"
_HOST = "ip|ipv6|host|address|client|peer"
#: words that speak against any kind
OTHER = "order|version|invoice|page|chapter|sku|isbn|ref|token|hash|license|section|serial|part|build|release|item|lot"

#: In the base patterns a run is entered at its first character only, or where the last match ended, and taken whole: the
#: matches are those of the plain patterns beside them, but no text takes more than linear time or deep recursion.
KINDS = [
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.\.|\.?(?:[^A-Za-z0-9.-]|\z))",
         lambda t: t.contains("@"), lambda v: F.lit(True), _MAIL, True),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]"), _octets, _HOST, True),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?=[\x20-]?[0-9])[\x200-9-]*?(?![\x20-]?[0-9])", lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), _luhn, _CARD, True),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.rlike(r"\+[0-9]"),
         lambda v: F.length(_digits(v)).between(9, 15), _CALL, True),
    # proposals of the method: they may overlap each other and those above
    Kind("number", r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])", _numeric, _luhn, _CARD, doubt=1 / 10),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _numeric,
         lambda v: ~v.rlike("^(?:000|666|9)") & ~v.rlike("-00-") & ~v.rlike("0000$"),
         "ssn|social|security|taxpayer", doubt=1 / 4),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _numeric, _iban,
         "iban|account|bank|transfer|pay", doubt=1 / 97),
    Kind("local", r"(?<![0-9+(.-])\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}(?![0-9-])", _numeric,
         lambda v: F.length(_digits(v)) == 10, _CALL, doubt=1 / 4),
    Kind("ipv6", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", lambda t: t.rlike(":[0-9A-Fa-f]{0,4}:"),
         _ipv6, _HOST, doubt=1 / 4),
    Kind("mac", r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}([:-])[0-9A-Fa-f]{2}(?:\1[0-9A-Fa-f]{2}){4}(?![0-9A-Za-z:-])",
         lambda t: t.rlike("[0-9A-Fa-f]{2}[:-][0-9A-Fa-f]{2}[:-]"), lambda v: ~v.rlike("^(?i)(?:(?:00|ff)[:-]?)+$"),
         "mac|device|adapter|ethernet|hardware|address", doubt=1 / 10),
    Kind("birth", r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9/-])",
         lambda t: t.rlike("[0-9][/.-][0-9]"), _birth, "born|birth|birthday|dob", doubt=4.0),
    Kind("spelled", rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]{{1,63}}"
         r"(?:(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]{2,63}){1,4}(?![A-Za-z0-9-])", lambda t: t.contains("dot"),
         lambda v: v.rlike("[A-Za-z]{2}$"), _MAIL, doubt=1 / 4),
]
NAMES = [k.name for k in KINDS]
BASE = [k.name for k in KINDS if k.base]

#: features of a candidate and the number of values that each can have
FEATURES = {"kind": len(KINDS), "digits": 10, "groups": 5, "signs": 5, "letters": 2, "before": 4, "after": 4, "lead": 4}


def _neighbour(c: Column) -> Column:
    """0: none or white space, 1: a letter, 2: a digit, 3: another sign."""
    return F.when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\S"), 3).otherwise(0)


def _lead(before: Column) -> Column:
    """1: starts a line, 2: behind a colon or equals sign, 3: behind a bracket or quote, 0: anything else."""
    return F.when(before.rlike(r"(?:^|\n)\s*$"), 1).when(before.rlike(r"[:=]\s*$"), 2).when(before.rlike(r"[(\[{<\"']$"), 3).otherwise(0)


def _said(kind: Kind, before: Column) -> Column:
    """1: the last word that says something speaks for the kind, 2: against it, 0: there is no such word."""
    last = rf"(?s).*\b(?:({kind.cue})|({OTHER}))\b"
    word = F.lower(before)
    return F.when(F.regexp_extract(word, last, 1) != "", 1).when(F.regexp_extract(word, last, 2) != "", 2).otherwise(0)


def _features(kind: int, value: Column, before: Column, after: Column) -> list[Column]:
    n = F.length(_digits(value))
    bins = [4, 8, 9, 10, 11, 12, 15, 16, 19]
    digits = sum((F.when(n > b, 1).otherwise(0) for b in bins[1:]), F.when(n > bins[0], 1).otherwise(0))
    named = {
        "kind": F.lit(kind), "digits": digits, "groups": F.least(F.lit(4), F.regexp_count(value, F.lit("[0-9]+"))),
        "signs": F.least(F.lit(4), F.regexp_count(value, F.lit("[^0-9A-Za-z]"))), "letters": value.rlike("[A-Za-z]").cast("int"),
        "before": _neighbour(F.right(before, F.lit(1))), "after": _neighbour(after), "lead": _lead(before)}
    return [named[f].cast("int").alias(f"f_{f}") for f in FEATURES]


_MATCH = "struct<m:string,g:string,next:string,start:bigint,end:bigint>"
_CANDIDATE = f"struct<kind:string,start:bigint,end:bigint,said:int,{','.join(f'f_{f}:int' for f in FEATURES)}>"


def proposed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column behind its own, the candidates of all kinds that pass their check, and its name.

    A candidate has ``kind, start, end, said`` (what the words before it say) and its features. Places come from the
    lengths of matches and of the texts between them, in code points. Null and empty texts have none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.columns
    found, gaps = [], []
    columns = {}
    for kind in KINDS:
        found.append(fresh(docs, f"found_{kind.name}"))
        gaps.append(fresh(docs, f"gaps_{kind.name}"))
        may = kind.may(text)
        none = F.array().cast("array<string>")
        columns[found[-1]] = F.when(may, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none)
        columns[gaps[-1]] = F.when(may, F.split(text, kind.pattern, -1)).otherwise(none)
    split = docs.select(*own, *(c.alias(n) for n, c in columns.items()))

    def after(at: Column, x: Column) -> Column:
        return at + F.length(x["g"]) + F.length(x["m"])

    all_kinds = []
    for number, (kind, m, g) in enumerate(zip(KINDS, found, gaps)):
        def spans(kind=kind, number=number, m=m, g=g) -> Column:
            near = F.zip_with(F.zip_with(m, F.slice(g, F.lit(1), F.size(m)), lambda a, b: F.struct(a.alias("m"), b.alias("g"))),
                              F.slice(g, F.lit(2), F.size(m)), lambda x, next: F.struct(x["m"].alias("m"), x["g"].alias("g"), next.alias("next")))
            placed = scanned(near, F.lit(0).cast("long"), after, lambda at, x: F.struct(
                x["m"].alias("m"), F.right(x["g"], F.lit(CONTEXT)).alias("g"), F.left(x["next"], F.lit(1)).alias("next"),
                (at + F.length(x["g"])).alias("start"), after(at, x).alias("end")), _MATCH)
            return F.transform(F.filter(placed, lambda c: kind.check(c["m"])), lambda c: F.struct(
                F.lit(kind.name).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), _said(kind, c["g"]).alias("said"),
                *_features(number, c["m"], c["g"], c["next"])))
        all_kinds.append(F.when(F.size(m) > 0, spans()).otherwise(F.array().cast(f"array<{_CANDIDATE}>")))
    name = fresh(docs, "candidates")
    return split.select(*own, F.concat(*all_kinds).alias(name)), name


@dataclass
class Model:
    """Trees over the features, and the least probability at which each kind is selected (over 1: never)."""

    trees: Trees
    thresholds: list[float]


def _known() -> np.ndarray:
    """Log odds of each kind before any document is seen."""
    return -np.log([k.doubt for k in KINDS])


def train(candidates: DataFrame, name: str, precision: float = PRECISION) -> Model:
    """Fitted on what the words before candidates say of them, which the features do not tell; counted over all documents.

    Feature vectors are counted in Spark, apart for two halves of the documents, told apart by a hash of document and
    place. One half fits the trees, which start from what is known of each kind; the other calibrates. The threshold of a
    kind is the lowest score at which, of its candidates there of that score or more with such a word, the wanted share
    is personal. What is known beforehand counts as a few candidates, so a kind without such words is decided by that,
    and other kinds have no say.
    """
    each = candidates.select("doc_id", F.explode(name).alias("c"))
    half = F.pmod(F.xxhash64("doc_id", "c.start"), F.lit(2)).alias("half")
    rows = each.groupBy(half, "c.said", *(F.col(f"c.f_{f}").alias(f) for f in FEATURES)).count().collect()
    rows.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    n, said, kind = np.array([r["count"] for r in rows], float), np.array([r["said"] for r in rows]), x[:, 0].astype(int)
    y, fits = (said == 1).astype(float), np.array([r["half"] for r in rows]) == 0
    start = _known()[kind]
    own = fits & (said > 0)
    trees = fit(x[own], y[own], trees=16, depth=3, rate=0.4, weights=n[own], offset=start[own])
    score = 1 / (1 + np.exp(-(trees.margin(x) + start)))
    held = n * (~fits & (said > 0))

    def lowest(k: int) -> float:
        mine, sure = kind == k, 1 / (1 + KINDS[k].doubt)
        assumed = PRIOR * n * mine / max(n[mine].sum(), 1.0)
        for t in np.unique(score[mine]):
            above = mine & (score >= t)
            if (held * y + assumed * sure)[above].sum() >= (precision - 1e-9) * (held + assumed)[above].sum():
                return float(t) - 1e-9
        return 2.0

    return Model(trees, [lowest(k) for k in range(len(KINDS))])


def _by_kind(rank: Column, values: list[float]) -> Column:
    out = F.lit(float(values[0]))
    for k, value in enumerate(values[1:], 1):
        out = F.when(rank == k, F.lit(float(value))).otherwise(out)
    return out


def _score(trees: Trees, c: Column) -> Column:
    """The trees' log odds, what is known of the kind and what the words before say, as a probability."""
    names = [f"f_{f}" for f in FEATURES]

    def walk(t: int, node: int) -> Column:
        left, right = int(trees.left[t][node]), int(trees.right[t][node])
        if left == node:
            return F.lit(float(trees.value[t][node]))
        return F.when(c[names[int(trees.feature[t][node])]] <= float(trees.threshold[t][node]), walk(t, left)).otherwise(walk(t, right))

    margin = sum((walk(t, 0) for t in range(len(trees.feature))), F.lit(float(trees.base)))
    cue = float(np.log(CUE))
    said = F.when(c["said"] == 1, cue).when(c["said"] == 2, -cue).otherwise(0.0)
    return 1 / (1 + F.exp(-(margin + _by_kind(c["f_kind"], _known().tolist()) + said)))


_SPAN = "struct<start:bigint,end:bigint,rank:int,doubt:double,kind:string,score:double>"


def _clear_of_base(spans: Column) -> Column:
    """``spans``, sorted by start, without added ones that overlap a base span; one pass each way."""
    def pass_(items: Column, first: int, step, hits) -> Column:
        marked = scanned(items, F.lit(first).cast("long"), lambda s, x: F.when(x["rank"] < len(BASE), step(s, x)).otherwise(s),
                         lambda s, x: F.struct(x.alias("x"), ((x["rank"] >= len(BASE)) & hits(s, x)).alias("hit")), f"struct<x:{_SPAN},hit:boolean>")
        return F.transform(F.filter(marked, lambda v: ~v["hit"]), lambda v: v["x"])

    ahead = pass_(spans, -1, lambda s, x: F.greatest(s, x["end"]), lambda s, x: x["start"] < s)
    return F.reverse(pass_(F.reverse(ahead), (1 << 62), lambda s, x: F.least(s, x["start"]), lambda s, x: x["end"] > s))


def _best_apart(spans: Column) -> Column:
    """Of added ``spans``, sorted by start, those that no better kept one overlaps: decided in each chain of overlaps apart."""
    marked = scanned(spans, F.lit(-1).cast("long"), lambda s, x: F.greatest(s, x["end"]),
                     lambda s, x: F.struct(x.alias("x"), (x["start"] >= s).alias("new")), f"struct<x:{_SPAN},new:boolean>")

    def best(chain: Column) -> Column:
        ranked = F.array_sort(F.transform(chain, lambda v: F.struct(
            v["x"]["doubt"].alias("doubt"), (1 - v["x"]["score"]).alias("order"), v["x"]["start"].alias("start"), v["x"]["rank"].alias("rank"), v["x"].alias("x"))))
        return F.aggregate(ranked, F.array().cast(f"array<{_SPAN}>"), lambda have, v: F.when(
            F.exists(have, lambda h: (h["start"] < v["x"]["end"]) & (v["x"]["start"] < h["end"])), have).otherwise(F.concat(have, F.array(v["x"]))))

    def chains(all_: Column) -> Column:
        firsts = F.filter(F.transform(all_, lambda v, i: F.when(v["new"], i + 1)), lambda i: i.isNotNull())
        return let(firsts, lambda at: F.transform(at, lambda s, j: best(
            F.slice(all_, s, F.coalesce(F.get(at, j + 1), F.size(all_) + 1) - s))))

    return F.flatten(let(marked, chains))


def selected(candidates: str | Column, model: Model) -> Column:
    """``array<struct<kind,start,end,score>>``: base candidates, and others that score enough.

    A candidate with a word before it that says something is taken from the wanted precision on, any other from the
    threshold of its kind on. Of added spans that overlap one another the one whose kind leaves least doubt stays, then the
    best score, then the first; one that overlaps a base span goes. Time grows with the number of spans, and with
    the square only of those that form one chain of overlaps.
    Sorted by kind, as listed, then start.
    """
    c = F.col(candidates) if isinstance(candidates, str) else candidates
    scored = F.transform(c, lambda x: F.struct(x.alias("x"), _score(model.trees, x).alias("score")))
    good = F.filter(scored, lambda v: (v["x"]["f_kind"] < len(BASE)) | F.when(
        v["x"]["said"] == 0, v["score"] >= _by_kind(v["x"]["f_kind"], model.thresholds)).otherwise(v["score"] >= PRECISION))
    by_place = F.array_sort(F.transform(good, lambda v: F.struct(
        v["x"]["start"].alias("start"), v["x"]["end"].alias("end"), v["x"]["f_kind"].alias("rank"),
        _by_kind(v["x"]["f_kind"], [k.doubt for k in KINDS]).alias("doubt"), v["x"]["kind"].alias("kind"), v["score"].alias("score"))))
    kept = let(_clear_of_base(by_place), lambda all_: F.concat(
        F.filter(all_, lambda x: x["rank"] < len(BASE)), _best_apart(F.filter(all_, lambda x: x["rank"] >= len(BASE)))))
    order = F.array_sort(F.transform(kept, lambda x: F.struct(
        x["rank"].alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["score"].alias("score"))))
    return F.transform(order, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["score"].alias("score")))


def found(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` for every row of ``docs(doc_id, text)``; texts are read once, candidates are written down."""
    candidates, name = proposed(docs.select("doc_id", "text"))
    rows = written(candidates.select("doc_id", name), "candidates")
    model = train(rows, name)
    spans = selected(name, model)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return rows.select("doc_id", F.when(F.size(name) > 0, spans).otherwise(none).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[PERSONAL]") -> DataFrame:
    """``docs`` with every selected span replaced by ``mark``; other rows and columns stay as they are, and null stays null."""
    candidates, name = proposed(docs)
    model = train(candidates, name)
    spans = F.array_sort(F.transform(selected(name, model), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"))))
    own = fresh(candidates, "cuts")
    return cut_out(candidates.withColumn(own, spans), own, mark).select(*docs.columns)
