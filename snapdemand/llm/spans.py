"""Spans of texts as columns: writing them out, and cutting them out of their text; arrays gone through in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listed(spans: str | Column, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined, of some kinds only if given."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    picked = F.filter(spans, lambda s: s["kind"].isin(kinds)) if kinds else spans
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def cut_out(rows: DataFrame, spans: str, mark: str) -> DataFrame:
    """``rows`` with each of ``spans``, sorted by start, replaced by ``mark`` in ``text``; overlapping ones become one.

    ``n_chars``, if there, is kept right. Rows without a span stay as they are.
    """
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    kept = F.aggregate(
        spans, start,
        # left to right: the text between the end so far and the next start
        lambda done, s: F.when(s["start"] < done["at"], F.struct(
            F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))).otherwise(F.struct(
                s["end"].alias("at"), F.concat(done["out"], F.array(F.substr(
                    F.col("text"), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")))).alias("out"))),
        lambda done: F.array_join(F.concat(done["out"], F.array(F.substr(F.col("text"), (done["at"] + 1).cast("int")))), mark))
    some = F.size(spans) > 0
    out = rows.withColumn("text", F.when(some, kept).otherwise(F.col("text")))
    if "n_chars" in rows.columns:
        kind = rows.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out


#: elements that are gone through before what they gave is put away: appending to an array copies it
_BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def scanned(items: Column, state: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """``array<kind>``: for each of ``items`` in order ``emit(state, item)``, after which ``step(state, item)`` is the state.

    Goes through blocks, so that time grows with the number of items and hardly with its square.
    """
    def block(done: Column, part: Column) -> Column:
        inner = F.aggregate(
            part, F.struct(done["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("out")),
            lambda a, x: F.struct(step(a["state"], x).alias("state"), F.concat(a["out"], F.array(emit(a["state"], x))).alias("out")))
        return let(inner, lambda i: F.struct(i["state"].alias("state"), F.concat(done["out"], F.array(i["out"])).alias("out")))

    def blocks(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / F.lit(_BLOCK)).cast("int")
        return F.when(F.size(all_) > 0, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(all_, b * _BLOCK + 1, F.lit(_BLOCK))))

    start = F.struct(state.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    gone = F.aggregate(let(items, blocks), start, block, lambda done: F.flatten(done["out"]))
    return F.coalesce(gone, F.array().cast(f"array<{kind}>"))
