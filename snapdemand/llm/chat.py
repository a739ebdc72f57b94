"""Chat formatting by prefix-target expansion: every assistant turn is an example of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET = "assistant"
HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"


def escaped(text: Column) -> Column:
    """``text`` without any control string: a backslash is doubled, and one follows each ``<`` and ``#``."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in ("<", "#"):
        out = F.replace(out, F.lit(mark), F.lit(mark + "\\"))
    return out


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), F.url_encode(role), F.lit(MIDDLE), escaped(text), F.lit(TAIL))


def examples(turns: DataFrame, target: str = TARGET) -> DataFrame:
    """``(conv_id, position, formatted, loss_start, loss_length)``, an example per row, from ``turns(conv_id, turn, role, text)``.

    Each turn of the ``target`` role gives one example: all turns before it as context, then the turn itself. Only the
    characters of that turn's text are trainable: ``loss_length`` code points from ``loss_start``. If turns follow the last
    target, or there is none, one more example holds the whole conversation and nothing to train on.
    ``position`` counts the turns in the example. A turn is ``### role: text</turn>`` and a line end, with control strings
    escaped reversibly; roles are URL-encoded.

    Turns are ordered by turn (null first), then role, then text; repeated rows are turns of their own. Null roles and
    texts are empty. Rows with a null conv_id are one conversation. Empty in, empty out.
    """
    rows = turns.select(
        "conv_id", F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    formatted = grouped.select(
        "conv_id", F.transform("turns", lambda t: F.struct(
            (t["role"] == target).alias("target"), _turn(t["role"], t["text"]).alias("formatted"),
            F.length(escaped(t["text"])).alias("length"))).alias("turns"))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")),
                    lambda i: F.get("turns", i - 1)["target"] | (i == F.size("turns")))
    one = formatted.select("conv_id", "turns", F.explode(ends).alias("position"))
    last = F.get("turns", F.col("position") - 1)
    parts = F.slice(F.transform("turns", lambda t: t["formatted"]), F.lit(1), F.col("position"))
    return one.select("conv_id", "position", F.array_join(parts, "").alias("formatted"), last["target"].alias("trained"),
                      last["length"].alias("length")).select(
        "conv_id", "position", "formatted",
        F.when(F.col("trained"), F.length("formatted") - len(TAIL) - F.col("length")).otherwise(0).alias("loss_start"),
        F.when(F.col("trained"), F.col("length")).otherwise(0).alias("loss_length"))


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn of a formatted example."""
    parts = F.split(formatted, TAIL)
    body = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substr(p, F.lit(len(HEAD) + 1)))
    return F.transform(body, lambda p: F.struct(
        F.url_decode(F.substring_index(p, MIDDLE, 1)).alias("role"),
        unescaped(F.substr(p, F.instr(p, MIDDLE) + len(MIDDLE))).alias("text")))


def digests(found: DataFrame) -> DataFrame:
    """Per conversation what its ``examples`` hold, read back from the formatted strings."""
    mask = F.substr("formatted", F.col("loss_start") + 1, F.col("loss_length"))
    whole = found.select("conv_id", "position", "formatted", F.length("formatted").cast("long").alias("chars"),
                         F.when(F.col("loss_length") > 0, F.struct("position", unescaped(mask).alias("text"))).alias("loss"))
    grouped = whole.groupBy("conv_id").agg(
        F.max_by("formatted", "position").alias("longest"), F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "").alias("loss"))
    turns = grouped.withColumn("turns", read_turns(F.col("longest")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
