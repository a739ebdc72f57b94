"""Files: snapshots by day, dictionaries, rules, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from snapdemand import model
from snapdemand.functions.regex import Entry, Rule


def read_snapshots(
    spark: SparkSession, root: str, schema: T.StructType = model.SNAPSHOT_SCHEMA, view: str | None = None
) -> DataFrame:
    """The hive-partitioned snapshots below ``root`` under a fixed schema, so no file is opened to infer one.

    The partition column ``date`` stays in the result: filter on it to skip whole days. Fails when nothing is there.
    """
    df = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(root)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_glob(spark: SparkSession, glob: str, schema: T.StructType = model.POSTING_SCHEMA) -> DataFrame:
    """Snapshot files by a glob; raises when no file matches."""
    return spark.read.schema(schema).parquet(glob)


def with_position(spark: SparkSession, path: str, into: str = "position") -> DataFrame:
    """Ordered files as written by ``sinks.write_ordered``, with each row's place in them, from 1.

    Files are ranges of the order, by name; a row's place in its file is known to the reader. Only rows per file are
    added up, so no task sees all rows.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = counts.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    return rows.join(before, "_file").withColumn(into, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def earlier_days(snapshots: DataFrame, day: Column, date: str = "date") -> DataFrame:
    """Days before ``day``; with ``date`` the partition column the others are never listed or read."""
    return snapshots.where(F.col(date) < day)


def read_dictionary(spark: SparkSession, path: str, schema: str = model.DICTIONARY_SCHEMA) -> DataFrame:
    """A CSV whose quotes are doubled and whose backslashes are plain characters."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return read_dictionary(spark, path, model.RULES_SCHEMA)


def load_entries(dictionary: DataFrame) -> list[Entry]:
    """The dictionary as expressions of a plan; for one that grows, see ``operators.dictionary``."""
    return [Entry(r.skill, r.category, r.pattern) for r in dictionary.collect()]


def load_rules(rules: DataFrame) -> list[Rule]:
    return [Rule(r.field, r.priority, r.pattern, r.value) for r in rules.collect()]


def constants(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of constants built from literals, so that no Python worker starts."""
    names = [f.name for f in T.StructType.fromDDL(schema)]
    types = [f.dataType for f in T.StructType.fromDDL(schema)]
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def read_run_summaries(spark: SparkSession, root: str, schema: str = model.RUN_SUMMARY_SCHEMA) -> DataFrame:
    """The run summaries of all days below ``root``, one row per run."""
    return (
        spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json").json(root)
    )
