"""Versioned tables behind one log: a set of tables is replaced as a whole, or not at all.

Below ``root``, table ``t`` of version ``v`` lies in ``t/version=v``, where it may be cut into parts such as ``date=2026-10-08``.
Nothing is ever overwritten. Which version of a part counts stands in ``log``: publishing adds one small file there, as
the last step, and readers take the newest version that the log names. So a write that dies half way, or a version that
its checks refuse, leaves what was published readable, and all tables of a version appear in the same moment.
Versions that the log no longer names as newest are not deleted here; give them a retention time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "part string, version string, tables array<string>, published_at string"
#: the part of tables that are not cut into parts
WHOLE = ""


@dataclass(frozen=True)
class Version:
    """Tables that are written and not published yet."""

    root: str
    name: str

    def path(self, table: str, part: str = WHOLE) -> str:
        return f"{self.root}/{table}/version={self.name}" + (f"/{part}" if part else "")

    def write(self, df: DataFrame, table: str, part: str = WHOLE, by: Sequence[str] = (), kind: str = "parquet") -> DataFrame:
        """Writes one table, or one part of it, or with ``by`` all parts at once; returns it as read back."""
        path = self.path(table, part)
        writer = df.write.format(kind)
        writer = writer.option("compression", "zstd") if kind == "parquet" else writer
        (writer.partitionBy(*by) if by else writer).save(path)
        return df.sparkSession.read.format(kind).schema(df.schema).load(path)

    def catalogued(self, table: str) -> str:
        """The catalogue's name of a table that is written in buckets."""
        return f"{table}_{self.name}".replace("-", "_")

    def write_buckets(self, df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
        """Writes a table as one sorted file per bucket of ``key``, known to the catalogue, so that tables of as many buckets
        join on ``key`` without an exchange; returns it as read back. For keys of few rows each: all rows of one key,
        null included, go to one task.
        """
        name, spark = self.catalogued(table), df.sparkSession
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        path = self.path(table).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{name}` ({fields}) USING parquet OPTIONS (compression 'zstd') "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
        df.repartition(int(buckets), key).write.insertInto(name)
        return spark.table(name)


class Store:
    """Tables below one folder, read as last published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self) -> DataFrame:
        """``(part, version, tables, published_at)``: everything that was ever published, one row for each part of a version."""
        try:
            return self.spark.read.schema(_LOG).json(f"{self.root}/log")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def current(self) -> dict[str, tuple[str, list[str]]]:
        """Newest published version of each part, and the tables it has there; the calendar bounds the number of parts."""
        newest = self.log().groupBy("part").agg(F.max(F.struct("version", "tables")).alias("n"))
        return {r["part"]: (r["n"]["version"], r["n"]["tables"]) for r in newest.collect()}

    def stage(self) -> Version:
        """A new version. Its number is one more than the newest, so it wins over all that were published before."""
        newest = max((v for v, _ in self.current().values()), default="0")
        return Version(self.root, f"{int(newest.split('-')[0]) + 1:010d}-{uuid.uuid4().hex[:8]}")

    def publish(self, version: Version, parts: Mapping[str, Sequence[str]]) -> None:
        """Makes the version the newest of ``parts``, each given with the tables it has there: one file appears in the log.

        A table that the version lacks in a part is gone from that part, too.
        """
        now = datetime.now(timezone.utc).isoformat()
        rows = F.array(*[F.struct(F.lit(p), F.lit(version.name), F.array(*[F.lit(t) for t in sorted(tables)]), F.lit(now))
                         for p, tables in parts.items()])
        names = T.StructType.fromDDL(_LOG).names
        self.spark.range(1).select(F.inline(rows).alias(*names)).coalesce(1).write.mode("append").json(f"{self.root}/log")

    def read(self, table: str, schema: str | T.StructType | None = None, kind: str = "parquet") -> DataFrame:
        """The published parts of a table, with the columns that name the parts.

        With a schema no file is opened to infer one, and a table of which nothing is published is empty; without, that
        raises. A table in buckets is read as the catalogue describes it; where the catalogue does not know it, as in a
        session of its own without a metastore, the rows are the same and joins exchange them.
        """
        published = [(Version(self.root, v), p) for p, (v, tables) in sorted(self.current().items()) if table in tables]
        if len(published) == 1 and published[0][1] == WHOLE and self.spark.catalog.tableExists(published[0][0].catalogued(table)):
            return self.spark.table(published[0][0].catalogued(table))
        paths = [version.path(table, part) for version, part in published]
        if not paths:
            if schema is None:
                raise ValueError(f"nothing is published below {self.root}")
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.format(kind).option("basePath", f"{self.root}/{table}")
        return (read if schema is None else read.schema(schema)).load(paths).drop("version")
