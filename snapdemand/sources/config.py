"""Config entries: objects with the meta keys and one more key, which names the source system."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdemand import model


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """(position, entry) per config entry of a YAML or JSON list; entry is JSON text. Position is the file's order."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("reading YAML needs the yaml package; give the config as JSON instead") from exc
        entries = yaml.safe_load(text)
    else:
        entries = json.loads(text)
    return spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(entries)], "position int, entry string")


def _fields(entry: Column) -> Column:
    return F.from_json(entry, "map<string,string>")


def _systems(fields: Column, meta: Sequence[str]) -> Column:
    return F.array_except(F.map_keys(fields), F.array(*[F.lit(m) for m in meta]))


def config_to_dimension(
    config: DataFrame, meta: Sequence[str] = model.CONFIG_META_KEYS, entry: str = "entry"
) -> DataFrame:
    """One dimension row per entry; ``source_system`` is null unless exactly one key is no meta key."""
    parsed = config.select(_fields(F.col(entry)).alias("f")).select(
        "f", _systems(F.col("f"), meta).alias("s"))
    return parsed.select(
        F.try_element_at("f", F.lit("key")).alias("company_key"),
        F.try_element_at("f", F.lit("name")).alias("name"),
        F.try_element_at("f", F.lit("industry")).alias("industry"),
        F.when(F.size("s") == 1, F.get("s", F.lit(0))).alias("source_system"),
    )


def site_configs(
    config: DataFrame, meta: Sequence[str] = model.CONFIG_META_KEYS, entry: str = "entry"
) -> DataFrame:
    """One row per entry and site: the value of the system key is one object or a list of objects."""
    parsed = config.withColumn("_f", _fields(F.col(entry))).withColumn("_s", F.explode(_systems(F.col("_f"), meta)))
    value = F.try_element_at("_f", F.col("_s"))
    listed = F.from_json(value, "array<map<string,string>>")
    single = F.array(F.from_json(value, "map<string,string>"))
    sites = F.when(F.ltrim(value).startswith("["), listed).otherwise(single)
    carried = [c for c in config.columns if c != entry]
    return parsed.select(
        *carried,
        F.try_element_at("_f", F.lit("key")).alias("company_key"),
        F.col("_s").alias("source_system"),
        F.posexplode(sites).alias("site", "config"),
    )


def config_problems(config: DataFrame, systems: Sequence[str], meta: Sequence[str] = model.CONFIG_META_KEYS,
                    entry: str = "entry") -> DataFrame:
    """Entries without exactly one known system, and keys used twice: (check, severity, key, detail)."""
    from snapdemand.quality.checks import check_rows, check_unique

    parsed = config.select(_fields(F.col(entry)).alias("f")).select(
        F.try_element_at("f", F.lit("key")).alias("company_key"), _systems(F.col("f"), meta).alias("s"))
    known = F.size(F.array_intersect("s", F.array(*[F.lit(s) for s in systems])))
    wrong = check_rows(parsed, (F.size("s") != 1) | (known != 1), ["company_key"],
                       F.array_join(F.array_sort("s"), ","), "one_known_system")
    return wrong.unionByName(check_unique(parsed, ["company_key"], "unique_company"))
