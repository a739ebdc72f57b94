"""Schemas, and the fixed values that decide results.

Everything here is a default: each operator takes the same thing as a parameter.
"""

from __future__ import annotations

from pyspark.sql import types as T

POSTING_FIELDS = (
    "source_system", "company_key", "posting_id", "title", "location",
    "posted_raw", "url", "description", "collected_at",
)
POSTING_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in POSTING_FIELDS])
SNAPSHOT_SCHEMA = T.StructType(POSTING_SCHEMA.fields + [T.StructField("date", T.DateType())])

DESCRIBED_SCHEMA = "source_system string, posting_id string, date date"

DICTIONARY_SCHEMA = "skill string, category string, pattern string"
RULES_SCHEMA = "field string, priority int, pattern string, value string"
DIMENSION_SCHEMA = "company_key string, name string, industry string, source_system string"

RUN_SUMMARY_SCHEMA = (
    "date string, started_at string, duration_s double, rows bigint, "
    "companies array<struct<key string, status string, rows bigint, error string, "
    "describe_errors bigint, truncated boolean, duration_s double>>"
)

# They must equal the results users have today.
KEEP_PATTERN = r"egypt|cairo|giza|alexandria"
MANY_PLACES_PATTERN = r"\A[0-9]+ locations\z"
COUNTRY_PATTERN = r"egypt"
COUNTRY_BUCKET = "Egypt (other)"
COUNTRY_NAME, COUNTRY_CODE = "Egypt", "EGY"
PLACES = {
    "cairo": "Cairo",
    "giza": "Giza",
    "alexandria": "Alexandria",
    "alex": "Alexandria",
    "nasr city": "Cairo",
    "maadi": "Cairo",
    "heliopolis": "Cairo",
    "6th of october": "Giza",
    "sheikh zayed": "Giza",
    "smart village": "Giza",
}
SCOPES = {
    "all": ("data_engineering", "data_analysis", "ai_ml", "software", "other"),
    "data": ("data_engineering", "data_analysis"),
    "ai_ml": ("ai_ml",),
    "tech": ("software", "data_engineering", "data_analysis", "ai_ml"),
}
RULE_DEFAULTS = {"role_family": "other", "seniority": "mid"}
SENIORITIES = ("intern", "junior", "mid", "senior")
CONFIG_META_KEYS = ("key", "name", "industry")
TOP_TAGS, TREND_TAGS, TOP_COMPANIES = 15, 10, 10
TREND_SCOPE = "tech"
STALE_AFTER_HOURS = 36
WARN_AFTER_DAYS, ERROR_AFTER_DAYS = 1, 2
