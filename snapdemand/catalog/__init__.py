"""Every operator as a query over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from snapdemand.catalog import (  # noqa: F401
    aggregates, checks, filters, joins, payloads, products, ranking, scalars, scans, sets, sinks,
)
from snapdemand.catalog.base import QUERIES, SQL  # noqa: F401
