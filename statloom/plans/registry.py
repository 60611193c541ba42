"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Added before rounding on both sides: sums are multiples of 0.0001, so that halves of the last digit would otherwise be
#: rounded by the order of summation.
NUDGE = 0.00000137


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql.replace(", 4)", f" + {NUDGE:.8f}, 4)")
        return f

    return add
