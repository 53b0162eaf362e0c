"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def signed_zero_safe(sql: str) -> str:
    """Wrap every ``round(...)`` of an oracle query as ``(round(...) + 0e0)``.

    DuckDB's round can return -0.0 where Spark's (decimal-based) round returns
    0.0; adding +0.0 maps -0.0 to 0.0 and leaves every other value unchanged."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = signed_zero_safe(sql[j + 6:k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0e0)")
        i = k + 1


def register(key: str, sql: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``.

    ``sql`` is the equivalent DuckDB query over the same Parquet tables; leave it
    out only for results that SQL cannot state (timings, random values).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = signed_zero_safe(sql)
        if headline:
            HEADLINE.append(key)
        return fn
    return deco
