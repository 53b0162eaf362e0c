"""Tumbling-window aggregates (batch and streaming share these builders)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _window_cols():
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def window_log_counts(df: DataFrame, ts: str = "timestamp", width: str = "5 minutes") -> DataFrame:
    """A1: per window and log type, ``count(log_type)`` (a null log type counts 0)."""
    agg = df.groupBy(F.window(ts, width), "log_type").agg(F.count("log_type").alias("log_count"))
    return agg.select(*_window_cols(), "log_type", "log_count")


def window_avg_humidity(df: DataFrame, ts: str = "timestamp", width: str = "5 minutes") -> DataFrame:
    """A2: per window, average humidity after a null-on-bad-input cast."""
    h = F.col("environment_humidity").try_cast("double")
    agg = df.groupBy(F.window(ts, width)).agg(F.avg(h).alias("avg_humidity"))
    return agg.select(*_window_cols(), "avg_humidity")


def window_temperature_stats(df: DataFrame, ts: str = "timestamp", width: str = "5 minutes") -> DataFrame:
    """Per window min / max / avg temperature."""
    t = F.col("environment_temperature")
    agg = df.groupBy(F.window(ts, width)).agg(
        F.min(t).alias("min_temperature"), F.max(t).alias("max_temperature"),
        F.avg(t).alias("avg_temperature"))
    return agg.select(*_window_cols(), "min_temperature", "max_temperature", "avg_temperature")
