"""Column expressions (JVM-side built-ins only; no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import AIR_QUALITY_CATEGORIES, AIR_QUALITY_LEVELS, LOG_MESSAGES


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P1: bytes -> text ------------------------------------------------------
def decode_utf8(value: str | Column = "value") -> Column:
    """Binary message value to text; invalid UTF-8 becomes null instead of failing."""
    v = col_(value)
    return F.when(F.is_valid_utf8(v.cast("string")), v.cast("string"))


# --- X2: truncation keeping the NTZ type of the input -------------------------
def trunc_ntz(unit: str, c: str | Column) -> Column:
    return F.date_trunc(unit, col_(c)).cast("timestamp_ntz")


# --- X3 / X4: air-quality CASE expressions ----------------------------------
def air_quality_category(c: str | Column = "hasAirQuality") -> Column:
    v = col_(c)
    out = F.lit("Other")
    for name in reversed(AIR_QUALITY_CATEGORIES):
        out = F.when(v == name, F.lit(name)).otherwise(out)
    return out


def air_quality_level(c: str | Column = "hasAirQuality") -> Column:
    v = col_(c)
    out = F.lit(0)
    for name, level in reversed(list(AIR_QUALITY_LEVELS.items())):
        out = F.when(v == name, F.lit(level)).otherwise(out)
    return out


# --- X15: log type -> message ------------------------------------------------
def log_message_for(c: str | Column = "log_type") -> Column:
    v = col_(c)
    out = F.lit(None).cast("string")
    for t, msg in reversed(list(LOG_MESSAGES.items())):
        out = F.when(v == t, F.lit(msg)).otherwise(out)
    return out


# --- X8: ranges


def clamp(c: str | Column, lo: Column | float | None, hi: Column | float | None) -> Column:
    """Clamp into [lo, hi]; a null bound leaves that side open."""
    v = col_(c)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo).cast("double")
    hi_c = hi if isinstance(hi, Column) else F.lit(hi).cast("double")
    v = F.when(hi_c.isNotNull() & (v > hi_c), hi_c).otherwise(v)
    return F.when(lo_c.isNotNull() & (v < lo_c), lo_c).otherwise(v)


# --- X13: the two timestamp renderings ----------------------------------------
def format_plain(c: str | Column) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss")


def format_iso_z(c: str | Column) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
