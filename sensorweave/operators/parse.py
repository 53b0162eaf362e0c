"""Message encode / decode / parse / flatten / cast.

Every step is a built-in expression inside one projection chain, so the
whole ingest path stays in one whole-stage-codegen stage with no Python
worker.  Casts are ``try_cast`` (null on bad input, as the reference's
Spark 2.4 casts behaved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.telemetry import decode_utf8, format_iso_z

MICROS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# --- K8 / X12: rows -> JSON messages ---------------------------------------------
def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols))


def encode_v2(tel: DataFrame, key_cols=("event_id",)) -> DataFrame:
    """Flattened telemetry -> v2 message: outer members text, nested members JSON text."""
    xyz = lambda p: [F.col(f"{p}_{a}").alias(a) for a in "xyz"]
    msg = F.struct(
        F.date_format("ts", MICROS_FMT).alias("timestamp"),
        F.col("sensor_name"), F.col("joint_name"),
        _json(*xyz("position")).alias("position"),
        _json(F.struct(*xyz("force")).alias("force"), F.struct(*xyz("torque")).alias("torque")
              ).alias("force_torque"),
        F.col("joint_angle").cast("string").alias("joint_angle"),
        F.col("velocity").cast("string").alias("velocity"),
        F.col("current").cast("string").alias("current"),
        _json(F.col("environment_air_quality").alias("air_quality"),
              F.col("environment_humidity").alias("humidity"),
              F.col("environment_temperature").alias("temperature")).alias("environment"),
        _json(format_iso_z("ts").alias("timestamp"), F.col("log_type").alias("type"),
              F.col("log_message").alias("message")).alias("log"),
    )
    return tel.select(*key_cols, F.to_json(msg).cast("binary").alias("value"))


# --- P1 - P7: decode and parse -------------------------------------------------------
def decode(df: DataFrame, value: str = "value", keep=("event_id",)) -> DataFrame:
    keep = [c for c in keep if c in df.columns]
    return df.select(*keep, decode_utf8(value).alias("json"))


def parse_v2(df: DataFrame, json_col: str = "json", keep=("event_id",)) -> DataFrame:
    """Outer parse + star expansion, then the four nested members parsed in place."""
    keep = [c for c in keep if c in df.columns]
    outer = df.select(*keep, F.from_json(json_col, S.MESSAGE_V2).alias("m")).select(*keep, "m.*")
    return outer.select(
        *keep, "timestamp", "sensor_name", "joint_name",
        F.from_json("position", S.XYZ).alias("position"),
        F.from_json("force_torque", S.FORCE_TORQUE).alias("force_torque"),
        "joint_angle", "velocity", "current",
        F.from_json("environment", S.ENVIRONMENT).alias("environment"),
        F.from_json("log", S.LOG).alias("log"),
    )


# --- P9: flatten -------------------------------------------------------------------------
# fixed values: nested member, flattened column
FLATTEN = [
    ("position.x", "position_x"), ("position.y", "position_y"), ("position.z", "position_z"),
    ("force_torque.force.x", "force_x"), ("force_torque.force.y", "force_y"),
    ("force_torque.force.z", "force_z"), ("force_torque.torque.x", "torque_x"),
    ("force_torque.torque.y", "torque_y"), ("force_torque.torque.z", "torque_z"),
    ("environment.air_quality", "environment_air_quality"),
    ("environment.humidity", "environment_humidity"),
    ("environment.temperature", "environment_temperature"),
    ("log.timestamp", "log_timestamp"), ("log.type", "log_type"), ("log.message", "log_message"),
]


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs -> prefixed columns, parents dropped, in one projection."""
    parents = {"position", "force_torque", "environment", "log"}
    rest = [c for c in df.columns if c not in parents]
    return df.select(*rest, *[F.col(src).alias(dst) for src, dst in FLATTEN])


# --- P11: cast to the staging types --------------------------------------------------------
def cast_staging(df: DataFrame) -> DataFrame:
    casts = {
        "timestamp": F.col("timestamp").try_cast("timestamp"),
        "joint_angle": F.col("joint_angle").try_cast("double"),
        "velocity": F.col("velocity").try_cast("double"),
        "current": F.col("current").try_cast("double"),
        "log_timestamp": F.col("log_timestamp").try_cast("timestamp"),
    }
    return df.select(*[casts.get(c, F.col(c)).alias(c) for c in df.columns])


def ingest_v2(df: DataFrame, keep=("event_id",)) -> DataFrame:
    """binary value -> typed staging rows (decode, parse, flatten, cast)."""
    keep = [c for c in keep if c in df.columns]
    out = cast_staging(flatten(parse_v2(decode(df, keep=keep), keep=keep)))
    return out.select(*keep, *S.STAGING_COLUMNS)


# --- v1 robot messages (P8, P10) ----------------------------------------------------------
def _single_quoted(c: Column) -> Column:
    return F.regexp_replace(c, '"', "'")


def encode_v1(tel: DataFrame, key_cols=("event_id",)) -> DataFrame:
    """Telemetry -> v1 robot message; nested members as single-quoted text."""
    xyz = lambda p: [F.col(f"{p}_{a}").alias(a) for a in "xyz"]
    angles = F.struct(
        F.col("joint_angle").alias("joint_1"), F.col("torque_x").alias("joint_2"),
        F.col("position_x").alias("joint_3"), F.col("position_y").alias("joint_4"),
        F.col("force_y").alias("joint_5"), F.col("velocity").alias("joint_6"))
    msg = F.struct(
        _single_quoted(_json(F.struct(*xyz("force")).alias("force"),
                             F.struct(*xyz("torque")).alias("torque"))).alias("force_torque"),
        F.date_format("ts", MICROS_FMT).alias("timestamp"),
        _single_quoted(_json(*xyz("position"))).alias("position"),
        F.col("current").cast("string").alias("load"),
        F.col("velocity").cast("string").alias("velocity"),
        F.col("environment_temperature").cast("string").alias("temperature"),
        F.col("k").cast("string").alias("pressure"),
        F.when(F.col("log_type") == "error", F.lit("open")).otherwise(F.lit("closed")).alias("gripper_status"),
        F.col("environment_humidity").alias("proximity"),
        _single_quoted(F.to_json(angles)).alias("joint_angles"),
    )
    return tel.select(*key_cols, F.to_json(msg).cast("binary").alias("value"))


def parse_v1(df: DataFrame, keep=("event_id",)) -> DataFrame:
    """Parse v1; nested members stay structs, renamed back to their own names."""
    keep = [c for c in keep if c in df.columns]
    outer = (decode(df, keep=keep)
             .select(*keep, F.from_json("json", S.MESSAGE_V1).alias("m")).select(*keep, "m.*"))
    parsed = outer.select(
        "*", F.from_json("force_torque", S.FORCE_TORQUE).alias("force_torque_parsed"),
        F.from_json("position", S.XYZ).alias("position_parsed"),
        F.from_json("joint_angles", S.JOINT_ANGLES).alias("joint_angles_parsed"))
    return (parsed.drop("force_torque", "position", "joint_angles")
            .withColumnsRenamed({"force_torque_parsed": "force_torque", "position_parsed": "position",
                                 "joint_angles_parsed": "joint_angles"}))


# --- flat sensor messages (P2, P12) ----------------------------------------------------------
def encode_flat(tel: DataFrame, key_cols=("event_id",)) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    msg = F.struct(
        _json(F.col("log_type").alias("log_type"),
              F.col("environment_air_quality").alias("air_quality")).alias("more_details"),
        s("position_x").alias("position_x"), s("position_y").alias("position_y"),
        s("force_y").alias("acceleration_y"), s("force_x").alias("acceleration_x"),
        s("environment_temperature").alias("temperature"), F.col("sensor_name").alias("sensor"),
        s("k").alias("pressure"), s("velocity").alias("velocity_x"), s("current").alias("velocity_y"),
        F.date_format("ts", MICROS_FMT).alias("timestamp"))
    return tel.select(*key_cols, F.to_json(msg).cast("binary").alias("value"))


def parse_flat(df: DataFrame, keep=("event_id",)) -> DataFrame:
    keep = [c for c in keep if c in df.columns]
    p = decode(df, keep=keep).select(*keep, F.from_json("json", S.FLAT_SENSOR_WIRE).alias("p"))
    return p.select(
        *keep, F.col("p.more_details").alias("more_details"),
        *[F.col(f"p.{c}").try_cast("double").alias(c) for c in S.FLAT_SENSOR_DOUBLES],
        F.col("p.sensor").alias("sensor"),
        F.col("p.timestamp").try_cast("timestamp").alias("timestamp"))
