"""Declared schemas for every message shape and the shared staging table."""

from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# --- fixed values: the members of the messages and of the staging rows, as they stand on the wire ---
# v2 telemetry message: ten members, all text; nested members hold JSON text.
MESSAGE_V2 = _struct(
    timestamp=_S, sensor_name=_S, joint_name=_S, position=_S, force_torque=_S,
    joint_angle=_S, velocity=_S, current=_S, environment=_S, log=_S,
)

XYZ = _struct(x=_D, y=_D, z=_D)
FORCE_TORQUE = _struct(force=XYZ, torque=XYZ)
ENVIRONMENT = _struct(air_quality=_S, humidity=_S, temperature=_D)
LOG = _struct(timestamp=_S, type=_S, message=_S)

# v1 robot message: nested members arrive as (possibly single-quoted) JSON text.
MESSAGE_V1 = T.StructType([
    T.StructField("force_torque", _S), T.StructField("timestamp", T.TimestampType()),
    T.StructField("position", _S), T.StructField("load", _S),
    T.StructField("velocity", _S), T.StructField("temperature", _S),
    T.StructField("pressure", _S), T.StructField("gripper_status", _S),
    T.StructField("proximity", _S), T.StructField("joint_angles", _S),
])
JOINT_ANGLES = _struct(**{f"joint_{i}": _D for i in range(1, 7)})

# Flat sensor message: every member text on the wire.
FLAT_SENSOR_WIRE = _struct(
    more_details=_S, position_x=_S, position_y=_S, acceleration_y=_S,
    acceleration_x=_S, temperature=_S, sensor=_S, pressure=_S,
    velocity_x=_S, velocity_y=_S, timestamp=_S,
)
FLAT_SENSOR_DOUBLES = [
    "position_x", "position_y", "acceleration_y", "acceleration_x",
    "temperature", "pressure", "velocity_x", "velocity_y",
]

# Staging table written by the ingest job and read back by the aggregator.
# log_timestamp is a timestamp here (the reference wrote text but declared a
# timestamp on read); one shared definition avoids that mismatch.
STAGING = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("sensor_name", _S), T.StructField("joint_name", _S),
    T.StructField("joint_angle", _D), T.StructField("velocity", _D),
    T.StructField("current", _D),
    T.StructField("position_x", _D), T.StructField("position_y", _D),
    T.StructField("position_z", _D),
    T.StructField("force_x", _D), T.StructField("force_y", _D), T.StructField("force_z", _D),
    T.StructField("torque_x", _D), T.StructField("torque_y", _D), T.StructField("torque_z", _D),
    T.StructField("environment_air_quality", _S),
    T.StructField("environment_humidity", _S),
    T.StructField("environment_temperature", _D),
    T.StructField("log_timestamp", T.TimestampType()),
    T.StructField("log_type", _S), T.StructField("log_message", _S),
])
STAGING_COLUMNS = [f.name for f in STAGING.fields]
