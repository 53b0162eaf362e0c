"""Fixed values that must equal the reference behaviour for identical results.

Everything in this module is a plain constant: message texts, value domains,
range constraints stated by the sensor ontology, and the static topology that
the graph seed creates.  Nothing here is derived or computed.
"""

# --- fixed values: log messages per log type -------------------------------
LOG_MESSAGES = {
    "warn": "Warning log message",
    "info": "Info log message",
    "error": "Error log message",
}

# --- fixed values: value domains -------------------------------------------
AIR_QUALITY_LEVELS = {"Good": 1, "Moderate": 2, "Unhealthy": 3}  # anything else -> 0
AIR_QUALITY_CATEGORIES = ["Good", "Moderate", "Unhealthy"]  # anything else -> 'Other'

# --- fixed values: ontology range restrictions ------------------------------
# (class, property, minInclusive text, maxInclusive text) as written in the
# knowledge base; the joint-angle minimum uses U+2212 MINUS SIGN in the source.
KB_NAMESPACE = "http://example.org/robotics#"
KB_RESTRICTIONS = [
    ("Joint", "hasJointAngle", "−360", "360"),
    ("TemperatureSensor", "hasTemperature", "0", "50"),
    ("HumiditySensor", "hasHumidity", "0", "90"),
    ("Sensor", "hasForce", "0", "30"),
    ("Sensor", "hasTorque", "0", "10"),
    ("Sensor", "hasCurrent", "2.5", "25"),
]

# Effective clamp limits used when no constraint row is found (the extraction
# query of the reference finds none on its KB).  Force and torque are clamped
# symmetrically to +/- max.
DEFAULT_LIMITS = {
    "hasJointAngle": (-360.0, 360.0),
    "hasTemperature": (0.0, 50.0),
    "hasHumidity": (0.0, 90.0),
    "hasForce": (-30.0, 30.0),
    "hasTorque": (-10.0, 10.0),
    "hasCurrent": (2.5, 25.0),
}

# Which telemetry column is governed by which ontology property.
PROPERTY_COLUMNS = {
    "hasJointAngle": ["joint_angle"],
    "hasTemperature": ["environment_temperature"],
    "hasHumidity": ["environment_humidity"],
    "hasForce": ["force_x", "force_y", "force_z"],
    "hasTorque": ["torque_x", "torque_y", "torque_z"],
    "hasCurrent": ["current"],
}

# --- fixed values: ontology class hierarchy (subClassOf pairs) --------------
KB_SUBCLASS = [
    ("AirQualitySensor", "EnvironmentSensor"),
    ("EnvironmentSensor", "Environment"),
    ("ErrorLog", "Log"),
    ("HumiditySensor", "EnvironmentSensor"),
    ("InfoLog", "Log"),
    ("Joint", "RobotArm"),
    ("Location", "Environment"),
    ("Log", "RobotArm"),
    ("PowerSupply", "Location"),
    ("Sensor", "Joint"),
    ("TemperatureSensor", "EnvironmentSensor"),
    ("WarnLog", "Log"),
]

# --- fixed values: RDF vocabulary -------------------------------------------
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"

# --- fixed values: static topology seed -------------------------------------
SEED_TIMESTAMP = "2024-07-01 12:00:00"
SEED_JOINT_TYPES = [
    ("joint_1", "Base Joint"),
    ("joint_2", "Shoulder Joint"),
    ("joint_3", "Elbow Joint"),
    ("joint_4", "Wrist 1 Joint"),
    ("joint_5", "Wrist 2 Joint"),
    ("joint_6", "Wrist 3 Joint"),
]
# Root nodes: (label, name, extra property map)
SEED_ROOTS = [
    ("Thing", "Thing", {}),
    ("RobotArm", "RobotArm", {"hasRobotName": "RoboArm1"}),
    ("Environment", "Environment", {}),
    ("Location", "Location", {"inBuilding": "BuildingA", "inWorkstation": "Workstation5"}),
    ("PowerSupply", "PowerSupply", {"hasVoltage": "220.0"}),
    ("Log", "Log", {}),
]
# Seed log nodes: (label, name, message); all at SEED_TIMESTAMP.
SEED_LOGS = [
    ("WarnLog", "WarnLog", "Warning log message"),
    ("InfoLog", "InfoLog", "Info log message"),
    ("ErrorLog", "ErrorLog", "Error log message"),
]
# Seed edges between named nodes: (type, src label, src name, dst label, dst name)
SEED_EDGES = [
    ("HAS_A", "Thing", "Thing", "RobotArm", "RobotArm"),
    ("HAS_JOINT", "RobotArm", "RobotArm", "Joint", "joint_1"),
    ("HAS_JOINT", "RobotArm", "RobotArm", "Joint", "joint_2"),
    ("HAS_JOINT", "RobotArm", "RobotArm", "Joint", "joint_3"),
    ("HAS_JOINT", "RobotArm", "RobotArm", "Joint", "joint_4"),
    ("HAS_JOINT", "RobotArm", "RobotArm", "Joint", "joint_5"),
    ("HAS_JOINT", "RobotArm", "RobotArm", "Joint", "joint_6"),
    ("HAS_LOGS", "RobotArm", "RobotArm", "Log", "Log"),
    ("HAS_RECORD", "Log", "Log", "WarnLog", "WarnLog"),
    ("HAS_RECORD", "Log", "Log", "InfoLog", "InfoLog"),
    ("HAS_RECORD", "Log", "Log", "ErrorLog", "ErrorLog"),
    ("HAS_A", "Thing", "Thing", "Environment", "Environment"),
    ("HAS_LOCATION", "Environment", "Environment", "Location", "Location"),
    ("POWERED_BY", "Location", "Location", "PowerSupply", "PowerSupply"),
]
# Joints of the full seed: (name, joint type); they stand beside the joints above.
SEED_FULL_JOINTS = [
    ("Joint1", "Base Joint"),
    ("Joint2", "Shoulder Joint"),
    ("Joint3", "Elbow Joint"),
    ("Joint4", "Wrist 1 Joint"),
    ("Joint5", "Wrist 2 Joint"),
    ("Joint6", "Wrist 3 Joint"),
]
# Example sensor values of the full seed: (name, joint, acceleration, current,
# force, position x, y, z, torque, velocity)
SEED_SENSORS = [
    ("Sensor1", "Joint1", 1.5, 2.0, 3.0, 0.5, 1.0, 1.5, 4.0, 2.5),
    ("Sensor2", "Joint2", 1.2, 1.8, 2.5, 0.4, 0.9, 1.4, 3.5, 2.0),
    ("Sensor3", "Joint3", 1.3, 1.9, 2.8, 0.45, 0.95, 1.45, 3.8, 2.3),
    ("Sensor4", "Joint4", 1.4, 2.1, 3.1, 0.48, 0.98, 1.48, 4.1, 2.4),
    ("Sensor5", "Joint5", 1.6, 2.3, 3.4, 0.52, 1.02, 1.52, 4.4, 2.6),
    ("Sensor6", "Joint6", 1.7, 2.5, 3.6, 0.54, 1.04, 1.54, 4.6, 2.7),
]
# Environment sub-sensors of the full seed: (label, name, property, value, edge type)
SEED_ENV_SUBSENSORS = [
    ("AirQualitySensor", "AirQualitySensor", "hasAirQuality", "Good", "HAS_AIRQUALITY"),
    ("HumiditySensor", "HumiditySensor", "hasHumidity", "45.0", "HAS_HUMIDITY"),
    ("TemperatureSensor", "TemperatureSensor", "hasTemperature", "22.0", "HAS_TEMPERATURE"),
]

# Edge types of the dashboard's variable-length path report.
PATH_EDGE_TYPES = ["HAS_A", "HAS_JOINT", "POWERED_BY", "HAS_LOGS", "HAS_LOCATION"]

# Nodes created for each event by the bulk create: (label, name, {property: telemetry expression or text})
UNWIND_NODES = [
    ("Thing", "Thing", {}),
    ("RobotArm", "RobotArm", {"hasRobotName": "'RobotArm1'"}),
    ("Joint", "Joint", {"hasJointType": "joint_name"}),
    ("Sensor", "Sensor", {"hasAcceleration": "joint_angle", "hasCurrent": "current", "hasForce": "force_x",
                          "hasPositionX": "position_x", "hasPositionY": "position_y", "hasPositionZ": "position_z",
                          "hasTorque": "torque_y", "hasVelocity": "velocity"}),
    ("Location", "Location", {"inBuilding": "'BuildingA'", "inWorkstation": "'Workstation5'"}),
    ("PowerSupply", "PowerSupply", {"hasVoltage": "220.0"}),
    ("Environment", "Environment", {}),
    ("EnvironmentSensor", "EnvironmentSensor", {}),
    ("AirQualitySensor", "AirQualitySensor", {"hasAirQuality": "environment_air_quality"}),
    ("HumiditySensor", "HumiditySensor", {"hasHumidity": "environment_humidity"}),
    ("TemperatureSensor", "TemperatureSensor", {"hasTemperature": "environment_temperature"}),
    ("Log", "Log", {}),
    ("WarnLog", "WarnLog", {"hasTimestamp": "CASE WHEN log_type = 'warn' THEN ts END",
                            "hasMessage": "CASE WHEN log_type = 'warn' THEN log_message END"}),
    ("InfoLog", "InfoLog", {"hasTimestamp": "CASE WHEN log_type = 'info' THEN ts END",
                            "hasMessage": "CASE WHEN log_type = 'info' THEN log_message END"}),
    ("ErrorLog", "ErrorLog", {"hasTimestamp": "CASE WHEN log_type = 'error' THEN ts END",
                              "hasMessage": "CASE WHEN log_type = 'error' THEN log_message END"}),
]
# The relationships created between one event's nodes (type, from, to)
UNWIND_EDGES = [
    ("HAS_JOINT", "RobotArm", "Joint"),
    ("HAS_SENSOR", "Joint", "Sensor"),
    ("HAS_A", "Thing", "RobotArm"),
    ("HAS_A", "Thing", "Environment"),
    ("HAS_READING", "Environment", "EnvironmentSensor"),
    ("HAS_AIRQUALITY", "EnvironmentSensor", "AirQualitySensor"),
    ("HAS_HUMIDITY", "EnvironmentSensor", "HumiditySensor"),
    ("HAS_TEMPERATURE", "EnvironmentSensor", "TemperatureSensor"),
    ("HAS_LOGS", "RobotArm", "Log"),
    ("HAS_RECORD", "Log", "WarnLog"),
    ("HAS_RECORD", "Log", "InfoLog"),
    ("HAS_RECORD", "Log", "ErrorLog"),
    ("HAS_LOCATION", "Environment", "Location"),
    ("POWERED_BY", "Location", "PowerSupply"),
]
