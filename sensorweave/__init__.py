"""sensorweave: telemetry ingest, property-graph tables and reports on Spark."""

__version__ = "0.1.0"
