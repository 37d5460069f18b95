"""fleetlens: fleet telemetry jobs for PySpark (metrics, logs, processes)."""

__version__ = "0.1.0"
