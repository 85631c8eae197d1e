"""Bronze / silver / gold table jobs for game telemetry, on PySpark."""
