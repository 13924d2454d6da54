"""Station-telemetry analytics on Spark."""
