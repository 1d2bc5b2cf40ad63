"""Planetary catalogue and telemetry analytics as Spark DataFrame programs."""
