"""Sensor and weather analytics as plain PySpark DataFrame code."""
