"""Threat-signal analytics as PySpark DataFrame operators."""
