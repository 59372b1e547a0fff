"""Wearable-health analytics on Spark: streaming alerts, medallion layers,
dataset preparation and dashboard analytics as DataFrame functions."""

__version__ = "0.1.0"
