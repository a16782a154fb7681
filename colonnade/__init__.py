"""Colonnade: distributed column profiling, attribute classification and dataset cataloguing on Spark."""
