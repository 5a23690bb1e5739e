"""Joins, windows and aggregations of the rain-alert model."""
