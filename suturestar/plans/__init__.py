"""Whole plans built from the operators: dimensions, loads, views, reports, lookups."""
