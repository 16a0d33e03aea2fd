"""Scans of the input tables, CSV in and out, and stand-in inputs over the given tables."""
