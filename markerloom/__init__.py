"""Linkage-map, genome-anchoring and corpus operators as plain Spark DataFrame functions."""
