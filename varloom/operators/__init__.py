"""Joins, aggregates, set operations, statistics, effect parsing, quality checks and classifiers."""
