"""Operators on DataFrames: staging, enrichment, totals, ranking, null-safe joins, check rows."""
