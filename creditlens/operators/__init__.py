"""Operators over whole tables (joins, grouping, windows, statistics, models)."""
