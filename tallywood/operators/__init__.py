"""Reusable joins, aggregates and rankings."""
