"""Operators re-expressed as DataFrame plans (windows, joins, aggregates)."""
