"""Reusable operators: dedup, SCD2, joins, checks, contracts, fuzzy repair."""
