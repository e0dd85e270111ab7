"""Incremental builds: micro-batch silver over a landing folder, SCD2 merge."""
