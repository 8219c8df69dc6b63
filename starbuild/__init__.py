"""Incremental star schemas from nested JSON records, as DataFrame transforms."""
