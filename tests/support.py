"""Helpers of the tests; fixtures are in conftest.py."""

from datetime import datetime, timedelta

START = datetime(2025, 10, 6, 12, 0, 0)


def at(sec: float) -> datetime:
    return START + timedelta(seconds=sec)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
