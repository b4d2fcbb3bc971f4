"""Row helpers shared by the tests."""

from collections import Counter
from datetime import datetime


def bag(df, *columns):
    """The rows of a frame as a multiset of tuples."""
    chosen = df.select(*columns) if columns else df
    return Counter(tuple(r) for r in chosen.collect())


def at(text):
    return datetime.fromisoformat(text)
