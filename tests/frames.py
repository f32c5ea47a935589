"""What the test modules share."""

from __future__ import annotations


def rows(df, *names):
    """Rows as sorted tuples of the named columns."""
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
