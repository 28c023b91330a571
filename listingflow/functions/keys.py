"""Surrogate keys and change predicates."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARKER = "<NULL>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(*cols, sep: str = "||", null_marker: str = NULL_MARKER) -> Column:
    """``md5`` over the parts joined by ``sep``; a NULL part is written as ``null_marker``.

    ``concat_ws`` alone skips NULLs, which would give (NULL, b) and (b, NULL) the same key.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_marker)) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def ts_text(c) -> Column:
    """Timestamp as fixed-width text (microseconds), independent of the session time zone
    for ``timestamp_ntz`` input."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def ts_literal(value, dtype: str = "timestamp_ntz") -> Column:
    """A timestamp constant that does not depend on the Python process time zone.

    A Column passes through; a ``datetime``/``date`` or text is written as text and cast by
    Spark, so a wall-clock value stays the same wall-clock value (for ``timestamp_ntz``) or is
    read in the session time zone (for ``timestamp``).
    """
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast(dtype)


def changed(left_cols, right_cols) -> Column:
    """True when any pair differs, NULL-safe (``NOT (l <=> r)`` OR-folded)."""
    tests = [~_col(a).eqNullSafe(_col(b)) for a, b in zip(left_cols, right_cols)]
    return reduce(lambda x, y: x | y, tests)
