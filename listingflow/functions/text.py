"""Text tidying expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def strip_space(c) -> Column:
    """Trim every kind of whitespace at both ends (``trim`` alone only removes spaces)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def clean_text_col(c, default: str | None = "Unknown") -> Column:
    """Collapse whitespace runs to one space, trim, capitalise each word.

    NULL and text that is empty after trimming become ``default`` (``None`` keeps NULL).
    """
    tidy = F.initcap(F.trim(F.regexp_replace(_col(c), r"\s+", " ")))
    tidy = _empty_to_null(tidy)
    return tidy if default is None else F.coalesce(tidy, F.lit(default))


def clean_name_col(c, default: str | None = "Unknown Developer") -> Column:
    """Without double quotes and commas, each run of white space as one space, trimmed."""
    name = F.trim(F.regexp_replace(F.translate(_col(c), '",', ""), r"\s+", " "))
    name = _empty_to_null(name)
    return name if default is None else F.coalesce(name, F.lit(default))


def is_nan_text(c) -> Column:
    """True for the text ``nan`` in any case with surrounding spaces."""
    return F.lower(F.trim(_col(c))) == "nan"


def strip_fences(c, tags=("json", "sql")) -> Column:
    """Remove Markdown code fences (```json, ```sql, ```) and surrounding whitespace."""
    out = _col(c)
    for tag in tags:
        out = F.replace(out, F.lit("```" + tag), F.lit(""))
    out = F.replace(out, F.lit("```"), F.lit(""))
    return strip_space(out)
