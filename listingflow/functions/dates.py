"""Date parsing with an ordered list of layouts; the first layout that parses wins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, in the order they are tried. Whitespace is removed before
# parsing, so the spaced layout "MMM dd, yyyy" is tried in its space-free forms. A layout paired
# with a number is applied to that many leading characters only (an ISO date followed by a time).
DEFAULT_DATE_LAYOUTS = (
    ("yyyy-MM-dd", 10),
    ("MM/dd/yyyy", None),
    ("M/d/yyyy", None),
    ("dd-MM-yyyy", None),
    ("d-M-yyyy", None),
    ("dd-MMM-yyyy", None),
    ("MMM-dd-yyyy", None),
    ("MMMdd,yyyy", None),
    ("MMMd,yyyy", None),
)


def layout_shape(fmt: str, whole: bool = True) -> str:
    """A regular expression every text must match for ``fmt`` to parse it (a necessary test,
    derived from the layout letters: ``yyyy`` four or more digits, ``MM``/``dd`` two digits,
    ``M``/``d`` one or more, ``MMM`` three letters, ``MMMM`` letters; other characters literal)."""
    parts = []
    for token in re.findall(r"y+|M+|d+|[^yMd]+", fmt):
        n = len(token)
        if token[0] == "y":
            parts.append(r"[+-]?\d{%d,}" % n if n >= 4 else r"\d{%d}" % n)
        elif token[0] == "M":
            parts.append({1: r"\d+", 2: r"\d{2}", 3: "[A-Za-z]{3}"}.get(n, "[A-Za-z]+"))
        elif token[0] == "d":
            parts.append(r"\d+" if n == 1 else r"\d{%d}" % n)
        else:
            parts.append(re.escape(token))
    return "^" + "".join(parts) + ("$" if whole else "")


def parse_date_col(c, layouts=DEFAULT_DATE_LAYOUTS) -> Column:
    """Remove all whitespace, then the first layout of ``layouts`` that parses wins.

    Each ``try_to_date`` is guarded by its layout's shape test: a layout that cannot match is
    skipped instead of being attempted (a failed parse costs a JVM exception per value), so a
    value is parsed about once. The shape test is a necessary condition of the parse, so the
    result equals the plain ``coalesce`` over all layouts.
    """
    text = F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"\s+", "")
    attempts = []
    for layout in layouts:
        fmt, prefix = (layout, None) if isinstance(layout, str) else layout
        src = F.substring(text, 1, prefix) if prefix else text
        shape = layout_shape(fmt, whole=prefix is None)
        attempts.append(F.when(text.rlike(shape), F.try_to_date(src, fmt)))
    return F.coalesce(*attempts)
