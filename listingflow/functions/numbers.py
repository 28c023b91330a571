"""Tolerant numeric parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A price text is one number, with a currency word or sign before or behind it at most.
_WORD = r"[\p{L}\p{Sc}]+\.?"
_PRICE = rf"^\s*(?:{_WORD}\s*)?([-+]?[0-9.][0-9 \u00A0,.]*?(?:[eE][-+]?[0-9]+)?)\s*(?:{_WORD})?\s*$"
# Ways to write it: plain, or in groups of three by one separator. A single group behind a point
# ("2.500") or a comma before other than three digits ("1,5") can be read two ways: no number.
_PLAIN = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
_TWO_WAYS = r"^[-+]?[1-9][0-9]{0,2}\.[0-9]{3}$"
_BY_COMMA = r"^[-+]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]*)?$"
_BY_SPACE = r"^[-+]?[0-9]{1,3}([ \u00A0][0-9]{3})+([.,][0-9]{1,2})?$"
_BY_POINT = r"^[-+]?[0-9]{1,3}(\.[0-9]{3}){2,}(,[0-9]{1,2})?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_amount_col(c, mode: str = "decimal", precision: int = 18, scale: int = 2) -> Column:
    """Price text -> positive number or NULL.

    ``decimal``: the whole text, less a currency word, must be one number, plain or grouped by
    thousands in one style, read as ``decimal(precision, scale)``; anything else gives NULL.
    ``digits``: every non-digit removed, read as bigint (the
    original behaviour, kept for comparison). Values <= 0 and unreadable text give NULL.
    """
    src = _col(c).cast("string")
    if mode == "decimal":
        text = F.regexp_extract(src, _PRICE, 1)
        number = (F.when(text.rlike(_TWO_WAYS), None).when(text.rlike(_PLAIN), text)
                  .when(text.rlike(_BY_COMMA), F.replace(text, F.lit(",")))
                  .when(text.rlike(_BY_SPACE), F.translate(text, ", \u00A0", "."))
                  .when(text.rlike(_BY_POINT), F.translate(text, ",.", ".")))
        value = number.try_cast(f"decimal({precision},{scale})")
    elif mode == "digits":
        value = F.regexp_replace(src, "[^0-9]", "").try_cast("bigint")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(value > 0, value)


def positive_double_col(c) -> Column:
    """``try_cast`` to double; NaN, zero and negatives become NULL."""
    value = _col(c).try_cast("double")
    return F.when((value > 0) & ~F.isnan(value), value)


def clamp_col(c, lo, hi, dtype: str = "double") -> Column:
    """``try_cast`` to ``dtype`` (NaN -> NULL), then clamp into [lo, hi]; NULL stays NULL."""
    value = _col(c).try_cast(dtype)
    if dtype in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    return (F.when(value < lo, F.lit(lo).cast(dtype))
            .when(value > hi, F.lit(hi).cast(dtype))
            .otherwise(value))
