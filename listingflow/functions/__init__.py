"""Column expressions (built-in ``pyspark.sql.functions`` only, so they stay in codegen)."""

from listingflow.functions.dates import DEFAULT_DATE_LAYOUTS, parse_date_col
from listingflow.functions.keys import changed, hash_key, ts_literal, ts_text
from listingflow.functions.numbers import (clamp_col, parse_amount_col, positive_double_col)
from listingflow.functions.text import (clean_name_col, clean_text_col, is_nan_text,
                                        strip_fences, strip_space)

__all__ = [
    "DEFAULT_DATE_LAYOUTS", "parse_date_col", "changed", "hash_key", "ts_literal", "ts_text", "clamp_col",
    "parse_amount_col", "positive_double_col", "clean_name_col", "clean_text_col",
    "is_nan_text", "strip_fences", "strip_space",
]
