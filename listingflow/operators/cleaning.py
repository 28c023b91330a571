"""Cleaning operators: each takes a DataFrame and returns one, adding or retyping columns.

All work is built-in column expressions, so a chain of them collapses into one projection
inside whole-stage codegen; none of them shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from listingflow.functions.dates import DEFAULT_DATE_LAYOUTS, parse_date_col
from listingflow.functions.numbers import clamp_col, parse_amount_col, positive_double_col
from listingflow.functions.text import clean_name_col, clean_text_col, is_nan_text

# The text columns tidied by clean_text, and the allowed domains of the two
# developer ratings.
TEXT_COLUMNS = ("City", "District", "Compound_Name", "Unit_Type", "View_Type")
REPUTATION_DOMAIN = ("low", "medium", "high", "excellent", "poor")
PUNCTUALITY_DOMAIN = ("low", "medium", "high")

# The amenities JSON document and the defaults for its missing fields and for
# Smart_Home_Ready.
AMENITIES_DDL = "has_pool boolean, gym boolean, security string, parking_spots int"
AMENITY_DEFAULTS = {"Smart_Home_Ready": 0, "security": "None", "has_pool": False, "gym": False,
                    "parking_spots": 0}


def clean_text(df: DataFrame, cols=TEXT_COLUMNS, default: str | None = "Unknown") -> DataFrame:
    """Collapse spaces, trim, capitalise words; NULL or empty -> ``default``."""
    return df.withColumns({c: clean_text_col(c, default) for c in cols})


def parse_dates(df: DataFrame, cols, layouts=DEFAULT_DATE_LAYOUTS) -> DataFrame:
    """Text -> date by the first layout that parses (order kept); unparseable -> NULL."""
    cols = [cols] if isinstance(cols, str) else cols
    return df.withColumns({c: parse_date_col(c, layouts) for c in cols})


def date_fallback(df: DataFrame, col: str,
                  candidates=("ingestion_time", "bronze_ingested_at")) -> DataFrame:
    """Fill a missing date from the date part of the first candidate column present."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return df
    return df.withColumn(col, F.coalesce(F.col(col), F.to_date(F.col(present[0]))))


def within_years(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    """NULL dates whose year lies outside [lo, hi]."""
    return df.withColumn(col, F.when(F.year(col).between(lo, hi), F.col(col)))


def parse_amount(df: DataFrame, col: str, mode: str = "decimal") -> DataFrame:
    """Price text -> positive ``decimal(18,2)`` (or the digit-only bigint reading)."""
    return df.withColumn(col, parse_amount_col(col, mode))


def positive_double(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, positive_double_col(col))


def ratio(df: DataFrame, out: str, num: str, den: str) -> DataFrame:
    """``num / den`` as doubles; NULL when either side is NULL or the divisor is zero."""
    return df.withColumn(out, F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))


def clamp(df: DataFrame, col: str, lo, hi, dtype: str = "double") -> DataFrame:
    return df.withColumn(col, clamp_col(col, lo, hi, dtype))


def try_casts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Tolerant casts: text that does not read as the type becomes NULL instead of failing."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def expand_json(df: DataFrame, col: str, schema=AMENITIES_DDL, drop: bool = True) -> DataFrame:
    """Parse a JSON text column into top-level typed columns.

    A field of the wrong type is NULL on its own; an unreadable document gives all NULLs.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    # Parse once into a struct column and expand it; referencing the parse once per field would
    # let the optimizer prune it into one parse per field.
    out = (df.withColumn("__parsed", F.from_json(F.col(col), schema))
           .select("*", *[F.col("__parsed")[f.name].alias(f.name) for f in schema.fields])
           .drop("__parsed"))
    return out.drop(col) if drop else out


def clean_name(df: DataFrame, col: str = "Developer_Name",
               default: str | None = "Unknown Developer") -> DataFrame:
    return df.withColumn(col, clean_name_col(col, default))


def map_values(df: DataFrame, col: str, mapping) -> DataFrame:
    """Replace known values of ``col``.

    ``mapping`` as a dict becomes one CASE expression (for the short lists of spelling fixes);
    as a DataFrame ``(from_value, to_value)`` it is joined, so it may be any size (AQE broadcasts it
    only when its measured size allows).
    """
    if isinstance(mapping, dict):
        if not mapping:
            return df
        return df.replace(mapping, subset=[col])
    pairs = (mapping.select(F.col(mapping.columns[0]).alias("__from"),
                            F.col(mapping.columns[1]).alias("__to"))
             .groupBy("__from").agg(F.min("__to").alias("__to")))  # one target per value
    joined = df.join(pairs, F.col(col) == F.col("__from"), "left")
    return joined.withColumn(col, F.coalesce(F.col("__to"), F.col(col))).drop("__from", "__to")


def validate_domain(df: DataFrame, col: str, allowed, default: str = "Unknown") -> DataFrame:
    """Keep a value whose lower case is in ``allowed`` (capitalised); anything else -> default."""
    c = F.col(col)
    ok = F.lower(c).isin(list(allowed))
    return df.withColumn(col, F.when(c.isNotNull() & ok, F.initcap(c)).otherwise(F.lit(default)))


def scrub_nan(df: DataFrame, default: str = "Unknown", cols=None) -> DataFrame:
    """The text ``nan`` (any case, padded) -> ``default`` in every string column."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(is_nan_text(c), F.lit(default)).otherwise(F.col(c))
                           for c in cols})


def recode(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """Replace single values (e.g. 0 rooms -> 1)."""
    c = F.col(col)
    expr = None
    for old, new in mapping.items():
        expr = (F.when(c == old, F.lit(new)) if expr is None
                else expr.when(c == old, F.lit(new)))
    return df if expr is None else df.withColumn(col, expr.otherwise(c))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Per-column NULL defaults, cast to the column's own type (no silent text/boolean coercion)."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in defaults.items() if c in types})
