import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from listingflow.functions import (clamp_col, clean_name_col, clean_text_col, hash_key,
                                   parse_amount_col, parse_date_col, positive_double_col,
                                   strip_fences)
from listingflow.functions.dates import DEFAULT_DATE_LAYOUTS, layout_shape


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_clean_text(spark):
    got = one_col(spark, ["  new   cairo ", "NEW\tCAIRO", None, "   ", "", "a b"], clean_text_col)
    assert got == ["New Cairo", "New Cairo", "Unknown", "Unknown", "Unknown", "A B"]
    assert one_col(spark, [None, " x "], lambda c: clean_text_col(c, None)) == [None, "X"]


def test_clean_name(spark):
    got = one_col(spark, ['"Palm  Hills",', "A\nB", None, '"",'], clean_name_col)
    assert got == ["Palm Hills", "A B", "Unknown Developer", "Unknown Developer"]


def test_parse_dates_all_layouts(spark):
    values = ["2025-03-07 10:00:00", "03/07/2025", "3/7/2025", "07-03-2025", "7-3-2025",
              "07-Mar-2025", "Mar-07-2025", "Mar 07, 2025", "Mar 7, 2025", "TBD", None,
              "13/45/2025", " 2025 - 03 - 07 "]
    got = one_col(spark, values, parse_date_col)
    d = dt.date(2025, 3, 7)
    assert got == [d] * 9 + [None, None, None, d]


def test_layout_shapes_are_necessary():
    import re
    for fmt, prefix in DEFAULT_DATE_LAYOUTS:
        shape = layout_shape(fmt, whole=prefix is None)
        assert shape.startswith("^")
    assert re.match(layout_shape("dd-MMM-yyyy"), "07-Mar-2025")
    assert not re.match(layout_shape("MM/dd/yyyy"), "3/7/2025")


def test_parse_amount(spark):
    values = ["EGP 1,250,000.50", "1250000", "1.25E7", "-500", "", None, "0", "abc", "12.50"]
    got = one_col(spark, values, parse_amount_col)
    assert got == [Decimal("1250000.50"), Decimal("1250000.00"), Decimal("12500000.00"), None,
                   None, None, None, None, Decimal("12.50")]
    digits = one_col(spark, ["EGP 1,250,000.50", "-500", ""], lambda c: parse_amount_col(c, "digits"))
    assert digits == [125000050, 500, None]


def test_positive_double_and_clamp(spark):
    assert one_col(spark, ["nan", "0", "-5", "12.5", "x"], positive_double_col) == [None, None, None, 12.5, None]
    got = one_col(spark, ["-3", "150", "nan", None, "40"], lambda c: clamp_col(c, 0.0, 100.0))
    assert got == [0.0, 100.0, None, None, 40.0]
    got = one_col(spark, ["-2", "34", "12"], lambda c: clamp_col(c, 0, 30, "int"))
    assert got == [0, 30, 12]


def test_hash_key_null_positions_differ(spark):
    df = spark.createDataFrame([(None, "b"), ("b", None), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(hash_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    assert keys[2] == __import__("hashlib").md5(b"a||b").hexdigest()


def test_strip_fences(spark):
    got = one_col(spark, ["```json\n{\"a\": 1}\n```", "  ```sql SELECT 1 ```  ", None], strip_fences)
    assert got == ['{"a": 1}', "SELECT 1", None]


def test_spread_only_when_scan_is_narrow(spark, tmp_path):
    from listingflow.session import spread
    path = str(tmp_path / "one")
    spark.range(1000).coalesce(1).write.parquet(path)
    narrow = spark.read.parquet(path)
    assert narrow.rdd.getNumPartitions() == 1
    wide = spread(narrow, 4)
    assert wide.rdd.getNumPartitions() == 4 and wide.count() == 1000
    many = spark.range(0, 1000, numPartitions=8)
    assert spread(many, 4) is many
