"""Silver step semantics on the fixture with literal edits: missing keys, a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from listingflow.operators.features import impute_mean
from listingflow.operators.quality import REASON_MISSING_KEY, split_valid
from listingflow.plans.silver import clean_rows, impute_and_derive, newest_versions, silver_transform
from listingflow.sources.fixtures import raw_listings


def test_missing_keys_each_quarantined(spark):
    raw = raw_listings(spark, SF_SMALL)
    sample = raw.orderBy("row_seq").limit(3).collect()
    bad_keys = [None, "nan", "   "]
    extra = spark.createDataFrame([r.asDict() | {"Property_ID": k} for r, k in zip(sample, bad_keys)],
                                  raw.schema)
    flagged = silver_transform(raw.unionByName(extra), "2021-06-30")
    good, bad = split_valid(flagged)
    missing = bad.filter(F.col("quarantine_reason") == REASON_MISSING_KEY)
    assert missing.count() == 3                       # not collapsed into one NULL group
    assert good.select("Property_ID").distinct().count() == good.count()
    assert flagged.count() == raw.select("Property_ID").distinct().count() + 3


def test_hot_group_means_equal_window_semantics(spark):
    raw = raw_listings(spark, SF_SMALL)
    # one developer (NULL -> "Unknown Developer") and one city ("Unknown") hold a third of rows
    hot = F.col("row_seq") % 3 == 0
    skewed = raw.withColumns({"Developer_Name": F.when(hot, F.lit(None)).otherwise(F.col("Developer_Name")),
                              "City": F.when(hot, F.lit("nan")).otherwise(F.col("City"))})
    cleaned = clean_rows(newest_versions(skewed))
    ours = impute_and_derive(cleaned, "2021-06-30").select(
        "Property_ID", "Down_Payment_Pct", "Transport_Index_Num")
    w_dev, w_city = Window.partitionBy("Developer_Name"), Window.partitionBy("City")
    ref = cleaned.select(
        "Property_ID",
        F.when(~F.coalesce(F.col("Installment_Years") > 0, F.lit(False)), F.lit(100.0))
         .otherwise(F.coalesce("Down_Payment_Pct", F.avg("Down_Payment_Pct").over(w_dev)))
         .alias("Down_Payment_Pct"),
        F.coalesce("Transport_Index_Num", F.avg("Transport_Index_Num").over(w_city))
         .alias("Transport_Index_Num"))
    a = {r.Property_ID: (round(r.Down_Payment_Pct, 9), r.Transport_Index_Num) for r in ours.collect()}
    b = {r.Property_ID: (round(r.Down_Payment_Pct, 9), r.Transport_Index_Num) for r in ref.collect()}
    assert a == b
    hot_rows = cleaned.filter(F.col("Developer_Name") == "Unknown Developer").count()
    assert hot_rows * 4 > cleaned.count()             # the hot group really is hot


def test_impute_mean_from_history(spark):
    batch = spark.createDataFrame([("a", None), ("b", None)], "g string, v double")
    history = spark.createDataFrame([("a", 4.0), ("a", 6.0)], "g string, v double")
    out = {r.g: r.v for r in impute_mean(batch, "v", "g", stats_from=history).collect()}
    assert out == {"a": 5.0, "b": None}
