from pyspark.sql import functions as F

from listingflow.operators import cleaning as C
from listingflow.operators.asklog import audit_queries, chat_context, parse_routes
from listingflow.operators.features import (PAYMENT_CASH, PAYMENT_INSTALMENTS, flexibility_score,
                                            impute_down_payment, impute_mean, payment_type,
                                            ready_to_move)
from listingflow.operators.merge import dedup_latest, insert_new, upsert
from listingflow.operators.quality import flag_invalid, listing_rules, quality_summary, split_valid

SPELLING = {"Blue Hou se": "Blue House", "North Gat e": "North Gate"}


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_map_values_dict_and_table(spark):
    df = spark.createDataFrame([('"Blue  Hou se",',), ("Other",), (None,)], "Developer_Name string")
    df = C.clean_name(df)
    out = C.map_values(df, "Developer_Name", SPELLING)
    assert [r[0] for r in out.collect()] == ["Blue House", "Other", "Unknown Developer"]
    table = spark.createDataFrame([("Other", "Canon")], "f string, t string")
    out2 = C.map_values(df, "Developer_Name", table)
    assert sorted(r[0] for r in out2.collect()) == sorted(["Blue Hou se", "Canon", "Unknown Developer"])


def test_validate_domain_scrub_recode(spark):
    df = spark.createDataFrame([("HIGH", "nan", 0), (" high", " NaN ", 2), (None, "x", None)],
                               "r string, s string, n int")
    out = C.recode(C.scrub_nan(C.validate_domain(df, "r", C.REPUTATION_DOMAIN)), "n", {0: 1})
    assert rows(out, "r", "s", "n") == [("High", "Unknown", 1), ("Unknown", "Unknown", 2),
                                        ("Unknown", "x", None)]


def test_expand_json_and_defaults(spark):
    df = spark.createDataFrame([('{"has_pool": true, "parking_spots": "two", "security": "x"}', None),
                                ("bad json", 1)], "Amenities_JSON string, Smart_Home_Ready int")
    out = C.fill_defaults(C.expand_json(df, "Amenities_JSON"), C.AMENITY_DEFAULTS)
    assert rows(out, "has_pool", "gym", "security", "parking_spots", "Smart_Home_Ready") == [
        (True, False, "x", 0, 0), (False, False, "None", 0, 1)]


def test_impute_mean_null_safe_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0), (None, None),
                                ("b", None)], "g string, v double")
    out = impute_mean(df, "v", "g")
    assert sorted(rows(out, "g", "v"), key=str) == sorted(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), (None, 5.0), (None, 5.0), ("b", None)], key=str)


def test_payment_features(spark):
    df = spark.createDataFrame([(1, "d", 5, None), (2, "d", 10, 20.0), (3, "d", None, 40.0),
                                (4, "d", 0, None)],
                               "id int, Developer_Name string, Installment_Years int, Down_Payment_Pct double")
    out = flexibility_score(impute_down_payment(payment_type(df))).orderBy("id")
    got = rows(out, "Payment_Type", "Down_Payment_Pct", "Payment_Flexibility_Score")
    assert got == [(PAYMENT_INSTALMENTS, 30.0, 0.16), (PAYMENT_INSTALMENTS, 20.0, 0.48),
                   (PAYMENT_CASH, 100.0, None), (PAYMENT_CASH, 100.0, 0.0)]


def test_round_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(1.005,), (2.675,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 2)).collect()] == [1.01, 2.68]


def test_ready_to_move(spark):
    df = spark.createDataFrame([("2021-01-01",), ("2022-01-01",), (None,)], "d string") \
        .select(F.to_date("d").alias("Delivery_Date"))
    assert [r[0] for r in ready_to_move(df, "2021-06-30").select("Is_Ready_To_Move").collect()] == [
        True, False, False]


def test_dedup_latest_total_order(spark):
    df = spark.createDataFrame([("k", 1, 1), ("k", 2, 1), ("k", 2, 5), ("j", 1, 1)],
                               "k string, t int, s int")
    assert sorted(rows(dedup_latest(df, "k", ["t", "s"]), "k", "t", "s")) == [("j", 1, 1), ("k", 2, 5)]


def test_upsert_and_insert_new_are_idempotent_and_null_safe(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    assert sorted(rows(once, "k", "v"), key=str) == sorted(rows(twice, "k", "v"), key=str)
    assert sorted(rows(once, "k", "v"), key=str) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "N")], key=str)
    ins = insert_new(target, source, ["k"])
    assert sorted(rows(ins, "k", "v"), key=str) == sorted([(1, "a"), (2, "b"), (None, "n"), (3, "C")], key=str)
    assert sorted(rows(insert_new(ins, source, ["k"]), "k", "v"), key=str) == sorted(rows(ins, "k", "v"), key=str)


def test_flag_split_and_summary(spark):
    df = spark.createDataFrame([(None, None, "Unknown"), (1.0, None, "X"), (1.0, 2.0, "Unknown"),
                                (1.0, 2.0, "X")], "Total_Price double, Size_SqM double, City string")
    flagged = flag_invalid(df, listing_rules())
    assert [r[0] for r in flagged.select("quarantine_reason").collect()] == [
        "Missing or Invalid Price", "Missing or Invalid Size", "Missing City", None]
    good, bad = split_valid(flagged)
    assert good.count() == 1 and bad.count() == 3
    summary = {r["reason"]: (r["rows"], r["share"], r["alert"])
               for r in quality_summary(flagged, 0.3).collect()}
    assert summary["Valid"] == (1, 0.25, False)
    assert summary["Missing City"] == (1, 0.25, False)


def test_audit_queries(spark):
    df = spark.createDataFrame([
        ("SELECT last_updated_ts FROM fact_listings",),
        ("```sql\nSELECT * FROM t WHERE x = 'drop table'\n```",),
        ("MERGE INTO t USING s ON 1=1",),
        ("select count(*) from t",),
        ("SELECT * FROM t LIMIT 5; DELETE FROM t",),
        ("SHOW TABLES",),
    ], "sql_text string")
    got = rows(audit_queries(df), "blocked", "blocked_words", "needs_limit")
    assert got == [(False, "", True), (False, "", True), (True, "MERGE", True),
                   (False, "", False), (True, "DELETE", False), (True, "", True)]


def test_parse_routes(spark):
    df = spark.createDataFrame([('{"status": "IN_SCOPE", "message": ""}',),
                                ('```json\n{"status": "OOS_GEO", "message": "geo"}\n```',),
                                ("not json",), ('{"status": "OOS_GENERAL"}',), ("{}",),
                                ('{"status": "OOS_GEO"} trailing',), ("[1, 2]",)], "reply string")
    got = rows(parse_routes(df), "route_status", "in_scope", "reply_message")
    assert got[0] == ("IN_SCOPE", True, None)
    assert got[1] == ("OOS_GEO", False, "geo")
    assert got[2] == ("IN_SCOPE", True, None)
    assert got[3][0:2] == ("OOS_GENERAL", False) and got[3][2]
    assert got[4][1] is False
    assert got[5] == ("IN_SCOPE", True, None) and got[6] == ("IN_SCOPE", True, None)


def test_chat_context_matches_list_slicing(spark):
    msgs = [(1, i, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(6)] + \
           [(2, 0, "system", "s0"), (2, 1, "user", None)]
    df = spark.createDataFrame(msgs, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["context"] for r in chat_context(df).collect()}

    def expected(conv):
        history = [m for m in msgs if m[0] == conv]
        out = {}
        for i, m in enumerate(history):
            recent = history[max(0, i - 3): i + 1]
            text = ""
            if len(recent) > 1:
                text = "Conversation Context:\n" + "".join(
                    f"{'User' if r[2] == 'user' else 'Assistant'}: {r[3] or ''}\n" for r in recent[:-1])
            out[(conv, m[1])] = text
        return out
    assert got == {**expected(1), **expected(2)}


def test_guarded_sql_blocks_and_limits(spark):
    import pytest
    from listingflow.plans.star import guarded_sql
    spark.range(100).createOrReplaceTempView("nums")
    assert guarded_sql(spark, "SELECT id FROM nums").count() == 20
    assert guarded_sql(spark, "SELECT id FROM nums LIMIT 50").count() == 50
    assert guarded_sql(spark, "```sql\nSELECT count(*) AS n FROM nums;\n```").first()["n"] == 100
    with pytest.raises(PermissionError):
        guarded_sql(spark, "DROP TABLE nums")
    with pytest.raises(PermissionError):
        guarded_sql(spark, "SELECT 1; DELETE FROM nums")


def test_upsert_keeps_new_columns_and_assert_unique(spark):
    import pytest
    from listingflow.operators.merge import assert_unique
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "b", 1.5)], "k int, v string, extra double")
    out = {r.k: (r.v, r.extra) for r in upsert(target, source, ["k"]).collect()}
    assert out == {1: ("a", None), 2: ("b", 1.5)}
    assert_unique(target, ["k"])
    with pytest.raises(ValueError):
        assert_unique(target.union(target), ["k"], "dup")


def test_observe_counts_and_stamp_run(spark):
    import datetime as dt
    from listingflow.operators.quality import observe_counts, stamp_run
    df = spark.createDataFrame([(dt.datetime(2020, 1, d),) for d in (3, 1, 2)], "t timestamp_ntz")
    observed, obs = observe_counts(df, "probe", "t")
    stamped = stamp_run(observed, "run-1", dt.datetime(2030, 5, 6, 7, 8, 9))
    rows = stamped.collect()
    assert obs.get == {"rows": 3, "max_mark": "2020-01-03 00:00:00"}
    assert {(r.silver_run_id, r.silver_updated_at) for r in rows} == {
        ("run-1", dt.datetime(2030, 5, 6, 7, 8, 9))}


def test_table_context_and_views(spark, tmp_root):
    from listingflow.sources.context import table_context
    from listingflow.sources.tables import TableStore, append_rows, read_table
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, name string")
    ctx = {(r.table_name, r.column_name): (r.data_type, r.sample_values)
           for r in table_context({"a": a}, sample_rows=2).collect()}
    assert ctx[("a", "id")][0] == "int" and len(ctx[("a", "name")][1].split(" | ")) == 2
    path = f"{tmp_root}/appendonly"
    append_rows(a, path)
    append_rows(a.withColumn("more", F.lit(1.0)), path)
    both = read_table(spark, path)
    assert both.count() == 6 and both.filter(F.col("more").isNull()).count() == 3
    store = TableStore(spark, f"{tmp_root}/store")
    store.publish("fact_listings", a)
    store.register_views(["fact_listings", "missing"])
    assert spark.sql("SELECT count(*) AS n FROM fact_listings").first().n == 3


def test_star_measures_generic(spark):
    from listingflow.plans.star import star_measures
    fact = spark.createDataFrame([("l1", 10.0, 2.0), ("l1", 20.0, 4.0), ("l2", 5.0, 1.0)],
                                 "location_sk string, Size_SqM double, Price_Per_SqM double")
    locs = spark.createDataFrame([("l1", "A", "d"), ("l2", "B", "d")],
                                 "location_sk string, City string, District string")
    out = star_measures(fact, locs, by=["City"],
                        measures=[("n", "count", "*", None), ("s", "sum", "Size_SqM", None),
                                  ("a", "avg", "Price_Per_SqM", 1)],
                        where="Size_SqM > 6")
    assert sorted(map(tuple, out.collect())) == [("A", 2, 30.0, 3.0)]


def test_lookup_left_and_unique(spark):
    import pytest
    from listingflow.operators.facts import lookup
    rows_ = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, label string")
    out = lookup(rows_, dim, {"code": "k"}, ["label"], check_unique=True).orderBy("id")
    assert [tuple(r) for r in out.collect()] == [(1, "a", "A"), (2, "z", None), (3, None, None)]
    with pytest.raises(ValueError):
        lookup(rows_, dim.union(dim), {"code": "k"}, ["label"], check_unique=True)
