"""Property tests of operators against plain-Python references (few examples each: every
example runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listingflow.functions.dates import parse_date_col
from listingflow.operators.asklog import chat_context
from listingflow.operators.merge import insert_new, upsert

SETTINGS = settings(max_examples=5, deadline=None, derandomize=True,
                    suppress_health_check=list(HealthCheck))


@SETTINGS
@given(convs=st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]),
                                         st.one_of(st.none(), st.text("ab ,\n", max_size=5))),
                               max_size=7), min_size=1, max_size=3))
def test_chat_context_equals_list_slicing(spark, convs):
    rows = [(c, t, role, text) for c, msgs in enumerate(convs) for t, (role, text) in enumerate(msgs)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.context for r in chat_context(df).collect()}
    for c, msgs in enumerate(convs):
        for i in range(len(msgs)):
            recent = msgs[max(0, i - 3): i + 1]
            want = ""
            if len(recent) > 1:
                want = "Conversation Context:\n" + "".join(
                    f"{'User' if r == 'user' else 'Assistant'}: {x or ''}\n" for r, x in recent[:-1])
            assert got[(c, i)] == want


LAYOUTS = ["%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "{m}/{d}/%Y", "%d-%m-%Y", "{d}-{m}-%Y", "%d-%b-%Y",
           "%b-%d-%Y", "%b %d, %Y", "%b {d}, %Y"]


def render(day: dt.date, layout: str) -> str:
    return day.strftime(layout.replace("{m}", str(day.month)).replace("{d}", str(day.day)))


@SETTINGS
@given(days=st.lists(st.dates(dt.date(2010, 1, 1), dt.date(2035, 12, 31)), min_size=1, max_size=20),
       layouts=st.lists(st.sampled_from(LAYOUTS), min_size=20, max_size=20))
def test_any_listed_layout_parses_back(spark, days, layouts):
    texts = [render(d, layout) for d, layout in zip(days, layouts)]
    df = spark.createDataFrame(list(zip(range(len(texts)), texts)), "i int, s string")
    got = {r.i: r.d for r in df.select("i", parse_date_col("s").alias("d")).collect()}
    for i, day in enumerate(days):          # slashes are month-first, dashes day-first
        assert got[i] == day, (texts[i], got[i], day)


keys = st.one_of(st.none(), st.integers(0, 6))


@SETTINGS
@given(target=st.dictionaries(keys, st.text("xyz", max_size=2), max_size=6),
       source=st.dictionaries(keys, st.text("XYZ", max_size=2), max_size=6))
def test_upsert_and_insert_new_match_dict_semantics(spark, target, source):
    schema = "k int, v string"
    t = spark.createDataFrame(list(target.items()), schema)
    s = spark.createDataFrame(list(source.items()), schema)
    up = {r.k: r.v for r in upsert(t, s, ["k"]).collect()}
    assert up == {**target, **source}
    ins = {r.k: r.v for r in insert_new(t, s, ["k"]).collect()}
    assert ins == {**source, **target}
