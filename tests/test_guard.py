"""The guarded runner: WITH names by scope, functions by their registered class, outer-level rules."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from listingflow.operators.asklog import audit_queries
from listingflow.plans.guard import allowed_function, guarded_sql, read_query

NAMES = ["allowed", "secret", "other"]


@pytest.fixture(scope="module")
def views(spark):
    spark.createDataFrame([(1, "x")], "a int, b string").createOrReplaceTempView("allowed")
    spark.createDataFrame([(7, "hidden")], "a int, b string").createOrReplaceTempView("secret")
    yield spark
    for name in ("allowed", "secret"):
        spark.catalog.dropTempView(name)


def run(spark, text):
    return [tuple(r) for r in guarded_sql(spark, text, tables=["allowed"]).collect()]


@pytest.mark.parametrize("text", [
    "SELECT * FROM secret UNION ALL SELECT * FROM (WITH secret AS (SELECT 1 AS a, 'x' AS b) SELECT * FROM secret)",
    "SELECT * FROM secret WHERE a IN (WITH secret AS (SELECT 7 AS a) SELECT a FROM secret)",
    "WITH t AS (WITH secret AS (SELECT 1 AS a) SELECT * FROM secret) SELECT * FROM t, secret",
    "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret",
    "WITH t AS (SELECT * FROM secret), secret AS (SELECT 1 AS a, 'x' AS b) SELECT * FROM t",
    "SELECT (SELECT max(b) FROM secret) FROM allowed",
    "SELECT * FROM allowed WHERE EXISTS (SELECT 1 FROM secret)",
    "SELECT * FROM allowed, LATERAL (SELECT * FROM secret)",
    "WITH secret AS (SELECT 1 AS a) SELECT * FROM default.secret",
    "SELECT * FROM parquet.`/tmp/x`",
    "SELECT * FROM IDENTIFIER('sec' || 'ret')",
    "TABLE secret",
])
def test_tables_behind_shadowing_names_are_refused(views, text):
    with pytest.raises(PermissionError):
        run(views, text)


@pytest.mark.parametrize("text, rows", [
    ("WITH secret AS (SELECT a + 1 AS a FROM allowed) SELECT * FROM secret", [(2,)]),
    ("WITH x AS (SELECT * FROM allowed), y AS (SELECT * FROM x) SELECT y.b FROM y JOIN x ON x.a = y.a", [("x",)]),
    ("WITH x AS (SELECT 5 AS a) SELECT * FROM (WITH x AS (SELECT 6 AS a) SELECT * FROM x) UNION ALL SELECT * FROM x", [(6,), (5,)]),
    ("WITH x AS (SELECT 3 AS n) SELECT a FROM allowed WHERE 3 IN (SELECT n FROM x)", [(1,)]),
    ("WITH RECURSIVE r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r WHERE n < 3) SELECT n FROM r ORDER BY n", [(1,), (2,), (3,)]),
])
def test_legal_shadowing_runs(views, text, rows):
    assert run(views, text) == rows


def queries():
    """(text, tables it reads): nested WITHs, unions and subqueries, resolved by the generator."""
    def build(draw, visible, depth):
        kind = draw(st.sampled_from(["table", "with", "union", "nested", "in"] if depth else ["table"]))
        if kind == "table":
            name = draw(st.sampled_from(NAMES))
            return f"SELECT * FROM {name}", set() if name in visible else {name}
        if kind in ("union", "in"):
            (one, a), (two, b) = build(draw, visible, depth - 1), build(draw, visible, depth - 1)
            if kind == "union":
                return f"SELECT * FROM ({one}) UNION ALL SELECT * FROM ({two})", a | b
            return f"SELECT * FROM ({one}) q WHERE EXISTS ({two})", a | b
        if kind == "nested":
            one, a = build(draw, visible, depth - 1)
            return f"SELECT * FROM ({one})", a
        defined, parts, read = visible, [], set()
        for name in draw(st.lists(st.sampled_from(NAMES), min_size=1, max_size=2, unique=True)):
            text, a = build(draw, defined, depth - 1)
            parts.append(f"{name} AS ({text})")
            read |= a
            defined = defined | {name}
        text, a = build(draw, defined, depth - 1)
        return f"WITH {', '.join(parts)} SELECT * FROM ({text})", read | a

    return st.composite(lambda draw: build(draw, frozenset(), 4))()


@settings(max_examples=60, deadline=None, derandomize=True)
@given(queries())
def test_names_by_scope(spark, query):
    text, tables = query
    assert read_query(spark, text).relations == tables


@pytest.mark.parametrize("text", [
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT java_method('java.lang.Math', 'abs', 1)",
    "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
    "SELECT system.builtin.reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT a FROM allowed WHERE length(reflect('java.lang.System', 'getProperty', 'user.home')) > 0",
    "SELECT transform(array(1), x -> reflect('java.lang.System', 'getProperty', 'user.home'))",
    "SELECT input_file_name() FROM allowed", "SELECT current_user", "SELECT current_database()", "SELECT raise_error('x')",
    "SELECT harmless(a) FROM allowed", "SELECT upper_case(b) FROM allowed", "SELECT * FROM range(3)", "SELECT no_such_function(1)",
])
def test_functions_that_do_more_than_compute_are_refused(views, text):
    views.udf.register("harmless", lambda x: x)
    with pytest.raises(PermissionError):
        run(views, text)


def test_functions_that_compute_run(views):
    assert run(views, "SELECT upper(b), round(avg(a), 1), count(*) FROM allowed GROUP BY b") == [("X", 1.0, 1)]
    assert run(views, "SELECT explode(sequence(1, 2)), date_format(DATE '2020-01-02', 'yyyy'), coalesce(NULL, typeof(a)) "
                      "FROM allowed") == [(1, "2020", "int"), (2, "2020", "int")]
    views.udf.register("harmless", lambda x: x)
    assert guarded_sql(views, "SELECT harmless(b) FROM allowed", tables=["allowed"], functions=["harmless"]).first()[0] == "x"
    assert not allowed_function(views, "builtin.upper") and allowed_function(views, "UPPER")


def test_window_aggregates_keep_the_row_limit(spark):
    texts = {"SELECT a, COUNT(*) OVER () FROM t": True, "SELECT COUNT(*) FROM t": False, "SELECT sum(a) FILTER (WHERE a > 1) FROM t": False,
             "SELECT sum(a) FILTER (WHERE a > 1) OVER (PARTITION BY b) FROM t": True, "SELECT max(a) over w, a FROM t WINDOW w AS (ORDER BY b)": True,
             "SELECT COUNT(*), MAX(a) OVER () FROM t": False, "SELECT a FROM (SELECT max(a) FROM t LIMIT 3)": True,
             "SELECT a FROM t LIMIT 5": False, "SELECT counter(a) FROM t": True, "SELECT a, max FROM t": True, "SELECT SUM (a)": False}
    df = spark.createDataFrame([(t,) for t in texts], "sql_text string")
    assert {r["sql_text"]: r["needs_limit"] for r in audit_queries(df).collect()} == texts


def test_many_parentheses_are_one_pass(spark):
    """100,000 parentheses, nested and side by side; ten times as many take about ten times as long."""
    def seconds(n):
        texts = [("SELECT " + "(" * n + "1" + ")" * n,), ("SELECT " + "()" * n + " LIMIT 3",)]
        df = audit_queries(spark.createDataFrame(texts, "sql_text string"))
        start = time.time()
        assert sorted(r["needs_limit"] for r in df.collect()) == [False, True]
        return time.time() - start

    seconds(1000)
    short, long = seconds(10_000), seconds(100_000)
    assert long < 40 * max(short, 0.5)
