"""Question-side helpers re-aimed at tables: audits of generated SQL, router replies and chat
context, computed over whole logs with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.text import strip_fences

# Statement words that block a generated query (the first eight are the original
# list; MERGE, CREATE and TRANSFORM close gaps in it; REPLACE writes behind CREATE only, alone it
# is a harmless function), and the aggregates that make a row limit
# unnecessary.
FORBIDDEN_WORDS = ("DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "TRUNCATE", "GRANT", "REVOKE",
                   "MERGE", "CREATE", "TRANSFORM")
AGGREGATE_WORDS = ("COUNT", "AVG", "SUM", "MIN", "MAX")
DEFAULT_ROW_LIMIT = 20

# Router statuses and the fallback reply for an out-of-scope question without a
# message ("Sorry, this question is outside my speciality.").
IN_SCOPE = "IN_SCOPE"
DEFAULT_OOS_MESSAGE = "عذراً، هذا السؤال خارج تخصصي."
ROUTE_SCHEMA = "status string, message string, _corrupt_record string"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def without_literals(c) -> Column:
    """SQL text with every '...' literal emptied and every comment made a space. Literals and
    comments are taken in one pass, whichever starts first, so a quote inside a comment opens no
    literal and dashes inside a literal open no comment."""
    both = r"('(?:[^']|'')*')|(?:--[^\n]*|/\*[\s\S]*?\*/)"
    marked = F.regexp_replace(_col(c), both, " $1")
    return F.regexp_replace(marked, r"'([^']|'')*'", "''")


def outer_level(c) -> Column:
    """What stands outside all parentheses of an upper-case text, as a struct: ``limited`` (the word
    LIMIT) and ``aggregated`` (a call of an aggregate that is not a window function, which keeps its
    rows). One pass over the text's words and signs; the state is a depth and a few flags, so the
    work grows with the text's length, however many parentheses it has."""
    # after: 0 plain, 1 an aggregate's name was just read, 2 inside its arguments, 3 its arguments
    # are closed and what follows decides, 4 FILTER was read behind them, 5 inside the filter.
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("after"), F.lit(False).alias("limited"),
                     F.lit(False).alias("aggregated"))
    tokens = F.regexp_extract_all(c, F.lit(r"[()]|\w+|[^\s\w()]"), F.lit(0))

    def step(s, token):
        outside, opens, closes = s["depth"] == 0, token == "(", token == ")"
        after = s["after"]
        word = (F.when((after == 3) & (token == "FILTER"), 4)
                .when(token.isin(*AGGREGATE_WORDS), 1).otherwise(0))
        return F.struct(
            F.when(opens, s["depth"] + 1).when(closes, F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"]).alias("depth"),
            F.when(outside & opens, F.when(after == 1, 2).when(after == 4, 5).otherwise(0))
             .when(closes & (s["depth"] == 1), F.when(after.isin(2, 5), 3).otherwise(0))
             .when(outside & ~closes, word).otherwise(after).alias("after"),
            (s["limited"] | (outside & (token == "LIMIT"))).alias("limited"),
            (s["aggregated"] | (outside & (after == 3) & ~token.isin("OVER", "FILTER"))).alias("aggregated"))

    return F.aggregate(tokens, start, step, lambda s: F.struct(
        s["limited"].alias("limited"), (s["aggregated"] | (s["after"] == 3)).alias("aggregated")))


def audit_queries(df: DataFrame, sql_col: str = "sql_text", words=FORBIDDEN_WORDS) -> DataFrame:
    """Add ``clean_sql`` (fences removed), ``blocked_words`` (whole words outside literals and
    comments, in order, comma-joined), ``blocked`` (any such word, or not a SELECT/WITH
    statement) and ``needs_limit`` (no LIMIT and no aggregate call outside parentheses; an
    aggregate with OVER keeps all rows and does not count)."""
    clean = strip_fences(sql_col)
    upper = F.upper(without_literals(clean))
    pattern = r"\b(" + "|".join(words) + r")\b"
    found = F.regexp_extract_all(upper, F.lit(pattern), 1)
    return df.withColumns({
        "clean_sql": clean,
        "blocked_words": F.array_join(found, ","),
        "blocked": (F.size(found) > 0) | ~upper.rlike(r"^\s*(SELECT|WITH)\b"),
        "__outer": outer_level(upper),
    }).withColumn("needs_limit", ~F.col("__outer.limited") & ~F.col("__outer.aggregated")).drop("__outer")


def parse_routes(df: DataFrame, reply_col: str = "reply") -> DataFrame:
    """Router replies -> ``route_status``, ``in_scope`` and ``reply_message``.

    Unreadable JSON counts as in scope (the question goes on to the SQL step). A readable reply
    without status IN_SCOPE is out of scope and answered with its message, or the default one.
    """
    body = strip_fences(reply_col)
    parsed = F.from_json(body, ROUTE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # The JSON reader accepts a leading object followed by other text; a reply counts as
    # readable only if the whole (fence-free) text is one object.
    corrupt = (parsed["_corrupt_record"].isNotNull() | parsed.isNull() |
               ~F.coalesce(body.rlike(r"^\{[\s\S]*\}$"), F.lit(False)))
    status = parsed["status"]
    in_scope = corrupt | F.coalesce(status == IN_SCOPE, F.lit(False))
    return df.withColumns({
        "route_status": F.when(corrupt, F.lit(IN_SCOPE)).otherwise(status),
        "in_scope": in_scope,
        "reply_message": F.when(~in_scope, F.coalesce(parsed["message"],
                                                      F.lit(DEFAULT_OOS_MESSAGE))),
    })


def chat_context(df: DataFrame, n: int = 4, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Add ``context``: the ``n - 1`` messages before each message as
    ``Conversation Context:`` + one ``User: ...`` / ``Assistant: ...`` line each, or ``''``.

    Messages follow by ``turn``, whatever gaps it has. ``lag`` over (conversation, turn) is one
    shuffle and streams through a partition with a buffer of ``n - 1`` rows, however long a
    conversation is.
    """
    line = F.concat(F.when(F.col(role) == "user", F.lit("User")).otherwise(F.lit("Assistant")),
                    F.lit(": "), F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    w = Window.partitionBy(conv).orderBy(turn)
    before = [F.coalesce(F.lag(line, k).over(w), F.lit("")) for k in range(n - 1, 0, -1)]
    first = F.lag(line, 1).over(w).isNull()
    return df.withColumn("context", F.when(first, F.lit("")).otherwise(
        F.concat(F.lit("Conversation Context:\n"), *before)))
