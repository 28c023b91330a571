"""Question-side and ingest queries: chat context, query-log audit, router replies, stream
ingest and table context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.plans import oracle as O
from listingflow.plans.queries.base import register
from listingflow.sources.fixtures import read_driver_table


# ---------------------------------------------------------------- chat side

@register("chat_context", """
SELECT conv_id, turn, role,
  CASE WHEN lag(line, 1) OVER w IS NULL THEN ''
       ELSE 'Conversation Context:' || chr(10) || coalesce(lag(line, 3) OVER w, '')
            || coalesce(lag(line, 2) OVER w, '') || lag(line, 1) OVER w END AS context
FROM (SELECT conv_id, turn, role,
             CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': ' || coalesce(text, '') || chr(10) AS line
      FROM conversations)
WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def q_chat_context(spark, sf_dir):
    from listingflow.operators.asklog import chat_context
    conv = read_driver_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role",
                                                                    "text")
    return chat_context(conv).select("conv_id", "turn", "role", "context")


def generated_sql(events: DataFrame) -> DataFrame:
    """A generated-query log derived from ``events`` (one text per event, twelve shapes: plain,
    fenced, aggregate, limited, literal containing a blocked word, write statements, a write behind
    a comment, a harmless function, inner limits, a script)."""
    uid = F.col("user_id").cast("string")
    cents = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    k = F.col("event_id") % 12
    text = (F.when(k == 0, F.concat(F.lit("SELECT City, Total_Price FROM fact_listings WHERE Rooms_Count = "), uid))
            .when(k == 1, F.concat(F.lit("```sql\nSELECT * FROM dim_location WHERE District = 'Drop "),
                                   F.col("event_type"), F.lit("'\n```")))
            .when(k == 2, F.concat(F.lit("SELECT Property_ID, last_updated_ts FROM fact_listings "
                                         "ORDER BY last_updated_ts DESC LIMIT "), uid))
            .when(k == 3, F.concat(F.lit("DELETE FROM dim_developer WHERE developer_sk = '"),
                                   F.col("event_id").cast("string"), F.lit("'")))
            .when(k == 4, F.concat(F.lit("select count(*) from fact_listings where Total_Price > "), cents))
            .when(k == 5, F.lit("WITH t AS (SELECT * FROM fact_listings) SELECT * FROM t; DROP TABLE t"))
            .when(k == 6, F.concat(F.lit("MERGE INTO dim_location USING x ON 1=1 -- "), F.col("props")))
            .when(k == 7, F.concat(F.lit("WITH x AS (SELECT 1) -- '\nINSERT INTO tgt SELECT "), uid, F.lit(" -- '")))
            .when(k == 8, F.concat(F.lit("SELECT replace(City, 'a', 'b') FROM dim_location /* don't drop */ WHERE 1 = "), uid))
            .when(k == 9, F.concat(F.lit("SELECT * FROM (SELECT * FROM fact_listings LIMIT "), uid,
                                   F.lit(") t WHERE (1 = (SELECT max(2)))")))
            .when(k == 10, F.concat(F.lit("SELECT TRANSFORM (City) USING 'cat' FROM dim_location WHERE 1 = "), uid))
            .otherwise(F.concat(F.lit("  SELECT max (Size_SqM) FROM fact_listings WHERE Rooms_Count = "), uid)))
    return events.select("event_id", text.alias("sql_text"))


def router_replies(events: DataFrame) -> DataFrame:
    """Router replies derived from ``events``: valid, fenced, invalid, and partial JSON."""
    k = F.col("event_id") % 6
    cents = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    reply = (F.when(k == 0, F.lit('{"status": "IN_SCOPE", "message": ""}'))
             .when(k == 1, F.concat(F.lit('```json\n{"status": "OOS_GENERAL", "message": "general '),
                                    F.col("event_type"), F.lit('"}\n```')))
             .when(k == 2, F.concat(F.lit("not json "), F.col("event_type")))
             .when(k == 3, F.lit('{"status": "OOS_GEO"}'))
             .when(k == 4, F.concat(F.lit('{"message": "user '), F.col("user_id").cast("string"), F.lit('"}')))
             .otherwise(F.concat(F.lit('{"status": "OOS_AMBIGUOUS", "message": "budget '), cents, F.lit('"}'))))
    return events.select("event_id", reply.alias("reply"))


_NL = "chr(10)"
_CENTS = "cast(cast(floor(value * 100) AS bigint) AS varchar)"
_SQL_LOG = f"""q AS (SELECT event_id, CASE event_id % 12
  WHEN 0 THEN 'SELECT City, Total_Price FROM fact_listings WHERE Rooms_Count = ' || cast(user_id AS varchar)
  WHEN 1 THEN '```sql' || {_NL} || 'SELECT * FROM dim_location WHERE District = ''Drop ' || event_type || '''' || {_NL} || '```'
  WHEN 2 THEN 'SELECT Property_ID, last_updated_ts FROM fact_listings ORDER BY last_updated_ts DESC LIMIT ' || cast(user_id AS varchar)
  WHEN 3 THEN 'DELETE FROM dim_developer WHERE developer_sk = ''' || cast(event_id AS varchar) || ''''
  WHEN 4 THEN 'select count(*) from fact_listings where Total_Price > ' || {_CENTS}
  WHEN 5 THEN 'WITH t AS (SELECT * FROM fact_listings) SELECT * FROM t; DROP TABLE t'
  WHEN 6 THEN 'MERGE INTO dim_location USING x ON 1=1 -- ' || props
  WHEN 7 THEN 'WITH x AS (SELECT 1) -- ''' || {_NL} || 'INSERT INTO tgt SELECT ' || cast(user_id AS varchar) || ' -- '''
  WHEN 8 THEN 'SELECT replace(City, ''a'', ''b'') FROM dim_location /* don''t drop */ WHERE 1 = ' || cast(user_id AS varchar)
  WHEN 9 THEN 'SELECT * FROM (SELECT * FROM fact_listings LIMIT ' || cast(user_id AS varchar) || ') t WHERE (1 = (SELECT max(2)))'
  WHEN 10 THEN 'SELECT TRANSFORM (City) USING ''cat'' FROM dim_location WHERE 1 = ' || cast(user_id AS varchar)
  ELSE '  SELECT max (Size_SqM) FROM fact_listings WHERE Rooms_Count = ' || cast(user_id AS varchar) END AS sql_text
FROM events)"""


def _strip_fences_sql(x: str) -> str:
    return (f"regexp_replace(replace(replace(replace({x}, '```json', ''), '```sql', ''), '```', ''), "
            f"'^\\s+|\\s+$', '', 'g')")


_WORDS = r"\b(DROP|DELETE|UPDATE|INSERT|ALTER|TRUNCATE|GRANT|REVOKE|MERGE|CREATE|TRANSFORM)\b"


_BARE = (r"regexp_replace(regexp_replace(clean_sql, '(''([^'']|'''')*'')|--[^\n]*|/[*](.|\n)*?[*]/', ' \1', 'g'), "
         r"'''([^'']|'''')*''', '''''', 'g')")
_PAREN = "regexp_replace({}, '[(][^()]*[)]', '¤', 'g')"
_OUTSIDE = _PAREN.format(_PAREN.format(_PAREN.format(_PAREN.format("up"))))


@register("audit_queries", O.with_ctes(
    _SQL_LOG, f"a AS (SELECT event_id, sql_text, {_strip_fences_sql('sql_text')} AS clean_sql FROM q)",
    f"b AS (SELECT *, upper({_BARE}) AS up FROM a)", f"o AS (SELECT *, {_OUTSIDE} AS outside FROM b)") + rf"""
SELECT event_id, sql_text, clean_sql,
  array_to_string(regexp_extract_all(up, '{_WORDS}', 1), ',') AS blocked_words,
  len(regexp_extract_all(up, '{_WORDS}', 1)) > 0 OR NOT regexp_matches(up, '^\s*(SELECT|WITH)\b') AS blocked,
  NOT regexp_matches(outside, '\bLIMIT\b') AND NOT regexp_matches(outside, '\b(COUNT|AVG|SUM|MIN|MAX)\s*¤') AS needs_limit
FROM o""")
def q_audit_queries(spark, sf_dir):
    from listingflow.operators.asklog import audit_queries
    return audit_queries(generated_sql(read_driver_table(spark, sf_dir, "events")))


@register("parse_routes", O.with_ctes(f"""r AS (SELECT event_id, CASE event_id % 6
  WHEN 0 THEN '{{"status": "IN_SCOPE", "message": ""}}'
  WHEN 1 THEN '```json' || {_NL} || '{{"status": "OOS_GENERAL", "message": "general ' || event_type || '"}}' || {_NL} || '```'
  WHEN 2 THEN 'not json ' || event_type
  WHEN 3 THEN '{{"status": "OOS_GEO"}}'
  WHEN 4 THEN '{{"message": "user ' || cast(user_id AS varchar) || '"}}'
  ELSE '{{"status": "OOS_AMBIGUOUS", "message": "budget ' || {_CENTS} || '"}}' END AS reply
FROM events)""", f"""t AS (SELECT event_id, reply, {_strip_fences_sql('reply')} AS body FROM r)""",
                                      """u AS (SELECT *, coalesce(CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' END, false) AS ok FROM t)""",
                                      """v AS (SELECT *, CASE WHEN ok THEN json_extract_string(body, '$.status') END AS st,
                   CASE WHEN ok THEN json_extract_string(body, '$.message') END AS msg FROM u)""") + f"""
SELECT event_id, reply,
  CASE WHEN NOT ok THEN 'IN_SCOPE' ELSE st END AS route_status,
  (NOT ok OR coalesce(st = 'IN_SCOPE', false)) AS in_scope,
  CASE WHEN NOT (NOT ok OR coalesce(st = 'IN_SCOPE', false)) THEN coalesce(msg, 'عذراً، هذا السؤال خارج تخصصي.') END AS reply_message
FROM v""")
def q_parse_routes(spark, sf_dir):
    from listingflow.operators.asklog import parse_routes
    return parse_routes(router_replies(read_driver_table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- ingest and context

@register("ingest_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_ingest_stream(spark, sf_dir):
    """Stream the events file into a bronze folder (drain and stop), then read the table back
    without its ingest stamps (time, file, day partition). The folder is a fresh one under the
    checkpoint root."""
    from listingflow.session import scratch_path
    from listingflow.sources.tables import read_table
    from listingflow.streaming.ingest import ingest_stream
    base = scratch_path(spark, "bronze-events")
    ingest_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", f"{base}/table", f"{base}/_checkpoint")
    return read_table(spark, f"{base}/table").drop("bronze_ingested_at", "source_file_path",
                                                   "ingest_date")


@register("ingest_bad_lines", """
SELECT event_id, event_type, value, NULL AS bad_line, true AS stamped FROM events WHERE event_id % 10 <> 0
UNION ALL
SELECT NULL, NULL, NULL, '{"event_id": ' || event_id || ', "event_type"', true FROM events WHERE event_id % 10 = 0""")
def q_ingest_bad_lines(spark, sf_dir):
    """JSON lines made of the events, every tenth cut off, taken in by two runs: rows in the table,
    cut lines in the quarantine, each exactly once and with its ingest stamps."""
    from listingflow.session import scratch_path
    from listingflow.streaming.ingest import ingest_stream, read_ingested
    base = scratch_path(spark, "bronze-lines")
    events = read_driver_table(spark, sf_dir, "events")
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type"'))
    line = F.when(F.col("event_id") % 10 == 0, cut).otherwise(F.to_json(F.struct("event_id", "event_type", "value")))
    schema = T.StructType.fromDDL("event_id bigint, event_type string, value double")
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).select(line.alias("value")).write.text(f"{base}/in/part={part}")
        ingest_stream(spark, f"{base}/in/*", f"{base}/table", f"{base}/_checkpoint", fmt="json", schema=schema,
                      schema_path=f"{base}/_schema", quarantine=f"{base}/bad")
    stamped = (F.col("bronze_ingested_at").isNotNull() & F.col("source_file_path").endswith(".txt")
               & (F.col("ingest_date") == F.to_date("bronze_ingested_at"))).alias("stamped")
    good = read_ingested(spark, f"{base}/table", f"{base}/_schema").select(
        "event_id", "event_type", "value", F.lit(None).cast("string").alias("bad_line"), stamped)
    bad = spark.read.parquet(f"{base}/bad").select(
        F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("double").alias("value"), F.col("_corrupt_record").alias("bad_line"), stamped)
    return good.unionByName(bad)


CONTEXT_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
_SAMPLES = "\n  UNION ALL\n  ".join(
    f"SELECT '{t}' AS table_name, column_name, v FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM "
    f"(SELECT * FROM {t} LIMIT 2)) ON COLUMNS(*) INTO NAME column_name VALUE v)"
    for t in CONTEXT_TABLES)


@register("table_context", f"""
WITH cols AS (
  SELECT table_name, ordinal_position - 1 AS ordinal, column_name,
         CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint'
              WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
              WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type
  FROM information_schema.columns
  WHERE table_name IN ({", ".join(f"'{t}'" for t in CONTEXT_TABLES)})),
samples AS (
  {_SAMPLES})
SELECT c.table_name, c.ordinal, c.column_name, c.data_type,
       coalesce(string_agg(s.v, ' | ' ORDER BY s.v), '') AS sample_values
FROM cols c LEFT JOIN samples s ON c.table_name = s.table_name AND c.column_name = s.column_name
GROUP BY ALL""")
def q_table_context(spark, sf_dir):
    """Schema and two sample rows of the driver's star tables (the context handed to a
    question-to-SQL assistant); only two rows of each table are read."""
    from listingflow.sources.context import table_context
    return table_context({n: read_driver_table(spark, sf_dir, n) for n in CONTEXT_TABLES},
                         sample_rows=2)
