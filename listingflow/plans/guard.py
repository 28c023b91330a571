"""Guarded runner for generated SQL: one read-only query, allowed tables, allowed functions.

The text is read by Spark's own parser and its plan is walked before anything is analyzed. The
walk carries the WITH names that are visible at each place: a name hides a table only inside the
query that defines it and in the definitions after its own, as Spark resolves it. Functions are
looked up in the session's registry and allowed by the group and the class that they are
registered with, so a new name for a forbidden class, or a user's function under a harmless name,
is seen for what it is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from listingflow.operators.asklog import DEFAULT_ROW_LIMIT, audit_queries

# The kinds of plan nodes that a read-only query may have, as Spark's parser names them.
READ_NODES = frozenset(
    "Project Filter Aggregate Join Sort GlobalLimit LocalLimit Offset SubqueryAlias Distinct Union "
    "Except Intersect OneRowRelation UnresolvedRelation UnresolvedWith UnresolvedHaving "
    "UnresolvedInlineTable UnresolvedSubqueryColumnAliases WithWindowDefinition Window Generate "
    "LateralJoin Pivot Unpivot Tail Sample ResolvedInlineTable LocalRelation".split())
# Spark's groups of built-in functions that only compute from their arguments, and
# the classes outside them that do so too. Left out are the groups with functions that call JVM
# methods, read the session, its files or its user, raise errors on purpose, or parse XML.
SAFE_GROUPS = frozenset(
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs datetime_funcs "
    "generator_funcs hash_funcs json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs "
    "struct_funcs window_funcs".split())
SAFE_CLASSES = frozenset({"TypeOf"})
# Expressions whose target is only known after analysis, and words that read the
# session without being written as a call.
LATE_EXPRESSIONS = frozenset({"ExpressionWithUnresolvedIdentifier", "UnresolvedFunctionName"})
SESSION_WORDS = frozenset({"current_user", "session_user", "current_catalog", "current_database", "current_schema"})


@dataclass
class Reading:
    """What the parser sees in a text: kinds of plan nodes, names of relations that are not the
    query's own WITH names there, function names, other things that are not allowed, and whether
    the outer query has a LIMIT."""

    kinds: set[str] = field(default_factory=set)
    relations: set[str] = field(default_factory=set)
    functions: set[str] = field(default_factory=set)
    refused: set[str] = field(default_factory=set)
    limited: bool = False


def _each(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def read_query(spark: SparkSession, text: str) -> Reading:
    """Parse ``text`` and walk the plan. Nothing is analyzed or run."""
    found = Reading()
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    subquery = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.PlanExpression",
                                                  True, plan.getClass().getClassLoader())
    # (plan node or expression, is it a plan node, WITH names visible there); a work list, since
    # generated texts can be nested deeply.
    work = [(plan, True, frozenset())]
    while work:
        x, is_plan, visible = work.pop()
        kind = x.getClass().getSimpleName()
        if not is_plan:
            if subquery.isInstance(x):
                work.append((x.plan(), True, visible))
            if kind == "UnresolvedFunction":
                found.functions.add(".".join(_each(x.nameParts())).lower())
            elif kind in LATE_EXPRESSIONS:
                found.refused.add(kind)
            elif kind == "UnresolvedAttribute" and x.name().lower() in SESSION_WORDS:
                found.refused.add(x.name().lower())
            work += [(child, False, visible) for child in _each(x.children())]
            continue
        found.kinds.add(kind)
        if kind == "UnresolvedRelation":
            parts = list(_each(x.multipartIdentifier()))
            if len(parts) > 1 or parts[0].lower() not in visible:
                found.relations.add(".".join(parts).lower())
        if kind == "UnresolvedWith":
            recursive = x.allowRecursion()
            for pair in _each(x.cteRelations()):
                name = frozenset({pair.productElement(0).lower()})
                work.append((pair.productElement(1), True, visible | name if recursive else visible))
                visible |= name         # for the definitions after it and for the query
        work += [(e, False, visible) for e in _each(x.expressions())]
        work += [(child, True, visible) for child in _each(x.children())]
    top = plan
    while top.getClass().getSimpleName() in ("UnresolvedWith", "Offset"):
        top = top.children().head()
    found.limited = top.getClass().getSimpleName() in ("GlobalLimit", "LocalLimit")
    return found


def allowed_function(spark: SparkSession, name: str) -> bool:
    """Whether the session's registry has ``name`` as a built-in function of a safe group or class.
    Qualified names never are; names it does not have could be anything and are not allowed."""
    if "." in name:
        return False
    identifier = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name)
    info = spark._jsparkSession.sessionState().functionRegistry().lookupFunction(identifier)
    if info.isEmpty() or info.get().getSource() != "built-in":
        return False
    return info.get().getGroup() in SAFE_GROUPS or info.get().getClassName().rsplit(".", 1)[-1] in SAFE_CLASSES


def guarded_sql(spark: SparkSession, sql_text: str, limit: int = DEFAULT_ROW_LIMIT, tables=None, functions=()) -> DataFrame:
    """Run one read-only generated query against allowed tables.

    The text must pass the rule of ``audit_queries``, and Spark's parser must see nothing but
    query nodes (no command, insert or script) over ``tables`` (default: the temp views of the
    session; never a path) and built-in functions that only compute, or those named in
    ``functions``. Blocked text raises before analysis. Without a LIMIT of the outer query or an
    aggregate, ``limit`` rows are returned (applied to the DataFrame, not glued to the text).
    """
    verdict = audit_queries(spark.createDataFrame([(sql_text,)], "sql_text string")).first()
    if verdict["blocked"]:
        raise PermissionError(f"blocked query ({verdict['blocked_words'] or 'not a SELECT'})")
    text = verdict["clean_sql"].rstrip().rstrip(";")
    found = read_query(spark, text)
    if other := found.kinds - READ_NODES:
        raise PermissionError(f"blocked query (plan nodes {sorted(other)})")
    if found.refused:
        raise PermissionError(f"blocked query ({sorted(found.refused)})")
    if tables is None:
        tables = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    if unknown := found.relations - {t.lower() for t in tables}:
        raise PermissionError(f"blocked query (tables {sorted(unknown)} are not allowed)")
    more = {f.lower() for f in functions}
    if bad := sorted(f for f in found.functions - more if not allowed_function(spark, f)):
        raise PermissionError(f"blocked query (functions {bad} are not allowed)")
    result = spark.sql(text)
    return result.limit(limit) if verdict["needs_limit"] and not found.limited else result
