"""Exact top-k inner-product search by MaxScore.

Dimensions are the terms, the vectors of a shard their postings. For a query, each term has an
upper bound of what it can add in this shard; terms are ordered by bound. Once k scores are
known, the terms whose bounds together cannot reach the k-th of them are non-essential: only the
essential postings are traversed for all vectors, and the others are probed, largest bound first,
for vectors that can still compete. Shards' results are merged. Components can be negative, so a
term's contributions count from the least one in the shard.

A shard's rows stay in a task's memory and queries stream past them, so only the queries are
copied, once per shard. Integers are exact: sums are kept in doubles only while they stay below
2**53.

Defined results: vectors that are null, empty or hold null or non-finite components take no part;
rows that repeat an id are rows of their own, each a candidate, and a query if the id is; rows with
a null id are candidates only and come last among equal scores; missing components of shorter
vectors count 0; ties go to the smaller id; fewer candidates than k give fewer rows; an empty
table gives an empty table.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.vectors import blocks_of, finite, matrix
from listingflow.session import stage

SHARD_ROWS = 8192
NO_ID = (1 << 63) - 1       # stands for a null id inside the tasks: last among equal scores
#: Vectors of a shard that are scored in full first, to know k scores.
SEED_ROWS = 512
SCHEMA = "query long, query_id long, row long, vec_id long, score long"


def max_score(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own_row: int, query: np.ndarray, k: int,
              most: np.ndarray, least: np.ndarray) -> list[tuple[int, int]]:
    """The k best (score, place) of one shard but the query's own row, ties to the smaller id.
    ``vectors``: terms x vectors; ``most`` and ``least``: the largest and smallest component of each term."""
    ends = np.stack([query * most, query * least])
    low, bound = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
    order = np.argsort(-bound, kind="stable")
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)        # bounds of the terms from j on
    seed = slice(0, SEED_ROWS)
    own = rows != own_row
    scores = query @ vectors[:, seed]
    seen, known = np.flatnonzero(own[seed]), scores[own[seed]]
    others = np.arange(SEED_ROWS, len(ids))
    if len(others):
        base = low.sum()
        floor = (np.partition(known, -k)[-k] if len(known) >= k else -np.inf) - base
        # A vector must get floor or more above base; terms from ``essential`` on cannot give that alone.
        essential = int(np.searchsorted(-rest, -floor, side="left")) if floor > 0 else 0
        essential = max(1, min(essential, len(order)))
        terms = order[:essential]
        got = query[terms] @ vectors[terms, SEED_ROWS:] - low[terms].sum()
        at = essential
        while True:
            fits = got + rest[at] >= floor
            others, got = others[fits], got[fits]
            if at == len(order) or not len(others):
                break
            step = order[at:at + 8]
            got = got + query[step] @ vectors[np.ix_(step, others)] - low[step].sum()
            at += len(step)
        keep = own[others]
        seen, known = np.concatenate([seen, others[keep]]), np.concatenate([known, got[keep] + base])
    best = np.lexsort((rows[seen], ids[seen], -known))[:k]
    return [(int(known[i]), int(seen[i])) for i in best]


def _search(batches, width, k):
    """Rows sorted by (shard, kind): a shard's own rows (kind 0), then the queries (kind 1)."""
    schema = pa.schema([(n, pa.int64()) for n in ("query", "query_id", "row", "vec_id", "score")])
    current, held, shard = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        shards, kinds = table.column("shard").to_numpy(), table.column("kind").to_numpy()
        edges = np.flatnonzero(np.append(True, (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1]))).tolist()
        out = []
        for i, j in zip(edges, [*edges[1:], len(shards)], strict=True):
            part = table.slice(i, j - i)
            if shards[i] != current:
                current, held, shard = shards[i], [], None
            if kinds[i] == 0:
                held.append(part)
                continue
            if shard is None and held:
                own = pa.concat_tables(held).combine_chunks()
                shard, held = (own.column("row").to_numpy(), own.column("vec_id").to_numpy(), matrix(own.column("v"), width).T), []
            if shard is None:
                continue
            rows, ids, values = shard
            wanted = matrix(part.column("v"), width)
            most, least = values.max(axis=1), values.min(axis=1)
            size = float(np.abs(values).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * width
            kind = np.float64 if size < 2 ** 51 else np.int64
            if values.dtype != kind or not values.flags.c_contiguous:
                values = np.ascontiguousarray(values, kind)
                shard = rows, ids, values
            for query, ident, vector in zip(part.column("row").to_pylist(), part.column("vec_id").to_pylist(), wanted.astype(kind), strict=True):
                out += [(query, ident, int(rows[p]), int(ids[p]), s) for s, p in max_score(rows, ids, values, query, vector, k, most, least)]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, the ``k``
    other rows with the largest inner product of the components floor(scale * x)."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    ident = F.col(id_col).cast("long")
    rows = stage(vectors.filter(finite(vector_col))
                 .select(F.monotonically_increasing_id().alias("row"), F.coalesce(ident, F.lit(NO_ID)).alias("vec_id"),
                         F.coalesce(ident % every == 0, F.lit(False)).alias("asks"), whole.alias("v")), "topk-vectors")
    total, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    shards = blocks_of(total, shard_rows)
    data = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "row", "vec_id", "v")
    asked = rows.filter("asks").select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                                       "row", "vec_id", "v")
    found = (data.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "kind")
             .mapInArrow(partial(_search, width=width or 1, k=k), SCHEMA))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score"))


ORACLE = """
WITH q AS (SELECT ROW_NUMBER() OVER () AS row, vec_id, LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND LEN(embedding) > 0
             AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
p AS (SELECT a.row AS query, a.vec_id AS query_id, b.row, b.vec_id, LIST_SUM(LIST_TRANSFORM(LIST_ZIP(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM q a JOIN q b ON a.row <> b.row WHERE a.vec_id % 50 = 0),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST, row)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
