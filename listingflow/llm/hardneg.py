"""Hard negatives by a secondary-sort shuffle.

Scored pairs carry a packed key (anchor, descending score, positives first, id). One shuffle by
anchor sorts them, and an iterator streams over each anchor's pairs: its first rows of the same
label are the positives, each of which opens a window below its own score; rows of other labels
go to every open window that they fit, until it has enough. An anchor's pairs are never held
together, only its few open windows are.

Pairs come from shards of the table: a shard's rows stay in memory, anchors stream past them in
blocks. Of the same label only the shard's first rows are sent on, since no other can be among the
first of all. Then the anchors' windows are known, and of other labels each shard sends the first
rows of every window. Nothing that could be returned is left out.

Defined results: rows with a null label or vector, or with a null or non-finite component, take
no part; an empty vector scores 0, and so do components that the shorter vector lacks; rows that
repeat an id are rows of their own, each an anchor if the id is; rows with a null id are never
anchors and come last among equal scores; an empty table gives an empty table. Components are
taken as 64-bit integers.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.vectors import all_finite, blocks_of, matrix
from listingflow.session import stage

SHARD_ROWS = 4096
#: Anchors that are scored against a shard at once.
BLOCK_ROWS = 256
NO_ID = (1 << 63) - 1       # stands for a null id inside the tasks: last among equal scores
FOUND = pa.schema([("anchor", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "anchor long, row long, id long, score long"


class Shard:
    """Rows of one shard by label, and the scores of anchors against them."""

    def __init__(self, rows: pa.Table, width: int):
        order = np.argsort(rows.column("label").to_numpy(), kind="stable")
        self.labels = rows.column("label").to_numpy()[order]
        self.rows, self.ids = rows.column("row").to_numpy()[order], rows.column("id").to_numpy()[order]
        self.values = matrix(rows.column("v"), width)[order]
        self.exact = self.values.astype(np.float64)
        self.largest = float(np.abs(self.exact).max(initial=0))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Integer inner products; in doubles only where those are exact."""
        bound = self.largest * float(np.abs(anchors.astype(np.float64)).max(initial=0)) * max(1, anchors.shape[1])
        if bound < 2 ** 53:
            return (anchors.astype(np.float64) @ self.exact.T).astype(np.int64)
        return anchors @ self.values.T

    def own_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))

    def first(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """The k first of the places ``at``: higher scores, then smaller ids."""
        if len(at) > k:
            least = np.partition(scores[at], len(at) - k)[len(at) - k]
            at = at[scores[at] >= least]
        return at[np.lexsort((self.rows[at], self.ids[at], -scores[at]))][:k]


def _positives(shard: Shard, anchor: int, label: int, windows, scores: np.ndarray, k: int) -> np.ndarray:
    own = np.arange(len(shard.rows))[shard.own_label(label)]
    return shard.first(own[shard.rows[own] != anchor], scores, k)


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score of a negative for a positive's score, both in hundredths of it."""
    return -(-low * score // 100), high * score // 100


def _negatives(shard: Shard, anchor: int, label: int, windows, scores: np.ndarray, k: int, low: int, high: int) -> np.ndarray:
    spans = [b for p in windows if (b := bounds(p, low, high))[0] <= b[1]]
    if not spans:
        return np.zeros(0, np.int64)
    own = shard.own_label(label)
    fits = (scores >= min(a for a, _ in spans)) & (scores <= max(b for _, b in spans))
    fits[own] = False
    at = np.flatnonzero(fits)
    picked = [shard.first(at[(scores[at] >= a) & (scores[at] <= b)], scores, k) for a, b in spans]
    return np.unique(np.concatenate(picked))


def _past_shards(batches, width, pick):
    """Rows sorted by (shard, kind): a shard's own rows (kind 0) come first and stay, anchors
    (kind 1) stream past them; ``pick`` chooses places of the shard for one anchor."""
    current, held, shard = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        shards, kinds = table.column("shard").to_numpy(), table.column("kind").to_numpy()
        edges = np.flatnonzero(np.append(True, (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1]))).tolist()
        for i, j in zip(edges, [*edges[1:], len(shards)], strict=True):
            part = table.slice(i, j - i)
            if shards[i] != current:
                current, held, shard = shards[i], [], None
            if kinds[i] == 0:
                held.append(part)
                continue
            if shard is None and held:
                shard, held = Shard(pa.concat_tables(held).combine_chunks(), width), []
            if shard is None:
                continue
            for k in range(0, part.num_rows, BLOCK_ROWS):
                block = part.slice(k, BLOCK_ROWS)
                scored = shard.scores(matrix(block.column("v"), width))
                out = {n: [] for n in FOUND.names}
                for n, (anchor, label, windows) in enumerate(zip(*(block.column(c).to_pylist() for c in ("row", "label", "windows")), strict=True)):
                    at = pick(shard, anchor, label, windows or (), scored[n])
                    out["anchor"].append(np.full(len(at), anchor))
                    for name, values in (("row", shard.rows), ("id", shard.ids), ("score", scored[n])):
                        out[name].append(values[at])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out.values()], schema=FOUND)


def _mine(batches, k, positives, low, high):
    """The stream over sorted keys: windows open at positives, negatives go to the open ones."""
    schema = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])
    current, seen, windows = None, 0, []
    for batch in batches:
        out = []
        for anchor, anchor_id, kind, ident, score in zip(*(batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "kind", "id", "score")), strict=True):
            if anchor != current:
                current, seen, windows = anchor, 0, []
            ident = None if ident == NO_ID else ident
            if kind == 0:
                seen += 1
                if seen <= positives:
                    windows.append([ident, score, *bounds(score, low, high), 0])
                continue
            for window in windows:
                if window[2] <= score <= window[3] and window[4] < k:
                    window[4] += 1
                    out.append((anchor_id, window[0], window[4], ident, window[1], score))
            windows = [w for w in windows if w[2] <= score and w[4] < k]
        columns = list(zip(*out, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def hard_negatives(vectors: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, relabel: int = 7, labels: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``; their positives are their first
    ``positives`` other rows of the same label. For each, the first ``negatives`` rows of another
    label with a score from ``low`` to ``high`` hundredths of the positive's. Labels of ids
    divisible by ``relabel`` first move on by one, modulo ``labels``."""
    ident, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    moved = F.when(ident % relabel == 0, (label + 1) % labels).otherwise(label)
    rows = stage(vectors.filter(label.isNotNull() & all_finite(vector_col))
                 .select(F.monotonically_increasing_id().alias("row"), F.coalesce(ident, F.lit(NO_ID)).alias("id"),
                         moved.alias("label"), whole.alias("v"), F.coalesce(ident % every == 0, F.lit(False)).alias("asks")),
                 "negative-rows")
    count, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    shards = blocks_of(count, shard_rows)
    none = F.lit(None).cast("array<long>")
    data = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"),
                       "row", "id", "label", "v", none.alias("windows"))
    anchors = rows.filter("asks").select("row", "id", "label", "v")

    def met(asked: DataFrame, pick) -> DataFrame:
        """What ``pick`` finds for each anchor in each shard."""
        copies = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                              "row", "id", "label", "v", "windows")
        return (data.unionByName(copies).repartition("shard").sortWithinPartitions("shard", "kind")
                .mapInArrow(partial(_past_shards, width=width or 0, pick=pick), FOUND_DDL))

    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    near = met(anchors.withColumn("windows", none), partial(_positives, k=positives))
    near = stage(near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives).drop("place"), "positives")
    opened = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("windows"))
    far = met(anchors.join(opened, "row"), partial(_negatives, k=negatives, low=low, high=high))
    pairs = near.withColumn("kind", F.lit(0)).unionByName(far.withColumn("kind", F.lit(1)))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    keyed = pairs.join(named, "anchor").withColumn("key", F.struct("anchor", (-F.col("score")).alias("down"), "kind", "id", "row"))
    mined = (keyed.repartition("anchor").sortWithinPartitions("key").select("anchor", "anchor_id", "kind", "id", "score")
             .mapInArrow(partial(_mine, k=negatives, positives=positives, low=low, high=high),
                         "anchor_id long, positive_id long, rank long, negative_id long, positive_score long, negative_score long"))
    return mined.withColumn("rank", F.col("rank").cast("int"))


ORACLE = """
WITH v AS (SELECT ROW_NUMBER() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
p AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.row, b.vec_id,
        COALESCE(LIST_SUM(LIST_TRANSFORM(LIST_ZIP(a.v, b.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
      FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) AS place
                       FROM p WHERE same) WHERE place <= 5),
r AS (SELECT pos.anchor_id, pos.vec_id AS positive_id, p.vec_id AS negative_id, pos.score AS positive_score, p.score AS negative_score,
        ROW_NUMBER() OVER (PARTITION BY pos.anchor, pos.row ORDER BY p.score DESC, p.vec_id NULLS LAST, p.row)::INT AS rank
      FROM pos JOIN p ON p.anchor = pos.anchor AND NOT p.same AND 50 * pos.score <= 100 * p.score AND 100 * p.score <= 95 * pos.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""
