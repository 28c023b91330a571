"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are turned by one fixed random rotation and cut into blocks of few dimensions. If
two vectors are within squared distance d, then in some block they are within d times the
block's share of the dimensions. So each block is range-joined under its share, a little widened
for the rotation's rounding, and only pairs found by some block are compared in full, by the cosine
of the vectors as they are, not as rotated (the first such block counts the pair, so the union has
no repeats). A block's range join is a grid over its leading dimensions: a vector lives in one
cell and visits the cells within reach. Cells are cut into tiles, tile pairs are the groups, so a
hot label or cell is spread over many tasks.

Equal vectors under a label are joined as one with a count. Groups return, per vector, how many
it links with and one link into its part of the group: nothing quadratic leaves a task.

Defined results: null labels and vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length do not link; rows that repeat an id
are vectors of their own, linked by what they hold; the component of a row with a null id
is the least id that it is linked with, or null; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from listingflow.llm.components import components
from listingflow.llm.vectors import finite, spread_copies
from listingflow.session import stage

THRESHOLD = 0.98
BLOCK = 8               # dimensions of a block
TILE = 2048             # vectors on a side of a tile pair
SEED = 20240607
#: Rows of the table from which on grids get one more dimension, doubling each time.
GRID_ROWS = 20_000


@lru_cache(maxsize=8)
def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED + width).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def scaled(v: np.ndarray) -> np.ndarray:
    """The vector in doubles times a power of two that brings its largest component near 1: no
    component is rounded and no product overflows."""
    x = np.asarray(v, np.float64)
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def turned(x: np.ndarray) -> np.ndarray:
    """The unit vector of ``x``, rotated. One vector at a time, so that every task gets the same bits."""
    return (x / np.linalg.norm(x)) @ rotation(len(x))


def block_edges(width: int) -> list[int]:
    """Borders of the blocks: width 64 gives 0, 8, ..., 64."""
    count = -(-width // BLOCK)
    return [round(i * width / count) for i in range(count + 1)]


def _cells(turned: np.ndarray, reach: float, dims: int) -> list[tuple[int, bool]]:
    """Codes of the cells within reach of a point, one of them its own (True)."""
    wide = 6 * reach
    half = math.ceil((1 + reach) / wide) + 1        # coordinates of unit vectors are within 1
    while (2 * half) ** dims >= 1 << 62:
        dims -= 1
    out = [(0, True)]
    for x in turned[:dims]:
        own, low, high = (math.floor((x + d) / wide) for d in (0, -reach, reach))
        out = [(code * 2 * half + v + half, home and v == own) for code, home in out for v in range(low, high + 1)]
    return out


def near_links(vectors: DataFrame, *, threshold: float = THRESHOLD, tile: int = TILE, grid_dims: int) -> DataFrame:
    """``rep, links, root`` rows from distinct vectors ``rep, label, embedding, copies``: the
    copies that ``rep`` links with in one group, and a vector of its component there."""
    limit = (2 - 2 * threshold) * (1 + 1e-9) + 1e-12
    schema = "label int, width int, block int, cell long, home boolean, rep long, copies long, vector binary"

    kind = np.float32 if vectors.schema["embedding"].dataType.elementType == FloatType() else np.float64

    def place(batches):
        for batch in batches:
            out = {n: [] for n in ("label", "width", "block", "cell", "home", "rep", "copies", "vector")}
            reps, labels, vecs, copies = (batch.column(n).to_pylist() for n in ("rep", "label", "embedding", "copies"))
            for rep, label, vec, n in zip(reps, labels, vecs, copies, strict=True):
                x = scaled(vec)
                spun, edges, packed = turned(x), block_edges(len(x)), np.asarray(vec, kind).tobytes()
                for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
                    reach = math.sqrt(limit * (j - i) / len(x))
                    for cell, home in _cells(spun[i:j], reach, min(grid_dims, j - i)):
                        for name, value in zip(out, (label, len(x), b, cell, home, rep, n, packed), strict=True):
                            out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("label", pa.int32()), ("width", pa.int32()), ("block", pa.int32()), ("cell", pa.int64()),
                ("home", pa.bool_()), ("rep", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary())]))

    placed = stage(vectors.select("rep", "label", "embedding", "copies").mapInArrow(place, schema), "near-cells")
    cell = ["label", "width", "block", "cell"]
    tiles = placed.groupBy(*cell).agg(
        F.ceil(F.count(F.when(F.col("home"), 1)) / tile).cast("int").alias("own_tiles"),
        F.ceil(F.count("*") / tile).cast("int").alias("all_tiles")).filter("own_tiles > 0")
    sized = placed.join(tiles, cell)
    salt = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    own = spread_copies(sized.filter("home").withColumn("i", salt("own_tiles")), "j", F.col("all_tiles"))
    seen = spread_copies(sized.withColumn("j", salt("all_tiles")), "i", F.col("own_tiles"))
    pick = [*cell, "i", "j", "rep", "copies", "vector"]
    key = [*cell, "i", "j"]

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["rep", "links", "root"]
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        width, block = left.column("width")[0].as_py(), left.column("block")[0].as_py()
        whole = [np.stack([scaled(np.frombuffer(v, kind)) for v in t.column("vector").to_pylist()]) for t in (left, right)]
        a, b = (np.stack([turned(x) for x in w]) for w in whole)
        norms = [np.linalg.norm(w, axis=1) for w in whole]
        ia, ib = left.column("rep").to_numpy(), right.column("rep").to_numpy()
        copies, edges = right.column("copies").to_numpy(), block_edges(width)
        budget = [limit * (j - i) / width for i, j in zip(edges, edges[1:], strict=False)]
        i, j = edges[block], edges[block + 1]
        xa, xb = a[:, i:j], b[:, i:j]
        links, parent = np.zeros(len(ia), np.int64), {}
        square = (xb * xb).sum(axis=1)

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for at in range(0, len(ia), 256):
            part = xa[at:at + 256]
            rough = (part * part).sum(axis=1)[:, None] + square - 2 * (part @ xb.T)
            p, q = np.nonzero(rough <= budget[block] + 1e-9)
            for k in range(0, len(p), 1 << 16):
                u, v = p[k:k + (1 << 16)] + at, q[k:k + (1 << 16)]
                other = ia[u] != ib[v]
                u, v = u[other], v[other]
                for e in range(block + 1):          # in this block and in none before it
                    gap = a[u, edges[e]:edges[e + 1]] - b[v, edges[e]:edges[e + 1]]
                    fits = (gap * gap).sum(axis=1) <= budget[e]
                    fits = fits if e == block else ~fits
                    u, v = u[fits], v[fits]
                fine = (whole[0][u] * whole[1][v]).sum(axis=1) / (norms[0][u] * norms[1][v]) >= threshold
                u, v = u[fine], v[fine]
                np.add.at(links, u, copies[v])
                for x, y in zip(ia[u].tolist(), ib[v].tolist(), strict=True):
                    x, y = root(x), root(y)
                    parent[max(x, y)] = min(x, y)
        some = np.flatnonzero(links)
        roots = [root(int(x)) for x in ia[some]]
        return pa.table([pa.array(ia[some]), pa.array(links[some]), pa.array(roots, pa.int64())], names=names)

    # New names for the right side: both sides come from one table.
    return (own.select(*pick).groupBy(*key).cogroup(seen.select(*pick).toDF(*pick).groupBy(*key))
            .applyInArrow(match, "rep long, links long, root long"))


def near_duplicates(vectors: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per input row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
                          F.col(vector_col).alias("embedding"))
    nonzero = F.exists("embedding", lambda x: x != 0)
    fine = F.col("label").isNotNull() & finite("embedding") & F.coalesce(nonzero, F.lit(False))
    valid = rows.filter(fine)
    distinct = stage(valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                     .withColumn("rep", F.monotonically_increasing_id()), "near-distinct")
    dims = max(0, min(BLOCK, math.ceil(math.log2(max(1, distinct.count()) / GRID_ROWS)) + 2))
    found = stage(near_links(distinct, threshold=threshold, tile=tile, grid_dims=dims), "near-links")
    per_rep = found.groupBy("rep").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    reps = stage(distinct.join(per_rep, "rep", "left").join(grouped, distinct["rep"] == grouped["id"], "left")
                 .select("label", "embedding", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("part")), "near-reps")
    named = reps.groupBy("part").agg(F.min("least").alias("component_id"))
    linked = valid.join(reps.join(named, "part"), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
