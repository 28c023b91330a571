"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both tokenizers spell the same bytes, so tokens of either end at byte offsets of one text. A place
where tokens of both end is a shared cut. An interval between shared cuts is divided: from its
middle outwards the first end of one side that the other side has too (found by bisection) is its
new cut, and both halves go on; an interval without such an end inside is a group. All intervals
of many texts are divided together, level by level. Inside a group the tokens overlap in a chain,
each overlap is one link.

The first pass writes each text's counts, digest and distinct linked pairs of ids. Pairs are then
counted over all texts, per id of the second side the highest count is found, and the last pass
sums them up per text. The pair table is sent to every task only while it has ``MOST_PAIRS`` rows
at most, else the pairs are joined with it; both ways give the same results.

Defined results: texts that are null or empty, and texts that a side does not spell byte by byte
(as with characters that its alphabet uses itself), have no tokens, zeros and the digest ''; rows
that repeat an id are rows of their own and count each; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import arrow_rows
from listingflow.llm.symbols import turns
from listingflow.session import stage

MOST_PAIRS = 4_000_000      # of the table that is sent to every task (17 bytes a row)
STEPS = 16                  # ends that intervals try together before long ones are searched alone


class Sides:
    """Both tokenizers and the bytes of their tokens. A: a byte-level BPE vocabulary file, B: a
    piece model with byte fallback. ``pattern`` is what A cuts texts by before merging."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {_spelt(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_a = dict(zip(ranks.values(), ranks, strict=True))
        self.bytes_a = [bytes_a.get(i, b"") for i in range(1 + max(bytes_a))]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.long_a, self.long_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.from_a, self.from_b = (np.cumsum(x) - x for x in (self.long_a, self.long_b))
        self.all_a, self.all_b = (np.frombuffer(b"".join(x), np.uint8) for x in (self.bytes_a, self.bytes_b))
        #: Every id followed by each of the three signs that can stand behind it.
        self.signed = [f"{i}{sign}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for sign in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spelt_b(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_b.__getitem__, ids))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B over all texts, and each text's first place in both (one more at the
        end). A text that a side does not spell byte by byte has no tokens."""
        spelt = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        a = [self.a.encode_to_numpy(" " + t) if t else np.zeros(0, np.uint32) for t in texts]
        b = [np.frombuffer(array("i", self.b.encode(t)), np.int32) if t else np.zeros(0, np.int32) for t in texts]
        for side, table, start in ((a, self.long_a, self.from_a), (b, self.long_b, self.from_b)):
            ids = np.concatenate(side) if side else np.zeros(0, np.int64)
            sizes = table[ids]
            ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(x) for x in side])).astype(np.int64)]
            at = np.repeat(start[ids] - (np.cumsum(sizes) - sizes), sizes)
            at += np.arange(len(at))
            whole = self.all_a[at] if side is a else self.all_b[at]
            for i, data in enumerate(spelt):
                if data and (ends[i + 1] - ends[i] != len(data) or whole[ends[i]:ends[i + 1]].tobytes() != data):
                    spelt[i] = b""
        a, b = ([x if data else x[:0] for x, data in zip(side, spelt, strict=True)] for side in (a, b))
        first = [np.append(0, np.cumsum([len(x) for x in side])).astype(np.int64) for side in (a, b)]
        return *(np.concatenate(side).astype(np.int64) if side else np.zeros(0, np.int64) for side in (a, b)), *first


def _spelt(token: str) -> bytes:
    return bytes(map(_byte_letters().__getitem__, token))


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the letter of that number if it is visible, the
    others, in order, as letters from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str, pattern: str) -> Sides:
    """One pair per worker process; each worker reads the vocabularies itself."""
    return Sides(path_a, path_b, pattern)


def _near_middle(ends_a: np.ndarray, ends_b: np.ndarray, low: int, high: int, tried: int) -> tuple[int, int]:
    """For one interval: the place in A and B of the shared end nearest to the middle of A's places
    from ``low`` to below ``high``, after ``tried`` failures; (-1, -1) if there is none."""
    middle, part = low + (high - low) // 2, 64
    while tried < high - low:
        t = np.arange(tried, min(high - low, tried + part))
        at = middle + np.where(t % 2 == 1, -(t + 1) // 2, t // 2)
        other = np.searchsorted(ends_b, ends_a[at])
        hit = np.flatnonzero(ends_b[other] == ends_a[at])
        if len(hit):
            return int(at[hit[0]]), int(other[hit[0]])
        tried, part = tried + part, part * 2
    return -1, -1


def divide(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of tokens between shared cuts, in order: the place after each group's last token, in
    A and in B. ``ends_*``: token ends over all texts joined, rising; ``first_*``: each text's first
    token, one more at the end."""
    some = np.flatnonzero(np.diff(first_a) > 0)
    a0, a1, b0, b1 = first_a[some], first_a[some + 1], first_b[some], first_b[some + 1]
    tried, done = np.zeros(len(some), np.int64), []
    while len(a0):
        single = (a1 - a0 == 1) | (b1 - b0 == 1) | (tried >= a1 - a0 - 1)
        done.append((a1[single], b1[single]))
        a0, a1, b0, b1, tried = (x[~single] for x in (a0, a1, b0, b1, tried))
        # A's candidates are the ends of its tokens but the last; the middle one first, then to both sides.
        at = a0 + (a1 - a0 - 1) // 2 + np.where(tried % 2 == 1, -(tried + 1) // 2, tried // 2)
        other = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[other] == ends_a[at]
        for i in np.flatnonzero(~hit & (tried >= STEPS)).tolist():
            at[i], other[i] = _near_middle(ends_a, ends_b, int(a0[i]), int(a1[i]) - 1, int(tried[i]))
            hit[i] = at[i] >= 0
            tried[i] = tried[i] if hit[i] else a1[i]        # without any: a group
        # Both halves stand where their interval stood: sorted ends are found faster.
        tried = np.where(hit, 0, tried + 1)
        halves = 1 + hit
        right = (np.cumsum(halves) - 1)[hit]
        a0, a1, b0, b1, tried = (np.repeat(x, halves) for x in (a0, a1, b0, b1, tried))
        a0[right] = a1[right - 1] = at[hit] + 1
        b0[right] = b1[right - 1] = other[hit] + 1
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.sort(np.concatenate(x)) for x in zip(*done, strict=True))


def links(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping tokens as places in A and B, group by group. A group's only token of a side
    overlaps all of the other side's. In a larger group every end but the last cuts: the stretch
    before it lies in one token of each side, and each stretch is a link."""
    from_a, from_b = (np.append(0, x[:-1])[:len(x)] for x in (last_a, last_b))
    n_a, n_b = last_a - from_a, last_b - from_b
    one_a, one_b = n_a == 1, (n_b == 1) & (n_a > 1)
    large = ~one_a & ~one_b
    spans = lambda start, size: np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out = [(np.repeat(from_a[one_a], n_b[one_a]), spans(from_b[one_a], n_b[one_a])),
           (spans(from_a[one_b], n_a[one_b]), np.repeat(from_b[one_b], n_a[one_b]))]
    i, j = spans(from_a[large], n_a[large]), spans(from_b[large], n_b[large] - 1)
    out += [(i, np.searchsorted(ends_b, ends_a[i])), (np.searchsorted(ends_a, ends_b[j]), j)]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def align(s: Sides, texts: list[str | None]) -> dict[str, list]:
    """Per text: counts, the groups as text, distinct linked id pairs (a * size of B + b) and how
    often each is linked."""
    a, b, *first = s.encode(texts)
    ends_a, ends_b = np.cumsum(s.long_a[a]), np.cumsum(s.long_b[b])
    last_a, last_b = divide(ends_a, ends_b, *first)
    groups = np.searchsorted(last_a, first[0], side="right")
    # A's tokens of a group, then B's, each with the sign that stands behind it.
    from_a, from_b = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (last_a, last_b))
    sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    sign_a[last_a - 1], sign_b[last_b - 1] = 1, 2
    codes = np.zeros(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + np.repeat(from_b, last_a - from_a)] = 3 * a + sign_a
    codes[np.arange(len(b)) + np.repeat(last_a, last_b - from_b)] = 3 * b + sign_b
    codes, edge = codes.tolist(), (first[0] + first[1]).tolist()
    at_a, at_b = links(ends_a, ends_b, last_a, last_b)
    text = np.searchsorted(first[0], at_a, side="right") - 1
    pairs = len(s.bytes_b) * len(s.bytes_a)
    keys = np.sort(text * pairs + a[at_a] * len(s.bytes_b) + b[at_b])
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(head, len(keys)))
    keys = keys[head]
    own = np.searchsorted(keys, np.arange(len(texts) + 1) * pairs)
    found = np.bincount(text, minlength=len(texts))
    ids, times, own = (keys % pairs), times, own.tolist()
    return {"n_a": np.diff(first[0]).tolist(), "n_b": np.diff(first[1]).tolist(), "n_groups": np.diff(groups).tolist(),
            "n_links": found.tolist(),
            "groups": ["".join(map(s.signed.__getitem__, codes[i:j]))[:-1] for i, j in zip(edge, edge[1:], strict=False)],
            "pairs": [ids[i:j] for i, j in zip(own, own[1:], strict=False)],
            "times": [times[i:j] for i, j in zip(own, own[1:], strict=False)]}


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
            with_groups: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256``, ``pairs`` and
    ``times``; with ``with_groups`` also ``groups``, the aligned ids as text."""
    counts = ("n_a", "n_b", "n_groups", "n_links")
    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
              + ", groups string" * with_groups)

    def run(rows):
        s = sides(path_a, path_b, pattern)
        out = {n: [] for n in (*counts, "groups_sha256", "pairs", "times", "groups")}
        for i, j in turns(rows["text"]):
            got = align(s, rows["text"][i:j])
            for n in (*counts, "pairs", "times"):
                out[n] += got[n]
            out["groups_sha256"] += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got["groups"]]
            if with_groups:
                out["groups"] += got["groups"]
        return {"doc_id": rows["doc_id"], **out}

    return arrow_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def _add_up(batches):
    """Partial sums per pair."""
    schema = pa.schema([("pair", pa.int64()), ("count", pa.int64())])
    for batch in batches:
        pairs, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (0, 1))
        ids, which = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(ids), np.int64)
        np.add.at(total, which, times)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total)], schema=schema)


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """``pair, count, best``: how often ids are linked in all texts, and whether no other id of A is
    linked with that id of B more often."""
    counts = stage(found.select("pairs", "times").mapInArrow(_add_up, "pair long, count long")
                   .groupBy("pair").agg(F.sum("count").alias("count")), "pair-counts")
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("count").alias("most"))
    return (counts.join(most, F.col("pair") % size_b == F.col("b"))
            .select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def align_documents(docs: DataFrame, path_a: str, path_b: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                    most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    spark = docs.sparkSession
    rows = stage(aligned(docs, path_a, path_b, pattern, id_col=id_col, text_col=text_col)
                 .withColumn("row", F.monotonically_increasing_id()), "aligned")
    table = stage(pair_counts(rows, len(sides(path_a, path_b, pattern).bytes_b)), "pair-table")
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if table.count() > most_pairs:
        each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
        sums = (each.join(table, F.col("pairs") == F.col("pair")).groupBy("row")
                .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                     F.sum(F.col("times") * F.col("count")).alias("count_sum")))
        return (rows.select("row", *plain).join(sums, "row", "left")
                .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")}).select(*order))
    known = table.toArrow()
    ids = known.column("pair").to_numpy()
    by = np.argsort(ids)
    sent = spark.sparkContext.broadcast((ids[by], known.column("count").to_numpy()[by],
                                         known.column("best").to_numpy(zero_copy_only=False).astype(bool)[by]))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"

    def look_up(batches):
        ids, counts, best = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(ids, pairs)
            ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
            sums = [np.diff(np.append(0, np.append(0, np.cumsum(x))[ends])) for x in (times * best[at], times * counts[at])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in plain], *[pa.array(x, pa.int64()) for x in sums]],
                                             names=[*plain, "n_best", "count_sum"])

    return rows.select(*plain, "pairs", "times").mapInArrow(look_up, schema).select(*order)
