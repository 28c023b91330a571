"""Suffix-array deduplication: bytes covered by a long string that starts anywhere else too.

Candidate segments come grouped by anchor (``anchors``). For each batch of groups a suffix array
and its Burrows-Wheeler transform are built, and common prefixes are found by increasing value:
an interval of suffixes that share a word is extended to the left by each byte before it, breadth
first, and the first time a border of a new interval is met gives the common prefix there. The
search stops at the minimum length: borders still open then have at least that much in common,
and the suffixes between two closed borders are the places of one repeated string.

Defined results: null text is empty; matches lie inside a document, never across; copies of a
whole document count as other places; strings are bytes, so a match may begin inside a character;
repeated ids are separate rows; extra columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.anchors import Windows, repeated_windows
from listingflow.llm.common import settle
from listingflow.llm.symbols import BYTE_VALUES, joined_bytes

LENGTH = 400
PACKED = 7              # symbols of nine bits in one integer


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` symbols at least, and each place's packed first
    symbols. Starts from packed symbols and doubles; only ties are sorted again."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(PACKED, np.int64)])
    packed = np.zeros(n, np.int64)
    for i in range(PACKED):
        packed = (packed << 9) | padded[i:i + n]
    order = np.argsort(packed, kind="stable")
    sorted_keys = packed[order]
    head = np.ones(n, bool)
    head[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    have = PACKED
    while have < depth:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        places = order[slots]
        nxt = places + have
        key = rank[places] * (n + 1) + np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[slots] = places[by]
        key = key[by]
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        head[slots] |= new
        fresh = np.maximum.accumulate(np.where(new, slots, 0))
        rank[order[slots]] = fresh
        have *= 2
    return order, packed


def long_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``text`` (0 ends a segment) and, for each suffix in that order, whether it
    shares its first ``least`` symbols with the one before; symbol 0 never counts as shared."""
    n = len(text)
    order, packed = suffix_order(text, least)
    before = text[order - 1]            # the Burrows-Wheeler transform, as one ring
    by_symbol = np.argsort(before, kind="stable")
    forward = np.empty(n, np.int64)     # where the suffix one symbol longer stands
    forward[by_symbol] = np.arange(n)
    # Of each place, the nearest places with the same symbol before.
    same = before[by_symbol]
    previous, following = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    equal = same[1:] == same[:-1]
    previous[by_symbol[1:][equal]] = by_symbol[:-1][equal]
    following[by_symbol[:-1][equal]] = by_symbol[1:][equal]
    # Values below PACKED are read off the packed symbols.
    known = np.full(n + 1, -1, np.int16)
    known[0] = known[n] = 0
    keys = packed[order]
    differ = keys[1:] ^ keys[:-1]
    at = np.flatnonzero(differ) + 1
    bits = np.frexp(differ[at - 1].astype(np.float64))[1]      # under 2 ** 63: the highest set bit
    exact = (np.int64(1) << np.minimum(bits - 1, 62)) > differ[at - 1]
    bits = bits - exact
    known[at] = np.minimum((9 * PACKED - bits) // 9, PACKED - 1)
    # Intervals of words of PACKED symbols whose right border has the value PACKED - 1.
    borders = np.concatenate([[0], at, [n]])
    ends = borders[1:][known[borders[1:]] == PACKED - 1]
    low = borders[np.searchsorted(borders, ends) - 1]
    high, value = ends, PACKED
    while value < least and len(low):
        size = high - low
        which = np.repeat(np.arange(len(low)), size)
        places = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        real = before[places] != 0
        first = real & (previous[places] < low[which])
        last = real & (following[places] >= high[which])
        lows, whose = forward[places[first]], which[first]
        highs, whose_last = forward[places[last]] + 1, which[last]
        # Within an interval, symbols stand in the same order on both sides.
        lows = lows[np.argsort(whose * (n + 1) + lows, kind="stable")]
        highs = highs[np.argsort(whose_last * (n + 1) + highs, kind="stable")]
        new = known[highs] < 0
        low, high = lows[new], highs[new]
        known[high] = value
        value += 1
    shared = known[:n] < 0
    return order, shared


def solve(segments: list[bytes], windows: np.ndarray, weights: np.ndarray, length: int) -> list[list[int]]:
    """For each segment, [from, to) pairs of window starts whose ``length`` bytes occur again."""
    sizes = np.array([len(s) for s in segments])
    text = np.zeros(int(sizes.sum()) + len(segments), np.uint16)
    begins = np.cumsum(sizes + 1) - sizes - 1
    joined = np.frombuffer(b"".join(segments), np.uint8)
    inside = np.ones(len(text), bool)
    inside[begins + sizes] = False
    text[inside] = joined.astype(np.uint16) + 1
    order, shared = long_prefixes(text, length)
    whose = np.repeat(np.arange(len(segments)), sizes + 1)
    is_window = np.arange(len(text)) - begins[whose] < windows[whose]
    # Weight of each class of suffixes that share the first ``length`` symbols.
    counted = is_window[order]
    classes = np.cumsum(~shared) - 1
    total = np.bincount(classes, weights=np.where(counted, weights[whose[order]], 0))
    repeated = np.zeros(len(text) + 1, bool)
    repeated[order] = counted & (total[classes] > 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated])))       # ends at separators
    out: list[list[int]] = [[] for _ in segments]
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        s = int(whose[a])
        out[s] += [a - int(begins[s]), b - int(begins[s])]
    return out


def _symbols(texts):
    data, starts = joined_bytes(texts)
    return BYTE_VALUES[data], starts, data


BYTES = Windows(LENGTH, (200, 360, LENGTH), _symbols, solve, np.uint8)


def covered(ranges: list[list[int]], length: int, size: int) -> np.ndarray:
    """Marks of the symbols covered by the windows of the [from, to) pairs."""
    edge = np.zeros(size + 1, np.int64)
    for part in ranges:
        pairs = np.array(part, np.int64)
        np.add.at(edge, pairs[::2], 1)
        np.add.at(edge, pairs[1::2] + length - 1, -1)
    return np.cumsum(edge)[:size] > 0


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` (null: the least long), ``k1, k2`` (hashes of the whole text) and ``text`` (null: empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
                       F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text"))


def _cut(length: int, with_text: bool):
    def run(batches):
        for batch in batches:
            out = {n: [] for n in ("k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept")}
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for k1, k2, text, ranges in zip(c["k1"], c["k2"], c["text"], c["ranges"], strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                gone = covered(ranges, length, len(data))
                kept = data[~gone].tobytes()
                out["k1"].append(k1)
                out["k2"].append(k2)
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                # Characters of which a byte was removed go whole.
                out["kept"].append(kept.decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("kept_sha256", pa.string()), ("kept", pa.string())]))

    return run


def _changes(texts: DataFrame, with_text: bool) -> DataFrame:
    """``k1, k2`` of the texts that lose bytes: what is left of them, or ``all`` for texts that
    occur as a whole again."""
    held, ranges = repeated_windows(texts, BYTES)
    per_text = ranges.groupBy("k1", "k2").agg(F.collect_list("ranges").alias("ranges"))
    cut = (held.filter("copies = 1").select("k1", "k2", "text").join(per_text, ["k1", "k2"]).mapInArrow(
        _cut(LENGTH, with_text), "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept string"))
    copies = texts.groupBy("k1", "k2").agg(F.count("*").alias("copies")).filter("copies > 1").select("k1", "k2")
    return settle(cut.withColumn("all", F.lit(False)).unionByName(copies.withColumn("all", F.lit(True)),
                                                                  allowMissingColumns=True), "cuts")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    changes = _changes(keyed(docs, id_col, text_col), False)
    size = F.octet_length(F.col("text")).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), size.alias("n_bytes"),
        F.sha2("text", 256).alias("sha"))
    # A text that occurs as a whole again goes whole, if it has any window at all.
    whole = F.coalesce(F.col("all"), F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    return rows.join(changes, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns with repeats taken out of the text (null stays null). Of a
    character that loses a byte the others go too."""
    changes = _changes(keyed(docs, id_col, text_col), True)
    text = F.coalesce(F.col(text_col), F.lit(""))
    change = changes.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("all").alias("__all"),
                            F.col("kept").alias("__kept"))
    whole = F.coalesce(F.col("__all"), F.lit(False)) & (F.octet_length(text) >= LENGTH)
    kept = F.when(whole, F.lit("")).otherwise(F.coalesce("__kept", F.col(text_col)))
    return (docs.withColumns({"__a": F.xxhash64(text), "__b": F.xxhash64(F.lit(1), text)})
            .join(change, (F.col("__a") == F.col("__k1")) & (F.col("__b") == F.col("__k2")), "left")
            .withColumn(text_col, kept).select(*docs.columns))
