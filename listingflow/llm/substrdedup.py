"""Substring deduplication by prefix-partitioned suffix trees over words.

Candidate segments come grouped by anchor (``anchors``). Their suffixes are split by prefix, one
word at first and longer where a prefix has more suffixes than a subtree may hold, so that every
subtree fits in memory. A subtree is grown breadth first from its prefix: a node is a set of
suffixes that agree so far; edges are as long as all of them go on alike, and a node branches
where they differ. Branches with a single place end. Nodes that reach the minimum depth are
internal nodes of the suffix tree that deep: their places are the repeats, which joined over
neighbouring starts are the maximal ones.

Defined results: null and blank texts have no words and the digest of the empty text; repeats lie
inside a document; copies of a whole document count as other places; words are compared as they
are (by hash; a repeat is as many equal 32-bit hashes as the window has words); repeated ids are
separate rows; extra columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.anchors import Windows, repeated_windows
from listingflow.llm.common import settle, word_count
from listingflow.llm.suffixdedup import covered, keyed
from listingflow.llm.symbols import joined_bytes, word_hashes, word_places

LENGTH = 35
#: Suffixes of one subtree, unless they agree in all words.
SUBTREE = 1 << 17


def prefix_groups(text: np.ndarray, places: np.ndarray, weights: np.ndarray, length: int, most: int):
    """Groups (places, weights, depth) of suffixes by prefix, each of at most ``most`` places
    unless its prefix is ``length`` long. Prefixes with one place of weight 1 are left out."""
    todo = [(places, weights, 0)]
    while todo:
        places, weights, depth = todo.pop()
        if depth == length or depth and len(places) <= most:
            yield places, weights, depth
            continue
        symbol = text[places + depth]
        order = np.argsort(symbol, kind="stable")
        places, weights, symbol = places[order], weights[order], symbol[order]
        cut = np.append(np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])), len(symbol))
        weight = np.add.reduceat(weights, cut[:-1])
        # Small groups of neighbouring prefixes go together; larger ones get a longer prefix.
        held, held_size = [], 0
        for a, b, w in zip(cut[:-1].tolist(), cut[1:].tolist(), weight.tolist(), strict=True):
            if w < 2:
                continue
            if b - a > most:
                todo.append((places[a:b], weights[a:b], depth + 1))
                continue
            if held_size + b - a > most:
                yield np.concatenate([places[x:y] for x, y in held]), np.concatenate([weights[x:y] for x, y in held]), depth
                held, held_size = [], 0
            held.append((a, b))
            held_size += b - a
        if held:
            yield np.concatenate([places[x:y] for x, y in held]), np.concatenate([weights[x:y] for x, y in held]), depth


def deep_places(text: np.ndarray, places: np.ndarray, weights: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Places below the nodes of depth ``length`` with two places or more."""
    node = np.zeros(len(places), np.int64)
    while depth < length and len(places):
        symbol = text[places + depth]
        head = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        size = np.diff(np.append(head, len(node)))
        differs = np.repeat(np.add.reduceat(symbol != np.repeat(symbol[head], size), head) > 0, size)
        if differs.any():           # nodes that branch here; the edges of the others go on
            slots = np.flatnonzero(differs)
            order = slots[np.lexsort((symbol[slots], node[slots]))]
            places[slots], weights[slots], symbol[slots] = places[order], weights[order], symbol[order]
            new = np.append(True, (node[1:] != node[:-1]) | (symbol[1:] != symbol[:-1]))
            node = np.cumsum(new) - 1
            keep = np.bincount(node, weights=weights)[node] > 1
            places, weights, node = places[keep], weights[keep], node[keep]
        depth += 1
    return places


def solve(segments: list[bytes], windows: np.ndarray, weights: np.ndarray, length: int, most: int = SUBTREE) -> list[list[int]]:
    """For each segment (32-bit word hashes), [from, to) pairs of starts of repeated windows."""
    words = np.frombuffer(b"".join(segments), np.uint32)
    sizes = np.array([len(s) // 4 for s in segments])
    begins = np.cumsum(sizes) - sizes
    whose = np.repeat(np.arange(len(segments)), windows)
    places = np.arange(len(whose)) - np.repeat(np.cumsum(windows) - windows, windows) + begins[whose]
    repeated = np.zeros(len(words) + 1, bool)
    for group, weight, depth in prefix_groups(words, places, np.asarray(weights)[whose], length, most):
        repeated[deep_places(words, group, weight, depth, length)] = True
    # A segment ends with length - 1 words that are not window starts, so runs stay inside.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated])))
    out: list[list[int]] = [[] for _ in segments]
    owner = np.searchsorted(begins, edges[::2], side="right") - 1
    for s, a, b in zip(owner.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        out[s] += [a - int(begins[s]), b - int(begins[s])]
    return out


def _symbols(texts):
    data, starts = joined_bytes(texts)
    begin, end, first = word_places(data, starts)
    hashes = word_hashes(data, begin, end)
    return hashes, first, hashes.astype(np.uint32)


WORDS = Windows(LENGTH, (10, 30, LENGTH), _symbols, solve, np.uint32)


def _cut(length: int):
    def run(batches):
        for batch in batches:
            out = {n: [] for n in ("k1", "k2", "n_removed", "kept_sha256")}
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for k1, k2, text, ranges in zip(c["k1"], c["k2"], c["text"], c["ranges"], strict=True):
                data, starts = joined_bytes([text])
                begin, end, _ = word_places(data, starts)
                gone = covered(ranges, length, len(begin))
                whole = data.tobytes()
                kept = b" ".join([whole[a:b] for a, b in zip(begin[~gone].tolist(), end[~gone].tolist(), strict=True)])
                for name, x in zip(out, (k1, k2, int(gone.sum()), hashlib.sha256(kept).hexdigest()), strict=True):
                    out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))

    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    texts = keyed(docs, id_col, text_col)
    held, ranges = repeated_windows(texts, WORDS)
    per_text = ranges.groupBy("k1", "k2").agg(F.collect_list("ranges").alias("ranges"))
    cut = (held.filter("copies = 1").select("k1", "k2", "text").join(per_text, ["k1", "k2"])
           .mapInArrow(_cut(LENGTH), "k1 long, k2 long, n_removed long, kept_sha256 string"))
    copies = texts.groupBy("k1", "k2").agg(F.count("*").alias("copies")).filter("copies > 1").select("k1", "k2")
    changes = settle(cut.withColumn("all", F.lit(False)).unionByName(copies.withColumn("all", F.lit(True)),
                                                                   allowMissingColumns=True), "cuts")
    text = F.col("text")
    spaced = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"),
        word_count(text).alias("n_words"), F.sha2(spaced, 256).alias("sha"))
    # A text that occurs as a whole again goes whole, if it has any window at all.
    whole = F.coalesce(F.col("all"), F.lit(False)) & (F.col("n_words") >= LENGTH)
    return rows.join(changes, ["k1", "k2"], "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
