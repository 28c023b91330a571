"""Repeated windows of symbols (bytes or words) across a table of texts.

Every window of L symbols has an anchor: the place of the least hash among its k-grams. Equal
windows have equal anchors at the same offset, and neighbouring windows mostly share one, so the
windows of a text fall into few runs, and only runs whose anchor value occurs again anywhere can
hold a repeated window. Those runs' symbols ("segments") are grouped by anchor and handed to a
solver, each distinct segment once with its number of occurrences.

An anchor value with very many occurrences (a line or passage that a third of all texts have) is
not one group: its windows are anchored again by longer k-grams, in the end by the whole window,
where a group is one window's content and only a count. No rule drops anything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import settle
from listingflow.llm.symbols import U, mix, powers_down, prefix_sums, sliding_min, turns, window_hash

#: An anchor with more occurrences (first level) or distinct segments (later) is anchored again.
GROUP = 512
#: Symbols that a solver gets at once, unless one group has more.
BATCH = 1 << 19
PLACE = U((1 << 20) - 1)


@dataclass(frozen=True)
class Windows:
    """What a solver and the passes share. ``symbols(texts)``: symbol values of all texts joined,
    where each text starts, and what segments are cut from (one entry per symbol)."""

    length: int
    grams: tuple[int, ...]                  # k of each level; the last is the window itself
    symbols: Callable
    solve: Callable                         # (segments, windows, weights, length) -> list of ranges
    dtype: type


@dataclass
class Runs:
    """Runs of neighbouring windows that share an anchor, over joined texts."""

    text: np.ndarray
    first: np.ndarray       # first window's place, from the text's start
    at: np.ndarray          # the same, over the joined symbols
    count: np.ndarray
    anchor: np.ndarray


def window_anchors(hashes: np.ndarray, wide: int) -> np.ndarray:
    """Place of the least of every ``wide`` neighbouring k-gram hashes, leftmost of equal ones."""
    if len(hashes) < wide:
        return np.zeros(0, np.int64)
    if wide == 1:
        return np.arange(len(hashes))
    if len(hashes) <= int(PLACE):
        keyed = (hashes & ~PLACE) | np.arange(len(hashes), dtype=U)
        return (sliding_min(keyed, wide) & PLACE).astype(np.int64)
    # Longer than a turn (one very long text): in pieces that overlap by a window.
    step = int(PLACE) - wide
    return np.concatenate([at + window_anchors(hashes[at:at + step + wide - 1], wide)
                           for at in range(0, len(hashes) - wide + 1, step)])


def runs(sums: np.ndarray, starts: np.ndarray, length: int, k: int, only: np.ndarray | None = None) -> Runs:
    """Runs of the windows inside texts; with ``only``, of the windows marked there."""
    hashes = window_hash(sums, k)
    place = window_anchors(hashes, length - k + 1)
    size = np.diff(starts)
    inside = np.zeros(len(sums), bool)
    for i in np.flatnonzero(size >= length):
        inside[starts[i]:starts[i + 1] - length + 1] = True
    inside = inside[:len(place)]
    if only is not None:
        inside &= only[:len(place)]
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, np.zeros(0, U))
    text = np.searchsorted(starts, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (np.diff(at) > 1) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    at, text = at[head], text[head]
    return Runs(text, at - starts[text], at, count, hashes[place[at]])


def segment_hashes(sums: np.ndarray, r: Runs, length: int) -> np.ndarray:
    """64 bits of each run's whole segment and number of windows."""
    end = r.at + r.count + length - 1
    return mix((sums[end] - sums[r.at]) * powers_down(len(sums))[r.at] + mix(r.count.astype(U)) + r.anchor)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U).view(np.int64))


def _first_level(w: Windows):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            for i, j in turns(texts):
                values, starts, _ = w.symbols(texts[i:j])
                r = runs(prefix_sums(values), starts, w.length, w.grams[0])
                # One row per text and anchor: periodic texts meet the same anchor all along.
                order = np.lexsort((r.anchor, r.text))
                text, anchor = r.text[order], r.anchor[order]
                new = np.ones(len(order), bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                head = np.flatnonzero(new)
                n = np.diff(np.append(head, len(order))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][text[head]]), _signed(anchor[head]), pa.array(n)],
                                                 names=["id", "anchor", "own"])

    return run


def _marked(r: Runs, chosen: np.ndarray, size: int) -> np.ndarray:
    """Window starts of the chosen runs."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, r.at[chosen], 1)
    np.add.at(edge, (r.at + r.count)[chosen], -1)
    return np.cumsum(edge)[:size] > 0


EMIT = ("kind int, anchor long, seg long, k1 long, k2 long, weight long, windows int, starts array<int>, body binary")
EMIT_ARROW = pa.schema([("kind", pa.int32()), ("anchor", pa.int64()), ("seg", pa.int64()), ("k1", pa.int64()),
                        ("k2", pa.int64()), ("weight", pa.int64()), ("windows", pa.int32()),
                        ("starts", pa.list_(pa.int32())), ("body", pa.binary())])
SEGMENT, OCCURRENCE, SURE, OPEN = 0, 1, 2, 3


def _emit(w: Windows, level: int):
    """Rows from texts whose repeated anchors are known: SEGMENT (a distinct segment, its weight
    in this batch), OCCURRENCE (where a text has it), SURE (a repeated whole window), OPEN (runs
    of the next level of windows whose anchor has too many occurrences)."""
    length, k, last = w.length, w.grams[level], level == len(w.grams) - 1

    def run(batches):
        for batch in batches:
            c = {n: batch.column(n) for n in batch.schema.names}
            texts, k1, k2 = c["text"].to_pylist(), c["k1"].to_pylist(), c["k2"].to_pylist()
            copies, cold, hot = c["copies"].to_pylist(), c["cold"].to_pylist(), c["hot"].to_pylist()
            for i, j in turns(texts):
                values, starts, source = w.symbols(texts[i:j])
                sums = prefix_sums(values)
                r = runs(sums, starts, length, k)
                signed = r.anchor.view(np.int64)
                # Which runs' anchors are in their text's lists.
                kind = np.zeros(len(signed), np.int8)
                ends = np.searchsorted(r.text, np.arange(j - i + 1))
                for t in range(i, j):
                    own = slice(ends[t - i], ends[t - i + 1])
                    for mark, listed in ((1, cold[t]), (2, hot[t])):
                        if listed:
                            kind[own][np.isin(signed[own], np.array(listed, np.int64))] = mark
                rows = {n: [] for n in EMIT_ARROW.names}

                def add(kind_, anchor, seg, t, weight, windows, at, body, rows=rows):
                    for name, x in zip(rows, (kind_, anchor, seg, k1[t], k2[t], weight, windows, at, body), strict=True):
                        rows[name].append(x)

                picked = np.flatnonzero(kind == 1)
                if len(picked):
                    part = Runs(*(x[picked] for x in (r.text, r.first, r.at, r.count, r.anchor)))
                    seg = part.anchor if last else segment_hashes(sums, part, length)
                    seg, anchors = seg.view(np.int64), part.anchor.view(np.int64)
                    weigh = np.array(copies[i:j], np.int64)[part.text]
                    order = np.lexsort((part.first, seg, anchors, part.text))
                    per = np.flatnonzero(np.append(True, (np.diff(seg[order]) != 0) | (np.diff(part.text[order]) != 0)
                                                   | (np.diff(anchors[order]) != 0)))
                    for a, b in zip(per, np.append(per[1:], len(order)), strict=True):
                        one = order[a]
                        add(SURE if last else OCCURRENCE, int(anchors[one]), int(seg[one]), i + int(part.text[one]), 0,
                            int(part.count[one]), part.first[order[a:b]].tolist(), None)
                    if not last:
                        keys, first, back = np.unique(np.stack([anchors, seg], 1), axis=0, return_index=True, return_inverse=True)
                        total = np.bincount(back.ravel(), weights=weigh, minlength=len(keys))
                        for one, weight in zip(first.tolist(), total.tolist(), strict=True):
                            at, n = int(part.at[one]), int(part.count[one])
                            add(SEGMENT, int(anchors[one]), int(seg[one]), i + int(part.text[one]), int(weight), n, None,
                                source[at:at + n + length - 1].tobytes())
                if not last and (kind == 2).any():
                    nxt = runs(sums, starts, length, w.grams[level + 1], _marked(r, kind == 2, len(values)))
                    seg = nxt.anchor if level + 2 == len(w.grams) else segment_hashes(sums, nxt, length)
                    keys = np.stack([nxt.text, nxt.anchor.view(np.int64), seg.view(np.int64)], 1)
                    keys, n = np.unique(keys, axis=0, return_counts=True)
                    for (t, anchor, s), m in zip(keys.tolist(), n.tolist(), strict=True):
                        add(OPEN, anchor, s, i + t, m * copies[i + t], 0, None, None)
                if rows["kind"]:
                    yield pa.RecordBatch.from_pydict(rows, schema=EMIT_ARROW)

    return run


def _solve(w: Windows):
    """Solver over sorted rows (anchor, seg, windows, weight, body), whole anchors at a time."""
    out_schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("ranges", pa.list_(pa.int32()))])

    def solved(held):
        ranges = w.solve([h[4] for h in held], np.array([h[2] for h in held]), np.array([h[3] for h in held]), w.length)
        found = [(h[0], h[1], x) for h, x in zip(held, ranges, strict=True) if x]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, out_schema, strict=True)],
                                          schema=out_schema)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("anchor", "seg", "windows", "weight", "body")]
            for row in zip(*columns, strict=True):
                if held and held[-1][:2] == row[:2]:
                    held[-1] = (*row[:3], held[-1][3] + row[3], row[4])
                    continue
                if size >= BATCH and held[-1][0] != row[0]:
                    yield solved(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4]) // np.dtype(w.dtype).itemsize
        if held:
            yield solved(held)

    return run


def repeated_windows(texts: DataFrame, w: Windows) -> tuple[DataFrame, DataFrame]:
    """``texts``: id, k1, k2 (content hashes), text. Returns the texts that hold an anchor that
    occurs again, one per content (k1, k2, copies, text), and ``k1, k2, ranges``: for each of
    them with repeated windows, [from, to) pairs of window starts, as one array per part."""
    seen = settle(texts.select("id", "text").mapInArrow(_first_level(w), "id long, anchor long, own int"), "anchors")
    counts = seen.groupBy("anchor").agg(F.sum("own").alias("n")).filter("n > 1")
    lists = (seen.drop("own").join(counts, "anchor").groupBy("id")
             .agg(F.collect_set(F.when(F.col("n") <= GROUP, F.col("anchor"))).alias("cold"),
                  F.collect_set(F.when(F.col("n") > GROUP, F.col("anchor"))).alias("hot")))
    one = texts.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    # Only the first text of each content goes on, with the number of its copies.
    wanted = one.join(lists, "id")
    held = settle(texts.select("id", "k1", "k2", "text").join(wanted, ["id", "k1", "k2"])
                 .select("k1", "k2", "copies", "text", "cold", "hot"), "anchored")
    parts, now = [], held
    for level in range(len(w.grams)):
        out = settle(now.mapInArrow(_emit(w, level), EMIT), "segments")
        kind = {n: out.filter(F.col("kind") == n) for n in (SEGMENT, OCCURRENCE, SURE, OPEN)}
        if level == len(w.grams) - 1:
            parts.append(kind[SURE].select("k1", "k2", F.flatten(F.transform(
                "starts", lambda x: F.array(x, x + 1))).alias("ranges")))
            break
        found = (kind[SEGMENT].select("anchor", "seg", "windows", "weight", "body").repartition("anchor")
                 .sortWithinPartitions("anchor", "seg").mapInArrow(_solve(w), "anchor long, seg long, ranges array<int>"))
        parts.append(kind[OCCURRENCE].join(found, ["anchor", "seg"]).select("k1", "k2", F.flatten(F.transform(
            "starts", lambda s: F.transform("ranges", lambda x: x + s))).alias("ranges")))
        opened = kind[OPEN].select("k1", "k2", "anchor", "seg", "weight")
        if opened.isEmpty():
            break
        segs = opened.groupBy("anchor", "seg").agg(F.sum("weight").alias("weight"))
        stats = (segs.groupBy("anchor").agg(F.sum("weight").alias("n"), F.count("*").alias("variants")).filter("n > 1"))
        lists = (opened.select("k1", "k2", "anchor").join(stats, "anchor").groupBy("k1", "k2")
                 .agg(F.collect_set(F.when(F.col("variants") <= GROUP, F.col("anchor"))).alias("cold"),
                      F.collect_set(F.when(F.col("variants") > GROUP, F.col("anchor"))).alias("hot")))
        now = held.select("k1", "k2", "copies", "text").join(lists, ["k1", "k2"])
    ranges = parts[0]
    for part in parts[1:]:
        ranges = ranges.unionByName(part)
    return held.select("k1", "k2", "copies", "text"), ranges
