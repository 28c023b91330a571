"""Class-conditional Kneser-Ney scores against direct counts, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import frame, rows

from listingflow.llm import toxicity

BAD = ["vile", "rotten", "filthy", "schäbig"]


def texts(n=600, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        toxic = rng.random() < 0.3
        words = [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randrange(1, 90))]
        for _ in range(toxic * rng.randrange(1, 4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        out.append((i, rng.choice([" ", ", ", "\n"]).join(words).title(), None, None, 0, int(toxic)))
    return out


def part(i):
    return zlib.crc32(str(i).encode()) % 5


def tables(spark, data, labels=None):
    docs = frame(spark, [r[:5] for r in data])
    given = [(r[0], r[5]) for r in data] if labels is None else labels
    return docs, spark.createDataFrame(given, "doc_id long, toxic int").repartition(3)


def test_model_equals_direct_counts(spark):
    data = texts()
    docs, labels = tables(spark, data)
    model = toxicity.train(docs, labels)
    seen = {0: set(), 1: set()}
    for i, text, *_, toxic in data:
        if part(i) in (1, 2, 3):
            w = [x.lower() for x in text.replace(",", " ").split()]
            seen[toxic] |= set(zip(["", *w], w))
    counts = [Counter(b for _, b in seen[c]) for c in (0, 1)]
    shared = Counter(b for _, b in seen[0] | seen[1])
    total, kept = [sum(c.values()) for c in counts], []
    for c in counts:
        d = toxicity.discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])
        kept.append(lambda x, d=d: [0, *d][min(x, 3)])
    held = [sum(kept[c](v) for v in counts[c].values()) / total[c] for c in (0, 1)]
    everything = sum(shared.values()) + 0.5 * (len(shared) + 1)

    def llr(w):
        p = [(counts[c][w] - kept[c](counts[c][w])) / total[c] + held[c] * (shared[w] + 0.5) / everything for c in (0, 1)]
        return math.log(p[1] / p[0])

    assert model.size == len(shared) and math.isclose(model.unseen, llr("never"))
    words = sorted(shared)
    hashes, _ = toxicity.words([" ".join(words)])
    found = {r["word"]: r["llr"] for r in model.table.collect()}
    for w, h in zip(words, hashes.view(np.int64).tolist(), strict=True):
        assert math.isclose(found[h], llr(w), abs_tol=1e-9), w
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for i, text, *_ in data[:80]:
        w = [llr(x.lower()) for x in text.replace(",", " ").split()]
        runs = [max(w), max(sum(w[k:k + 4]) / 4 for k in range(len(w) - 3)) if len(w) > 4 else sum(w) / len(w), sum(w) / len(w)]
        z = model.weights[0] + sum(a * b for a, b in zip(model.weights[1:], runs, strict=True))
        assert math.isclose(scores[i], 1 / (1 + math.exp(-z)), abs_tol=1e-6)


def test_held_out_accuracy_and_both_ways(spark):
    data = texts(900, seed=6)
    docs, labels = tables(spark, data)
    model = toxicity.train(docs, labels)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(r["held_out"] == (part(i) == 0) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for i, r in out.items())
    held = [(r[5], out[r[0]]["predicted"]) for r in data if part(r[0]) == 0]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    joined = {r["doc_id"]: r for r in toxicity.score(docs, model, most_words=0).collect()}
    assert joined == out
    assert toxicity.train(docs, labels, most_words=0).weights == pytest.approx(model.weights, abs=1e-6)


def test_held_out_labels_teach_nothing(spark):
    data = texts(300)
    turned = [(r[0], 1 - r[5] if part(r[0]) == 0 else r[5]) for r in data] + [(None, 1), (1, None)]
    one, two = (sorted(map(tuple, toxicity.toxicity(*tables(spark, data, x)).collect())) for x in (None, turned))
    assert one == two


def test_copies_teach_once(spark):
    """A text copied many times adds no distinct pair of words."""
    data = texts(300)
    docs, labels = tables(spark, data)
    copies = [(i, data[7][1], None, None, 0, 0) for i in range(1000, 1400)]
    more, also = tables(spark, data + copies)
    train = lambda d, l: {r["word"]: (r["toxic"], r["ordinary"]) for r in toxicity.count_words(
        toxicity.labelled(d, l).filter("part != 4")).collect()}
    before, after = train(docs, labels), train(more, also)
    changed = {w for w in after if after[w] != before.get(w)}
    hashes, _ = toxicity.words([data[7][1]])
    assert changed <= set(hashes.view(np.int64).tolist()) and all(after[w][1] - before.get(w, (0, 0))[1] <= len(hashes) for w in changed)


def test_defined_cases(spark):
    """Nulls, empty and long texts, repeated and null ids, clashing names, missing classes, empty tables."""
    data = rows()
    docs = frame(spark, data + [data[10], data[10], (None, data[10][1], None, None, 0)], clash=True)
    _, labels = tables(spark, [], [(i, i % 2) for i in range(8, len(data))] + [(9, 0), (9, 1)])
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(data) + 3
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add(r["score"])
        assert 0 <= r["score"] <= 1 and r["held_out"] == (r["doc_id"] is not None and part(r["doc_id"]) == 0)
    assert by[None] == by[10] and len(by[10]) == 1
    assert by[0] == by[1] == by[2] and len(by[0]) == 1
    for share, given in ((1.0, [(i, 1) for i in range(30)]), (0.0, [(i, 0) for i in range(30)]), (0.0, [])):
        got = toxicity.toxicity(*tables(spark, [(*r, 0) for r in data], given)).collect()
        assert {r["score"] for r in got} == {share} and len(got) == len(data)
    assert toxicity.toxicity(*tables(spark, [], [(1, 1)])).count() == 0
