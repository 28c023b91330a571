"""Suffix-array and suffix-tree deduplication against brute force, with every level in use."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from listingflow.llm import anchors, substrdedup, suffixdedup
from llm_rows import frame, rows, table


def covered(starts, length, size):
    out = np.zeros(size, bool)
    for s in starts:
        out[s:s + length] = True
    return out


def brute(units, length):
    count = Counter(tuple(u[i:i + length]) for u in units for i in range(len(u) - length + 1))
    return [covered([i for i in range(len(u) - length + 1) if count[tuple(u[i:i + length])] > 1], length, len(u))
            for u in units]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bytes_expected(data):
    texts = [(t or "").encode() for _, t, *_ in data]
    out = {}
    for (doc_id, *_), text, gone in zip(data, texts, brute(texts, suffixdedup.LENGTH), strict=True):
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc_id] = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def words_expected(data):
    units = [words(t) for _, t, *_ in data]
    out = {}
    for (doc_id, *_), unit, gone in zip(data, units, brute(units, substrdedup.LENGTH), strict=True):
        kept = " ".join(w for w, g in zip(unit, gone, strict=True) if not g)
        out[doc_id] = (len(unit), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("group", [512, 1])     # 1: every shared anchor goes through all levels
@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_all_cases_against_brute_force(spark, monkeypatch, group, kind):
    monkeypatch.setattr(anchors, "GROUP", group)
    data = rows()
    op, expected = ((suffixdedup, bytes_expected) if kind == "bytes" else (substrdedup, words_expected))
    assert table(op.remove_repeats(frame(spark, data, clash=True)), "doc_id") == expected(data)


@pytest.mark.parametrize("op", [suffixdedup, substrdedup])
def test_empty_tables_and_repeated_rows(spark, op):
    assert op.remove_repeats(frame(spark, [])).count() == 0
    assert op.remove_repeats(frame(spark, [(1, None, None, None, None), (None, "", None, None, 0)])).count() == 2
    text = " ".join(f"q{i}" for i in range(200))
    out = op.remove_repeats(frame(spark, [(1, text, None, None, 0), (1, text, None, None, 0), (None, text, None, None, 0)]))
    assert all(r["n_removed"] == r[1] for r in out.collect()) and out.count() == 3


def test_whole_documents_table_of_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert table(suffixdedup.remove_repeats(docs), "doc_id") == bytes_expected(data)
    assert table(substrdedup.remove_repeats(docs), "doc_id") == words_expected(data)


def test_interval_expansion_finds_all_long_prefixes():
    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([8, 9, 12, 20, 33])
        base = bytes(rng.choice(b"ab\x00c") for _ in range(120))
        segments = []
        for _ in range(rng.randrange(1, 9)):
            at = rng.randrange(80)
            s = bytearray(base[at:at + rng.randrange(length, 61)])
            s[rng.randrange(len(s))] = rng.choice(b"abcd")
            if len(s) >= length:
                segments.append(bytes(s))
        if not segments:
            continue
        windows = np.array([len(s) - length + 1 for s in segments])
        weights = np.array([rng.choice([1, 1, 2]) for _ in segments])
        count = Counter()
        for s, n, w in zip(segments, windows, weights, strict=True):
            for i in range(n):
                count[s[i:i + length]] += w
        for s, n, got in zip(segments, windows, suffixdedup.solve(segments, windows, weights, length), strict=True):
            marks = [False] * n
            for a, b in zip(got[::2], got[1::2], strict=True):
                marks[a:b] = [True] * (b - a)
            assert marks == [count[s[i:i + length]] > 1 for i in range(n)]


def test_subtrees_of_any_size_agree():
    rng = random.Random(6)
    for _ in range(150):
        length, base = rng.choice([2, 3, 5, 8]), [rng.randrange(3) for _ in range(60)]
        segments = []
        for _ in range(rng.randrange(1, 9)):
            at = rng.randrange(40)
            s = np.array(base[at:at + rng.randrange(length, 20)], np.uint32)
            s[rng.randrange(len(s))] = 7
            if len(s) >= length:
                segments.append(s)
        if not segments:
            continue
        windows, weights = np.array([len(s) - length + 1 for s in segments]), np.ones(len(segments), int)
        count = Counter(tuple(s[i:i + length]) for s, n in zip(segments, windows, strict=True) for i in range(n))
        for most in (1, 3, 1000):
            found = substrdedup.solve([s.tobytes() for s in segments], windows, weights, length, most=most)
            for s, n, got in zip(segments, windows, found, strict=True):
                marks = [False] * n
                for a, b in zip(got[::2], got[1::2], strict=True):
                    marks[a:b] = [True] * (b - a)
                assert marks == [count[tuple(s[i:i + length])] > 1 for i in range(n)]


def test_text_form_keeps_whole_characters(spark):
    passage = "".join(chr(0xE0 + i % 25) for i in range(300))       # two bytes each
    data = [(1, "a" + passage + " one", "l", "s", 0), (2, passage + "two ", "l", "s", 0), (3, None, "l", "s", 0),
            (4, "alone", "l", "s", 0)]
    out = {r["doc_id"]: r["text"] for r in suffixdedup.without_repeats(frame(spark, data, clash=True)).collect()}
    assert out == {1: "a one", 2: "two ", 3: None, 4: "alone"}
