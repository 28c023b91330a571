"""The n-gram Jaccard join against brute force; connected components."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from pyspark.sql import functions as F

from listingflow.llm import jaccard
from listingflow.llm.common import Stages
from listingflow.llm.components import components
from llm_rows import frame, prose, rows, table

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def expected(data):
    sets = {r[0]: shingles(r[1]) for r in data}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, groups=6, each=10):
    """Groups whose members are near and far enough that some pairs link and some do not."""
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        words = prose(rng, rng.randrange(20, 120), 3000).split(" ")
        for _ in range(each):
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(words))
    rng.shuffle(out)
    return [(i * 3 + 1, t, None, None, 0) for i, t in enumerate(out)]


@pytest.mark.parametrize("tile", [4096, 3])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    for data in (rows(), near_copies(1), near_copies(2, 3, 25)):
        assert table(jaccard.jaccard_groups(frame(spark, data, clash=True)), "doc_id") == expected(data)


def test_without_the_first_comparison_trees_find_all(spark, monkeypatch):
    """Every link through the trees: the comparison with a group's first member is left out."""
    real, calls = jaccard.linked_pairs, []

    def second_only(pairs, *rest):
        calls.append(1)
        return real(pairs.filter("false") if len(calls) == 1 else pairs, *rest)

    monkeypatch.setattr(jaccard, "linked_pairs", second_only)
    data = near_copies(3)
    assert table(jaccard.jaccard_groups(frame(spark, data)), "doc_id") == expected(data)


def test_repeated_and_null_ids(spark):
    """Rows are linked by their texts alone; the least id that is there names a component."""
    assert jaccard.jaccard_groups(frame(spark, [])).count() == 0
    rng = random.Random(12)
    one, two, three, four = (prose(rng, 60, 3000) for _ in range(4))
    near = lambda t, k: " ".join([*t.split(" "), *(f"more{k}{i}" for i in range(3))])
    data = [(21, one), (21, two), (30, near(two, 1)), (5, one), (None, three), (None, four), (17, near(three, 2)), (20, near(four, 3)),
            (None, "lonely text of seven words for itself"), (None, None), (None, None), (9, ""), (21, "other words that nobody else has"), (8, near(two, 4))]
    got = sorted((tuple(r) for r in jaccard.jaccard_groups(frame(spark, [(*r, None, None, 0) for r in data])).collect()), key=repr)
    n = lambda t: len(shingles(t))
    want = [5, 8, 8, 5, 17, 20, 17, 20, None, None, None, 9, 21, 8]
    assert got == sorted(((i, n(t), c) for (i, t), c in zip(data, want, strict=True)), key=repr)


def test_families_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ELEMENTS", 150)
    data = near_copies(2, 3, 25)
    assert table(jaccard.jaccard_groups(frame(spark, data)), "doc_id") == expected(data)


def thue_morse(length, turned):
    """Letters a and b by the parity of ones in the place: sums of powers cancel out on these."""
    return "".join("ab"[(bin(i).count("1") + turned) % 2] for i in range(length))


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_on_which_sums_of_powers_collide(spark, length):
    data = [(k, " ".join([thue_morse(length, k)] * 6), None, None, 0) for k in (0, 1)]
    assert table(jaccard.jaccard_groups(frame(spark, data)), "doc_id") == {0: (1, 0), 1: (1, 1)}
    from listingflow.llm import substrdedup
    data = [(k, " ".join([thue_morse(length, k)] + [f"w{k}{i}" for i in range(20)] + [thue_morse(length, k)] * 20), None, None, 0) for k in (0, 1)]
    out = substrdedup.remove_repeats(frame(spark, data)).collect()
    assert [r["n_removed"] for r in out] == [0, 0]


def test_trees_drop_no_pair():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2 ** 63, rng.integers(5, 80)).astype(np.uint64)
        for _ in range(12):
            s = base.copy()
            k = rng.integers(0, max(1, len(s) // 6) + 1)
            s[rng.integers(0, len(s), k)] = rng.integers(0, 2 ** 63, k)
            sets.append(np.unique(s))
    sets.sort(key=len)
    bits = np.frombuffer(b"".join(jaccard.bitmap(s) for s in sets), np.uint64).reshape(len(sets), -1)
    tree = jaccard.SignatureTree(np.array([len(s) for s in sets]), bits)
    found = {(int(x), int(y)) for p, q in jaccard.join_trees(tree, tree) for x, y in zip(p, q, strict=True)}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            if 100 * common >= 85 * (len(a) + len(b) - common):
                assert (i, j) in found
    assert len(found) < len(sets) ** 2 / 4


def test_components_of_paths_stars_and_random_links(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(1, 60)] + [(500, 400 + i) for i in range(50)] + [(7000, 7000), (9, 9)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for link in links for x in link if link[0] != link[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [80, 85, 97, 100])
def test_size_classes_keep_sizes_that_can_link_together(spark, percent):
    n = np.arange(1, 4000)
    top = n * 100 // percent            # the largest size that n can link with
    pairs = spark.createDataFrame([(int(a), int(b)) for a, b in zip(n, top, strict=True)], "a long, b long")
    one, two = (jaccard.size_class(F.col(c), percent) for c in "ab")
    apart = pairs.select((two - one).alias("d")).distinct().collect()
    if percent < 100:
        assert {r.d for r in apart} <= {0, 1}
    else:
        assert {r.d for r in apart} == {0}


def test_sets_at_the_border_of_their_classes_link(spark):
    words = [f"v{k}" for k in range(1300)]
    data = [(k + 1, " ".join(words[:size + 3]), None, None, 0)      # nested sets of these sizes
            for k, size in enumerate([17, 20, 34, 40, 85, 100, 170, 200, 850, 1000, 1176])]
    assert table(jaccard.jaccard_groups(frame(spark, data, clash=True)), "doc_id") == expected(data)


def test_no_bitmap_is_sent_for_sets_of_sizes_that_cannot_link(spark, monkeypatch):
    rows_of, write = {}, Stages.write

    def counted(self, df, name):
        out = write(self, df, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(Stages, "write", counted)
    words = [f"v{k}" for k in range(500)]
    data = [(k + 1, " ".join(words[:size]), None, None, 0) for k, size in enumerate([30, 60, 120, 240, 480])]
    assert table(jaccard.jaccard_groups(frame(spark, data)), "doc_id") == expected(data)
    assert rows_of["set-groups"] > 0 and rows_of["set-members"] == 0


@pytest.mark.parametrize("percent", [80, 85, 97, 100])
def test_linked_sets_share_as_many_first_elements(percent):
    rng = np.random.default_rng(percent)
    n = np.arange(1, 5000)
    h, k, j = -(-percent * n // 100), jaccard.least_shared(n, percent), jaccard.least_meetings(n, percent)
    assert (np.diff(h - k) >= 0).all() and (np.diff(k - j) >= 0).all() and (1 <= j).all() and (j <= k).all() and (k <= h).all()
    for _ in range(400):
        whole = np.unique(rng.integers(0, 10 ** 6, rng.integers(1, 200)))
        gone = len(whole) * (100 - percent) // 100      # elements that one of both sets lacks
        at = np.arange(gone) if rng.random() < 0.5 else rng.permutation(len(whole))[:gone]
        side = rng.random(gone) < rng.random()
        a, b = np.delete(whole, at[side]), np.delete(whole, at[~side])
        most = max(len(a), len(b))
        first = [s[:jaccard.prefix_size(len(s), percent)] for s in (a, b)]
        assert len(np.intersect1d(*first)) >= jaccard.least_shared(most, percent)


def test_long_texts_with_one_passage_in_common_make_no_pairs(spark, monkeypatch):
    rows_of, write = {}, Stages.write

    def counted(self, df, name):
        out = write(self, df, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(Stages, "write", counted)
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(100))
    data = [(k, " ".join([*(f"w{rng.randrange(10**9)}" for _ in range(4000)), passage]), None, None, 0) for k in range(12)]
    got = table(jaccard.jaccard_groups(frame(spark, data)), "doc_id")
    assert {i: c for i, (_, c) in got.items()} == {k: k for k in range(12)}
    assert rows_of["set-pairs"] == 0


def test_a_walk_of_full_bitmaps_holds_few_pairs():
    n = 2048
    tree = jaccard.SignatureTree(np.full(n, 5000), np.full((n, jaccard.BITS // 64), ~np.uint64(0)))
    tracemalloc.start()
    found = sum(len(p) for p, _ in jaccard.join_trees(tree, tree))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == n * n
    assert peak < 64 * 2 ** 20


def test_few_texts_are_taken_that_are_not_needed(spark):
    texts = spark.range(3000).select(F.xxhash64("id").alias("k1"), "id")
    wanted = texts.filter("id % 30 = 0")
    ids = {r.id for r in jaccard.needed(texts, wanted).collect()}
    assert ids >= set(range(0, 3000, 30)) and len(ids) <= 105
    assert jaccard.needed(texts, wanted.filter("false")).count() == 0
