"""N-gram Jaccard join by signature trees.

Documents are sets of word n-grams; two link when their sets' Jaccard similarity reaches the
threshold. Equal sets are one set here. Any two linked sets share several of each set's first
elements in a common (hash) order (``least_shared``), so sets meet in groups by such an element. A set
that shares fewer of its first elements with any others at all links with nothing and goes, so sets that
only have some common n-grams make no pairs. Most links are found by comparing each set with the first
of a group, the one that it shares the most elements with; what is linked that way is not compared
again. Then each set stays in the groups of its rarest elements alone, and pairs count in how many groups
they meet (``least_meetings``). Small groups give their pairs as they are, large ones are joined by
signature trees: leaves of sets of like size, inner nodes with the OR of their token bitmaps and
their size range. Two trees are walked together; a pair of nodes is dropped when the sizes are too
far apart or the common bits allow too small an overlap.

Pairs that are left are compared exactly, on whole sets: pairs that hang together are one family.
A family is cut by ranges of hash values into slices of bounded size, so each element is sent once,
however many pairs its set is in; the family's pairs stream past each slice's sets, and common
elements add up over the slices. Nothing is capped.

Defined results: texts that are null, empty or without words have an empty set and link with
nothing; texts with fewer words than n have one n-gram, the whole sequence; rows that repeat an id
are documents of their own, linked by their text alone; a row with a null id takes the smallest id
that it is linked with, or none; ties need no rule; an empty table gives an empty table. Sets hold
64-bit hashes, equal sets are told by 128 bits.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.common import Stages, small
from listingflow.llm.components import components
from listingflow.llm.symbols import U, joined_bytes, mix, prefix_sums, turns, window_hash, word_hashes, word_places
from listingflow.session import stage

GRAM, PERCENT = 4, 85   # of op10
BITS = 2048             # of a set's bitmap
TILE = 4096             # sets of a group that are joined in one task
ELEMENTS = 16_000_000   # that one task holds when it compares pairs of a family (8 bytes each)
PLACES = 1 << 25        # bits that tell which texts are needed (4 MB, however many texts there are)
SMALL = 8               # sets of a group whose pairs are taken without trees
LEAF, FAN = 16, 8       # sets of a leaf, children of an inner node
PAIRS = 10_000          # candidate pairs of a batch, at least
NODES = 1 << 18         # pairs of nodes that a walk holds at once
SHARE = 8               # of the elements that linked sets have in common, one in so many is looked for

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32      # A-Z


def shingle_sets(texts: list[str | None], gram: int = GRAM) -> list[np.ndarray]:
    """Each text's sorted distinct n-gram hashes."""
    out = []
    for i, j in turns(texts):
        data, starts = joined_bytes(texts[i:j])
        begin, end, first = word_places(data, starts)
        words = word_hashes(LOWER[data], begin, end)
        sums = prefix_sums(words)
        grams = window_hash(sums, gram)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= gram:
                out.append(np.unique(grams[a:b - gram + 1]))
            elif b > a:     # short: the whole sequence, told from longer ones by its length
                whole = window_hash(prefix_sums(words[a:b]), b - a)
                out.append(mix(whole + U(b - a)))
            else:
                out.append(np.zeros(0, U))
    return out


def least_overlap(a, b, percent: int = PERCENT):
    """Common elements that sets of sizes a and b need (whole numbers: 100 * i >= percent * union)."""
    return -(-percent * (a + b) // (100 + percent))


def least_shared(n, percent: int = PERCENT):
    """How many of a set's first ``prefix_size`` elements any set that it links with has among its own.

    With h = ceil(percent * n / 100), a prefix leaves out h - k elements, which does not fall with n. Of two
    linked sets, take the one whose prefix ends first: of the h or more common elements of the larger
    set, at most its h - k lie behind that end, so k of them are in both prefixes (k: of the larger set).
    """
    return 1 + -(-percent * n // 100) // SHARE


def least_meetings(n, percent: int = PERCENT):
    """In how many groups linked sets (n: of the larger one) meet, when each stays in those of its rarest
    elements and leaves ``least_shared - least_meetings`` of the most frequent ones, which does not fall with n."""
    return 1 + (least_shared(n, percent) - 1) // 2


def prefix_size(n, percent: int = PERCENT):
    return n - -(-percent * n // 100) + least_shared(n, percent)


def size_class(n, percent: int = PERCENT):
    """The class of a set's size: sizes that can link lie in one class or in two neighbouring ones."""
    if percent >= 100:
        return n
    return F.floor(F.log(n) / (math.log(100 / percent) * (1 + 1e-9)))   # a little wide, for rounding


def _scan(batches, gram, percent):
    same = [(n, pa.int64()) for n in ("row", "id", "k1", "k2")]
    schema = pa.schema([*same, ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())])
    for batch in small(batches):
        sets = shingle_sets(batch.column("text").to_pylist(), gram)
        out = {n: [] for n in schema.names} | {n: batch.column(n) for n, _ in same}
        for s in sets:
            n = len(s)
            out["n"].append(n)
            for name, salt in (("f1", 1), ("f2", 2)):
                out[name].append(int(np.add.reduce(mix(s + U(salt)), dtype=U).view(np.int64)) if n else 0)
            out["prefix"].append(s[:prefix_size(n, percent)].view(np.int64) if n else [])
            out["bits"].append(bitmap(s))
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def bitmap(s: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[(s % U(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _sets(batches, gram):
    """Rows ``family, slices, a, text`` to ``family, slice, kind, a, b, na, nb, elements``: each set's
    elements, cut at the borders of equal ranges of hash values."""
    schema = pa.schema([("family", pa.int64()), ("slice", pa.int32()), ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()),
                        ("na", pa.int64()), ("nb", pa.int64()), ("elements", pa.binary())])
    for batch in small(batches):
        families, slices, a, texts = (batch.column(c).to_pylist() for c in ("family", "slices", "a", "text"))
        for i, j in turns(texts):
            out = []
            for k, s in enumerate(shingle_sets(texts[i:j], gram), i):
                borders = np.array([(r << 64) // slices[k] for r in range(1, slices[k])], U)
                edges = [0, *np.searchsorted(s, borders).tolist(), len(s)]
                out += [(families[k], r, 0, a[k], None, None, None, s[x:y].astype(U).tobytes())
                        for r, (x, y) in enumerate(zip(edges, edges[1:], strict=False)) if y > x]
            columns = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _compare(batches):
    """Rows sorted by (family, slice, kind): the slice's sets, then the family's pairs, which stream
    past. Gives each pair's common elements in the slice, if any."""
    schema = pa.schema([(n, pa.int64()) for n in ("a", "b", "na", "nb", "common")])
    held, sets = None, {}
    for batch in batches:
        out, elements = [], batch.column("elements")
        columns = (batch.column(c).to_pylist() for c in ("family", "slice", "kind", "a", "b", "na", "nb"))
        for row, (family, part, kind, a, b, na, nb) in enumerate(zip(*columns, strict=True)):
            if (family, part) != held:
                held, sets = (family, part), {}
            if kind == 0:
                sets[a] = np.frombuffer(elements[row].as_buffer(), U).copy()
            elif a in sets and b in sets:
                both = np.concatenate([sets[a], sets[b]])
                both.sort(kind="stable")
                out.append((a, b, na, nb, int((both[1:] == both[:-1]).sum())))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def needed(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``k1`` may be among those of ``keys``, told by one bit each: most of the
    texts that are not needed are not shuffled."""
    place = F.pmod("k1", F.lit(PLACES))
    marks = (keys.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("__bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__marks")))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__marks", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    return (texts.join(F.broadcast(marks), F.bitmap_bucket_number(place) == F.col("__bucket")).filter(marked)
            .select(*texts.columns))


def linked_pairs(pairs: DataFrame, families: DataFrame, texts: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold. ``families``: rep, family, n, id, k1, k2, with
    both sets of every pair in its ``family``; ``texts``: text with the id and the content hashes by
    which a rep's text is found."""
    slices = families.groupBy("family").agg(F.ceil(F.sum("n") / ELEMENTS).cast("int").alias("slices"))
    placed = stage(families.join(slices, "family").select("rep", "id", "k1", "k2", "n", "family", "slices"), "set-families")
    one = placed.select("family", F.col("rep").alias("a"), F.col("n").alias("na"), "slices")
    two = placed.select("family", F.col("rep").alias("b"), F.col("n").alias("nb"))
    met = (pairs.join(one, ["family", "a"]).join(two, ["family", "b"])
           .select("family", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(1).alias("kind"), "a", "b",
                   "na", "nb", F.lit(None).cast("binary").alias("elements")))
    held = (needed(texts, placed).join(placed.withColumnRenamed("id", "__id"), ["k1", "k2"]).filter(F.col("id").eqNullSafe(F.col("__id")))
            .select("family", "slices", F.col("rep").alias("a"), "text")
            .mapInArrow(partial(_sets, gram=gram), "family long, slice int, kind int, a long, b long, na long, nb long, elements binary"))
    common = (held.unionByName(met).repartition("family", "slice").sortWithinPartitions("family", "slice", "kind")
              .mapInArrow(_compare, "a long, b long, na long, nb long, common long")
              .groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common")))
    return common.filter(F.col("common") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


class SignatureTree:
    """Sets sorted by size; level 0 holds the sets, each node above ORs up to FAN nodes (a leaf:
    LEAF sets) below and keeps their least and largest size."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        # Elements that share a bit with another of their set: common bits can hide so many more.
        self.levels = [(bits, sizes, sizes, sizes - ones)]
        while len(self.levels[-1][1]) > 1:
            b, low, high, hidden = self.levels[-1]
            at = np.arange(0, len(low), fan(len(self.levels)))
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(hidden, at)))


def fan(level: int) -> int:
    return LEAF if level == 1 else FAN


def join_trees(one: SignatureTree, two: SignatureTree, percent: int = PERCENT):
    """Index pairs of sets that may reach the threshold, in parts."""
    level = max(len(one.levels), len(two.levels)) - 1
    stack = [(level, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, p, q = stack.pop()
        a = one.levels[min(level, len(one.levels) - 1)]
        b = two.levels[min(level, len(two.levels) - 1)]
        # Sizes first, then bits.
        fits = (100 * b[2][q] >= percent * a[1][p]) & (100 * a[2][p] >= percent * b[1][q])
        p, q = p[fits], q[fits]
        parts = []
        for k in range(0, len(p), 1 << 14):
            x, y = p[k:k + (1 << 14)], q[k:k + (1 << 14)]
            common = np.bitwise_count(a[0][x] & b[0][y]).sum(axis=1, dtype=np.int64)
            most = common + np.minimum(a[3][x], b[3][y])
            fits = most >= least_overlap(a[1][x], b[1][y], percent)
            parts.append((x[fits], y[fits]))
        p, q = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (p, q)
        if not len(p):
            continue
        if level == 0:
            yield p, q
            continue
        if len(p) > NODES // fan(level) ** 2:   # their children are too many at once
            step = NODES // fan(level) ** 2
            stack += [(level, p[k:k + step], q[k:k + step]) for k in range(0, len(p), step)]
            continue
        p, q = _children(one, level, p, q)
        q, p = _children(two, level, q, p)
        stack.append((level - 1, p, q))


def _children(tree: SignatureTree, level: int, nodes: np.ndarray, others: np.ndarray):
    if level >= len(tree.levels):       # the other tree is higher
        return nodes, others
    below = len(tree.levels[level - 1][1])
    first = nodes * fan(level)
    count = np.minimum(first + fan(level), below) - first
    which = np.repeat(np.arange(len(nodes)), count)
    return np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which], others[which]


def _tree_pairs(batches, percent):
    """Rows sorted by (token, i, j): candidate pairs of sets in different components, and in how many
    groups they meet at least if they are linked."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("least", pa.int64())])

    def pairs(rows):
        rows.sort(key=lambda r: r[5])
        side = [[r for r in rows if r[7]], [r for r in rows if r[8]]]
        whole = rows[0][1] == rows[0][2]
        if not all(side):
            return
        sides = [tuple(np.array([r[c] for r in part]) for c in (3, 4, 5)) for part in (side[:1] if whole else side)]
        (rep1, comp1, n1), (rep2, comp2, n2) = sides[0], sides[-1]
        if rows[0][6] is None:
            p, q = (x.ravel() for x in np.indices((len(rep1), len(rep2))))
            fits = 100 * np.minimum(n1[p], n2[q]) >= percent * np.maximum(n1[p], n2[q])
            met = [(p[fits], q[fits])]
        else:
            trees = [SignatureTree(n, np.frombuffer(b"".join(r[6] for r in part), np.uint64).reshape(len(part), -1))
                     for (_, _, n), part in zip(sides, side, strict=False)]
            met = join_trees(trees[0], trees[-1], percent)
        for p, q in met:
            fine = (comp1[p] != comp2[q]) & ((rep1[p] < rep2[q]) if whole else (rep1[p] != rep2[q]))
            a, b, n = rep1[p[fine]], rep2[q[fine]], np.maximum(n1[p[fine]], n2[q[fine]])
            if len(a):
                yield np.minimum(a, b), np.maximum(a, b), least_meetings(n, percent)

    names = ("token", "i", "j", "rep", "component", "n", "bits", "left", "right")
    def groups():
        held = []
        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                if held and held[-1][:3] != row[:3]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    out, rows = [], 0
    for group in groups():
        for part in pairs(group):
            out.append(part)
            rows += len(part[0])
            if rows >= PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=schema)
                out, rows = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=schema)


def jaccard_groups(docs: DataFrame, *, gram: int = GRAM, percent: int = PERCENT, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document. Sets of ``gram`` words link from a
    similarity of ``percent`` hundredths on."""
    stages = Stages(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).select(
        "id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")
    scanned = stages.write(texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        partial(_scan, gram=gram, percent=percent),
        "row long, id long, k1 long, k2 long, n long, f1 long, f2 long, prefix array<long>, bits binary"), "sets")
    key = ["n", "f1", "f2"]
    some = scanned.filter("n > 0").select("row", "id", *key)
    reps = stages.write(some.groupBy(*key).agg(F.min("row").alias("rep"), F.min("id").alias("least")), "set-reps")
    # Written, as its size then shows: the wide rows are shuffled only where many sets have copies.
    others = stages.write(some.join(reps, F.col("row") == F.col("rep"), "left_anti").select(F.col("row").alias("rep")), "set-others")
    firsts = scanned.filter("n > 0").withColumnRenamed("row", "rep").join(others, "rep", "left_anti")
    prefixes = stages.write(firsts.select("rep", "n", "prefix"), "set-prefixes")
    one = stages.write(firsts.select("rep", "id", "k1", "k2", "n", "bits"), "set-firsts")
    ids = stages.write(scanned.select("id", *key), "set-ids")
    stages.drop("sets", "set-others")
    texts, known = texts.filter("text is not null"), one.select("rep", "n", "id", "k1", "k2")
    # The elements that several sets have, then their sets: partial sums and a join that Spark can
    # split, so an element that a third of all sets have is not one task.
    tokens = prefixes.select(F.explode("prefix").alias("token"), "rep")
    common = stages.write(tokens.groupBy("token").agg(F.count("*").alias("members")).filter("members > 1").select("token"), "set-common")
    stages.drop()
    shared = stages.write(tokens.join(common, "token"), "set-shared")
    stages.drop("set-prefixes", "set-common")
    # Sets that share enough, and the first set of each element that several of those have.
    least = F.expr(f"1 + ceil({percent} * n / 100) div {SHARE}")     # least_shared, as a column
    able = shared.groupBy("rep").agg(F.count("*").alias("met")).join(one.select("rep", "n"), "rep").filter(F.col("met") >= least).drop("met")
    alive = stages.write(shared.join(able, "rep"), "set-alive")
    stages.drop("set-shared")
    leads = stages.write(alive.groupBy("token").agg(F.min("rep").alias("lead"), F.min_by("n", "rep").alias("lead_n"),
                                                    F.count("*").alias("members")).filter("members > 1"), "set-leads")
    met = stages.write(alive.join(leads, "token"), "set-groups")
    stages.drop("set-alive")
    # Each set is first compared with one set: the lead that it shares the most of its first
    # elements with, if that is half of them at least (fewer are left to the trees).
    near = F.expr(f"100 * least(n, lead_n) >= {percent} * greatest(n, lead_n)")
    star = (met.filter((F.col("rep") != F.col("lead")) & near).groupBy("rep", "n", "lead").agg(F.count("*").alias("shared"))
            .filter(2 * F.col("shared") >= F.col("n") - F.ceil(percent * F.col("n") / 100) + least)
            .groupBy(F.col("rep").alias("b")).agg(F.max(F.struct("shared", (-F.col("lead")).alias("minus"))).alias("best"))
            .select((-F.col("best.minus")).alias("a"), "b", (-F.col("best.minus")).alias("family")))
    star = stages.write(star, "set-stars")
    in_star = star.select(F.col("b").alias("rep"), "family").union(star.select("a", "family")).distinct()
    links = stages.write(linked_pairs(star, in_star.join(known, "rep"), texts, gram, percent), "set-links")
    stages.drop("set-leads", "set-stars")
    # Sets of one label are linked already; two steps along the links join up nearly all that are.
    first, second = (links.select(F.col("b").alias(f"{c}_from"), F.col("a").alias(f"{c}_to")) for c in ("one", "two"))
    label = (first.join(second, F.col("one_to") == F.col("two_from"), "left")
             .select(F.col("one_from").alias("id"), F.coalesce("two_to", "one_to").alias("label")))
    of_rep = Window.partitionBy("rep")
    kept = (met.withColumns({"at": F.row_number().over(of_rep.orderBy("members", "token")), "met": F.count("*").over(of_rep)})
            .filter(F.col("at") <= F.col("met") - least + F.expr(f"1 + ceil({percent} * n / 100) div {SHARE} div 2")))
    placed = stages.write(kept.select("token", "rep", "n").join(label, F.col("rep") == F.col("id"), "left")
                          .select("token", "rep", "n", F.coalesce("label", "rep").alias("component")), "set-placed")
    stages.drop("set-groups")
    # Only sets of one size class or of neighbouring ones can link, so a set goes to a tree only if those
    # classes of the element hold several components. A token's classes are few (a logarithm of the sizes).
    placed = placed.withColumn("class", size_class(F.col("n"), percent))
    mixed = (placed.groupBy("token", "class").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("members"))
             .groupBy("token").agg(F.min("c1").alias("c1"), F.max("c2").alias("c2"), F.sum("members").alias("size"),
                                   F.collect_list(F.struct("class", "c1", "c2")).alias("classes"))
             .filter("c1 != c2")
             .select("token", "size", F.explode(F.expr(
                 "filter(classes, x -> exists(classes, y -> abs(y.class - x.class) <= 1 and (y.c1 != x.c1 or y.c2 != x.c1)))")).alias("x"))
             .select("token", "size", F.col("x.class").alias("class")))
    members = stages.write(placed.join(mixed, ["token", "class"]).select("token", "rep", "n", "component", "size"), "set-members")
    stages.drop("set-placed")
    big = F.col("size") > SMALL
    members = (members.filter(big).join(one.select("rep", "bits"), "rep")
               .unionByName(members.filter(~big).withColumn("bits", F.lit(None).cast("binary"))))
    members = (members.withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
               .withColumn("t", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
               .select("token", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "rep", "component",
                       F.col("n").cast("long").alias("n"), "bits",
                       (F.col("t") <= F.col("o")).alias("left"), (F.col("t") >= F.col("o")).alias("right")))
    pairs = stages.write(members.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
                         .mapInArrow(partial(_tree_pairs, percent=percent), "a long, b long, least long")
                         .groupBy("a", "b", "least").agg(F.count("*").alias("times")).filter("times >= least").select("a", "b"), "set-pairs")
    stages.drop("set-members")
    families = stages.write(components(pairs).select(F.col("id").alias("rep"), F.col("component").alias("family")), "set-parts")
    pairs = pairs.join(families, F.col("a") == F.col("rep")).select("a", "b", "family")
    more = stages.write(linked_pairs(pairs, families.join(known, "rep"), texts, gram, percent), "set-more")
    stages.drop("set-pairs", "set-parts", "set-firsts")
    whole = components(links.unionByName(more))
    grouped = stages.write(reps.join(whole, F.col("rep") == F.col("id"), "left")
                           .select(*key, "least", F.coalesce("component", "rep").alias("part")), "set-components")
    named = grouped.groupBy("part").agg(F.min("least").alias("component_id"))
    of_set = grouped.join(named, "part").select(*key, "component_id")
    return (ids.join(of_set, key, "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))
