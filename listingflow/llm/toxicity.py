"""Toxicity by class-conditional Kneser-Ney models.

A word's class count is the number of distinct words that it follows in that class, so a text that
is copied a thousand times teaches no more than once. Each class discounts its counts (discounts
for counts of one, two and more, from the counts of counts) and hands the mass to the backoff
distribution, which both classes share: distinct preceding words over all labelled texts. A rare
expression therefore differs little between the classes, whatever class it was seen in. A text's
toxic and ordinary log-likelihoods are compared over runs of words, divided by the run's length:
the most toxic word, the most toxic run of four, the whole text. Three weights turn these into a
probability; they are fitted by Newton steps on other texts than the counts came from, all sums
made by Spark.

The counts are a table that grows with the corpus. Up to ``MOST_WORDS`` words its scores are sent to every
task; beyond that, the texts' words are joined with it. Both ways give the same scores.

Words are maximal runs of letters and digits, lower-cased, told apart by 64-bit hashes.

Defined results: labels of rows held out (crc32 of the id as text, modulo 5, is 0) are never used,
nor labels of null ids; a document with several labels is toxic if one says so; null and empty
texts and texts without a word have the score of a text in which nothing speaks for either class;
if labels of one class are missing among the rows that count, every score is the toxic share; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import arrow_rows
from listingflow.llm.symbols import U, joined_bytes, mix, turns, word_hashes, word_places
from listingflow.session import stage

FOLDS = 5               # by crc32 of the id: 0 is held out, 4 fits the weights, the others count
RUNS = (1, 4, 0)        # words of a run; 0: the whole text
MOST_WORDS = 4_000_000  # words of the model that are sent to every task (16 bytes each)
MOST_LABELS = 2_000_000  # labelled ids that are sent to every task, else joined by a shuffle
RIDGE = 1.0
NOT_WORD = re.compile(r"[\W_]+")


def fold(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def held_out(doc_id) -> F.Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, and each text's first word (one more at the end)."""
    data, starts = joined_bytes([NOT_WORD.sub(" ", (t or "").lower()) for t in texts])
    begin, end, first = word_places(data, starts)
    return word_hashes(data, begin, end), first


def _pairs(batches):
    """Distinct (word, word before, class) of each part of the rows ``text, toxic``."""
    schema = pa.schema([("word", pa.int64()), ("before", pa.int64()), ("kind", pa.int32())])
    for batch in batches:
        texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        for i, j in turns(texts):
            word, first = words(texts[i:j])
            if not len(word):
                continue
            before = np.concatenate([np.zeros(1, U), word[:-1]])
            before[first[:-1][first[:-1] < len(word)]] = 0
            kind = np.repeat(1 + toxic[i:j].astype(np.int32), np.diff(first))
            _, at = np.unique(mix(word + U(3) * mix(before)) + kind.astype(U), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(word[at].view(np.int64)), pa.array(before[at].view(np.int64)),
                                              pa.array(kind[at])], schema=schema)


def labelled(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``part`` (1 to 4), ``toxic``, ``text`` of the documents whose labels may be used."""
    known = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("__id").isNotNull() & F.col("toxic").isNotNull()).withColumn("part", fold("__id")).filter("part != 0")
             .groupBy("__id", "part").agg(F.max("toxic").alias("toxic")))
    known = stage(known, "toxic-labels")
    small = known.count() <= MOST_LABELS
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")).filter("text is not null")
    return rows.join(F.broadcast(known) if small else known, "__id").select("part", "toxic", "text")


@dataclass
class Model:
    """``table``: word, llr (log of toxic over ordinary probability); words not in it have ``unseen``.
    ``share``: of toxic texts, the score of everything if one class was not there."""

    table: DataFrame
    size: int
    unseen: float
    weights: tuple[float, ...] | None
    share: float


def discounts(counts: list[int]) -> list[float]:
    """What is taken off counts of 1, 2 and 3 or more, from how many words have counts 1 to 4."""
    n1, n2, n3, n4 = (max(0, x) for x in counts)
    usual = [0.75, 1.1, 1.4]
    if not n1 or not n2:
        return usual
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else usual[2]]
    return [min(max(x, 0.1 * k), 0.95 * k) for k, x in enumerate(raw, 1)]


def count_words(rows: DataFrame) -> DataFrame:
    """``word, ordinary, toxic, shared``: distinct words before it, per class and in all."""
    pairs = (rows.select("text", "toxic").mapInArrow(_pairs, "word long, before long, kind int")
             .groupBy("word", "before").agg(F.bit_or("kind").alias("kinds")))
    has = lambda bit: F.sum(F.col("kinds").bitwiseAND(bit) / bit).cast("long")
    return pairs.groupBy("word").agg(has(1).alias("ordinary"), has(2).alias("toxic"), F.count("*").alias("shared"))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", runs=RUNS,
          most_words: int = MOST_WORDS) -> Model:
    """The model of all labelled rows that are not held out."""
    rows = labelled(docs, labels, id_col=id_col, text_col=text_col)
    counts = stage(count_words(rows.filter("part != 4")), "toxic-words")
    classes = ("toxic", "ordinary")
    sums = counts.agg(
        F.count("*").alias("words"), F.coalesce(F.sum("shared"), F.lit(0)).alias("shared"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in classes],
        *[F.count(F.when(F.col(c) == k, 1)).alias(f"{c}{k}") for c in classes for k in (1, 2, 3, 4)],
        *[F.count(F.when(F.col(c) >= 3, 1)).alias(f"{c}_more") for c in classes]).first()
    if not sums["toxic"] or not sums["ordinary"]:
        share = rows.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
        return Model(counts.select("word", F.lit(0.0).alias("llr")), 0, 0.0, None, share)
    base = (F.col("shared") + 0.5) / (sums["shared"] + 0.5 * (sums["words"] + 1))
    logs, held = {}, {}
    for c in classes:
        d1, d2, d3 = discounts([sums[f"{c}{k}"] for k in (1, 2, 3, 4)])
        taken = F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, d1).when(F.col(c) == 2, d2).otherwise(d3)
        held[c] = (d1 * sums[f"{c}1"] + d2 * sums[f"{c}2"] + d3 * sums[f"{c}_more"]) / sums[c]
        logs[c] = F.log((F.col(c) - taken) / F.lit(float(sums[c])) + F.lit(held[c]) * base)
    table = stage(counts.select("word", (logs["toxic"] - logs["ordinary"]).alias("llr")), "toxic-scores")
    model = Model(table, sums["words"], math.log(held["toxic"] / held["ordinary"]), None, 0.0)
    check = rows.filter("part = 4").withColumn("row", F.monotonically_increasing_id())
    parts = stage(compare(check, model, ["toxic"], runs=runs, most_words=most_words), "toxic-fit")
    model.weights = fit(parts, len(runs))
    return model


def fit(rows: DataFrame, count: int, *, rounds: int = 30) -> tuple[float, ...]:
    """Logistic weights (the constant first) of ``features`` for ``toxic``, by Newton steps whose
    sums Spark makes over all rows. Without both classes: the whole text's comparison alone."""
    x = [F.lit(1.0), *[F.col("features")[i] for i in range(count)]]
    kinds = rows.agg(F.min("toxic"), F.max("toxic")).first()
    w = np.zeros(count + 1)
    if kinds[0] is None or kinds[0] == kinds[1]:
        w[-1] = 1.0
        return tuple(w)
    for _ in range(rounds):
        z = sum((F.lit(float(a)) * b for a, b in zip(w, x, strict=True)), F.lit(0.0))
        p = 1 / (1 + F.exp(-z))
        scaled = rows.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], (F.col("toxic") - p).alias("g"), (p * (1 - p)).alias("h"))
        pairs = [(i, j) for i in range(count + 1) for j in range(i + 1)]
        got = scaled.agg(*[F.sum(F.col("g") * F.col(f"x{i}")) for i in range(count + 1)],
                         *[F.sum(F.col("h") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs]).first()
        pull = RIDGE * np.append(0.0, np.ones(count))
        gradient, curve = np.array(got[:count + 1]) - pull * w, np.diag(pull + 1e-9)
        for (i, j), v in zip(pairs, got[count + 1:], strict=True):
            curve[i, j] += v
            if i != j:
                curve[j, i] += v
        step = np.linalg.solve(curve, gradient)
        w = w + step * min(1.0, 20.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return tuple(round(float(v), 9) for v in w)


def features(llr: np.ndarray, runs=RUNS) -> list[float]:
    """The largest mean of ``llr`` over runs of each length (a shorter text: over all of it)."""
    if not len(llr):
        return [0.0] * len(runs)
    sums = np.concatenate([[0.0], np.cumsum(llr)])
    return [float((sums[n:] - sums[:-n]).max()) / n if 0 < n < len(llr) else float(sums[-1]) / len(llr) for n in runs]


def compare(rows: DataFrame, model: Model, keep: list[str], *, runs=RUNS, most_words: int = MOST_WORDS) -> DataFrame:
    """``features`` of each row's ``text``, beside its columns ``keep``. The unique column ``row``
    is used only by the way without a broadcast."""
    fields = {f.name: f for f in rows.schema.fields}
    ddl = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in keep)
    if model.size <= most_words:
        table = model.table.toArrow()
        known = table.column("word").to_numpy()
        order = np.argsort(known)
        sent = rows.sparkSession.sparkContext.broadcast((known[order], table.column("llr").to_numpy()[order]))
        unseen = model.unseen

        def run(c):
            out = []
            known, values = sent.value
            for i, j in turns(c["text"]):
                word, first = words(c["text"][i:j])
                llr = np.full(len(word), unseen)
                if len(known):
                    word = word.view(np.int64)
                    at = np.minimum(np.searchsorted(known, word), len(known) - 1)
                    llr = np.where(known[at] == word, values[at], unseen)
                out += [features(llr[a:b], runs) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            return {**{k: c[k] for k in keep}, "features": out}

        return arrow_rows(rows.select("text", *keep), run, f"{ddl}, features array<double>")

    def spell(c):
        out = []
        for i, j in turns(c["text"]):
            word, first = words(c["text"][i:j])
            signed = word.view(np.int64)
            out += [signed[a:b].tolist() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        return {"row": c["row"], **{k: c[k] for k in keep}, "words": out}

    spelt = stage(arrow_rows(rows.select("text", "row", *keep), spell, f"row long, {ddl}, words array<long>"), "toxic-texts")
    each = spelt.select("row", F.posexplode("words").alias("place", "word")).join(model.table, "word", "left")
    lists = each.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("place", F.coalesce("llr", F.lit(model.unseen)).alias("llr")))).alias("found"))
    joined = spelt.drop("words").join(lists, "row", "left").select(*keep, F.col("found.llr").alias("llr"))

    def sums(c):
        return {**{k: c[k] for k in keep}, "features": [features(np.array(x or [], np.float64), runs) for x in c["llr"]]}

    return arrow_rows(joined, sums, f"{ddl}, features array<double>")


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", runs=RUNS,
          most_words: int = MOST_WORDS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    if model.weights is None:
        found = rows.withColumn("score", F.lit(float(model.share)))
    else:
        parts = compare(rows, model, ["doc_id"], runs=runs, most_words=most_words)
        z = sum((F.lit(a) * F.col("features")[i] for i, a in enumerate(model.weights[1:])), F.lit(model.weights[0]))
        found = parts.withColumn("score", F.round(1 / (1 + F.exp(-z)), 9))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the labels that may be used, then score every row."""
    return score(docs, train(docs, labels, id_col=id_col, text_col=text_col), id_col=id_col, text_col=text_col)
