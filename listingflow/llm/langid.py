"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is the product of its letters'
vectors, each permuted (rolled) by its place; a text is the sum over its n-grams; a language is
the sum over its training texts. A text gets the language whose vector has the largest cosine
with its own. Since products of random vectors are nearly orthogonal, the cosine compares n-gram
profiles, in a vector whose size does not grow with the alphabet.

Defined results: null texts and texts without a letter get ``und`` and score 0; ties go to the
smaller language name; without any labelled text everything is ``und``; copies are scored alike;
an empty table gives an empty table. The score is the cosine, cut at 0.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from listingflow.llm.common import arrow_rows, small

UNKNOWN = "und"
DIMENSIONS = 1024
SYMBOLS = 64            # 0: between words, 1-26: a-z, the rest: other letters, by code point
SEED = 20240607
#: n-gram vectors a worker keeps (one byte a dimension).
KEPT = 40_000


def _symbol(code: int) -> int:
    char = chr(code)
    if not char.isalpha():
        return 0
    if "a" <= char <= "z":
        return code - 96
    return 27 + (code * 2654435761 >> 7) % (SYMBOLS - 27)


class Profiles:
    """Letter vectors, and a memory of the n-gram vectors made of them."""

    def __init__(self, dimensions: int = DIMENSIONS):
        signs = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, dimensions), dtype=np.int8) * 2 - 1
        self.dimensions = dimensions
        self.letters = [np.roll(signs, place, axis=1) for place in (2, 1, 0)]
        self.basic = np.array([_symbol(c) for c in range(0x250)], np.int64)
        self._forget()

    def _forget(self):
        self.row = np.full(SYMBOLS ** 3, -1, np.int32)
        self.vectors, self.used = np.zeros((KEPT, self.dimensions), np.int8), 0

    def ngrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the whole text and their counts, runs of non-letters as one."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.basic[np.minimum(codes, 0x24F)]
        for at in np.flatnonzero(codes >= 0x250):
            symbols[at] = _symbol(int(codes[at]))
        if not symbols.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        padded = np.concatenate([[0], symbols, [0]])
        padded = padded[np.append(True, (padded[1:] != 0) | (padded[:-1] != 0))]
        grams = (padded[:-2] * SYMBOLS + padded[1:-1]) * SYMBOLS + padded[2:]
        counts = np.bincount(grams, minlength=1)
        distinct = np.flatnonzero(counts)
        return distinct, counts[distinct]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, each as often as it is there."""
        out = np.zeros(self.dimensions)
        for at in range(0, len(grams), KEPT // 4):
            part = grams[at:at + KEPT // 4]
            new = part[self.row[part] < 0]
            if len(new):
                if self.used + len(new) > KEPT:
                    self._forget()
                    new = part
                a, b, c = new // SYMBOLS ** 2, new // SYMBOLS % SYMBOLS, new % SYMBOLS
                rows = slice(self.used, self.used + len(new))
                self.vectors[rows] = self.letters[0][a] * self.letters[1][b] * self.letters[2][c]
                self.row[new] = np.arange(rows.start, rows.stop)
                self.used = rows.stop
            out += counts[at:at + KEPT // 4].astype(np.float32) @ self.vectors[self.row[part]].astype(np.float32)
        return out


@functools.lru_cache(maxsize=2)
def _profiles(dimensions: int) -> Profiles:
    return Profiles(dimensions)


def train(labelled: DataFrame, *, dimensions: int = DIMENSIONS) -> dict[str, list[float]]:
    """Language vectors from all rows of ``labelled`` (``text``, ``lang``; rows where either is
    null or the text has no letter teach nothing). Each task counts n-grams per language and
    makes one vector per language of them; the vectors are added up. What reaches the driver is
    one vector per language."""
    rows = labelled.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    schema = "lang string, at int, part double"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        p, totals = _profiles(dimensions), {}
        for batch in small(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, counts = p.ngrams(text)
                if len(grams):
                    total = totals.setdefault(lang, np.zeros(SYMBOLS ** 3, np.int64))
                    total[grams] += counts
        for lang, total in totals.items():
            grams = np.flatnonzero(total)
            vector = p.bundle(grams, total[grams])
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * dimensions, "at": list(range(dimensions)), "part": vector.tolist()}, schema=target)

    sums = rows.mapInArrow(run, schema).groupBy("lang", "at").agg(F.sum("part").alias("part"))
    learned = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("v")).collect()
    return {r["lang"]: [x["part"] for x in r["v"]] for r in learned}


def _told(languages: dict[str, list[float]], dimensions: int):
    """Function of a text: its language and score."""
    names = sorted(languages)
    vectors = np.array([languages[n] for n in names]).reshape(len(names), dimensions)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)

    def told(text):
        p = _profiles(dimensions)
        grams, counts = p.ngrams(text)
        if not len(grams) or not names:
            return UNKNOWN, 0.0
        own = p.bundle(grams, counts)
        cosines = vectors @ own / max(float(np.linalg.norm(own)), 1e-300)
        best = int(np.argmax(cosines))
        return names[best], min(1.0, max(0.0, float(cosines[best])))

    return told


def predict(docs: DataFrame, languages: dict[str, list[float]], *, dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text. A narrow map; only the text is used."""
    told = _told(languages, dimensions)

    def run(rows):
        found = [told(text) for text in rows["text"]]
        return {"doc_id": rows["doc_id"], "lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    return arrow_rows(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, languages: dict[str, list[float]], *, text_col: str = "text",
                  dimensions: int = DIMENSIONS) -> DataFrame:
    """The rows whose language is told, unchanged; rows that would get ``und`` go."""
    columns = docs.columns
    told = _told(languages, dimensions)

    def run(batches):
        for batch in small(batches):
            texts = batch.column(columns.index(text_col)).to_pylist()
            yield batch.filter(pa.array([told(t)[0] != UNKNOWN for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id) -> F.Column:
    """Rows kept from training: crc32 of the id as text leaves remainder 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, *, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the labelled rows that are not held out, then predict every row:
    ``doc_id, held_out, lang_pred, score``. A null id is not held out."""
    languages = train(docs.filter(~held_out("doc_id")), dimensions=dimensions)
    return (predict(docs, languages, dimensions=dimensions)
            .select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"))
