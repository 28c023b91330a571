"""Language ID: held-out accuracy, direct cosines, defined cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from listingflow.llm import langid
from llm_rows import frame, rows, table


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs).withColumnRenamed("lang_pred", "p").join(docs.select("doc_id", "lang"), "doc_id")
    r = out.filter("held_out").agg(F.avg((F.col("p") == F.col("lang")).cast("double")), F.count("*")).first()
    assert r[1] > 200 and r[0] > 0.95


def direct(text, dimensions):
    """Sum of permuted letter products, n-gram by n-gram."""
    signs = np.random.default_rng(langid.SEED).integers(0, 2, (langid.SYMBOLS, dimensions), dtype=np.int8) * 2 - 1
    symbols = [0]
    for char in text.lower():
        s = langid._symbol(ord(char))
        if s or symbols[-1]:
            symbols.append(s)
    if symbols[-1]:
        symbols.append(0)
    out = np.zeros(dimensions)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        out += np.roll(signs[a], 2) * np.roll(signs[b], 1) * signs[c]
    return out


def test_equals_direct_profiles_and_defined_cases(spark):
    data = rows()
    got = table(langid.identify(frame(spark, data, clash=True), dimensions=256), "doc_id")
    protos = {}
    for doc_id, text, lang, *_ in data:
        if lang and zlib.crc32(str(doc_id).encode()) % 3 != 1 and any(c.isalpha() for c in text or ""):
            protos[lang] = protos.get(lang, 0) + direct(text, 256)
    names = sorted(protos)
    for doc_id, text, *_ in data:
        held, lang, score = got[doc_id]
        assert held == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        if not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0.0)
            continue
        own = direct(text, 256)
        cosines = [own @ protos[n] / np.linalg.norm(own) / np.linalg.norm(protos[n]) for n in names]
        best = int(np.argmax(cosines))
        assert abs(score - max(0, min(1, cosines[best]))) < 1e-5
        assert lang == names[best] or abs(cosines[names.index(lang)] - cosines[best]) < 1e-6


def test_without_labels_and_empty(spark):
    data = [(i, t, None, s, n) for i, t, _, s, n in rows()]
    assert {r["lang_pred"] for r in langid.identify(frame(spark, data)).collect()} == {"und"}
    assert langid.identify(frame(spark, [])).count() == 0


def test_prediction_uses_the_text_alone(spark):
    data = rows()
    languages = langid.train(frame(spark, data))
    one = table(langid.predict(frame(spark, data), languages), "doc_id")
    other = [(i + 7, t, "zz", "q", 0) for i, t, *_ in data]
    two = table(langid.predict(frame(spark, other), languages), "doc_id")
    assert all(one[i] == two[i + 7] for i in one)


def test_rows_kept_are_those_with_a_predicted_language(spark):
    data = [(i, t, lang and lang.replace("aa", "und"), s, n) for i, t, lang, s, n in rows()]
    docs = frame(spark, data)
    languages = langid.train(docs)
    told = {i for i, (lang, _) in table(langid.predict(docs, languages), "doc_id").items() if lang != "und"}
    kept = {r["doc_id"] for r in langid.with_language(docs, languages).collect()}
    assert kept == told
    assert 0 < len(kept) < sum(any(c.isalpha() for c in t or "") for _, t, *_ in data)
