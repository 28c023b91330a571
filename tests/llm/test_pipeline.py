"""The corpus pipeline: every stage against a brute-force version on its own input."""

import hashlib
from collections import Counter

import corpus_pipeline as pipeline
from llm_rows import frame, rows
from test_pipeline_near import groups
from test_repeats import brute
from listingflow.llm import mixing, suffixdedup
from listingflow.session import stage


def collected(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_in_turn(spark):
    docs = frame(spark, rows())
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["language", "near_duplicates", "repeated_strings", "source_mix", "tokens"]
    step = dict(pipeline.STAGES)

    out = stage(step["language"](spark, docs, None))
    before, after = collected(docs), collected(out)
    assert out.columns == docs.columns
    assert sorted(after, key=repr) == sorted((r for r in before if any(c.isalpha() for c in r[1] or "")), key=repr)

    docs, before = out, after
    out = stage(step["near_duplicates"](spark, docs, None))
    after = collected(out)
    least = groups(before, pipeline.GRAM, pipeline.PERCENT)
    assert sorted(after) == sorted(r for r in before if least[r[0]] == r[0])

    docs, before = out, after
    out = stage(step["repeated_strings"](spark, docs, None))
    after = {r[0]: r for r in collected(out)}
    data = [(r[1] or "").encode() for r in before]
    for row, text, gone in zip(before, data, brute(data, suffixdedup.LENGTH), strict=True):
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g).decode("utf-8", "ignore")
        assert after[row[0]] == (row[0], kept, row[2], row[3], len(kept))

    docs, before = out, list(after.values())
    out = stage(step["source_mix"](spark, docs, None))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert Counter(collected(out)) == Counter({r: copies[r[0]] for r in before if copies[r[0]]})

    docs, before = out, collected(out)
    out = step["tokens"](spark, docs, None).collect()
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in out) == Counter(
        (r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in before)


def test_run_over_a_whole_table(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0


def test_stages_take_empty_tables_and_clashing_names(spark):
    for data, clash in (([], False), (rows(2), True)):
        docs = frame(spark, data, clash=clash)
        for _, step in pipeline.STAGES[:-1]:
            docs = stage(step(spark, docs, None))
        assert docs.columns == frame(spark, [], clash=clash).columns
        assert bool(data) == bool(pipeline.STAGES[-1][1](spark, docs, None).count())
