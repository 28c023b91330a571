"""Byte-level BPE against the public tokenizer library, greedy counts against a direct cover."""

import base64
import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from listingflow.llm import bpe, tokencount
from llm_rows import frame, rows, table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_form_matches_the_library_on_every_case(spark, library):
    data = rows()
    got = table(bpe.encode_documents(frame(spark, data, clash=True), PATH, public_tokenizers.PATTERN), "doc_id")
    assert len(got) == len(data)
    for doc_id, text, *_ in data:
        ids = library.encode_ordinary(text or "")
        packed = array("I", ids).tobytes()
        assert got[doc_id] == (len(ids), hashlib.sha256(packed).hexdigest(),
                               hashlib.sha256((text or "").encode()).hexdigest())


def test_ids_column_and_empty_table(spark):
    data = [(1, "hello world", None, None, None), (1, "hello world", None, None, None)]
    out = bpe.encode_documents(frame(spark, data), PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(out) == 2 and out[0]["ids"] == out[1]["ids"] and len(out[0]["ids"]) == 4 * out[0]["n_tokens"]
    assert bpe.encode_documents(frame(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_odd_white_space_and_long_pieces(library):
    codec = bpe.codec(PATH, public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\tab's.,1é  \x1c\x85 ") for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["ab" * 300, " " * 150 + "x", "é" * 200, "\x00\x00 a"]
    for text, packed in zip(texts, codec.in_turns(texts), strict=True):
        assert packed == array("I", library.encode_ordinary(text)).tobytes()
        assert codec.decode(packed) == text.encode()


def test_appends_and_edits_equal_a_new_encoding():
    v = bpe.codec(PATH, public_tokenizers.PATTERN).vocabulary
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"abetion st") for _ in range(rng.randrange(1, 30)))
        more = bytes(rng.choice(b"abetion st") for _ in range(rng.randrange(8)))
        encoder = bpe.PrefixEncoder(v, data)
        encoder.append(more)
        assert encoder.ids() == bpe.PrefixEncoder(v, data + more).ids()
        at = rng.randrange(len(data))
        encoder = bpe.PrefixEncoder(v, data)
        encoder.edit(at, 2, more)
        assert encoder.ids() == bpe.PrefixEncoder(v, data[:at] + more + data[at + 2:]).ids()


def test_an_edit_computes_near_places_only():
    v = bpe.codec(PATH, public_tokenizers.PATTERN).vocabulary
    rng = random.Random(5)
    data = bytes(rng.choice(b"abetion st") for _ in range(4000))
    encoder = bpe.PrefixEncoder(v, data)
    for _ in range(40):
        at, removed = rng.randrange(len(data)), rng.randrange(4)
        more = bytes(rng.choice(b"abetion st") for _ in range(rng.randrange(4)))
        computed = encoder.edit(at, removed, more)
        data = data[:at] + more + data[at + removed:]
        assert encoder.data == data and encoder.ids() == bpe.PrefixEncoder(v, data).ids()
        assert computed <= len(more) + 3 * v.longest
    # Bytes that never agree again are all computed: what a run of one letter splits into moves on.
    run = bpe.PrefixEncoder(v, b"x" * 1500)
    run.edit(0, 0, b"x")
    assert run.ids() == bpe.PrefixEncoder(v, b"x" * 1501).ids()


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})


def greedy(word, tokens):
    n, at = 0, 0
    while at < len(word):
        size = next((k for k in range(min(len(word) - at, 130), 0, -1) if word[at:at + k] in tokens), 0)
        if not size:
            return -1
        n, at = n + 1, at + size
    return n


def test_automaton_equals_greedy_cover_on_random_vocabularies():
    rng = random.Random(5)
    for _ in range(300):
        tokens = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))}
        automaton = tokencount.LongestMatch(sorted(tokens))
        for _ in range(20):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 14)))
            assert automaton.count(word) == greedy(word, tokens)


def test_counts_of_every_case(spark, library):
    import regex
    tokens = {base64.b64decode(x.split()[0]) for x in open(PATH, "rb")}
    data = rows()
    out = tokencount.count_tokens(frame(spark, data, clash=True), PATH, public_tokenizers.PATTERN)
    got = table(out, "doc_id")
    for doc_id, text, *_ in data:
        each = [greedy(p.encode(), tokens) for p in regex.findall(public_tokenizers.PATTERN, text or "")]
        assert got[doc_id] == (len(each), sum(each), max(each, default=0))
    assert tokencount.count_tokens(frame(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
