"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a byte string, exactly one token can be the last one of the correct encoding of each prefix:
the longest token ``t`` ending there such that the last token of the prefix before it and ``t``
may stand side by side (merging the bytes of the two gives the two back). Storing that token per
prefix makes appends exact (only new prefixes are computed) and lets an edit re-encode from the
edited byte on, up to where the table agrees with the old one again. The text is first cut by the vocabulary's pattern; pieces are independent.

Defined results: null or empty text has no tokens (digest of zero bytes); copies and ties need no
rule since each document is encoded alone; an empty table gives an empty table; other columns of
the input are not looked at. A vocabulary without all 256 single bytes is refused.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import arrow_rows

#: Distinct pieces (words) whose encoding one worker remembers; beyond it the memory starts anew.
PIECE_MEMORY = 600_000
#: Longest piece (bytes) that is encoded together with others.
SHORT = 32
#: The pattern of the public rank files, for which texts may be cut at single spaces first.
SPACED = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
          r"|\s+(?!\S)|\s+")
#: Characters of text whose pieces are looked up together.
TURN = 4_000_000


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary: ``ranks[bytes] = id``, lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 single bytes")
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, filter(None, lines))})

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token`` (itself twice for a single byte); ``None``
        when merging the token's own bytes never gives it."""
        if token not in self._parts:
            word = self.tokens[token]
            at = [word[i:i + 1] for i in range(len(word))]
            while len(at) > 2:
                best = min(range(len(at) - 1), default=None,
                           key=lambda i: self.ranks.get(at[i] + at[i + 1], 1 << 60))
                if self.ranks.get(at[best] + at[best + 1], 1 << 60) >= token:
                    break
                at[best:best + 2] = [at[best] + at[best + 1]]
            if len(at) == 1:
                self._parts[token] = (token, token)
            else:
                self._parts[token] = (self.ranks[at[0]], self.ranks[at[1]]) if len(at) == 2 else None
        return self._parts[token]

    def side_by_side(self, left: int, right: int) -> bool:
        """True if merging the bytes of the two tokens gives the two tokens.

        Undo the latest merge of the two again and again, looking only at the tokens that touch
        the border. If at any moment the touching tokens would have merged before the merge that
        was just undone, the border could not have survived.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) > PIECE_MEMORY:
            self.pairs.clear()
        ranks, tokens, fine, undone = self.ranks, self.tokens, True, 1 << 60
        while True:
            if ranks.get(tokens[left] + tokens[right], 1 << 60) < undone:
                fine = False
                break
            single_l, single_r = len(tokens[left]) == 1, len(tokens[right]) == 1
            if single_l and single_r:
                break
            # Of equal ranks the left one merged first, so the right one is undone first.
            if not single_l and (single_r or left > right):
                undone, left = left, self.parts(left)[1]
            else:
                undone, right = right + 1, self.parts(right)[0]
        self.pairs[key] = fine
        return fine


class PrefixEncoder:
    """Encoding of one growing byte string; ``last[i]`` is the last token of the first i bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> int:
        """Add bytes; the stored prefixes stay valid. Returns the number of prefixes computed."""
        self.data += more
        return self._complete()

    def edit(self, at: int, removed: int, added: bytes) -> int:
        """Replace ``removed`` bytes at ``at`` by ``added``. Prefixes before ``at`` are reused, and so
        are those after the place from which the table agrees with the old one. Returns the number
        of prefixes computed."""
        removed = min(removed, len(self.data) - at)
        old, rest = self.last, self.data[at + removed:]
        self.data, self.last = self.data[:at], old[:at + 1]
        computed = self.append(added)
        self.data += rest
        return computed + self._complete(old, len(added) - removed)

    def _complete(self, old: list[int] | None = None, shift: int = 0) -> int:
        """Compute the missing prefixes. A prefix depends on as many places as the longest token has
        bytes: once these all agree with ``old``, ``shift`` places before, so does all that follows."""
        v = self.vocabulary
        data, last, ranks, fits = self.data, self.last, v.ranks, v.side_by_side
        first = len(last)
        same = int(old is not None and last[-1] == old[first - 1 - shift])
        for end in range(first, len(data) + 1):
            for at in range(max(0, end - v.longest), end):
                token = ranks.get(data[at:end])
                if token is not None and (fits(last[at], token) if at else v.parts(token)):
                    last.append(token)
                    break
            if old is not None:
                same = same + 1 if token == old[end - shift] else 0
                if same >= v.longest:
                    last += old[end - shift + 1:]
                    return end + 1 - first
        return len(data) + 1 - first

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.tokens[self.last[end]])
        return out[::-1]


class PieceTable:
    """The prefix table of many short pieces at once, one array operation per (start, end).

    Slices are looked up by a 64-bit hash; a piece whose tokens do not give its bytes back (a
    hash collision) is encoded again by ``PrefixEncoder``.
    """

    SLOTS = 1 << 20

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.powers = np.cumprod(np.full(SHORT, self.base, np.uint64), dtype=np.uint64)
        words = [(i, t) for t, i in v.ranks.items() if len(t) <= SHORT]
        hashes = np.zeros(len(words), np.uint64)
        for n in {len(t) for _, t in words}:
            rows = [k for k, (_, t) in enumerate(words) if len(t) == n]
            hashes[rows] = self._prefixes(b"".join(words[k][1] for k in rows), n)[-1]
        order = np.argsort(hashes)
        self.hashes = np.append(hashes[order], np.uint64(0))
        self.ids = np.array([i for i, _ in words], np.int64)[order]
        first = np.arange(self.SLOTS + 1, dtype=np.uint64) << np.uint64(44)
        self.first = np.searchsorted(self.hashes[:-1], first[:-1])
        self.deepest = int(np.bincount((self.hashes[:-1] >> np.uint64(44)).astype(np.int64)).max())
        # Answers of side_by_side, one per slot; what is not there is asked again.
        self.pair_key = np.full(self.SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(self.SLOTS, bool)

    def _prefixes(self, joined: bytes, n: int) -> list[np.ndarray]:
        columns = np.frombuffer(joined, np.uint8).reshape(-1, n).T.astype(np.uint64)
        out = [np.zeros(columns.shape[1], np.uint64)]
        for column in columns:
            out.append((out[-1] + column + np.uint64(1)) * self.base)
        return out

    def _tokens(self, hashes: np.ndarray) -> np.ndarray:
        at = self.first[(hashes >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(hashes), -1, np.int64)
        for step in range(self.deepest):
            where = np.minimum(at + step, len(self.ids))
            hit = np.flatnonzero(self.hashes[where] == hashes)
            hit = hit[where[hit] < len(self.ids)]
            out[hit] = self.ids[where[hit]]
        return out

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        slot = ((key.astype(np.uint64) * self.base) >> np.uint64(44)).astype(np.int64)
        missing = np.flatnonzero(self.pair_key[slot] != key)
        fine = self.pair_fits[slot]
        if len(missing):
            asked, back = np.unique(key[missing], return_inverse=True)
            answers = np.array([self.vocabulary.side_by_side(int(k) >> 32, int(k) & 0xFFFFFFFF)
                                for k in asked], bool)
            fine[missing] = answers[back]
            self.pair_key[slot[missing]] = key[missing]
            # Of several keys that share a slot the last one written stays.
            keep = missing[self.pair_key[slot[missing]] == key[missing]]
            self.pair_fits[slot[keep]] = fine[keep]
        return fine

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(k)
        for n, rows in by_length.items():
            if n > SHORT:
                for k in rows:
                    out[k] = array("I", PrefixEncoder(self.vocabulary, pieces[k]).ids()).tobytes()
            elif n:
                for k, packed in zip(rows, self._same_length([pieces[k] for k in rows], n), strict=True):
                    out[k] = packed
        return out

    def _same_length(self, pieces: list[bytes], n: int) -> list[bytes]:
        v, m = self.vocabulary, len(pieces)
        prefix = self._prefixes(b"".join(pieces), n)
        last = np.full((n + 1, m), -1, np.int64)
        start = np.zeros((n + 1, m), np.int64)
        for end in range(1, n + 1):
            open_rows = np.arange(m)
            for at in range(end):
                hashes = prefix[end][open_rows] - prefix[at][open_rows] * self.powers[end - at - 1]
                token = self._tokens(hashes)
                some = np.flatnonzero(token >= 0)
                if at:
                    some = some[self._fits(last[at][open_rows[some]], token[some])]
                else:
                    whole = {int(t): v.parts(int(t)) is not None for t in np.unique(token[some])}
                    some = some[[whole[int(t)] for t in token[some]]] if len(some) else some
                rows = open_rows[some]
                last[end, rows], start[end, rows] = token[some], at
                open_rows = np.delete(open_rows, some)
                if not len(open_rows):
                    break
        # Walk back from the end; tokens come out last first.
        at, rows, steps = np.full(m, n), np.arange(m), []
        while (at > 0).any():
            steps.append(np.where(at > 0, last[at, rows], -1))
            at = np.where(at > 0, start[at, rows], 0)
        ids = np.array(steps[::-1]).T
        packed = ids[ids >= 0].astype("<u4").tobytes()
        ends = np.cumsum((ids >= 0).sum(axis=1)) * 4
        found, begin, out = v.tokens, 0, []
        for piece, row, end in zip(pieces, ids.tolist(), ends.tolist(), strict=True):
            one, begin = packed[begin:end], end
            if b"".join([found[t] for t in row if t >= 0]) != piece:
                one = array("I", PrefixEncoder(v, piece).ids()).tobytes()
            out.append(one)
        return out


class Codec:
    """Text to packed little-endian 32-bit ids, and back to bytes."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.cut = vocabulary, regex.compile(pattern).findall
        self.table = PieceTable(vocabulary)
        self.units: dict[str, bytes] = {}
        self.crowded = re.compile(r"\s |\s\Z| \s").search if pattern == SPACED else None
        order = [vocabulary.tokens.get(i, b"") for i in range(max(vocabulary.tokens) + 1)]
        self._bytes = np.frombuffer(b"".join(order), np.uint8)
        self._long = np.fromiter(map(len, order), np.int64, len(order))
        self._from = np.cumsum(self._long) - self._long

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def _cut_units(self, text: str) -> list[str]:
        """Texts between single spaces, each but the first with its space: no match of ``SPACED``
        goes across a space with a non-blank on both sides. Other patterns: the matches."""
        if self.crowded is None or self.crowded(text):
            return self.cut(text)
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.cut(text)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; each distinct new piece is encoded once."""
        cut = [self._cut_units(text or "") for text in texts]
        if len(self.units) > PIECE_MEMORY:
            self.units.clear()
        new = list(set().union(*cut).difference(self.units))
        pieces = [self.cut(unit) for unit in new]
        known = dict.fromkeys(piece for unit in pieces for piece in unit)
        data, ranks = [p.encode("utf-8", "surrogatepass") for p in known], self.vocabulary.ranks
        packed = self.table.encode([b"" if d in ranks else d for d in data])
        for piece, d, ids in zip(known, data, packed, strict=True):  # a piece that is a token stays one
            known[piece] = ids or array("I", [ranks[d]]).tobytes()
        for unit, own in zip(new, pieces, strict=True):
            self.units[unit] = known[own[0]] if len(own) == 1 else b"".join([known[p] for p in own])
        return [b"".join(map(self.units.__getitem__, units)) for units in cut]

    def in_turns(self, texts: list[str | None]):
        """Packed ids of each text, taking about ``TURN`` characters of texts at a time."""
        turn, size = [], 0
        for text in texts:
            turn.append(text)
            size += len(text or "")
            if size >= TURN:
                yield from self.encode_all(turn)
                turn, size = [], 0
        yield from self.encode_all(turn)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        long = self._long[ids]
        ends = np.cumsum(long)
        at = np.repeat(self._from[ids] - (ends - long), long)
        at += np.arange(len(at))
        return self._bytes[at].tobytes()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process; each worker reads the vocabulary at ``path`` itself."""
    return Codec(Vocabulary.read(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and,
    with ``with_ids``, the packed ids (binary). A narrow map: no shuffle, one document at a time."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(rows):
        c = codec(path, pattern)
        out = {"doc_id": rows["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for packed in c.in_turns(rows["text"]):
            out["n_tokens"].append(len(packed) // 4)
            out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode(packed)).hexdigest())
            if with_ids:
                out["ids"].append(packed)
        return out

    return arrow_rows(narrow, run, schema + (", ids binary" if with_ids else ""))
