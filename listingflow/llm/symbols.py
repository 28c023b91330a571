"""Texts as number arrays: bytes or word hashes, window hashes and sliding minima."""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
ODD_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2 ** 63, 256, dtype=U) * U(2) + U(1)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: For the last eight bytes of a word: the bytes that are there (little-endian).
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
LONG_WORD = 512         # bytes from which on a word is hashed by itself
#: Bytes of text that are worked on together.
TURN = 1 << 18

_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, TURN + 1)
        for name, base in (("up", ODD), ("down", ODD_INVERSE)):
            table = np.full(size, base, U)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=U)
    return _powers["up"][:n], _powers["down"][:n]


def powers_down(n: int) -> np.ndarray:
    """ODD ** -place for n places."""
    return _power_tables(n)[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(29)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(32)
    return x


def turns(texts: list[str | None]):
    """Index ranges of texts that together have about ``TURN`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= TURN:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def joined_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and where each text starts (one more at the end)."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum([len(d) for d in data], out=starts[1:])
    return np.frombuffer(b"".join(data), np.uint8), starts


def word_places(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of the words of all texts, and each text's first word (one more at the end)."""
    word = ~BLANK[data]
    head = word.copy()
    head[1:] &= ~word[:-1]
    edge = starts[1:-1]
    edge = edge[edge < len(data)]
    head[edge] |= word[edge]
    tail = word.copy()
    tail[:-1] &= ~word[1:]
    edge = edge[edge > 0] - 1
    tail[edge] |= word[edge]
    begin, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return begin, end, np.searchsorted(begin, starts)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value * ODD ** place before each place: from these, any window's hash is a
    difference, moved to place 0 (arithmetic modulo 2 ** 64)."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * _power_tables(len(values))[0], out=sums[1:])
    return sums


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range: eight bytes at a time go through ``mix``, so no periodic
    pattern of bytes cancels out (as it could in sums of powers); long ranges by a library hash."""
    size = end - begin
    out = mix(size.astype(U) * ODD + U(1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1), writeable=False)
    for i in np.flatnonzero(size > LONG_WORD):
        whole = hashlib.blake2b(data[begin[i]:end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(whole, "little")
    left = np.flatnonzero(size <= LONG_WORD)
    at = begin[left]
    while len(left):
        rest = end[left] - at
        block = eight[at].view(U).ravel() & MASKS[np.minimum(rest, 8)]
        out[left] = mix(out[left] ^ block)
        more = rest > 8
        left, at = left[more], at[more] + 8
    return out


def window_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` values, from their ``prefix_sums``."""
    n = max(0, len(sums) - k)
    out = sums[k:] - sums[:n]
    out *= _power_tables(n)[1]
    return mix(out)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` neighbours."""
    m, part = 1, values
    while m * 2 <= w:
        part = np.minimum(part[:-m], part[m:])
        m *= 2
    return np.minimum(part[:len(values) - w + 1], part[w - m:]) if m < w else part
