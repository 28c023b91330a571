"""Token counts: greedy longest-match word pieces counted by a linear automaton.

The vocabulary is a byte trie. Matching walks the trie; where no child fits, the walk would have
to take the longest token found so far and start again behind it. A failure link goes straight
to the node that the rest of the walked bytes would reach, and each link knows how many tokens
were taken ("popped") on the way. So each byte is read once and only counts are kept: no piece is
ever built. With all 256 single bytes in the vocabulary every word has a greedy cover.

Defined results: null, empty and blank texts have 0 words and 0 pieces; copies and ties need no
rule; an empty table gives an empty table; other input columns are not looked at.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import arrow_rows

#: Distinct words whose count one worker remembers; beyond it the memory starts anew.
WORD_MEMORY = 500_000


class LongestMatch:
    """Trie with failure links and popped-token counts over byte tokens."""

    def __init__(self, tokens):
        self.child: list[dict[int, int]] = [{}]
        self.ends = [False]
        parent, byte = [0], [0]
        for token in tokens:
            node = 0
            for b in token:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.ends.append(False)
                    parent.append(node)
                    byte.append(b)
                node = nxt
            if node:
                self.ends[node] = True
        # fail[v]: where the rest of v's bytes leads once no child fits; popped[v]: tokens taken
        # on the way there. -1: the bytes cannot be covered.
        n = len(self.child)
        self.fail, self.popped = [-1] * n, [0] * n
        level = list(self.child[0].values())
        while level:
            for v in level:
                if self.ends[v]:
                    self.fail[v], self.popped[v] = 0, 1
                    continue
                u, b = parent[v], byte[v]
                z, taken = self.fail[u], self.popped[u]
                while z >= 0 and b not in self.child[z]:
                    taken += self.popped[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.popped[v] = self.child[z][b], taken
            level = [c for v in level for c in self.child[v].values()]

    def count(self, word: bytes) -> int:
        """Greedy longest-match tokens of the word; -1 if it has no greedy cover."""
        child, fail, popped = self.child, self.fail, self.popped
        node = total = 0
        for b in word:
            while (nxt := child[node].get(b)) is None:
                if node == 0 or fail[node] < 0:
                    return -1
                total += popped[node]
                node = fail[node]
            node = nxt
        while node:
            if fail[node] < 0:
                return -1
            total += popped[node]
            node = fail[node]
        return total


class _Counts(dict):
    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word.encode("utf-8", "surrogatepass"))
        # A word without a cover is one unknown token.
        self[word] = n = 1 if n < 0 else n
        return n


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str):
    with open(path, "rb") as lines:
        automaton = LongestMatch(base64.b64decode(x.split()[0]) for x in lines if x.strip())
    return _Counts(automaton), regex.compile(pattern).findall


def count_tokens(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, max_word_tokens`` of every whole text: words are the matches
    of ``pattern``, tokens their greedy longest-match pieces. A narrow map without a shuffle."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(rows):
        counts, cut = _counter(path, pattern)
        out = {"doc_id": rows["doc_id"], "n_words": [], "n_tokens": [], "max_word_tokens": []}
        for text in rows["text"]:
            if len(counts) > WORD_MEMORY:
                counts.clear()
            each = list(map(counts.__getitem__, cut(text or "")))
            out["n_words"].append(len(each))
            out["n_tokens"].append(sum(each))
            out["max_word_tokens"].append(max(each, default=0))
        return out

    return arrow_rows(narrow, run, "doc_id long, n_words long, n_tokens long, max_word_tokens long")
