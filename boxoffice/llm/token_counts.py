"""Token counts: greedy word-piece lengths by a linear longest-match automaton.

The vocabulary's trie gets, for every node, a failure link and the number of
pieces that following the link completes. A text is then read once, byte by
byte; whenever the trie has no edge, the node's count is added and its link
followed. No piece is ever built, and no byte is read twice.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
# Lengths of short words are remembered, at most so many at a time.
REMEMBERED_WORDS, REMEMBERED_BYTES = 200_000, 40
ROOT, NONE = 0, -1


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class LongestMatch(dict):
    """Piece counts of words under greedy longest match; a dict that remembers short words.

    ``pieces`` must hold every single byte, so that each word can be matched.
    """

    def __init__(self, pieces) -> None:
        super().__init__()
        edges: dict[int, int] = {}  # node * 256 + byte -> node
        parent, label, ends = [NONE], [0], [False]
        for piece in pieces:
            node = ROOT
            for byte in piece:
                key = node << 8 | byte
                if key not in edges:
                    edges[key] = len(parent)
                    parent.append(node)
                    label.append(byte)
                    ends.append(False)
                node = edges[key]
            ends[node] = node != ROOT
        if any(not ends[edges[b]] if b in edges else True for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        self.edges, self.link, self.popped = edges, [NONE] * len(parent), [0] * len(parent)
        depth = [0] * len(parent)
        for node in range(1, len(parent)):  # a parent has a smaller number
            depth[node] = depth[parent[node]] + 1
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if ends[node]:
                self.link[node], self.popped[node] = ROOT, 1
                continue
            at, count = self.link[parent[node]], self.popped[parent[node]]
            while (at << 8 | label[node]) not in edges:
                at, count = self.link[at], count + self.popped[at]
            self.link[node], self.popped[node] = edges[at << 8 | label[node]], count

    def count(self, data: bytes) -> int:
        edges, link, popped = self.edges, self.link, self.popped
        node = total = ROOT
        for byte in data:
            while (following := edges.get(node << 8 | byte)) is None:
                total += popped[node]
                node = link[node]
            node = following
        while node != ROOT:
            total += popped[node]
            node = link[node]
        return total

    def __missing__(self, word: bytes) -> int:
        count = self.count(b" " + word)
        if len(word) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = count
        return count

    def of_text(self, text: str | None) -> tuple[int, int]:
        """(words, pieces) of a whole text."""
        words = (text or "").encode().split()
        return len(words), sum(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def matcher(path: str) -> LongestMatch:
    return LongestMatch(read_ranks(path))


def token_counts(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Struct of n_words and n_tokens of a text.

    Words are runs without ASCII white space. A word's pieces are those of a
    space and the word under greedy longest match: the first piece is one that
    begins a word, the others continue it. Null and empty texts count 0.
    """
    path = vocabulary_path(vocabulary)

    @F.pandas_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]))
    def counted(texts: pd.Series) -> pd.DataFrame:
        of = matcher(path).of_text
        return pd.DataFrame([of(t) for t in texts], columns=["n_words", "n_tokens"])

    return counted(text)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words and n_tokens of every row; a repeated row gives a row again."""
    counts = token_counts(F.col("text"), vocabulary)
    return docs.select("doc_id", counts.alias("counts")).select("doc_id", "counts.*")
