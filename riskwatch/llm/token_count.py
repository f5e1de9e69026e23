"""Token counts of a unigram segmentation by dynamic programming over a trie.

A pre-token is a run without white space, with the space mark before it. Its
segmentation is the one with the highest sum of piece scores, and of equally
high ones that with the fewest tokens. The best score of a prefix only depends
on the prefix, so the new distinct pre-tokens of a batch are walked as a trie, in
sorted order: what two neighbours share is kept on a stack, and scores are
computed once for each trie node. The counts at the ends of pre-tokens are
stored, and a document's count is the sum over its pre-tokens.

Everything happens where a document is read; nothing is shuffled. Memory holds one
batch and a bounded store of counts.

Defined results: a null or empty text, or one of white space, has no tokens. A
character that is no piece is coded by its UTF-8 bytes, a token each, at a
score below all pieces. Rows stay one to one; other columns are left out.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col, map_arrow, small_batches, texts

SPACE = "\u2581"
BYTE_PENALTY = 10.0
"""A byte's score lies so far under the lowest piece's."""


class UnigramCounter:
    entries, kept = 800_000, 400_000
    """Counts remembered; beyond that the first met, which are the frequent ones, stay (results do not change)."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.byte_score = min(pieces.values(), default=0.0) - BYTE_PENALTY
        self.root: dict = {}
        for piece, score in pieces.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score
        self.counts: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Store the counts of words, which must be sorted: one walk over their trie."""
        root, counts = self.root, self.counts
        # at each depth of the path: best (score, tokens), and pieces begun and not ended (best at their start, node)
        best: list[tuple[float, int]] = []
        begun: list[list[tuple[float, int, dict]]] = []

        def push(c: str) -> None:
            score, tokens = best[-1]
            going, found = [], None
            for from_score, from_tokens, node in (*begun[-1], (score, tokens, root)):
                node = node.get(c)
                if node is not None:
                    going.append((from_score, from_tokens, node))
                    end = node.get("")
                    if end is not None and (found is None or (from_score + end, -from_tokens - 1) > found):
                        found = (from_score + end, -from_tokens - 1)
            if c not in self.pieces:
                size = len(c.encode())
                by_bytes = (score + size * self.byte_score, -tokens - size)
                found = by_bytes if found is None or by_bytes > found else found
            best.append((found[0], -found[1]))
            begun.append(going)

        last = ""
        best.append((0.0, 0))
        begun.append([])
        push(SPACE)
        for word in words:
            shared = len(os.path.commonprefix((last, word)))
            del best[shared + 2:], begun[shared + 2:]
            for c in word[shared:]:
                push(c)
            counts[word] = best[-1][1]
            last = word

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        if len(self.counts) > self.entries:
            self.counts = dict(islice(self.counts.items(), self.kept))
        words = [x.split() for x in texts]
        self.learn(sorted(set(chain.from_iterable(words)).difference(self.counts)))
        look = self.counts.__getitem__
        return [(len(x), sum(map(look, x))) for x in words]


_counters: dict[str, UnigramCounter] = {}


def counter(path: str) -> UnigramCounter:
    """The worker's counter for a sentencepiece model's pieces and scores; loaded once."""
    if path not in _counters:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        _counters[path] = UnigramCounter({model.id_to_piece(i): model.get_score(i) for i in plain})
    return _counters[path]


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """document id, n_pre_tokens, n_tokens of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in small_batches(batches, "t", 8 << 20):
            words, tokens = zip(*count(texts(batch.column("t"))), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                [id_col, "n_pre_tokens", "n_tokens"])

    docs = df.select(col(id_col).alias("k"), col(text_col).cast("string").alias("t"))
    return map_arrow(docs, run, f"`{id_col}` {docs.schema['k'].dataType.simpleString()}, n_pre_tokens long, n_tokens long")
