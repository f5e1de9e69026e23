"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that no neighbouring word extends, of at least ``EXPONENT`` periods and
``WORDS`` words.

The word numbers of a batch of texts are recompressed: block compression gives every
maximal repetition of one symbol a name of its own, pair compression then splits the
symbols into left and right ones and names every pair of a left and a right symbol,
and so on up to one symbol. The rules are a run-length grammar. Equal stretches have
equal names but for a symbol on either side of each level, so that two places are
compared by walking up while both stand at the edge of a phrase and down where names
differ: one step a level, for all questions at once (``Grammar.agree``).

A run of period p and 4 periods has words p apart identical over 3 periods, so one
place of the harmonic grid 0, 3p, 6p, ... lies in it. Of the places where the words
agree, the grammar gives the exact extension to both sides. All places of a text of n
words are about n/3 * ln(n/4). Runs found with multiples of their smallest period
cover the same stretch, so the smallest period of each stretch is kept.

Names are dealt by sorting pairs, not by hashing them, so nothing rests on chance but
the number of levels. Memory is proportional to the batch: 4 MB of texts, or one longer
text.

Defined results: a null text is an empty one, and has no runs and an empty collapsed
text. Rows that repeat are judged each for itself; null ids stay. Other columns are
left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import col, flat_bytes, map_arrow, mix64, small_batches

EXPONENT, WORDS = 4, 6
GRID_ROWS = 1 << 20
"""So many places of the harmonic grid are looked at together."""

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@dataclass
class Level:
    """The symbols of one level, the first symbol of each phrase of the level above (and the end), and whose phrase
    each symbol is in."""

    symbol: np.ndarray
    first: np.ndarray
    up: np.ndarray
    blocks: bool


class Grammar:
    """The run-length grammar of one row of symbols, and where two of its places agree."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self.levels: list[Level] = []
        row, names = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1
        while len(row) > 1:
            first = np.flatnonzero(np.diff(row, prepend=-1))
            if len(first) < len(row):
                above, times = row[first], np.diff(first, append=len(row))
                more = times > 1
                keys, above[more] = np.unique(above[more] * (self.size + 1) + times[more], return_inverse=True)
                above[more] += names
                names += len(keys)
                row = self._add(row, first, above, blocks=True)
            if len(row) > 1:
                head = np.append(self._heads(row), False)
                first = np.flatnonzero(~np.append(False, head[:-1]))
                above, paired = row[first], head[first]
                keys, above[paired] = np.unique(above[paired] * names + row[first[paired] + 1], return_inverse=True)
                above[paired] += names
                names += len(keys)
                row = self._add(row, first, above, blocks=False)

    def _add(self, row: np.ndarray, first: np.ndarray, above: np.ndarray, blocks: bool) -> np.ndarray:
        up = np.repeat(np.arange(len(first)), np.diff(first, append=len(row)))
        self.levels.append(Level(row, np.append(first, len(row)), up, blocks))
        return above

    @staticmethod
    def _heads(row: np.ndarray) -> np.ndarray:
        """Where a left symbol stands before a right one. Symbols are left or right by a bit of their hash; the bits are
        drawn again until a fifth of the neighbours pair up (a quarter or more are expected)."""
        for salt in count(1):
            salted = row.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
            left = (mix64(salted) & np.uint64(1)) == 1
            heads = max(left[:-1] & ~left[1:], ~left[:-1] & left[1:], key=np.count_nonzero)
            if 5 * np.count_nonzero(heads) >= len(heads):
                return heads

    def agree(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """For places a < b, how many symbols are identical from there on (step 1) or from there back (step -1)."""
        found = self.size - b if step > 0 else a + 1  # up to the end, unless they differ before
        i, j, of = a.astype(np.int64), b.astype(np.int64), np.arange(len(a))
        differ: list[list[tuple[np.ndarray, ...]]] = [[] for _ in self.levels]
        for k, level in enumerate(self.levels):
            if not len(of):
                break
            symbol, side = level.symbol, int(step < 0)
            other = symbol[i] != symbol[j]
            differ[k].append((i[other], j[other], of[other]))
            i, j, of = i[~other], j[~other], of[~other]
            inside = (level.first[level.up[i] + side] - side != i) | (level.first[level.up[j] + side] - side != j)
            if inside.any():
                moves = 1
                if level.blocks:  # to the end of the shorter rest of two blocks of one symbol
                    rest = [(level.first[level.up[x] + 1 - side] - x) if step > 0 else x - level.first[level.up[x]] + 1
                            for x in (i[inside], j[inside])]
                    moves = np.minimum(*rest)
                i[inside] += step * moves
                j[inside] += step * moves
                there = (j < len(symbol)) & (i >= 0)
                i, j, of = i[there], j[there], of[there]
                apart = (level.first[level.up[i] + side] - side != i) | (level.first[level.up[j] + side] - side != j)
                differ[k].append((i[apart], j[apart], of[apart]))
                i, j, of = i[~apart], j[~apart], of[~apart]
            i, j = level.up[i], level.up[j]
        i = j = of = np.zeros(0, np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            if len(of):  # from phrases above that differ to their symbols
                low = [level.first[x] for x in (i, j)]
                high = [level.first[x + 1] for x in (i, j)]
                i, j = low if step > 0 else (high[0] - 1, high[1] - 1)
                same = level.symbol[i] == level.symbol[j]
                moves = np.minimum(high[0] - low[0], high[1] - low[1]) if level.blocks else 1
                i, j = i + step * same * moves, j + step * same * moves
                there = (j < len(level.symbol)) & (i >= 0)
                i, j, of = i[there], j[there], of[there]
            parts = [(i, j, of), *differ[k]]
            i, j, of = (np.concatenate(x) for x in zip(*parts, strict=True))
        found[of] = (i - a[of]) * step
        return found


def find(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, ordered by start and period. Text d has the words from at[d] to
    at[d + 1]; starts are counted over all texts."""
    sizes = np.diff(at)
    periods = np.where(sizes >= WORDS, sizes // EXPONENT, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    spacing = (EXPONENT - 1) * period
    places = -((period - sizes[text]) // spacing)
    ends = np.cumsum(places)
    grammar, found = None, [np.zeros((3, 0), np.int64)]
    start = 0
    while start < len(text):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + GRID_ROWS, side="right")))
        part = slice(start, stop)
        p, d = np.repeat(period[part], places[part]), np.repeat(text[part], places[part])
        turn = np.arange(len(p)) - np.repeat(np.cumsum(places[part]) - places[part], places[part])
        i = at[d] + turn * (EXPONENT - 1) * p
        same = words[i] == words[i + p]
        i, p, d, start = i[same], p[same], d[same], stop
        if not len(i):
            continue
        grammar = grammar or Grammar(words)
        after = np.minimum(grammar.agree(i, i + p, 1), at[d + 1] - i - p)
        before = np.zeros(len(i), np.int64)
        inner = i > at[d]
        back = grammar.agree(i[inner] - 1, (i + p)[inner] - 1, -1)
        before[inner] = np.minimum(back, (i - at[d])[inner])
        length = before + after + p
        run = length >= np.maximum(WORDS, EXPONENT * p)
        found.append(np.stack([(i - before)[run], length[run], p[run]]))
    runs = np.concatenate(found, axis=1)
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    new = np.ones(runs.shape[1], bool)
    new[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    runs = runs[:, new]
    return tuple(runs[:, np.lexsort((runs[2], runs[0]))])


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with every white space as a blank and one after each text, starts and sizes of the words in them, the words'
    numbers, and where each text's words start."""
    none, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    texts = texts.fill_null("").cast(pa.large_string())
    data, offsets = flat_bytes(pc.binary_join_element_wise(texts, none, blank))
    space = _SPACE[data]
    was_space = np.empty_like(space)
    was_space[:1] = True
    was_space[1:] = space[:-1]
    start, stop = np.flatnonzero(~space & was_space), np.flatnonzero(space & ~was_space)
    ends = np.append(0, np.cumsum(stop - start))
    solid = pa.py_buffer(np.ascontiguousarray(data[~space]))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), solid])
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    return np.where(space, np.uint8(0x20), data), start, stop - start, numbers, np.searchsorted(start, offsets)


def _collapsed(data: np.ndarray, start: np.ndarray, sizes: np.ndarray, kept: np.ndarray, at: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    before = np.append(0, np.cumsum(kept))[at]  # kept words before each text
    sizes = sizes[kept] + 1  # with the blank behind, but not at the end of a text
    sizes[before[1:][np.diff(before) > 0] - 1] -= 1
    ends = np.append(0, np.cumsum(sizes))
    flat = data[np.repeat(start[kept] - ends[:-1], sizes) + np.arange(ends[-1])]
    offsets = pa.py_buffer(ends[before].astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, offsets, pa.py_buffer(flat)]).cast(pa.string())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "t"):
        data, start, sizes, words, at = split_words(batch.column("t"))
        first, length, period = find(words, at)
        dropped = np.zeros(len(words) + 1, np.int64)
        np.add.at(dropped, first + period, 1)
        np.add.at(dropped, first + length, -1)
        kept = np.cumsum(dropped[:-1]) == 0
        cuts = np.searchsorted(first, at)
        local = first - np.repeat(at[:-1], np.diff(cuts))
        spans = pa.StructArray.from_arrays([pa.array(x) for x in (local, length, period)], ["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("k"), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans),
             _collapsed(data, start, sizes, kept, at)], ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start and period), and collapsed: the words but
    those of a run after its first period, joined by one blank."""
    docs = df.select(col(id_col).alias("k"), col(text_col).cast("string").alias("t"))
    kind = docs.schema["k"].dataType.simpleString()
    return map_arrow(docs, _runs, f"doc_id {kind}, n_words long, "
                     "runs array<struct<start: long, length: long, period: long>>, collapsed string")
