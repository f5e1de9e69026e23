"""Hard negatives of anchors among all rows, by exact integer scores.

Anchors and candidates meet in tiles: a group of anchors times a block of candidates,
each of bounded size, one tile a task. Inside a task, Strassen's recursion multiplies
pieces of the tile in 64-bit integers, with zeros up to an even size on every level.
Integer additions are exact, and since sums and products are taken modulo 2^64, the
recursion's larger sums do no harm as long as the scores themselves fit.

What a task keeps are heaps: the best few entries of each owner by (score descending,
id, row). Two heaps of one owner merge into one by the same rule, inside a task from
piece to piece and between tasks in order of the owner, so neither holds more than the
heaps and one batch. The first pass has one heap an anchor, of its positives: other rows of its
label. The second has one heap for each anchor and positive, of the rows of other
labels whose score lies in the window that the positive's score sets.

Every anchor is scored against every row, in blocks; no row is left out, whatever the
number of rows of a label. Groups and blocks are dealt by a hash of the row's number,
so a hot label or many equal rows spread like any others.

Defined results: rows without id, label or vector and vectors with a null component
take no part. A missing component at the end counts as zero. Rows that repeat are rows of
their own, ties go to the smaller id, then to the earlier row. An anchor without
positives, or a positive without negatives in its window, gives no row. A table whose
scores might not fit 64 bits raises an error. Other columns are left out. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, map_arrow

ANCHORS, CANDIDATES = 16_384, 8_192
"""Most rows of a tile, but for the unevenness of a hash."""
PIECE, LEAF = 256, 16


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in 64-bit integers, by seven products of halves as long as no side is at most ``LEAF``."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        wide = strassen(np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2))))
        return wide[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The first ``size`` entries of each owner by (score descending, id, row), as columns in this order."""

    def __init__(self, size: int):
        self.size = size
        self.columns = tuple(np.zeros(0, np.int64) for _ in range(4))

    def push(self, owner: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        columns = [np.concatenate(x) for x in zip(self.columns, (owner, score, ident, row), strict=True)]
        order = np.lexsort((columns[3], columns[2], -columns[1], columns[0]))
        owner = columns[0][order]
        first = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1 if len(owner) else 0))
        place = np.arange(len(owner)) - np.repeat(first, np.diff(first, append=len(owner)))
        self.columns = tuple(x[order[place < self.size]] for x in columns)

    def worst(self, owners: int) -> np.ndarray:
        """For owners 0, 1, ...: the score that an entry needs at least; the smallest number while there is room."""
        out = np.full(owners, np.iinfo(np.int64).min)
        full = np.flatnonzero(np.bincount(self.columns[0], minlength=owners)[:owners] == self.size)
        last = np.searchsorted(self.columns[0], full, side="right") - 1
        out[full] = self.columns[1][last]
        return out

    def take_below(self, owner: int | None) -> tuple[np.ndarray, ...]:
        """Remove and return the entries of owners below this one, or all."""
        cut = len(self.columns[0]) if owner is None else int(np.searchsorted(self.columns[0], owner))
        out, self.columns = tuple(x[:cut] for x in self.columns), tuple(x[cut:] for x in self.columns)
        return out


ENTRY = "owner long, slot int, place int, score long, id long, row long"


def _entries(columns: tuple[np.ndarray, ...], slots: int, names: np.ndarray | None = None) -> pa.RecordBatch:
    """Entries of owners that are numbers of anchors (or of names of anchors) times ``slots`` plus a slot."""
    owner, score, ident, row = columns
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(first, append=len(owner)))
    own = owner // slots if names is None else names[owner // slots]
    return pa.RecordBatch.from_arrays(
        [pa.array(own), pa.array((owner % slots).astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(score),
         pa.array(ident), pa.array(row)], ["owner", "slot", "place", "score", "id", "row"])


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, with zeros up to the width."""
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(values), width), np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    out = np.empty((len(anchors), len(candidates)), np.int64)
    for i in range(0, len(anchors), PIECE):
        for j in range(0, len(candidates), PIECE):
            out[i:i + PIECE, j:j + PIECE] = strassen(anchors[i:i + PIECE], candidates[j:j + PIECE].T)
    return out


def _tiles(width: int, size: int, slots: int, window: tuple[int, int] | None):
    """The heaps of each tile, from rows in order of (block, group, anchors last)."""
    step = 4 * PIECE

    def heaps(anchors: pa.RecordBatch, there: list[np.ndarray]) -> pa.RecordBatch:
        row, label = (anchors.column(x).to_numpy() for x in ("row", "label"))
        vec, heap = _matrix(anchors.column("vec"), width), Heaps(size)
        if window:  # rounded inwards to whole scores; a place without a positive has a window that holds nothing
            scores = _matrix(anchors.column("scores"), slots)
            low, high = -(-window[0] * scores // 100), window[1] * scores // 100
            some = pc.list_value_length(anchors.column("scores")).to_numpy(zero_copy_only=False)
            low[np.arange(slots) >= some[:, None]] = np.iinfo(np.int64).max
        for k in range(0, len(there[0]), step):
            other, ident, its_label, its_vec = (x[k:k + step] for x in there)
            score = _scores(vec, its_vec)
            same = label[:, None] == its_label
            worst = heap.worst(len(row) * slots).reshape(len(row), slots)
            for slot in range(slots):
                if window:
                    fits = ~same & (score >= np.maximum(low, worst)[:, slot, None]) & (score <= high[:, slot, None])
                else:
                    fits = same & (score >= worst[:, slot, None]) & (row[:, None] != other)
                a, c = np.nonzero(fits)
                heap.push(a * slots + slot, score[a, c], ident[c], other[c])
        return _entries(heap.columns, slots, row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, there = None, [], None
        for batch in batches:
            block, group, anchor = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("block", "group", "anchor"))
            new = np.diff(block) | np.diff(group) | np.diff(anchor.astype(np.int64))
            cuts = np.flatnonzero(new) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if start == stop:
                    continue
                if (block[start], group[start]) != now:
                    now, parts, there = (block[start], group[start]), [], None
                piece = batch.slice(start, stop - start)
                if not anchor[start]:
                    columns = [piece.column(x).to_numpy() for x in ("row", "id", "label")]
                    parts.append((*columns, _matrix(piece.column("vec"), width)))
                    continue
                if parts:
                    there, parts = [np.concatenate(x) for x in zip(*parts, strict=True)], []
                for i in range(0, piece.num_rows if there else 0, step):
                    yield heaps(piece.slice(i, step), there)

    return run


def _merged(size: int, slots: int):
    """One heap for each owner and slot, from heaps in order of the owner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = Heaps(size)
        for batch in batches:
            owner, slot, score, ident, row = (batch.column(x).to_numpy() for x in ("owner", "slot", "score", "id", "row"))
            if len(owner):
                heap.push(owner * slots + slot, score, ident, row)
                yield _entries(heap.take_below(int(owner[-1]) * slots), slots)
        yield _entries(heap.take_below(None), slots)
    return run


@dataclass
class _Grid:
    width: int
    blocks: int
    groups: int

    def best(self, rows: DataFrame, anchors: DataFrame, size: int, slots: int,
             window: tuple[int, int] | None = None) -> DataFrame:
        """The heaps of all anchors over all rows."""
        def dealt(df: DataFrame, anchor: bool, scores):
            every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(x - 1).cast("long"))) for x in (self.blocks, self.groups)]
            own = [F.pmod(F.xxhash64(F.lit(i), "row"), F.lit(x)) for i, x in enumerate((self.blocks, self.groups))]
            block, group = (every[0], own[1]) if anchor else (own[0], every[1])
            return df.select(block.alias("block"), group.alias("group"), F.lit(anchor).alias("anchor"),
                             "row", "id", "label", "vec", scores.alias("scores"))

        none, tiles = F.array().cast("array<long>"), self.blocks * self.groups
        both = dealt(rows, False, none).union(dealt(anchors, True, F.col("scores") if window else none))
        both = both.repartition(tiles, "block", "group").sortWithinPartitions("block", "group", "anchor")
        found = map_arrow(both, _tiles(self.width, size, slots, window), ENTRY)
        return map_arrow(found.repartition(tiles, "owner").sortWithinPartitions("owner"), _merged(size, slots), ENTRY)


def mine(df: DataFrame, id_col: str, vector_col: str, label_col: str, anchor_col: str, positives: int = 5,
         negatives: int = 3, window: tuple[int, int] = (50, 95)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every row with a true ``anchor_col``.

    Ids and labels are integers, vectors arrays of integers. A negative's score lies between these hundredths of the
    positive's, both included.
    """
    rows = df.select(col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"),
                     col(vector_col).cast("array<long>").alias("vec"), F.coalesce(col(anchor_col), F.lit(False)).alias("anchor"))
    rows = rows.where("id is not null and label is not null and vec is not null and not exists(vec, x -> x is null)")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    largest = F.max(F.array_max(F.transform("vec", lambda x: F.abs(x))))
    n, n_anchors, width, largest = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vec")), largest).first()
    if 100 * (width or 0) * (largest or 0) ** 2 >= 1 << 63:
        raise OverflowError("scores of these vectors might not fit 64 bits")
    grid = _Grid(max(1, width or 1), max(1, -(-n // CANDIDATES)), max(1, -(-n_anchors // ANCHORS)))
    anchors = rows.where("anchor")
    found = materialize(grid.best(rows, anchors, positives, 1), "positives")
    # at most ``positives`` entries an anchor, in the order of their places
    scores = F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"])
    scores = found.groupBy("owner").agg(scores.alias("scores"))
    asked = anchors.join(scores, F.col("row") == F.col("owner"))
    hard = grid.best(rows, asked, negatives, positives, window)
    hard = hard.select("owner", F.col("slot").alias("place"), (F.col("place") + 1).alias("rank"),
                       F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = found.select("owner", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row").alias("owner"), F.col("id").alias("anchor_id"))
    return (hard.join(found, ["owner", "place"]).join(names, "owner")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
