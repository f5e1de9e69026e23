"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Packing only depends on how many pieces there are of each length, so the plan is
made on those counts: at most ``capacity`` numbers, however large the corpus.
From the longest length down, an index of single, pair and triple length sums
gives the lengths that fill the gap exactly; as many sequences as the counts
allow are made at once. What no such sum completes is packed by best fit
decreasing, again many equal sequences at a time. Each step uses up a length or
a kind of sequence, so the plan stays a few times ``capacity`` rows long.

Pieces then find their places by themselves: the r-th piece of a length, by
write task and place in it, takes the r-th slot of that length.

Defined results: a null text is an empty one, which is the end id alone. A
document longer than the capacity is cut into pieces of the capacity; only the
last may be shorter. Null and repeated document ids are kept as they are; other
columns are left out. An empty table gives no pieces.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import binary_rows, col, map_arrow, small_batches
from .encode import encoder

RANK_BITS = 44
WORDS = 800_000
"""Words that a worker remembers; in a pipeline it shares its memory with what earlier stages left."""


class SumIndex:
    """Which lengths fill a gap exactly, under the counts that are left.

    Counts only fall, so a pair or triple that has run out never comes back: for
    each sum the search goes on from where it last succeeded.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self.pair_from = [(s + 1) // 2 for s in range(len(left))]
        self.triple_from = [(s + 2) // 3 for s in range(len(left))]

    def enough(self, *lengths: int) -> bool:
        return all(self.left[x] >= n for x, n in Counter(lengths).items())

    def pairs(self, total: int) -> Iterator[tuple[int, int]]:
        """Pairs with this sum, from equal halves outwards, which spares the short pieces."""
        a = np.arange(self.pair_from[total], total)
        found = a[(self.left[a] > 0) & (self.left[total - a] > 0)].tolist()
        self.pair_from[total] = found[0] if found else total
        for x in found:
            if self.enough(x, total - x):
                yield x, total - x

    def triples(self, total: int) -> Iterator[tuple[int, int, int]]:
        a = np.arange(self.triple_from[total], total - 1)
        first = True
        for x in a[self.left[a] > 0].tolist():
            rest = total - x
            if self.pair_from[rest] >= rest:
                continue
            for y, z in self.pairs(rest):
                if first:
                    self.triple_from[total], first = x, False
                if self.enough(x, y, z):
                    yield x, y, z
                    break
        if first:
            self.triple_from[total] = total

    def fill(self, length: int, gap: int, most: int) -> tuple[int, ...] | None:
        if not gap:
            return ()
        if most >= 1 and self.enough(length, gap):
            return (gap,)
        for search in (self.pairs, self.triples)[:max(0, most - 1)]:
            for found in search(gap):
                if self.enough(length, *found):
                    return found
        return None


def make_plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), all pieces used once.

    Where few lengths are left over, sums of fewer lengths can leave better
    residuals, so each bound on the sums is tried and the shortest plan taken.
    """
    plans = [_plan(counts, capacity, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences filled exactly by a length and at most ``most`` others, then the rest by best fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan, index = [], SumIndex(left)
    for length in range(capacity, 0, -1):
        while left[length] and (found := index.fill(length, capacity - length, most)) is not None:
            need = Counter((length, *found))
            times = min(int(left[x]) // n for x, n in need.items())
            for x, n in need.items():
                left[x] -= times * n
            plan.append(((length, *found), times))
    return plan + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on counts: by gap, the kinds of sequences with that gap."""
    kinds: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    held = np.zeros(capacity + 1, np.int64)

    def add(lengths: tuple[int, ...], times: int) -> None:
        if times:
            gap = capacity - sum(lengths)
            kinds[gap].append((lengths, times))
            held[gap] += times

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(held[length:])
            if not len(fits):
                each = capacity // length
                add((length,) * each, n // each)
                add((length,) * (n % each), int(n % each > 0))
                break
            gap = length + int(fits[0])
            lengths, times = kinds[gap].pop()
            held[gap] -= times
            each = gap // length
            whole = min(times, n // each)
            rest = n - whole * each if whole < times else 0
            add(lengths + (length,) * each, whole)
            if rest:
                add(lengths + (length,) * rest, 1)
            add(lengths, times - whole - (rest > 0))
            n -= whole * each + rest
    return [x for kind in kinds.values() for x in kind]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For runs of pieces of one length: the first's key (length, rank), sequence and offset."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length << RANK_BITS | used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("key", "sequence", "offset"))}


PIECE = ("doc_id {id}, piece int, start long, length long, part int, rank long, ids binary")


def cut(df: DataFrame, vocabulary: str, end_id: int, capacity: int, keep_space: bool = False,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with their ids, written once to the shared folder.

    ``part`` and ``rank`` (among the pieces of one length of that part) name a piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, keep_space, WORDS).encode_flat
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in small_batches(batches, "t"):
            flat, at = encode(batch.column("t"))
            sizes = np.diff(at) + 1
            flat = np.insert(flat, at[1:], end_id)
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = capacity * piece
            length = np.minimum(capacity, sizes[row] - start)
            rank = []
            for n in length.tolist():
                rank.append(seen[n])
                seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                 pa.array(np.full(len(row), part, np.int32)), pa.array(rank, pa.int64()),
                 binary_rows(flat, np.concatenate([[0], np.cumsum(length)]))],
                ["doc_id", "piece", "start", "length", "part", "rank", "ids"])

    docs = df.select(col(id_col).alias("k"), col(text_col).cast("string").alias("t"))
    found = map_arrow(docs, run, PIECE.format(id=docs.schema["k"].dataType.simpleString()))
    return materialize(found, "pieces")


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (any columns beside length, part and rank) with sequence_id and offset.

    The counts by length go to the driver, at most ``capacity`` rows; the slots
    that come back are broadcast, a few times as many.
    """
    spark = pieces.sparkSession
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = by_part.groupBy("length").agg(F.sum("n").alias("n"))
    table = spark.sparkContext.broadcast(slots(make_plan(dict(map(tuple, counts.collect())), capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    ranked = pieces.join(by_part, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("_before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = table.value
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            key = batch.column("length").to_numpy() << RANK_BITS | rank
            at = np.searchsorted(place["key"], key, side="right") - 1
            sequence = place["sequence"][at] + (key - place["key"][at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(place["offset"][at])],
                                             [*batch.schema.names, "sequence_id", "offset"])

    ranked = ranked.select(*pieces.columns)
    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in ranked.schema)
    return map_arrow(ranked, run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids of every sequence, its pieces in order; a group holds one capacity."""
    piece = F.struct("offset", "doc_id", "ids")
    found = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    join = F.aggregate("p", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"]))
    return found.select("sequence_id", join.alias("ids"), F.col("p.doc_id").alias("doc_ids"))
