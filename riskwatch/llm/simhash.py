"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints of 64 bits are sorted by Gray rank, in which neighbours differ in few
bits, and cut into blocks. A node above some fingerprints holds the bits they all
share (mask and pattern) beyond those of its parent. A search walks down from the
top, adds up the differences from the shared bits of each level, and leaves a whole
group as soon as they exceed the distance.

The upper levels, one leaf a block and at most ``BLOCKS`` blocks, are broadcast; a
fingerprint is sent to the blocks its walk reaches, and each block walks on within.
Blocks are cut by count, and only distinct fingerprints are indexed, so a hot group
of copies is one row here. A block gives back a spanning forest of the links it
finds, not all pairs; components over these edges are the classes.

Defined results: a null text is an empty one, whose fingerprint is zero and which
links like any other. The id of a class is the smallest document id that is not
null. Repeated rows and ids are kept. Other columns stay as they are. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import col, map_arrow, small_batches
from .components import components

SEED = 42
BLOCK_CODES, BLOCKS = 2048, 1 << 14
"""A block holds about so many fingerprints; beyond so many blocks they grow, as the upper levels are broadcast."""
LEAF, FAN = 16, 8


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words, joined by spaces; of all words if there are fewer."""
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words])
    starts = (ends[:-size] if size < len(words) else ends[:0]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip([0, *starts], (ends[size - 1:] - 1).tolist(), strict=True)]


def simhash(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of ``sizes`` hashes: bits set in over half of them; zero for none."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    # byte lanes hold sums of up to 255 hashes; then the groups of one document are added
    groups = -(-sizes[some] // 255)
    first = np.cumsum(groups) - groups
    within = np.arange(groups.sum()) - np.repeat(first, groups)
    starts = np.repeat(np.cumsum(sizes[some]) - sizes[some], groups) + 255 * within
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, starts).view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        over = 2 * total > sizes[some][:, None]
        out[some] |= (over.astype(np.uint64) << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(
            axis=1, dtype=np.uint64)
    return out


def fingerprints(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """row (the kept columns, all by default) and code, the fingerprint's bits as a long."""
    keep = df.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            hashes = [shingle_hashes(x or "", shingle) for x in batch.column(text_col).to_pylist()]
            sizes = np.array([len(x) for x in hashes], np.int64)
            flat = np.fromiter((h for x in hashes for h in x), np.uint64, int(sizes.sum()))
            row = pa.StructArray.from_arrays([batch.column(x) for x in keep], fields=[batch.schema.field(x) for x in keep])
            yield pa.RecordBatch.from_arrays([row, pa.array(simhash(flat, sizes).view(np.int64))], ["row", "code"])

    used = df.select(*(col(x) for x in dict.fromkeys([*keep, text_col])))
    fields = T.StructType([used.schema[x] for x in keep])
    return map_arrow(used, run, T.StructType([T.StructField("row", fields), T.StructField("code", T.LongType())]))


def _gray_rank():
    """The place of a code in Gray order, as a long that sorts like it."""
    rank = F.col("code")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-1 << 63))


class GrayIndex:
    """The tree over codes in Gray order, or over the (and, or) of blocks of them."""

    def __init__(self, all_and: np.ndarray, all_or: np.ndarray):
        levels = [(all_and, all_or)]
        width = LEAF
        while len(levels[-1][0]) > 1:
            starts = np.arange(0, len(levels[-1][0]), width)
            levels.append((np.bitwise_and.reduceat(levels[-1][0], starts), np.bitwise_or.reduceat(levels[-1][1], starts)))
            width = FAN
        self.levels = []
        above = np.zeros(1, np.uint64)  # bits that the parent already holds
        for depth in range(len(levels) - 1, -1, -1):
            low, high = levels[depth]
            fan = LEAF if depth == 0 else FAN
            parent = np.arange(len(low)) // fan if self.levels else np.zeros(len(low), np.int64)
            mask = ~(low ^ high)
            self.levels.append((mask & ~above[parent], low, fan, len(low)))
            above = mask

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) pairs whose accumulated differences stay within the distance."""
        at = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        spent = np.zeros(len(queries), np.uint8)
        for i, (mask, pattern, fan, n) in enumerate(self.levels):
            if i:
                children = node[:, None] * fan + np.arange(fan)
                there = children < n
                node = children[there]
                at, spent = (np.broadcast_to(x[:, None], there.shape)[there] for x in (at, spent))
            spent = spent + np.bitwise_count((queries[at] ^ pattern[node]) & mask[node])
            near = spent <= distance
            at, node, spent = at[near], node[near], spent[near]
        return at, node


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]: the smallest index of each class."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]


def _spread(blocks: list[tuple[int, int, int]], distance: int):
    """Every code as a member of its block, and as a query to each later block that its walk reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, low, high = (np.array(x, np.int64) for x in zip(*blocks, strict=True))
        index = GrayIndex(low.view(np.uint64), high.view(np.uint64))
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                code, block, rank = (part.column(x).to_numpy() for x in ("code", "block", "rank"))
                at, leaf = index.search(code.view(np.uint64), distance)
                later = number[leaf] > block[at]
                at, to = at[later], number[leaf][later]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([block, to])), pa.array(np.repeat([False, True], [len(code), len(at)])),
                     pa.array(np.concatenate([rank, rank[at]])), pa.array(np.concatenate([code, code[at]]))],
                    ["block", "query", "rank", "code"])
    return run


def _search(distance: int):
    """The edges of each block: its members' forest, and one edge for each query that reaches a member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, index, codes, label = None, [], None, None, None

        def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        def ask(queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """First members reached by the queries; members reached by the same query become one class."""
            nonlocal label
            at, node = index.search(queries, distance)
            order = np.argsort(at, kind="stable")
            at, node = at[order], node[order]
            same = at[1:] == at[:-1]
            label = _unite(label, node[1:][same], node[:-1][same])
            first = np.flatnonzero(np.diff(at, prepend=-1))
            return queries[at[first]], codes[node[first]]

        def build() -> None:
            nonlocal index, codes, label, members
            codes = np.concatenate(members).view(np.uint64)
            members, index, label = [], GrayIndex(codes, codes), np.arange(len(codes))
            for i in range(0, len(codes), 512):
                ask(codes[i:i + 512])

        def forest() -> pa.RecordBatch:
            other = np.flatnonzero(label != np.arange(len(label)))
            return edges(codes[other], codes[label[other]])

        for batch in batches:
            block = batch.column("block").to_numpy()
            query = batch.column("query").to_numpy(zero_copy_only=False)
            code = batch.column("code").to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(block)], strict=True):
                if start == stop:
                    continue
                if block[start] != now:
                    if members:
                        build()
                    if index is not None:
                        yield forest()
                    now, index = block[start], None
                if not query[start]:
                    members.append(code[start:stop])
                    continue
                if members:
                    build()
                for i in range(start, stop, 512):
                    yield edges(*ask(code[i:min(i + 512, stop)].view(np.uint64)))
        if members:
            build()
        if index is not None:
            yield forest()
    return run


def links(codes: DataFrame, distance: int) -> DataFrame:
    """a, b: edges that connect exactly the codes which a chain of links within the distance connects."""
    n = codes.count()
    count = max(1, min(BLOCKS, -(-n // BLOCK_CODES)))
    ranked = codes.select("code", _gray_rank().alias("rank")).repartitionByRange(count, "rank")
    ranked = materialize(ranked.withColumn("block", F.spark_partition_id().cast("long")), "codes")
    blocks = ranked.groupBy("block").agg(F.bit_and("code"), F.bit_or("code")).orderBy("block").collect()
    if not blocks:
        return codes.select(F.col("code").alias("a"), F.col("code").alias("b"))
    spread = map_arrow(ranked, _spread([tuple(x) for x in blocks], distance),
                       "block long, query boolean, rank long, code long")
    dealt = spread.repartition(count, "block").sortWithinPartitions("block", "query", "rank")
    return map_arrow(dealt, _search(distance), "a long, b long")


def classes(codes: DataFrame, distance: int) -> DataFrame:
    """code, component (a code of the class) for every distinct code."""
    found = materialize(components(links(codes, distance)), "classes")
    return (codes.join(found, F.col("code") == F.col("node"), "left")
            .select("code", F.coalesce("component", "code").alias("component")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 2) -> DataFrame:
    """document id, code and component_id: the smallest id that links reach, for every row."""
    rows = materialize(fingerprints(df, text_col, [id_col], shingle), "fingerprints")
    rows = rows.select(F.col("row")[id_col].alias("id"), "code")
    codes = materialize(rows.groupBy("code").agg(F.min("id").alias("least")), "codes")
    of_class = materialize(classes(codes.select("code"), distance), "classes")
    least = (of_class.join(codes, "code").groupBy("component").agg(F.min("least").alias("component_id")))
    least = materialize(least, "classes")
    named = of_class.join(least, "component").select("code", "component_id")
    return rows.join(named, "code").select(F.col("id").alias(id_col), "code", "component_id")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
          distance: int = 2) -> DataFrame:
    """The rows of ``df``, one of each class: the smallest document id, null last, and its first row."""
    rows = fingerprints(df, text_col, None, shingle).withColumn("n", F.monotonically_increasing_id())
    rows = materialize(rows, "rows")
    codes = materialize(rows.select("code").distinct(), "codes")
    of_class = materialize(classes(codes, distance), "classes")
    id_ = F.col("row")[id_col]
    first = F.min(F.struct(id_.isNull().alias("no"), id_.alias("id"), "n")).alias("first")
    stay = rows.select("row", "code", "n").join(of_class, "code").groupBy("component").agg(first)
    return rows.join(stay.select("first.n"), "n", "left_semi").select("row.*")
