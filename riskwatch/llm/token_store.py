"""Token ids in directly addressable codes, written as a table of segments and read back.

Every id is cut into 8-bit chunks. Level 0 holds the lowest chunk of all ids;
level j + 1 holds the next chunk of those ids of level j that need one. For each
level a continuation bitmap has a one where the id goes on, and a rank directory
has the number of ones before each block of 512 bits. So the id at any place is
read by following at most one chunk a level, and a range of ids by one slice a
level; nothing before it is decoded.

File format: Parquet rows, one a segment, in ascending document order::

    part, seg       place of the segment (write task, running number in it)
    before          ids in the segments of the same part before this one
    n_tokens        ids in the segment
    doc_ids, ends   its documents and, for each, the ids of the segment up to its end
    levels          array of (codes, more, ranks): bytes, bitmap (little bit first), unsigned 32-bit counts

Data pages are not compressed. Two small tables lie beside the segments: ``_parts`` has
the ids before each part, ``_directory`` the file, place, first id and number of ids of
each segment. A lookup finds its segment in the directory and reads only that row of one file.

Defined results: a null text is an empty one; every document ends with
``end_id``, so an empty text is that id alone. Null document ids come first and
are kept. Rows with one document id are documents of their own, ordered by text.
A document longer than ``SEGMENT_TOKENS`` is a segment by itself. An empty table
gives an empty store. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_rows, col, map_arrow, small_batches
from .encode import encoder

SEGMENT_TOKENS = 1 << 18
BLOCK_BITS = 512
HEAD = 64
LEVEL = "struct<codes:binary,more:binary,ranks:binary>"
SEGMENT = ("part int, seg int, before long, n_tokens long, doc_ids array<bigint>, ends array<bigint>, "
           f"levels array<{LEVEL}>")


def dac_encode(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of an array of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK_BITS), dtype=np.uint32) if len(more) else []
        ranks = np.concatenate([[0], np.cumsum(blocks)])[:-1] if len(more) else np.zeros(0)
        levels.append({"codes": rest.astype(np.uint8).tobytes(), "more": bits.tobytes(),
                       "ranks": ranks.astype("<u4").tobytes()})
        rest = rest[more] >> 8
        if not len(rest):
            return levels


def rank(level: dict[str, bytes], i: int) -> int:
    """Ones before bit i: the directory's count and at most one block of the bitmap."""
    block = i // BLOCK_BITS
    ranks = np.frombuffer(level["ranks"], "<u4")
    if block == len(ranks):
        if not block:
            return 0
        block -= 1
    bits = np.frombuffer(level["more"], np.uint8, offset=block * BLOCK_BITS // 8)[:BLOCK_BITS // 8]
    return int(ranks[block]) + int(np.unpackbits(bits, bitorder="little")[:i - block * BLOCK_BITS].sum())


def dac_get(levels: list[dict[str, bytes]], i: int) -> int:
    """The id at place i."""
    value = 0
    for j, level in enumerate(levels):
        value |= level["codes"][i] << 8 * j
        if not level["more"][i >> 3] >> (i & 7) & 1:
            return value
        i = rank(level, i)
    return value


def dac_range(levels: list[dict[str, bytes]], start: int, stop: int) -> np.ndarray:
    """The ids at places start to stop, by one slice of each level."""
    out, at = np.zeros(stop - start, np.uint32), None
    for j, level in enumerate(levels):
        codes = np.frombuffer(level["codes"], np.uint8)[start:stop].astype(np.uint32) << np.uint32(8 * j)
        if at is None:
            out |= codes
        else:
            out[at] |= codes
        bits = np.frombuffer(level["more"], np.uint8)[start >> 3:(stop + 7) >> 3]
        on = np.flatnonzero(np.unpackbits(bits, bitorder="little")[start & 7:(start & 7) + stop - start])
        if not len(on):
            break
        at = on if at is None else at[on]
        start = rank(level, start)
        stop = start + len(on)
    return out


def _segments(vocabulary: str, end_id: int, keep_space: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, keep_space).encode_flat
        end, part = np.array([end_id], "<u4"), TaskContext.get().partitionId()
        seg = before = size = 0
        docs: list = []
        ids: list[np.ndarray] = []
        type_ = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
                           ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                           ("levels", pa.list_(pa.struct([(x, pa.binary()) for x in ("codes", "more", "ranks")])))])

        def segment() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in ids])
            row = {"part": part, "seg": seg, "before": before, "n_tokens": int(ends[-1]), "doc_ids": docs,
                   "ends": ends.tolist(), "levels": dac_encode(np.concatenate(ids))}
            return pa.RecordBatch.from_pylist([row], schema=type_)

        for batch in small_batches(batches, "t", 8 << 20):
            flat, at = encode(batch.column("t"))
            for doc, i, j in zip(batch.column("k").to_pylist(), at[:-1], at[1:], strict=True):
                found = np.concatenate([flat[i:j], end])
                if ids and size + len(found) > SEGMENT_TOKENS:
                    yield segment()
                    seg, before, size, docs, ids = seg + 1, before + size, 0, [], []
                docs.append(doc)
                ids.append(found)
                size += len(found)
        if ids:
            yield segment()
    return run


def write_tokens(df: DataFrame, path: str, vocabulary: str, end_id: int, keep_space: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, end it with ``end_id`` and write the ids in ascending document order.

    The texts are dealt by document id range, so each task writes a contiguous
    run of documents and no task sees more than its range.
    """
    docs = df.select(col(id_col).cast("long").alias("k"), col(text_col).cast("string").alias("t"))
    # a text's beginning is enough for the borders of the ranges: null and repeated ids are split by it
    ordered = docs.withColumn("head", F.substring("t", 1, HEAD)).repartitionByRange("k", "head")
    ordered = ordered.sortWithinPartitions("k", "t").select("k", "t")
    found = map_arrow(ordered, _segments(vocabulary, end_id, keep_space), SEGMENT)
    found.write.parquet(path, compression="uncompressed")
    _write_directory(df.sparkSession, path)


def _write_directory(spark: SparkSession, path: str) -> None:
    """The tables beside the segments. The driver adds up one number a write task."""
    rows = spark.read.schema(SEGMENT).parquet(path).select("part", "seg", "before", "n_tokens", F.input_file_name().alias("file"))
    sizes = sorted((r.part, r.n) for r in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    ends = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    parts = spark.createDataFrame([(p, start) for (p, _), start in zip(sizes, ends, strict=False)], "part int, base long")
    parts.coalesce(1).write.parquet(f"{path}/_parts")
    start = (F.col("base") + F.col("before")).alias("start")
    directory = rows.join(F.broadcast(parts), "part").select("file", "part", "seg", start, "n_tokens")
    directory.repartitionByRange("start").sortWithinPartitions("start").write.parquet(f"{path}/_directory")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the ids of all segments before each. The parts, one row a write task, are broadcast."""
    parts = spark.read.schema("part int, base long").parquet(f"{path}/_parts")
    table = spark.read.schema(SEGMENT).parquet(path).join(F.broadcast(parts), "part")
    return table.withColumn("start", F.col("base") + F.col("before")).drop("base")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            doc_ids, ends, levels, start = (batch.column(x)[row].as_py() for x in
                                            ("doc_ids", "ends", "levels", "start"))
            ends = np.array(ends, dtype=np.int64)
            ids = dac_range(levels, 0, int(ends[-1]))
            sizes = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start + ends - sizes), pa.array(sizes),
                 binary_rows(ids, np.concatenate([[0], ends]))], ["doc_id", "start", "n_tokens", "ids"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document read back: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    found = segments(spark, path).select("doc_ids", "ends", "levels", "start")
    return map_arrow(found, _documents, "doc_id long, start long, n_tokens long, ids binary")


def segment_of(spark: SparkSession, path: str, place: int) -> tuple[DataFrame, int] | None:
    """The levels of the segment that holds a place of the whole store, as one row of one file, and its first place."""
    directory = spark.read.schema("file string, part int, seg int, start long, n_tokens long").parquet(f"{path}/_directory")
    row = directory.where((F.col("start") <= place) & (F.col("start") > place - F.col("n_tokens"))).first()
    if row is None:
        return None
    return spark.read.schema(SEGMENT).parquet(row.file).where(F.col("seg") == row.seg).select("levels"), row.start


def token_at(spark: SparkSession, path: str, place: int) -> int | None:
    """The id at one place of the whole store: one segment is read, and of it at most one chunk a level."""
    found = segment_of(spark, path, place)
    return dac_get([x.asDict() for x in found[0].first().levels], place - found[1]) if found else None
