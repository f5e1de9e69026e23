"""Document fingerprints by locally consistent parsing.

A text is a string of bytes. On each level, a run of one symbol becomes one
symbol; deterministic coin tossing then gives every symbol a label from its left
neighbour (twice the lowest bit in which they differ, plus that bit), and after
four rounds labels are below six and neighbours still differ. Phrases start at
local maxima of the labels. A phrase is named by a hash of its symbols, and the
names are the next level's symbols, up to one name for the whole text. Where a
phrase starts only depends on a few symbols around it, so equal substrings get
equal names inside, wherever they stand.

A fingerprint is the smallest ``SKETCH`` of the hashed names of all levels, for
texts of any length, as hexadecimal numbers of eight digits. Two fingerprints' likeness is the share of common ones
among the smallest of both together, an estimate of the Jaccard similarity of
the names.

Defined results: a null text is an empty one; an empty text has the empty
fingerprint, which is like itself (1.0) and unlike all others (0.0). Null
document ids come first in order, rows of one id are ordered by text. Repeated
rows are kept. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, map_arrow, mix64, small_batches

SKETCH = 64
BUCKET_ROWS, BUCKETS, TASK_BUCKETS = 500, 1 << 14, 4
"""Documents are dealt in runs of about so many, some runs to a task; beyond so many runs they grow, as their
first ids are broadcast."""

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _toss(symbol: np.ndarray, left: np.ndarray) -> np.ndarray:
    apart = symbol ^ left
    place = np.bitwise_count(~apart & (apart - apart.dtype.type(1))).astype(apart.dtype)
    return (2 * place + ((symbol >> place) & apart.dtype.type(1))).astype(np.uint8)


_PAIRS = np.arange(256, dtype=np.uint8)
_TOSS = _toss(np.repeat(_PAIRS, 256), np.tile(_PAIRS, 256))  # at 256 * symbol + left


def _labels(symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six; a text's first symbol has, as its left neighbour, itself with bit 0 turned."""
    left = np.empty_like(symbol)
    left[1:] = symbol[:-1]
    left[first] = symbol[first] ^ np.uint64(1)
    label = _toss(symbol, left)
    for _ in range(3):
        pair = label.astype(np.uint16) << 8
        pair[1:] |= label[:-1]
        pair[first] = label[first].astype(np.uint16) << 8 | (label[first] ^ 1)
        label = _TOSS[pair]
    return label


def _up(symbol: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of one level's phrases and where each text's names start; no text is empty."""
    new = np.empty(len(symbol), bool)
    new[1:] = symbol[1:] != symbol[:-1]
    new[first] = True
    at = np.flatnonzero(new)
    if len(at) < len(symbol):  # runs
        runs = np.diff(at, append=len(symbol)).astype(np.uint64)
        symbol, long = symbol[at], runs > 1
        symbol[long] = mix64(symbol[long] + runs[long] * _STEP)
        first = np.searchsorted(at, first)
    label = _labels(symbol, first)
    start = np.zeros(len(symbol), bool)
    start[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    start[first[1:] - 1] = False  # a text's last symbol has no right neighbour
    start[first] = True
    start_at = np.flatnonzero(start)
    sizes = np.diff(start_at, append=len(symbol))
    place = np.arange(len(symbol), dtype=np.uint64) - np.repeat(start_at, sizes).astype(np.uint64)
    names = np.add.reduceat(mix64(symbol + place * _STEP), start_at)
    return mix64(names + sizes.astype(np.uint64)), np.searchsorted(start_at, first)


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted 32-bit numbers of each text's fingerprint."""
    sizes = np.array([len(x) for x in texts], np.int64)
    owner = np.flatnonzero(sizes)
    if not len(owner):
        return [np.zeros(0, np.uint32) for _ in texts]
    symbol = _BYTES[np.frombuffer(b"".join(texts), np.uint8)]
    first = np.cumsum(sizes[owner]) - sizes[owner]
    found = []
    while len(owner):
        symbol, first = _up(symbol, first)
        counts = np.diff(first, append=len(symbol))
        whole = counts == 1
        of = np.repeat(owner, counts).astype(np.uint64)
        found.append(of << np.uint64(32) | mix64(symbol) >> np.uint64(32))
        symbol, owner, counts = symbol[np.repeat(~whole, counts)], owner[~whole], counts[~whole]
        first = np.cumsum(counts) - counts
    all_ = np.sort(np.concatenate(found))  # sorting is faster here than the hash table of np.unique
    all_ = all_[np.append(True, all_[1:] != all_[:-1])]
    cuts = np.searchsorted(all_, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    return [all_[a:min(b, a + SKETCH)].astype(np.uint32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    both = np.sort(np.concatenate([a, b]))
    if not len(both):
        return 1.0
    twice = np.flatnonzero(both[1:] == both[:-1])
    # the place of a common number among the distinct ones
    places = twice - np.arange(len(twice))
    size = min(SKETCH, len(both) - len(twice))
    return int((places < size).sum()) / size


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids and texts of runs of documents and the text after each, from rows ordered by bucket."""
    waiting = None
    for batch in small_batches(batches, "t", 1 << 20):
        ids, texts, nexts = [], [], []
        for bucket, again, doc, text in zip(*(batch.column(x).to_pylist() for x in ("bucket", "again", "k", "t")),
                                            strict=True):
            if waiting is not None and waiting[0] == bucket:
                ids.append(waiting[1])
                texts.append(waiting[2])
                nexts.append(text or "")
                waiting = None
            if not again:
                waiting = (bucket, doc, text or "")
        if ids:
            yield ids, texts, nexts


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts, nexts in _with_next(batches):
        edited = [(x[:len(x) - len(x) // 2] + y[:len(x) // 2]).encode() for x, y in zip(texts, nexts, strict=True)]
        # a document's next is the following one but at the end of the run
        own = sketches([x.encode() for x in texts] + [nexts[-1].encode()])
        changed = sketches(edited)
        follow = [own[i + 1] if nexts[i] is texts[i + 1] or nexts[i] == texts[i + 1] else
                  sketches([nexts[i].encode()])[0] for i in range(len(texts) - 1)] + [own[-1]]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(x) for x in texts], pa.int64()),
            "edited_sha256": [hashlib.sha256(x).hexdigest() for x in edited],
            "fingerprint": [to_text(x) for x in own[:-1]], "edited_fingerprint": [to_text(x) for x in changed],
            "near_edited": [likeness(a, b) for a, b in zip(own, changed, strict=False)],
            "near_next": [likeness(a, b) for a, b in zip(own, follow, strict=False)]})


def in_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket, again, k, t: documents in runs of ascending ids, each run followed by the next run's first document.

    The first document after the last one is the first of all. Runs are cut at
    quantiles of the ids; their first ids, at most ``BUCKETS``, are all that the driver sees.
    """
    spark = df.sparkSession
    order = F.coalesce(col(id_col).cast("long"), F.lit(-1 << 63))
    docs = df.select(order.alias("order"), col(id_col).cast("long").alias("k"), col(text_col).cast("string").alias("t"))
    count = max(1, min(BUCKETS, -(-docs.count() // BUCKET_ROWS)))
    at = F.percentile_approx("order", [i / count for i in range(1, count)] or [0.5], 4 * BUCKETS)
    bounds = sorted({float(x) for x in docs.agg(at.alias("x")).first().x or [0]})
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="place", outputCol="bucket")
    docs = cut.transform(docs.withColumn("place", F.col("order").cast("double"))).drop("place")
    firsts = sorted(map(tuple, docs.groupBy("bucket").agg(F.min("order")).collect()))
    rows = [(bucket, order, firsts[i - 1][0]) for i, (bucket, order) in enumerate(firsts)]
    firsts = spark.createDataFrame(rows, "bucket double, first long, before double")
    docs = docs.join(F.broadcast(firsts), "bucket")
    own = F.struct("bucket", F.lit(False).alias("again"))
    also = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("again"))
    places = F.when(F.col("order") == F.col("first"), F.array(own, also)).otherwise(F.array(own))
    dealt = docs.select(F.explode(places).alias("p"), "order", "k", "t").select("p.*", "order", "k", "t")
    return (dealt.repartition(-(-count // TASK_BUCKETS), "bucket").sortWithinPartitions("bucket", "again", "order", "t")
            .select("bucket", "again", "k", "t"))


def compare_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their and the next document's likeness."""
    return map_arrow(in_order(df, id_col, text_col), _compare,
                     "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                     "near_edited double, near_next double")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "t", 1 << 20):
            found = sketches([(x or "").encode() for x in batch.column("t").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array([to_text(x) for x in found], pa.string())],
                                             ["doc_id", "fingerprint"])

    docs = df.select(col(id_col).cast("long").alias("k"), col(text_col).cast("string").alias("t"))
    return map_arrow(docs, run, "doc_id long, fingerprint string")
