"""Isotonic regression by pooling adjacent violators, range by range.

Rows are first summed to counts by score. A block is a range of scores with its
positives and rows; neighbouring blocks whose rates don't rise are pooled. The order in
which violators are pooled doesn't matter, so blocks are pooled inside ranges of scores first,
by as many tasks as there are ranges, and what is left is pooled again with other
range borders until no two neighbours violate the order. Rates are compared as
integers (cross products of counts), so the result is exact and the same for any
number of ranges. Nothing that grows with the rows or the blocks comes to the driver: it
sees the first and last block of each range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship

RANGE_BLOCKS = 65_536
"""Blocks of a range, but for the unevenness of its sampled borders."""
BUCKETS, BUCKET_BLOCKS = 4_096, 16

SCHEMA = "key int, lo double, hi double, pos long, n long"


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one range, in order of (key, lo), with rising rates inside each key."""
    stack: list[list] = []
    for batch in batches:
        for key, lo, hi, pos, n in zip(*(batch.column(c).to_pylist() for c in ("key", "lo", "hi", "pos", "n")), strict=True):
            block = [key, lo, hi, pos, n]
            while stack and stack[-1][0] == key and stack[-1][3] * block[4] >= block[3] * stack[-1][4]:
                before = stack.pop()
                block = [key, before[1], block[2], before[3] + block[3], before[4] + block[4]]
            stack.append(block)
        if len(stack) > 1 and stack[-1][0] != stack[0][0]:  # earlier keys are settled
            cut = next(i for i, b in enumerate(stack) if b[0] == stack[-1][0])
            yield _batch(stack[:cut])
            stack = stack[cut:]
    yield _batch(stack)


def _batch(blocks: list[list]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
    columns = list(zip(*blocks, strict=True)) if blocks else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["key", "lo", "hi", "pos", "n"])


def _violations(blocks: DataFrame) -> bool:
    """Whether blocks on both sides of a range's border fall in rate. The driver gets two blocks a range."""
    block = F.struct("key", "lo", "pos", "n")
    ends = blocks.groupBy("part").agg(F.min(block).alias("first"), F.max(block).alias("last")).collect()
    ends.sort(key=lambda r: (r.first.key, r.first.lo))
    return any(a.last.key == b.first.key and a.last.pos * b.first.n >= b.first.pos * a.last.n
               for a, b in zip(ends[:-1], ends[1:], strict=True))


def fit(df: DataFrame, score: str, label: str, key: str | None = None) -> DataFrame:
    """The steps of each ``key``: key, lo, hi, pos, n and ``value``, the rate of the block. Rows without score (or NaN) or
    label are left out."""
    spark = df.sparkSession
    ship(spark)
    x = F.col(score).cast("double")
    counts = (df.where(x.isNotNull() & ~F.isnan(x) & F.col(label).isNotNull())
              .groupBy((F.col(key).cast("int") if key else F.lit(0)).alias("key"), x.alias("lo"))
              .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.count("*").alias("n")))
    blocks = materialize(counts.select("key", "lo", F.col("lo").alias("hi"), "pos", "n"), "counts")
    turn = 0
    while True:
        parts = max(1, -(-blocks.count() // RANGE_BLOCKS))
        dealt = blocks.repartitionByRange(parts + turn % 2, "key", "lo") if parts > 1 else blocks.repartition(1)
        pooled = dealt.sortWithinPartitions("key", "lo").mapInArrow(_pool, SCHEMA)
        pooled = materialize(pooled.withColumn("part", F.spark_partition_id()), "blocks")
        blocks, turn = pooled.drop("part"), turn + 1  # other borders in the next turn
        if parts == 1 or not _violations(pooled):
            return blocks.withColumn("value", F.col("pos") / F.col("n"))


def interpolate(df: DataFrame, steps: DataFrame, score: str, out: str, bounds: tuple[float, float] = (1e-6, 1 - 1e-6)) -> DataFrame:
    """``df`` with ``out``: the value of the step that holds the score, on the line between the nearest ends of two steps,
    or the first or last value outside; clipped to ``bounds``. Null without a score or without steps.

    Steps meet rows by bucket: ranges of scores with few steps each, and the neighbouring step on either side. The
    driver sees the buckets' borders and ends, at most ``BUCKETS``.
    """
    spark = df.sparkSession
    block = F.struct("lo", "hi", "value")
    count = max(1, min(BUCKETS, steps.count() // BUCKET_BLOCKS))
    at = F.percentile_approx("lo", [i / count for i in range(1, count)] or [0.5], 4 * BUCKETS)
    bounds_of = sorted(set(steps.agg(at.alias("x")).first().x or [])) if count > 1 else []
    splits = [float("-inf"), *bounds_of, float("inf")]

    def bucketed(rows: DataFrame, column: str) -> DataFrame:
        if len(splits) == 2:
            return rows.withColumn("_bucket", F.lit(0.0))
        return Bucketizer(splits=splits, inputCol=column, outputCol="_bucket", handleInvalid="keep").transform(rows)

    cells = materialize(bucketed(steps.select("lo", "hi", "value"), "lo"), "steps")
    ends = {r._bucket: r for r in cells.groupBy("_bucket").agg(F.min(block).alias("first"), F.max(block).alias("last")).collect()}
    beside, before = [], None
    for i in range(len(splits) - 1):
        after = next((ends[float(j)].first for j in range(i + 1, len(splits) - 1) if float(j) in ends), None)
        beside.append((float(i), [tuple(before)] if before else [], [tuple(after)] if after else []))
        before = ends[float(i)].last if float(i) in ends else before
    kind = "array<struct<lo: double, hi: double, value: double>>"
    beside = spark.createDataFrame(beside, f"_bucket double, before {kind}, after {kind}")
    own = cells.groupBy("_bucket").agg(F.array_sort(F.collect_list(block)).alias("own"))
    table = (beside.join(own, "_bucket", "left")
             .select("_bucket", F.concat("before", F.coalesce("own", F.array().cast(kind)), "after").alias("_steps")))
    x = F.col("_x")
    place = F.size(F.filter("_steps", lambda s: s["lo"] <= x))
    this, after = F.get("_steps", F.greatest(place - 1, F.lit(0))), F.get("_steps", place)
    slope = (after["value"] - this["value"]) / (after["lo"] - this["hi"])
    value = F.when((place == 0) | after.isNull() | (x <= this["hi"]), this["value"]).otherwise(
        this["value"] + (x - this["hi"]) * slope)
    value = F.when(x.isNotNull() & ~F.isnan(x) & value.isNotNull(), F.greatest(F.lit(bounds[0]), F.least(value, F.lit(bounds[1]))))
    rows = bucketed(df.withColumn("_x", F.col(score).cast("double")), "_x")
    return rows.join(table, "_bucket", "left").select(*df.columns, value.alias(out))
