"""Exact distributed quantiles, winsorizing and robust (median / IQR) z-scores by group.

All columns are handled together (no per-column passes). Statistics tables have
one row, or one row per group of codes; they are broadcast back if their rows are few, and
joined otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ACCURACY = 10_000
"""Rank error of the sketch that brackets a quantile: one in so many rows."""
BOUND, GRID = 100_000, 200
"""Distinct values that one task ranks at most, and into how many ranges more of them are cut."""
BROADCAST_ROWS = 100_000


def _same(keys: Sequence[str], prefix: str):
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _sized(stats: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``stats`` to be broadcast if ``of`` (itself by default), which has as many rows, is small enough; else as it is."""
    return F.broadcast(stats) if (of or stats).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else stats


def _beside(df: DataFrame, stats: DataFrame, keys: Sequence[str], prefix: str = "_key_", of: DataFrame | None = None) -> DataFrame:
    """``df`` beside its group's row of ``stats`` (null keys match). One row is broadcast; one row a group if there are
    few groups, counted in ``of``."""
    if not keys:
        return df.crossJoin(F.broadcast(stats))
    stats = stats.select(*[F.col(k).alias(prefix + k) for k in keys], *[c for c in stats.columns if c not in keys])
    return df.join(_sized(stats, of), _same(keys, prefix), "left").drop(*[prefix + k for k in keys])


def _narrowed(values: DataFrame, ranks: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """Values (v, n) and ranks (below, low, high) of each group with at most ``BOUND`` distinct values a group.

    As long as a group has more, its distinct values are cut into ``GRID`` ranges, the rows of each range are counted, and
    only the ranges stay that hold one of the two wanted ranks; the rows of earlier ones are added to ``below``. Ranges are
    exact wherever the sketch puts their borders, so no rank is lost.
    """
    while (values.groupBy(*group).agg(F.count("*").alias("d")).agg(F.max("d")).first()[0] or 0) > BOUND:
        grid = values.groupBy(*group).agg(F.percentile_approx("v", [i / GRID for i in range(1, GRID)], ACCURACY).alias("grid"))
        cut = _beside(values, grid, group, of=ranks).withColumn("range", F.size(F.filter("grid", lambda e: e < F.col("v")))).drop("grid")
        ranges = cut.groupBy(*group, "range").agg(F.sum("n").alias("rows"))
        before = F.sum("rows").over(Window.partitionBy(*group).orderBy("range")) - F.col("rows")  # over GRID rows at most
        ranges = _beside(ranges.withColumn("before", before), ranks, group)
        start = F.col("below") + F.col("before")
        held = materialize(ranges.where((start <= F.col("high")) & (start + F.col("rows") > F.col("low")))
                           .select(*group, "range", start.alias("start"), "low", "high", "part"), "ranges")
        ranks = materialize(held.groupBy(*group).agg(F.min("start").alias("below"), F.first("low").alias("low"),
                                                     F.first("high").alias("high"), F.first("part").alias("part")), "ranks")
        kept = _beside(cut, held.select(*group, "range", F.lit(True).alias("held")), [*group, "range"])
        values = materialize(kept.where("held").select(*group, "v", "n"), "values")
    return values, ranks


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
                    prefix: str = "_q_") -> DataFrame:
    """keys and ``prefix + col``: the exact quantiles (linear interpolation) of each column as an array.

    A mergeable sketch of each column first brackets each quantile. Then one pass counts the rows between brackets and the
    values inside them; a bracket that doesn't hold the wanted ranks is opened. Only the values inside meet to be
    ranked, and where these are many they are narrowed down first (``_narrowed``), so that a task ranks ``BOUND`` values at
    most. A group of up to twice ``ACCURACY`` rows, where the sketch's error is under a rank or two, is its own bracket.
    ``df`` is read twice (a third time only where a bracket is opened), so it should be materialized.
    """
    cols, keys, k = list(cols), list(keys), len(probs)
    width = 2 / ACCURACY
    ends = [x for q in probs for x in (max(0.0, q - width), min(1.0, q + width))]
    group = [*keys, "j"]
    # a sketch a column in one row a group: long rows would have a group a column, and many groups are sorted
    number = [F.col(c).cast("double") for c in cols]
    sketch = df.groupBy(*keys).agg(*[F.struct(F.lit(j).alias("j"), F.count(x).alias("of"), F.percentile_approx(x, ends, ACCURACY).alias("ends"))
                                     .alias(f"_s{j}") for j, x in enumerate(number)])
    sketch = materialize(sketch, "brackets")
    first = sketch.select(*keys, F.inline(F.array(*[F.col(f"_s{j}") for j in range(len(cols))]))).where("of > 0")
    first = first.withColumn("ends", F.when(F.col("of") > 2 * ACCURACY, F.col("ends")))  # else its own bracket
    # long rows, which only live inside a task: short expressions, whatever the number of columns
    packed = F.array(*[F.struct(F.lit(j).alias("j"), x.alias("v")) for j, x in enumerate(number)])
    data = df.select(*keys, F.inline(packed)).where(F.col("v").isNotNull())
    v, end = F.col("v"), F.col("ends")

    # a value inside a bracket is a cell of its own, all values between the same two ends are one, under any of them
    within = F.coalesce(reduce(lambda x, y: x | y, [v.between(end[2 * i], end[2 * i + 1]) for i in range(k)]), F.lit(True))
    cell = F.coalesce(F.size(F.filter("ends", lambda e: e < v)), F.lit(0))
    cells = _beside(data, first, group, of=sketch).select(*group, "v", cell.alias("cell"), F.when(within, v).alias("own"))
    cells = cells.groupBy(*group, "cell", "own").agg(F.max("v").alias("v"), F.count("*").alias("n"))
    cells = materialize(cells.select(*group, F.col("own").isNotNull().alias("within"), "v", "n"), "cells")

    # counts only: the ends are arrays, and a sum beside them would sort the rows
    counts = _beside(cells, first, group, of=sketch).groupBy(*group).agg(
        *[F.sum(F.when(F.coalesce(v < end[2 * i], F.lit(False)), F.col("n")).otherwise(0)).alias(f"below{i}") for i in range(k)],
        *[F.sum(F.when(F.coalesce(v <= end[2 * i + 1], F.lit(True)), F.col("n")).otherwise(0)).alias(f"upto{i}") for i in range(k)])
    counts = _beside(counts, first, group, of=sketch)

    def rank(i: int):
        place = (F.col("of") - 1) * F.lit(float(probs[i]))
        low = F.floor(place)
        high = F.least(low + 1, F.col("of") - 1)
        holds = (F.col(f"below{i}") <= low) & (high < F.col(f"upto{i}"))
        return F.struct(F.lit(i).alias("i"), F.when(holds, end[2 * i]).alias("lo"), F.when(holds, end[2 * i + 1]).alias("hi"),
                        F.when(holds, F.col(f"below{i}")).otherwise(F.lit(0)).cast("long").alias("below"),
                        F.when(holds, F.col(f"upto{i}") - F.col(f"below{i}")).otherwise(F.col("of")).alias("inside"),
                        low.alias("low"), high.alias("high"), (place - low).alias("part"), holds.alias("holds"))

    brackets = materialize(counts.select(*group, F.array(*[rank(i) for i in range(k)]).alias("ranks")), "ranks")
    inside = F.transform(F.filter("ranks", lambda r: F.coalesce(v >= r["lo"], F.lit(True)) & F.coalesce(v <= r["hi"], F.lit(True))),
                         lambda r: r["i"])
    ranks = brackets.select(*group, F.inline("ranks"))
    most = ranks.agg(F.max("inside").alias("inside"), F.bool_and("holds").alias("hold")).first()
    ranks = ranks.drop("holds")
    found = cells.where("within") if most.hold is not False else data.withColumn("n", F.lit(1).cast("long"))
    values = _beside(found, brackets, group, of=sketch).select(*group, F.explode(inside).alias("i"), "v", "n")
    values = values.groupBy(*group, "i", "v").agg(F.sum("n").alias("n"))
    group_i = [*group, "i"]
    if (most.inside or 0) > BOUND:
        values, ranks = _narrowed(materialize(values, "values"), ranks, group_i)
    upto = F.sum("n").over(Window.partitionBy(*group_i).orderBy("v"))
    ranked = _beside(values.withColumn("upto", upto), ranks, group_i)
    to = F.col("below") + F.col("upto")
    edge = ranked.groupBy(*group_i).agg(F.min(F.when(to > F.col("low"), v)).alias("a"), F.min(F.when(to > F.col("high"), v)).alias("b"),
                                        F.max("part").alias("part"))
    gap = F.col("b") - F.col("a")
    x = F.when(F.col("part") >= 0.5, F.col("b") - gap * (1 - F.col("part"))).otherwise(F.col("a") + gap * F.col("part"))
    lists = edge.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("i", x.alias("x")))).alias("xs"))
    lists = lists.select(*keys, "j", F.transform("xs", lambda e: e["x"]).alias("xs"))
    found = lists.groupBy(*keys).agg(*[F.max(F.when(F.col("j") == j, F.col("xs"))).alias(prefix + c)
                                       for j, c in enumerate(cols)])
    # groups (or the whole table) without any number have nulls
    every = sketch.select(*keys) if keys else df.sparkSession.range(1).select()
    return _beside(every, found, keys, of=sketch)


def winsorize(df: DataFrame, cols: Sequence[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clip each column to its own [lower, upper] quantiles; columns become double."""
    cols = list(cols)
    if not cols:
        return df
    j = _beside(df, exact_quantiles(df, cols, (lower, upper)), [])
    out = []
    for c in df.columns:
        if c in cols:
            x = F.col(c).cast("double")
            lo, hi = F.col("_q_" + c)[0], F.col("_q_" + c)[1]
            out.append(F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def robust_zscore(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (
        "sector_code", "size_bucket"), min_group: int = 10, suffix: str = "__zs_sector_size") -> DataFrame:
    """``(x - median) / IQR`` within each group, appended as ``<col><suffix>``.

    Groups with fewer than ``min_group`` rows (rows, not non-nulls) use the
    global median / IQR. IQR <= 0 falls back to |median|, or 1.0 when the
    median is 0. NULL group keys form their own group (null-safe join).
    The per-group (center, scale) pairs are resolved on the small statistics
    table, so each row only evaluates ``(x - center) / scale``.
    """
    cols, gcols = list(cols), list(group_cols)
    probs = (0.25, 0.5, 0.75)
    sizes = materialize(df.groupBy(*gcols).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    stats = _beside(sizes, exact_quantiles(df, cols, probs, gcols, prefix="_s_"), gcols, of=sizes)
    small = bool(sizes.where(F.col("_n") < min_group).take(1))  # only these take the global ones
    if small:
        stats = _beside(stats, exact_quantiles(df, cols, probs, prefix="_g_"), [])
    resolved = []
    for c in cols:
        st = F.col("_s_" + c)
        if small:
            st = F.when(F.col("_n") < min_group, F.col("_g_" + c)).otherwise(st)
        med = st[1]
        iqr = st[2] - st[0]
        scale = F.when(iqr > 0, iqr).when(med != 0, F.abs(med)).otherwise(F.lit(1.0))
        resolved += [med.alias("_c_" + c), scale.alias("_k_" + c)]
    j = _beside(df, stats.select(*gcols, *resolved), gcols, of=sizes)
    zs = [((F.col(c).cast("double") - F.col("_c_" + c)) / F.col("_k_" + c)).alias(c + suffix)
          for c in cols]
    return j.select(*[F.col(c) for c in df.columns], *zs)
