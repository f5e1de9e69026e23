"""Reusable window patterns.

* ``tail_flags``     — "last N rows per key" (pandas ``groupby.tail(n)``): one window
  per key over the rows of the observation window, with a full order.
* ``prefix_sums``    — cumulative sums per key in a given order as a two-phase
  scan: bucket totals -> offsets (tiny window) -> local running sums inside each
  (key, bucket). No task ever sees more than one bucket of one key.
* ``quantile_buckets`` — monotone bucket ids from approximate quantiles, the
  usual input of ``prefix_sums``.
* ``max_streak``     — longest run of consecutive rows meeting a threshold: gaps and
  islands inside spans of days, whose summaries merge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_buckets(df: DataFrame) -> int:
    """Buckets of a group: as many as shuffle partitions, which are set by the size of the data."""
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def tail_flags(df: DataFrame, key: str | Sequence[str], order_col: str,
               sizes: Mapping[str, int], tiebreak: Sequence[str]) -> DataFrame:
    """Add one boolean column per entry of ``sizes``: row is among the last n of its key.

    Order is ``order_col`` then ``tiebreak`` (both ascending); "last" means
    latest. ``tiebreak`` must tell rows of one ``order_col`` apart, or the choice
    among them would be arbitrary. ``df`` should hold the observation window only,
    which bounds the rows of a key.
    """
    if not tiebreak:
        raise ValueError("tail_flags needs a tiebreak for rows of one date")
    w = Window.partitionBy(*_as_list(key)).orderBy(*[F.col(c).desc() for c in (order_col, *tiebreak)])
    ranked = df.withColumn("_pos", F.row_number().over(w))
    return ranked.select(*df.columns, *[(F.col("_pos") <= F.lit(int(n))).alias(name) for name, n in sizes.items()])


def quantile_buckets(df: DataFrame, keys: Sequence[str], order_col: str, n: int,
                     name: str = "_bucket", accuracy: int = 10000) -> DataFrame:
    """Monotone bucket id in [0, n) from approximate per-key quantiles of ``order_col``."""
    keys = list(keys)
    probs = [i / n for i in range(1, n)]
    if keys:
        edges = df.groupBy(*keys).agg(
            F.percentile_approx(order_col, probs, accuracy).alias("_edges"))
        out = df.join(edges, on=keys, how="inner")
    else:
        edges = df.agg(F.percentile_approx(order_col, probs, accuracy).alias("_edges"))
        out = df.crossJoin(F.broadcast(edges))  # one row, bounded
    return (out.withColumn(name, F.size(F.filter("_edges", lambda e: e < F.col(order_col))))
            .drop("_edges"))


def prefix_sums(df: DataFrame, keys: Sequence[str], order_col: str,
                value_cols: Sequence[str], ascending: bool = True,
                buckets: int | None = None, prefix: str = "cum_",
                tiebreak: Sequence[str] = (), bucket: Column | None = None) -> DataFrame:
    """Running (inclusive) sums of ``value_cols`` per ``keys`` in ``order_col`` order.

    ``order_col`` (with ``tiebreak``) must be unique within a key. The two-phase
    scan bounds each window partition to one bucket of one key: quantile buckets,
    or ``bucket``, a monotone bucket number of ``order_col``, where that is known
    (a hash), which saves the quantile pass and its join. ``buckets=1`` is a plain
    window.
    """
    keys = list(keys)
    buckets = prefix_buckets(df) if buckets is None else buckets

    def order(*cols):
        return [F.col(c).asc() if ascending else F.col(c).desc() for c in cols]

    if buckets <= 1 and bucket is None:
        w = (Window.partitionBy(*keys).orderBy(*order(order_col, *tiebreak))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.select("*", *[F.sum(v).over(w).alias(prefix + v) for v in value_cols])

    b = df.withColumn("_b", bucket) if bucket is not None else quantile_buckets(df, keys, order_col, buckets, name="_b")
    totals = b.groupBy(*keys, "_b").agg(*[F.sum(v).alias("_t_" + v) for v in value_cols])
    wb = Window.partitionBy(*keys).orderBy(*order("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_b", *[
        F.coalesce(F.sum("_t_" + v).over(wb), F.lit(0)).alias("_o_" + v) for v in value_cols])
    wl = (Window.partitionBy(*keys, "_b").orderBy(*order(order_col, *tiebreak))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(v).over(wl).alias("_l_" + v) for v in value_cols])
    joined = local.join(offsets, on=keys + ["_b"], how="inner")
    return joined.select(*df.columns, *[(F.col("_o_" + v) + F.col("_l_" + v)).alias(prefix + v) for v in value_cols])


def max_streak(df: DataFrame, key: str | Sequence[str], order_col: str, value_col: str, threshold: float,
               tiebreak: Sequence[str], name: str = "max_streak", days: int = 32) -> DataFrame:
    """Longest run of consecutive rows with ``value >= threshold`` per key (0 if none).

    The rows of a key are cut into spans of ``days`` days of the date ``order_col``. Inside a span, the running count of
    breaking rows (below the threshold or NULL) labels each island, and the span is summed up as its rows, its
    qualifying rows at the start and at the end, and its longest run. Summaries of neighbouring spans merge into one of
    both, so a key of any length is split over tasks, and only one summary a span meets at the
    key. ``tiebreak`` orders rows of one day.
    """
    if not tiebreak:
        raise ValueError("max_streak needs a tiebreak for rows of one date")
    keys = _as_list(key)
    ok = F.coalesce(F.col(value_col) >= F.lit(threshold), F.lit(False))
    day = F.datediff(F.col(order_col).cast("date"), F.lit("1970-01-01").cast("date"))
    w = (Window.partitionBy(*keys, "_span").orderBy(order_col, *tiebreak)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = df.withColumn("_span", F.floor(day / days))
    islands = spans.select(*keys, "_span", ok.alias("_ok"), F.sum(F.when(ok, 0).otherwise(1)).over(w).alias("_isl"))
    runs = islands.groupBy(*keys, "_span", "_isl").agg(F.sum(F.col("_ok").cast("long")).alias("_run"), F.count("*").alias("_n"))
    last = F.max_by("_run", "_isl")
    summary = runs.groupBy(*keys, "_span").agg(
        F.sum("_n").alias("rows"), F.coalesce(F.max(F.when(F.col("_isl") == 0, F.col("_run"))), F.lit(0)).alias("head"),
        last.alias("tail"), F.max("_run").alias("best"))
    parts = F.array_sort(F.collect_list(F.struct("_span", "rows", "head", "tail", "best")))  # one entry a span

    def merged(a, b):
        joined = a["tail"] + b["head"]
        return F.struct(
            (a["rows"] + b["rows"]).alias("rows"),
            F.when(a["head"] == a["rows"], a["rows"] + b["head"]).otherwise(a["head"]).alias("head"),
            F.when(b["tail"] == b["rows"], joined + b["tail"] - b["head"]).otherwise(b["tail"]).alias("tail"),
            F.greatest(a["best"], b["best"], joined).alias("best"))

    zero = F.lit(0).cast("long")
    none = F.struct(zero.alias("rows"), zero.alias("head"), zero.alias("tail"), zero.alias("best"))
    return summary.groupBy(*keys).agg(parts.alias("_parts")).select(
        *keys, F.aggregate("_parts", none, merged)["best"].alias(name))
