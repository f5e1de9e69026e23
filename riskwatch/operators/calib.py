"""Quantile-bin calibration tables (deciles), their linear fit and reliability curves.

Quantile edges are exact linear-interpolation order statistics computed from
the per-score counts (``ranking.cumulative_counts``): every score row learns,
from a small per-group table of wanted positions, which positions fall inside
its cumulative-count range. No sort of the raw rows, no per-group value map.
Bins follow ``qcut(duplicates="drop")``: bin = number of interior edges < p,
with the first bin closed on the left; empty bins vanish and deciles are
renumbered 1..k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import cumulative_counts, score_counts


def qcut_probs(n_bins: int) -> list[float]:
    """Probabilities a quantile cut into ``n_bins`` actually evaluates:
    evenly spaced points, passed through a percent scale and back."""
    return [((i * (1.0 / n_bins) if i < n_bins else 1.0) * 100.0) / 100.0 for i in range(n_bins + 1)]


def percent_probs(n_bins: int) -> list[float]:
    """Probabilities of percentile edges 0, 100/n, ..., 100 (in percent, then / 100)."""
    step = 100.0 / n_bins
    return [(i * step if i < n_bins else 100.0) / 100.0 for i in range(n_bins + 1)]


def quantiles_from_counts(cum: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per group: ``edges`` = linear-interpolation quantiles at ``probs`` (ascending).

    ``cum`` is the output of ``cumulative_counts`` (``_s``, ``n``, ``cum_n``,
    ``tot_n``). Position arithmetic follows the common array-library recipe
    (virtual index ``(n - 1) q``, two-sided lerp), so that scores
    tied exactly at an edge fall on the same side as in the reference.
    Each score row finds the wanted positions inside its cumulative range;
    there is no sort of the raw rows.
    """
    keys = list(keys)
    T = F.col("tot_n").cast("double")

    def pos(i: int, q: float):
        vi = (T - F.lit(1.0)) * F.lit(float(q))
        above = vi >= (T - F.lit(1.0))
        below = vi < F.lit(0.0)
        prev = F.floor(vi).cast("long")
        lo = F.when(above, F.col("tot_n") - 1).when(below, F.lit(0)).otherwise(prev)
        hi = F.when(above, F.col("tot_n") - 1).when(below, F.lit(0)).otherwise(prev + 1)
        g = F.when(above | below, F.lit(0.0)).otherwise(vi - prev.cast("double"))
        return F.struct(F.lit(i).alias("i"), lo.alias("lo"), hi.alias("hi"), g.alias("_gm"))

    wanted = F.array(*[pos(i, q) for i, q in enumerate(probs)])
    before = F.col("cum_n") - F.col("n")
    rows = cum.select(*keys, "_s", F.inline(F.filter(wanted, lambda w: (
        ((w["lo"] >= before) & (w["lo"] < F.col("cum_n")))
        | ((w["hi"] >= before) & (w["hi"] < F.col("cum_n")))))))
    # (keys, i) touches one or two score rows: the smaller holds position lo, the larger hi
    g = rows.groupBy(*keys, "i", "_gm").agg(F.min("_s").alias("_a"), F.max("_s").alias("_b"))
    d = F.col("_b") - F.col("_a")
    edge = F.when(F.col("_gm") >= 0.5, F.col("_b") - d * (F.lit(1.0) - F.col("_gm"))).otherwise(
        F.col("_a") + d * F.col("_gm"))
    return g.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", edge.alias("e")))),
                    lambda s: s["e"]).alias("edges"))


def _edges(df: DataFrame, keys: Sequence[str], score: str, label: str, n_bins: int,
           buckets: int | None):
    keys = list(keys)
    counts = materialize(score_counts(df, keys, score, label), "counts")  # read for edges, sums and bins
    cum = cumulative_counts(counts, keys, buckets)
    return counts, quantiles_from_counts(cum, keys, qcut_probs(n_bins))


def bin_index(score_col, interior_edges_col):
    return F.size(F.filter(interior_edges_col, lambda e: e < score_col))


def decile_calibration(df: DataFrame, keys: Sequence[str], score: str, label: str,
                       n_bins: int = 10, buckets: int | None = None) -> DataFrame:
    """keys, decile, count, pd_avg, odr, abs_err_bp."""
    keys = list(keys)
    counts, edges = _edges(df, keys, score, label, n_bins, buckets)
    uniq = F.array_distinct(F.col("edges"))
    interior = F.slice(uniq, 2, F.greatest(F.size(uniq) - 2, F.lit(0)))
    j = counts.join(edges.select(*keys, interior.alias("_int")), keys, "inner") if keys else \
        counts.crossJoin(F.broadcast(edges.select(interior.alias("_int"))))
    b = j.select(*keys, bin_index(F.col("_s"), F.col("_int")).alias("_bin"), "_s", "n", "n_pos")
    agg = b.groupBy(*keys, "_bin").agg(
        F.sum("n").alias("count"), (F.sum(F.col("_s") * F.col("n")) / F.sum("n")).alias("pd_avg"),
        (F.sum("n_pos") / F.sum("n")).alias("odr"))
    w = Window.partitionBy(*keys).orderBy("_bin")
    return agg.select(*keys, F.dense_rank().over(w).cast("int").alias("decile"), "count",
                      "pd_avg", "odr", (F.abs(F.col("pd_avg") - F.col("odr")) * 1e4).alias("abs_err_bp"))


def reliability_curve(df: DataFrame, keys: Sequence[str], score: str, label: str,
                      n_bins: int = 10, buckets: int | None = None) -> DataFrame:
    """Quantile-strategy reliability curve: bin, prob_pred, prob_true (empty bins dropped)."""
    keys = list(keys)
    counts, edges = _edges(df, keys, score, label, n_bins, buckets)
    interior = F.slice(F.col("edges"), 2, n_bins - 1)
    j = counts.join(edges.select(*keys, interior.alias("_int")), keys, "inner") if keys else \
        counts.crossJoin(F.broadcast(edges.select(interior.alias("_int"))))
    b = j.select(*keys, bin_index(F.col("_s"), F.col("_int")).cast("int").alias("bin"), "_s", "n", "n_pos")
    return b.groupBy(*keys, "bin").agg(
        (F.sum(F.col("_s") * F.col("n")) / F.sum("n")).alias("prob_pred"),
        (F.sum("n_pos") / F.sum("n")).alias("prob_true"))


def decile_linear_fit(df: DataFrame, keys: Sequence[str], score: str, label: str,
                      n_bins: int = 10, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Monitoring calibration: deciles (pd_avg, odr rounded to 5) and the fit
    ``odr ~ pd_avg`` over decile means (slope 4 / intercept 5 places); (1, 0)
    when fewer than 3 deciles survive."""
    keys = list(keys)
    dec = decile_calibration(df, keys, score, label, n_bins, buckets).select(
        *keys, "decile", F.bround("pd_avg", 5).alias("pd_avg"), F.bround("odr", 5).alias("odr"),
        "count")
    ev = df.groupBy(*keys).agg(F.bround(F.avg(F.col(label).cast("double")), 5).alias("expected_odr"))
    fit = dec.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_deciles"),
        F.regr_slope("odr", "pd_avg").alias("_sl"), F.regr_intercept("odr", "pd_avg").alias("_ic"))
    fit = fit.select(*keys, "n_deciles",
                     F.when(F.col("n_deciles") >= 3, F.bround("_sl", 4)).otherwise(1.0).alias("slope"),
                     F.when(F.col("n_deciles") >= 3, F.bround("_ic", 5)).otherwise(0.0).alias("intercept"))
    fit = fit.join(ev, keys, "inner") if keys else fit.crossJoin(F.broadcast(ev))
    return dec, fit
