"""Monthly cohort backtest: one job grouped by month (no per-month driver loop).

Cohort preparation = month key -> month range (minus immature months) ->
one row per (month, customer) -> minimum cohort size before and after dropping
NULL score / label -> clipped probability. All metric families then run on the
same prepared frame, grouped by month (or month x segment).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip_prob
from ..session import materialize
from ..sources.sinks import read_latest, sink_upsert
from . import calib, ranking

MONTH = "as_of_month"


@dataclass
class BacktestParams:
    start: str                     # "YYYY-MM"
    end: str                       # "YYYY-MM"
    pd_col: str = "pd_12m"
    y_col: str = "y_event_6m"
    as_of_col: str = "as_of_date"
    id_col: str = "customer_id"
    tiebreak: str | None = None    # stable row order inside a (month, customer) / score tie
    amber: float = 0.02
    red: float = 0.05
    min_records: int = 200
    drop_last_n: int = 0
    cuts: tuple = ()
    n_bins: int = 10
    segment_col: str | None = None
    segment_min_records: int | None = None   # min_records if not given
    buckets: int | None = None


def month_key(c) -> "F.Column":
    return F.last_day(F.to_date(c))


def filter_month_range(df: DataFrame, start: str, end: str, drop_last_n: int = 0,
                       month_col: str = MONTH) -> DataFrame:
    """Months in [start, end]; the last ``drop_last_n`` are dropped unless that
    would drop every month."""
    s = F.last_day(F.to_date(F.lit(start + "-01")))
    e = F.last_day(F.to_date(F.lit(end + "-01")))
    y0, m0 = map(int, start.split("-"))
    y1, m1 = map(int, end.split("-"))
    n_months = (y1 - y0) * 12 + (m1 - m0) + 1
    if 0 < drop_last_n < n_months:
        e = F.last_day(F.add_months(e, -drop_last_n))
    return df.filter((F.col(month_col) >= s) & (F.col(month_col) <= e))


def dedup_cohort(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order`` — as a min_by aggregate (skew-safe, deterministic)."""
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r"))
            .select(*keys, "_r.*"))


def filter_min_records(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Keep groups with at least ``n`` rows (group sizes joined back, no window)."""
    keys = list(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")).filter(F.col("_cnt") >= n)
    return df.join(sizes.select(*keys), keys, "left_semi")


def dropna_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def prepare_cohorts(df: DataFrame, p: BacktestParams) -> DataFrame:
    """Month key, range, dedup, size filters, clipped ``_p`` and integer ``_y``."""
    d = df.withColumn(MONTH, month_key(p.as_of_col))
    d = filter_month_range(d, p.start, p.end, p.drop_last_n)
    if p.id_col in d.columns:
        order = [p.as_of_col] + ([p.tiebreak] if p.tiebreak else [])
        d = dedup_cohort(d, [MONTH, p.id_col], order)
    # size checks before and after dropping NULL score / label, in ONE aggregation
    ok = F.col(p.pd_col).isNotNull() & F.col(p.y_col).isNotNull()
    sizes = d.groupBy(MONTH).agg(F.count(F.lit(1)).alias("_all"), F.count_if(ok).alias("_ok"))
    keep = sizes.filter((F.col("_all") >= p.min_records) & (F.col("_ok") >= p.min_records)).select(MONTH)
    d = dropna_subset(d.join(keep, MONTH, "left_semi"), [p.pd_col, p.y_col])
    return d.withColumn("_p", clip_prob(p.pd_col)).withColumn("_y", F.col(p.y_col).cast("int"))


def cohort_metrics(d: DataFrame, keys: Sequence[str], p: BacktestParams,
                   min_records: int | None = None) -> DataFrame:
    """All metrics for each group of a prepared cohort frame, one row per group."""
    keys = list(keys)
    if min_records:
        d = filter_min_records(d, keys, min_records)
    cum = materialize(ranking.cumulative_scores(d, keys, "_p", "_y", p.buckets), "scores")
    rm = ranking.rank_metrics(d, keys, "_p", "_y", cum=cum)
    br = ranking.brier(d, keys, "_p", "_y")
    lf = ranking.lift_wide(d, keys, "_p", "_y", (0.1, 0.2), p.tiebreak, p.buckets, cum)
    te = ranking.threshold_eval(d, keys, "_p", "_y", {"amber": p.amber, "red": p.red})
    out = rm.join(br, keys).join(lf, keys).join(te, keys)
    return out.select(
        *keys, "auc", "ks", "brier", "pr_auc", "lift_10pct", "lift_20pct",
        *[f"{n}_{m}" for n in ("amber", "red") for m in ("alert_rate", "precision", "recall", "alerts")])


def metrics_roll12(m: DataFrame, cols=("auc", "ks", "brier", "pr_auc"), order_col: str = MONTH,
                   part: Sequence[str] = ("pd_col", "y_col"), window: int = 12,
                   min_periods: int = 3) -> DataFrame:
    """Rolling mean over the last ``window`` rows (months present), needing
    ``min_periods`` non-null values. Runs on the small per-month table."""
    w = Window.partitionBy(*part).orderBy(order_col).rowsBetween(-(window - 1), 0)
    return m.select("*", *[
        F.when(F.count(c).over(w) >= min_periods, F.avg(c).over(w)).alias(f"{c}_roll12")
        for c in cols])


def monthly_metrics(d: DataFrame, p: BacktestParams) -> DataFrame:
    return metrics_roll12(_named(cohort_metrics(d, [MONTH], p), p))


def _named(m: DataFrame, p: BacktestParams) -> DataFrame:
    """Monthly metrics with the names and cuts of the run."""
    return m.select(MONTH, F.lit(p.pd_col).alias("pd_col"), F.lit(p.y_col).alias("y_col"),
                    F.lit(float(p.amber)).alias("amber"), F.lit(float(p.red)).alias("red"),
                    *[c for c in m.columns if c != MONTH])


def segment_metrics(d: DataFrame, p: BacktestParams, segment_col: str) -> DataFrame:
    """Metrics by (month, segment); NULL segments dropped; size filter per segment."""
    s = d.filter(F.col(segment_col).isNotNull()).withColumn("segment", F.col(segment_col))
    m = cohort_metrics(s, [MONTH, "segment"], p, min_records=p.segment_min_records or p.min_records)
    return m.select(MONTH, F.lit(segment_col).alias("segment_col"),
                    *[c for c in m.columns if c != MONTH])


def backtest_monthly(df: DataFrame, p: BacktestParams) -> dict[str, DataFrame]:
    """metrics (with rolling 12), calibration deciles, threshold sweep, segments."""
    d = materialize(prepare_cohorts(df, p))  # feeds every metric family below
    out = {
        "metrics": monthly_metrics(d, p),
        "calibration": calib.decile_calibration(d, [MONTH], "_p", "_y", p.n_bins, p.buckets),
        "sweep": ranking.threshold_sweep(d, [MONTH], "_p", "_y", p.cuts) if p.cuts else None,
    }
    if p.segment_col:
        out["segments"] = segment_metrics(d, p, p.segment_col)
    return out


def update_backtest(batch: DataFrame, base: str, p: BacktestParams) -> DataFrame:
    """The monthly metrics of all rows given so far, after one more batch of cohort rows.

    Two upsert tables under ``base`` are kept, both by month: the rows of each cohort, one a customer, and the
    metrics of each cohort. A batch, with a new month or with late rows of old ones, is merged into the cohorts of its
    months, whose metrics are made again; cohorts of other months are neither read nor written. The
    months at the end that ``drop_last_n`` leaves out and the rolling means come from the small table of metrics.
    Rows without a month are left out.
    """
    spark, cohorts, metrics = batch.sparkSession, f"{base}/cohorts", f"{base}/metrics"
    batch = materialize(batch.withColumn(MONTH, month_key(p.as_of_col)).where(F.col(MONTH).isNotNull()), "batch")
    months = [r[0] for r in batch.select(MONTH).distinct().collect()]  # as many as cohorts
    order = [p.as_of_col] + ([p.tiebreak] if p.tiebreak else [])

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return dedup_cohort(new if old is None else old.unionByName(new), [MONTH, p.id_col], order)

    if months:
        sink_upsert(batch, cohorts, [MONTH, p.id_col], partition_by=MONTH, merge=merge)
        touched = read_latest(spark, cohorts, months)
        own = cohort_metrics(materialize(prepare_cohorts(touched, replace(p, drop_last_n=0))), [MONTH], p)
        # a month without a cohort any more leaves a row that says so
        every = spark.createDataFrame([(m,) for m in months], f"{MONTH} date")
        own = every.join(own.withColumn("_valid", F.lit(True)), MONTH, "left")
        sink_upsert(own, metrics, [MONTH], partition_by=MONTH, merge=lambda old, new: new)
    found = read_latest(spark, metrics)
    if found is None:
        found = cohort_metrics(prepare_cohorts(batch, p), [MONTH], p).withColumn("_valid", F.lit(True))
    found = filter_month_range(found.where("_valid").drop("_valid"), p.start, p.end, p.drop_last_n)
    return metrics_roll12(_named(found, p))
