"""Report views over backtest / stress results: confidence intervals, pooled
tables, bands, nearest cut, best / worst months, KPI triggers, workload,
alert overlap, capture, stress contribution / traffic light / sensitivity,
extra behaviour features and exposure buckets.

Inputs are the small per-month / per-cut / per-level result tables (or the
prepared cohort rows for count-based intervals); windows run on those small
tables only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import max_streak
from . import stress as ST

Z95 = 1.959963984540054


def wilson(p, n, z: float = Z95):
    """(lower, upper) Wilson score interval columns; (p, p) when n = 0 or p is NULL."""
    n_d = n.cast("double")
    den = F.lit(1.0) + F.lit(z * z) / n_d
    centre = (p + F.lit(z * z) / (F.lit(2.0) * n_d)) / den
    margin = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n_d + F.lit(z * z) / (F.lit(4.0) * n_d * n_d)) / den
    ok = (n > 0) & p.isNotNull()
    return (F.when(ok, F.greatest(F.lit(0.0), centre - margin)).otherwise(p),
            F.when(ok, F.least(F.lit(1.0), centre + margin)).otherwise(p))


def wilson_ci(prepared: DataFrame, keys: Sequence[str], score: str, label: str,
              cuts: dict[str, float]) -> DataFrame:
    """Precision / recall with Wilson intervals per group and named cut, from real
    counts (alerts for precision, events for recall)."""
    keys = list(keys)
    y = F.col(label).cast("long")
    aggs = [F.sum(y).alias("events")]
    for n, c in cuts.items():
        hit = F.col(score) >= F.lit(float(c))
        aggs += [F.count_if(hit).alias(f"{n}_alerts"), F.sum(F.when(hit, y).otherwise(0)).alias(f"{n}_tp")]
    a = prepared.groupBy(*keys).agg(*aggs)
    cols = []
    for n in cuts:
        prec = F.when(F.col(f"{n}_alerts") > 0, F.col(f"{n}_tp") / F.col(f"{n}_alerts"))
        rec = F.when(F.col("events") > 0, F.col(f"{n}_tp") / F.col("events"))
        plo, phi = wilson(prec, F.col(f"{n}_alerts"))
        rlo, rhi = wilson(rec, F.col("events"))
        cols += [prec.alias(f"{n}_precision"), plo.alias(f"{n}_precision_lo"), phi.alias(f"{n}_precision_hi"),
                 rec.alias(f"{n}_recall"), rlo.alias(f"{n}_recall_lo"), rhi.alias(f"{n}_recall_hi")]
    return a.select(*keys, *cols)


def auc_ci(rank: DataFrame, keys: Sequence[str], z: float = Z95) -> DataFrame:
    """Normal-approximation AUC interval, var = AUC (1 - AUC) / min(P, N)."""
    m = F.least(F.col("n_pos"), F.col("n_neg")).cast("double")
    se = F.sqrt(F.col("auc") * (F.lit(1.0) - F.col("auc")) / m)
    ok = (F.col("n_pos") > 0) & (F.col("n_neg") > 0) & F.col("auc").isNotNull()
    return rank.select(*keys, "auc",
                       F.when(ok, F.greatest(F.lit(0.0), F.col("auc") - z * se)).otherwise(F.col("auc")).alias("auc_lo"),
                       F.when(ok, F.least(F.lit(1.0), F.col("auc") + z * se)).otherwise(F.col("auc")).alias("auc_hi"))


def pooled_calibration(calib_tab: DataFrame, flag_bp: float = 20.0) -> DataFrame:
    """Mean pd / odr / error and total count per decile over all months."""
    return calib_tab.groupBy("decile").agg(
        F.avg("pd_avg").alias("pd_avg"), F.avg("odr").alias("odr"),
        F.avg("abs_err_bp").alias("abs_err_bp"), F.sum("count").alias("count")).select(
        "*", (F.col("abs_err_bp") > flag_bp).alias("flag"))


def pooled_sweep(sweep: DataFrame) -> DataFrame:
    return sweep.groupBy("cut").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("alert_rate").alias("alert_rate"), F.avg("alerts").alias("alerts"))


def metric_bands(metrics: DataFrame, cols=("auc", "ks", "brier", "pr_auc")) -> DataFrame:
    """Per metric: mean, sample std, mean - std, mean + std over months."""
    packed = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("v")) for c in cols])
    long = metrics.select(F.inline(packed))
    return long.groupBy("metric").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")).select(
        "metric", "mean", "std", (F.col("mean") - F.col("std")).alias("lower"),
        (F.col("mean") + F.col("std")).alias("upper"))


def latest_month_slice(df: DataFrame, month_col: str = "as_of_month") -> DataFrame:
    """Rows of the most recent month (1-row max joined back)."""
    mx = df.agg(F.max(month_col).alias("_mx"))
    return df.join(F.broadcast(mx), F.col(month_col) == F.col("_mx"), "inner").drop("_mx")


def join_nearest_cut(sweep: DataFrame, target: float, keys: Sequence[str] = ("as_of_month",)) -> DataFrame:
    """Per group, the sweep row whose cut is closest to ``target`` (ties: lower cut)."""
    keys = list(keys)
    others = [c for c in sweep.columns if c not in keys]
    order = F.struct(F.abs(F.col("cut") - F.lit(float(target))).alias("d"), F.col("cut").alias("c"))
    return sweep.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*")


def best_worst_months(metrics: DataFrame, metric: str = "auc", k: int = 3,
                      month_col: str = "as_of_month") -> DataFrame:
    """Top-k and bottom-k months by a metric (small monthly table)."""
    wd = Window.orderBy(F.col(metric).desc(), F.col(month_col))
    wa = Window.orderBy(F.col(metric).asc(), F.col(month_col))
    r = metrics.select(month_col, metric, F.row_number().over(wd).alias("_d"), F.row_number().over(wa).alias("_a"))
    best = r.filter(F.col("_d") <= k).select(F.lit("best").alias("kind"), F.col("_d").alias("rank"), month_col, metric)
    worst = r.filter(F.col("_a") <= k).select(F.lit("worst").alias("kind"), F.col("_a").alias("rank"), month_col, metric)
    return best.unionByName(worst)


def kpi_triggers(metrics: DataFrame, psi: DataFrame | None = None, auc_floor: float = 0.75,
                 psi_limit: float = 0.25, alert_move: float = 0.5, month_col: str = "as_of_month") -> DataFrame:
    """Per month: AUC below the floor for 2+ months running, PSI above the limit,
    amber alert rate moved by more than 50 % against the first month."""
    w = Window.orderBy(month_col)
    m = metrics.select(month_col, "auc", "amber_alert_rate",
                       F.lag("auc").over(w).alias("_prev_auc"),
                       F.first("amber_alert_rate").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_base_rate"))
    if psi is not None:
        m = m.join(psi.select(F.col("as_of_date").alias(month_col), F.col("pd_score").alias("psi_pd")), month_col, "left")
    else:
        m = m.withColumn("psi_pd", F.lit(None).cast("double"))
    return m.select(
        month_col,
        ((F.col("auc") < auc_floor) & (F.col("_prev_auc") < auc_floor)).alias("auc_trigger"),
        F.coalesce(F.col("psi_pd") > psi_limit, F.lit(False)).alias("psi_trigger"),
        F.coalesce(F.abs(F.col("amber_alert_rate") - F.col("_base_rate")) / F.col("_base_rate") > alert_move,
                   F.lit(False)).alias("alert_rate_trigger"))


def workload_hours(metrics: DataFrame, amber_min: float = 30, red_min: float = 60,
                   fte_hours: float = 160, month_col: str = "as_of_month") -> DataFrame:
    """Review workload per month: amber alerts x 30 min + red alerts x 60 min."""
    a = F.col("amber_alerts") * (amber_min / 60.0)
    r = F.col("red_alerts") * (red_min / 60.0)
    return metrics.select(month_col, a.alias("amber_hours"), r.alias("red_hours"), (a + r).alias("total_hours"),
                          ((a + r) / fte_hours).alias("fte"))


def alert_overlap(prepared: DataFrame, keys: Sequence[str], score: str, label: str,
                  amber: float, red: float) -> DataFrame:
    """Red is a subset of Amber; Amber-only count, precision and share of recall."""
    keys = list(keys)
    y = F.col(label).cast("long")
    in_a = (F.col(score) >= amber) & (F.col(score) < red)
    a = prepared.groupBy(*keys).agg(
        F.count_if(F.col(score) >= red).alias("red_alerts"), F.count_if(in_a).alias("amber_only_alerts"),
        F.sum(F.when(in_a, y).otherwise(0)).alias("_tp"), F.sum(y).alias("_ev"),
        F.count_if((F.col(score) >= red) & (F.col(score) < amber)).alias("red_outside_amber"))
    return a.select(*keys, "red_alerts", "amber_only_alerts",
                    F.when(F.col("amber_only_alerts") > 0, F.col("_tp") / F.col("amber_only_alerts")).alias("amber_only_precision"),
                    F.when(F.col("_ev") > 0, F.col("_tp") / F.col("_ev")).alias("amber_only_recall"),
                    (F.col("red_outside_amber") == 0).alias("red_subset_of_amber"))


def stress_contribution(results: DataFrame, scenario: str) -> DataFrame:
    """For one scenario: % NPL increase vs Base and share of the total NPL increase,
    per sector and per grade."""
    r = results.filter((F.col("scenario") == scenario) & (F.col("level") != "overall"))
    base = results.filter(F.col("scenario") == "Base").select("level", "key", F.col("npl_proxy").alias("_b"))
    j = r.join(base, ["level", "key"], "left")
    w = Window.partitionBy("level")
    return j.select("scenario", "level", "key", "delta_npl_proxy",
                    (F.col("delta_npl_proxy") / F.col("_b") * 100).alias("pct_increase"),
                    (F.col("delta_npl_proxy") / F.sum("delta_npl_proxy").over(w)).alias("share_of_delta"))


def stress_traffic_light(results: DataFrame, cap=(3e6, 6e6, 10e6), prov=(10e6, 20e6, 30e6)) -> DataFrame:
    """RAF band of each scenario from overall delta capital and delta provision."""
    o = results.filter(F.col("level") == "overall")
    dc, dp = F.coalesce(F.col("delta_capital"), F.lit(0.0)), F.coalesce(F.col("delta_provision"), F.lit(0.0))
    band = (F.when((dc > cap[2]) | (dp > prov[2]), "Red")
            .when((dc > cap[1]) | (dp > prov[1]), "Orange")
            .when((dc >= cap[0]) | (dp >= prov[0]), "Amber").otherwise("Green"))
    return o.select("scenario", dc.alias("delta_capital"), dp.alias("delta_provision"), band.alias("band"))


def stress_sensitivity(portfolio: DataFrame, elasticity_mults=(0.8, 1.0, 1.2), lgd_shifts=(-0.10, 0.0, 0.10),
                       scenarios=ST.SCENARIOS) -> DataFrame:
    """Overall NPL / provision per scenario under elasticity x (0.8, 1, 1.2) and
    LGD +/- 10 pp (clipped to [0, 1]): a literal grid crossed with the portfolio."""
    spark = portfolio.sparkSession
    frames = []
    for em in elasticity_mults:
        el = {k: v * em for k, v in ST.ELASTICITIES.items()}
        frames.append(ST.scenarios_frame(spark, scenarios, el).withColumn("elasticity_mult", F.lit(float(em))))
    sc = frames[0]
    for f in frames[1:]:
        sc = sc.unionByName(f)
    shifts = spark.createDataFrame([(float(s),) for s in lgd_shifts], "lgd_shift double")
    grid = sc.crossJoin(shifts)
    p = ST.stress_pd(portfolio, grid)
    p = p.withColumn("lgd", F.least(F.greatest(F.col("lgd") + F.col("lgd_shift"), F.lit(0.0)), F.lit(1.0)))
    imp = ST.stress_impacts(p)
    return imp.groupBy("scenario", "elasticity_mult", "lgd_shift").agg(
        F.sum("npl_proxy").alias("npl_proxy"), F.sum("provision").alias("provision"),
        F.sum("capital").alias("capital"))


def extra_behavior(credit: DataFrame, cashflow: DataFrame, fin: DataFrame, asof: str, days: int,
                   util_hi: float = 0.80, dpd_hi: int = 30) -> DataFrame:
    """Documented extra features: util max, days > 80 % util, dpd mean, days with
    dpd > 30, longest dpd > 0 streak; cash-flow net mean, negative days, net
    volatility; latest quarter-on-quarter revenue growth."""
    from .features import filter_obs_window
    cr = filter_obs_window(credit, asof, days)
    util = F.try_divide(F.col("utilized"), F.col("credit_limit"))
    b = cr.groupBy("customer_id").agg(
        F.max(util).alias("util_max"), F.count_if(util > util_hi).alias("days_util_gt80"),
        F.avg("dpd_days").alias("dpd_mean"), F.count_if(F.col("dpd_days") > dpd_hi).alias("days_dpd_gt30"))
    st = max_streak(cr, "customer_id", "date", "dpd_days", 1, ["credit_limit", "utilized"], name="dpd_max_streak")
    cf = filter_obs_window(cashflow, asof, days).withColumn("_net", F.col("inflow") - F.col("outflow"))
    c = cf.groupBy("customer_id").agg(F.avg("_net").alias("cf_net_mean"), F.count_if(F.col("_net") < 0).alias("cf_negative_days"),
                                      F.stddev_samp("_net").alias("cf_volatility"))
    w = Window.partitionBy("customer_id").orderBy("fq_date")
    g = fin.select("customer_id", F.try_divide(F.col("revenue") - F.lag("revenue").over(w), F.abs(F.lag("revenue").over(w))).alias("revenue_qoq_growth"),
                   F.lead(F.lit(1)).over(w).isNull().alias("_last")).filter("_last").drop("_last")
    return b.join(st, "customer_id", "left").join(c, "customer_id", "full_outer").join(g, "customer_id", "left")


def exposure_bucket(col: str = "ead", small: float = 1e6, large: float = 1e7):
    """Small (< small), Medium (small..large), Large (> large)."""
    x = F.col(col)
    return F.when(x.isNull(), F.lit(None).cast("string")).when(x < small, "Small").when(x <= large, "Medium").otherwise("Large")
