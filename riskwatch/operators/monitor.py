"""Model monitoring: metrics vs baseline, degradation flags, calibration fit,
grade mix / approval rate, data window, issues, long-form tables, full run.

Every piece is a small aggregate over the scored population; the run joins
one-row results (bounded) and never collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import GRADE_LABELS, MONITOR_GRADE_BOUNDS, grade_band
from ..session import materialize
from . import calib, drift, ranking

ALERT_THRESHOLDS = {"auc_min": 0.70, "auc_drop": 0.05, "brier_increase_abs": 0.01,
                    "brier_increase_rel": 0.20, "ks_drop_rel": 0.20, "pr_auc_drop": 0.05,
                    "psi_warn": 0.10, "psi_severe": 0.25}
EPS = 1e-12


def calc_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: auc, pr_auc, ks (signed, curve-based), brier."""
    d = df.select(F.col(score).alias("_p"), F.col(label).cast("int").alias("_y"))
    rm = ranking.rank_metrics(d, [], "_p", "_y", signed_ks=True)
    return rm.crossJoin(F.broadcast(ranking.brier(d, [], "_p", "_y"))).select("auc", "pr_auc", "ks", "brier")


def baseline_frame(spark, baseline: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([tuple(float(baseline.get(k, 0.0)) for k in ("auc", "pr_auc", "ks", "brier"))],
                                 "auc_base double, pr_auc_base double, ks_base double, brier_base double")


def join_baseline_metrics(cur: DataFrame, base: DataFrame) -> DataFrame:
    """Current metrics (1 row) beside the baseline metrics (1 row)."""
    return cur.crossJoin(F.broadcast(base))


def degrade_flags(joined: DataFrame, t: Mapping[str, float] = ALERT_THRESHOLDS) -> DataFrame:
    """auc < .70 or drop > .05; brier +.01 abs or +20 % rel; ks -20 % rel; pr_auc -.05."""
    auc, ab = F.col("auc"), F.col("auc_base")
    br, bb = F.col("brier"), F.col("brier_base")
    ks, kb = F.col("ks"), F.col("ks_base")
    pr, pb = F.col("pr_auc"), F.col("pr_auc_base")
    return joined.select(
        "*",
        ((auc < t["auc_min"]) | ((ab - auc) > t["auc_drop"])).alias("auc_alert"),
        (((br - bb) > t["brier_increase_abs"])
         | ((bb > 0) & (((br - bb) / bb) > t["brier_increase_rel"]))).alias("brier_alert"),
        ((kb > 0) & (((kb - ks) / F.greatest(kb, F.lit(EPS))) > t["ks_drop_rel"])).alias("ks_alert"),
        ((pb > 0) & ((pb - F.coalesce(pr, F.lit(0.0))) > t["pr_auc_drop"])).alias("pr_auc_alert"))


def grade_mix(df: DataFrame, score: str, approval_cut: float = 0.05,
              bounds=MONITOR_GRADE_BOUNDS) -> DataFrame:
    """Share of each grade A-G (zero-filled; p >= 1 or < 0 has no grade) and the
    approval rate ``mean(p < approval_cut)``; one row per grade."""
    spark = df.sparkSession
    g = df.select(grade_band(score, bounds, open_top=False).alias("grade"),
                  (F.col(score) < F.lit(approval_cut)).cast("double").alias("_ok"))
    tot = g.agg(F.count(F.lit(1)).alias("_n"), F.avg("_ok").alias("approval_rate"))
    cnt = g.filter(F.col("grade").isNotNull()).groupBy("grade").agg(F.count(F.lit(1)).alias("_c"))
    labels = spark.createDataFrame([(x,) for x in GRADE_LABELS[:len(bounds)]], "grade string")
    j = labels.join(F.broadcast(cnt), "grade", "left").crossJoin(F.broadcast(tot))
    return j.select("grade", (F.coalesce(F.col("_c"), F.lit(0)) / F.col("_n")).alias("share"),
                    "approval_rate")


def data_window(df: DataFrame, label: str | None, date_col: str | None) -> DataFrame:
    """Population size, event rate (5 places), first / last as-of date."""
    aggs = [F.count(F.lit(1)).alias("population_size")]
    aggs.append(F.bround(F.avg(F.col(label).cast("double")), 5).alias("event_rate") if label
                else F.lit(None).cast("double").alias("event_rate"))
    if date_col:
        aggs += [F.min(date_col).alias("data_window_start"), F.max(date_col).alias("data_window_end")]
    return df.agg(*aggs)


def issue_list(flags: DataFrame, psi_over: DataFrame, severe_names: DataFrame) -> DataFrame:
    """Ordered human-readable issues as ``array<string>`` (empty entries dropped)."""
    j = flags.crossJoin(F.broadcast(psi_over)).crossJoin(F.broadcast(severe_names))

    def msg(flag, text, cur, base):
        return F.when(F.col(flag), F.format_string(f"{text} is worse than its baseline: %s against %s",
                                                   F.bround(F.col(cur), 4).cast("string"),
                                                   F.bround(F.col(base), 4).cast("string")))
    items = F.array(
        msg("auc_alert", "AUC", "auc", "auc_base"),
        msg("ks_alert", "KS", "ks", "ks_base"),
        msg("brier_alert", "Brier score", "brier", "brier_base"),
        msg("pr_auc_alert", "PR-AUC", "pr_auc", "pr_auc_base"),
        F.when(F.col("psi_severe_count") > 0, F.format_string(
            "severe PSI in %d features, first %s", F.col("psi_severe_count"), F.col("severe_top5"))),
        F.when(F.col("psi_warn_count") > 0, F.format_string(
            "moderate PSI in %d features", F.col("psi_warn_count"))))
    return j.select(F.array_compact(items).alias("issues"))


def severe_top5(psi_tab: DataFrame) -> DataFrame:
    """Comma-joined names of the first five severe features (sorted PSI order)."""
    s = psi_tab.filter(F.col("severity") == "severe").select(
        F.struct((-F.col("psi")).alias("_o"), F.col("feature")).alias("_s"))
    return s.agg(F.array_join(F.slice(F.transform(F.array_sort(F.collect_list("_s")),
                                                  lambda x: x["feature"]), 1, 5), ", ").alias("severe_top5"))


def metrics_long(metrics: DataFrame, psi_over: DataFrame, gm: DataFrame, run: Mapping[str, str]) -> DataFrame:
    """(run_id, date_run, env, model_version, metric, value) rows: metrics in upper
    case, PSI_OVERALL, ApprovalRate, Grade_A..G; values rounded to 6 places."""
    ids = [F.lit(run.get(k, "")).alias(k) for k in ("run_id", "date_run", "env", "model_version")]
    m = metrics.select(F.inline(F.array(*[F.struct(F.lit(c.upper()).alias("metric"), F.col(c).alias("value"))
                                          for c in ("auc", "pr_auc", "ks", "brier")])))
    p = psi_over.select(F.lit("PSI_OVERALL").alias("metric"), F.col("psi_overall").alias("value"))
    a = gm.limit(1).select(F.lit("ApprovalRate").alias("metric"), F.col("approval_rate").alias("value"))
    g = gm.select(F.concat(F.lit("Grade_"), F.col("grade")).alias("metric"), F.col("share").alias("value"))
    return m.unionByName(p).unionByName(a).unionByName(g).select(
        *ids, "metric", F.bround("value", 6).alias("value"))


def monitor_run(base: DataFrame, cur: DataFrame, score: str, label: str, features: Sequence[str],
                baseline: Mapping[str, float], approval_cut: float = 0.05, psi_bins: int = 10,
                date_col: str | None = None, run: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The whole monitoring run: a one-row report plus the three long tables."""
    spark = cur.sparkSession
    run = run or {}
    cm = calc_metrics(cur, score, label)
    flags = degrade_flags(join_baseline_metrics(cm, baseline_frame(spark, baseline)))
    d = cur.select(F.col(score).alias("_p"), F.col(label).cast("int").alias("_y"))
    deciles, fit = calib.decile_linear_fit(d, [], "_p", "_y", 10)
    gm = grade_mix(cur, score, approval_cut)
    psi_tab = materialize(drift.psi_feature_table(base, cur, features, psi_bins))  # one row a feature, used four times
    po = drift.psi_overall(psi_tab, ALERT_THRESHOLDS["psi_warn"])
    issues = issue_list(flags, po, severe_top5(psi_tab))
    win = data_window(cur, label, date_col)
    dq = drift.data_quality(base, cur, features)
    one_rows = (flags, fit, po, dq, gm.limit(1).select("approval_rate"), issues)
    report = reduce(lambda x, y: x.crossJoin(F.broadcast(y)), one_rows, win)
    report = report.select("*", F.size("issues").alias("n_issues"))
    return {"report": report, "psi": drift.sort_psi(psi_tab), "deciles": deciles,
            "grade_mix": gm, "metrics_long": metrics_long(cm, po, gm, run)}


METRICS = ("auc", "pr_auc", "ks", "brier")
PSI_ROWS = 20


def nested_report(out: Mapping[str, DataFrame], run: Mapping[str, str], cutoffs: Mapping[str, float],
                  thresholds: Mapping[str, float] = ALERT_THRESHOLDS) -> DataFrame:
    """The run as one nested row: run and window, baseline and current metrics, cutoffs, approval rate, grade mix,
    calibration with its deciles, PSI with the first ``PSI_ROWS`` features of the sorted table, data quality, alert
    thresholds, alerts and issues. ``out`` is what ``monitor_run`` returned."""
    def rows(key: str, name: str, order: list, columns: Sequence[str], k: int | None = None) -> DataFrame:
        """One row: an ordered array of structs, of a table with a row a grade, decile or feature."""
        numbered = out[key].select(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *columns)
        items = F.array_sort(F.collect_list(F.struct(*numbered.columns)))
        return numbered.agg((F.slice(items, 1, k) if k else items).alias("_a")).select(
            F.transform("_a", lambda r: F.struct(*[r[c].alias(c) for c in columns])).alias(name))

    place = F.when(F.col("severity") == "warn", 0).when(F.col("severity") == "unknown", 1).when(F.col("severity") == "severe", 2).otherwise(3)
    by_psi = [place, F.coalesce(-F.col("psi"), F.lit(float("inf"))), F.col("feature")]  # as ``drift.sort_psi``
    parts = [rows("grade_mix", "grade_mix", [F.col("grade")], ("grade", "share")),
             rows("deciles", "deciles", [F.col("decile")], ("decile", "pd_avg", "odr", "count")),
             rows("psi", "psi_by_feature", by_psi, ("feature", "psi", "missing_rate", "severity"), PSI_ROWS)]
    j = reduce(lambda x, y: x.crossJoin(F.broadcast(y)), parts, out["report"])  # rows of one
    alerts = [*(F.col(f"{m}_alert") for m in METRICS), F.col("psi_alert")]
    literal = lambda d: F.struct(*[F.lit(v).alias(k) for k, v in d.items()])
    window = [c for c in ("data_window_start", "data_window_end") if c in out["report"].columns]
    return j.select(
        literal(run).alias("run"), F.struct("population_size", "event_rate", *window).alias("data_window"),
        F.struct(*[F.col(f"{m}_base").alias(m) for m in METRICS]).alias("baseline_metrics"),
        F.struct(*METRICS).alias("current_metrics"), literal(cutoffs).alias("cutoffs"), "approval_rate", "grade_mix",
        F.struct("slope", "intercept", "deciles").alias("calibration"),
        F.struct("psi_overall", "psi_severe_count", "psi_warn_count", "psi_by_feature").alias("psi"),
        F.struct("missing_rate_overall", "n_missing_increases").alias("data_quality"),
        literal(thresholds).alias("alert_thresholds"), F.struct(*alerts).alias("alerts"), "issues")


def report_json(report: DataFrame) -> DataFrame:
    """The report row as one JSON string (NaN-free: NULL stays null)."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("report_json"))
