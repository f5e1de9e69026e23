"""Registered feature-engineering queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import stable_double_sql
from ..session import materialize
from ..operators import features as FE
from ..sources import adapters as A
from . import params as P
from . import sql_adapters as S
from .registry import query


def fparams() -> FE.FeatureParams:
    return FE.FeatureParams(
        asof=P.PANEL_ASOF, obs_days=P.OBS_DAYS, recent_days=P.RECENT_DAYS,
        util_rows=P.UTIL_ROWS, breach_rows=P.BREACH_ROWS, cashflow_rows=P.CASHFLOW_ROWS,
        npe_dpd=P.NPE_DPD, covenant_asof=P.COVENANT_ASOF, covenant_days=P.COVENANT_DAYS,
        min_group=P.MIN_GROUP, winsor=P.WINSOR)


def labels_df(spark: SparkSession, sf: str) -> DataFrame:
    return FE.default_label(A.credit_daily(spark, sf), P.PANEL_ASOF, P.LABEL_HORIZON,
                            P.LABEL_DPD, P.LABEL_STREAK)


def covenant_df(spark: SparkSession, sf: str) -> DataFrame:
    return FE.covenant_test(A.fin_quarterly(spark, sf))


def sel(cols, doubles=()) -> str:
    """SELECT list with the doubles rounded like ``round_doubles``."""
    out = []
    for c in cols:
        out.append(f"{stable_double_sql(c)} AS {c}" if c in doubles else c)
    return "SELECT " + ", ".join(out)


def build_features(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship feature build. The daily panel feeds several builders (behaviour, labels,
    exclusion), so it is computed once and checkpointed. The quarterly panel is not: ratios and covenants
    are made in one pass over it, where the lines of a customer meet."""
    fin = A.fin_quarterly(spark, sf)
    credit = materialize(A.credit_daily(spark, sf))
    labels = FE.default_label(credit, P.PANEL_ASOF, P.LABEL_HORIZON, P.LABEL_DPD, P.LABEL_STREAK)
    return FE.features_build(fin, credit, A.cashflow_daily(spark, sf), None, labels, fparams())


# ---------------------------------------------------------------------------
# filters
# ---------------------------------------------------------------------------
_START = P.days_before(P.PANEL_ASOF, P.OBS_DAYS)
_RSTART = P.days_before(P.PANEL_ASOF, P.RECENT_DAYS)
CREDIT_COLS = ["customer_id", "date", "credit_limit", "utilized", "breach_flag", "dpd_days"]


@query("filter_obs_window", S.with_(S.CREDIT) + sel(CREDIT_COLS, {"credit_limit", "utilized"})
       + f" FROM credit WHERE date >= DATE '{_START}' AND date <= DATE '{P.PANEL_ASOF}'")
def q_filter_obs_window(spark, sf):
    """Credit rows inside the closed observation window."""
    return FE.filter_obs_window(A.credit_daily(spark, sf), P.PANEL_ASOF, P.OBS_DAYS)


@query("filter_recent_window", S.with_(S.CREDIT) + sel(CREDIT_COLS, {"credit_limit", "utilized"})
       + f" FROM credit WHERE date > DATE '{_RSTART}' AND date <= DATE '{P.PANEL_ASOF}'")
def q_filter_recent_window(spark, sf):
    return FE.filter_recent_window(A.credit_daily(spark, sf), P.PANEL_ASOF, P.RECENT_DAYS)


# ---------------------------------------------------------------------------
# financial ratios
# ---------------------------------------------------------------------------
_TTM = ["ebit_ttm", "ebitda_ttm", "interest_ttm", "revenue_ttm", "cogs_ttm"]


@query("ttm_rolling", S.with_(S.FIN, S.fin_ttm())
       + sel(["customer_id", "fq_date"] + _TTM, set(_TTM)) + " FROM fin_ttm")
def q_ttm_rolling(spark, sf):
    t = FE.ttm_rolling(A.fin_quarterly(spark, sf))
    return t.select("customer_id", "fq_date", *_TTM)


_LATEST = ["customer_id", "fq_date", "revenue", "total_debt", "ar"]


@query("latest_row", S.with_(S.FIN, S.fin_ttm())
       + sel(_LATEST, {"revenue", "total_debt", "ar"}) + " FROM fin_ttm WHERE rn_desc = 1")
def q_latest_row(spark, sf):
    fin = A.fin_quarterly(spark, sf).select(*_LATEST)
    return FE.latest_row(fin, "customer_id", "fq_date").select(*_LATEST)


_RATIOS = ["icr_ttm", "dscr_ttm_proxy", "debt_to_ebitda", "current_ratio", "dso", "dpo", "doh",
           "ccc", "delta_dso_qoq", "delta_ccc_qoq"]
_FIN_OUT = ["customer_id", "sector_code", "size_bucket"] + _RATIOS


@query("fin_ratios", S.with_(S.FIN, S.fin_ttm()) + sel(_FIN_OUT, set(_RATIOS)) + " FROM fin_last")
def q_fin_ratios(spark, sf):
    """Latest-quarter TTM ratios and QoQ deltas per customer (minimum slice)."""
    return FE.fin_ratios(A.fin_quarterly(spark, sf))


_QOQ = ["dso", "dso_prev", "delta_dso_qoq", "ccc", "ccc_prev", "delta_ccc_qoq"]


@query("qoq_delta", S.with_(S.FIN, S.fin_ttm()) + sel(["customer_id", "fq_date"] + _QOQ, set(_QOQ))
       + """ FROM (SELECT a.customer_id, a.fq_date, a.dso, b.dso AS dso_prev,
                a.dso - b.dso AS delta_dso_qoq, a.ccc, b.ccc AS ccc_prev, a.ccc - b.ccc AS delta_ccc_qoq
         FROM fin_c a LEFT JOIN fin_c b ON a.customer_id = b.customer_id AND b.rn_desc = 2
         WHERE a.rn_desc = 1)""")
def q_qoq_delta(spark, sf):
    return FE.qoq_delta(A.fin_quarterly(spark, sf))


@query("join_prev_quarter", S.with_(S.FIN, S.fin_ttm())
       + sel(["customer_id", "fq_date", "prev_fq_date", "revenue", "prev_revenue"],
             {"revenue", "prev_revenue"})
       + """ FROM (SELECT a.customer_id, a.fq_date, b.fq_date AS prev_fq_date, a.revenue,
                b.revenue AS prev_revenue
         FROM fin_ttm a LEFT JOIN fin_ttm b ON a.customer_id = b.customer_id AND b.rn_desc = 2
         WHERE a.rn_desc = 1)""")
def q_join_prev_quarter(spark, sf):
    """Latest quarter aligned with the previous one through ``lag`` (no self-join)."""
    from pyspark.sql import Window
    fin = A.fin_quarterly(spark, sf)
    w = Window.partitionBy("customer_id").orderBy("fq_date")
    t = fin.select("customer_id", "fq_date", "revenue",
                   F.lag("fq_date").over(w).alias("prev_fq_date"),
                   F.lag("revenue").over(w).alias("prev_revenue"),
                   F.lead(F.lit(1)).over(w).isNull().alias("_last"))
    return t.filter("_last").select("customer_id", "fq_date", "prev_fq_date", "revenue",
                                    "prev_revenue")


# ---------------------------------------------------------------------------
# behaviour / cash flow / covenants
# ---------------------------------------------------------------------------
_BEHAV = list(FE.BEHAVIOR_COLUMNS)
_BEHAV_D = {"util_mean_60d", "util_p95_60d", "dpd_trend_180d", "near_due_freq_7d"}


@query("behavior_features", S.with_(S.CREDIT, S.behav())
       + sel(["customer_id"] + _BEHAV, _BEHAV_D) + " FROM behav")
def q_behavior_features(spark, sf):
    return FE.behavior_features(A.credit_daily(spark, sf), fparams())


def _one_behavior(key: str, column: str):
    @query(key, S.with_(S.CREDIT, S.behav()) + sel(["customer_id", column], _BEHAV_D)
           + " FROM behav")
    def _q(spark, sf):
        return FE.behavior_features(A.credit_daily(spark, sf), fparams()).select(
            "customer_id", column)
    return _q


for _k, _c in (("util_mean_60d", "util_mean_60d"), ("util_p95_60d", "util_p95_60d"),
               ("breach_cnt_90d", "limit_breach_cnt_90d"), ("dpd_max_180d", "dpd_max_180d"),
               ("dpd_trend_180d", "dpd_trend_180d"), ("near_due_freq_7d", "near_due_freq_7d")):
    _one_behavior(_k, _c)

_CASH = list(FE.CASHFLOW_COLUMNS)


@query("cashflow_features", S.with_(S.CASH, S.cashf()) + sel(["customer_id"] + _CASH, set(_CASH))
       + " FROM cashf")
def q_cashflow_features(spark, sf):
    return FE.cashflow_features(A.cashflow_daily(spark, sf), fparams())


_COV = ["customer_id", "date", "covenant_name", "threshold", "actual", "breach_flag"]


@query("covenant_test", S.with_(S.FIN, S.covenant()) + sel(_COV, {"threshold", "actual"})
       + " FROM (SELECT * REPLACE (CAST(CAST(actual AS FLOAT) AS DOUBLE) AS actual) FROM cov)")
def q_covenant_test(spark, sf):
    """Every covenant test; ``actual`` in single precision, as ratios over the small constant reach 1e11."""
    return covenant_df(spark, sf).withColumn("actual", F.col("actual").cast("float").cast("double"))


@query("covenant_features", S.with_(S.FIN, S.covenant(), S.covf())
       + sel(["customer_id", "covenant_breach_any_180d", "covenant_breach_cnt_180d"],
             {"covenant_breach_any_180d"}) + " FROM covf")
def q_covenant_features(spark, sf):
    return FE.covenant_features(covenant_df(spark, sf), P.COVENANT_ASOF, P.COVENANT_DAYS)


_END = P.days_after(P.PANEL_ASOF, P.LABEL_HORIZON)


@query("max_streak", S.with_(S.CREDIT) + f"""SELECT customer_id, CAST(MAX(r) AS BIGINT) AS max_streak
FROM (SELECT customer_id, g, SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS r FROM (
  SELECT customer_id, ok, SUM(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY customer_id
     ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g
  FROM (SELECT customer_id, date, COALESCE(dpd_days >= {P.LABEL_DPD}, FALSE) AS ok FROM credit)) GROUP BY 1, 2)
GROUP BY customer_id""")
def q_max_streak(spark, sf):
    """Longest run of days with dpd >= threshold per customer over the whole panel."""
    from ..functions.windows import max_streak
    return max_streak(A.credit_daily(spark, sf), "customer_id", "date", "dpd_days", P.LABEL_DPD,
                      ["credit_limit", "utilized"])


@query("default_label", S.with_(S.CREDIT, S.labels())
       + "SELECT customer_id, asof_date, event_h12m FROM labels")
def q_default_label(spark, sf):
    return labels_df(spark, sf)


_PAST30_END = P.PANEL_ASOF


@query("label_risk_flags", S.with_(S.CREDIT, S.FIN, S.covenant(), S.labels()) + f"""
, past AS (SELECT customer_id, AVG(utilized) AS um, AVG(credit_limit) AS lm FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY date DESC) AS rn
    FROM credit WHERE date <= DATE '{P.PANEL_ASOF}') WHERE rn <= 30 GROUP BY 1),
fb AS (SELECT DISTINCT customer_id FROM cov WHERE date > DATE '{P.PANEL_ASOF}'
       AND date <= DATE '{_END}' AND breach_flag = 1),
x AS (SELECT l.customer_id, l.event_h12m,
        COALESCE(CASE WHEN p.lm > 0 THEN p.um / p.lm ELSE 0.0 END, 0.0) AS util_rate_30,
        fb.customer_id IS NOT NULL AS future_covenant_breach
      FROM labels l LEFT JOIN past p ON l.customer_id = p.customer_id
      LEFT JOIN fb ON l.customer_id = fb.customer_id)
SELECT customer_id, event_h12m, {stable_double_sql('util_rate_30')} AS util_rate_30, future_covenant_breach,
  ROUND(CAST(CASE WHEN event_h12m = 0 THEN (CASE WHEN util_rate_30 > 0.9 THEN 0.2 ELSE 0.0 END)
        + (CASE WHEN future_covenant_breach THEN 0.2 ELSE 0.0 END) END AS DOUBLE), 6) + 0.0 AS bump_prob
FROM x""")
def q_label_risk_flags(spark, sf):
    return FE.label_risk_flags(A.credit_daily(spark, sf), covenant_df(spark, sf),
                               labels_df(spark, sf), P.PANEL_ASOF, P.LABEL_HORIZON)


# ---------------------------------------------------------------------------
# joins / assembly
# ---------------------------------------------------------------------------
_ASM_COLS = (["customer_id", "sector_code", "size_bucket"] + _RATIOS + _BEHAV + _CASH
             + ["covenant_breach_any_180d", "covenant_breach_cnt_180d", "event_h12m"])
_ASM_D = set(_RATIOS) | _BEHAV_D | set(_CASH) | {"covenant_breach_any_180d"}
_ASM_SQL = """asm AS (
  SELECT f.*, b.util_mean_60d, b.util_p95_60d, b.limit_breach_cnt_90d, b.dpd_max_180d,
         b.dpd_trend_180d, b.near_due_freq_7d, c.inflow_mean_60d, c.outflow_mean_60d,
         c.inflow_drop_60d, v.covenant_breach_any_180d, v.covenant_breach_cnt_180d, l.event_h12m
  FROM fin_last f LEFT JOIN behav b ON f.customer_id = b.customer_id
  LEFT JOIN cashf c ON f.customer_id = c.customer_id
  LEFT JOIN covf v ON f.customer_id = v.customer_id
  LEFT JOIN labels l ON f.customer_id = l.customer_id)"""
_ALL_CTES = (S.FIN, S.CREDIT, S.CASH, S.fin_ttm(), S.behav(), S.cashf(), S.covenant(), S.covf(),
             S.labels(), S.npe(), _ASM_SQL)


def _assembled(spark, sf):
    p = fparams()
    ratios, covenants = FE.ratios_and_covenants(A.fin_quarterly(spark, sf), None, p)
    return FE.assemble_features(
        ratios,
        FE.behavior_features(A.credit_daily(spark, sf), p),
        FE.cashflow_features(A.cashflow_daily(spark, sf), p),
        covenants, labels_df(spark, sf))


@query("join_feature_assembly", S.with_(*_ALL_CTES) + sel(_ASM_COLS, _ASM_D) + " FROM asm")
def q_join_feature_assembly(spark, sf):
    return _assembled(spark, sf)


@query("join_exclude_npe", S.with_(*_ALL_CTES) + sel(_ASM_COLS, _ASM_D)
       + " FROM asm WHERE customer_id NOT IN (SELECT customer_id FROM npe)")
def q_join_exclude_npe(spark, sf):
    return FE.join_exclude_npe(_assembled(spark, sf), A.credit_daily(spark, sf), P.PANEL_ASOF,
                               P.RECENT_DAYS, P.NPE_DPD)


@query("join_metric_align", S.with_(S.CREDIT, S.CASH) + f"""
SELECT COALESCE(a.customer_id, b.customer_id) AS customer_id,
       {stable_double_sql('a.util_avg')} AS util_avg, a.dpd_max, {stable_double_sql('b.inflow_avg')} AS inflow_avg
FROM (SELECT customer_id, AVG(utilized) AS util_avg, CAST(MAX(dpd_days) AS BIGINT) AS dpd_max FROM credit
      WHERE date >= DATE '{_START}' AND date <= DATE '{P.PANEL_ASOF}' GROUP BY 1) a
FULL OUTER JOIN
     (SELECT customer_id, AVG(inflow) AS inflow_avg FROM cash
      WHERE date >= DATE '{_START}' AND date <= DATE '{P.PANEL_ASOF}' GROUP BY 1) b
ON a.customer_id = b.customer_id""")
def q_join_metric_align(spark, sf):
    """Outer alignment of per-customer metrics from two panels as ONE union + groupBy
    (conditional aggregates), not a full outer join."""
    cr = FE.filter_obs_window(A.credit_daily(spark, sf), P.PANEL_ASOF, P.OBS_DAYS)
    cf = FE.filter_obs_window(A.cashflow_daily(spark, sf), P.PANEL_ASOF, P.OBS_DAYS)
    u = (cr.select("customer_id", F.lit(1).alias("_src"), "utilized", "dpd_days",
                   F.lit(None).cast("double").alias("inflow"))
         .unionByName(cf.select("customer_id", F.lit(2).alias("_src"),
                                F.lit(None).cast("double").alias("utilized"),
                                F.lit(None).cast("long").alias("dpd_days"), "inflow")))
    return u.groupBy("customer_id").agg(
        F.avg("utilized").alias("util_avg"), F.max("dpd_days").cast("long").alias("dpd_max"),
        F.avg("inflow").alias("inflow_avg"))


# ---------------------------------------------------------------------------
# robust scaling and the flagship
# ---------------------------------------------------------------------------
_MODEL = list(FE.MODEL_COLUMNS)


def _winsor_sql() -> str:
    q = ", ".join(f"QUANTILE_CONT(CAST({c} AS DOUBLE), [{P.WINSOR[0]}, {P.WINSOR[1]}]) AS q_{c}"
                  for c in _MODEL)
    cols = []
    for c in ["customer_id", "sector_code", "size_bucket"] + _RATIOS + _BEHAV + _CASH + [
            "covenant_breach_any_180d", "covenant_breach_cnt_180d", "event_h12m"]:
        if c in _MODEL:
            cols.append(f"CASE WHEN {c} IS NULL THEN NULL ELSE LEAST(GREATEST(CAST({c} AS DOUBLE), "
                        f"q_{c}[1]), q_{c}[2]) END AS {c}")
        else:
            cols.append(c)
    return (f"wq AS (SELECT {q} FROM base),\n"
            f"wz AS (SELECT {', '.join(cols)} FROM base CROSS JOIN wq)")


def _zscore_sql() -> str:
    g = ", ".join(f"QUANTILE_CONT({c}, [0.25, 0.5, 0.75]) AS g_{c}" for c in _MODEL)
    s = ", ".join(f"QUANTILE_CONT({c}, [0.25, 0.5, 0.75]) AS s_{c}" for c in _MODEL)
    zs = []
    for c in _MODEL:
        st = f"(CASE WHEN sq.n < {P.MIN_GROUP} THEN g_{c} ELSE s_{c} END)"
        med = f"{st}[2]"
        iqr = f"({st}[3] - {st}[1])"
        scale = f"(CASE WHEN {iqr} > 0 THEN {iqr} WHEN {med} <> 0 THEN ABS({med}) ELSE 1.0 END)"
        zs.append(f"({c} - {med}) / {scale} AS {c}__zs_sector_size")
    return (f"gq AS (SELECT {g} FROM wz),\n"
            f"sq AS (SELECT sector_code AS k1, size_bucket AS k2, COUNT(*) AS n, {s} FROM wz GROUP BY 1, 2),\n"
            f"zz AS (SELECT wz.*, {', '.join(zs)} FROM wz LEFT JOIN sq ON wz.sector_code IS NOT DISTINCT FROM sq.k1 "
            f"AND wz.size_bucket IS NOT DISTINCT FROM sq.k2 CROSS JOIN gq)")


_BASE_SQL = "base AS (SELECT * FROM asm WHERE customer_id NOT IN (SELECT customer_id FROM npe))"
_WZ_COLS = _ASM_COLS
_WZ_D = set(_MODEL) | _ASM_D
_ZS = [c + "__zs_sector_size" for c in _MODEL]


@query("winsorize", S.with_(*_ALL_CTES, _BASE_SQL, _winsor_sql()) + sel(_WZ_COLS, _WZ_D)
       + " FROM wz")
def q_winsorize(spark, sf):
    from ..operators.robust import winsorize
    base = materialize(FE.join_exclude_npe(_assembled(spark, sf), A.credit_daily(spark, sf), P.PANEL_ASOF,
                                           P.RECENT_DAYS, P.NPE_DPD))
    return winsorize(base, _MODEL, *P.WINSOR)


FEATURES_SQL = (S.with_(*_ALL_CTES, _BASE_SQL, _winsor_sql(), _zscore_sql())
                + sel(_WZ_COLS + _ZS, _WZ_D | set(_ZS)) + " FROM zz")


@query("robust_zscore", FEATURES_SQL)
def q_robust_zscore(spark, sf):
    from ..operators.robust import robust_zscore, winsorize
    base = materialize(FE.join_exclude_npe(_assembled(spark, sf), A.credit_daily(spark, sf), P.PANEL_ASOF,
                                           P.RECENT_DAYS, P.NPE_DPD))
    return robust_zscore(materialize(winsorize(base, _MODEL, *P.WINSOR)), _MODEL,
                         ("sector_code", "size_bucket"), P.MIN_GROUP)


@query("features_build", FEATURES_SQL)
def q_features_build(spark, sf):
    """Flagship: the full as-of feature table."""
    return build_features(spark, sf)

# CTE list ending in ``zz`` (the unrounded feature table) for other oracles
FEATURE_CTES = (*_ALL_CTES, _BASE_SQL, _winsor_sql(), _zscore_sql())
FEATURE_COLUMNS = _WZ_COLS + _ZS


@query("safe_ratio", S.with_(S.FIN) + f"""SELECT customer_id, fq_date,
  {stable_double_sql('current_assets / NULLIF(current_liab, 0)')} AS current_ratio,
  {stable_double_sql('total_debt / NULLIF(ebitda, 0)')} AS debt_to_ebitda FROM fin""")
def q_safe_ratio(spark, sf):
    """Zero denominators give NULL instead of an error (ANSI mode) or infinity."""
    from ..functions.expr import safe_ratio
    fin = A.fin_quarterly(spark, sf)
    return fin.select("customer_id", "fq_date", safe_ratio("current_assets", "current_liab").alias("current_ratio"),
                      safe_ratio("total_debt", "ebitda").alias("debt_to_ebitda"))
