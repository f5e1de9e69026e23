"""As-of customer features: TTM ratios, credit behaviour, cash flow, covenants, labels.

Every builder returns one row per customer, keyed by ``customer_id``; all of them
are hash-partitioned by that key, so the assembly joins reuse one partitioning.
Windows run on grains the data bounds (quarters per customer, days inside the
observation window); aggregates use partial (map-side) aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_ratio
from ..session import materialize
from ..functions.windows import max_streak, tail_flags
from .robust import robust_zscore, winsorize

KEY = "customer_id"

FIN_MEASURES = ("revenue", "cogs", "ebitda", "ebit", "interest_expense", "total_debt",
                "current_assets", "current_liab", "inventory", "ar", "ap")
TTM_COLUMNS = ("ebit", "ebitda", "interest_expense", "revenue", "cogs")
RATIO_COLUMNS = ("icr_ttm", "dscr_ttm_proxy", "debt_to_ebitda", "current_ratio",
                 "dso", "dpo", "doh", "ccc", "delta_dso_qoq", "delta_ccc_qoq")
BEHAVIOR_COLUMNS = ("util_mean_60d", "util_p95_60d", "limit_breach_cnt_90d", "dpd_max_180d",
                    "dpd_trend_180d", "near_due_freq_7d")
CASHFLOW_COLUMNS = ("inflow_mean_60d", "outflow_mean_60d", "inflow_drop_60d")
COVENANT_COLUMNS = ("covenant_breach_any_180d", "covenant_breach_cnt_180d")
# The 20 columns that are winsorized and sector/size normalised (fixed list).
MODEL_COLUMNS = RATIO_COLUMNS + BEHAVIOR_COLUMNS + CASHFLOW_COLUMNS + ("covenant_breach_cnt_180d",)


@dataclass
class FeatureParams:
    """Feature-build parameters; defaults are the reference's (180-day window etc.)."""
    asof: str
    obs_days: int = 180
    recent_days: int = 7
    util_rows: int = 60
    breach_rows: int = 90
    cashflow_rows: int = 60
    npe_dpd: int = 90
    near_due: tuple = (0, 30)
    covenant_asof: str | None = None
    covenant_days: int | None = None
    fin_asof: str | None = None          # None reproduces the reference (no as-of filter)
    granularity: str = "timestamp"       # "timestamp" (reference) or "day"
    winsor: tuple | None = (0.01, 0.99)
    normalize: bool = True
    min_group: int = 10
    materialize: bool = True
    extra: dict = field(default_factory=dict)


# ---------------------------------------------------------------------------
# date windows
# ---------------------------------------------------------------------------
def _day_col(df: DataFrame, c: str, granularity: str) -> Column:
    if granularity == "day" or dict(df.dtypes)[c] == "date":
        return F.to_date(F.col(c))
    return F.col(c)


def _asof_lit(df: DataFrame, c: str, asof: str, granularity: str) -> Column:
    if granularity == "day" or dict(df.dtypes)[c] == "date":
        return F.to_date(F.lit(asof))
    return F.to_timestamp(F.lit(asof))


def _minus_days(x: Column, days: int) -> Column:
    return x - F.expr(f"INTERVAL {int(days)} DAYS")


def _plus_days(x: Column, days: int) -> Column:
    return x + F.expr(f"INTERVAL {int(days)} DAYS")


def filter_obs_window(df: DataFrame, asof: str, days: int, date_col: str = "date",
                      granularity: str = "timestamp") -> DataFrame:
    """Closed window ``asof - days <= date <= asof``."""
    d = _day_col(df, date_col, granularity)
    a = _asof_lit(df, date_col, asof, granularity)
    return df.filter((d >= _window_start(df, asof, days, date_col, granularity)) & (d <= a))


def filter_recent_window(df: DataFrame, asof: str, days: int, date_col: str = "date",
                         granularity: str = "timestamp") -> DataFrame:
    """Half-open window ``asof - days < date <= asof``."""
    return df.filter(_recent_flag(df, asof, days, date_col, granularity))


def _is_day(df: DataFrame, c: str, granularity: str) -> bool:
    return granularity == "day" or dict(df.dtypes)[c] == "date"


def _recent_flag(df: DataFrame, asof: str, days: int, date_col: str, granularity: str) -> Column:
    d = _day_col(df, date_col, granularity)
    a = _asof_lit(df, date_col, asof, granularity)
    start = F.date_sub(a, days) if _is_day(df, date_col, granularity) else _minus_days(a, days)
    return (d > start) & (d <= a)


def _window_start(df: DataFrame, asof: str, days: int, date_col: str, granularity: str) -> Column:
    a = _asof_lit(df, date_col, asof, granularity)
    return F.date_sub(a, days) if _is_day(df, date_col, granularity) else _minus_days(a, days)


# ---------------------------------------------------------------------------
# financial ratios
# ---------------------------------------------------------------------------
def ttm_rolling(fin: DataFrame, cols=TTM_COLUMNS, rows: int = 4) -> DataFrame:
    """Trailing ``rows``-quarter sums per customer (partial windows allowed)."""
    w = Window.partitionBy(KEY).orderBy("fq_date").rowsBetween(-(rows - 1), 0)
    return fin.select("*", *[F.sum(c).over(w).alias(f"{_ttm_name(c)}") for c in cols])


def _ttm_name(c: str) -> str:
    return "interest_ttm" if c == "interest_expense" else f"{c}_ttm"


def latest_row(df: DataFrame, key: str = KEY, order_col: str = "fq_date") -> DataFrame:
    """Last row per key in ``order_col`` order, as an aggregate (no window sort)."""
    others = [c for c in df.columns if c != key]
    packed = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_r"))
    return packed.select(key, "_r.*")


def _ratio_exprs() -> dict[str, Column]:
    ebitda, interest = F.col("ebitda_ttm"), F.col("interest_ttm")
    dso = safe_ratio(365 * F.col("ar"), F.col("revenue_ttm"))
    dpo = safe_ratio(365 * F.col("ap"), F.col("cogs_ttm"))
    doh = safe_ratio(365 * F.col("inventory"), F.col("cogs_ttm"))
    return {
        "icr_ttm": safe_ratio(F.col("ebit_ttm"), interest),
        "dscr_ttm_proxy": safe_ratio(ebitda - 0.3 * ebitda, interest),
        "debt_to_ebitda": safe_ratio(F.col("total_debt"), ebitda),
        "current_ratio": safe_ratio(F.col("current_assets"), F.col("current_liab")),
        "dso": dso, "dpo": dpo, "doh": doh,
        "ccc": dso + doh - dpo,
    }


def fin_ratios(fin: DataFrame, asof: str | None = None, with_deltas: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Latest-quarter ratios on TTM flows plus QoQ deltas of dso and ccc, and that quarter's ``keep`` columns.

    One sorted pass per customer computes the TTM sums, the ratios of every
    quarter, their lag and a last-row marker (the same window spec, so a
    single sort); no self-join.
    """
    if asof is not None:
        fin = fin.filter(F.to_date("fq_date") <= F.to_date(F.lit(asof)))
    w = Window.partitionBy(KEY).orderBy("fq_date")
    wttm = w.rowsBetween(-3, 0)
    base = fin.select(
        KEY, "fq_date", "sector_code", "size_bucket", "total_debt", "current_assets",
        "current_liab", "inventory", "ar", "ap", *keep,
        *[F.sum(c).over(wttm).alias(_ttm_name(c)) for c in TTM_COLUMNS],
        F.lead(F.lit(1)).over(w).isNull().alias("_is_last"))
    ratios = _ratio_exprs()
    with_ratios = base.select(KEY, "fq_date", "sector_code", "size_bucket", "_is_last", *keep,
                              *[e.alias(n) for n, e in ratios.items()])
    if with_deltas:
        with_ratios = with_ratios.select(
            "*", *[(F.col(c) - F.lag(c).over(w)).alias(f"delta_{c}_qoq") for c in ("dso", "ccc")])
    out_cols = [KEY, "sector_code", "size_bucket", *ratios.keys()]
    if with_deltas:
        out_cols += ["delta_dso_qoq", "delta_ccc_qoq"]
    return with_ratios.filter("_is_last").select(*out_cols, *keep)


def qoq_delta(fin: DataFrame, cols=("dso", "ccc")) -> DataFrame:
    """Per customer: latest value, previous-quarter value and delta of each ratio."""
    w = Window.partitionBy(KEY).orderBy("fq_date")
    t = ttm_rolling(fin)
    r = _ratio_exprs()
    t = t.select(KEY, "fq_date", *[r[c].alias(c) for c in cols],
                 F.lead(F.lit(1)).over(w).isNull().alias("_is_last"))
    t = t.select("*", *[F.lag(c).over(w).alias(f"{c}_prev") for c in cols])
    return t.filter("_is_last").select(
        KEY, "fq_date", *[x for c in cols for x in (
            F.col(c), F.col(f"{c}_prev"), (F.col(c) - F.col(f"{c}_prev")).alias(f"delta_{c}_qoq"))])


# ---------------------------------------------------------------------------
# credit behaviour / cash flow / covenants
# ---------------------------------------------------------------------------
def _others(df: DataFrame) -> list[str]:
    """Columns that tell rows of one customer and date apart (several products a day are legal)."""
    return [c for c in sorted(df.columns) if c not in (KEY, "date")]


def behavior_features(credit: DataFrame, p: FeatureParams) -> DataFrame:
    win = filter_obs_window(credit, p.asof, p.obs_days, "date", p.granularity)
    start = _window_start(credit, p.asof, p.obs_days, "date", p.granularity)
    flagged = tail_flags(win, KEY, "date", {"_u": p.util_rows, "_b": p.breach_rows}, _others(win))
    recent = _recent_flag(flagged, p.asof, p.recent_days, "date", p.granularity)
    t = F.datediff(F.to_date("date"), F.to_date(start)).cast("double")
    lo, hi = p.near_due
    dpd = F.col("dpd_days")
    in_u = F.col("_u")
    limit_mean = F.avg(F.when(in_u, F.col("credit_limit")))
    return flagged.groupBy(KEY).agg(
        safe_ratio(F.avg(F.when(in_u, F.col("utilized"))), limit_mean).alias("util_mean_60d"),
        safe_ratio(F.percentile(F.when(in_u, F.col("utilized")), 0.95), limit_mean)
        .alias("util_p95_60d"),
        F.coalesce(F.sum(F.when(F.col("_b"), F.col("breach_flag"))), F.lit(0)).cast("long")
        .alias("limit_breach_cnt_90d"),
        F.max(dpd).cast("long").alias("dpd_max_180d"),
        F.when(F.count(F.lit(1)) >= 2, F.regr_slope(dpd.cast("double"), t))
        .otherwise(F.lit(0.0)).alias("dpd_trend_180d"),
        F.avg(F.when(recent, ((dpd > lo) & (dpd < hi)).cast("double"))).alias("near_due_freq_7d"),
    )


def cashflow_features(cashflow: DataFrame, p: FeatureParams) -> DataFrame:
    win = filter_obs_window(cashflow, p.asof, p.obs_days, "date", p.granularity)
    flagged = tail_flags(win, KEY, "date", {"_t": p.cashflow_rows}, _others(win))
    inflow_mean = F.avg(F.when(F.col("_t"), F.col("inflow")))
    median = F.percentile(F.col("inflow"), 0.5)
    return flagged.groupBy(KEY).agg(
        inflow_mean.alias("inflow_mean_60d"),
        F.avg(F.when(F.col("_t"), F.col("outflow"))).alias("outflow_mean_60d"),
        safe_ratio(median - inflow_mean, median).alias("inflow_drop_60d"),
    )


def covenant_features(covenant: DataFrame, asof: str, obs_days: int = 180,
                      granularity: str = "timestamp", beside: bool = False) -> DataFrame:
    """Whether and how often a customer's tests of the window failed, a row a customer.

    ``beside`` takes the wide rows of ``covenant_test`` and puts the same two numbers beside every quarter of the
    customer, so that the panel is not read again to be joined with itself.
    """
    if beside:
        d = _day_col(covenant, "fq_date", granularity)
        a = _asof_lit(covenant, "fq_date", asof, granularity)
        inside = (d >= _window_start(covenant, asof, obs_days, "fq_date", granularity)) & (d <= a) & F.col(KEY).isNotNull()
        whole = Window.partitionBy(KEY).orderBy("fq_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        flags = [F.col(c) for c in BREACH_COLUMNS]
        found = F.when(F.coalesce(*flags).isNotNull(), sum((F.coalesce(c, F.lit(0)) for c in flags), F.lit(0)))
        return covenant.select(
            *[c for c in covenant.columns if c not in BREACH_COLUMNS],
            F.max(F.when(inside, F.greatest(*flags))).over(whole).cast("double").alias("covenant_breach_any_180d"),
            F.sum(F.when(inside, found)).over(whole).cast("long").alias("covenant_breach_cnt_180d"))
    win = filter_obs_window(covenant, asof, obs_days, "date", granularity)
    return win.groupBy(KEY).agg(
        F.max("breach_flag").cast("double").alias("covenant_breach_any_180d"),
        F.sum("breach_flag").cast("long").alias("covenant_breach_cnt_180d"))


# Covenant definitions (fixed values): name, threshold, breach direction.
COVENANTS = (
    ("ICR_min", 2.0, "<"),
    ("Debt_to_EBITDA_max", 4.0, ">"),
    ("Current_Ratio_min", 1.0, "<"),
    ("DSCR_min_proxy", 1.1, "<"),
)
BREACH_COLUMNS = tuple(f"breach__{name}" for name, _, _ in COVENANTS)


def covenant_test(fin: DataFrame, latest_only: bool = False, wide: bool = False) -> DataFrame:
    """Evaluate the four covenants on trailing-4-quarter ratios -> long rows.

    One evaluation per (customer, quarter) dated ``fq_date`` (``latest_only``
    keeps the newest quarter). ``wide`` gives the rows of ``fin``, each with a flag a covenant (``BREACH_COLUMNS``). Fallbacks when a TTM denominator is not
    positive: ICR and DSCR 5.0, Debt/EBITDA 10.0. The reference's random
    threshold noise is not reproduced.
    """
    w = Window.partitionBy(KEY).orderBy("fq_date")
    w4 = w.rowsBetween(-3, 0)
    t = fin.select(
        *(fin.columns if wide else (KEY, "fq_date", "total_debt", "current_assets", "current_liab")),
        F.coalesce(F.sum("ebit").over(w4), F.lit(0.0)).alias("_ebit"),
        F.coalesce(F.sum("interest_expense").over(w4), F.lit(0.0)).alias("_int"),
        F.coalesce(F.sum("ebitda").over(w4), F.lit(0.0)).alias("_ebitda"),
        F.lead(F.lit(1)).over(w).isNull().alias("_is_last"))
    if latest_only:
        t = t.filter("_is_last")
    eps = F.lit(1e-6)
    icr = F.when(F.col("_int") > 0, F.col("_ebit") / (F.col("_int") + eps)).otherwise(5.0)
    de = F.when(F.col("_ebitda") > 0, F.col("total_debt") / (F.col("_ebitda") + eps)).otherwise(10.0)
    cr = F.col("current_assets") / (F.col("current_liab") + eps)
    dscr = F.when(F.col("_int") > 0, F.col("_ebitda") / (F.col("_int") + eps)).otherwise(5.0)
    actual = {"ICR_min": icr, "Debt_to_EBITDA_max": de, "Current_Ratio_min": cr,
              "DSCR_min_proxy": dscr}
    def breach_of(name, thr, op):
        return (actual[name] < F.lit(thr)) if op == "<" else (actual[name] > F.lit(thr))

    if wide:
        return t.select(*fin.columns, *[breach_of(*x).cast("int").alias(c) for x, c in zip(COVENANTS, BREACH_COLUMNS, strict=True)])
    rows = []
    for name, thr, op in COVENANTS:
        a = actual[name]
        breach = breach_of(name, thr, op)
        rows.append(F.struct(F.lit(name).alias("covenant_name"), F.lit(thr).alias("threshold"),
                             a.alias("actual"), breach.cast("int").alias("breach_flag")))
    return t.select(KEY, F.to_date("fq_date").alias("date"), F.inline(F.array(*rows)))


# ---------------------------------------------------------------------------
# labels
# ---------------------------------------------------------------------------
def default_label(credit: DataFrame, asof: str, horizon_days: int = 365,
                  dpd_threshold: float = 90, min_streak: int = 30,
                  granularity: str = "timestamp") -> DataFrame:
    """12-month default flag: longest run of rows with dpd >= threshold in
    (asof, asof + horizon] reaching ``min_streak`` rows. One row per customer
    seen in ``credit``."""
    d = _day_col(credit, "date", granularity)
    a = _asof_lit(credit, "date", asof, granularity)
    end = F.date_add(a, horizon_days) if _is_day(credit, "date", granularity) \
        else _plus_days(a, horizon_days)
    future = credit.filter((d > a) & (d <= end))
    streaks = max_streak(future, KEY, "date", "dpd_days", dpd_threshold, _others(future), name="_streak")
    universe = credit.select(KEY).distinct()
    return (universe.join(streaks, KEY, "left").select(
        KEY, F.to_date(F.lit(asof)).alias("asof_date"),
        F.when(F.coalesce(F.col("_streak"), F.lit(0)) >= min_streak, 1).otherwise(0)
        .cast("int").alias("event_h12m")))


def label_risk_flags(credit: DataFrame, covenant: DataFrame, labels: DataFrame, asof: str,
                     horizon_days: int = 365, past_rows: int = 30, util_cutoff: float = 0.90,
                     util_bump: float = 0.20, cov_bump: float = 0.20,
                     covenant_asof: str | None = None) -> DataFrame:
    """For non-events: utilisation over the last ``past_rows`` rows up to as-of
    and any future covenant breach -> the bump probability of the label rule."""
    a = _asof_lit(credit, "date", asof, "timestamp")
    past = credit.filter(_day_col(credit, "date", "timestamp") <= a)
    flagged = tail_flags(past, KEY, "date", {"_p": past_rows}, _others(past)).filter("_p")
    util = flagged.groupBy(KEY).agg(
        F.avg("utilized").alias("_um"), F.avg("credit_limit").alias("_lm"))
    util = util.select(KEY, F.when(F.col("_lm") > 0, F.col("_um") / F.col("_lm"))
                       .otherwise(0.0).alias("util_rate_30"))
    cas = covenant_asof or asof
    ca = _asof_lit(covenant, "date", cas, "timestamp")
    cend = F.date_add(ca, horizon_days) if _is_day(covenant, "date", "timestamp") \
        else _plus_days(ca, horizon_days)
    cd = F.col("date")
    fut = (covenant.filter((cd > ca) & (cd <= cend) & (F.col("breach_flag") == 1))
           .select(KEY).distinct().withColumn("_fb", F.lit(True)))
    out = (labels.select(KEY, "event_h12m").join(util, KEY, "left").join(fut, KEY, "left"))
    ur = F.coalesce(F.col("util_rate_30"), F.lit(0.0))
    fb = F.coalesce(F.col("_fb"), F.lit(False))
    bump = (F.when(ur > util_cutoff, util_bump).otherwise(0.0)
            + F.when(fb, cov_bump).otherwise(0.0))
    return out.select(KEY, "event_h12m", ur.alias("util_rate_30"),
                      fb.alias("future_covenant_breach"),
                      F.when(F.col("event_h12m") == 0, bump).alias("bump_prob"))


# ---------------------------------------------------------------------------
# exclusion + assembly
# ---------------------------------------------------------------------------
def npe_customers(credit: DataFrame, asof: str, recent_days: int = 7, dpd: int = 90,
                  granularity: str = "timestamp") -> DataFrame:
    """Customers with max DPD >= ``dpd`` in the last ``recent_days`` (NPE proxy)."""
    recent = filter_recent_window(credit, asof, recent_days, "date", granularity)
    return (recent.groupBy(KEY).agg(F.max("dpd_days").alias("_m"))
            .filter(F.col("_m") >= dpd).select(KEY))


def join_exclude_npe(df: DataFrame, credit: DataFrame, asof: str, recent_days: int = 7,
                     dpd: int = 90, granularity: str = "timestamp") -> DataFrame:
    return df.join(npe_customers(credit, asof, recent_days, dpd, granularity), KEY, "left_anti")


def unique_labels(labels: DataFrame) -> DataFrame:
    """One label per customer (latest ``asof_date``) so the join cannot fan out."""
    return labels.groupBy(KEY).agg(
        F.max_by("event_h12m", F.col("asof_date")).cast("int").alias("event_h12m"))


def assemble_features(fin_rat: DataFrame, behav: DataFrame, cashf: DataFrame,
                      covf: DataFrame | None, labels: DataFrame | None) -> DataFrame:
    """Ratios left-joined with behaviour, cash flow, covenants and labels. Without ``covf`` the ratios have its columns."""
    df = fin_rat.join(behav, KEY, "left").join(cashf, KEY, "left")
    if covf is None:
        df = df.select(*[c for c in df.columns if c not in COVENANT_COLUMNS], *COVENANT_COLUMNS)
    else:
        df = df.join(covf, KEY, "left")
    if labels is not None:
        df = df.join(unique_labels(labels), KEY, "left")
    return df


def ratios_and_covenants(fin: DataFrame, covenant: DataFrame | None, p: FeatureParams) -> tuple[DataFrame, DataFrame | None]:
    """The two sides of the assembly; one, with the covenants' columns, where the tests are made from ``fin``."""
    window = (p.covenant_asof or p.asof, p.covenant_days or p.obs_days, p.granularity)
    if covenant is not None:
        return fin_ratios(fin, asof=p.fin_asof), covenant_features(covenant, *window)
    tested = covenant_features(covenant_test(fin, wide=True), *window, beside=True)
    return fin_ratios(tested, asof=p.fin_asof, keep=COVENANT_COLUMNS), None


def features_build(fin: DataFrame, credit: DataFrame, cashflow: DataFrame,
                   covenant: DataFrame | None, labels: DataFrame | None, p: FeatureParams) -> DataFrame:
    """Full feature table: ratios, behaviour, cash flow, covenants, label,
    NPE exclusion, winsorizing and robust (sector, size) z-scores.

    Without a table of covenant tests they are made from ``fin``, in the pass over its quarters that makes the ratios.
    """
    fin_rat, covf = ratios_and_covenants(fin, covenant, p)
    behav = behavior_features(credit, p)
    cashf = cashflow_features(cashflow, p)
    df = assemble_features(fin_rat, behav, cashf, covf, labels)
    df = join_exclude_npe(df, credit, p.asof, p.recent_days, p.npe_dpd, p.granularity)
    cols = [c for c in MODEL_COLUMNS if c in df.columns]
    # the assembled table feeds the quantile pass and the clip pass, and the
    # winsorized one feeds three statistics passes: checkpoint each once
    if p.materialize:
        df = materialize(df)
    if p.winsor is not None:
        df = winsorize(df, cols, p.winsor[0], p.winsor[1])
        if p.materialize and p.normalize:
            df = materialize(df)
    else:
        df = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                         for c in df.columns])
    if p.normalize:
        df = robust_zscore(df, cols, ("sector_code", "size_bucket"), p.min_group)
    return df
