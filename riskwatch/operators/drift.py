"""Population stability (PSI) and data quality.

All series / features / months are handled in ONE job: the inputs are
unpivoted to long form (period, series, value) once, baseline quantile edges
come from the per-value counts (``calib.quantiles_from_counts``), and bucket
counts are one grouped aggregation. No per-month, per-feature driver loop.

Two numeric PSI variants exist (both kept, see SURVEY ledger 15):

* ``psi_numeric``  (backtest): baseline percentile edges, outer edges stretched
  to cover the current period, left-closed histogram bins, epsilon 1e-5 added
  to every count, normaliser ``total + eps * number_of_edges``.
* ``psi_feature_table`` (monitoring): right-closed bins (first closed),
  out-of-range values dropped, empty shares replaced by 1e-12, NULL when a
  side has fewer than max(50, 5 bins) values or fewer than 3 distinct edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .calib import percent_probs, quantiles_from_counts
from .ranking import cumulative_counts
from .robust import exact_quantiles

PSI_EPS = 1e-5
MON_EPS = 1e-12


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "series",
            value: str = "value", cast: str | None = "double") -> DataFrame:
    """Wide -> long ``(ids, name, value)`` (one row per input row and column)."""
    vals = [F.col(c).cast(cast) if cast else F.col(c) for c in cols]
    packed = F.array(*[F.struct(F.lit(c).alias(name), v.alias(value)) for c, v in zip(cols, vals)])
    return df.select(*ids, F.inline(packed))


def _value_counts(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (long.filter(F.col("value").isNotNull())
            .groupBy(*keys, F.col("value").alias("_s"))
            .agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("n_pos"),
                 F.lit(0).cast("long").alias("n_neg")))


def baseline_edges(long_base: DataFrame, keys: Sequence[str], n_bins: int) -> DataFrame:
    """Per key: distinct percentile edges (0, 100/n, ..., 100) of the baseline values."""
    keys = list(keys)
    vc = _value_counts(long_base, keys)
    cum = cumulative_counts(vc, keys)
    e = quantiles_from_counts(cum, keys, percent_probs(n_bins))
    return e.select(*keys, F.array_distinct("edges").alias("edges"))


def feature_edges(base: DataFrame, feats: Sequence[str], n_bins: int) -> DataFrame:
    """feature, edges: distinct percentile edges of each column, one row a feature with two edges or more."""
    row = exact_quantiles(base, feats, percent_probs(n_bins))
    packed = F.array(*[F.struct(F.lit(c).alias("feature"),
                                F.array_distinct("_q_" + c).alias("edges"))
                       for c in feats])
    return row.select(F.inline(packed)).where(F.size("edges") >= 2)


# ---------------------------------------------------------------------------
# backtest PSI (monthly)
# ---------------------------------------------------------------------------
def flagged(df: DataFrame, period: str, cols: Sequence[str], cast: str = "double") -> DataFrame:
    """(series, _m, value, _is_base) of the columns; the baseline is the earliest period."""
    long = unpivot(df, [period], cols, cast=cast)
    base = df.agg(F.min(period).alias("_b"))
    return long.crossJoin(F.broadcast(base)).select(
        "series", F.col(period).alias("_m"), "value", F.coalesce(F.col(period) == F.col("_b"), F.lit(False)).alias("_is_base"))


def psi_numeric(long: DataFrame, period: str, base_period_value, n_bins: int = 10) -> DataFrame:
    """``long`` = (period, series, value): PSI of every period against the
    baseline period, per series -> (series, period, psi)."""
    is_base = F.coalesce(F.col(period) == F.lit(base_period_value), F.lit(False)).alias("_is_base")
    return psi_numeric_flagged(long.select("series", F.col(period).alias("_m"), "value", is_base), n_bins).withColumnRenamed("_m", period)


def psi_categorical(long: DataFrame, period: str, base_period_value) -> DataFrame:
    """Category-share PSI of every period vs the baseline period -> (series, period, psi)."""
    is_base = F.coalesce(F.col(period) == F.lit(base_period_value), F.lit(False)).alias("_is_base")
    return psi_categorical_flagged(long.select("series", F.col(period).alias("_m"), F.col("value").cast("string"), is_base)) \
        .withColumnRenamed("_m", period)


def psi_numeric_flagged(long: DataFrame, n_bins: int = 10) -> DataFrame:
    """``long`` = (series, _m, value, _is_base) -> (series, _m, psi)."""
    long = materialize(long, "series")  # read for edges and counts
    edges = materialize(baseline_edges(long.filter("_is_base"), ["series"], n_bins), "edges")
    counts = materialize(_cells(long.join(F.broadcast(edges), "series", "left"), _bin("value")), "counts")
    return _numeric_psi(counts, edges)


def psi_categorical_flagged(long: DataFrame) -> DataFrame:
    """As above for categories (NULLs excluded, epsilon added to both shares, no renormalisation)."""
    return _category_psi(materialize(_cells(long, F.col("value")), "counts"))


def category_union(long: DataFrame) -> DataFrame:
    """series, _m, n_categories: the categories that the period or the baseline has, as those of the period, plus those of
    the baseline, less those of both."""
    counts = materialize(_cells(long, F.col("value")), "counts")
    base = counts.where(F.col("_is_base") & F.col("cell").isNotNull()).select("series", "cell", F.lit(1).alias("hit"))
    whole = base.groupBy("series").agg(F.count("*").alias("whole"))
    j = counts.join(base, ["series", "cell"], "left").groupBy("series", "_m").agg(
        F.count("cell").alias("own"), F.count("hit").alias("both")).join(F.broadcast(whole), "series", "left")  # a row a series
    n = F.col("own") + F.coalesce("whole", F.lit(0)) - F.col("both")
    return j.select("series", "_m", n.alias("n_categories")).where("n_categories > 0")


def psi_monthly(cohorts: DataFrame, date_col: str = "as_of_date",
                numeric=("pd_12m", "ead", "lgd"), categorical=("sector", "grade"),
                names: dict | None = None, n_bins: int = 10) -> DataFrame:
    """Each month vs the earliest month, wide: as_of_date, pd_score, sector_mix,
    grade_mix, ead, lgd.

    The columns are written once, and one aggregation counts (series, month, bin or category)
    for all of them; the rest works on these counts.
    """
    names = names or {"pd_12m": "pd_score", "sector": "sector_mix", "grade": "grade_mix",
                      "ead": "ead", "lgd": "lgd"}
    d = materialize(cohorts.select(F.last_day(F.to_date(date_col)).alias("_m"), *[F.col(c).cast("double") for c in numeric],
                                   *[F.col(c).cast("string") for c in categorical]), "cohorts")
    d = d.crossJoin(F.broadcast(d.agg(F.min("_m").alias("_b")))).withColumn("_is_base", F.col("_m") == F.col("_b")).drop("_b")
    edges = materialize(feature_edges(d.where("_is_base"), numeric, n_bins).withColumnRenamed("feature", "series"), "edges")
    none = F.lit(None)
    packed = F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("value"), none.cast("string").alias("category")) for c in numeric],
                     *[F.struct(F.lit(c).alias("series"), none.cast("double").alias("value"), F.col(c).alias("category")) for c in categorical])
    long = d.select("_m", "_is_base", F.inline(packed)).join(F.broadcast(edges), "series", "left")
    cell = F.coalesce(F.col("category"), _bin("value"))
    counts = materialize(_cells(long, cell), "counts")
    numbers = F.col("series").isin(*numeric)
    long = _numeric_psi(counts.where(numbers), edges).unionByName(_category_psi(counts.where(~numbers)))
    order = [names.get(c, c) for c in ("pd_12m", "sector", "grade", "ead", "lgd")
             if c in list(numeric) + list(categorical)]
    return long.groupBy(F.col("_m").alias("as_of_date")).agg(*[
        F.max(F.when(F.col("series") == src, F.col("psi"))).alias(names.get(src, src))
        for src in list(numeric) + list(categorical)]).select("as_of_date", *order)


def _bin(value: str):
    """The number of the bin of ``edges`` that holds the value, as text; bins are closed to the left, the outer ones
    open. Null without a value or without edges."""
    interior = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    found = F.size(F.filter(interior, lambda e: e <= F.col(value)))
    return F.when(F.col(value).isNotNull() & F.col("edges").isNotNull(), found.cast("string"))


def _cells(long: DataFrame, cell) -> DataFrame:
    """Rows of each (series, period, cell); rows without a cell are counted under null."""
    return long.groupBy("series", "_m", "_is_base", cell.alias("cell")).agg(F.count("*").alias("c"))


def _numeric_psi(counts: DataFrame, edges: DataFrame, eps: float = PSI_EPS) -> DataFrame:
    """series, _m, psi from the counts of bins: a row of counts for each (series, period) beside the baseline's."""
    some = F.col("cell").isNotNull()
    rows = counts.groupBy("series", "_m", "_is_base").agg(
        F.coalesce(F.sum(F.when(some, F.col("c"))), F.lit(0)).alias("tot"),
        F.collect_list(F.when(some, F.struct(F.col("cell").cast("int").alias("bin"), "c"))).alias("bins"))  # one entry a bin
    base = rows.where("_is_base").select("series", F.col("tot").alias("btot"), F.col("bins").alias("bbins"))
    n = edges.select("series", F.size("edges").alias("n"))
    j = rows.join(base, "series", "left").join(F.broadcast(n), "series", "left")

    def share(bins: str, total: str, b):
        hits = F.aggregate(bins, F.lit(0).cast("long"), lambda s, x: s + F.when(x["bin"] == b, x["c"]).otherwise(0))
        return (hits + eps) / (F.col(total) + eps * F.col("n"))

    def term(s, b):
        a, e = share("bins", "tot", b), share("bbins", "btot", b)
        return s + (a - e) * F.ln(a / e)

    psi = F.aggregate(F.sequence(F.lit(0), F.col("n") - 2), F.lit(0.0), term)
    ok = (F.col("tot") > 0) & (F.col("btot") > 0) & (F.col("n") >= 2)
    return j.select("series", "_m", F.when(ok, psi).otherwise(0.0).alias("psi"))


def _category_psi(counts: DataFrame, eps: float = PSI_EPS) -> DataFrame:
    """series, _m, psi from the counts of categories.

    A baseline category that a period lacks adds a term that depends on the baseline alone. So the sum over all
    baseline categories of these terms is made once, and each category that the period has adds its own term less that
    one: categories never meet periods that don't have them.
    """
    some = F.col("cell").isNotNull()
    totals = counts.where(some).groupBy("series", "_m").agg(F.sum("c").alias("tot"))
    shares = counts.join(totals, ["series", "_m"], "left").select(
        "series", "_m", "_is_base", "cell", F.when(some, F.col("c") / F.col("tot")).alias("share"))
    e = F.col("share") + eps
    absent = ((eps - e) * F.ln(eps / e)).alias("absent")
    base = shares.where(some & F.col("_is_base")).select("series", "cell", F.col("share").alias("bshare"), absent)
    whole = base.groupBy("series").agg(F.sum("absent").alias("whole"))
    j = shares.join(base, ["series", "cell"], "left")
    a, e = F.col("share") + eps, F.coalesce("bshare", F.lit(0.0)) + eps
    own = F.when(F.col("share").isNotNull(), (a - e) * F.ln(a / e) - F.coalesce("absent", F.lit(0.0)))
    psi = j.groupBy("series", "_m").agg(F.sum(own).alias("own")).join(F.broadcast(whole), "series", "left")  # a row a series
    return psi.select("series", "_m", (F.coalesce("own", F.lit(0.0)) + F.coalesce("whole", F.lit(0.0))).alias("psi"))


def psi_summary(psi_wide: DataFrame, cols=("pd_score", "sector_mix", "grade_mix", "ead", "lgd")) -> DataFrame:
    """max, mean and status (Stable < 0.10 <= Moderate < 0.25 <= Significant) per series."""
    long = unpivot(psi_wide, [], cols, name="series", value="psi")
    agg = long.groupBy("series").agg(F.max("psi").alias("max_psi"), F.avg("psi").alias("mean_psi"))
    return agg.select("series", "max_psi", "mean_psi",
                      F.when(F.col("max_psi") < 0.10, "Stable")
                      .when(F.col("max_psi") < 0.25, "Moderate").otherwise("Significant").alias("status"))


# ---------------------------------------------------------------------------
# monitoring PSI per feature
# ---------------------------------------------------------------------------
def numeric_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    num = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    types = dict(df.dtypes)
    return [c for c in cols if c in types and (types[c] in num or types[c].startswith("decimal"))]


def psi_feature_table(base: DataFrame, cur: DataFrame, features: Sequence[str], bins: int = 10,
                      eps: float = MON_EPS) -> DataFrame:
    """feature, psi (4 places), status, severity, severity_rank, missing_rate, missing_delta."""
    feats = [c for c in numeric_columns(base, features) if c in numeric_columns(cur, features)]
    if not feats:
        schema = ("feature string, psi double, status string, severity string, "
                  "severity_rank int, missing_rate double, missing_delta double")
        return base.sparkSession.createDataFrame([], schema)
    sides = [df.select(F.lit(i).alias("_side"), *[F.col(c).cast("double").alias(c) for c in feats]) for i, df in enumerate((base, cur))]
    both = materialize(sides[0].unionByName(sides[1]), "sides")  # read for missing shares, edges and bins
    stats = both.groupBy("_side").agg(*[F.struct(F.count(c).alias("n"), F.avg(F.col(c).isNull().cast("double")).alias("miss")).alias(c)
                                        for c in feats])
    packed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["n"].alias("n"), F.col(c)["miss"].alias("miss")) for c in feats])
    stats = stats.select("_side", F.inline(packed)).groupBy("feature").agg(*[
        F.max(F.when(F.col("_side") == i, F.col(c))).alias(f"{c}_{side}") for i, side in enumerate("bc") for c in ("n", "miss")])
    stats = stats.withColumns({f"n_{s}": F.coalesce(f"n_{s}", F.lit(0)) for s in "bc"})  # a side without rows
    edges = materialize(feature_edges(both.where("_side = 0"), feats, bins), "edges")  # a row a feature
    lo, hi = F.element_at("edges", 1), F.element_at("edges", -1)
    interior = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    # the long rows only live inside the task: they are counted before the shuffle
    inr = unpivot(both, ["_side"], feats, "feature").join(F.broadcast(edges), "feature").where(F.col("value").between(lo, hi))
    counts = inr.groupBy("feature", "_side", F.size(F.filter(interior, lambda e: e < F.col("value"))).alias("bin")).agg(F.count("*").alias("c"))
    lists = counts.groupBy("feature").agg(F.collect_list(F.struct("_side", "bin", "c")).alias("cells"))  # one a side and bin

    def rows(side: int, b=None):
        hit = lambda x: (x["_side"] == side) & (F.lit(True) if b is None else x["bin"] == b)
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, x: s + F.when(hit(x), x["c"]).otherwise(0))

    def share(side: int, b):
        s = rows(side, b) / F.col("tots")[side]
        return F.when(s == 0, F.lit(eps)).otherwise(s)

    def term(s, b):
        e, a = share(0, b), share(1, b)
        return s + (a - e) * F.ln(a / e)

    psi = edges.join(lists, "feature").withColumn("tots", F.array(*[F.when(rows(i) > 0, rows(i)) for i in (0, 1)]))
    psi = psi.select("feature", F.aggregate(F.sequence(F.lit(0), F.size("edges") - 2), F.lit(0.0), term).alias("_psi"))
    n_min = max(50, bins * 5)
    j = stats.join(edges, "feature", "left").join(psi, "feature", "left")
    valid = (F.col("n_b") >= n_min) & (F.col("n_c") >= n_min) & (F.size("edges") >= 3)
    v = F.when(valid, F.bround("_psi", 4))
    status = (F.when(v.isNull(), "insufficient").when(v < 0.10, "stable")
              .when(v < 0.25, "moderate").otherwise("severe"))
    severity = (F.when(v.isNull(), "unknown").when(v < 0.10, "ok")
                .when(v < 0.25, "warn").otherwise("severe"))
    rank = (F.when(v.isNull(), 3).when(v < 0.10, 2).when(v < 0.25, 1).otherwise(0))
    return j.select("feature", v.alias("psi"), status.alias("status"), severity.alias("severity"),
                    rank.cast("int").alias("severity_rank"),
                    F.bround("miss_c", 4).alias("missing_rate"),
                    F.bround(F.col("miss_c") - F.col("miss_b"), 4).alias("missing_delta"))


def sort_psi(psi_tab: DataFrame, engine_order: bool = False) -> DataFrame:
    """Reference order: severity descending as text (warn, unknown, severe, ok),
    then psi descending with NULLs last; ``engine_order`` puts severe first."""
    if engine_order:
        return psi_tab.orderBy(F.col("severity_rank").asc(), F.col("psi").desc_nulls_last(),
                               F.col("feature").asc())
    return psi_tab.orderBy(F.col("severity").desc(), F.col("psi").desc_nulls_last(), F.col("feature").asc())


def topk_psi(psi_tab: DataFrame, k: int = 20) -> DataFrame:
    """The first ``k`` features of the sorted PSI table (report section)."""
    return sort_psi(psi_tab).limit(k)


def psi_overall(psi_tab: DataFrame, warn: float = 0.10) -> DataFrame:
    """Median of non-null feature PSI (0.0 if none), warn flag, counts of severe / warn."""
    return psi_tab.agg(
        F.coalesce(F.bround(F.percentile("psi", 0.5), 4), F.lit(0.0)).alias("psi_overall"),
        F.count_if(F.col("severity") == "severe").alias("psi_severe_count"),
        F.count_if(F.col("severity") == "warn").alias("psi_warn_count"),
    ).select("*", (F.col("psi_overall") >= warn).alias("psi_alert"))


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------
def missing_rates(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, base_missing, cur_missing, delta — one aggregation per side."""
    feats = [c for c in features if c in base.columns and c in cur.columns]

    def rates(df, name):
        row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in feats])
        return unpivot(row, [], feats, "feature", name)
    return rates(base, "base_missing").join(rates(cur, "cur_missing"), "feature").select(
        "feature", "base_missing", "cur_missing",
        (F.col("cur_missing") - F.col("base_missing")).alias("delta"))


def data_quality(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: overall missing rate of the current table (mean over features) and
    the number of features whose missing rate rose by more than 0.01."""
    feats = [c for c in features if c in cur.columns]
    row = cur.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in feats])
    overall = row.select(F.bround(sum((F.col(c) for c in feats), F.lit(0.0)) / len(feats), 4)
                         .alias("missing_rate_overall"))
    inc = missing_rates(base, cur, features).agg(
        F.count_if(F.col("delta") > 0.01).alias("n_missing_increases"))
    return overall.crossJoin(F.broadcast(inc))


def topk_missing(base: DataFrame, cur: DataFrame, features: Sequence[str], k: int = 10,
                 min_delta: float = 0.01) -> DataFrame:
    """Top ``k`` features by missing-rate increase (> ``min_delta``), delta rounded to 4."""
    mr = missing_rates(base, cur, features).filter(F.col("delta") > min_delta)
    return mr.orderBy(F.col("delta").desc(), F.col("feature")).limit(k).select(
        "feature", F.bround("delta", 4).alias("delta"))
