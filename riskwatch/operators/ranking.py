"""Rank metrics per group (cohort month, segment, ...) without a row-level sort.

Everything is computed on the *per-score counts* table
``(keys, score) -> n_pos, n_neg``: one partial aggregation over the rows, then
cumulative counts by a two-phase prefix sum (``prefix_sums``) so a cohort of
any size never lands in one task. Ties are handled exactly (mid-rank AUC,
tie-aware KS, step-wise average precision).

* AUC  = sum(n_pos * (neg_below + n_neg / 2)) / (P * N)
* KS   = max |cum_pos / P - cum_neg / N|   (``signed=True``: max(0, cum_neg/N - cum_pos/P))
* AP   = sum(n_pos * tp / (tp + fp)) / P, tp / fp counted at score >= s
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import prefix_sums
from ..session import materialize


def score_counts(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """``(keys, score) -> n_pos, n_neg, n`` (map-side combined)."""
    y = F.col(label).cast("long")
    return df.groupBy(*keys, F.col(score).alias("_s")).agg(
        F.sum(y).alias("n_pos"), F.sum(F.lit(1) - y).alias("n_neg"),
        F.count(F.lit(1)).alias("n"))


def cumulative_counts(counts: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Add inclusive ascending cumulative n_pos / n_neg / n and group totals P, N, T."""
    cum = prefix_sums(counts, keys, "_s", ["n_pos", "n_neg", "n"], ascending=True,
                      buckets=buckets)
    keys = list(keys)
    tot = counts.groupBy(*keys).agg(F.sum("n_pos").alias("tot_pos"), F.sum("n_neg").alias("tot_neg"),
                                    F.sum("n").alias("tot_n"))
    return cum.join(tot, keys, "inner") if keys else cum.crossJoin(F.broadcast(tot))


def cumulative_scores(df: DataFrame, keys: Sequence[str], score: str, label: str,
                      buckets: int | None = None) -> DataFrame:
    """The cumulative per-score counts, from counts that are made and written once:
    the bucket edges, bucket sums, group totals and running sums all read them."""
    counts = materialize(score_counts(df, keys, score, label), "counts")
    return cumulative_counts(counts, keys, buckets)


def rank_metrics(df: DataFrame, keys: Sequence[str], score: str, label: str,
                 signed_ks: bool = False, buckets: int | None = None, cum: DataFrame | None = None) -> DataFrame:
    """Per group: auc, ks, pr_auc, n_pos, n_neg (NULL when a class is missing).
    ``cum``: the group's ``cumulative_scores`` where several metrics share them."""
    keys = list(keys)
    c = cumulative_scores(df, keys, score, label, buckets) if cum is None else cum
    P, N = F.col("tot_pos").cast("double"), F.col("tot_neg").cast("double")
    neg_below = F.col("cum_n_neg") - F.col("n_neg")
    tp = F.col("tot_pos") - (F.col("cum_n_pos") - F.col("n_pos"))
    fp = F.col("tot_neg") - (F.col("cum_n_neg") - F.col("n_neg"))
    if signed_ks:
        ks_term = F.col("cum_n_neg") / N - F.col("cum_n_pos") / P
    else:
        ks_term = F.abs(F.col("cum_n_pos") / P - F.col("cum_n_neg") / N)
    valid = (F.col("tot_pos") > 0) & (F.col("tot_neg") > 0)
    agg = c.groupBy(*keys, "tot_pos", "tot_neg").agg(
        F.sum(F.col("n_pos") * (neg_below + F.col("n_neg") / 2.0)).alias("_auc_num"),
        F.max(F.when(valid, ks_term)).alias("_ks"),
        F.sum(F.when(F.col("n_pos") > 0, F.col("n_pos") * tp / (tp + fp))).alias("_ap_num"))
    ks = F.col("_ks")
    if signed_ks:
        ks = F.greatest(ks, F.lit(0.0))
    return agg.select(
        *keys,
        F.when(valid, F.col("_auc_num") / (P * N)).alias("auc"),
        F.when(valid, ks).alias("ks"),
        F.when(F.col("tot_pos") > 0, F.col("_ap_num") / P).alias("pr_auc"),
        F.col("tot_pos").alias("n_pos"), F.col("tot_neg").alias("n_neg"))


def auc(df, keys, score, label, buckets=None):
    return rank_metrics(df, keys, score, label, buckets=buckets).select(*keys, "auc")


def ks(df, keys, score, label, signed=False, buckets=None):
    return rank_metrics(df, keys, score, label, signed, buckets).select(*keys, "ks")


def pr_auc(df, keys, score, label, buckets=None):
    return rank_metrics(df, keys, score, label, buckets=buckets).select(*keys, "pr_auc")


def brier(df: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(F.pow(F.col(label).cast("double") - F.col(score), 2)).alias("brier"))


def pr_curve_points(df: DataFrame, keys: Sequence[str], score: str, label: str,
                    buckets: int | None = None) -> DataFrame:
    """Precision / recall at every distinct score (thresholds below the lowest
    positive score are dropped, as the classic curve stops at full recall)."""
    keys = list(keys)
    c = cumulative_scores(df, keys, score, label, buckets)
    tp = F.col("tot_pos") - (F.col("cum_n_pos") - F.col("n_pos"))
    fp = F.col("tot_neg") - (F.col("cum_n_neg") - F.col("n_neg"))
    min_pos = c.filter(F.col("n_pos") > 0).groupBy(*keys).agg(F.min("_s").alias("_minpos"))
    j = c.join(min_pos, keys, "inner") if keys else c.crossJoin(F.broadcast(min_pos))
    return j.filter(F.col("_s") >= F.col("_minpos")).select(
        *keys, F.col("_s").alias("threshold"),
        (tp / (tp + fp)).alias("precision"), (tp / F.col("tot_pos")).alias("recall"))


# ---------------------------------------------------------------------------
# lift (top-k without a global row_number)
# ---------------------------------------------------------------------------
def lift_at_k(df: DataFrame, keys: Sequence[str], score: str, label: str,
              fracs: Sequence[float] = (0.1, 0.2), tiebreak: str | None = None,
              buckets: int | None = None, cum: DataFrame | None = None) -> DataFrame:
    """Event rate in the top ``max(1, floor(n * frac))`` rows over the base rate (+1e-12).

    The k-th score is located from cumulative counts; only rows tied at that
    score are ranked (by ``tiebreak``) to fill the remainder.
    """
    keys = list(keys)
    c = cumulative_scores(df, keys, score, label, buckets) if cum is None else cum
    fr = F.array(*[F.lit(float(f)) for f in fracs])
    c = c.select("*", F.explode(fr).alias("frac"))
    k = F.greatest(F.lit(1), F.floor(F.col("tot_n") * F.col("frac")).cast("long"))
    above = F.col("tot_n") - F.col("cum_n")              # rows with a higher score
    pos_above = F.col("tot_pos") - F.col("cum_n_pos")
    cut = c.filter((above < k) & (above + F.col("n") >= k)).select(
        *keys, "frac", "tot_n", "tot_pos", F.col("_s").alias("_cut"), pos_above.alias("_pos_above"),
        (k - above).alias("_take"), F.col("n").alias("_tie_n"), F.col("n_pos").alias("_tie_pos"),
        k.alias("_k"))
    # rows at the cut score: positives among the first ``_take`` in tiebreak order,
    # found with a two-phase running count over the tied rows only (a huge tie
    # group is still split into buckets); without a tiebreak, the expected share
    if tiebreak is not None:
        ties = df.select(*keys, F.col(score).alias("_s"), F.col(label).cast("long").alias("_y"),
                         F.col(tiebreak).alias("_tb"))
        need = cut.filter(F.col("_take") < F.col("_tie_n")).select(*keys, "frac", "_cut", "_take")
        tied = ties.join(need, [*(ties[k_] == need[k_] for k_ in keys), ties["_s"] == need["_cut"]], "inner")
        tied = tied.select(*[ties[k_] for k_ in keys], "frac", "_tb", "_take", "_y",
                           F.lit(1).alias("_one"))
        run = prefix_sums(tied, keys + ["frac"], "_tb", ["_one", "_y"], buckets=buckets)
        partial = run.filter(F.col("cum__one") == F.col("_take")).select(
            *keys, "frac", F.col("cum__y").alias("_tie_take_pos"))
    else:
        partial = cut.select(*keys, "frac", (F.col("_tie_pos") * F.col("_take") / F.col("_tie_n"))
                             .alias("_tie_take_pos"))
    j = cut.join(partial, keys + ["frac"], "left")
    tie_pos = F.when(F.col("_take") >= F.col("_tie_n"), F.col("_tie_pos")).otherwise(
        F.coalesce(F.col("_tie_take_pos"), F.lit(0)))
    top_pos = F.col("_pos_above") + tie_pos
    base = F.col("tot_pos") / F.col("tot_n") + F.lit(1e-12)
    return j.select(*keys, "frac", ((top_pos / F.col("_k")) / base).alias("lift"),
                    (top_pos / F.greatest(F.col("tot_pos"), F.lit(1))).alias("capture"))


def lift_wide(df: DataFrame, keys: Sequence[str], score: str, label: str,
              fracs=(0.1, 0.2), tiebreak: str | None = None, buckets=None, cum=None) -> DataFrame:
    """``lift_10pct``, ``lift_20pct`` ... as columns (one row per group)."""
    lf = lift_at_k(df, keys, score, label, fracs, tiebreak, buckets, cum)
    return lf.groupBy(*keys).agg(*[
        F.max(F.when(F.col("frac") == float(f), F.col("lift"))).alias(f"lift_{int(round(f * 100))}pct")
        for f in fracs])


# ---------------------------------------------------------------------------
# thresholds
# ---------------------------------------------------------------------------
def _cut_aggs(score: str, label: str, cuts: Sequence[float]) -> list[Column]:
    p, y = F.col(score), F.col(label).cast("long")
    out = []
    for i, c in enumerate(cuts):
        hit = p >= F.lit(float(c))
        out += [F.count_if(hit).alias(f"_a{i}"), F.sum(F.when(hit, y).otherwise(0)).alias(f"_t{i}")]
    return out


def _cut_struct(i: int, c: float) -> Column:
    a, t = F.col(f"_a{i}"), F.col(f"_t{i}")
    return F.struct(
        F.lit(float(c)).alias("cut"),
        (a / F.col("_n")).alias("alert_rate"),
        F.when(a > 0, t / a).alias("precision"),
        F.when(F.col("_ev") > 0, t / F.col("_ev")).alias("recall"),
        a.alias("alerts"))


def threshold_sweep(df: DataFrame, keys: Sequence[str], score: str, label: str,
                    cuts: Sequence[float]) -> DataFrame:
    """Alert rate, precision, recall and alerts at every cut — ONE aggregation
    pass with one conditional count per cut, then unpivot (no join, no window)."""
    keys = list(keys)
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                F.sum(F.col(label).cast("long")).alias("_ev"),
                                *_cut_aggs(score, label, cuts))
    return agg.select(*keys, F.inline(F.array(*[_cut_struct(i, c) for i, c in enumerate(cuts)])))


def threshold_eval(df: DataFrame, keys: Sequence[str], score: str, label: str,
                   named_cuts: dict[str, float]) -> DataFrame:
    """Wide ``<name>_alert_rate / _precision / _recall / _alerts`` for named cuts."""
    keys = list(keys)
    names = list(named_cuts)
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                F.sum(F.col(label).cast("long")).alias("_ev"),
                                *_cut_aggs(score, label, [named_cuts[n] for n in names]))
    cols = []
    for i, n in enumerate(names):
        s = _cut_struct(i, named_cuts[n])
        cols += [s["alert_rate"].alias(f"{n}_alert_rate"), s["precision"].alias(f"{n}_precision"),
                 s["recall"].alias(f"{n}_recall"), s["alerts"].alias(f"{n}_alerts")]
    return agg.select(*keys, *cols)


def join_cut_theta(df: DataFrame, keys: Sequence[str], score: str, label: str,
                   cuts: Sequence[float]) -> DataFrame:
    """The sweep written as a range join: each row meets the one interval between two cuts that holds its score, and a
    cut's alerts are the sum over the intervals from it on. No row is repeated; kept as a cross-check."""
    keys, places = list(keys), sorted(float(c) for c in cuts)
    p, y = F.col(score), F.col(label).cast("long")
    above = F.array(*[F.lit(c) for c in places])
    interval = F.size(F.filter(above, lambda c: c <= p))  # the cuts that the row reaches
    rows = df.groupBy(*keys, interval.alias("_k")).agg(F.count("*").alias("n"), F.sum(y).alias("tp"))
    ofkey = rows.groupBy(*keys).agg(F.collect_list(F.struct("_k", "n", "tp")).alias("_r"))  # one entry an interval

    def total(name: str, least: int):
        return F.aggregate("_r", F.lit(0).cast("long"), lambda s, r: s + F.when(r["_k"] >= least, F.coalesce(r[name], F.lit(0))).otherwise(0))

    points = F.array(*[F.struct(F.lit(c).alias("cut"), total("n", i + 1).alias("alerts"), total("tp", i + 1).alias("_tp"))
                       for i, c in enumerate(places)])
    j = ofkey.select(*keys, total("n", 0).alias("_n"), total("tp", 0).alias("_ev"), F.inline(points))
    a, t = F.col("alerts"), F.col("_tp")
    return j.select(*keys, "cut", (a / F.col("_n")).alias("alert_rate"),
                    F.when(a > 0, t / a).alias("precision"),
                    F.when(F.col("_ev") > 0, t / F.col("_ev")).alias("recall"), "alerts")
