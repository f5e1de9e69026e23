"""Column expressions: null-safe ratios, clipping, logit, scores, tiers, grades, lookups.

All helpers return ``Column`` objects so they stay inside whole-stage codegen.
NULL is the engine's "missing" (the pandas NaN); nothing here produces NaN.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with a zero (or NULL) denominator giving NULL (ANSI-safe)."""
    return F.try_divide(col(num), col(den))


def clip(c: ColumnOrName, lo: float | None, hi: float | None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``least``/``greatest`` alone skip NULLs)."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(x.isNotNull(), out)


def clip_prob(c: ColumnOrName, lo: float = 1e-6, hi: float = 1 - 1e-6) -> Column:
    return clip(c, lo, hi)


def logit(p: ColumnOrName, eps: float = 1e-9) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.ln(q / (F.lit(1.0) - q))


def inv_logit(z: ColumnOrName) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def ews_score(p: ColumnOrName) -> Column:
    """EWS score ``round(100 * (1 - p), 2)`` with half-even rounding (high = safe)."""
    return F.bround(F.lit(100.0) * (F.lit(1.0) - col(p)), 2)


def tier_assign(p: ColumnOrName, red: float, amber: float,
                labels: Sequence[str] = ("Red", "Amber", "Green")) -> Column:
    """Red if p >= red, Amber if p >= amber, else Green; NULL p stays NULL."""
    x = col(p)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x >= F.lit(float(red)), labels[0])
            .when(x >= F.lit(float(amber)), labels[1])
            .otherwise(labels[2]))


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for right results.
# ---------------------------------------------------------------------------
GRADE_LABELS = ("A", "B", "C", "D", "E", "F", "G")
# Portfolio grade scale: upper bounds (exclusive) of grades A..F; G above.
PORTFOLIO_GRADE_BOUNDS = (0.005, 0.01, 0.02, 0.04, 0.07, 0.12)
# Monitoring grade scale: upper bounds (exclusive) of grades A..G; p >= 1.0 gets no grade.
MONITOR_GRADE_BOUNDS = (0.005, 0.01, 0.02, 0.05, 0.10, 0.20, 1.00)

ACTIONS = {
    "Green": "Theo dõi định kỳ; cập nhật BCTC đúng hạn.",
    "Amber": "Soát xét RM ≤10 ngày; yêu cầu management accounts; kiểm tra công nợ; hạn chế tăng hạn mức.",
    "Red": "Họp KH ≤5 ngày; lập kế hoạch dòng tiền 13 tuần; xem xét covenant tightening/TSĐB; đưa watchlist.",
}


def grade_band(p: ColumnOrName, bounds: Sequence[float] = PORTFOLIO_GRADE_BOUNDS,
               labels: Sequence[str] = GRADE_LABELS, open_top: bool = True) -> Column:
    """Half-open bands ``p < bounds[i] -> labels[i]``.

    ``open_top=True`` (portfolio scale) sends everything above the last bound to
    the next label; ``open_top=False`` (monitoring scale) leaves it ungraded.
    Negative p is ungraded on the monitoring scale (its first band starts at 0).
    """
    x = col(p)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    if not open_top:
        expr = expr.when(x < F.lit(0.0), F.lit(None).cast("string"))
    for b, lab in zip(bounds, labels):
        expr = expr.when(x < F.lit(float(b)), lab)
    if open_top:
        return expr.otherwise(labels[len(bounds)])
    return expr.otherwise(F.lit(None).cast("string"))


def lookup(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Literal map lookup (``Series.map(dict)``) with an optional default."""
    if not mapping:
        out = F.lit(None)
    else:
        kv = []
        for k, v in mapping.items():
            kv.extend([F.lit(k), F.lit(v)])
        out = F.create_map(*kv)[col(c)]
    if default is not None:
        out = F.coalesce(out, F.lit(default))
    return out


def action_map(tier: ColumnOrName, actions: Mapping[str, str] = ACTIONS) -> Column:
    return lookup(tier, actions)


def unit_hash(key: ColumnOrName, seed: int = 42) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) per key (20-bit xxhash64 bucket)."""
    return F.pmod(F.xxhash64(col(key), F.lit(seed)), F.lit(1 << 20)).cast("double") / float(1 << 20)


def mult_hash(key: ColumnOrName, seed: int = 42) -> Column:
    """Multiplicative hash of any integer key into [0, 2^32).

    The key is taken modulo 2^32 first and the multiplier is below 2^31, so the
    product fits a long. Keys that agree modulo 2^32 tie: order by (hash, key).
    The same arithmetic is available in any SQL engine, which keeps splits checkable.
    """
    k = F.pmod(col(key).cast("long"), F.lit(4294967296))
    return F.pmod(k * F.lit(1103515245) + F.lit(seed * 40503), F.lit(4294967296))


def id_hash(df, key: str, seed: int = 42) -> Column:
    """Hash of an id column of any type into [0, 2^32)."""
    if dict(df.dtypes)[key] in ("int", "bigint", "smallint", "tinyint"):
        return mult_hash(key, seed)
    return F.pmod(F.xxhash64(col(key), F.lit(seed)), F.lit(4294967296))


def stable_double(c: ColumnOrName, digits: int = 6) -> Column:
    """Output-edge rounding to ``digits`` decimals; ``+ 0.0`` turns -0.0 into 0.0."""
    return F.round(col(c), digits) + F.lit(0.0)


def stable_double_sql(expr: str, digits: int = 6) -> str:
    """SQL text of ``stable_double`` for the oracles."""
    return f"(ROUND(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def round_doubles(df, digits: int = 6, of: Mapping[str, int] | None = None):
    """Round every double column at the output edge; ``of``: the decimals of single columns
    (money sums of many rows differ in their last bits with the order of summation)."""
    out = []
    for name, dtype in df.dtypes:
        x = F.col(f"`{name}`")
        out.append(stable_double(x, (of or {}).get(name, digits)).alias(name) if dtype == "double" else x)
    return df.select(*out)
