"""Macro stress testing of a scored portfolio: every scenario in ONE job.

portfolio x scenarios (broadcast, literal-size table) -> stressed PD ->
impacts -> GROUPING SETS ((scenario), (scenario, sector), (scenario, grade))
-> deltas against the Base rows (self-join on the small aggregate).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import clip, inv_logit, logit, lookup

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for right results.
# ---------------------------------------------------------------------------
ELASTICITIES = {"gdp_growth": -0.20, "unemployment": 0.35, "rates": 0.15, "cpi": 0.10}
SECTOR_BETA = {"Manufacturing": 0.05, "Retail": 0.10, "Services": 0.00, "Construction": 0.12,
               "Agriculture": 0.03}
GRADE_BETA = {"A": -0.10, "B": -0.05, "C": 0.0, "D": 0.05, "E": 0.10, "F": 0.20, "G": 0.30}
SCENARIOS = [
    {"name": "Base", "shocks": {"gdp_growth": 0.0, "unemployment": 0.0, "rates": 0.0, "cpi": 0.0}},
    {"name": "Mild_Recession",
     "shocks": {"gdp_growth": -2.0, "unemployment": 1.5, "rates": 0.5, "cpi": 1.0}},
    {"name": "Moderate_Recession",
     "shocks": {"gdp_growth": -4.0, "unemployment": 3.0, "rates": 1.0, "cpi": 2.0}},
    {"name": "Severe_Recession",
     "shocks": {"gdp_growth": -6.0, "unemployment": 5.0, "rates": 0.0, "cpi": 0.5}},
    {"name": "Stagflation",
     "shocks": {"gdp_growth": -1.0, "unemployment": 2.0, "rates": 3.0, "cpi": 5.0}},
    {"name": "Interest_Rate_Shock",
     "shocks": {"gdp_growth": -1.5, "unemployment": 1.0, "rates": 4.0, "cpi": 3.0}},
    {"name": "Sector_Specific_Construction",
     "shocks": {"gdp_growth": -1.0, "unemployment": 1.0, "rates": 1.0, "cpi": 0.5},
     "sector_multipliers": {"Construction": 2.0, "Manufacturing": 1.2, "Retail": 1.1,
                            "Services": 1.0, "Agriculture": 1.0}},
]
MEASURES = ("ead", "npl_proxy", "el", "provision", "capital", "credit_income")
DELTA_MEASURES = ("npl_proxy", "el", "provision", "capital", "credit_income")


def scenario_shift(shocks: Mapping[str, float], elasticities=ELASTICITIES) -> float:
    """Sum of elasticity x shock (unknown factors contribute 0), in factor order."""
    z = 0.0
    for k, v in shocks.items():
        if k != "sector_multipliers":
            z = z + elasticities.get(k, 0.0) * float(v)
    return z


def scenarios_frame(spark: SparkSession, scenarios: Sequence[Mapping] = SCENARIOS,
                    elasticities=ELASTICITIES) -> DataFrame:
    """(scenario, ord, shift, multipliers map) — one row per scenario (literal size)."""
    rows = [(s["name"], i, scenario_shift(s["shocks"], elasticities),
             {k: float(v) for k, v in (s.get("sector_multipliers") or {}).items()})
            for i, s in enumerate(scenarios)]
    schema = T.StructType([
        T.StructField("scenario", T.StringType()), T.StructField("ord", T.IntegerType()),
        T.StructField("shift", T.DoubleType()),
        T.StructField("multipliers", T.MapType(T.StringType(), T.DoubleType()))])
    return spark.createDataFrame(rows, schema)


def scenarios_from_tables(shocks: DataFrame, multipliers: DataFrame | None = None,
                          elasticities=ELASTICITIES) -> DataFrame:
    """The scenario table from (scenario, factor, shock) and (scenario, sector, multiplier) rows.

    Unknown factors contribute 0; scenarios are numbered by name.
    """
    weight = F.coalesce(lookup("factor", elasticities), F.lit(0.0))
    found = shocks.groupBy("scenario").agg(F.sum(weight * F.col("shock")).alias("shift"))
    if multipliers is None:
        found = found.withColumn("multipliers", F.create_map().cast("map<string,double>"))
    else:
        pairs = multipliers.groupBy("scenario").agg(F.map_from_entries(F.collect_set(F.struct(
            "sector", F.col("multiplier").cast("double")))).alias("multipliers"))
        found = found.join(pairs, "scenario", "left").withColumn(
            "multipliers", F.coalesce("multipliers", F.create_map().cast("map<string,double>")))
    order = Window.orderBy("scenario")  # a handful of rows
    return found.select("scenario", (F.row_number().over(order) - 1).alias("ord"), "shift", "multipliers")


def stress_pd(portfolio: DataFrame, scenarios: DataFrame, sector_beta=SECTOR_BETA,
              grade_beta=GRADE_BETA, pd_cap: float = 0.5) -> DataFrame:
    """Portfolio x scenarios with the stressed PD:
    inv_logit(logit(pd) + shift + beta_sector + beta_grade) x sector multiplier,
    clipped to [1e-6, pd_cap]."""
    x = portfolio.crossJoin(F.broadcast(scenarios))  # join_scenario_cross
    z = (logit("pd_baseline") + F.col("shift") + lookup("sector", sector_beta, 0.0)
         + lookup("grade", grade_beta, 0.0))
    mult = F.coalesce(F.col("multipliers")[F.col("sector")], F.lit(1.0))
    return x.withColumn("pd_stress", clip(inv_logit(z) * mult, 1e-6, pd_cap)).drop("multipliers", "shift")


def stress_impacts(df: DataFrame, provision_coverage: float = 1.0, capital_alpha: float = 0.08) -> DataFrame:
    p, ead, lgd = F.col("pd_stress"), F.col("ead"), F.col("lgd")
    el = p * lgd * ead
    return df.select(
        "*", (p * ead).alias("npl_proxy"), el.alias("el"), (F.lit(provision_coverage) * el).alias("provision"),
        (F.lit(capital_alpha) * ead * F.sqrt(clip(p * lgd, 0.0, 1.0))).alias("capital"),
        (F.col("apr") * ead * (F.lit(1.0) - p) - el).alias("credit_income"))


def stress_aggregate(impacts: DataFrame) -> DataFrame:
    """Sums overall / by sector / by grade per scenario.

    Rows are summed once to (scenario, sector, grade); the grouping sets expand
    that small table only.
    """
    small = impacts.groupBy("scenario", "sector", "grade").agg(*[F.sum(m).alias(m) for m in MEASURES])
    level = (F.when(F.grouping("sector") == 0, "sector").when(F.grouping("grade") == 0, "grade")
             .otherwise("overall").alias("level"))
    sets = [["scenario"], ["scenario", "sector"], ["scenario", "grade"]]
    sums = small.groupingSets(sets, "scenario", "sector", "grade").agg(*[F.sum(m).alias(m) for m in MEASURES], level)
    return sums.select("scenario", *MEASURES, "level", F.coalesce("sector", "grade", F.lit("all")).alias("key"))


def stress_delta(agg: DataFrame, base: str = "Base") -> DataFrame:
    """Deltas against the Base rows on (level, key); Base rows keep NULL deltas."""
    b = agg.filter(F.col("scenario") == base).select(
        "level", "key", *[F.col(m).alias(f"_b_{m}") for m in DELTA_MEASURES])
    j = agg.join(F.broadcast(b), ["level", "key"], "left")  # one row a sector and grade
    is_base = F.col("scenario") == base
    return j.select("scenario", *MEASURES, "level", "key", *[
        F.when(~is_base, F.col(m) - F.col(f"_b_{m}")).alias(f"delta_{m}") for m in DELTA_MEASURES])


def stress_test(portfolio: DataFrame, scenarios: Sequence[Mapping] | DataFrame = SCENARIOS,
                provision_coverage: float = 1.0, capital_alpha: float = 0.08) -> DataFrame:
    """All scenarios, given as a list or as a scenario table, end to end."""
    sc = scenarios if isinstance(scenarios, DataFrame) else scenarios_frame(portfolio.sparkSession, scenarios)
    imp = stress_impacts(stress_pd(portfolio, sc), provision_coverage, capital_alpha)
    return stress_delta(stress_aggregate(imp))


def stress_summary(results: DataFrame) -> DataFrame:
    """Overall rows in millions, ordered by scenario name."""
    o = results.filter((F.col("level") == "overall") & (F.col("key") == "all"))
    return o.select("scenario", (F.col("npl_proxy") / 1e6).alias("npl_m"),
                    (F.coalesce(F.col("delta_npl_proxy"), F.lit(0.0)) / 1e6).alias("delta_npl_m"),
                    (F.col("provision") / 1e6).alias("provision_m")).orderBy("scenario")
