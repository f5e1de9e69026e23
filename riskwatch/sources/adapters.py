"""Driver tables (TPC-H-like star schema + events) viewed as the engine's inputs.

Each adapter is a lazy DataFrame over the whole driver tables (FIXTURES §2), so
every operator's work grows with the data. Column pruning and filters reach the
Parquet scans through Catalyst.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import io

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Market segment -> sector code used for the portfolio / stress views.
# HOUSEHOLD is left unmapped on purpose: it exercises the "Services" default.
SEGMENT_TO_SECTOR_CODE = {
    "AUTOMOBILE": "MFG",
    "BUILDING": "CON",
    "FURNITURE": "RET",
    "MACHINERY": "ENG",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan of the files that are there now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fin_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x quarter financials from lineitem / orders / customer.

    An order has few lines a quarter, so the eleven sums of an order are wider than the lines they are made of.
    Hence the needed columns of the lines move, once to their orders and once to their customers, and sums are made
    where all lines of a customer meet. What groups by customer next (windows, latest row, joins) needs no other exchange.
    """
    li = table(spark, sf_dir, "lineitem")

    def flag(c: str, value: str):
        return F.coalesce(F.col(c) == value, F.lit(False))

    lines = li.select(
        "l_orderkey", F.trunc(F.to_date("l_shipdate"), "quarter").alias("fq_date"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
        F.col("l_quantity").alias("quantity"), flag("l_returnflag", "R").alias("ret_r"),
        flag("l_returnflag", "A").alias("ret_a"), flag("l_linestatus", "O").alias("open"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    joined = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")
              .repartition("o_custkey").join(cust, F.col("o_custkey") == F.col("c_custkey")))
    price, disc, ret_r, ret_a, open_ = (F.col(c) for c in ("price", "disc", "ret_r", "ret_a", "open"))
    return (joined.groupBy(
        F.col("o_custkey").alias("customer_id"), "fq_date",
        F.col("c_mktsegment").alias("sector_code"),
        F.when(F.col("c_acctbal") >= 5000, "Corp").otherwise("SME").alias("size_bucket"))
        .agg(
            F.sum(price * (1 - disc)).alias("revenue"),
            F.sum(price * 0.6).alias("cogs"),
            F.sum(price * (F.lit(0.40) - disc)).alias("ebitda"),
            F.sum(price * (F.lit(0.35) - disc)).alias("ebit"),
            F.sum(price * F.col("tax")).alias("interest_expense"),
            F.sum(F.when(ret_r, 2 * price).otherwise(0.0)).alias("total_debt"),
            F.sum(F.when(open_, price).otherwise(0.0) + 100 * F.col("quantity")).alias("current_assets"),
            F.sum(F.when(ret_a, price).otherwise(0.0)).alias("current_liab"),
            F.sum(100 * F.col("quantity")).alias("inventory"),
            F.sum(F.when(open_, price).otherwise(0.0)).alias("ar"),
            F.sum(F.when(ret_a, 0.5 * price).otherwise(0.0)).alias("ap")))


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("customer_id"), F.to_date("ts").alias("date"),
                     "event_type", "value")


def credit_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x day credit usage from events (limit renamed ``credit_limit``)."""
    ev = _events_by_day(spark, sf_dir)
    limit = (F.lit(100) + F.lit(5) * (F.col("customer_id") % 20)).cast("double")
    agg = ev.groupBy("customer_id", "date").agg(
        F.sum("value").alias("utilized"),
        (F.lit(30) * F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)))
        .cast("long").alias("dpd_days"))
    return agg.select(
        "customer_id", "date", limit.alias("credit_limit"), "utilized",
        F.when(F.col("utilized") > limit, 1).otherwise(0).alias("breach_flag"), "dpd_days")


def cashflow_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    is_in = F.col("event_type").isin("purchase", "signup")
    return ev.groupBy("customer_id", "date").agg(
        F.sum(F.when(is_in, F.col("value")).otherwise(0.0)).alias("inflow"),
        F.sum(F.when(is_in, 0.0).otherwise(F.col("value"))).alias("outflow"))


def backtest_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x order-date scored cohort rows from orders / customer.

    ``pd_12m`` is computed in exact decimal arithmetic before the 3-place
    rounding (ties in rank metrics and deciles are intended).
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    price = F.col("o_totalprice")
    pd12 = F.round(price.cast("decimal(18,2)") * F.lit(0.0000004).cast("decimal(10,7)"), 3)
    hit = ((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729) % 1000) < (price / 500000 * 400)
    return j.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("as_of_date"),
        F.col("c_mktsegment").alias("sector"),
        F.substring("o_orderpriority", 1, 1).alias("grade"),
        pd12.cast("double").alias("pd_12m"),
        F.when(hit, 1).otherwise(0).alias("y_event_12m"),
        price.alias("ead"),
        ((F.lit(25) + F.col("c_nationkey") % 25).cast("double") / 100).alias("lgd"))


def portfolio_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (sector_code, baseline PD) for portfolio enrichment and stress."""
    c = table(spark, sf_dir, "customer")
    seg_map = F.create_map(*[F.lit(x) for kv in SEGMENT_TO_SECTOR_CODE.items() for x in kv])
    pd_b = F.least(F.greatest((F.lit(10000.0) - F.col("c_acctbal")) / 50000, F.lit(1e-6)),
                   F.lit(0.5))
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.coalesce(seg_map[F.col("c_mktsegment")], F.col("c_mktsegment")).alias("sector_code"),
        pd_b.alias("pd_baseline"))


@dataclass
class RawSet:
    """The five raw inputs of the feature build."""
    fin: DataFrame
    credit: DataFrame
    cashflow: DataFrame
    covenant: DataFrame
    labels: DataFrame | None


def load_raw_set(spark: SparkSession, base: str) -> RawSet:
    """The five raw tables under ``base`` (Parquet, else CSV) with their declared schemas; labels may be missing."""
    def one(name, schema):
        return io.read_table(spark, f"{base.rstrip('/')}/{name}", schema)

    try:
        labels = one("labels", io.LABELS)
    except FileNotFoundError:
        labels = None
    return RawSet(one("fin_quarterly", io.FIN_QUARTERLY), one("credit_daily", io.CREDIT_DAILY),
                  one("cashflow_daily", io.CASHFLOW_DAILY), one("covenant", io.COVENANT), labels)


RESULT_TABLES = ("metrics", "calibration", "sweep", "segments", "psi", "stress")


def load_results(spark: SparkSession, base: str, names=RESULT_TABLES) -> dict[str, DataFrame]:
    """The engine's own result tables that exist under ``base``, by name."""
    found = {}
    for name in names:
        try:
            found[name] = io.read_table(spark, f"{base.rstrip('/')}/{name}")
        except FileNotFoundError:
            continue
    return found
