"""Readers: Parquet-else-CSV, declared schemas, NaN -> NULL and nanosecond ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared input schemas (FIXTURES §1). ``limit`` is renamed ``credit_limit``.
FIN_QUARTERLY = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("fq_date", T.TimestampType(), False),
    T.StructField("sector_code", T.StringType()),
    T.StructField("size_bucket", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in (
        "revenue", "cogs", "ebitda", "ebit", "interest_expense", "total_debt",
        "current_assets", "current_liab", "inventory", "ar", "ap")],
])
CREDIT_DAILY = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("date", T.TimestampType(), False),
    T.StructField("credit_limit", T.DoubleType()),
    T.StructField("utilized", T.DoubleType()),
    T.StructField("breach_flag", T.IntegerType()),
    T.StructField("dpd_days", T.IntegerType()),
    T.StructField("product_type", T.StringType()),
])
CASHFLOW_DAILY = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("date", T.TimestampType(), False),
    T.StructField("inflow", T.DoubleType()),
    T.StructField("outflow", T.DoubleType()),
])
COVENANT = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("date", T.TimestampType(), False),
    T.StructField("covenant_name", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("actual", T.DoubleType()),
    T.StructField("breach_flag", T.IntegerType()),
])
LABELS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("asof_date", T.TimestampType()),
    T.StructField("event_h12m", T.IntegerType()),
])
BACKTEST_COHORTS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("as_of_date", T.TimestampType(), False),
    T.StructField("sector", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("pd_12m", T.DoubleType()),
    T.StructField("y_event_6m", T.IntegerType()),
    T.StructField("y_event_12m", T.IntegerType()),
    T.StructField("ead", T.DoubleType()),
    T.StructField("lgd", T.DoubleType()),
])

RENAMES = {"limit": "credit_limit", "%util_mean_60d": "util_mean_60d",
           "%util_p95_60d": "util_p95_60d"}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath)) and len(fs.globStatus(hpath)) > 0


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               rename: dict | None = None, clean_nan: bool = True) -> DataFrame:
    """Read ``path`` as Parquet, else CSV (header, ISO dates).

    A path without suffix tries ``.parquet`` then ``.csv`` like the reference's
    readers. Declared ``schema`` is applied to CSV and used to cast Parquet.
    """
    candidates = [path]
    if not (path.endswith(".parquet") or path.endswith(".csv") or path.endswith(".pq")):
        candidates = [path + ".parquet", path + ".csv", path]
    chosen = next((p for p in candidates if _exists(spark, p)), None)
    if chosen is None:
        raise FileNotFoundError(f"Not found: {' or '.join(candidates)}")
    if chosen.endswith(".csv"):
        reader = spark.read.option("header", True)
        df = reader.schema(schema).csv(chosen) if schema is not None else \
            reader.option("inferSchema", True).csv(chosen)
    else:
        df = spark.read.parquet(chosen)
    df = apply_renames(df, rename if rename is not None else RENAMES)
    if schema is not None and not chosen.endswith(".csv"):
        df = conform(df, schema)
    return nan_to_null(df) if clean_nan else df


def apply_renames(df: DataFrame, rename: dict) -> DataFrame:
    for old, new in rename.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns named in ``schema``; long nanosecond stamps become timestamps."""
    out = []
    types = dict(df.dtypes)
    for f in schema.fields:
        if f.name not in types:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType) and types[f.name] in ("bigint", "int"):
            c = nanos_to_timestamp(f.name)
        out.append(c.cast(f.dataType).alias(f.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*out, *extra)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """pandas NaN means missing: turn NaN into NULL in every float/double column."""
    targets = set(cols) if cols is not None else {
        n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[
        (F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")).alias(n) if n in targets
         else F.col(f"`{n}`")) for n in df.columns])


def nanos_to_timestamp(name: str):
    """Nanoseconds since epoch (read with ``nanosAsLong``) -> microsecond timestamp.

    Integer ``div`` keeps 23:59:59.999999999 on its own day; ``/`` would round
    through a double to the next midnight.
    """
    return F.expr(f"timestamp_micros(CAST(`{name}` AS BIGINT) div 1000)")


def read_nanos_parquet(spark: SparkSession, path: str, ts_cols: Sequence[str]) -> DataFrame:
    """Read pandas-written ``TIMESTAMP(NANOS)`` Parquet (rejected by default in Spark 4).

    Sets ``spark.sql.legacy.parquet.nanosAsLong`` for the session (the scan reads
    the setting when it runs, so it is left on) and converts the stamps.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    df = df.select(*[nanos_to_timestamp(n).alias(n) if n in ts_cols
                     else F.col(f"`{n}`") for n in df.columns])
    return nan_to_null(df)


def load_thresholds(spark: SparkSession, path: str) -> dict:
    """Absolute cutoffs from a JSON config ``{"absolute": {"thresholds": {"red", "amber"}}}``.

    Driver-side config (a few bytes); a file without absolute cutoffs is an error,
    as in the batch-scoring contract.
    """
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    parsed = spark.createDataFrame([(text,)], "j string").select(
        F.from_json("j", "absolute struct<thresholds: struct<red: double, amber: double>>").alias("c")
    ).first()["c"]
    if parsed is None or parsed["absolute"] is None or parsed["absolute"]["thresholds"] is None \
            or parsed["absolute"]["thresholds"]["red"] is None:
        raise ValueError("thresholds file has no absolute cutoffs")
    t = parsed["absolute"]["thresholds"]
    return {"red": float(t["red"]), "amber": float(t["amber"])}


def monitoring_cutoffs(thresholds: dict | None) -> dict:
    """Monitoring cutoffs: approval uses the *red* threshold as ``amber_max_pd``."""
    if not thresholds:
        return {"green_max_pd": 0.02, "amber_max_pd": 0.05, "red_min_pd": 0.05}
    return {"green_max_pd": thresholds.get("amber", 0.02), "amber_max_pd": thresholds.get("red", 0.05),
            "red_min_pd": thresholds.get("red", 0.05)}
