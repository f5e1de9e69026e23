"""Session helpers: a local session for tests/bench and checkpoint-dir discovery."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "riskwatch") -> SparkSession:
    """Session for tests and the bench: UTC, AQE on, UI off, few shuffle partitions."""
    n = shuffle_partitions or (2 * os.cpu_count() if cores == "*" else 2 * int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The cluster setting always wins. Where it is unset, a private folder is made
    for a ``local`` master only, as in tests: driver and tasks are one process
    there. On a cluster without the setting this raises, since each executor
    would write its own disk and later reads would miss files.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="riskwatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def shared_path(spark: SparkSession, name: str = "table") -> str:
    """A new path in the shared folder; what is written there goes when the session ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskwatch-{name}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(conf).deleteOnExit(hadoop_path)
    return path


def materialize(df, name: str = "table"):
    """Cut lineage by writing ``df`` once as Parquet under the shared checkpoint
    folder (``spark.checkpoint.dir``) and reading it back.

    Used where one derived table feeds many branches of a plan (the panels
    feeding several builders, the feature table feeding the split sides,
    edges, counts and statistics): the subtree is computed exactly once (an
    RDD checkpoint would compute it twice unless cached), the copy survives
    executor loss, later plans stay small for the optimizer, and downstream
    scans get Parquet column pruning and filter pushdown.
    """
    path = shared_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that their Python workers can import it."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if sc.applicationId not in _shipped and (root / "riskwatch").is_dir():
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/riskwatch_core", "zip", root, "riskwatch"))
        _shipped.add(sc.applicationId)
