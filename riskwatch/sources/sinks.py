"""Sinks: table writes, scored partitions, JSON report, and the re-runnable
append-safe upsert.

An upsert table is a folder of data folders and manifests. A write puts its rows into a
new data folder, which no reader looks at, and then commits: it renames the whole manifest of the
next version, which lists every data folder of the table, into place. A rename to a name that must
not exist yet is the only shared step, so of two writers that started from one version one
commits and the other starts again from the new version (or raises, if it named the version that it
expects). Readers take the highest manifest that is whole. A write that failed at
any point leaves the table as it was and later writes free to go on.

With ``partition_by`` a write only reads and rewrites the partitions that its rows
belong to, and the manifest carries the other partitions' folders over, so all of them
change at once. A re-run with the same batch gives the same content, and a changed value
replaces the old one (last batch wins, and inside a batch the highest ``sequence``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS, DATA = "_versions", "data"
ATTEMPTS = 8


class StaleVersion(RuntimeError):
    """The table is not at the version that the writer expected."""


@dataclass
class Manifest:
    """One version of a table: its data folders by partition value ("" without partitions), and its columns."""

    version: int
    fmt: str
    schema: str
    partition_by: str | None = None
    folders: dict[str, str] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole file in place under a name that is not there yet; False if it is."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, target = _fs(spark, path)
    _, aside = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(aside, target, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError:
        fs.delete(aside, False)
        if fs.exists(target):
            return False
        raise
    return True


def _attempted(spark: SparkSession, base: str) -> list[int]:
    fs, p = _fs(spark, f"{base.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, base: str) -> Manifest | None:
    """The newest version whose manifest is whole."""
    for n in reversed(_attempted(spark, base)):
        try:
            found = json.loads(_read_text(spark, f"{base.rstrip('/')}/{MANIFESTS}/{n:010d}.json"))
            return Manifest(**found)
        except (ValueError, TypeError):  # not a whole manifest: not committed
            continue
    return None


def list_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the committed versions."""
    out = []
    for n in _attempted(spark, base):
        try:
            out.append(json.loads(_read_text(spark, f"{base.rstrip('/')}/{MANIFESTS}/{n:010d}.json"))["version"])
        except (ValueError, TypeError, KeyError):
            continue
    return out


def _read(spark: SparkSession, base: str, m: Manifest, values: Sequence[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(m.schema))
    folders = [f for v, f in sorted(m.folders.items()) if values is None or v in set(values)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.format(m.fmt).schema(schema).load([f"{base.rstrip('/')}/{f}" for f in folders])


def read_latest(spark: SparkSession, base: str, partitions: Sequence | None = None) -> DataFrame | None:
    """The rows of the newest version, of some partitions only if these are given; None before the first commit."""
    m = latest(spark, base)
    return None if m is None else _read(spark, base, m, None if partitions is None else [str(v) for v in partitions])


def union_history(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old rows then new rows (``_batch`` 0 / 1), columns aligned by name."""
    n = new.withColumn("_batch", F.lit(1))
    if old is None:
        return n
    return old.withColumn("_batch", F.lit(0)).unionByName(n, allowMissingColumns=True)


def upsert_frames(old: DataFrame | None, new: DataFrame, keys: Sequence[str],
                  sequence: str | None = None) -> DataFrame:
    """Keep the last row per key across old + new (new wins) — a ``max_by``
    aggregate, not a window, so one hot key is still combined map-side.

    "Last" is by batch, then by the ``sequence`` column, then by the other values,
    so rows of one key in one batch have one winner whatever their order of arrival.
    """
    u = union_history(old, new)
    keys = list(keys)
    others = [c for c in u.columns if c not in keys and c != "_batch"]
    order = ["_batch", *([sequence] if sequence else []), *[c for c in others if c != sequence]]
    return (u.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r"))
            .select(*keys, "_r.*"))


def _write_data(df: DataFrame, base: str, fmt: str, partition_by: str | None) -> dict[str, str]:
    """Write rows to a new data folder; partition value -> folder under ``base``."""
    folder = f"{DATA}/{uuid.uuid4().hex}"
    if partition_by is None:
        df.write.mode("errorifexists").format(fmt).save(f"{base}/{folder}")
        return {"": folder}
    value = F.coalesce(F.col(partition_by).cast("string"), F.lit(""))
    values = sorted(r.v for r in df.select(value.alias("v")).distinct().collect())  # one a folder to be
    numbers = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(values)], "_v string, _place int")
    rows = df.withColumn("_v", value).join(F.broadcast(numbers), "_v").drop("_v")
    rows.write.mode("errorifexists").partitionBy("_place").format(fmt).save(f"{base}/{folder}")
    return {v: f"{folder}/_place={i}" for i, v in enumerate(values)}


def sink_upsert(new: DataFrame, base: str, keys: Sequence[str], fmt: str = "parquet", sequence: str | None = None,
                partition_by: str | None = None, expected: int | None = None,
                merge: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None) -> int:
    """Merge ``new`` into the table at ``base``; returns the version that this made.

    ``partition_by`` (one of the keys, such as the month; null and empty values share one partition) merges only the partitions
    that ``new`` has. ``merge`` (of old and new rows) takes the place of the last row of each key. ``expected`` is the version that the table must be at (-1: none yet), or ``StaleVersion`` is raised.
    """
    if partition_by is not None and partition_by not in keys:
        raise ValueError("partition_by must be one of the keys")
    spark, base = new.sparkSession, base.rstrip("/")
    for _ in range(ATTEMPTS):
        m = latest(spark, base)
        at = m.version if m else -1
        if expected is not None and at != expected:
            raise StaleVersion(f"the table is at version {at}, not {expected}")
        if m and (m.partition_by, m.fmt) != (partition_by, fmt):
            raise ValueError(f"the table is partitioned by {m.partition_by} in {m.fmt}")
        carried, old = {}, None
        if m and partition_by is None:
            old = _read(spark, base, m)
        elif m:
            touched = {"" if r.v is None else str(r.v) for r in new.select(F.col(partition_by).cast("string").alias("v")).distinct().collect()}
            carried = {v: f for v, f in m.folders.items() if v not in touched}
            old = _read(spark, base, m, sorted(touched))
        merged = merge(old, new) if merge else upsert_frames(old, new, keys, sequence)
        folders = _write_data(merged, base, fmt, partition_by)
        number = max(_attempted(spark, base), default=-1) + 1  # a manifest that is not whole keeps its number
        newer = latest(spark, base)
        if (newer.version if newer else -1) == at:
            done = Manifest(number, fmt, merged.schema.json(), partition_by, carried | folders)
            if _create(spark, f"{base}/{MANIFESTS}/{number:010d}.json", json.dumps(asdict(done))):
                return number
        if expected is not None:
            raise StaleVersion(f"another writer committed after version {at}")
    raise StaleVersion(f"{ATTEMPTS} other writers committed in turn")


def remove_unreferenced(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete data folders that none of the last ``keep`` versions lists; returns them. Not beside a running write."""
    base = base.rstrip("/")
    versions = list_versions(spark, base)[-keep:]
    used = set()
    for n in versions:
        m = Manifest(**json.loads(_read_text(spark, f"{base}/{MANIFESTS}/{n:010d}.json")))
        used |= set(m.folders.values())
    fs, p = _fs(spark, f"{base}/{DATA}")
    gone = []
    for st in fs.listStatus(p) if fs.exists(p) else []:
        parts = [st.getPath()] if f"{DATA}/{st.getPath().getName()}" in used else [
            x.getPath() for x in fs.listStatus(st.getPath()) if x.isDirectory()] or [st.getPath()]
        for path in parts:
            name = path.toString().split(f"/{DATA}/", 1)[1]
            if f"{DATA}/{name}" not in used:
                fs.delete(path, True)
                gone.append(f"{DATA}/{name}")
    return sorted(gone)


def sink_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def sink_scored(df: DataFrame, path: str, asof: str, thresholds: dict, fmt: str = "parquet") -> None:
    """Scored rows under ``asof=<date>`` (re-running a date replaces only that partition) plus the thresholds used as a
    1-row table."""
    spark = df.sparkSession
    (df.withColumn("asof", F.lit(asof)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("asof").format(fmt).save(path))
    thr = spark.createDataFrame([(asof, float(thresholds["red"]), float(thresholds["amber"]))],
                                "asof string, red double, amber double")
    thr.write.mode("overwrite").json(f"{path.rstrip('/')}_thresholds/asof={asof}")


def sink_report(report: DataFrame, path: str) -> None:
    """One-row nested report written as JSON (NULLs stay null)."""
    report.coalesce(1).write.mode("overwrite").json(path)
