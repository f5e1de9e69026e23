import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from riskwatch.operators.model import select_ids
from riskwatch.sources import sinks
from riskwatch.sources.sinks import read_latest, sink_table, sink_upsert
from riskwatch.streaming.upsert import upsert_stream


def test_versioned_upsert_rerun(spark):
    base = tempfile.mkdtemp(prefix="rw-upsert-")
    b1 = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    b2 = spark.createDataFrame([(2, 20.0), (3, 3.0)], "k int, v double")
    sink_upsert(b1, base, ["k"])
    sink_upsert(b2, base, ["k"])
    sink_upsert(b2, base, ["k"])          # re-run of the same batch: no growth
    got = sorted(map(tuple, read_latest(spark, base).collect()))
    assert got == [(1, 1.0), (2, 20.0), (3, 3.0)]


def test_stream_feeds_upsert(spark):
    src = tempfile.mkdtemp(prefix="rw-src-")
    out = tempfile.mkdtemp(prefix="rw-out-")
    ckpt = tempfile.mkdtemp(prefix="rw-ck-")
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double").write.mode("append").parquet(src)
    stream = spark.readStream.schema("k int, v double").parquet(src)
    q = upsert_stream(stream, out, ["k"], ckpt, transform=lambda d: d.withColumn("v", F.col("v") * 10))
    q.awaitTermination(120)
    got = sorted(map(tuple, read_latest(spark, out).collect()))
    assert got == [(1, 10.0), (2, 20.0)]


def test_load_thresholds(spark):
    import json
    import os
    import pytest
    from riskwatch.sources.io import load_thresholds
    d = tempfile.mkdtemp(prefix="rw-thr-")
    good, bad = os.path.join(d, "good.json"), os.path.join(d, "bad.json")
    with open(good, "w") as f:
        json.dump({"absolute": {"thresholds": {"red": 0.2, "amber": 0.05}}}, f)
    with open(bad, "w") as f:
        json.dump({"thresholds": {"red": 0.16, "amber": 0.03}}, f)
    assert load_thresholds(spark, good) == {"red": 0.2, "amber": 0.05}
    with pytest.raises(ValueError):
        load_thresholds(spark, bad)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_failed_write_changes_nothing(spark, monkeypatch):
    """Neither data without a manifest nor half a manifest is seen, and later writes go on."""
    base = tempfile.mkdtemp() + "/t"
    good = spark.createDataFrame([(1, 1.0)], "k int, v double")
    assert read_latest(spark, base) is None
    assert sink_upsert(good, base, ["k"]) == 0

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "_create", fail)  # the data is there, the commit is not
        with pytest.raises(OSError):
            sink_upsert(spark.createDataFrame([(1, 5.0), (2, 2.0)], "k int, v double"), base, ["k"])
    assert rows(read_latest(spark, base)) == [(1, 1.0)]
    with open(f"{base}/{sinks.MANIFESTS}/{1:010d}.json", "w") as f:
        f.write('{"version": 1, "fm')
    assert rows(read_latest(spark, base)) == [(1, 1.0)] and sinks.list_versions(spark, base) == [0]
    assert sink_upsert(spark.createDataFrame([(2, 7.0)], "k int, v double"), base, ["k"]) == 2
    assert rows(read_latest(spark, base)) == [(1, 1.0), (2, 7.0)]
    assert len(sinks.remove_unreferenced(spark, base, keep=1)) == 2
    assert rows(read_latest(spark, base)) == [(1, 1.0), (2, 7.0)] and len(os.listdir(f"{base}/{sinks.DATA}")) == 1


def test_two_writers(spark, monkeypatch):
    """Of two writers from one version one commits; the other merges into what it committed."""
    base = tempfile.mkdtemp() + "/t"
    sink_upsert(spark.createDataFrame([(0, 0.0)], "k int, v double"), base, ["k"])
    write, turns = sinks._write_data, iter([True, False, False])

    def slow(*args):
        out = write(*args)
        if next(turns):  # another writer commits between this one's read and its commit
            sink_upsert(spark.createDataFrame([(2, 2.0)], "k int, v double"), base, ["k"])
        return out

    monkeypatch.setattr(sinks, "_write_data", slow)
    assert sink_upsert(spark.createDataFrame([(1, 1.0)], "k int, v double"), base, ["k"]) == 2
    assert rows(read_latest(spark, base)) == [(0, 0.0), (1, 1.0), (2, 2.0)]
    monkeypatch.undo()
    with pytest.raises(sinks.StaleVersion):
        sink_upsert(spark.createDataFrame([(1, 1.0)], "k int, v double"), base, ["k"], expected=1)
    assert sink_upsert(spark.createDataFrame([(1, 3.0)], "k int, v double"), base, ["k"], expected=2) == 3
    assert not sinks._create(spark, f"{base}/{sinks.MANIFESTS}/{3:010d}.json", "x") and sinks.latest(spark, base).version == 3


def test_writers_side_by_side(spark):
    base = tempfile.mkdtemp() + "/t"
    frames = [spark.createDataFrame([("m%d" % (i % 2), i, float(i))], "m string, k int, v double") for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda f: sink_upsert(f, base, ["m", "k"], partition_by="m"), frames))
    assert sorted(versions) == [0, 1, 2, 3]
    assert rows(read_latest(spark, base)) == sorted(("m%d" % (i % 2), i, float(i)) for i in range(4))


def test_a_null_partition_and_another_layout(spark):
    base = tempfile.mkdtemp() + "/t"
    schema = "m date, k int, v double"
    sink_upsert(spark.createDataFrame([(None, 1, 1.0)], schema), base, ["m", "k"], partition_by="m")
    sink_upsert(spark.createDataFrame([(None, 1, 2.0)], schema), base, ["m", "k"], partition_by="m")
    assert rows(read_latest(spark, base)) == [(None, 1, 2.0)]
    with pytest.raises(ValueError):
        sink_upsert(spark.createDataFrame([(None, 1, 2.0)], schema), base, ["m", "k"])


def test_sink_table_and_ids(spark):
    path = tempfile.mkdtemp() + "/t"
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "customer_id int, sector_code string, x double")
    for _ in range(2):
        sink_table(df, path, partition_by=["sector_code"])
    assert rows(spark.read.parquet(path).select(*df.columns)) == rows(df) and "sector_code=a" in os.listdir(path)
    assert select_ids(df) == ["customer_id", "sector_code"]
