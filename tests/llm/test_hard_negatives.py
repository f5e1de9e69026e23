"""Hard negatives against plain loops."""

import random

import numpy as np
import pytest

from riskwatch.llm import hard_negatives, queries


def plain(rows, positives=5, negatives=3, low=50, high=95):
    """rows: (id, label, vector or None, anchor)."""
    rows = [(k, *x) for k, x in enumerate(rows) if None not in x[:3] and None not in x[2]]
    out = []
    for k, name, label, vec, anchor in rows:
        if not anchor:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vec, v, strict=False)), i, n, other == label)
                        for n, i, other, v, _ in rows if n != k)
        for s, i, _, _ in [x for x in scored if x[3]][:positives]:
            inside = [x for x in scored if not x[3] and -low * s <= -100 * x[0] <= -high * s]
            out += [(name, i, r + 1, x[1], -s, -x[0]) for r, x in enumerate(inside[:negatives])]
    return sorted(out)


def test_strassen():
    rnd = np.random.default_rng(1)
    for _ in range(80):
        m, k, n = rnd.integers(1, 120, 3)
        a, b = rnd.integers(-10**8, 10**8, (m, k)), rnd.integers(-10**8, 10**8, (k, n))
        assert (hard_negatives.strassen(a, b) == a @ b).all()


def test_heaps_merge():
    rnd = np.random.default_rng(2)
    columns = [rnd.integers(0, 5, 400), rnd.integers(-3, 4, 400), rnd.integers(0, 9, 400), np.arange(400)]
    heap = hard_negatives.Heaps(6)
    for cut in np.array_split(np.arange(400), 7):
        heap.push(*(x[cut] for x in columns))
    want = [x for o in range(5) for x in sorted((o, -s, i, r) for ow, s, i, r in zip(*columns) if ow == o)[:6]]
    assert list(zip(heap.columns[0], -heap.columns[1], *heap.columns[2:])) == want


SCHEMA = "name long, kind int, v array<long>, first boolean, id string, row string, vec string, owner string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "r", "v", "o") for r in rows], SCHEMA).repartition(3)


def mined(spark, rows):
    found = hard_negatives.mine(frame(spark, rows), "name", "v", "kind", "first")
    return sorted(tuple(r) for r in found.collect())


def vectors(rnd, n, kinds):
    base = [[rnd.randint(-20, 20) for _ in range(9)] for _ in range(12)]
    return [(i, rnd.choice(kinds), [x + rnd.randint(-3, 3) for x in rnd.choice(base)], i % 5 == 0) for i in range(n)]


@pytest.mark.parametrize("sizes", [(16_384, 8_192), (9, 20)])
def test_mine_against_plain_loops(spark, monkeypatch, sizes):
    monkeypatch.setattr(hard_negatives, "ANCHORS", sizes[0])
    monkeypatch.setattr(hard_negatives, "CANDIDATES", sizes[1])
    rnd = random.Random(5)
    rows = vectors(rnd, 150, [0, 0, 0, 1, 2])
    rows += [(None, 0, [1] * 9, True), (900, None, [1] * 9, True), (905, 1, None, True), (910, 1, [1, None], True),
             (915, 1, [], True), (920, 2, [3, 4], True), (925, 7, [5] * 9, True), (930, 0, [2] * 9, None)]
    rows += [rows[3], rows[3], rows[10], *((i, 1, rows[7][2], False) for i in range(300, 340))]  # rows and vectors that repeat
    found = mined(spark, rows)
    assert found and found == plain(rows)


def test_mine_hot_label(spark, monkeypatch):
    """Half the rows share one vector and label: ties go by id."""
    monkeypatch.setattr(hard_negatives, "CANDIDATES", 50)
    rnd = random.Random(6)
    rows = vectors(rnd, 60, [0, 1]) + [(1000 + i, 0, [9, 9, 9, 0, 0, 0, 1, 2, 3], i < 2) for i in range(60)]
    assert mined(spark, rows) == plain(rows)


def test_mine_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 2, [3], False)]) == []
    with pytest.raises(OverflowError):
        mined(spark, [(1, 2, [1 << 40], True)])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = []
    for name, vec, label in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect():
        label = (label + 1) % 10 if name % 7 == 0 else label
        rows.append((name, label, [int(np.floor(256 * np.float64(x))) for x in vec], name % 50 == 0))
    found = queries.QUERIES["op12_hard_negatives"](spark, sf).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(map(tuple, found)) == plain(rows) and len(found) > 50
