"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest

from riskwatch.llm import embedding_graph, queries


def plain(rows, threshold=0.98):
    """rows: (id, label, vector or None) -> sorted (id, n_links, component_id, kept)."""
    good = [i for i, (_, label, v) in enumerate(rows) if label is not None and v and None not in v
            and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i in range(len(rows))}
    for label, dim in {(rows[i][1], len(rows[i][2])) for i in good}:
        own = [i for i in good if (rows[i][1], len(rows[i][2])) == (label, dim)]
        v = np.array([rows[i][2] for i in own], np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(v @ v.T >= threshold), strict=True):
            if a != b:
                links[own[a]].add(own[b])
    out, seen = [], set()
    for i in range(len(rows)):
        if i in seen:
            continue
        reached, front = {i}, [i]
        while front:
            new = links[front.pop()] - reached
            reached |= new
            front += new
        seen |= reached
        least = min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)
        out += [(rows[j][0], len(links[j]), least, rows[j][0] == least) for j in reached]
    return sorted(out, key=str)


def groups(seed, n, sizes, dim=24, label=0):
    """Random vectors and groups of near copies."""
    rnd = np.random.default_rng(seed)
    vectors = list(rnd.normal(size=(n, dim)))
    for size in sizes:
        base = rnd.normal(size=dim)
        vectors += [base + 0.09 * rnd.normal(size=dim) * rnd.random() for _ in range(size)]
    return [(1000 * seed + i, label, x.astype(np.float32).tolist()) for i, x in enumerate(vectors)]


SCHEMA = "name long, label int, vec array<float>, node string, v string, copies long, id long"


def found(spark, rows):
    df = spark.createDataFrame([(*r, "n", "v", 3, 4) for r in rows], SCHEMA).repartition(3)
    out = embedding_graph.near_duplicates(df, "name", "vec", "label").collect()
    return sorted((tuple(r) for r in out), key=str)


def test_pruned_graph_is_searchable():
    rows = embedding_graph.unit(_lists(groups(3, 700, [2] * 40 + [60]))).astype(np.float32)
    lists = embedding_graph.pruned(rows, np.random.default_rng(0))
    edges = np.full((len(rows), max(map(len, lists))), -1)
    for i, x in enumerate(lists):
        assert i not in x and len(set(x.tolist())) == len(x) <= 2 * embedding_graph.DEGREE + 8 * embedding_graph.FAR
        edges[i, :len(x)] = x
    q, m = embedding_graph.search(rows, edges, rows, int((rows @ rows.sum(axis=0)).argmax()), 16, 0.98)
    got = set(zip(q.tolist(), m.tolist(), strict=True))
    want = set(zip(*(x.tolist() for x in np.nonzero(rows @ rows.T >= 0.98)), strict=True))
    assert len(got) == len(q) and got <= want and len(got) >= 0.99 * len(want)


def _lists(rows):
    import pyarrow as pa
    return pa.array([x[2] for x in rows])


def test_against_all_pairs(spark):
    rows = groups(1, 200, [2, 3, 40]) + groups(2, 90, [7], label=5)
    rows += [(9000, 0, rows[0][2]), (9001, 5, rows[0][2]), (9002, 0, [3 * x for x in rows[1][2]]), rows[2], rows[2]]
    rows += [(9010, None, rows[0][2]), (9011, 0, None), (9012, 0, [0.0] * 24), (9013, 0, [None] * 24), (9014, 0, []),
             (9015, 0, [float("nan")] * 24), (9016, 0, [float("inf")] * 24), (9017, 0, rows[0][2][:8]), (None, 0, rows[0][2]),
             (None, 7, rows[0][2])]
    assert found(spark, rows) == plain(rows)


def test_cells_parts_and_blocks(spark, monkeypatch):
    """Overlapping cells cut into parts and blocks, a third of the rows copies or near copies."""
    for name, value in (("CELL", 60), ("PART", 70), ("QUERIES", 90)):
        monkeypatch.setattr(embedding_graph, name, value)
    rows = groups(4, 400, [2] * 20 + [5] * 6 + [90])
    rows += [(50_000 + i, 0, rows[7][2]) for i in range(150)]
    want, got = plain(rows), found(spark, rows)
    assert sum(x[1] for x in got) >= 0.99 * sum(x[1] for x in want)
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.99 * len(want)


def test_nothing(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, 1, None)]) == [(3, 0, 3, True)]


def test_audit_counts_missing_links(spark):
    rows = groups(5, 30, [4, 4])
    nodes = spark.createDataFrame([(i, 1, label, len(v), v) for i, label, v in rows],
                                  "node long, copies long, label long, dim int, v array<float>")
    links = embedding_graph.find_links(nodes, 0.98, embedding_graph.Width())
    assert embedding_graph.audit(nodes, links, 0.98) == 1.0
    some = links.where("links is null or a % 2 = 0")
    assert 0 < embedding_graph.audit(nodes, some, 0.98) < 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = queries.QUERIES["op13_embedding_graph"](spark, sf).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
