"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors are nodes, equal vectors of one label one node. The nodes of a label are cut
into cells around centroids; a node is at home in its ``HOMES`` nearest cells, so that
cells overlap. A cell of many nodes is cut further into parts of a bounded size by a
hash. In each part, every node gets its nearest nodes as candidates, and robust pruning keeps
a candidate unless one kept before is closer to it, by a factor of ``ALPHA``, than the node
itself is. A few more edges lead to nodes drawn at random, as a group of near copies would have no
edges but its own. Edges run both ways. The adjacency lists that a node has from its cells are
united to one flat graph.

A search takes a node as a query to its ``PROBES`` nearest cells. In each part it
starts at the medoid, goes greedily along the edges with a beam of candidates, and
then expands every node in range until no edge leads to another one. What it finds
is verified in double precision. A pair counts in the first of the found node's
homes that the query probes, so that it counts once. A task gives back the number of links of each
query and a spanning forest, never pairs; the forests' components are the classes.

The search is audited: the links of ``AUDIT`` nodes, of the smallest hashes, are counted
by brute force over all nodes, and cells, probes and beam are doubled as long as less than
``RECALL`` of them is found.

Bounds: centroids are fitted on at most ``SAMPLE`` nodes and are at most ``CENTROIDS``;
beyond that, cells have more parts. A task holds one part and a block of queries. Nodes
that are all near each other are linked pair by pair, as every one's number of links is
asked for, but part by part and without giving pairs out.

Defined results: rows whose label or vector is null, or whose vector is zero, empty or
has a null or a component that is not finite, link with nothing and are their own class. Vectors
of different lengths don't link. Equal rows are links of each other. A null id is never
a class's smallest id while it has another one. Other columns are left out. An empty
table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, map_arrow, ship
from .components import components

SAMPLE, CENTROIDS, CELL = 65_536, 16_384, 512
PART, QUERIES = 2_048, 4_096
NEAREST, DEGREE, FAR, ALPHA = 64, 24, 8, 1.2
AUDIT, RECALL, ROUNDS = 512, 0.99, 4
SLACK = 1e-4  # of single precision in the search, before the check in double precision


@dataclass(frozen=True)
class Width:
    homes: int = 2
    probes: int = 4
    beam: int = 24

    def doubled(self) -> Width:
        return Width(2 * self.homes, 2 * self.probes, 2 * self.beam)


def unit(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of length one in double precision, of vectors of one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square overflows
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


# ---- the graph of a part -----------------------------------------------------------------------------------------

def pruned(rows: np.ndarray, rnd: np.random.Generator) -> list[np.ndarray]:
    """The neighbours of each row: its nearest rows after robust pruning, a few drawn ones, and the rows it is one of."""
    n = len(rows)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    near = rows @ rows.T
    np.fill_diagonal(near, -np.inf)
    k = min(NEAREST, n - 1)
    closest = np.argpartition(-near, k - 1, axis=1)[:, :k]
    likeness = np.take_along_axis(near, closest, axis=1)
    open_ = np.ones_like(closest, bool)
    source, target = [], []
    np.fill_diagonal(near, 1)
    for _ in range(DEGREE):
        left = np.flatnonzero(open_.any(axis=1))
        if not len(left):
            break
        best = np.where(open_[left], likeness[left], -np.inf).argmax(axis=1)
        chosen = closest[left, best]
        source.append(left)
        target.append(chosen)
        between = near[chosen[:, None], closest[left]]
        open_[left] &= ALPHA * (1 - between) > 1 - likeness[left]
        open_[left, best] = False
    source, target = np.concatenate(source), np.concatenate(target)
    # of the edges that come in, the closest ones
    order = np.lexsort((-near[source, target], target))
    place = np.arange(len(order)) - np.searchsorted(target[order], target[order])
    back = order[place < DEGREE]
    far, to = np.repeat(np.arange(n), FAR), rnd.integers(0, n, n * FAR)
    far, to = far[far != to], to[far != to]
    pairs = np.unique(np.concatenate([source * n + target, target[back] * n + source[back], far * n + to, to * n + far]))
    return np.split(pairs % n, np.searchsorted(pairs, np.arange(1, n) * n))


def search(rows: np.ndarray, edges: np.ndarray, queries: np.ndarray, start: int, beam: int,
           reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs of at least this likeness that a greedy search from ``start`` and the range around what it
    finds lead to. ``edges`` has the neighbours of each row, filled up with -1."""
    n, size = len(queries), beam
    seen, opened = np.zeros((n, len(rows)), bool), np.zeros((n, len(rows)), bool)
    at = np.full((n, size), -1)
    near = np.full((n, size), -np.inf, rows.dtype)
    at[:, 0], near[:, 0] = start, queries @ rows[start]
    seen[:, start] = True
    first = np.flatnonzero(near[:, 0] >= reach)
    hits = [(first, np.full(len(first), start))]
    live = np.arange(n)
    while len(live):
        ids, likeness = at[live], near[live]
        closed = (ids < 0) | opened[live[:, None], ids]
        best = np.where(closed, -np.inf, likeness).argmax(axis=1)
        go = ~closed[np.arange(len(live)), best]
        live, ids, likeness, best = live[go], ids[go], likeness[go], best[go]
        if not len(live):
            break
        node = ids[np.arange(len(live)), best]
        opened[live, node] = True
        to = edges[node]
        new = (to >= 0) & ~seen[live[:, None], to]
        q, slot = np.nonzero(new)
        found = to[q, slot]
        seen[live[q], found] = True
        score = np.full(to.shape, -np.inf, rows.dtype)
        score[q, slot] = np.einsum("ij,ij->i", queries[live[q]], rows[found])
        hit = score[q, slot] >= reach
        hits.append((live[q[hit]], found[hit]))
        ids, likeness = np.concatenate([ids, to], axis=1), np.concatenate([likeness, score], axis=1)
        top = np.argpartition(-likeness, size - 1, axis=1)[:, :size]
        at[live] = np.where(np.isneginf(np.take_along_axis(likeness, top, axis=1)), -1, np.take_along_axis(ids, top, axis=1))
        near[live] = np.take_along_axis(likeness, top, axis=1)
    query, row = (np.concatenate(x) for x in zip(*hits, strict=True))
    front = ~opened[query, row]
    fq, fr = query[front], row[front]
    out = [(query, row)]
    while len(fq):
        opened[fq, fr] = True
        to = edges[fr]
        owner = np.broadcast_to(fq[:, None], to.shape)
        new = (to >= 0) & ~seen[owner, to]
        pair = np.unique(owner[new] * np.int64(len(rows)) + to[new])
        fq, fr = pair // len(rows), pair % len(rows)
        seen[fq, fr] = True
        hit = np.einsum("ij,ij->i", queries[fq], rows[fr]) >= reach
        fq, fr = fq[hit], fr[hit]
        out.append((fq, fr))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]: the smallest index of each class."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]
    return label


# ---- cells -------------------------------------------------------------------------------------------------------

def _fit(rows: np.ndarray, count: int) -> np.ndarray:
    """Centroids of a sample, by three rounds of spherical k-means from evenly drawn rows."""
    centre = rows[np.linspace(0, len(rows) - 1, count).astype(np.int64)]
    for _ in range(3):
        of = np.concatenate([(rows[i:i + 4096] @ centre.T).argmax(axis=1) for i in range(0, len(rows), 4096)])
        sums = np.zeros_like(centre)
        np.add.at(sums, of, rows)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centre = np.where(length > 0, sums / np.maximum(length, 1e-30), centre)
    return centre


def centroids(nodes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Centroids of each (label, length) of more nodes than a cell holds; at most ``CENTROIDS`` in all."""
    cell = max(CELL, -(-nodes.count() // CENTROIDS))
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    large = {(r.label, r.dim): r.n for r in sizes.collect()}  # at most CENTROIDS rows
    if not large:
        return {}
    chosen = nodes.sparkSession.createDataFrame(list(large), "label long, dim int")
    sample = (nodes.join(F.broadcast(chosen), ["label", "dim"]).orderBy(F.xxhash64("node"), "node").limit(SAMPLE)
              .select("label", "dim", F.col("v").cast("array<float>").alias("v")).toArrow())
    out = {}
    label, dim = (sample.column(x).to_numpy() for x in ("label", "dim"))
    for key, n in large.items():
        own = np.flatnonzero((label == key[0]) & (dim == key[1]))
        count = min(-(-n // cell), max(1, len(own) // 4))
        if count > 1:
            out[key] = _fit(unit(sample.column("v").take(pa.array(own))), count)
    return out


def _assign(centre: dict[tuple[int, int], np.ndarray], width: Width):
    """Each node's nearest cells, the nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = (batch.column(x).to_numpy() for x in ("label", "dim"))
            probes = [[0]] * batch.num_rows
            for key in set(zip(label.tolist(), dim.tolist(), strict=True)) & centre.keys():
                own = np.flatnonzero((label == key[0]) & (dim == key[1]))
                near = unit(batch.column("v").take(pa.array(own))) @ centre[key].T
                order = np.argsort(-near, axis=1, kind="stable")[:, :width.probes].tolist()
                for i, cells in zip(own.tolist(), order, strict=True):
                    probes[i] = cells
            homes = [x[:width.homes] for x in probes]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("node", "copies", "label", "dim", "v")), pa.array(homes, pa.list_(pa.int32())),
                 pa.array(probes, pa.list_(pa.int32()))], ["node", "copies", "label", "dim", "v", "homes", "probes"])
    return run


# ---- tasks of a part ---------------------------------------------------------------------------------------------

def _build(table: pa.Table) -> pa.Table:
    """The adjacency list of each node of a part."""
    table = table.sort_by("node")
    node = table.column("node").to_numpy()
    rows = unit(table.column("v")).astype(np.float32)
    lists = pruned(rows, np.random.default_rng(len(node)))
    return pa.table({"node": node, "edges": pa.array([node[x] for x in lists], pa.list_(pa.int64()))})


def _links(beam: int, threshold: float):
    """The links of a block of queries to the nodes of a part: their number by query, and a forest of edges a, b."""
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if not members.num_rows or not queries.num_rows:
            return empty
        members = members.sort_by("node")
        cell = members.column("cell")[0].as_py()
        node, copies, asked = members.column("node").to_numpy(), members.column("copies").to_numpy(), queries.column("node").to_numpy()
        exact, exact_q = unit(members.column("v")), unit(queries.column("v"))
        rows, q_rows = exact.astype(np.float32), exact_q.astype(np.float32)
        # places of neighbours that are in this part
        lists = members.column("edges").combine_chunks()
        ends, flat = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(node)), np.diff(ends))
        flat = flat[ends[0]:ends[-1]]
        place = np.minimum(np.searchsorted(node, flat), len(node) - 1)
        here = node[place] == flat
        owner, place = owner[here], place[here]
        slot = np.arange(len(owner)) - np.searchsorted(owner, owner)
        edges = np.full((len(node), int(slot.max(initial=0)) + 1), -1)
        edges[owner, slot] = place
        medoid = int((rows @ rows.sum(axis=0)).argmax())
        # the cell in which a pair counts: the first of the found node's homes that the query probes
        earlier = [x[:x.index(cell)] for x in members.column("homes").to_pylist()]
        probes = queries.column("probes").to_pylist()
        all_nodes = np.unique(np.concatenate([node, asked]))
        label = np.arange(len(all_nodes))
        as_member, as_query = np.searchsorted(all_nodes, node), np.searchsorted(all_nodes, asked)
        total = np.zeros(len(asked), np.int64)
        n_cells = 1 + max(max(x) for x in probes)
        for start in range(0, len(asked), 256):
            part = slice(start, start + 256)
            q, m = search(rows, edges, q_rows[part], medoid, beam, threshold - SLACK)
            q += start
            real = (asked[q] != node[m]) & (np.einsum("ij,ij->i", exact_q[q], exact[m]) >= threshold)
            q, m = q[real], m[real]
            if not len(q):
                continue
            label = unite(label, as_query[q], as_member[m])
            probed = np.zeros((256, n_cells), bool)
            for i, cells in enumerate(probes[part]):
                probed[i, cells] = True
            first = np.ones(len(q), bool)
            for depth in range(max(map(len, earlier))):
                before = np.array([x[depth] if len(x) > depth else -1 for x in earlier])[m]
                first &= ~((before >= 0) & (before < n_cells) & probed[q - start, np.clip(before, 0, n_cells - 1)])
            np.add.at(total, q[first], copies[m[first]])
        linked, other = np.flatnonzero(total), np.flatnonzero(label != np.arange(len(label)))
        counts = pa.table({"a": asked[linked], "b": pa.nulls(len(linked), pa.int64()), "links": total[linked]})
        forest = pa.table({"a": all_nodes[other], "b": all_nodes[label[other]], "links": pa.nulls(len(other), pa.int64())})
        return pa.concat_tables([counts, forest])
    return run


def find_links(nodes: DataFrame, threshold: float, width: Width) -> DataFrame:
    """From nodes (node, copies, label, dim, v): rows (a, null, links) and edges (a, b, null)."""
    spark = nodes.sparkSession
    ship(spark)
    assigned = map_arrow(nodes, _assign(centroids(nodes), width), "node long, copies long, label long, dim int, "
                         f"v {nodes.schema['v'].dataType.simpleString()}, homes array<int>, probes array<int>")
    assigned = materialize(assigned, "cells")
    key = ["label", "dim", "cell"]
    at_home = assigned.withColumn("cell", F.explode("homes"))
    asking = assigned.withColumn("cell", F.explode("probes"))
    tiles = (at_home.select(*key, F.lit(1).alias("h"), F.lit(0).alias("q")).union(asking.select(*key, F.lit(0), F.lit(1)))
             .groupBy(*key).agg(F.ceil(F.sum("h") / PART).cast("int").alias("parts"),
                                F.ceil(F.sum("q") / QUERIES).cast("int").alias("blocks")))
    tiles = materialize(tiles, "tiles")
    own_part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    members = at_home.join(tiles, key).withColumn("part", own_part)
    graph = members.select(*key, "part", "node", "v").groupBy(*key, "part").applyInArrow(_build, "node long, edges array<long>")
    graph = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))  # a list a home
    graph = materialize(graph, "graph")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = (members.join(graph, "node").withColumn("block", every("blocks"))
               .select(*key, "part", "block", "node", "copies", "v", "homes", "edges"))
    block = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int")
    queries = (asking.join(tiles, key).withColumn("part", every("parts"))
               .select(*key, "part", block.alias("block"), "node", "v", "probes"))
    queries = queries.toDF(*queries.columns)  # both sides come from one table: columns of their own
    found = (members.groupBy(*key, "part", "block").cogroup(queries.groupBy(*key, "part", "block"))
             .applyInArrow(_links(width.beam, threshold), "a long, b long, links long"))
    return materialize(found, "links")


# ---- audit -------------------------------------------------------------------------------------------------------

def _count_links(asked: list[tuple[int, int, int, list[float]]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([x[0] for x in asked])
        total = np.zeros(len(asked), np.int64)
        kinds: dict[tuple[int, int], list[int]] = {}
        for i, (_, label, dim, _) in enumerate(asked):
            kinds.setdefault((label, dim), []).append(i)
        rows = {k: unit(pa.array([asked[i][3] for i in own])) for k, own in kinds.items()}
        for batch in batches:
            node, copies, label, dim = (batch.column(x).to_numpy() for x in ("node", "copies", "label", "dim"))
            for k, own in kinds.items():
                there = np.flatnonzero((label == k[0]) & (dim == k[1]))
                if len(there):
                    near = rows[k] @ unit(batch.column("v").take(pa.array(there))).T >= threshold
                    total[own] += (near & (names[own][:, None] != node[there])) @ copies[there]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], ["a", "links"])
    return run


def audit(nodes: DataFrame, links: DataFrame, threshold: float) -> float:
    """The share of the links of some nodes that were found; 1.0 if they have none."""
    asked = [tuple(r) for r in nodes.orderBy(F.xxhash64("node"), "node").limit(AUDIT).select("node", "label", "dim", "v").collect()]
    if not asked:
        return 1.0
    true = map_arrow(nodes, _count_links(asked, threshold), "a long, links long").groupBy("a").agg(F.sum("links").alias("true"))
    found = links.where("links is not null").groupBy("a").agg(F.sum("links").alias("found"))
    n_true, n_found = true.join(found, "a", "left").agg(F.sum("true"), F.sum("found")).first()
    return (n_found or 0) / n_true if n_true else 1.0


# ---- the operator ------------------------------------------------------------------------------------------------

def near_duplicates(df: DataFrame, id_col: str, vector_col: str, label_col: str, threshold: float = 0.98) -> DataFrame:
    """id, n_links (other rows linked directly), component_id (the smallest id that links reach) and kept: whether this
    is the row's own id. Ids and labels are integers."""
    rows = df.select(col(id_col).alias("id"), col(label_col).cast("long").alias("label"), col(vector_col).alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0)
    rows = materialize(rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
                       .withColumn("node", F.monotonically_increasing_id()), "vectors")
    nodes = rows.where("usable").groupBy("label", "v").agg(F.min("node").alias("node"), F.count("*").alias("copies"),
                                                         F.min("id").alias("least"))
    nodes = materialize(nodes.withColumn("dim", F.size("v")), "nodes")
    width = Width()
    for left in range(ROUNDS, 0, -1):
        links = find_links(nodes.select("node", "copies", "label", "dim", "v"), threshold, width)
        recall = audit(nodes, links, threshold)
        if recall >= RECALL:
            break
        width = width.doubled()
        if left == 1:
            warnings.warn(f"the audit found {recall:.3f} of the links", stacklevel=2)
    counts = links.where("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    reached = materialize(components(links.where("b is not null")), "classes")
    of = nodes.join(counts, "node", "left").join(reached, "node", "left")
    of = of.select("label", "v", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                   F.coalesce("component", "node").alias("component"))
    of = materialize(of, "classes")
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(least, "component").select("label", "v", "n_links", "component_id")
    one = rows.where("usable").join(of, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long"), "id")
    return one.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                   F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
