"""Boosted trees over gradient sums that Spark counts.

Rows are binned once. A round grows one tree for every model at once: the full
model and those that leave out one fold. A job visits every row, finds its leaf in
each model's unfinished tree and adds its gradient to the sums of (model, leaf,
feature, bin). Sums of partitions are added on their way to the driver, which sees
``models x leaves x features x bins`` numbers, whatever the number of rows, and
chooses the splits. Of two siblings only the one with fewer rows is counted, the other is
their parent less that one.

Trees grow leaf by leaf, the best gain first, up to ``num_leaves`` leaves. Jobs look
ahead: each counts the children of all splits that are likely to be made, so that a tree takes about
as many jobs as it has levels, and the order of the splits stays that of one at a time.

Where the rows fit into one task, each model grows in a task of its own, which gets the rows of its folds. Its sums are
the whole sums already, and it goes on by the same steps to the next level and round without a job for each. Only
more rows than that take a job a level.

Gradients are rounded to multiples of 2^-``GRAIN`` and summed as integers, so the sums,
and with them the trees, don't depend on how rows are dealt out or in which
order tasks end.

A missing value has a bin of its own, and a split sends it where the gain is larger.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship

GRAIN = 24
MERGE = 64
"""Sums of so many partitions are added in one task at most."""
ROUNDS_BETWEEN_WRITES = 20
"""Margins are written every so many rounds; in between, a row walks the trees grown since."""
PART_ROWS = 50_000
"""Rows of a partition where the rows of a model are more than one task's."""


@dataclass
class BoostParams:
    rounds: int = 300
    learning_rate: float = 0.05
    num_leaves: int = 15
    max_depth: int = 6
    min_child_samples: int = 10
    min_child_hessian: float = 1e-3
    reg_lambda: float = 0.1
    colsample: float = 0.8
    max_bins: int = 63
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists. A leaf has feature -1. A row goes left if its bin is at most ``split``, a missing one if
    ``missing_left``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    split: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for name, empty in (("feature", -1), ("split", 0), ("missing_left", False), ("left", -1), ("right", -1),
                            ("value", 0.0), ("cover", 0), ("gain", 0.0)):
            getattr(self, name).append(empty)
        return len(self.feature) - 1

    def leaves_of(self, bins: np.ndarray, missing: int, depth: int) -> np.ndarray:
        """The node at which each row of bins (rows x features) ends."""
        node = np.zeros(len(bins), np.int64)
        self.move(node, bins, missing, depth)
        return node

    def move(self, node: np.ndarray, bins: np.ndarray, missing: int, depth: int) -> None:
        """Moves rows from the nodes where they are down to where they end."""
        feature, split, left, right = (np.array(x) for x in (self.feature, self.split, self.left, self.right))
        missing_left = np.array(self.missing_left)
        rows = np.arange(len(bins))
        for _ in range(depth):
            rows = rows[feature[node[rows]] >= 0]
            if not len(rows):
                return
            at = node[rows]
            bin_ = bins[rows, feature[at]]
            goes = np.where(bin_ == missing, missing_left[at], bin_ <= split[at])
            node[rows] = np.where(goes, left[at], right[at])


# ---- bins --------------------------------------------------------------------------------------------------------

def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Ascending edges of each feature, from one pass of mergeable sketches; bin b holds edges[b-1] < x <= edges[b]."""
    probs = [i / max_bins for i in range(1, max_bins)]
    number = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features]
    row = df.agg(*[F.percentile_approx(x, probs, 10_000).alias(f"e{i}") for i, x in enumerate(number)]).first()
    return [sorted(set(e or ())) for e in row]


def to_bins(values: np.ndarray, edges: list[list[float]], missing: int) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for j, e in enumerate(edges):
        x = values[:, j]
        out[:, j] = np.where(np.isnan(x), missing, np.searchsorted(np.array(e, np.float64), x))
    return out


def feature_matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    """Rows x features in double precision; null is NaN."""
    return np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in features], axis=1)


def _binned(df: DataFrame, features: Sequence[str], edges: list[list[float]], missing: int, models: int) -> DataFrame:
    names = [f"f{j}" for j in range(len(features))]
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = to_bins(feature_matrix(batch, names), edges, missing)
            rows = pa.array([x.tobytes() for x in bins], pa.binary())
            margin = pa.array([[0.0] * models] * batch.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows, batch.column("y"), batch.column("fold"), margin],
                                             ["bins", "y", "fold", "margin"])

    cols = [F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)]
    return df.select(*cols, F.col("_y").alias("y"), F.col("_fold").alias("fold")).mapInArrow(
        run, "bins binary, y int, fold int, margin array<double>")


def _rows(batch: pa.RecordBatch, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, n_features)
    y, fold = (batch.column(x).to_numpy() for x in ("y", "fold"))
    margin = batch.column("margin").flatten().to_numpy()
    return bins, y, fold, margin.reshape(len(y), -1).copy()


# ---- sums --------------------------------------------------------------------------------------------------------

@dataclass
class Model:
    """One of the models that grow together: its left-out fold (-1: none), first margin and weight of positives."""

    fold: int
    start: float
    weight: float
    trees: list[Tree] = field(default_factory=list)


def gradients(y: np.ndarray, margin: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted log loss, as integers in units of 2^-GRAIN times the larger weight."""
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y == 1, weight, 1.0) / max(weight, 1.0)
    one = float(1 << GRAIN)
    return np.rint((p - y) * w * one).astype(np.int64), np.rint(p * (1 - p) * w * one).astype(np.int64)


def sums(bins: np.ndarray, slot: np.ndarray, slots: int, parts: tuple[np.ndarray, ...], width: int) -> np.ndarray:
    """slots x features x bins x parts: integer sums over rows whose slot is not negative."""
    here = np.flatnonzero(slot >= 0)
    start = slot[here].astype(np.int64) * width
    # sums of a batch stay below 2^53, where double precision holds whole numbers
    weights = [x[here].astype(np.float64) for x in parts]
    out = np.empty((slots, bins.shape[1], width, len(parts)), np.int64)
    for j in range(bins.shape[1]):
        at = start + bins[:, j][here]
        for k, x in enumerate(weights):
            out[:, j, :, k] = np.bincount(at, x, slots * width).reshape(slots, width)
    return out


def _margins(bins: np.ndarray, margin: np.ndarray, trees: list[list[Tree]], missing: int, depth: int) -> np.ndarray:
    for m, own in enumerate(trees):
        for tree in own:
            margin[:, m] += np.array(tree.value)[tree.leaves_of(bins, missing, depth)]
    return margin


def _count(models: list[tuple[int, float, float]], pending: list[list[Tree]], growing: list[Tree], asked: list[list[int]],
           n_features: int, missing: int, depth: int):
    """A partition's sums for the asked nodes of each model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(x), n_features, missing + 1, 3), np.int64) for x in asked]
        for batch in batches:
            bins, y, fold, margin = _rows(batch, n_features)
            margin = _margins(bins, margin, pending, missing, depth)
            for m, (left_out, start, weight) in enumerate(models):
                if not asked[m]:
                    continue
                slots = np.full(len(growing[m].feature), -1)
                slots[asked[m]] = np.arange(len(asked[m]))
                slot = np.where(fold == left_out, -1, slots[growing[m].leaves_of(bins, missing, depth)])
                g, h = gradients(y, margin[:, m] + start, weight)
                total[m] += sums(bins, slot, len(asked[m]), (g, h, np.ones(len(y), np.int64)), missing + 1)
        yield from _as_batches(total)
    return run


def _as_batches(total: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for m, x in enumerate(total):
        if x.size:
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["m", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for m, x in zip(batch.column("m").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            x = np.frombuffer(x, np.int64)
            total[m] = total[m] + x if m in total else x
    for m, x in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["m", "sums"])


def _collect_sums(rows: DataFrame, parts: int, run, asked: list[list[int]], shape: tuple[int, ...]) -> list[np.ndarray]:
    found = rows.mapInArrow(run, "m int, sums binary")
    while parts > 1:  # sums of partitions meet, ``MERGE`` a task, until one is left
        parts = -(-parts // MERGE)
        found = found.repartition(parts, F.spark_partition_id()).mapInArrow(_add, "m int, sums binary")
    out = [np.zeros((len(x), *shape), np.int64) for x in asked]
    for r in found.collect():
        out[r.m] += np.frombuffer(r.sums, np.int64).reshape(out[r.m].shape)
    return out


# ---- splits ------------------------------------------------------------------------------------------------------

@dataclass
class _Split:
    gain: float
    feature: int
    at: int
    missing_left: bool
    left: np.ndarray  # g, h, n of the left child
    right: np.ndarray


def best_split(total: np.ndarray, chosen: Sequence[int], p: BoostParams, scale: float) -> _Split | None:
    """The split of the largest gain: the first feature, lowest bin, missing right, among equal ones.

    ``total`` is features x bins x (g, h, n), the last bin that of missing values.
    """
    x = total[chosen]
    all_, none = x.sum(axis=1)[:, None, :], x[:, -1:, :]
    below = np.cumsum(x[:, :-1, :], axis=1)
    gains, kinds = [], []
    for missing_left in (False, True):
        left = below + none if missing_left else below
        right = all_ - left
        fits = (left[..., 2] >= p.min_child_samples) & (right[..., 2] >= p.min_child_samples)
        fits &= (left[..., 1] / scale >= p.min_child_hessian) & (right[..., 1] / scale >= p.min_child_hessian)
        if missing_left:
            fits &= none[..., 2] > 0  # else both directions are one split
        score = [(s[..., 0] / scale) ** 2 / (s[..., 1] / scale + p.reg_lambda) for s in (left, right, all_)]
        gains.append(np.where(fits, score[0] + score[1] - score[2], -np.inf))
        kinds.append((left, right))
    gain = np.stack(gains, axis=2)  # feature, bin, direction
    f, b, d = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[f, b, d] > 0:
        return None
    return _Split(float(gain[f, b, d]), int(chosen[f]), int(b), bool(d), kinds[d][0][f, b], kinds[d][1][f, b])


class _Growth:
    """One tree's growth: what is known of its nodes, and the order of splits made one at a time, best gain first."""

    def __init__(self, p: BoostParams, chosen: Sequence[int], scale: float):
        self.p, self.chosen, self.scale = p, chosen, scale
        self.seen = Tree()  # all splits that were looked at
        self.known: dict[int, np.ndarray] = {}
        self.splits: dict[int, _Split | None] = {}
        self.parent: dict[int, tuple[int, int]] = {}  # node: its parent and its sibling
        self.depth = {0: 0}
        self.totals: dict[int, np.ndarray] = {}
        self.tree: Tree | None = None

    def learn(self, node: int, total: np.ndarray) -> None:
        self.known[node] = total
        self.totals.setdefault(node, total[0].sum(axis=0))
        self.splits[node] = best_split(total, self.chosen, self.p, self.scale)

    def learn_pair(self, node: int, total: np.ndarray) -> None:
        parent, sibling = self.parent[node]
        self.learn(node, total)
        if sibling not in self.known and self._may_split(sibling):
            self.learn(sibling, self.known[parent] - total)

    def _may_split(self, node: int) -> bool:
        return self.depth[node] < self.p.max_depth and self.totals[node][2] >= 2 * self.p.min_child_samples

    def _children(self, node: int) -> tuple[int, int]:
        if self.seen.left[node] < 0:
            s = self.splits[node]
            left, right = self.seen.add(), self.seen.add()
            self.seen.feature[node], self.seen.split[node], self.seen.missing_left[node] = s.feature, s.at, s.missing_left
            self.seen.left[node], self.seen.right[node] = left, right
            for child, other, total in ((left, right, s.left), (right, left, s.right)):
                self.depth[child], self.parent[child], self.totals[child] = self.depth[node] + 1, (node, other), total
        return self.seen.left[node], self.seen.right[node]

    def step(self) -> list[int]:
        """The nodes to count next; none once the tree is grown."""
        if 0 not in self.known:
            return [0]
        tree, at = Tree(), {0: 0}  # node of the tree -> node of ``seen``
        tree.cover[0] = int(self.totals[0][2])
        queue: list[tuple[float, int]] = []
        wanted: list[int] = []

        def enter(node: int) -> None:
            own = at[node]
            if not self._may_split(own):
                return
            if own not in self.known:
                wanted.append(own)
            elif self.splits[own] is not None:
                heapq.heappush(queue, (-self.splits[own].gain, node))

        enter(0)
        sure, leaves = True, 1
        while queue and leaves < self.p.num_leaves:
            sure = sure and not wanted  # a node that is not counted might have had a larger gain
            node = heapq.heappop(queue)[1]
            s = self.splits[at[node]]
            left, right = tree.add(), tree.add()
            tree.feature[node], tree.split[node], tree.missing_left[node] = s.feature, s.at, s.missing_left
            tree.left[node], tree.right[node], tree.gain[node] = left, right, s.gain
            for child, own in zip((left, right), self._children(at[node]), strict=True):
                at[child] = own
                tree.cover[child] = int(self.totals[own][2])
                enter(child)
            leaves += 1
        if wanted and (not sure or leaves < self.p.num_leaves):
            lighter = {}
            for node in wanted:  # one of two siblings, the lighter one
                if node == 0:
                    return [0]
                pair = tuple(sorted((node, self.parent[node][1])))
                if pair not in lighter or self.totals[node][2] < self.totals[lighter[pair]][2]:
                    lighter[pair] = min(pair, key=lambda x: (self.totals[x][2], x))
            return sorted(lighter.values())
        for node, own in at.items():
            g, h, _ = self.totals[own] / self.scale
            if tree.feature[node] < 0 and len(tree.feature) > 1:
                tree.value[node] = float(-g / (h + self.p.reg_lambda) * self.p.learning_rate)
        self.tree = tree
        return []


def chosen_features(n: int, p: BoostParams, round_: int) -> list[int]:
    """The features of one round, the same for all models."""
    k = max(1, round(n * p.colsample))
    return sorted(np.random.default_rng((p.seed, round_)).permutation(n)[:k].tolist())


# ---- training ----------------------------------------------------------------------------------------------------

@dataclass
class Ensemble:
    features: list[str]
    edges: list[list[float]]
    models: list[Model]
    depth: int

    @property
    def missing(self) -> int:
        return max((len(e) for e in self.edges), default=0) + 1


def train(df: DataFrame, features: Sequence[str], label: str, p: BoostParams, fold: str | None = None, folds: int = 0,
          rows_per_task: int = 50_000) -> Ensemble:
    """The full model, and for each value 0 .. folds - 1 of column ``fold`` one that leaves those rows out.

    Up to ``rows_per_task`` rows, a model grows in one task; the trees are the same either way. Rows without a label are left out. Feature values may be null or NaN.
    """
    features = list(features)
    df = df.where(F.col(label).isNotNull()).withColumn("_y", (F.col(label) == 1).cast("int"))
    df = df.withColumn("_fold", F.col(fold).cast("int") if fold else F.lit(-2))
    stats = df.groupBy("_fold").agg(F.count("*").alias("n"), F.sum("_y").alias("pos")).collect()  # one row a fold
    ensemble = Ensemble(features, bin_edges(df, features, p.max_bins), [], p.max_depth)
    for left_out in [-1, *range(folds)]:
        n = sum(r.n for r in stats if r._fold != left_out)
        pos = sum(r.pos for r in stats if r._fold != left_out)
        rate = min(max(pos / n, 1e-6), 1 - 1e-6) if n else 0.5
        ensemble.models.append(Model(left_out, float(np.log(rate / (1 - rate))), float((1 - rate) / max(rate, 1e-6))))
    total = sum(r.n for r in stats)
    parts = 1 if total <= rows_per_task else -(-total // min(rows_per_task, PART_ROWS))
    missing = ensemble.missing
    rows = _binned(df, features, ensemble.edges, missing, len(ensemble.models))
    rows = materialize(rows.repartition(parts) if parts > 1 else rows, "bins")
    return _boost(rows, parts, ensemble, p)


def _grow(growth: list[_Growth], sums_of) -> list[Tree]:
    """One tree a model, from the sums of the nodes that the growths ask for."""
    while any(asked := [g.step() if g.tree is None else [] for g in growth]):
        for g, nodes, found in zip(growth, asked, sums_of(asked), strict=True):
            for node, total in zip(nodes, found, strict=True):
                g.learn(node, total) if node == 0 else g.learn_pair(node, total)
    return [g.tree for g in growth]


def _growths(p: BoostParams, n_features: int, round_: int, scales: list[float]) -> list[_Growth]:
    chosen = chosen_features(n_features, p, round_)
    return [_Growth(p, chosen, s) for s in scales]


def _boost(rows: DataFrame, parts: int, ensemble: Ensemble, p: BoostParams) -> Ensemble:
    n, missing = len(ensemble.features), ensemble.missing
    models = [(m.fold, m.start, m.weight) for m in ensemble.models]
    scales = [(1 << GRAIN) / max(m.weight, 1.0) for m in ensemble.models]
    pending: list[list[Tree]] = [[] for _ in models]
    if parts == 1:
        for m, trees in zip(ensemble.models, _grow_apart(rows, models, scales, p, n, missing), strict=True):
            m.trees += trees
        return ensemble
    for round_ in range(0, p.rounds, ROUNDS_BETWEEN_WRITES):
        rounds = range(round_, min(p.rounds, round_ + ROUNDS_BETWEEN_WRITES))
        for k in rounds:
            growth = _growths(p, n, k, scales)

            def sums_of(asked, growth=growth):
                run = _count(models, pending, [g.seen for g in growth], asked, n, missing, p.max_depth)
                return _collect_sums(rows, parts, run, asked, (n, missing + 1, 3))

            for own, tree in zip(pending, _grow(growth, sums_of), strict=True):
                own.append(tree)
        for m, own in zip(ensemble.models, pending, strict=True):
            m.trees += own
        if rounds.stop < p.rounds:
            rows, pending = materialize(_moved(rows, pending, n, missing, p.max_depth), "margins"), [[] for _ in models]
    return ensemble


def _grow_apart(rows: DataFrame, models: list[tuple[int, float, float]], scales: list[float], p: BoostParams, n: int,
                missing: int) -> list[list[Tree]]:
    """The trees of each model, by a task of its own that gets the model's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(batch.column("m"), batch.column("bins").to_pylist(), batch.column("y").to_numpy()) for batch in batches]
        if not parts:
            return
        m = parts[0][0][0].as_py()
        bins = np.frombuffer(b"".join(b"".join(x) for _, x, _ in parts), np.uint8).reshape(-1, n)
        trees = _grow_in_task(bins, np.concatenate([y for _, _, y in parts]), models[m], scales[m], p, missing)
        found = [(m, *row[1:]) for row in _node_rows([trees])]
        yield pa.RecordBatch.from_pylist([dict(zip(NODE_COLUMNS, row, strict=True)) for row in found], schema=_NODE_SCHEMA)

    left_out = F.array(*[F.lit(fold) for fold, _, _ in models])
    each = rows.select("bins", "y", "fold", F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1))).alias("m"))
    each = each.where(~F.col("fold").eqNullSafe(left_out[F.col("m")])).select("m", "bins", "y")
    found = each.repartitionById(len(models), "m").mapInArrow(run, NODES).collect()
    # sorted here, as the borders of a distributed sort would be found by growing all trees twice
    grown = _trees_of(sorted(found, key=lambda r: (r.model, r.tree, r.node)), len(models))
    none = np.zeros((0, n), np.uint8), np.zeros(0, np.int32)
    return [own or _grow_in_task(*none, models[m], scales[m], p, missing) for m, own in enumerate(grown)]


def _grow_in_task(bins: np.ndarray, y: np.ndarray, model: tuple[int, float, float], scale: float, p: BoostParams,
                  missing: int) -> list[Tree]:
    """The trees of the model whose rows these are."""
    bins, margin, ones = np.asfortranarray(bins), np.zeros(len(y)), np.ones(len(y), np.int64)
    made: list[Tree] = []
    for k in range(p.rounds):
        growth = _growths(p, bins.shape[1], k, [scale])
        g, h = gradients(y, margin + model[1], model[2])
        at = np.zeros(len(y), np.int64)  # where rows are, as the tree grows

        def sums_of(asked, seen=growth[0].seen, at=at, parts=(g, h, ones)):
            seen.move(at, bins, missing, p.max_depth)
            slots = np.full(len(seen.feature), -1)
            slots[asked[0]] = np.arange(len(asked[0]))
            return [sums(bins, slots[at], len(asked[0]), parts, missing + 1)]

        tree, = _grow(growth, sums_of)
        margin += np.array(tree.value)[tree.leaves_of(bins, missing, p.max_depth)]
        made.append(tree)
    return made


def _moved(rows: DataFrame, pending: list[list[Tree]], n_features: int, missing: int, depth: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, _, margin = _rows(batch, n_features)
            margin = _margins(bins, margin, pending, missing, depth)
            new = pa.ListArray.from_arrays(pa.array(np.arange(0, margin.size + 1, margin.shape[1]), pa.int32()),
                                           pa.array(margin.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), batch.column("fold"), new],
                                             ["bins", "y", "fold", "margin"])
    return rows.mapInArrow(run, rows.schema)


# ---- scores ------------------------------------------------------------------------------------------------------

def margins(df: DataFrame, ensemble: Ensemble, keep: Sequence[str]) -> DataFrame:
    """The kept columns and ``margins``: each model's log odds."""
    features, edges, missing, depth = ensemble.features, ensemble.edges, ensemble.missing, ensemble.depth
    starts, trees = [m.start for m in ensemble.models], [m.trees for m in ensemble.models]
    names = [f"_f{j}" for j in range(len(features))]
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = to_bins(feature_matrix(batch, names), edges, missing)
            out = _margins(bins, np.tile(np.array(starts, np.float64), (batch.num_rows, 1)), trees, missing, depth)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, out.shape[1]), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), rows], ["kept", "margins"])

    kept = df.select(F.struct(*keep).alias("kept"), *[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)])
    kind = kept.schema["kept"].dataType.simpleString()
    return kept.mapInArrow(run, f"kept {kind}, margins array<double>").select("kept.*", "margins")


def probability(margin):
    """A margin's probability."""
    return 1 / (1 + F.exp(-margin))


def importances(ensemble: Ensemble, model: int = 0) -> list[tuple[str, float]]:
    """Each feature's share of the gain of all splits."""
    total = np.zeros(len(ensemble.features))
    for tree in ensemble.models[model].trees:
        for f, gain in zip(tree.feature, tree.gain, strict=True):
            if f >= 0:
                total[f] += gain
    return [(c, float(x)) for c, x in zip(ensemble.features, total / (total.sum() or 1.0), strict=True)]


# ---- contributions -----------------------------------------------------------------------------------------------

@dataclass
class Path:
    """One leaf's path: the nodes on it and the side they must take, which feature of ``features`` each node splits,
    and for each pattern of features that a row agrees with, the contribution to each feature."""

    nodes: list[int]
    sides: list[bool]
    of: list[int]
    features: list[int]
    table: np.ndarray
    base: float


def paths(tree: Tree) -> list[Path]:
    """The paths of a tree's leaves with the Shapley values of every pattern.

    A leaf counts fully where a row agrees with a feature's splits on the path, and by the share of the rows that
    do where the feature is unknown. The Shapley value of a feature is the sum over the subsets of the others, weighted by
    their size; with at most as many features as levels, all subsets are listed.
    """
    found, stack = [], [(0, [], [])]
    while stack:
        node, nodes, sides = stack.pop()
        if tree.feature[node] >= 0:
            stack += [(tree.right[node], [*nodes, node], [*sides, False]), (tree.left[node], [*nodes, node], [*sides, True])]
            continue
        features = list(dict.fromkeys(tree.feature[x] for x in nodes))
        of = [features.index(tree.feature[x]) for x in nodes]
        share = np.ones(len(features))
        for x, f, below in zip(nodes, of, [*nodes, node][1:], strict=True):
            share[f] *= tree.cover[below] / tree.cover[x]
        d = len(features)
        subsets = np.arange(1 << d)
        bits = (subsets[:, None] >> np.arange(d)) & 1
        # pattern x subset: the features of the subset are known, the others count by their share
        weight = np.where(bits[None, :, :] == 1, bits[:, None, :], share[None, None, :]).prod(axis=2)
        table = np.zeros((1 << d, d))
        for j in range(d):
            without = subsets[bits[:, j] == 0]
            size = bits[without].sum(axis=1).tolist()
            ways = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in size])
            table[:, j] = tree.value[node] * ((weight[:, without | 1 << j] - weight[:, without]) @ ways)
        found.append(Path(nodes, sides, of, features, table, tree.value[node] * float(share.prod())))
    return found


def contributions_of(bins: np.ndarray, trees: list[Tree], of_trees: list[list[Path]], missing: int) -> np.ndarray:
    """Rows x features: what each feature adds to the margin."""
    out = np.zeros((bins.shape[1], len(bins)))
    for tree, own in zip(trees, of_trees, strict=True):
        feature = np.maximum(np.array(tree.feature), 0)
        x = bins[:, feature]
        goes = np.where(x == missing, np.array(tree.missing_left), x <= np.array(tree.split))
        for path in own:
            if not path.features:
                continue
            pattern = np.full(len(bins), (1 << len(path.features)) - 1)
            for node, side, f in zip(path.nodes, path.sides, path.of, strict=True):
                pattern &= ~np.where(goes[:, node] == side, 0, 1 << f)
            for k, f in enumerate(path.features):
                out[f] += path.table[pattern, k]
    return out.T


def base_value(ensemble: Ensemble, model: int = 0) -> float:
    """The margin of a row of which nothing is known."""
    return ensemble.models[model].start + sum(p.base for t in ensemble.models[model].trees for p in paths(t))


def contributions(df: DataFrame, ensemble: Ensemble, keep: Sequence[str] = (), model: int = 0) -> DataFrame:
    """The kept columns, and for each feature ``c__<name>``, its contribution to the margin, and ``v__<name>``, its value.

    Contributions and ``base_value`` add up to the margin. Every row is explained on its own, with the node table
    of all trees at hand.
    """
    features, edges, missing = ensemble.features, ensemble.edges, ensemble.missing
    trees = ensemble.models[model].trees
    names = [f"_f{j}" for j in range(len(features))]
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_trees = [paths(t) for t in trees]
        for batch in batches:
            values = feature_matrix(batch, names)
            found = contributions_of(to_bins(values, edges, missing), trees, of_trees, missing)
            columns = [pa.array(x) for x in found.T] + [pa.array(x, from_pandas=True) for x in values.T]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *columns],
                                             ["kept", *(f"c{j}" for j in range(len(features))), *(f"v{j}" for j in range(len(features)))])

    kept = F.struct(*keep) if keep else F.struct(F.lit(1).alias("_none"))
    rows = df.select(kept.alias("kept"), *[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)])
    kind = rows.schema["kept"].dataType.simpleString()
    schema = ", ".join([f"kept {kind}", *(f"c{j} double" for j in range(len(features))), *(f"v{j} double" for j in range(len(features)))])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], *[F.col(f"c{j}").alias(f"c__{c}") for j, c in enumerate(features)],
                      *[F.col(f"v{j}").alias(f"v__{c}") for j, c in enumerate(features)])


# ---- saved models ------------------------------------------------------------------------------------------------

TREE_COLUMNS = ("feature", "split", "missing_left", "left", "right", "value", "cover", "gain")
NODE_COLUMNS = ("model", "tree", "node", *TREE_COLUMNS)
NODES = ("model int, tree int, node int, feature int, split int, missing_left boolean, left int, right int, value double, "
         "cover long, gain double")
_NODE_SCHEMA = pa.schema([(c, {"int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "long": pa.int64()}[k])
                          for c, k in (x.split() for x in NODES.split(", "))])


def _node_rows(models: list[list[Tree]]) -> list[tuple]:
    return [(m, t, n, *(getattr(tree, c)[n] for c in TREE_COLUMNS))
            for m, trees in enumerate(models) for t, tree in enumerate(trees) for n in range(len(tree.feature))]


def _trees_of(rows: list, models: int) -> list[list[Tree]]:
    """Trees from their nodes in order."""
    out: list[list[Tree]] = [[] for _ in range(models)]
    for r in rows:
        if r["node"] == 0:
            out[r["model"]].append(Tree())
        else:
            out[r["model"]][-1].add()
        for c in TREE_COLUMNS:
            getattr(out[r["model"]][-1], c)[r["node"]] = r[c]
    return out


def save(ensemble: Ensemble, path: str, spark: SparkSession) -> None:
    """Node, model and feature tables under ``path``, through Spark's writers."""
    nodes = spark.createDataFrame(_node_rows([m.trees for m in ensemble.models]), NODES)
    nodes.coalesce(1).write.parquet(f"{path}/nodes")
    rows = [(m, x.fold, x.start, x.weight, ensemble.depth) for m, x in enumerate(ensemble.models)]
    spark.createDataFrame(rows, "model int, fold int, start double, weight double, depth int").coalesce(1).write.parquet(f"{path}/models")
    rows = [(j, c, [float(x) for x in e]) for j, (c, e) in enumerate(zip(ensemble.features, ensemble.edges, strict=True))]
    spark.createDataFrame(rows, "place int, feature string, edges array<double>").coalesce(1).write.parquet(f"{path}/features")


def load(spark: SparkSession, path: str) -> Ensemble:
    """A saved ensemble; its size depends on the numbers of trees and leaves only."""
    features = spark.read.parquet(f"{path}/features").orderBy("place").collect()
    models = spark.read.parquet(f"{path}/models").orderBy("model").collect()
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("model", "tree", "node").collect()
    trees = _trees_of(nodes, len(models))
    return Ensemble([r.feature for r in features], [list(r.edges) for r in features],
                    [Model(r.fold, r.start, r.weight, own) for r, own in zip(models, trees, strict=True)], models[0].depth)
