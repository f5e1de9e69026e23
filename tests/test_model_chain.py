"""Boosted trees, their contributions, isotonic pooling and the training chain against plain versions."""

import itertools
import math
import tempfile

import numpy as np
import pytest

from riskwatch.operators import boost, isotonic
from riskwatch.operators import model as MD


# ---- trees -------------------------------------------------------------------------------------------------------

def plain_split(bins, g, h, rows, chosen, missing, p, scale):
    """The best split of some rows by trying every one: (gain, feature, bin, missing left)."""
    def score(x):
        return (sum(int(g[i]) for i in x) / scale) ** 2 / (sum(int(h[i]) for i in x) / scale + p.reg_lambda)

    best = None
    for f, b, missing_left in itertools.product(chosen, range(missing), (False, True)):
        left = [i for i in rows if (bins[i, f] == missing and missing_left) or (bins[i, f] != missing and bins[i, f] <= b)]
        right = [i for i in rows if i not in set(left)]
        if min(len(left), len(right)) < p.min_child_samples or (missing_left and not any(bins[i, f] == missing for i in rows)):
            continue
        if min(sum(int(h[i]) for i in x) / scale for x in (left, right)) < p.min_child_hessian:
            continue
        gain = score(left) + score(right) - score(rows)
        if gain > 0 and (best is None or gain > best[0]):
            best = (gain, f, b, missing_left, left, right)
    return best


def plain_tree(bins, g, h, rows, chosen, missing, p, scale):
    """Leaf by leaf, one split at a time: {leaf's rows: value}, and the splits in order."""
    leaves = [(0, rows, plain_split(bins, g, h, rows, chosen, missing, p, scale))]
    splits = []
    while len(leaves) < p.num_leaves and any(x[2] for x in leaves):
        at = max((i for i, x in enumerate(leaves) if x[2]), key=lambda i: leaves[i][2][0])
        depth, _, (gain, f, b, missing_left, left, right) = leaves[at]
        splits.append((f, b, missing_left))
        children = [(depth + 1, x, plain_split(bins, g, h, x, chosen, missing, p, scale) if depth + 1 < p.max_depth else None)
                    for x in (left, right)]
        leaves[at:at + 1] = children
    if len(leaves) == 1:
        return {tuple(rows): 0.0}, splits
    value = {tuple(x): -(sum(int(g[i]) for i in x) / scale) / (sum(int(h[i]) for i in x) / scale + p.reg_lambda) * p.learning_rate
             for _, x, _ in leaves}
    return value, splits


def sample(n=500, seed=3):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 4)), 1)
    x[rnd.random((n, 4)) < 0.12] = np.nan
    z = np.nan_to_num(x)
    y = (z[:, 0] + z[:, 1] * z[:, 2] + np.isnan(x[:, 3]) + rnd.normal(size=n) > 1.2).astype(int)
    return x, y, rnd.integers(0, 3, n)


P = dict(rounds=4, num_leaves=7, max_depth=4, min_child_samples=8, max_bins=12, learning_rate=0.3, colsample=0.75)


def frame(spark, x, y, fold):
    rows = [(i, *[None if math.isnan(v) else float(v) for v in r], int(c), int(f)) for i, (r, c, f) in enumerate(zip(x, y, fold, strict=True))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y int, fold int").repartition(3)


@pytest.fixture(scope="module")
def grown(spark):
    x, y, fold = sample()
    df = frame(spark, x, y, fold).cache()
    p = MD.ModelParams(label="y", **P)
    return x, y, fold, df, p, MD.train_classifier(df, ["a", "b", "c", "d"], p, "fold", 3)


def test_trees_are_those_of_one_split_at_a_time(grown):
    x, y, fold, _, p, model = grown
    bins = boost.to_bins(x, model.edges, model.missing)
    for m in (model.models[0], model.models[2]):
        rows = [i for i in range(len(y)) if fold[i] != m.fold]
        rate = y[rows].mean()
        assert m.start == pytest.approx(math.log(rate / (1 - rate))) and m.weight == pytest.approx((1 - rate) / rate)
        margin, scale = np.full(len(y), m.start), (1 << boost.GRAIN) / max(m.weight, 1.0)
        for round_, tree in enumerate(m.trees):
            g, h = boost.gradients(y, margin, m.weight)
            chosen = boost.chosen_features(4, p, round_)
            want, splits = plain_tree(bins, g, h, rows, chosen, model.missing, p, scale)
            made = [(f, b, d) for f, b, d in zip(tree.feature, tree.split, tree.missing_left, strict=True) if f >= 0]
            assert sorted(made) == sorted(splits) and len(chosen) == 3
            leaf = tree.leaves_of(bins, model.missing, p.max_depth)
            got = {}
            for i in rows:
                got.setdefault(int(leaf[i]), []).append(i)
            assert {tuple(v): tree.value[k] for k, v in got.items()} == want
            assert all(tree.cover[k] == len(v) for k, v in got.items())
            margin += np.array(tree.value)[leaf]


def test_trees_do_not_depend_on_partitions(spark, grown, monkeypatch):
    x, y, fold, df, p, model = grown
    monkeypatch.setattr(boost, "MERGE", 2)
    monkeypatch.setattr(boost, "ROUNDS_BETWEEN_WRITES", 2)
    again = boost.train(df.repartition(5), model.features, "y", p, "fold", 3, rows_per_task=90)
    assert [m.trees for m in again.models] == [m.trees for m in model.models]


def expected(tree, bins, missing, known, node=0):
    """The tree's value of a row of which only some features are known."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        goes = tree.missing_left[node] if bins[f] == missing else bins[f] <= tree.split[node]
        return expected(tree, bins, missing, known, left if goes else right)
    return sum(tree.cover[c] / tree.cover[node] * expected(tree, bins, missing, known, c) for c in (left, right))


def test_contributions_against_all_subsets(grown):
    x, _, _, df, p, model = grown
    bins = boost.to_bins(x, model.edges, model.missing)[:40]
    trees = model.models[0].trees
    got = boost.contributions_of(bins, trees, [boost.paths(t) for t in trees], model.missing)
    for i in range(len(bins)):
        for j in range(4):
            others, want = [k for k in range(4) if k != j], 0.0
            for size in range(4):
                for s in itertools.combinations(others, size):
                    ways = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                    want += ways * sum(expected(t, bins[i], model.missing, {*s, j}) - expected(t, bins[i], model.missing, set(s)) for t in trees)
            assert got[i, j] == pytest.approx(want, abs=1e-12)


def test_contributions_add_up_to_the_margin(grown):
    *_, df, p, model = grown
    c = {r.id: r for r in boost.contributions(df, model, ["id"]).collect()}
    base = boost.base_value(model)
    for r in MD.score_raw(model, df, ["id"]).collect():
        assert sum(c[r.id][f"c__{f}"] for f in model.features) + base == pytest.approx(r.margin, abs=1e-9)
        assert r.score_raw == pytest.approx(1 / (1 + math.exp(-r.margin)))
    top = MD.explain_topk(boost.contributions(df, model, ["id"]), model.features, ["id"], 2).collect()
    for r in top:
        sizes = sorted((abs(c[r.id][f"c__{f}"]) for f in model.features), reverse=True)
        assert [abs(r.contrib1), abs(r.contrib2)] == sizes[:2] and r.contrib1 == c[r.id][f"c__{r.feat1}"]


def test_saved_model_scores_alike(spark, grown):
    *_, df, p, model = grown
    path = tempfile.mkdtemp() + "/m"
    MD.save_model(model, path, spark)
    again = MD.load_model(spark, path)
    assert again == model
    assert sum(v for _, v in boost.importances(again)) == pytest.approx(1)


def test_train_on_constant_and_empty_columns(spark):
    rows = [(i, 1.0, None, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    model = MD.train_classifier(df, ["a", "b"], MD.ModelParams(label="y", rounds=2))
    assert [r.score_raw for r in MD.score_raw(model, df, ["id"]).collect()] == [0.5] * 60
    assert boost.base_value(model) == 0.0


# ---- isotonic ----------------------------------------------------------------------------------------------------

def plain_steps(rows):
    """Blocks (lo, hi, pos, n) of (score, label) rows by pooling one after the other."""
    counts = {}
    for s, y in rows:
        a, b = counts.get(s, (0, 0))
        counts[s] = (a + y, b + 1)
    out = []
    for s in sorted(counts):
        block = [s, s, *counts[s]]
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            before = out.pop()
            block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
        out.append(block)
    return [tuple(b) for b in out]


@pytest.mark.parametrize("blocks", [65_536, 7])
def test_isotonic_steps(spark, monkeypatch, blocks):
    monkeypatch.setattr(isotonic, "RANGE_BLOCKS", blocks)
    rnd = np.random.default_rng(5)
    rows = [(k, round(float(s), 2), int(rnd.random() < s ** 2)) for k in (0, 1) for s in rnd.random(300)]
    rows += [(0, 5.0 + i, 0) for i in range(40)]  # one block over many ranges
    df = spark.createDataFrame([*rows, (0, None, 1), (1, 0.4, None), (1, float("nan"), 1)], "k int, s double, y int")
    found = isotonic.fit(df, "s", "y", "k").orderBy("key", "lo").collect()
    for k in (0, 1):
        assert [(r.lo, r.hi, r.pos, r.n) for r in found if r.key == k] == plain_steps([x[1:] for x in rows if x[0] == k])
    assert all(r.value == r.pos / r.n for r in found)


@pytest.mark.parametrize("per_bucket", [16, 1])
def test_interpolation(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(isotonic, "BUCKET_BLOCKS", per_bucket)
    rnd = np.random.default_rng(6)
    train = [(round(float(s), 2), int(rnd.random() < s)) for s in rnd.random(400)]
    steps = isotonic.fit(spark.createDataFrame(train, "s double, y int"), "s", "y")
    x = [*rnd.random(200).tolist(), -1.0, 2.0, 0.0, 1.0, *[s for s, _ in train[:50]]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*x, None])], "i int, score double")
    found = {r.i: r for r in isotonic.interpolate(df, steps, "score", "p", (0.0, 1.0)).collect()}
    plain = plain_steps(train)
    xs, ys = [e for lo, hi, _, _ in plain for e in (lo, hi)], [v for _, _, pos, n in plain for v in (pos / n, pos / n)]
    assert len(plain) > 5 and found[len(x)].p is None
    for i, v in enumerate(x):
        assert found[i].p == pytest.approx(float(np.interp(v, xs, ys)), abs=1e-12)


def test_isotonic_of_nothing(spark):
    df = spark.createDataFrame([], "s double, y int")
    steps = isotonic.fit(df, "s", "y")
    assert steps.count() == 0
    one = spark.createDataFrame([(0.5,)], "s double")
    assert isotonic.interpolate(one, steps, "s", "p").first().p is None


def test_recalibration(spark):
    rnd = np.random.default_rng(7)
    rows = [(i, float(s), int(rnd.random() < s)) for i, s in enumerate(rnd.random(150))]
    steps, out, summary = MD.calibrate_isotonic(spark.createDataFrame(rows, "id int, s double, y int"), "s", "y", 0.6, 0.3)
    r = summary.first()
    assert (r.positives, r.few_positives) == (sum(x[2] for x in rows), sum(x[2] for x in rows) < 100)
    got = out.collect()
    assert r.brier == pytest.approx(np.mean([(x.prob_calibrated - x.y) ** 2 for x in got]))
    for x in got:
        assert x.tier == ("Red" if x.prob_calibrated >= 0.6 else "Amber" if x.prob_calibrated >= 0.3 else "Green")
        assert x.score_ews == pytest.approx(100 * (1 - x.prob_calibrated), abs=0.0051)


# ---- the chain ---------------------------------------------------------------------------------------------------

def test_train_calibrate_score(spark):
    x, y, _ = sample(400, 9)
    rows = [(i, "s", *[None if math.isnan(v) else float(v) for v in r], None if i == 0 else int(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "customer_id int, sector_code string, a double, b double, c double, d double, event_h12m int")
    path = MD.train_and_calibrate(df, tempfile.mkdtemp() + "/run", MD.ModelParams(**P))
    scores = spark.read.parquet(f"{path}/scores").toPandas()
    assert len(scores) == 399 and scores.is_test.sum() == round(y[1:].sum() * 0.2) + round((1 - y[1:]).sum() * 0.2)
    thr = spark.read.parquet(f"{path}/thresholds").first()
    assert (thr.red, thr.amber) == pytest.approx(np.quantile(scores.prob_calibrated, [0.95, 0.85]))
    assert ((scores.tier == "Red") == (scores.prob_calibrated >= thr.red)).all() and set(scores.tier) == {"Red", "Amber", "Green"}
    test = scores[scores.is_test]
    m = spark.read.parquet(f"{path}/metrics").first()
    p, t = test.prob_calibrated.to_numpy(), test.event_h12m.to_numpy()
    pairs = np.sign(p[t == 1][:, None] - p[t == 0])
    assert m.auc == pytest.approx((pairs > 0).mean() + (pairs == 0).mean() / 2) and m.auc > 0.6
    assert m.brier == pytest.approx(((p - t) ** 2).mean())
    # the folds: each calibrated on what its model has not seen, then averaged
    model, steps, split = MD.load_model(spark, path), spark.read.parquet(f"{path}/steps").toPandas(), spark.read.parquet(f"{path}/split").toPandas()
    bins = boost.to_bins(split[["a", "b", "c", "d"]].to_numpy(float), model.edges, model.missing)
    order = np.argsort([model.features.index(c) for c in model.features])
    assert model.features == ["a", "b", "c", "d"] and order.tolist() == [0, 1, 2, 3]
    want = np.zeros(len(split))
    for k, own in enumerate(model.models[1:]):
        margin = own.start + sum(np.array(tr.value)[tr.leaves_of(bins, model.missing, 4)] for tr in own.trees)
        raw = 1 / (1 + np.exp(-margin))
        out = (split.fold == k).to_numpy()
        assert own.fold == k and own.trees[0].cover[0] == ((~split.is_test) & ~out).sum()
        plain = plain_steps([(float(s), int(c)) for s, c in zip(raw[out], split.event_h12m[out], strict=True)])
        assert plain[0][2:] == tuple(steps[steps.key == k].sort_values("lo").iloc[0][["pos", "n"]])
        xs, ys = [e for lo, hi, _, _ in plain for e in (lo, hi)], [v for _, _, pos, n in plain for v in (pos / n, pos / n)]
        want += np.interp(raw, xs, ys) / 5
    got = scores.set_index("customer_id").prob_calibrated.loc[split.customer_id].to_numpy()
    assert got == pytest.approx(np.clip(want, 1e-6, 1 - 1e-6), abs=1e-9)
    batch = MD.score_features(path, df, 0.2, 0.05).toPandas().set_index("customer_id")
    assert len(batch) == 400
    assert batch.prob_default_12m_calibrated.loc[split.customer_id].to_numpy() == pytest.approx(got, abs=1e-12)
