"""Boosted trees, staged errors and searches against a plain numpy version."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import boosting as bo

FEATURES = ["a", "b", "c"]


def rows_of(n=400, seed=0):
    """Few distinct values with three rows or more each, so that every value is a bin of its own; some are missing."""
    draw = np.random.default_rng(seed)
    a, b, c = draw.integers(0, 20, n) * 0.5, draw.integers(0, 7, n).astype(float), draw.integers(0, 2, n).astype(float)
    y = 3 * a + np.where(b > 3, 10, 0) * c + draw.normal(0, 1, n)
    a[draw.random(n) < 0.2] = np.nan
    b[draw.random(n) < 0.1] = np.nan
    return np.stack([a, b, c], axis=1), y


def frame_of(spark, x, y):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, y double")


def plain_fit(x, y, p, columns=None, rows=None, width=3):
    """Trees as nested tuples, and the predictions after every tree; thresholds are tried one by one."""
    now = np.full(len(y), y.mean())
    trees, stages = [], [now.copy()]

    def score(g):
        return (np.sign(g.sum()) * max(abs(g.sum()) - p.alpha, 0)) ** 2 / (len(g) + p.lam)

    def value(g):
        return -np.sign(g.sum()) * max(abs(g.sum()) - p.alpha, 0) / (len(g) + p.lam) * p.rate

    def grow(at, g, depth, allowed):
        best = (0.0, None)
        if depth < p.depth:
            for f in allowed:
                v = x[at, f]
                for missing_left in (True, False) if np.isnan(v).any() else (True,):
                    for cut in np.unique(v[~np.isnan(v)]):
                        left = np.where(np.isnan(v), missing_left, v <= cut)
                        if min(left.sum(), (~left).sum()) < max(p.least_weight, 1):
                            continue
                        gain = score(g[at][left]) + score(g[at][~left]) - score(g[at])
                        if gain > 1e-6 and gain > best[0] * (1 + 1e-9):
                            best = (gain, (f, cut, missing_left, left))
        if best[1] is None:
            return ("leaf", value(g[at]), at)
        f, cut, side, left = best[1]
        children = grow(at[left], g, depth + 1, allowed), grow(at[~left], g, depth + 1, allowed)
        if best[0] < p.gamma and children[0][0] == children[1][0] == "leaf":
            return ("leaf", value(g[at]), at)
        return ("split", f, cut, side, *children)

    def apply(node, out):
        if node[0] == "leaf":
            out[node[2]] = node[1]
        else:
            apply(node[4], out)
            apply(node[5], out)

    for _ in range(p.trees):
        tree = grow(np.arange(len(y)), now - y, 0, range(width))
        step = np.zeros(len(y))
        apply(tree, step)
        now = now + step
        trees.append(tree)
        stages.append(now.copy())
    return trees, stages


def same_tree(model, tree, node, plain):
    if plain[0] == "leaf":
        assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(plain[1], abs=1e-8)
        assert tree.rows[node] == len(plain[2])
        return
    f = tree.feature[node]
    assert f == plain[1] and model.edges[f][tree.cut[node]] == plain[2] and tree.missing_left[node] == plain[3]
    same_tree(model, tree, tree.left[node], plain[4])
    same_tree(model, tree, tree.right[node], plain[5])


@pytest.mark.parametrize("p", [
    bo.Boosting(trees=6, depth=4, rate=0.3),
    bo.Boosting(trees=5, depth=3, rate=0.1, alpha=4.0, lam=2.5, gamma=30.0, least_weight=5)])
@pytest.mark.parametrize("gathered", [0, 64 << 20])
def test_trees_equal_plain_ones(spark, p, gathered, monkeypatch):
    monkeypatch.setattr(bo, "KEEP", 2)              # margins are written on the way
    monkeypatch.setattr(bo, "GATHERED", gathered)   # sums meet by key, or in the driver
    x, y = rows_of()
    df = frame_of(spark, x, y).repartition(3)
    model, = bo.fit_boosted(df, "y", FEATURES, [p])
    trees, stages = plain_fit(x, y, p)
    for tree, plain in zip(model.trees, trees, strict=True):
        same_tree(model, tree, 0, plain)
    got = {r["id"]: r["prediction"] for r in model.predict(df).select("id", "prediction").collect()}
    assert np.allclose([got[i] for i in range(len(y))], stages[-1])
    errors = [r["rmse"] for r in model.staged_errors(df).orderBy("trees").collect()]
    assert np.allclose(errors, [np.sqrt(np.mean((s - y) ** 2)) for s in stages])
    shares = dict(model.importance())
    assert sum(shares.values()) == pytest.approx(1.0) and max(shares, key=shares.get) == "a"


def test_table_of_trees_gives_the_predictions(spark):
    x, y = rows_of(seed=1)
    df = frame_of(spark, x, y)
    model, = bo.fit_boosted(df, "y", FEATURES, [bo.Boosting(trees=3, depth=3, rate=0.5)])
    nodes = {(r["tree"], r["node"]): r for r in model.as_table(spark).collect()}
    for r in model.predict(df).limit(60).collect():
        total = model.base
        for t in range(3):
            node = nodes[t, 0]
            while node["feature"] is not None:
                v = r[node["feature"]]
                node = nodes[t, node["left"] if (node["missing_left"] if v is None else v <= node["threshold"]) else node["right"]]
            total += node["value"]
        assert total == pytest.approx(r["prediction"])


def test_folds_and_draws(spark):
    x, y = rows_of(seed=2)
    df = frame_of(spark, x, y).withColumn("fold", (F.col("id") % 3).cast("int"))
    p = bo.Boosting(trees=4, depth=3, rate=0.3)
    without = bo.fit_boosted(df, "y", FEATURES, [p, p], [0, 2], "fold", "id")
    for model, k in zip(without, (0, 2), strict=True):
        kept = np.arange(len(y)) % 3 != k
        trees, _ = plain_fit(x[kept], y[kept], p)
        alone, = bo.fit_boosted(df.where(F.col("fold") != k), "y", FEATURES, [p], key="id")
        assert [t.feature for t in model.trees] == [t.feature for t in alone.trees]
        assert model.base == pytest.approx(y[kept].mean())
    drawn = bo.Boosting(trees=8, depth=3, rate=0.3, row_share=0.5, column_share=0.67)
    one, = bo.fit_boosted(df.repartition(5), "y", FEATURES, [drawn], key="id")
    two, = bo.fit_boosted(df.repartition(2), "y", FEATURES, [drawn], key="id")
    assert [t.feature for t in one.trees] == [t.feature for t in two.trees]         # draws do not depend on the partitions
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for t in one.trees)
    assert all(120 < t.rows[0] < 280 for t in one.trees) and len({t.rows[0] for t in one.trees}) > 1


def test_search_equals_single_fits(spark):
    x, y = rows_of(seed=3)
    df = frame_of(spark, x, y)
    base = bo.Boosting(trees=6, depth=2, rate=0.3)
    sets = [base, replace(base, trees=3), replace(base, rate=0.1), replace(base, depth=3, lam=2.0)]
    found = dict(bo.search_staged(df, "y", FEATURES, sets, "id"))
    assert set(found) == set(sets)
    folds = np.array([r["k"] for r in df.orderBy("id").select(bo.fold_of("id", 3).alias("k")).collect()])
    for p in sets:
        errors = []
        for k in range(3):
            model, = bo.fit_boosted(df.where(bo.fold_of("id", 3) != k), "y", FEATURES, [p])
            got = {r["id"]: r["prediction"] for r in model.predict(df).collect()}
            errors.append(np.sqrt(np.mean([(got[i] - y[i]) ** 2 for i in np.flatnonzero(folds == k)])))
        assert found[p] == pytest.approx(np.mean(errors), rel=1e-6)
    rounds = bo.halving_staged(df, "y", FEATURES, sets, "id", most=9)
    assert [r["trees"] for r in rounds] == [1, 3, 9] and [r["sets"] for r in rounds] == [3, 1, 1]
    assert rounds[-1]["rmse"] <= rounds[0]["rmse"]


def test_no_rows_and_missing_columns(spark):
    df = frame_of(spark, *rows_of(30))
    model, = bo.fit_boosted(df.limit(0), "y", FEATURES, [bo.Boosting(trees=2, depth=2)])
    assert {r["prediction"] for r in model.predict(df).collect()} == {0.0}
    empty = df.withColumn("b", F.lit(None).cast("double"))
    model, = bo.fit_boosted(empty, "y", FEATURES, [bo.Boosting(trees=2, depth=2)])
    assert all(f != 1 for t in model.trees for f in t.feature)


def test_margins_move_once_per_tree(spark, monkeypatch):
    tree = bo.Tree()
    left, right = tree.split(0, 0, 1, True, 1.0)
    tree.value[left], tree.value[right] = 0.5, -2.0
    bins, y = np.array([[0], [2], [bo.MISSING]], np.uint8), np.zeros(3)
    row = (bins.tobytes(), y.tobytes(), np.arange(3).tobytes(), np.zeros(3, np.int32).tobytes(), np.ones((2, 3)).tobytes())
    (moved,) = bo._moved(1, [None, tree])([row])
    assert np.frombuffer(moved[4]).reshape(2, 3).tolist() == [[1, 1, 1], [1.5, -1, 1.5]]
    df = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("a"), ((F.col("id") * 13) % 60).cast("double").alias("y")).coalesce(1)
    found = []
    for keep in (1, 3):
        monkeypatch.setattr(bo, "KEEP", keep)
        (model,) = bo.fit_boosted(df, "y", ["a"], [bo.Boosting(trees=5, depth=2)], key="id")
        found.append([v for t in model.trees for v in t.value])
    assert found[0] == pytest.approx(found[1], abs=1e-9)


def test_features_of_few_bins_share_a_byte():
    plain, missing = [3, 2, 200, 2, 255, 25], [True, False, True, False, True, False]
    packs, draw = bo.Packs.shared(plain, missing), np.random.default_rng(5)
    bins = np.array([draw.integers(0, p, 500) for p in plain]).astype(np.uint8)
    for f in np.flatnonzero(missing):
        bins[f, draw.random(500) < 0.2] = bo.MISSING
    bytes_, weights = packs.pack(bins), draw.normal(size=500)
    assert len(bytes_) < len(plain) and max(packs.sizes) <= 256
    for f, p in enumerate(plain):
        at = packs.of[f]
        assert (packs.codes[f][bytes_[at]] == bins[f]).all()
        want = np.bincount(np.where(bins[f] == bo.MISSING, p, bins[f]), weights, p + 1)
        assert np.allclose(packs.sums_of(f, np.bincount(bytes_[at], weights, 256)), want)


def test_fits_of_a_search_grow_some_at_a_time(spark, monkeypatch):
    x, y = rows_of(120, seed=4)
    df = frame_of(spark, x, y)
    sets = [bo.Boosting(trees=t, depth=2, rate=0.3, lam=lam) for t, lam in ((1, 1.0), (3, 1.0), (2, 2.0))]
    found, held, started = [], [], bo.Ready.started
    monkeypatch.setattr(bo.Ready, "started", lambda self, bases: held.append(len(bases)) or started(self, bases))
    for many in (8, 2):
        monkeypatch.setattr(bo, "FITS", many)
        models = bo.fit_boosted(df, "y", FEATURES, sets, key="id")
        assert [len(m.trees) for m in models] == [1, 3, 2]
        found.append([t for m in models for t in m.trees])
    assert all(a.feature == b.feature and a.cut == b.cut and a.value == pytest.approx(b.value) for a, b in zip(*found, strict=True))
    assert held == [3, 2, 1]            # margins of two fits a row, however many sets there are
