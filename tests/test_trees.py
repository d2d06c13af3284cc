"""Trees against a trainer that looks at rows one by one."""

import math
from dataclasses import replace

import numpy as np
import pytest
from helpers import CFG, dense, inputs

from demandloom.models import pooled, roster, trees
from demandloom.operators import series

GROWTH = trees.Growth(trees=3, depth=3, step=0.3, l2=1.0, seed=7)
FOREST = trees.Growth(trees=4, depth=3, seed=7)


def known(spark, parts=None, n=30):
    rows = []
    for k in range(5):
        rows += dense(
            "2024-07-01", n, city=f"c{k}", value=lambda i, k=k: float((k + 1) * (i % 7 + 1) + (i * 7919 * (k + 1)) % 11)
        )
    df = inputs(spark, rows)
    arrays = series.series_arrays(series.prepare_series(df, CFG), CFG)
    found = roster.history_of(arrays, CFG, "full")[0]
    return found.repartition(parts) if parts else found


def rows_of(df, lags=7, bins=64):
    """Codes, labels in millionths and keys, and the cut points, by plain loops."""
    scaled = pooled.scaled_series(df, CFG, lags).collect()
    counts = {}
    for row in scaled:
        for z in row["_z"]:
            cell = math.floor(z * 1e6 + 0.5) * 256 // 1_000_000
            counts[cell] = counts.get(cell, 0) + 1
    total, before, last, cuts = sum(counts.values()), 0, 0, []
    for cell in sorted(counts):
        if bins * before // total > last:
            cuts.append(cell)
        last = bins * before // total
        before += counts[cell]
    table = []
    for r in pooled.training_rows(pooled.scaled_series(df, CFG, lags), CFG, lags).collect():
        cells = [math.floor(v * 1e6 + 0.5) * 256 // 1_000_000 for v in r["features"][:lags]]
        codes = [sum(c <= cell for c in cuts) for cell in cells] + [int(r["features"][lags])]
        table.append((codes, math.floor(r["label"] * 1e6 + 0.5), r["key"]))
    return sorted(table), cuts


def gain_of(g, h, growth):
    return max(abs(g) - growth.l1, 0.0) ** 2 / (h + growth.l2) if h + growth.l2 > 0 else 0.0


def split_of(rows, growth, unit, boosted, may):
    """(gain, feature, bin) of the best split of (codes, weight, whole target) rows."""
    whole = gain_of(sum(g for _, _, g in rows) / unit, sum(w for _, w, _ in rows), growth)
    best = (1e-9 * max(1.0, whole), -1, 0)
    for f in range(len(rows[0][0])):
        for b in sorted({codes[f] for codes, _, _ in rows}):
            left = [r for r in rows if r[0][f] <= b]
            right = [r for r in rows if r[0][f] > b]
            hl, hr = sum(w for _, w, _ in left), sum(w for _, w, _ in right)
            if not may[f] or hl < max(growth.min_weight, 1e-9) or hr < max(growth.min_weight, 1e-9):
                continue
            gain = gain_of(sum(g for *_, g in left) / unit, hl, growth)
            gain += gain_of(sum(g for *_, g in right) / unit, hr, growth) - whole
            gain = 0.5 * gain - growth.gamma if boosted else gain
            if gain > best[0] * (1 + 1e-12):
                best = (gain, f, b)
    return best


def grow(rows, growth, unit, boosted, leaf, t):
    nodes = {}

    def visit(rows, node, depth):
        w, g = sum(w for _, w, _ in rows), sum(g for *_, g in rows) / unit
        if depth < growth.depth:
            gain, f, b = split_of(rows, growth, unit, boosted, trees.allowed(growth, 8, t, node))
            if f >= 0:
                nodes[node] = (f, b)
                visit([r for r in rows if r[0][f] <= b], 2 * node + 1, depth + 1)
                visit([r for r in rows if r[0][f] > b], 2 * node + 2, depth + 1)
                return
        nodes[node] = leaf(g, w)

    visit(rows, 0, 0)
    return nodes


def walk(nodes, codes):
    at = 0
    while isinstance(nodes[at], tuple):
        f, b = nodes[at]
        at = 2 * at + 1 + (codes[f] > b)
    return nodes[at]


def same(tree, nodes):
    inner = {i: v for i, v in nodes.items() if isinstance(v, tuple)}
    assert {i: (int(tree.feature[i]), int(tree.bin[i])) for i in np.flatnonzero(tree.feature >= 0)} == inner
    for i, v in nodes.items():
        if not isinstance(v, tuple):
            assert tree.value[i] == pytest.approx(v, abs=1e-9)


@pytest.mark.parametrize(
    "change",
    [{}, {"l1": 0.8}, {"l2": 30.0}, {"gamma": 0.4}, {"min_weight": 20}, {"row_share": 0.5}, {"column_share": 0.4}],
)
def test_boosted_trees_equal_the_plain_trainer(spark, change):
    growth = replace(GROWTH, **change)
    df = known(spark)
    model = pooled.fit(df, CFG, 7, growth, boosted=True)
    table, cuts = rows_of(df)
    assert model.cuts.tolist() == cuts
    base = sum(z for _, z, _ in table) / len(table) / 1e6
    assert model.base == pytest.approx(base, abs=1e-12)

    def leaf(g, w):
        return -growth.step * math.copysign(max(abs(g) - growth.l1, 0), g) / (w + growth.l2)

    margins = [model.base] * len(table)
    for t, tree in enumerate(model.trees):
        rows = []
        for (codes, z, key), margin in zip(table, margins):
            a, b = trees.bag_constants(growth.seed, t)
            if growth.row_share == 1 or (a * key + b) % trees.HASH < int(growth.row_share * trees.HASH):
                rows.append((codes, 1, math.floor((margin - z / 1e6) * trees.UNIT + 0.5)))
        nodes = grow(rows, growth, trees.UNIT, True, leaf, t)
        same(tree, nodes)
        codes = np.array([c for c, _, _ in table], np.uint8)
        margins = [m + v for m, v in zip(margins, tree.predict(codes))]
        assert tree.predict(codes).tolist() == pytest.approx([walk(nodes, c) for c, _, _ in table])
    plain = pooled.fit(df, CFG, 7, GROWTH, boosted=True)
    if change:  # the parameter has an effect
        assert any((a.value != b.value).any() for a, b in zip(plain.trees, model.trees))


@pytest.mark.parametrize("change", [{}, {"min_weight": 15}, {"column_share": 0.4}])
def test_forest_equals_the_plain_trainer(spark, change):
    growth = replace(FOREST, **change)
    df = known(spark)
    model = pooled.fit(df, CFG, 7, growth, boosted=False)
    table, _ = rows_of(df)
    weights_seen = set()
    for t, tree in enumerate(model.trees):
        a, b = trees.bag_constants(growth.seed, t)
        rows = []
        for codes, z, key in table:
            u, w, share = (a * key + b) % trees.HASH, 0, math.exp(-1)
            upto = share
            while w < 9 and u >= int(upto * trees.HASH):
                w += 1
                share /= w
                upto += share
            weights_seen.add(w)
            if w:
                rows.append((codes, w, z * w))
        same(tree, grow(rows, growth, 1e6, False, lambda g, w: g / w, t))
    assert weights_seen >= {0, 1, 2, 3}


@pytest.mark.parametrize("boosted", [True, False])
def test_trees_do_not_depend_on_partitions_or_passes(spark, boosted, monkeypatch):
    growth = GROWTH if boosted else FOREST

    def fitted(parts):
        return [(t.feature.tolist(), t.bin.tolist(), t.value.tolist()) for t in pooled.fit(known(spark, parts), CFG, 7, growth, boosted).trees]

    one = fitted(1)
    assert fitted(7) == one
    monkeypatch.setattr(trees, "BLOCK", 16)
    monkeypatch.setattr(trees, "REFRESH", 1)
    monkeypatch.setattr(trees, "CELLS", 1)
    assert fitted(40) == one


def test_bags_are_poisson():
    keys = np.random.default_rng(1).integers(0, trees.HASH, 200_000)
    weights = trees.bag_weights(keys, FOREST, 3, bagged=True)
    share = np.bincount(weights, minlength=6)[:6] / len(keys)
    assert share == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(6)], abs=0.005)
    other = trees.bag_weights(keys, FOREST, 4, bagged=True)
    assert abs(np.corrcoef(weights, other)[0, 1]) < 0.01


def test_series_with_values_that_are_not_finite_take_no_part(spark):
    rows = dense("2024-07-01", 30) + dense("2024-07-01", 30, city="x", value=lambda i: float("inf") if i == 4 else 1.0)
    arrays = series.series_arrays(series.prepare_series(inputs(spark, rows), CFG), CFG)
    entry = {"gbt": {"model": "gbt", "params": {"trees": 2, "depth": 2}}}
    found = roster.forecast_series(arrays, CFG, entry, "full")
    assert {r["city"] for r in found.collect()} == {"B1"}


def test_negative_and_zero_series(spark):
    rows = dense("2024-07-01", 30, value=lambda i: (-1.0) ** i * (i + 1)) + dense("2024-07-01", 30, city="z", value=lambda i: 0.0)
    arrays = series.series_arrays(series.prepare_series(inputs(spark, rows), CFG), CFG)
    for model in ("gbt", "random_forest"):
        entry = {model: {"model": model, "params": {"trees": 2, "depth": 2}}}
        assert roster.forecast_series(arrays, CFG, entry, "full").count() == 18


@pytest.mark.parametrize("bad", [{"trees": 0}, {"depth": 0}, {"row_share": 0}, {"column_share": 2}, {"l2": -1}])
def test_growth_rejects(bad):
    with pytest.raises(ValueError):
        trees.Growth(**bad)


def test_tree_table(spark):
    df = known(spark)
    model = pooled.fit(df, CFG, 7, FOREST, boosted=False)
    table = pooled.tree_table(df, model).collect()
    assert len(table) == sum((t.feature >= 0).sum() for t in model.trees) and min(r["gain"] for r in table) > 0
    assert pooled.tree_table(df, None).count() == 0


@pytest.mark.parametrize("boosted", [True, False])
def test_one_block_takes_few_jobs(spark, boosted):
    """As many trees again need no more jobs; a level or a tree of one block is no job of its own."""
    context, jobs = spark.sparkContext, []
    for n in (5, 10):
        group = f"fit-{boosted}-{n}"
        context.setJobGroup(group, group)
        model = pooled.fit(known(spark), CFG, 7, replace(GROWTH if boosted else FOREST, trees=n), boosted)
        assert len(model.trees) == n and all(tree.feature[0] >= 0 for tree in model.trees)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(group)))
        context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] <= 15
