"""Regression trees on binned rows, grown level by level with one aggregate per level.

Rows are packed into blocks of numpy bytes, so a pass over them is a few array operations per
block. A pass sums weights and targets by (tree, node, feature, bin) in every task; Spark adds
the sums of a node and chooses its best split where they meet, and only the splits, whose
number is bounded by the model, come back to the driver. Sums are integers, so they are exact
and a tree is the same for any order and partitioning of the rows. Where all rows are one block
its task takes several levels and trees at once, as there is nothing to add.

Two learners use this: second-order boosting (Chen and Guestrin, 2016), a tree at a time on the
gradients of the trees before it, and bagged forests (Breiman, 2001), all trees of a level in
one pass. A row's bag weight comes from a hash of its key and the tree.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.durable import durable, release

# functions that run in tasks travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICRO = 1_000_000  # learned values are whole millionths
GRID = 256  # cells per unit in which values are counted for the cut points
UNIT = float(1 << 20)  # gradients are whole parts of this
BLOCK = 1 << 16  # rows packed together
HASH = 4_294_967_291  # the largest prime below 2 ** 32: keys and their hashes lie below it
CELLS = 1 << 23  # sums a task holds at once; more trees than that take further passes
REFRESH = 10  # trees after which the margins are written anew
WEEKDAYS = 7


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``l1``, ``l2`` and ``gamma`` are those of second-order boosting;
    ``min_weight`` is the least sum of weights of a child."""

    trees: int = 100
    depth: int = 6
    step: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    gamma: float = 0.0
    min_weight: float = 1.0
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 0

    def __post_init__(self):
        if self.trees < 1 or not 1 <= self.depth <= 16:
            raise ValueError("trees must be at least 1, depth 1 to 16")
        if not (0 < self.row_share <= 1 and 0 < self.column_share <= 1):
            raise ValueError("shares of rows and columns must be above 0 and at most 1")
        if min(self.l1, self.l2, self.gamma, self.min_weight) < 0:
            raise ValueError("l1, l2, gamma and min_weight must not be negative")


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2 i + 1 (code <= bin) and 2 i + 2."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n), np.zeros(n))

    def nodes(self, codes: np.ndarray, levels: int) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(levels):
            f = self.feature[at]
            beyond = codes[rows, np.maximum(f, 0)] > self.bin[at]
            at = np.where(f < 0, at, 2 * at + 1 + beyond)
        return at

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(codes, int(len(self.value)).bit_length() - 1)]


@dataclass
class Ensemble:
    """Cut points (cells at which a value's bin begins), a base value and trees."""

    cuts: np.ndarray
    base: float
    trees: list[Tree] = field(default_factory=list)
    mean_of_trees: bool = False

    def predict(self, codes: np.ndarray) -> np.ndarray:
        total = np.zeros(len(codes))
        for tree in self.trees:
            total += tree.predict(codes)
        return self.base + (total / max(1, len(self.trees)) if self.mean_of_trees else total)


def cells_of(values: np.ndarray) -> np.ndarray:
    """The grid cell of each value, by whole millionths."""
    return np.floor(values * MICRO + 0.5).astype(np.int64) * GRID // MICRO


def codes_of(windows: np.ndarray, weekdays: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bins of lag windows (rows, lags) and weekdays."""
    binned = np.searchsorted(cuts, cells_of(windows), side="right")
    return np.column_stack([binned, weekdays]).astype(np.uint8)


def cut_points(values: DataFrame, column: str, bins: int) -> np.ndarray:
    """Cells at which about equal shares of the values begin, from one count by cell.

    Values are at most the days of history times their mean in size, so there are at most a
    grid of that many cells, however many rows.
    """
    micro = F.floor(F.col(column) * MICRO + 0.5)
    counts = values.groupBy(F.floor(micro * GRID / MICRO).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.orderBy("cell").toArrow()
    cell, n = found.column("cell").to_numpy(), found.column("n").to_numpy()
    before = np.cumsum(n) - n
    share = bins * before // max(1, n.sum())
    return cell[1:][np.diff(share) > 0]


def bag_constants(seed: int, tree: int) -> tuple[int, int]:
    """Factor and summand of a tree's hash of row keys, (factor * key + summand) mod HASH."""
    factor, summand = np.random.default_rng([seed, tree]).integers(1, HASH, 2)
    return int(factor), int(summand)


def hashed(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    factor, summand = bag_constants(seed, tree)
    return (keys.astype(np.uint64) * np.uint64(factor) % np.uint64(HASH) + np.uint64(summand)) % np.uint64(HASH)


def poisson_limits() -> list[int]:
    """Hashes below the k-th limit have weight k - 1 at most: Poisson with mean 1."""
    share, limits = 0.0, []
    for k in range(9):
        share += math.exp(-1) / math.factorial(k)
        limits.append(int(share * HASH))
    return limits


def bag_weights(keys: np.ndarray, growth: Growth, tree: int, bagged: bool) -> np.ndarray | None:
    """Weight of each row in a tree: Poisson for bagging, else 1 for a share of the rows.
    None stands for all 1."""
    if not bagged and growth.row_share >= 1:
        return None
    h = hashed(keys, growth.seed, tree)
    if bagged:
        return np.searchsorted(np.array(poisson_limits(), np.uint64), h, side="right")
    return (h < np.uint64(int(growth.row_share * HASH))).astype(np.int64)


def allowed(growth: Growth, features: int, tree: int, node: int) -> np.ndarray:
    """Features that a node may split on."""
    if growth.column_share >= 1:
        return np.ones(features, bool)
    most = max(1, int(growth.column_share * features))
    chosen = np.random.default_rng([growth.seed, tree, node + 1]).permutation(features)[:most]
    return np.isin(np.arange(features), chosen)


def score(g, h, growth: Growth):
    """What a leaf with these sums gains over none (twice, for boosting)."""
    shrunk = np.sign(g) * np.maximum(np.abs(g) - growth.l1, 0.0)
    return shrunk * shrunk / np.where(h + growth.l2 > 0, h + growth.l2, 1.0)


def best_split(weights: np.ndarray, sums: np.ndarray, growth: Growth, may: np.ndarray, boosted: bool):
    """(feature, bin, gain, left weight, left sum) from (features, bins) histograms.

    Of equal gains the first feature's first bin wins; feature -1 says that no split gains.
    """
    total_w, total_g = weights[0].sum(), sums[0].sum()
    left_w, left_g = np.cumsum(weights, axis=1)[:, :-1], np.cumsum(sums, axis=1)[:, :-1]
    right_w, right_g = total_w - left_w, total_g - left_g
    whole = score(total_g, total_w, growth)
    gain = score(left_g, left_w, growth) + score(right_g, right_w, growth) - whole
    gain = 0.5 * gain - growth.gamma if boosted else gain
    least = max(growth.min_weight, 1e-9)
    gain = np.where((left_w >= least) & (right_w >= least) & may[:, None], gain, -np.inf)
    place = int(np.argmax(gain)) if gain.size else 0
    if not gain.size or gain.flat[place] <= 1e-9 * max(1.0, abs(float(whole))):
        return -1, 0, 0.0, 0.0, 0.0
    feature, at = divmod(place, gain.shape[1])
    return feature, at, float(gain[feature, at]), float(left_w[feature, at]), float(left_g[feature, at])


def pack(rows: DataFrame, lags: int, cuts: np.ndarray) -> DataFrame:
    """Blocks (n, codes, label, keys) of rows (features array, label, key)."""

    def block(windows, labels, keys) -> pa.RecordBatch:
        windows = np.concatenate(windows).reshape(-1, lags + 1)
        codes = codes_of(windows[:, :lags], windows[:, lags], cuts)
        label = np.floor(np.concatenate(labels) * MICRO + 0.5).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([len(label)], pa.int64()), pa.array([codes.tobytes()], pa.binary()),
                pa.array([label.tobytes()], pa.binary()), pa.array([np.concatenate(keys).tobytes()], pa.binary()),
            ],
            names=["n", "codes", "label", "keys"],
        )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], []), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held[0].append(batch.column("features").flatten().to_numpy(zero_copy_only=False))
            held[1].append(batch.column("label").to_numpy(zero_copy_only=False))
            held[2].append(batch.column("key").to_numpy(zero_copy_only=False).astype(np.uint32))
            n += batch.num_rows
            if n >= BLOCK:
                yield block(*held)
                held, n = ([], [], []), 0
        if n:
            yield block(*held)

    kinds = "n long, codes binary, label binary, keys binary"
    return rows.select("features", "label", "key").mapInArrow(packed, kinds)


def _opened(block: dict, features: int):
    codes = np.frombuffer(block["codes"], np.uint8).reshape(-1, features)
    label = np.frombuffer(block["label"], np.int64)
    return codes, label, np.frombuffer(block["keys"], np.uint32)


def _sums(codes, weights, sums, slot, slots, bins):
    """Exact (slots, features, bins) sums: a block's stay below 2 ** 53."""
    features = codes.shape[1]
    place = ((slot[:, None] * features + np.arange(features)) * bins + codes).ravel()
    shape, size = (slots, features, bins), slots * features * bins
    w = np.bincount(place, None if weights is None else np.repeat(weights, features), size)
    g = np.bincount(place, np.repeat(sums, features), size)
    return w.astype(np.int64).reshape(shape), g.astype(np.int64).reshape(shape)


def _tally(blocks: Iterable[dict], growth: Growth, trees: dict[int, Tree], level: int, features: int, bins: int,
           before: Ensemble | None) -> dict[int, list[np.ndarray]]:
    """Per tree the (nodes, features, bins) sums of weights and of targets over these blocks."""
    first, slots = (1 << level) - 1, 1 << level
    boosted = before is not None
    held = {t: [np.zeros((slots, features, bins), np.int64) for _ in range(2)] for t in trees}
    for block in blocks:
        codes, label, keys = _opened(block, features)
        if boosted:
            margin = np.frombuffer(block["margin"])
            for tree in before.trees:
                margin = margin + tree.predict(codes)
            target = np.floor((margin - label / MICRO) * UNIT + 0.5)
        else:
            target = label
        for t, tree in trees.items():
            slot = tree.nodes(codes, level) - first
            weights = bag_weights(keys, growth, t, bagged=not boosted)
            kept = slot >= 0 if weights is None else (slot >= 0) & (weights > 0)
            own = None if weights is None else weights[kept]
            sums = target[kept] if own is None else target[kept] * own
            for total, new in zip(held[t], _sums(codes[kept], own, sums, slot[kept], slots, bins)):
                total += new
    return held


def _choice(t: int, node: int, w: np.ndarray, g: np.ndarray, growth: Growth, boosted: bool) -> tuple:
    """The best split of a node, as a row of _SPLIT, from its whole sums."""
    g = g / (UNIT if boosted else float(MICRO))
    found = best_split(w, g, growth, allowed(growth, len(w), t, node), boosted)
    return (t, node, *found[:3], float(w[0].sum()), float(g[0].sum()), *found[3:])


def grow_level(
    blocks: DataFrame, growth: Growth, trees: dict[int, Tree], level: int, features: int, bins: int,
    before: Ensemble | None = None,
) -> list:
    """The best splits of all nodes of a level of these trees, as rows (tree, node, feature,
    bin, gain, w, g, left_w, left_g).

    With ``before`` the sums are of gradients of squared error after ``before``'s trees, which
    the block's margins do not hold yet; else they are of labels under bag weights.
    """
    first = (1 << level) - 1
    boosted = before is not None

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (block for batch in batches for block in batch.to_pylist())
        for t, (w, g) in _tally(each, growth, trees, level, features, bins, before).items():
            nodes = np.flatnonzero(w.any(axis=(1, 2)))
            if len(nodes):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(nodes), t, np.int32)), pa.array((nodes + first).astype(np.int32)),
                        pa.array([w[i].tobytes() for i in nodes], pa.binary()),
                        pa.array([g[i].tobytes() for i in nodes], pa.binary()),
                    ],
                    names=["tree", "node", "w", "g"],
                )

    def chosen(key: tuple, parts: pa.Table) -> pa.Table:
        t, node = (k.as_py() for k in key)

        def total(name: str) -> np.ndarray:
            high = low = np.zeros((features, bins), np.int64)
            for content in parts.column(name).to_pylist():
                part = np.frombuffer(content, np.int64).reshape(features, bins)
                # in two halves, which no number of tasks makes too large
                high, low = high + (part >> 31), low + (part & 0x7FFFFFFF)
            return high.astype(float) * float(1 << 31) + low

        return _rows([_choice(t, node, total("w"), total("g"), growth, boosted)])

    tasks = blocks.mapInArrow(tallied, "tree int, node int, w binary, g binary")
    return tasks.groupBy("tree", "node").applyInArrow(chosen, _KINDS).collect()


def grow_trees(
    blocks: DataFrame, growth: Growth, trees: Iterable[int], features: int, bins: int, before: Ensemble | None = None,
) -> list:
    """The best splits of all nodes of these trees, as ``grow_level`` gives them level by level,
    where all rows are one block: its sums are whole, so its task goes from level to level, and
    with ``before`` from tree to tree, without a job for each."""
    trees = list(trees)
    boosted = before is not None

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [block for batch in batches for block in batch.to_pylist()]
        done = None if before is None else Ensemble(before.cuts, 0.0, list(before.trees))
        for t in trees:
            tree = Tree.of_depth(growth.depth)
            for level in range(growth.depth):
                (w, g), = _tally(held, growth, {t: tree}, level, features, bins, done).values()
                first = (1 << level) - 1
                splits = [
                    _choice(t, int(i) + first, w[i].astype(float), g[i].astype(float), growth, boosted)
                    for i in np.flatnonzero(w.any(axis=(1, 2)))
                ]
                if splits:
                    yield from _rows(splits).to_batches()
                if not _take([dict(zip(_SPLIT, s)) for s in splits], {t: tree}, _leaf(growth, boosted)):
                    break
            if done is not None:
                done.trees.append(tree)

    return blocks.mapInArrow(grown, _KINDS).collect()


_SPLIT = ("tree", "node", "feature", "bin", "gain", "w", "g", "left_w", "left_g")


_KINDS = "tree int, node int, feature int, bin int, gain double, w double, g double, left_w double, left_g double"


def _rows(splits: list[tuple]) -> pa.Table:
    kinds = [pa.int32()] * 4 + [pa.float64()] * 5
    return pa.table({n: pa.array(v, k) for n, v, k in zip(_SPLIT, zip(*splits), kinds)})


def _leaf(growth: Growth, boosted: bool):
    """The value of a leaf from its sums of targets and of weights."""

    def mean(g: float, w: float) -> float:
        return g / w if w else 0.0

    def step(g: float, w: float) -> float:
        shrunk = math.copysign(max(abs(g) - growth.l1, 0.0), g)
        return -growth.step * shrunk / (w + growth.l2) if w + growth.l2 > 0 else 0.0

    return step if boosted else mean


def _take(splits: list, trees: dict[int, Tree], leaf) -> dict[int, Tree]:
    """Enter splits into the trees, with the values their children have as leaves; returns the
    trees that go on."""
    grown = {}
    for s in splits:
        tree = trees[s["tree"]]
        if s["node"] == 0:
            tree.value[0] = leaf(s["g"], s["w"])
        if s["feature"] < 0:
            continue
        at = s["node"]
        tree.feature[at], tree.bin[at], tree.gain[at] = s["feature"], s["bin"], s["gain"]
        tree.value[2 * at + 1] = leaf(s["left_g"], s["left_w"])
        tree.value[2 * at + 2] = leaf(s["g"] - s["left_g"], s["w"] - s["left_w"])
        grown[s["tree"]] = tree
    return grown


def fit_forest(blocks: DataFrame, growth: Growth, cuts: np.ndarray, features: int, one_block: bool = False) -> Ensemble:
    """Bagged trees; a level of all of them is one pass, and all levels where there is one block."""
    bins = max(len(cuts) + 1, WEEKDAYS)
    forest = [Tree.of_depth(growth.depth) for _ in range(growth.trees)]
    alive = dict(enumerate(forest))
    leaf = _leaf(growth, boosted=False)
    if one_block:
        _take(grow_trees(blocks, growth, alive, features, bins), alive, leaf)
        return Ensemble(cuts, 0.0, forest, mean_of_trees=True)
    for level in range(growth.depth):
        at_once = max(1, CELLS // (2 * features * bins << level))
        grown, order = {}, sorted(alive)
        for start in range(0, len(order), at_once):
            some = {t: alive[t] for t in order[start : start + at_once]}
            splits = grow_level(blocks, growth, some, level, features, bins)
            grown |= _take(splits, some, leaf)
        alive = grown
    return Ensemble(cuts, 0.0, forest, mean_of_trees=True)


def fit_boosted(
    blocks: DataFrame, growth: Growth, cuts: np.ndarray, features: int, base: float, one_block: bool = False
) -> Ensemble:
    """Trees on the gradients of squared error, each shrunk by the step size."""
    bins = max(len(cuts) + 1, WEEKDAYS)
    model, fresh = Ensemble(cuts, base), Ensemble(cuts, 0.0)
    leaf = _leaf(growth, boosted=True)
    with_margins = durable(_margins(blocks, features, Ensemble(cuts, base)))
    for start in range(0, growth.trees, REFRESH):
        some = {t: Tree.of_depth(growth.depth) for t in range(start, min(start + REFRESH, growth.trees))}
        if one_block:
            _take(grow_trees(with_margins, growth, some, features, bins, fresh), some, leaf)
            fresh.trees.extend(some.values())
        else:
            for t, tree in some.items():
                alive = {t: tree}
                for level in range(growth.depth):
                    splits = grow_level(with_margins, growth, alive, level, features, bins, fresh)
                    alive = _take(splits, alive, leaf)
                    if not alive:
                        break
                fresh.trees.append(tree)
        model.trees.extend(some.values())
        if start + REFRESH < growth.trees:
            old, with_margins = with_margins, durable(_margins(with_margins, features, fresh))
            with_margins.count()
            release(old)
            fresh = Ensemble(cuts, 0.0)
    release(with_margins)
    return model


def _margins(blocks: DataFrame, features: int, more: Ensemble) -> DataFrame:
    """Blocks whose margins hold ``more`` as well."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for block in batch.to_pylist():
                codes = np.frombuffer(block["codes"], np.uint8).reshape(-1, features)
                old = np.frombuffer(block["margin"]) if "margin" in block else 0.0
                # tree by tree, as the levels between two refreshes do
                total = old + np.full(len(codes), more.base)
                for tree in more.trees:
                    total = total + tree.predict(codes)
                margins.append(total.tobytes())
            kept = [batch.column(n) for n in ("n", "codes", "label", "keys")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(margins, pa.binary())], names=["n", "codes", "label", "keys", "margin"]
            )

    return blocks.mapInArrow(added, "n long, codes binary, label binary, keys binary, margin binary")


def path_forecaster(model: Ensemble, steps: int, lags: int, freq_days: int):
    """A pandas UDF (values, weekday of the first day ahead) -> forecasts, each step on the ones
    before it; all series of a batch take a step together."""

    def forecast(values: pd.Series, weekday: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        window = np.array([np.asarray(v[-lags:], float) for v in values])
        day = weekday.to_numpy().astype(np.int64)
        path = np.zeros((len(window), steps))
        for step in range(steps):
            codes = codes_of(window, (day + step * freq_days) % WEEKDAYS, model.cuts)
            path[:, step] = model.predict(codes)
            window = np.column_stack([window[:, 1:], path[:, step]])
        return pd.Series(list(path))

    return F.pandas_udf(forecast, "array<double>")
