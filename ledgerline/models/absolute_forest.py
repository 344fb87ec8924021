"""A regression forest that splits by the absolute error and predicts medians.

Trees grow level by level, all together. Features are cut into bins, labels into levels; a level's job counts, for every
open node, feature and bin, how many rows have each label level. Tasks count their own rows, Spark adds the counts up
per node, and the best cut of a node is found from its counts alone, where medians and absolute errors of all cuts are
running sums. No row leaves its task. With no more distinct values than bins and levels the trees are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.numbering import sequence_numbers
from ledgerline.session import written

_CELLS = 2_000_000  # counts that a task holds at a time, at most
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, for draws that depend on a row and a tree only."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def drawn_copies(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a bootstrap sample of the tree holds each row: a Poisson variable of mean one from the row's hash."""
    base = _U((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    uniform = (_mixed(rows.view(_U) ^ _mixed(np.array([base]))[0]) >> _U(11)).astype(float) / 2**53
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(steps, uniform, side="right")


@dataclass
class Tree:
    """Nodes by number; ``feature`` is -1 for a leaf or a node that is still open. A row with a bin up to ``cut`` goes left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left = (np.array(c) for c in (self.feature, self.cut, self.left))
        at = np.zeros(len(bins), np.int64)
        while True:
            moving = feature[at] >= 0
            if not moving.any():
                return at
            here = at[moving]
            right = bins[moving, feature[here]] > cut[here]
            at[moving] = left[here] + right


@dataclass
class Forest:
    features: list[str]
    bounds: list[list[float]]
    trees: list[Tree]

    def predict(self, rows: DataFrame, column: str = "prediction") -> DataFrame:
        """Every row with the mean of the trees' medians; null where a feature is missing."""
        bounds, trees = [np.array(b) for b in self.bounds], self.trees

        @F.pandas_udf("double")
        def mean(*values: pd.Series) -> pd.Series:
            known = np.logical_and.reduce([v.notna().to_numpy() for v in values])
            bins = np.stack([np.searchsorted(b, v.fillna(0).to_numpy(), side="left") for b, v in zip(bounds, values)], axis=1)
            total = sum(np.array(tree.value)[tree.nodes_of(bins)] for tree in trees)
            return pd.Series(np.where(known, total / len(trees), np.nan)).replace({np.nan: None}).astype("Float64")

        return rows.withColumn(column, mean(*[F.col(f).cast("double") for f in self.features]))


def _levels(rows: DataFrame, column: str, most: int) -> list[float]:
    """The distinct values of a column in order, or ``most`` quantiles if there are more. Quantiles are values at places in
    the order of all rows, so they do not depend on the partitions."""
    distinct = [r[0] for r in rows.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(distinct) <= most:
        return distinct
    placed = sequence_numbers(rows.select(column), [column], "_place", unique=True, total="_all")
    cell = F.floor(F.col("_place") * most / F.col("_all")) != F.floor((F.col("_place") - 1) * most / F.col("_all"))
    return sorted({r[0] for r in placed.where(cell).select(column).collect()})  # ``most`` rows


def _binned(rows: DataFrame, bounds: list[list[float]], middles: list[float], features: Sequence[str], label: str) -> DataFrame:
    """``row`` (a hash), ``bins`` (an array, one per feature) and ``level``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            bins = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(bounds, columns[:-1])], axis=1).astype(np.int32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(bins.ravel()), max(bins.shape[1], 1)).cast(pa.list_(pa.int32()))
            level = pa.array(np.searchsorted(middles, columns[-1], side="left").astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, level], ["row", "bins", "level"])

    values = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([*features, label])]
    return rows.select("row", *values).mapInArrow(run, "row long, bins array<int>, level int")


def _candidates(tree: int, node: int, features: int, take: int, seed: int) -> np.ndarray:
    """The features that a node may use, drawn by tree and node."""
    if take >= features:
        return np.arange(features)
    return np.sort(np.random.default_rng([seed, tree, node]).choice(features, take, replace=False))


def best_cut(counts: np.ndarray, levels: np.ndarray, min_leaf: int) -> tuple[float, int] | None:
    """The smallest absolute error left by a cut of one feature, and the last bin that goes left; from counts per bin and
    label level. None if no cut leaves ``min_leaf`` rows on both sides."""
    below = np.cumsum(counts, axis=0)[:-1]
    total = counts.sum(axis=0)
    sides = below.sum(axis=1), (total - below).sum(axis=1)
    allowed = (sides[0] >= min_leaf) & (sides[1] >= min_leaf)
    if not allowed.any():
        return None
    errors = absolute_error(below, levels) + absolute_error(total - below, levels)
    errors = np.where(allowed, errors, np.inf)
    at = int(errors.argmin())
    return float(errors[at]), at


def absolute_error(counts: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Per row of counts by label level: the sum of distances from the median."""
    running, sums = np.cumsum(counts, axis=1), np.cumsum(counts * levels, axis=1)
    n = running[:, -1:]
    middle = (running * 2 >= n).argmax(axis=1)
    pick = np.arange(len(counts))
    up_to, sum_up_to = running[pick, middle], sums[pick, middle]
    return levels[middle] * (2 * up_to - n[:, 0]) + sums[:, -1] - 2 * sum_up_to


def median(counts: np.ndarray, levels: np.ndarray) -> float:
    """The median of one row of counts; the middle of the two middle values if they differ."""
    running = np.cumsum(counts)
    low, high = (int((running * 2 >= running[-1]).argmax()), int((running * 2 > running[-1]).argmax()))
    return float((levels[low] + levels[high]) / 2)


def fit_forest(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    num_trees: int = 100,
    max_depth: int = 8,
    min_leaf: int = 1,
    take: int | None = None,
    bins: int = 32,
    label_levels: int = 128,
    bootstrap: bool = True,
    seed: int = 0,
) -> Forest:
    """Grow ``num_trees`` trees on the rows without missing values; ``take`` features are tried at a node (all by default).

    Rows equal in all columns are drawn alike. An empty frame gives trees that predict 0.
    """
    spark, features = rows.sparkSession, list(features)
    known = rows.select(*[F.col(c).cast("double").alias(c) for c in (*features, label)]).na.drop()
    known = written(known.withColumn("row", F.xxhash64(*features, label)), "forest-rows")
    values = [_levels(known, f, bins) for f in features]
    bounds = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]
    levels = np.array(_levels(known, label, label_levels) or [0.0])
    middles = ((levels[1:] + levels[:-1]) / 2).tolist()
    binned = written(_binned(known, bounds, middles, features, label), "forest-bins")
    trees = [Tree() for _ in range(num_trees)]
    opened = {t: [0] for t in range(num_trees)}
    take = min(take or len(features), len(features))
    width = [len(b) + 1 for b in bounds]
    for depth in range(max_depth + 1):
        if not opened:
            break
        following: dict[int, list[int]] = {}
        for group in _groups(opened, take * max(width, default=1) * len(levels)):
            found = _level(spark, binned, trees, group, levels, width, take, min_leaf, depth < max_depth, bootstrap, seed)
            for tree, node, feature, cut, value in found:
                grown = trees[tree]
                grown.value[node] = value
                if feature >= 0:
                    grown.feature[node], grown.cut[node], grown.left[node] = feature, cut, len(grown.feature)
                    for column, start in ((grown.feature, -1), (grown.cut, 0), (grown.left, 0), (grown.value, value)):
                        column.extend([start] * 2)
                    following.setdefault(tree, []).extend([grown.left[node], grown.left[node] + 1])
        opened = following
    return Forest(features, bounds, trees)


def _groups(opened: dict[int, list[int]], cells: int) -> Iterator[dict[int, list[int]]]:
    """Open nodes in groups whose counts fit into a task."""
    group, held = {}, 0
    for tree, nodes in opened.items():
        for node in nodes:
            if held and held + cells > _CELLS:
                yield group
                group, held = {}, 0
            group.setdefault(tree, []).append(node)
            held += cells
    if group:
        yield group


def _level(
    spark: SparkSession,
    binned: DataFrame,
    trees: list[Tree],
    group: dict[int, list[int]],
    levels: np.ndarray,
    width: list[int],
    take: int,
    min_leaf: int,
    may_split: bool,
    bootstrap: bool,
    seed: int,
) -> list[tuple[int, int, int, int, float]]:
    """``(tree, node, feature, cut, median)`` of the open nodes; feature -1 where a node stays a leaf."""
    used = {t: trees[t] for t in group}
    tried = {(t, n): _candidates(t, n, len(width), take, seed) for t, nodes in group.items() for n in nodes}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column(0).to_numpy(zero_copy_only=False)
            bins = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            level = batch.column(2).to_numpy(zero_copy_only=False)
            for t, nodes in group.items():
                copies = drawn_copies(row, t, seed) if bootstrap else np.ones(len(row), np.int64)
                at = used[t].nodes_of(bins)
                for node in nodes:
                    mine = np.flatnonzero((at == node) & (copies > 0))
                    if len(mine):
                        for f in tried[t, node]:
                            place = bins[mine, f].astype(np.int64) * len(levels) + level[mine]
                            size = width[f] * len(levels)
                            here = np.bincount(place, weights=copies[mine], minlength=size).astype(np.int64)
                            key = (t, node, int(f))
                            sums[key] = sums[key] + here if key in sums else here
        for (t, node, f), here in sums.items():
            there = np.flatnonzero(here)
            same = [pa.array(np.full(len(there), v, np.int32)) for v in (t, node, f)]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(there.astype(np.int64)), pa.array(here[there])], ["tree", "node", "feature", "place", "n"]
            )

    def chosen(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        best, totals = None, None
        for f, of in cells.groupby("feature", sort=True):
            counts = np.zeros(width[f] * len(levels), np.int64)
            counts[of["place"].to_numpy()] = of["n"].to_numpy()
            counts = counts.reshape(width[f], len(levels))
            totals = counts.sum(axis=0)
            cut = best_cut(counts, levels, min_leaf) if may_split else None
            if cut is not None and (best is None or cut[0] < best[0] - 1e-9):
                best = (cut[0], int(f), cut[1])
        now = absolute_error(totals[None, :], levels)[0]
        feature, at = (best[1], best[2]) if best is not None and best[0] < now - 1e-9 else (-1, 0)
        return pd.DataFrame([[*key, feature, at, median(totals, levels)]], columns=["tree", "node", "feature", "cut", "value"])

    cells = binned.mapInArrow(counted, "tree int, node int, feature int, place long, n long")
    summed = cells.groupBy("tree", "node", "feature", "place").agg(F.sum("n").alias("n"))
    # A group is one node's counts: features x bins x levels cells at most.
    cuts = summed.groupBy("tree", "node").applyInPandas(chosen, "tree int, node int, feature int, cut int, value double")
    return [tuple(r) for r in cuts.orderBy("tree", "node").collect()]  # one row per open node
