"""Extremely randomised trees for feature importance.

Each tree sees every row. A node draws features in random order and looks at the first ``sqrt(features)`` that vary in
it; each gets one threshold, uniform between the node's least and greatest value, and the best Gini gain splits the
node, down to pure leaves. Draws are hashes of (seed, tree, node, feature): the trees are the same whatever the
partitioning, and any program that uses the same hash grows them.

Two phases. While a node holds more than ``MOST_BYTES``, it is split level by level from two aggregates over all
tasks: its range of every feature and class counts, then class counts left of each drawn threshold. Smaller
nodes are grown to the end inside tasks, side by side: a group is a few trees over one node's rows, so what a task holds is bounded.
Trees that stay undivided share their rows, so the table moves once a group; a divided tree moves it once by itself.
Values that are all exact in 32 bits move and are held in 32 bits. Only sums of gains leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from motifspark.session import materialise

_GOLD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Values (rows x features) of a node that one task grows by itself, in bytes.
MOST_BYTES = 256 << 20
#: Rows of a level that are split at a time.
BLOCK = 1 << 16
#: (tree, node, feature) entries that a level of large nodes brings to the driver at a time.
MOST_ENTRIES = 2_000_000


def mixed(*parts, after=0) -> np.ndarray:
    """A 64-bit hash of whole numbers, element by element (splitmix steps); ``after``: the hash of the parts before them."""
    out = np.asarray(after, np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            z = (out ^ np.asarray(p).astype(np.uint64)) + _GOLD
            z = (z ^ (z >> np.uint64(30))) * _M1
            z = (z ^ (z >> np.uint64(27))) * _M2
            out = z ^ (z >> np.uint64(31))
    return out


def children(seed: int, tree, node) -> tuple[np.ndarray, np.ndarray]:
    return mixed(seed, tree, node, 1), mixed(seed, tree, node, 2)


def draws(seed: int, tree, node, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes x features): rank keys of the features and uniforms of their thresholds."""
    tree, node, f = np.asarray(tree, np.uint64)[:, None], np.asarray(node, np.uint64)[:, None], np.arange(features, dtype=np.uint64)[None, :]
    return mixed(seed, tree, node, f, 3), (mixed(seed, tree, node, f, 4) >> np.uint64(11)) * 2.0 ** -53


def candidates(seed: int, tree, node, low: np.ndarray, high: np.ndarray, look: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes x look): the drawn features of each node, -1 where fewer vary, and their thresholds (left: at most that)."""
    key, u = draws(seed, tree, node, low.shape[1])
    varies = high > low
    key = np.where(varies, key >> np.uint64(1), key | np.uint64(1 << 63))  # features that vary come first
    feature = np.argsort(key, axis=1, kind="stable")[:, :look]
    take = lambda a: np.take_along_axis(a, feature, 1)
    cut = take(low) + take(u) * (take(high) - take(low))
    cut = np.where(cut >= take(high), take(low), cut)
    return np.where(take(varies), feature, -1), cut


def gini(counts: np.ndarray) -> np.ndarray:
    """Gini impurity times the number of rows, over the last axis."""
    n = counts.sum(-1)
    return n - (counts.astype(float) ** 2).sum(-1) / np.maximum(n, 1)


def best_splits(counts: np.ndarray, left: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column of the best candidate, its gain) per node; -1 for a pure node or one where nothing varies. ``left``: (nodes, look, classes)."""
    gain = gini(counts)[:, None] - gini(left) - gini(counts[:, None, :] - left)
    gain = np.where(feature >= 0, np.round(gain, 9), -np.inf)
    best = np.argmax(gain, 1)  # the first drawn of equals
    found = np.take_along_axis(gain, best[:, None], 1)[:, 0]
    best[(found == -np.inf) | ((counts > 0).sum(1) < 2)] = -1
    return best, found


def _down(cut: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The greatest values of ``kind`` that are at most ``cut``: they divide values of that kind as ``cut`` does."""
    near = cut.astype(kind)
    return np.where(near > cut, np.nextafter(near, kind.type(-np.inf)), near)


class _Level:
    """Rows of some nodes, node after node: which features each node looks at, and how they divide its rows."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, starts: np.ndarray, size: np.ndarray):
        self.flat, self.width, self.rows, self.starts, self.size = x.reshape(-1), x.shape[1], rows, starts, size

    def values(self, feature: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(features a node, rows): the values of each node's own features, and where its rows start; of ``some`` nodes only."""
        if some is None:
            size, starts, rows = self.size, self.starts, self.rows
        else:
            size = self.size[some]
            starts = np.cumsum(size) - size
            rows = self.rows[np.arange(size.sum()) + np.repeat(self.starts[some] - starts, size)]
        at = rows * self.width
        return np.stack([self.flat[at + np.repeat(f, size)] for f in feature.T]), starts

    def look(self, seed: int, tree: int, nodes: np.ndarray, look: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, cut) as ``candidates`` gives them, and the features' values. Only features that come up in the drawn order are read."""
        own = mixed(seed, tree, nodes)
        key = mixed(np.arange(self.width, dtype=np.uint64)[None, :], 3, after=own[:, None]) >> np.uint64(1)
        first = np.sort(np.argpartition(key, look - 1, axis=1)[:, :look], axis=1) if look < self.width else np.broadcast_to(np.arange(self.width), key.shape)
        first = np.take_along_axis(first, np.argsort(np.take_along_axis(key, first, 1), axis=1, kind="stable"), 1)
        found, starts = self.values(first)
        low, high = (f.reduceat(found, starts, axis=1).T.astype(np.float64) for f in (np.minimum, np.maximum))
        feature, open_ = first.copy(), np.flatnonzero(~(high > low).all(1))
        if len(open_):   # some of the first do not vary: the next ones in order, a few at a time
            order = np.argsort(key[open_], axis=1, kind="stable")
            have, some, lo, hi = np.zeros(len(open_), np.int64), np.arange(len(open_)), low[open_], high[open_]
            feature[open_] = -1
            for at in range(0, self.width, look):
                part = order[some, at:at + look]
                if at:
                    got, begin = self.values(part, open_[some])
                    lo, hi = (f.reduceat(got, begin, axis=1).T.astype(np.float64) for f in (np.minimum, np.maximum))
                place = have[some][:, None] + np.cumsum(hi > lo, axis=1) - 1
                i, j = np.nonzero((hi > lo) & (place < look))
                to = open_[some[i]], place[i, j]
                feature[to], low[to], high[to] = part[i, j], lo[i, j], hi[i, j]
                have[some] = np.minimum(look, place[:, -1] + 1)
                some = some[have[some] < look]
                if not len(some):
                    break
            found = self.values(np.maximum(feature, 0))[0]
        u = (mixed(np.maximum(feature, 0), 4, after=own[:, None]) >> np.uint64(11)) * 2.0 ** -53
        cut = low + u * (high - low)
        return feature, np.where(cut >= high, low, cut), found


def grow(x: np.ndarray, y: np.ndarray, classes: int, seed: int, tree: int, node: int, look: int, block: int = BLOCK) -> np.ndarray:
    """Sum of gains (in rows) per feature of the subtree under ``node`` over these rows, level by level over some nodes at a time."""
    gains = np.zeros(x.shape[1])
    todo = [(np.ascontiguousarray(x), np.asarray(y), np.arange(len(x)), np.array([0]), np.array([node], np.uint64))] if len(x) else []
    while todo:
        x, y, rows, starts, nodes = todo.pop()
        if 4 * len(rows) <= len(x):   # few of the rows are left: side by side they are read faster
            x, y, rows = x[rows], y[rows], np.arange(len(rows))
        is_class = [(y[rows] == c).astype(np.int32) for c in range(classes)]
        counts = np.stack([np.add.reduceat(c, starts) for c in is_class], 1)
        size = np.diff(np.append(starts, len(rows)))
        mixed_ = (counts > 0).sum(1) > 1  # pure nodes are leaves
        if not mixed_.all():
            keep = np.repeat(mixed_, size)
            rows, counts, size, nodes, is_class = rows[keep], counts[mixed_], size[mixed_], nodes[mixed_], [c[keep] for c in is_class]
            if not len(rows):
                continue
            starts = np.cumsum(size) - size
        feature, cut, own = _Level(x, rows, starts, size).look(seed, tree, nodes, look)
        cut = _down(cut, own.dtype)
        left, is_left = np.empty((len(nodes), feature.shape[1], classes), np.int64), np.empty(own.shape, bool)
        for j in range(len(own)):
            np.less_equal(own[j], np.repeat(cut[:, j], size), out=is_left[j])
            for c in range(classes):
                left[:, j, c] = np.add.reduceat(is_class[c] * is_left[j], starts)
        best, gain = best_splits(counts, left, feature)
        split = best >= 0
        np.add.at(gains, feature[split, best[split]], gain[split])
        if not split.any():
            continue
        goes = np.repeat(split, size)
        side = ~is_left[np.repeat(np.maximum(best, 0), size), np.arange(len(rows))][goes]
        rows, size, nodes = rows[goes], size[split], nodes[split]
        starts = np.cumsum(size) - size
        # rows of a node that go left before those that go right, in their order
        right = np.cumsum(side)
        n_right = np.add.reduceat(side.astype(np.int64), starts)
        before = right - side - np.repeat(np.cumsum(n_right) - n_right, size)
        ordered = np.empty_like(rows)
        ordered[np.where(side, np.repeat(starts + size - n_right, size) + before, np.arange(len(rows)) - before)] = rows
        rows, starts = ordered, np.stack([starts, starts + size - n_right], 1).ravel()   # both sides have rows: the feature varies
        nodes = np.stack(children(seed, np.full(len(nodes), tree), nodes), 1).ravel()
        # the next level in blocks of whole nodes, so that what a level needs beside the rows is bounded
        first = np.flatnonzero(np.diff(starts // block, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(starts)), strict=True):
            end = starts[b] if b < len(starts) else len(rows)
            todo.append((x, y, rows[starts[a]:end], starts[a:b] - starts[a], nodes[a:b]))
    return gains


@dataclass
class _Top:
    """The large nodes of a tree that are split already: id -> (feature, threshold)."""

    splits: dict[int, tuple[int, float]]

    def place(self, x: np.ndarray, seed: int, tree: int) -> np.ndarray:
        """Node of each row."""
        node = np.zeros(len(x), np.uint64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if at in self.splits and len(rows):
                f, cut = self.splits[at]
                go = x[rows, f] <= np.float64(cut)  # in 64 bits, however the values are held
                lo, hi = (int(c) for c in children(seed, tree, np.uint64(at)))
                todo += [(lo, rows[go]), (hi, rows[~go])]
            else:
                node[rows] = at
        return node


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    return x, batch.column(1).to_numpy()


def _signed(x: int) -> int:
    return int(x) - (1 << 64) if int(x) >> 63 else int(x)


def _split_large(data: DataFrame, n_features: int, classes: int, seed: int, trees: range, look: int, most_rows: int, n: int) -> tuple[dict[int, _Top], dict[int, np.ndarray]]:
    """Split every node of ``trees`` with more than ``most_rows`` rows -> (tops, gains per tree)."""
    tops, gains = {t: _Top({}) for t in trees}, {t: np.zeros(n_features) for t in trees}
    active = {(t, 0) for t in trees} if n > most_rows else set()
    while active:
        def ranges(batches: Iterator[pa.RecordBatch], active=active) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[int, int], list] = {}
            for batch in batches:
                x, y = _numbers(batch)
                for t in sorted({t for t, _ in active}):
                    node = tops[t].place(x, seed, t)
                    for at in np.unique(node).tolist():
                        if (t, at) in active:
                            own = x[node == at]
                            low, high, counts = own.min(0), own.max(0), np.bincount(y[node == at], minlength=classes)
                            if (t, at) in found:
                                was = found[t, at]
                                low, high, counts = np.minimum(low, was[0]), np.maximum(high, was[1]), counts + was[2]
                            found[t, at] = [low, high, counts]
            for (t, at), (low, high, counts) in found.items():
                k = max(n_features, classes)
                pad = lambda a: np.concatenate([a.astype(float), np.zeros(k - len(a))])
                yield pa.RecordBatch.from_arrays([pa.array([t] * k, pa.int32()), pa.array([_signed(at)] * k, pa.int64()), pa.array(range(k), pa.int32()), pa.array(pad(low)), pa.array(pad(high)),
                                                  pa.array(pad(counts).astype(np.int64))], ["tree", "node", "i", "low", "high", "n"])

        k = max(n_features, classes)
        rows = data.mapInArrow(ranges, "tree int, node long, i int, low double, high double, n long").groupBy("tree", "node", "i").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()  # large nodes of these trees x features
        keys = sorted({(r.tree, r.node) for r in rows})
        at = {key: i for i, key in enumerate(keys)}
        low, high, counts = np.zeros((len(keys), k)), np.zeros((len(keys), k)), np.zeros((len(keys), k), np.int64)
        for r in rows:
            j = at[r.tree, r.node]
            low[j, r.i], high[j, r.i], counts[j, r.i] = r.low, r.high, r.n
        counts = counts[:, :classes]
        tree, node = np.array([t for t, _ in keys]), np.array([a for _, a in keys], np.int64).view(np.uint64)
        feature, cut = candidates(seed, tree, node, low[:, :n_features], high[:, :n_features], look)
        place = {(t, int(a)): i for i, (t, a) in enumerate(zip(tree.tolist(), node.tolist(), strict=True))}

        def lefts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(keys), feature.shape[1], classes), np.int64)
            for batch in batches:
                x, y = _numbers(batch)
                for t in np.unique(tree).tolist():
                    mine = tops[t].place(x, seed, t)
                    for a in np.unique(mine).tolist():
                        if (i := place.get((t, a))) is not None:
                            rows_ = mine == a
                            go = x[rows_][:, np.maximum(feature[i], 0)] <= cut[i]
                            total[i] += go.T.astype(np.int64) @ np.eye(classes, dtype=np.int64)[y[rows_]]
            i, j, c = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([*(pa.array(v.astype(np.int32)) for v in (i, j, c)), pa.array(total[i, j, c])], ["i", "j", "c", "n"])

        left = np.zeros((len(keys), feature.shape[1], classes), np.int64)
        for r in data.mapInArrow(lefts, "i int, j int, c int, n long").groupBy("i", "j", "c").agg(F.sum("n").alias("n")).collect():
            left[r.i, r.j, r.c] = r.n
        best, gain = best_splits(counts, left, feature)
        active = set()
        for i, (t, a) in enumerate(zip(tree.tolist(), node.tolist(), strict=True)):
            if best[i] >= 0:
                f = int(feature[i, best[i]])
                tops[t].splits[int(a)] = (f, float(cut[i, best[i]]))
                gains[t][f] += gain[i]
                n_left = int(left[i, best[i]].sum())
                for child, size in zip(children(seed, t, np.uint64(a)), (n_left, int(counts[i].sum()) - n_left), strict=True):
                    if size > most_rows:
                        active.add((t, int(child)))
    return tops, gains


def _dealer(tops: dict[int, _Top], seed: int, groups: int) -> Callable:
    """Rows to the groups that need them: (-1 - group, 0) for undivided trees, (tree, node) for the others."""
    start = min(tops)
    whole = sorted({(t - start) % groups for t in tops if not tops[t].splits})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = _numbers(batch)
            dealt = [(-1 - g, np.zeros(len(batch), np.int64)) for g in whole]
            dealt += [(t, tops[t].place(x, seed, t).view(np.int64)) for t in tops if tops[t].splits]
            for t, node in dealt:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), t, np.int32)), pa.array(node), *batch.columns], ["tree", "node", "x", "y"])

    return run


def _finisher(trees: range, groups: int, classes: int, seed: int, look: int) -> Callable:
    """A group's rows -> (tree, gains) of the subtrees that grow from them."""
    def run(key, table):
        t, node = key[0].as_py(), key[1].as_py()
        n, y = table.num_rows, table.column("y").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        del table
        own = [i for i in trees if (i - trees.start) % groups == -1 - t] if t < 0 else [t]
        made = [grow(x, y, classes, seed, i, node & ((1 << 64) - 1), look) for i in own]
        return pa.table({"tree": pa.array(own, pa.int32()), "gains": pa.array([g.tolist() for g in made], pa.list_(pa.float64()))})

    return run


def importances(df: DataFrame, feature_cols: list[str], label_col: str = "CLASS", n_trees: int = 500, seed: int = 0, most_values: int | None = None,
                most_entries: int = MOST_ENTRIES) -> np.ndarray:
    """Mean over the trees of each feature's share of the tree's gains; sums to 1 (all zero if no tree splits).

    Null and non-finite values count as 0, rows without label are left out. Any number of classes that a driver can
    list; a table of one class or without rows splits nowhere.
    """
    names, f = list(feature_cols), len(feature_cols)
    number = lambda c: F.coalesce(F.when(F.abs(F.col(f"`{c}`").cast("double")) < float("inf"), F.col(f"`{c}`").cast("double")), F.lit(0.0))
    rows = df.where(F.col(label_col).isNotNull())
    labels = sorted(r[0] for r in rows.select(label_col).distinct().collect())  # classes
    if len(labels) < 2 or not names:
        return np.zeros(f)
    label = F.lit(None).cast("int")
    for i, v in enumerate(labels):
        label = F.when(F.col(label_col) == F.lit(v), F.lit(i)).otherwise(label)
    exact = rows.agg(F.min(reduce(and_, [number(c).cast("float").cast("double") == number(c) for c in names])).alias("exact")).first()[0]
    kind, width = ("float", 4) if exact else ("double", 8)
    most_values = most_values or MOST_BYTES // width
    data = materialise(rows.select(F.array(*[number(c).cast(kind) for c in names]).alias("x"), label.alias("y")), "importance rows")
    n, look, classes = data.count(), max(1, int(math.sqrt(f))), len(labels)
    most_rows = max(1, most_values // f)
    at_a_time = n_trees if n <= most_rows else max(1, min(n_trees, most_entries // (2 * f * -(-n // most_rows))))
    sums, split = np.zeros(f), 0
    spark = df.sparkSession
    for start in range(0, n_trees, at_a_time):
        trees = range(start, min(n_trees, start + at_a_time))
        tops, gains = _split_large(data, f, classes, seed, trees, look, most_rows, n)
        # a group: one node's rows and the trees that grow from them; undivided trees share their rows, a few trees a group
        groups = min(len(trees), 4 * max(1, spark.sparkContext.defaultParallelism))

        dealt = data.mapInArrow(_dealer(tops, seed, groups), f"tree int, node long, x array<{kind}>, y int")
        # a number of partitions of its own: few bytes, but seconds of work in each group
        parts = max(4 * groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
        per_tree = dealt.repartition(parts, "tree", "node").groupBy("tree", "node").applyInArrow(_finisher(trees, groups, classes, seed, look), "tree int, gains array<double>")
        per_tree = per_tree.select("tree", F.posexplode("gains").alias("i", "g")).groupBy("tree", "i").agg(F.sum("g").alias("g")).collect()  # trees x features
        for r in per_tree:
            gains[r.tree][r.i] += r.g
        for g in gains.values():
            if g.sum() > 0:
                sums, split = sums + g / g.sum(), split + 1
    return sums / split if split else sums
