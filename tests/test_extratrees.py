"""Extremely randomised trees against a recursive brute force with the same draws."""

import math

import numpy as np
import pytest

from motifspark.operators import extratrees as ET
from motifspark.operators.importance import feature_importance


def brute(x, y, seed, tree, look):
    """One tree, node by node: plain recursion over Python lists."""
    gains = [0.0] * x.shape[1]
    classes = int(y.max()) + 1

    def impurity(ys):
        return len(ys) - sum(sum(v == c for v in ys) ** 2 for c in range(classes)) / len(ys) if len(ys) else 0.0

    def split(rows, node):
        ys = [int(y[i]) for i in rows]
        if len(set(ys)) < 2:
            return
        key, u = (a[0] for a in ET.draws(seed, [tree], [node], x.shape[1]))
        best = None
        varying = [f for f in range(x.shape[1]) if len({x[i, f] for i in rows}) > 1]
        for f in sorted(varying, key=lambda f: (int(key[f]) >> 1, f))[:look]:
            low, high = min(x[i, f] for i in rows), max(x[i, f] for i in rows)
            cut = low + float(u[f]) * (high - low)
            cut = low if cut >= high else cut
            left, right = [i for i in rows if x[i, f] <= cut], [i for i in rows if x[i, f] > cut]
            gain = round(impurity(ys) - impurity([int(y[i]) for i in left]) - impurity([int(y[i]) for i in right]), 9)
            if best is None or gain > best[0]:
                best = (gain, f, left, right)
        if best:
            gains[best[1]] += best[0]
            lo, hi = (int(c) for c in ET.children(seed, tree, np.uint64(node)))
            split(best[2], lo)
            split(best[3], hi)

    split(list(range(len(y))), 0)
    return np.array(gains)


def table(n=180, f=7, seed=1):
    r = np.random.default_rng(seed)
    x = np.round(r.standard_normal((n, f)), 1)
    x[:, 3] = 5.0  # constant
    x[:, 4] = x[:, 4] > 0  # two values
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * r.standard_normal(n) > 0).astype(int)
    y[r.random(n) < 0.05] = 2
    return x, y


def test_local_growth_equals_brute_force():
    x, y = table()
    for tree in range(6):
        assert np.allclose(ET.grow(x, y, 3, 9, tree, 0, 2), brute(x, y, 9, tree, 2), atol=1e-6)


@pytest.mark.parametrize("how", [{}, {"most_values": 7 * 40}, {"most_values": 7 * 40, "most_entries": 300}])
def test_importances_equal_brute_force(spark, how):
    """Whether whole trees grow in tasks or their large nodes are split from aggregates over all tasks."""
    x, y = table()
    df = spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(x, y, strict=True)], ", ".join(f"f{i} double" for i in range(7)) + ", CLASS int").repartition(5)
    got = ET.importances(df, [f"f{i}" for i in range(7)], n_trees=8, seed=3, **how)
    want = [brute(x, y, 3, t, int(math.sqrt(7))) for t in range(8)]
    assert np.allclose(got, sum(g / g.sum() for g in want) / 8, atol=1e-9)
    assert got[3] == 0 and abs(got.sum() - 1) < 1e-12 and got[0] == max(got)


def test_importance_edges(spark):
    kinds = "a double, b double, CLASS int"
    one = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 1.0, 0)], kinds)
    assert [r.importance for r in feature_importance(one, ["a", "b"], n_trees=3).collect()] == [0.0, 0.0]
    assert [r.importance for r in feature_importance(one.limit(0), ["a", "b"], n_trees=3).collect()] == [0.0, 0.0]
    odd = spark.createDataFrame([(None, 1.0, 0), (float("nan"), 2.0, 1), (float("inf"), 1.0, None), (1.0, 1.0, 1), (1.0, 1.0, 0)], kinds)
    got = {r.feature: r.importance for r in feature_importance(odd, ["a", "b"], n_trees=20).collect()}
    assert abs(sum(got.values()) - 1) < 1e-9 and all(v > 0 for v in got.values())


def test_growth_in_blocks_and_in_32_bits():
    """Levels in blocks of nodes give the same gains, and 32-bit values the same trees as 64-bit ones (thresholds stay in 64)."""
    x, y = table()
    x = x.astype(np.float32)
    for tree in range(4):
        want = ET.grow(x.astype(float), y, 3, 9, tree, 0, 2)
        assert np.allclose(ET.grow(x, y, 3, 9, tree, 0, 2, block=16), want, atol=1e-9)
    top = ET._Top({0: (0, 0.1)})
    assert (top.place(np.array([[0.1]], np.float32), 1, 1) == ET._Top({0: (0, 0.1)}).place(np.array([[np.float64(np.float32(0.1))]]), 1, 1)).all()


@pytest.mark.parametrize("cells", ["float", "double"])
def test_undivided_trees_share_their_rows(spark, monkeypatch, cells):
    """A table far above 4 million numbers moves once a group, not once a tree; 32-bit values stay 32 bits wide."""
    sent = []
    real = ET._dealer

    def watched(tops, seed, groups):
        sent.append((sum(bool(t.splits) for t in tops.values()), groups))
        return real(tops, seed, groups)

    monkeypatch.setattr(ET, "_dealer", watched)
    monkeypatch.setattr(ET, "MOST_BYTES", 8 * 7 * 300)
    x, y = table(320 if cells == "float" else 280)
    if cells == "float":
        x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(x, y, strict=True)], ", ".join(f"f{i} double" for i in range(7)) + ", CLASS int")
    got = ET.importances(df, [f"f{i}" for i in range(7)], n_trees=40, seed=3)
    assert sent == [(0, min(40, 4 * spark.sparkContext.defaultParallelism))]
    want = [brute(x, y, 3, t, int(math.sqrt(7))) for t in range(40)]
    assert np.allclose(got, sum(g / g.sum() for g in want) / 40, atol=1e-9)


def test_nodes_look_at_drawn_features_only(monkeypatch):
    """A node hashes each feature once for its order and makes thresholds for the few it looks at; the trees are those of the draws."""
    r = np.random.default_rng(11)
    x, y = r.normal(size=(300, 64)).astype(np.float32), r.integers(0, 2, 300)
    x[:, ::3] = np.round(x[:, ::3])                  # many features that do not vary in small nodes
    x[:, 1] = 0.0
    hashed, nodes, keep = [], [], ET.mixed
    monkeypatch.setattr(ET, "mixed", lambda *parts, **more: (hashed if np.ndim(out := keep(*parts, **more)) == 2 else nodes).append(out.size) or out)
    got = ET.grow(x, y, 2, 5, 1, 0, 8)
    assert sum(hashed) <= (64 + 8) * sum(nodes)
    monkeypatch.undo()
    assert np.allclose(got, brute(x.astype(float), y, 5, 1, 8))
