"""The pivot plan of kNN against the plan that sends all references to the tasks, and against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from motifspark.operators import pivotknn as P
from motifspark.operators.knn import edited_nn, knn

SCHEMA = "NAME string, x array<double>"


def _frame(spark, x, prefix="p"):
    return spark.createDataFrame([(f"{prefix}{i:05d}", [float(v) for v in row]) for i, row in enumerate(x)], SCHEMA)


def _rows(df):
    return sorted((r["id"], r["rank"], r["nid"], round(r["dist"], 9)) for r in df.collect())


def _clusters(seed=1, n=1500, d=6, centres=12):
    rng = np.random.default_rng(seed)
    return rng.normal(scale=10, size=(centres, d))[rng.integers(0, centres, n)] + rng.normal(scale=0.3, size=(n, d))


@pytest.mark.parametrize("name,x", [
    ("clusters", _clusters()),
    ("grid with ties", np.round(np.random.default_rng(2).uniform(0, 4, size=(900, 2)))),
    ("uniform, no structure", np.random.default_rng(3).uniform(size=(600, 12))),
    ("far from the origin", _clusters(4, 700) + 1e4),
    ("fewer rows than k", np.arange(6, dtype=float).reshape(3, 2)),
    ("one row", np.ones((1, 3))),
])
def test_pivot_plan_equals_plain_plan(spark, name, x):
    df = _frame(spark, x)
    assert _rows(knn(df, 5, broadcast_bytes=0, block_rows=64)) == _rows(knn(df, 5))


def test_other_references_and_a_hot_point(spark):
    """A third of the references and a third of the queries stand at one point; ids of both sides overlap."""
    x = _clusters(5, 900)
    x[:300] = x[0]
    ref, df = _frame(spark, x), _frame(spark, np.vstack([x[:200], _clusters(6, 300)]))
    for exclude in (True, False):
        assert _rows(knn(df, 4, ref=ref, exclude_self=exclude, broadcast_bytes=0, block_rows=50)) == \
            _rows(knn(df, 4, ref=ref, exclude_self=exclude))


def test_empty_sides(spark):
    none, some = spark.createDataFrame([], SCHEMA), _frame(spark, np.ones((4, 2)))
    assert P.pivot_knn(some, none, 3).count() == 0
    assert P.pivot_knn(none, some, 3).count() == 0


def test_bounds_never_rule_out_a_nearer_row():
    rng = np.random.default_rng(7)
    x, pivots = _clusters(8, 400), _clusters(8, 400)[rng.choice(400, 20, replace=False)]
    cells = P.Cells(pivots)
    cell = cells.squared(x).argmin(axis=1)
    away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
    cells.lo = np.array([away[cell == j].min() if (cell == j).any() else 0.0 for j in range(20)])
    cells.hi = np.array([away[cell == j].max() if (cell == j).any() else 0.0 for j in range(20)])
    cells.parts = np.array([int((cell == j).any()) for j in range(20)])
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    theta2 = np.sort(d2, axis=1)[:, 5]
    open_ = cells.reachable(x, theta2)
    for i in range(len(x)):
        assert open_[i, cell[d2[i] <= theta2[i]]].all()
    assert open_.mean() < 0.5


def test_shuffled_probes_per_query(spark):
    """On clustered rows a query visits few of the cells: that is what is shuffled."""
    df = _frame(spark, _clusters(9, 4000, centres=40))
    n = df.count()
    points = P._points(df, "NAME", "x")
    made = []
    keep = P.materialise

    def spy(frame, what):
        out = keep(frame, what)
        if what == "knn probes":
            made.append(out.count())
        return out

    P.materialise = spy
    try:
        got = P.pivot_knn(df, df, 5, block_rows=256)
        assert got.count() == 5 * n
    finally:
        P.materialise = keep
    pivots = len(P._choose(points, n))
    assert made[0] / n < 0.15 * pivots      # every block would be pivots - 1 probes per query


def test_edited_nn_same_on_both_plans(spark):
    x = _clusters(10, 400, centres=3)
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(f"r{i:04d}", *map(float, v), int(rng.uniform() < 0.4)) for i, v in enumerate(x)],
                               "NAME string, " + ", ".join(f"c{j} double" for j in range(6)) + ", CLASS int")
    cols = [f"c{j}" for j in range(6)]
    plain = {r["NAME"] for r in edited_nn(df, cols, 3).collect()}
    assert {r["NAME"] for r in edited_nn(df, cols, 3, broadcast_bytes=0, block_rows=40).collect()} == plain


def test_probes_without_structure_are_one_row_a_query(spark):
    """Where no bound holds, what is written and shuffled is a query with its blocks, not a row per query and cell."""
    x = np.random.default_rng(11).uniform(size=(700, 16))
    df, made, keep = _frame(spark, x), [], P.materialise

    def spy(frame, what):
        out = keep(frame, what)
        if what == "knn probes":
            made.append(out.select(F.count(F.lit(1)), F.sum(F.size("blocks")), F.max(F.array_max("blocks"))).first())
        return out

    P.materialise = spy
    try:
        got = _rows(P.pivot_knn(df, df, 3, block_rows=20))
    finally:
        P.materialise = keep
    rows, visits, last = made[0]
    assert rows == len(x) and visits <= len(x) * (last + 1) and last + 1 <= 8      # 26 cells in 35 parts and more
    assert got == _rows(knn(df, 3))


def test_nearest_over_many_tiles_ties_and_holes():
    rng = np.random.default_rng(12)
    R = rng.normal(size=(9000, 5)).round(1)
    R[:3000] = R[0]                                     # a tie of thousands
    R[5] = np.nan
    Q = np.vstack([R[:40], rng.normal(size=(260, 5)), np.full((1, 5), np.inf)])
    rid = np.array([f"r{(i * 7919) % 9000:05d}" for i in range(9000)], dtype=object)
    rid[8999] = rid[8998]                               # an id that repeats
    qid = np.array([*rid[:40], *(f"q{i}" for i in range(259)), rid[8998], "odd"], dtype=object)
    qi, ri, d2, rank = P.nearest(qid, Q, rid, R, 4, True)
    for i in range(len(Q)):
        full = ((R - Q[i]) ** 2).sum(axis=1)
        full[(rid == qid[i]) | ~np.isfinite(full)] = np.inf
        best = [j for j in np.lexsort((rid, full))[:4] if np.isfinite(full[j])]
        assert [(rid[j], full[j]) for j in best] == [(rid[j], d) for j, d in zip(ri[qi == i], d2[qi == i])]
        assert rank[qi == i].tolist() == list(range(1, len(best) + 1))


def test_rows_with_holes_on_both_plans(spark):
    x = _clusters(13, 300).tolist()
    for i in range(0, 300, 9):
        x[i] = [None] * 6 if i % 2 else [float("nan"), *x[i][1:]]
    df = spark.createDataFrame([(f"p{i:05d}", v) for i, v in enumerate(x)], SCHEMA)
    got = _rows(knn(df, 3, broadcast_bytes=0, block_rows=32))
    assert got == _rows(knn(df, 3)) and len(got) == 3 * (300 - 34)


def test_neighbours_found_once_serve_every_k(spark):
    x = _clusters(14, 200, centres=3)
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"r{i:04d}", *map(float, v), int(rng.uniform() < 0.3)) for i, v in enumerate(x)],
                               "NAME string, " + ", ".join(f"c{j} double" for j in range(6)) + ", CLASS int")
    cols = [f"c{j}" for j in range(6)]
    near = knn(df.select("NAME", F.array(*cols).alias("x")), 5)
    for k in (3, 5):
        assert {r.NAME for r in edited_nn(df, cols, k, neighbours=near).collect()} == {r.NAME for r in edited_nn(df, cols, k).collect()}


def test_blocks_are_sent_and_queries_stay(spark, monkeypatch):
    """Many blocks, in several jobs: what is written is at most k rows a query and job, however many blocks a query must search; ids may repeat."""
    x = np.vstack([np.random.default_rng(15).uniform(size=(500, 12)), np.ones((40, 12))])
    names = [f"p{i % 500:05d}" for i in range(len(x))]
    df = spark.createDataFrame([(n, [float(v) for v in row]) for n, row in zip(names, x)], SCHEMA)
    monkeypatch.setattr(P, "BLOCK_VALUES", 12 * 60)
    monkeypatch.setattr(P, "SENT_VALUES", 12 * 60 * 4)
    monkeypatch.setattr(P, "QUERY_VALUES", 12 * 50)
    made, keep = {}, P.materialise

    def spy(frame, what):
        out = keep(frame, what)
        made.setdefault(what, []).append(out)
        return out

    monkeypatch.setattr(P, "materialise", spy)
    got = P.pivot_knn(df, df, 3, block_rows=25)
    rows = sorted((r["id"], r["rank"], round(r["dist"], 9)) for r in got.collect())
    blocks = made["knn probes"][0].agg(F.max(F.array_max("blocks"))).first()[0] + 1
    assert blocks >= 8 and len(made["knn candidates"]) == -(-blocks // 4)
    assert all(c.count() <= 3 * len(x) for c in made["knn candidates"])
    # brute force: per id the least rows of the union over its queries, as a window over all pairs gives them
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    want = {}
    for i, n in enumerate(names):
        pairs = [(d2[i, j], names[j]) for j in range(len(x)) if names[j] != n]
        want.setdefault(n, []).extend(sorted(pairs)[:3])
    assert rows == sorted((n, r + 1, round(float(np.sqrt(d)), 9)) for n, pairs in want.items() for r, (d, _) in enumerate(sorted(pairs)[:3]))


@pytest.mark.parametrize("scale,offset", [(1.0, 0.0), (1.0, 1e5), (1e-9, 0.0), (1e25, 0.0)])
def test_nearest_in_32_bits_is_exact(scale, offset):
    """Distances that differ by less than a 32-bit product can tell are ordered as 64 bits order them."""
    rng = np.random.default_rng(16)
    R = rng.normal(size=(3000, 16))
    R[1000:2000] = R[:1000] + rng.normal(scale=1e-7, size=(1000, 16))
    R = R * scale + offset
    ids = np.array([f"r{i}" for i in range(3000)], dtype=object)
    qi, ri, d2, _ = P.nearest(ids[:300], R[:300], ids, R, 3, True)
    full = ((R[:300, None, :] - R[None, :, :]) ** 2).sum(2)
    full[np.arange(300), np.arange(300)] = np.inf
    assert (ri.reshape(300, 3) == np.argsort(full, axis=1, kind="stable")[:, :3]).all()
