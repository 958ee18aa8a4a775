"""Sampling, resampling, training and search on small synthetic tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from motifspark.operators.knn import edited_nn, knn, smote
from motifspark.operators.sampling import NotEnoughRows, bucket_samples, first_n_by_key, sample_n, stratified_split, with_order_key
from motifspark.operators.scaling import minmax_scale, standard_scale
from motifspark.plans.runplan import model_ids, run_plan


def _md5_order(names, seed):
    return sorted(names, key=lambda n: (hashlib.md5(f"{seed}:{n}".encode()).hexdigest(), n))


def test_sample_n_matches_brute_force_and_is_partition_free(spark):
    names = [f"S{i}:{i * 3}" for i in range(5000)]
    df = spark.createDataFrame([(n,) for n in names], "NAME string")
    want = set(_md5_order(names, 9)[:777])
    a = {r["NAME"] for r in sample_n(df, 777, 9).collect()}
    b = {r["NAME"] for r in sample_n(df.repartition(13), 777, 9).collect()}
    assert a == want == b
    # force the histogram refinement path
    c = {r["NAME"] for r in first_n_by_key(with_order_key(df, 9), 777, 9, final_rows=50).collect()}
    assert c == want
    with pytest.raises(NotEnoughRows):
        sample_n(df, 5001, 9).collect()


def test_bucket_samples_independent_draws(spark):
    names = [f"P{i}:1" for i in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "NAME string")
    out = bucket_samples(df, 20, (1, 2, 5), seed=4).collect()
    by = {}
    for r in out:
        by.setdefault(r["mult"], set()).add(r["NAME"])
    for m in (1, 2, 5):
        assert by[m] == set(_md5_order(names, 4 + m)[:20 * m])


def test_stratified_split_exact(spark):
    rows = [(f"n{i}", i % 3 == 0 and 1 or 0) for i in range(300)]
    df = spark.createDataFrame(rows, "NAME string, CLASS int")
    out = stratified_split(df, seed=5).collect()
    assert len(out) == 300
    for cls in (0, 1):
        names = [r["NAME"] for r in out if r["CLASS"] == cls]
        test = {r["NAME"] for r in out if r["CLASS"] == cls and r["is_test"]}
        assert test == set(_md5_order(names, 5)[:round(0.2 * len(names))])


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (5.0, 5.0)], "a double, b double")
    s = standard_scale(df, ["a", "b"]).collect()
    assert [round(r["a"], 6) for r in s] == [-1.224745, 0.0, 1.224745] and all(r["b"] == 0 for r in s)
    m = minmax_scale(df, ["a", "b"]).collect()
    assert [r["a"] for r in m] == [0.0, 0.5, 1.0] and all(r["b"] == 0 for r in m)


def _pts(spark, n=60):
    import random
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        c = 0 if i < n // 4 else 1
        base = 0.0 if c == 0 else 3.0
        rows.append((f"r{i}", base + rnd.random(), base + rnd.random(), c))
    return spark.createDataFrame(rows, "NAME string, a double, b double, CLASS int"), rows


def test_knn_matches_brute_force(spark):
    df, rows = _pts(spark)
    got = {(r["id"], r["rank"]): r["nid"] for r in
           knn(df.select("NAME", F.array("a", "b").alias("x")), 4, block_rows=7).collect()}
    for name, a, b, _ in rows:
        d = sorted(((x - a) ** 2 + (y - b) ** 2, n2) for n2, x, y, _ in rows if n2 != name)
        for k in range(4):
            assert got[(name, k + 1)] == d[k][1]


def test_smote_balanced_and_inside_segments(spark):
    df, rows = _pts(spark)
    out = smote(df, ["a", "b"], k=3, seed=2).collect()
    counts = {}
    for r in out:
        counts[r["CLASS"]] = counts.get(r["CLASS"], 0) + 1
    assert counts[0] == counts[1]
    mins = [(x, y) for _, x, y, c in rows if c == 0]
    lo = (min(p[0] for p in mins), min(p[1] for p in mins))
    hi = (max(p[0] for p in mins), max(p[1] for p in mins))
    for r in out:
        if "#s" in r["NAME"]:
            assert lo[0] - 1e-9 <= r["a"] <= hi[0] + 1e-9 and lo[1] - 1e-9 <= r["b"] <= hi[1] + 1e-9


def test_enn_subset(spark):
    df, rows = _pts(spark)
    mixed = df.unionByName(spark.createDataFrame([("odd", 0.5, 0.5, 1)], df.schema))
    out = {r["NAME"] for r in edited_nn(mixed, ["a", "b"], k=3).collect()}
    assert out <= {r[0] for r in rows} | {"odd"}
    assert "odd" not in out


def test_training_separates(spark):
    from motifspark.operators.train import fit_linear
    df, rows = _pts(spark, 200)
    coef = fit_linear(df, ["a", "b"], "logreg", {"C": 10.0})
    ok = 0
    for _, a, b, c in rows:
        margin = coef["bias"] + coef["weights"][0] * a + coef["weights"][1] * b
        ok += (0 if margin <= 0 else 1) == c
    assert ok / len(rows) >= 0.95


def test_run_plan_and_cache(spark):
    assert len(model_ids()) == 172
    plan = run_plan(spark, family="linear")
    assert plan.count() == 144
    from motifspark.operators.search import lookup, pending, linear_grid, mlp_grid
    assert len(linear_grid()) == 18 and len(mlp_grid()) == 18
    cache = plan.limit(10).select("family", "crit", "tag", "mult", "n_feats", "model", F.lit("{}").alias("params"))
    assert pending(plan, cache).count() == 134
    assert pending(plan, cache, redo=True).count() == 144
    with pytest.raises(Exception):
        lookup(plan, cache).collect()


def test_searches_small_grids(spark):
    from motifspark.operators.search import linear_grid, mlp_grid, search_linear, search_mlp, search_resampled
    df, _ = _pts(spark, 120)
    lin = search_linear(df, ["a", "b"], seed=1, grid=linear_grid()[:2]).collect()
    assert len(lin) == 2 and all(r["recall"] >= 0.9 for r in lin)
    mlp = search_mlp(df, ["a", "b"], seed=1, grid=[dict(g, hidden=[4]) for g in mlp_grid()[:2]], max_iter=50).collect()
    assert len(mlp) == 2 and {r["fit"] for r in mlp} == {0, 1}  # each grid entry is a fit of its own
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == mlp[0]["tp"] + mlp[0]["fp"] + mlp[0]["fn"] + mlp[0]["tn"] > 0 for r in mlp)
    res = search_resampled(df, ["a", "b"], seed=1, ks=((3, 3),), grid=linear_grid()[:1]).collect()
    assert len(res) == 1 and res[0]["k_smote"] == 3


def test_grids_have_the_fixed_values():
    from motifspark.operators.search import linear_grid, mlp_grid, resampled_grid
    from motifspark.operators.train import model_key
    g = linear_grid()
    assert [(p["solver"], p["penalty"], p["C"]) for p in g[:9]] == [("lbfgs", "l2", c) for c in (0.1, 1, 10)] + [("liblinear", q, c) for q in ("l1", "l2") for c in (0.1, 1, 10)]
    assert [(p["alpha"], p["penalty"], p["l1_ratio"]) for p in g[9:12]] == [(1e-5, "l2", 0.0), (1e-5, "elasticnet", 0.15), (1e-5, "elasticnet", 0.5)]
    assert [p["grid_ord"] for p in g] == list(range(18)) and len({model_key(p["model"], p) for p in g}) == 15
    assert {p["alpha"] for p in mlp_grid()} == {1e-5, 1e-4, 1e-3} and {p["learning_rate_init"] for p in mlp_grid()} == {1e-4, 1e-3}
    assert len({model_key("mlp", p) for p in mlp_grid()}) == 18 and len(resampled_grid()) == 12


def test_perceptron_kernel_equals_spark(spark):
    """Our forward pass of the extracted weights gives Spark's own predictions."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    from motifspark.operators.train import fit_mlp, predict_mlp, prepared
    df, _ = _pts(spark, 150)
    df = df.withColumn("c", F.lit(3.0)).withColumn("d", F.col("a") * F.col("b"))
    cols = ["a", "b", "c", "d"]
    ours = {r["name"] for r in predict_mlp(fit_mlp(df, cols, hidden=(5, 3), max_iter=30, seed=4), df).collect()}
    with prepared(df, cols) as p:
        model = MultilayerPerceptronClassifier(layers=[4, 5, 3, 2], maxIter=30, seed=4, solver="l-bfgs", tol=1e-6).fit(p.vectors)
        assert model.transform(p.vectors).where("prediction = 0").count() == len(ours)
    assert 0 < len(ours) < 150


def test_folding_equals_scaling(spark):
    from motifspark.operators.scaling import minmax_scale, standard_scale
    from motifspark.operators.train import fit_linear
    df, rows = _pts(spark, 120)
    for scaler, scale in (("standard", standard_scale), ("minmax", minmax_scale)):
        a = fit_linear(df, ["a", "b"], "logreg", {"C": 1.0}, scaler=scaler)
        b = fit_linear(scale(df, ["a", "b"]), ["a", "b"], "logreg", {"C": 1.0}, scaler=scaler)
        scaled = {r["NAME"]: r for r in scale(df, ["a", "b"]).collect()}
        for name, x, y, _ in rows:
            s = scaled[name]
            assert abs(a["weights"][0] * x + a["weights"][1] * y + a["bias"] - (b["weights"][0] * s["a"] + b["weights"][1] * s["b"] + b["bias"])) < 1e-4


def test_flow_with_all_families_and_cache(spark, tmpdir_path):
    """F8 on a small reference: defaults, then searched parameters through the cache; ingested features give the same lists."""
    import random

    from motifspark.operators.predict import Models
    from motifspark.plans import pipeline as P
    from motifspark.sources.tables import read_params
    rnd = random.Random(5)
    word = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    pos = spark.createDataFrame([(f"p{i}", word("DEWF", 24)) for i in range(6)], "seq_id string, seq string")
    ref = spark.createDataFrame([(f"r{i}", word("ACGHIKLMNPQRSTVY", 40) + (word("DEWF", 30) if i % 5 == 0 else "")) for i in range(40)], "seq_id string, seq string")
    ids = spark.createDataFrame([(f"r{i}",) for i in range(20)], "id string")
    cfg = P.PipelineConfig(mults=(1,), random_control_n=150, importance_trees=5, mlp_iter=10, seed=3, thresholds=(90,), cum_thresholds=(0.95,))
    cfg.params = {**cfg.params, "mlp": {"hidden": [4]}}
    out = P.run(spark, cfg, pos, ref, ids)
    sets = len(out["feature_sets"])
    assert out["models"].count() == 2 * sets * 3 + 2 * sets * 3 and out["mlps"].count() == 2 * sets
    found = {r["seq_id"] for r in out["fasta"].collect()}
    assert found and found <= {f"r{i}" for i in range(0, 40, 5)}  # only where the planted stretch is
    assert all(r["record"].startswith(f">{r['seq_id']}:{r['start']}-") for r in out["fasta"].collect())
    # brute force votes from the returned models
    names = P.composition_names()
    models = Models.of([r.asDict() for r in out["models"].collect()], [r.asDict() for r in out["mlps"].collect()], names)
    import numpy as np
    feats = P.featurize(ref, cfg).collect()
    X = np.array([[r[c] for c in names] for r in feats])
    votes = models.votes(X)
    need = -(-90 * int(votes.any(axis=0).sum()) // 100)
    want = {r["NAME"] for r, v in zip(feats, votes.sum(axis=1)) if v >= max(1, need)}
    assert {r["name"] for r in out["consensus"].collect()} == want
    # ingested tables instead of window text
    table = P.consensus_table(P.ingest_features(P.featurize(ref, cfg)), models, names, cfg.thresholds)
    assert {r["name"] for r in table.collect()} == want
    # searched parameters: what is cached is not searched again, a missing entry is an error
    small = P.PipelineConfig(tags=("PTM",), mults=(1,), importance_trees=5, mlp_iter=10, families=("linear",), cache=tmpdir_path + "/cache", cum_thresholds=(0.9,), thresholds=(50,), seed=3)
    got = P.run(spark, small, pos, ref, ids)
    assert got["models"].count() == 9  # three criteria x three models
    n = read_params(spark, small.cache).count()
    P.search_all(spark, out["tables"], {}, got["feature_sets"], small)
    assert read_params(spark, small.cache).count() == n == 9
    import pytest
    small.tags = ("Random",)
    with pytest.raises(KeyError):
        P.train_all(out["tables"], got["feature_sets"], small, names)


def test_resampled_models_required(spark):
    from motifspark.plans.pipeline import resampled_models
    t = spark.createDataFrame([("smoteenn/PTM/cum90/logreg", [1.0], 0.0), ("smoteenn/PTM/cum90/sgd_partial", [1.0], 0.0)], "list_id string, weights array<double>, bias double")
    assert resampled_models(t, "PTM", "cum90").count() == 2  # SGD may be missing
    with pytest.raises(FileNotFoundError):
        resampled_models(t.where("list_id LIKE '%logreg'"), "PTM", "cum90")


def test_knn_on_equal_points(spark):
    """600 equal points: k candidates per query and block, and both plans give the same."""
    df = spark.createDataFrame([(f"e{i:03d}", [1.0, 2.0]) for i in range(600)], "NAME string, x array<double>")
    a = {tuple(r) for r in knn(df, 3).collect()}
    b = {tuple(r) for r in knn(df, 3, block_rows=100, broadcast_bytes=0).collect()}
    assert a == b and len(a) == 1800


def test_random_pool_serves_the_largest_multiple(spark):
    """More known fragments than the configured pool has windows: every table still gets its mult x positives."""
    from motifspark.operators import controls as CO
    from motifspark.plans import pipeline as P
    import numpy as np
    rng = np.random.default_rng(4)
    seqs = spark.createDataFrame([(f"S{i}", "".join(rng.choice(list("ACDEFGHIKL"), 60))) for i in range(30)], "seq_id string, seq string")
    ids = spark.createDataFrame([(f"S{i}",) for i in range(10)], "id string")
    cfg = P.PipelineConfig(mults=(1, 5), random_control_n=20)
    pos = P.featurize(seqs.limit(1), cfg).limit(30)
    pools = P.control_pools(cfg, seqs, ids, 30)
    got = {(r.tag, r.mult, r.CLASS): r["count"] for r in CO.training_tables(pos, pools, 30, cfg.mults, 1).groupBy("tag", "mult", "CLASS").count().collect()}
    assert got == {(t, m, c): 30 * (m if c else 1) for t in ("PTM", "Random") for m in (1, 5) for c in (0, 1)}
    assert pools["Random"].count() == 150
    assert P.control_pools(P.PipelineConfig(mults=(1,), random_control_n=40), seqs, ids, 30)["Random"].count() == 40


def test_md5_tops_equal_hashlib():
    import pyarrow as pa
    from motifspark.functions.hashing import md5_tops
    texts = ["", None, "a" * 53, "a" * 54, "a" * 55, "a" * 56, "\u00e9:12", "x" * 200] + [f"D{i * 977}:{i}" for i in range(500)]
    for prefix in ("", "8:", "q" * 60):
        for at in (0, 3, 6):
            want = [None if x is None else int(hashlib.md5((prefix + x).encode()).hexdigest()[:8], 16) for x in texts[at:]]
            assert md5_tops(pa.array(texts).slice(at), prefix, block=64).to_pylist() == want
    assert md5_tops(pa.array([], pa.string())).to_pylist() == [] and md5_tops(pa.array([None], pa.string())).to_pylist() == [None]


def test_drawn_names_are_hashed_in_batches_and_features_for_the_draw_alone(spark):
    """Names alone are judged by the batch kernel; a table with other columns is filtered by its key below what makes them."""
    from motifspark.operators import sampling as SA
    from motifspark.operators.features import composition_features
    from motifspark.operators.windows import sliding_windows
    names = spark.createDataFrame([(f"D{i % 3000}:{i}",) for i in range(20000)] + [(None,)] * 5, "NAME string").repartition(3)
    draws = [SA.Draw(m, 40 * m, 7 + m) for m in (1, 2, 5)]
    got = SA.first_n(names, draws).groupBy("draw").agg(F.sort_array(F.collect_list("NAME")).alias("n")).collect()
    want = {d.label: sorted(r[0] for r in names.where("NAME IS NOT NULL").orderBy(F.md5(F.concat(F.lit(f"{d.seed}:"), "NAME")), "NAME").limit(d.n).collect()) for d in draws}
    assert {r["draw"]: r["n"] for r in got} == want
    near = SA._near_names(names, ["8"], [1 << 31])
    assert "MapInArrow" in near._jdf.queryExecution().executedPlan().toString()
    seqs = spark.createDataFrame([(f"S{i}", "ACDEFGHIKLMNPQRSTVWY" * 10) for i in range(20)], "seq_id string, seq string")
    written = []
    real = SA.materialise
    try:
        SA.materialise = lambda df, what: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, what)
        assert SA.sample_n(composition_features(sliding_windows(seqs)), 25, 3).count() == 25
    finally:
        SA.materialise = real
    plan = written[0]
    filters = [i for i, line in enumerate(plan.splitlines()) if "Filter" in line and "md5" in line]
    assert filters and filters[-1] > max(i for i, line in enumerate(plan.splitlines()) if "replace(" in line)
