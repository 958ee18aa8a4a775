"""Windows, regions, consensus and extraction on hand-made fixtures."""

from pyspark.sql import functions as F

from motifspark.functions.text import RESIDUES
from motifspark.operators.consensus import consensus, fragment_support, n_lists, support_summary
from motifspark.operators.extract import extract_regions
from motifspark.operators.regions import merge_regions, parse_fragments
from motifspark.operators.windows import sliding_windows, window_counts


def _seqs(spark, lengths, prefix="S"):
    rows = [(f"{prefix}{i}", ("ACDEFGHIKLMNPQRSTVWY" * 10)[:n]) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "seq_id string, seq string")


def test_positive_example_window_count(spark):
    # shapes of the reference's positive example: 5 sequences -> 97 windows at w=15
    assert sliding_windows(_seqs(spark, [38, 16, 37, 39, 37])).count() == 97


def test_window_edges(spark):
    df = _seqs(spark, [15, 14, 0, 20])
    w = {r["name"]: r["sub"] for r in sliding_windows(df).collect()}
    assert "S0:1" in w and len([k for k in w if k.startswith("S0:")]) == 1
    assert not any(k.startswith("S1:") or k.startswith("S2:") for k in w)
    assert len([k for k in w if k.startswith("S3:")]) == 6
    # windows re-join to parent substrings
    for r in sliding_windows(df).collect():
        seq = ("ACDEFGHIKLMNPQRSTVWY" * 10)
        assert r["sub"] == seq[r["start"] - 1: r["start"] + 14]


def test_window_step_index_and_minlen(spark):
    df = _seqs(spark, [30, 19])
    rows = sliding_windows(df, w=10, step=4, min_len=20, id_mode="index").collect()
    assert sorted(r["start"] for r in rows) == [1, 5, 9, 13, 17, 21]
    assert sorted(r["name"] for r in rows)[:2] == ["S0:1", "S0:2"]


def test_window_chunks_and_non_ascii(spark):
    long = "ACDEFGHIKLMNPQRSTVWY" * 50
    df = spark.createDataFrame([("L", long), ("U", "ÄB" + "ACDEFGHIKLMNPQRSTVWY")], "seq_id string, seq string")
    rows = sliding_windows(df, chunk=7).collect()
    got = {(r["seq_id"], r["start"]): r["sub"] for r in rows}
    assert len([k for k in got if k[0] == "L"]) == len(long) - 14
    assert all(got[("L", s)] == long[s - 1: s + 14] for s in range(1, len(long) - 13))
    u = "ÄB" + "ACDEFGHIKLMNPQRSTVWY"
    assert got[("U", 1)] == u[:15] and got[("U", 2)] == u[1:16]


def test_window_counts_match_explode(spark):
    df = _seqs(spark, [38, 16, 37, 39, 37, 3])
    wc = {r["seq_id"]: r["n_windows"] for r in window_counts(df).collect()}
    ex = {r["seq_id"]: r["count"] for r in sliding_windows(df).groupBy("seq_id").count().collect()}
    assert wc == ex


def test_islands_golden(spark):
    starts = [1, 2, 3, 17, 18, 33, 34, 49, 200]
    df = spark.createDataFrame([("X", s) for s in starts] + [("X", 2)], "seq_id string, start int")
    got = sorted(tuple(r)[1:] for r in merge_regions(df, w=15, min_frags=1).collect())
    assert got == [(1, 32, 5), (33, 48, 2), (49, 63, 1), (200, 214, 1)]
    got2 = sorted(tuple(r)[1:] for r in merge_regions(df, w=15, min_frags=2).collect())
    assert got2 == [(1, 32, 5), (33, 48, 2)]


def test_islands_across_blocks(spark):
    # tiny block size forces islands to cross block borders
    starts = [1, 2, 3, 17, 18, 33, 34, 49, 200, 201, 214, 229, 243]
    df = spark.createDataFrame([("X", s) for s in starts], "seq_id string, start int")
    a = sorted(tuple(r) for r in merge_regions(df, w=15, min_frags=1, block=4).collect())
    b = sorted(tuple(r) for r in merge_regions(df, w=15, min_frags=1).collect())
    assert a == b


def test_parse_fragment_ids(spark):
    df = spark.createDataFrame([("A:B:12",), ("Q5M775_28:166",), ("  ",)], "name string")
    got = sorted(tuple(r) for r in parse_fragments(df).collect())
    assert got == [("A:B", 12), ("Q5M775_28", 166)]
    bad = spark.createDataFrame([("nocolon",)], "name string")
    import pytest
    with pytest.raises(Exception):
        parse_fragments(bad).collect()
    worse = spark.createDataFrame([("A:x1",)], "name string")
    with pytest.raises(Exception):
        parse_fragments(worse).collect()


def test_consensus_empty_list_lowers_n(spark):
    pairs = spark.createDataFrame([("L1", "a:1"), ("L1", "a:1"), ("L1", "b:1"), ("L2", "a:1"), ("L3", " "), ("L3", "")],
                                  "list_id string, name string")
    sup = fragment_support(pairs)
    n = n_lists(pairs)
    assert spark.range(1).select(n).first()[0] == 2
    kept = {(r["pct"], r["name"]) for r in consensus(sup, n, [100, 50]).collect()}
    assert kept == {(100, "a:1"), (50, "a:1"), (50, "b:1")}
    s = support_summary(sup, n).first()
    assert (s["n_lists"], s["n_unique"], s["max_support"], s["max_pct"]) == (2, 2, 2, 100.0)


def test_threshold_float_ceil(spark):
    from motifspark.operators.consensus import threshold_k
    import math
    r = spark.range(1).select(threshold_k(7, F.lit(100)).alias("k")).first()["k"]
    assert r == math.ceil((7 / 100.0) * 100)


def test_extract_missing_parent_and_bounds(spark):
    seqs = spark.createDataFrame([("P", "A" * 70 + "C" * 10)], "seq_id string, seq string")
    regions = spark.createDataFrame([("P", 1, 75, 3), ("P", 70, 81, 2), ("Q", 1, 5, 2)],
                                    "seq_id string, start int, end int, n_frags bigint")
    rows = extract_regions(regions, seqs).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["header"] == ">P:1-75|n_frags=3"
    assert r["record"] == ">P:1-75|n_frags=3\n" + "A" * 60 + "\n" + "A" * 10 + "C" * 5


def _flat_models(n, weight):
    import numpy as np

    from motifspark.operators.predict import LinearModels
    return LinearModels([f"m{i}" for i in range(n)], np.full((n, 20), weight), np.full(n, weight / 100))


def test_no_list_is_an_error(spark):
    import pytest

    from motifspark.operators.consensus import NoLists, consensus_from_pairs
    from motifspark.plans import flows
    seqs = _seqs(spark, [20])
    with pytest.raises(NoLists):
        flows.consensus_windows(flows.window_scores(seqs, _flat_models(1, 1.0)))
    with pytest.raises(NoLists):
        consensus_from_pairs(spark.createDataFrame([("L", " ")], "list_id string, name string"))
    sup = spark.createDataFrame([("a:1", 0)], "name string, support long")
    with pytest.raises(Exception, match="empty"):
        consensus(sup.withColumn("support", F.lit(1).cast("bigint")), F.lit(0).cast("bigint"), [90]).collect()
    assert consensus(sup, F.lit(3).cast("bigint"), [0]).count() == 0  # a name needs a vote


def test_repeated_ids_count_once(spark):
    from motifspark.plans import flows
    seqs = _seqs(spark, [20]).unionByName(_seqs(spark, [20])).unionByName(_seqs(spark, [18], "T"))
    scores = flows.window_scores(seqs, _flat_models(70, -1.0))
    cons = flows.consensus_windows(scores, (100,))
    assert sorted(r["name"] for r in cons.collect()) == [f"S0:{i}" for i in range(1, 7)] + [f"T0:{i}" for i in range(1, 5)]
    assert sorted((r["seq_id"], r["n_frags"]) for r in flows.consensus_regions(cons).collect()) == [("S0", 6), ("T0", 4)]


def test_votes_of_repeated_names_are_united(spark):
    import numpy as np

    from motifspark.functions.text import RESIDUES
    from motifspark.operators.predict import LinearModels, WindowScores
    W = np.zeros((2, 20))
    W[0, 0], W[1, 1] = -1.0, -1.0  # one model wants A, the other C
    models = LinearModels(["a", "c"], W, np.array([0.5, 0.5]))
    seqs = spark.createDataFrame([("X", "A" * 15), ("X", "C" * 15), ("Y", "A" * 15)], "seq_id string, seq string")
    got = {r["NAME"]: (r["support"], r["hits"]) for r in WindowScores(seqs, models, RESIDUES).rows(1).collect()}
    assert got == {"X:1": (2, [3]), "Y:1": (1, [1])}
    assert WindowScores(seqs, models, RESIDUES).n_lists() == 2


def test_kernel_equals_row_by_row(spark):
    import numpy as np

    from motifspark.functions.text import RESIDUES
    from motifspark.operators.features import composition_features, composition_names
    from motifspark.operators.predict import LinearModels, WindowScores, composition_rows, score_features
    r = np.random.default_rng(3)
    rows = [(f"s{i}", "".join(r.choice(list(RESIDUES + "xÄ"), int(r.integers(0, 200))))) for i in range(40)]
    seqs = spark.createDataFrame(rows, "seq_id string, seq string")
    models = LinearModels([f"m{i:03d}" for i in range(700)], r.standard_normal((700, 20)), r.standard_normal(700) / 10)
    for step, chunk, above in ((1, 7, None), (3, 64, 50), (1, 4096, 1 << 22)):
        want = composition_features(sliding_windows(seqs, step=step), keep=("seq_id", "start"))
        got = composition_rows(seqs, RESIDUES, step=step, chunk=chunk, spread_above=above)
        f = lambda df: sorted((x["NAME"], *[round(x[c], 9) for c in composition_names()]) for x in df.collect())
        assert f(got) == f(want)
        a = WindowScores(seqs, models, RESIDUES, step=step, chunk=chunk, spread_above=above).rows().select("NAME", "support", "hits").collect()
        b = score_features(want, models, composition_names(), ["NAME"]).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_split_keeps_repeated_names_single(spark):
    from motifspark.operators.sampling import stratified_split
    df = spark.createDataFrame([("same", 0)] * 6 + [(f"n{i}", i % 2) for i in range(14)], "NAME string, CLASS int")
    out = stratified_split(df, seed=1)
    assert out.count() == 20
    assert {r["CLASS"]: r["n"] for r in out.where("is_test").groupBy("CLASS").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: round(0.2 * 13), 1: round(0.2 * 7)}


def test_small_helpers(spark, tmpdir_path):
    import os

    import pytest

    from motifspark.operators.features import assert_feature_count, require_columns
    from motifspark.operators.importance import bucket_suffix, set_name
    from motifspark.operators.regions import sort_regions
    from motifspark.operators.windows import prepare
    from motifspark.sources.fasta import write_records
    assert [bucket_suffix(m) for m in (1, 2, 10)] == ["", "2", "10"] and set_name(0.29) == "cum28"
    df = spark.createDataFrame([("b", 5, 9, 1), ("a", 7, 9, 1), ("a", 7, 8, 1), ("a", 1, 9, 1)], "seq_id string, start int, end int, n_frags int")
    assert [tuple(r)[:3] for r in sort_regions(df).collect()] == [("a", 1, 9), ("a", 7, 8), ("a", 7, 9), ("b", 5, 9)]
    with pytest.raises(ValueError):
        require_columns(df, "seq_id", "CLASS")
    with pytest.raises(ValueError):
        assert_feature_count(["a"], 2)
    whole = prepare(_seqs(spark, [20, 3]), enabled=False).collect()  # whole sequences as single fragments
    assert sorted((r["name"], r["start"], len(r["sub"])) for r in whole) == [("S0", 1, 20), ("S1", 1, 3)]
    write_records(spark.createDataFrame([(90, ">x\nAC"), (100, ">y\nDE")], "pct int, record string"), tmpdir_path + "/r", partition_by=["pct"])
    assert sorted(f for f in os.listdir(tmpdir_path + "/r") if f.startswith("pct")) == ["pct=100", "pct=90"]


def test_votes_in_32_bits_are_those_of_64():
    """Margins that 32 bits cannot tell from 0 are computed in 64; odd numbers and large ones too."""
    import numpy as np
    from motifspark.operators.predict import Models
    r = np.random.default_rng(0)
    X = r.integers(0, 16, (9000, 20)) / 15.0
    W = r.standard_normal((30, 20))
    b = -(X[:30] * W).sum(1) + np.where(np.arange(30) % 3 == 0, 1e-9, np.where(np.arange(30) % 3 == 1, -1e-9, 1e-3))
    models = Models([str(i) for i in range(30)], W, b)
    assert (models.votes(X) == (X @ W.T + b <= 0)).all()
    assert models.votes(X)[np.arange(30), np.arange(30)].tolist() == [i % 3 == 1 for i in range(30)]
    odd = X[:50].copy()
    odd[0, 0], odd[1, 1], odd[2, 2] = np.nan, np.inf, 1e300
    with np.errstate(all="ignore"):
        assert (models.votes(odd) == (odd @ W.T + b <= 0)).all()
    assert Models([], np.zeros((0, 20)), np.zeros(0)).votes(X).shape == (9000, 0) and models.votes(X[:0]).shape == (0, 30)
    words, support = models.counted(models.votes(X))
    assert (support == models.votes(X).sum(1)).all() and (models.set_bits(np.bitwise_or.reduce(words, axis=0)) == models.votes(X).any(0)).all()


def test_rounded_fractions_are_looked_up(spark):
    """``digits`` rounds as Spark does, without a rounding per cell; and windows are dealt out in long chunks."""
    from motifspark.operators.predict import composition_rows
    from motifspark.operators.windows import sliding_windows
    seqs = spark.createDataFrame([("a", "ACDEFGHIKLMNPQRSTVWY" * 30), ("b", "AAC" * 60), ("c", "A\u00e9C" * 50)], "seq_id string, seq string")
    cols = [f"f_{a}" for a in RESIDUES]
    for w, digits in ((15, 6), (128, 6), (7, 3)):
        want = composition_rows(seqs, RESIDUES, w=w, min_len=w).select("NAME", *[F.round(c, digits).alias(c) for c in cols])
        got = composition_rows(seqs, RESIDUES, w=w, min_len=w, digits=digits).select("NAME", *cols)
        assert "round(" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    long = spark.createDataFrame([("l", "ACDEFGHIKLMNPQRSTVWY" * 1000)], "seq_id string, seq string")
    found = {r["start"]: r["sub"] for r in sliding_windows(long, step=3).collect()}
    text = "ACDEFGHIKLMNPQRSTVWY" * 1000
    assert found == {i + 1: text[i:i + 15] for i in range(0, 20000 - 14, 3)}
