"""Votes and N from one scoring pass; parents of regions picked out before anything is shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from motifspark.functions.text import RESIDUES
from motifspark.operators.joins import sieve
from motifspark.operators.predict import Models, WindowScores, least_votes
from motifspark.plans import flows
from motifspark.sources.fasta import sequence_lookup

import numpy as np


def _scores(spark, repeated, n_models=70, shift=0.0, parts=4):
    rnd = random.Random(5)
    seqs = [(f"s{i}", "".join(rnd.choice(RESIDUES) for _ in range(rnd.randint(15, 120)))) for i in range(60)]
    if repeated:
        seqs += [(f"s{i}", "".join(rnd.choice(RESIDUES) for _ in range(60))) for i in range(7)]
    w = np.random.default_rng(6).normal(size=(n_models, len(RESIDUES)))
    b = np.random.default_rng(7).normal(scale=0.1, size=n_models) + shift
    b[3] = 100.0                                    # a model that never fires
    models = Models([f"m{i:03d}" for i in range(n_models)], w, b)
    return WindowScores(spark.createDataFrame(seqs, "seq_id string, seq string").repartition(parts), models, RESIDUES)


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("pct", [1, 50, 60, 100])
def test_voted_equals_count_then_rows(spark, repeated, pct):
    scores = _scores(spark, repeated)
    rows, n = scores.voted(pct)
    assert n == scores.n_lists() == 69
    want = scores.rows(least_votes(pct, n))
    key = lambda df: sorted((r["NAME"], r["seq_id"], r["start"], r["support"], tuple(r["hits"])) for r in df.collect())
    assert key(rows) == key(want)
    assert pct == 100 or rows.count() > 0


def test_no_votes_and_no_sequences(spark):
    from motifspark.operators.consensus import NoLists
    with pytest.raises(NoLists):
        flows.consensus_windows(_scores(spark, False, shift=1000.0))
    scores = _scores(spark, False)
    none = WindowScores(scores.seqs.where("false"), scores.models, RESIDUES)
    rows, n = none.voted(50)
    assert n == 0 and rows.count() == 0


def test_sieve_keeps_every_key_and_little_else(spark):
    df = spark.range(200_000).select(F.concat(F.lit("id"), "id").alias("seq_id"), F.col("id").alias("v"))
    keys = df.where("v % 997 = 0").select("seq_id").unionByName(spark.createDataFrame([(None,), ("absent",)], "seq_id string"))
    got = sieve(df, keys, "seq_id")
    assert got.columns == df.columns
    assert got.join(keys, "seq_id", "left_semi").count() == 201
    assert got.count() < 201 + 20
    assert sieve(df, keys.where("false"), "seq_id").count() == 0
    # few bits: many strangers, never a key missing
    assert sieve(df, keys, "seq_id", bits=8).join(keys, "seq_id", "left_semi").count() == 201


def test_lookup_of_parents_only(spark):
    rows = [("a", "OLD", 0, 0, 1), ("a", "NEW", 1, 0, 0), ("b", "B", 0, 0, 0), ("c", "C", 0, 0, 2), ("c", "CC", 0, 0, 3)]
    rec = spark.createDataFrame(rows, "seq_id string, seq string, file_ord int, pos_block long, pos_row long")
    only = spark.createDataFrame([("a",), ("a",), ("c",), ("zz",)], "seq_id string")
    assert {tuple(r) for r in sequence_lookup(rec, only=only).collect()} == {("a", "NEW"), ("c", "CC")}
    assert {tuple(r) for r in sequence_lookup(rec, "first", only=only).collect()} == {("a", "OLD"), ("c", "C")}
    assert sequence_lookup(rec).count() == 3


def test_lookup_without_order(spark):
    """Equal repeats are one sequence; different ones are an error, as nothing says which is later."""
    rec = spark.createDataFrame([("a", "X"), ("a", "X"), ("b", "Y"), ("c", "1"), ("c", "2")], "seq_id string, seq string")
    ab = spark.createDataFrame([("a",), ("b",)], "seq_id string")
    assert {tuple(r) for r in sequence_lookup(rec, only=ab).collect()} == {("a", "X"), ("b", "Y")}
    with pytest.raises(Exception, match="no order columns"):
        sequence_lookup(rec).collect()


def test_digests_beyond_a_bigint(spark):
    """Sums of names' hashes go on modulo 2^64 where a BIGINT ends (four billion names do that); others are plain sums."""
    from motifspark.operators.predict import digest_sums
    parts = {"far": [(3, 2 ** 62 + 5), (2, 2 ** 62 + 7), (0, 2 ** 32 - 1)], "farther": [(1, 2 ** 63 - 1)] * 5, "near": [(4, 9), (0, 0), (1, 2 ** 40)], "none": [(0, 0)]}
    rows = [(k, n, h) for k, v in parts.items() for n, h in v]
    got = {r["list_id"]: (r["n_positive"], r["name_sum"]) for r in digest_sums(spark.createDataFrame(rows, "list_id string, n bigint, h bigint").repartition(4)).collect()}
    signed = lambda v: (v + 2 ** 63) % 2 ** 64 - 2 ** 63
    assert got == {k: (sum(n for n, _ in v), signed(sum(h for _, h in v))) for k, v in parts.items() if k != "none"}
    assert got["near"][1] == 9 + 2 ** 40 and got["far"][1] < 0


def _perceptrons(n, rng, shift=0.0):
    made = []
    for i in range(n):
        cols = np.sort(rng.permutation(len(RESIDUES))[:12])
        sizes = [12, 16, 8, 2]
        layers = [(rng.normal(size=(a, b)), rng.normal(scale=0.3, size=b)) for a, b in zip(sizes, sizes[1:])]
        layers[-1] = (np.hstack([np.zeros((8, 1)), layers[-1][0][:, 1:]]), np.array([0.0, shift + 0.5 * i]))
        made.append({"list_id": f"p{i}", "features": [RESIDUES[c] for c in cols], "shift": rng.normal(size=12) * 0.05, "scale": np.append(rng.uniform(0.02, 0.2, 11), 0.0),
                     "layers": sizes, "weights": np.concatenate([np.concatenate([w.ravel(), b]) for w, b in layers]), "activation": "relu"})
    return made


def test_narrow_perceptrons_vote_as_wide_ones():
    rng = np.random.default_rng(3)
    x = rng.multinomial(15, np.ones(len(RESIDUES)) / len(RESIDUES), size=9000) / 15.0
    models = Models.of([], _perceptrons(6, rng), list(RESIDUES))
    for p in models.mlps:
        at = np.array([p.votes(row[None, :])[0] for row in x[:50]])
        assert (p.votes(x) == p.exactly(x)).all() and (at == p.exactly(x[:50])).all()
    # equal outputs are a vote, outputs one rounding apart are told apart, and what is no number is what 64 bits say
    flat = [(w * 0, b) for w, b in models.mlps[0].layers]
    for gap in (0.0, 1e-15, -1e-15, 1e-9, -1e-9):
        flat[-1] = (flat[-1][0], np.array([0.5, 0.5 + gap]))
        tie = type(p)(p.columns, p.shift, p.scale, flat, True)
        assert (tie.votes(x) == (gap <= 0)).all()
    x[5], x[7] = np.nan, np.inf
    assert (p.votes(x) == p.exactly(x)).all()


@pytest.mark.parametrize("pct", [1, 40, 70, 100])
@pytest.mark.parametrize("shift", [0.0, 60.0])
def test_perceptrons_see_rows_that_can_pass(monkeypatch, pct, shift):
    """Rows that pass have all their votes and the models that fire are all found; others are kept from the perceptrons."""
    rng = np.random.default_rng(4)
    x = rng.multinomial(15, np.ones(len(RESIDUES)) / len(RESIDUES), size=30000) / 15.0
    linear = [{"list_id": f"l{i}", "weights": rng.normal(size=len(RESIDUES)), "bias": 0.3} for i in range(12)]
    models = Models.of(linear, _perceptrons(8, rng, shift), list(RESIDUES))
    want = models.votes(x)
    shown, kind = [], type(models.mlps[0])
    real = kind.votes
    monkeypatch.setattr(kind, "votes", lambda self, rows: shown.append(len(rows)) or real(self, rows))
    fired, found = np.zeros(20, np.int64), []
    for part in np.array_split(np.arange(len(x)), 3):
        got = models.votes_above(x[part], fired, pct)
        keep = got.sum(1) >= least_votes(pct, int((fired > 0).sum()))
        assert (got[keep] == want[part][keep]).all()
        found.append(part[keep])
    assert ((fired > 0) == want.any(0)).all()
    need = least_votes(pct, int(want.any(0).sum()))
    assert set(np.flatnonzero(want.sum(1) >= need)) <= set(np.concatenate(found))
    assert pct < 70 or shift or sum(shown) < 0.5 * 8 * len(x)


def test_draws_from_text_equal_draws_from_the_table(spark):
    from motifspark.operators import controls as CO, sampling as SA
    from motifspark.plans import pipeline as P
    rnd = random.Random(8)
    seqs = spark.createDataFrame([(f"s{i}" if i % 50 else None, "".join(rnd.choice(RESIDUES) for _ in range(rnd.randint(0, 90)))) for i in range(400)], "seq_id string, seq string").repartition(3)
    cfg = P.PipelineConfig()
    pool, source = P.featurize(seqs, cfg), P.window_source(seqs, cfg)
    assert source.rows == pool.count()
    rows = lambda df: sorted(map(tuple, df.collect()))
    asked = []
    spy = SA.Source(source.rows, lambda seeds, bounds: asked.append(len(seeds)) or source.near(seeds, bounds))
    assert rows(CO.random_controls(pool, 700, 3, source=spy)) == rows(CO.random_controls(pool, 700, 3))
    assert rows(SA.bucket_samples(pool, 300, (1, 2, 5), 9, source=spy)) == rows(SA.bucket_samples(pool, 300, (1, 2, 5), 9))
    assert asked == [1, 3]
    with pytest.raises(SA.NotEnoughRows):
        SA.bucket_samples(pool, source.rows, (1, 2), 9, source=source)
