"""File sources and sinks on tiny synthetic files."""

import json
import os

from motifspark.sources.fasta import read_fasta, read_fastas, sequence_lookup, write_fasta
from motifspark.sources.tables import (read_features, read_ids, read_importance, read_labelled,
                                       read_prediction_lists, read_regions, read_json_list)


def _w(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_read_fasta_odd_shapes(spark, tmpdir_path):
    p = _w(os.path.join(tmpdir_path, "a.fa"),
           "junk before header\n>s1 desc\nACDE\nfghi\n\n>s2\n>s3\nKLM\r\nNPQ\n>s1 again\nWWW\n")
    rows = [(r["seq_id"], r["seq"]) for r in read_fasta(spark, p).orderBy("pos_block", "pos_row").collect()]
    assert rows == [("s1", "ACDEfghi"), ("s2", ""), ("s3", "KLMNPQ"), ("s1", "WWW")]


def test_read_fasta_split_safe(spark, tmpdir_path):
    recs = [(f"id{i}", "ACDEFGHIKL" * (1 + i % 7)) for i in range(3000)]
    p = _w(os.path.join(tmpdir_path, "big.fa"), "".join(f">{a} x\n{s[:25]}\n{s[25:]}\n" for a, s in recs))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_fasta(spark, p)
        assert df.rdd.getNumPartitions() > 1
        got = sorted((r["seq_id"], r["seq"]) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(recs)


def test_lookup_later_file_wins(spark, tmpdir_path):
    a = _w(os.path.join(tmpdir_path, "a.fa"), ">x\nAAA\n>y\nCCC\n>x\nDDD\n")
    b = _w(os.path.join(tmpdir_path, "b.fa"), ">y\nEEE\n")
    got = {r["seq_id"]: r["seq"] for r in sequence_lookup(read_fastas(spark, [a, b])).collect()}
    assert got == {"x": "DDD", "y": "EEE"}


def test_write_fasta_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("a:1", "ACDEFGHIKLMNPQR"), ("b:2", "A" * 130)], "name string, sub string")
    out = os.path.join(tmpdir_path, "out")
    write_fasta(df, out, width=60)
    back = {r["seq_id"]: r["seq"] for r in read_fasta(spark, out + "/*.txt").collect()}
    assert back == {"a:1": "ACDEFGHIKLMNPQR", "b:2": "A" * 130}


def test_feature_tables(spark, tmpdir_path):
    p = _w(os.path.join(tmpdir_path, "f.tsv"), "NAME\tf1\tf2\tidr_name\tCLASS\nA:1\t1.5\tinf\tz\t0\nB:2\t\tNaN\tz\t1\nC:3\tword\t-inf\tz\t1\n")
    df = read_features(spark, p)
    rows = {r["NAME"]: r for r in df.collect()}
    assert rows["A:1"]["f1"] == 1.5 and rows["A:1"]["f2"] == float("inf")
    assert rows["B:2"]["f1"] is None
    lab = read_labelled(spark, p, sep="\t", expected=2)
    assert "idr_name" not in lab.columns
    assert {r["NAME"]: (r["f1"], r["f2"]) for r in lab.collect()} == {"A:1": (1.5, 0.0), "B:2": (0.0, 0.0), "C:3": (0.0, 0.0)}


def test_ids_lists_regions_importance_json(spark, tmpdir_path):
    ids = _w(os.path.join(tmpdir_path, "ids.txt"), " Q8TD84_4 \n\nP1\nP1\n")
    assert sorted(r["id"] for r in read_ids(spark, ids).collect()) == ["P1", "Q8TD84_4"]
    assert read_ids(spark, os.path.join(tmpdir_path, "missing.txt"), missing_ok=True).count() == 0
    root = os.path.join(tmpdir_path, "preds", "linear", "f1")
    os.makedirs(root)
    _w(os.path.join(root, "a.txt"), "x:1\ny:2\n")
    _w(os.path.join(root, "b.txt"), "\n")
    _w(os.path.join(root, "c.csv"), "z:9\n")
    pl = read_prediction_lists(spark, os.path.join(tmpdir_path, "preds"))
    assert sorted(r["name"] for r in pl.collect() if r["name"]) == ["x:1", "y:2"]
    reg = _w(os.path.join(tmpdir_path, "r.tsv"), "seq_id\tstart\tend\tn_frags\nP\t1\t20\t3\n")
    assert [tuple(r) for r in read_regions(spark, reg).collect()] == [("P", 1, 20, 3)]
    imp = _w(os.path.join(tmpdir_path, "imp.csv"), "feature,importance,cum_fraction\nf1,0.7,0.7\nf2,0.3,1.0\n")
    assert read_importance(spark, imp).count() == 2
    j = _w(os.path.join(tmpdir_path, "drop.json"), json.dumps(["f3", "f4"]))
    assert read_json_list(spark, j) == ["f3", "f4"]


def test_file_order_decides_whatever_the_names(spark, tmpdir_path):
    a = _w(os.path.join(tmpdir_path, "a.fa"), ">x\nAAA\n")
    b = _w(os.path.join(tmpdir_path, "b.fa"), ">x\nBBB\n")
    for paths, want in (([a, b], "BBB"), ([b, a], "AAA")):
        for read in (read_fasta, read_fastas):
            assert [r["seq"] for r in sequence_lookup(read(spark, paths)).collect()] == [want]
    os.makedirs(os.path.join(tmpdir_path, "folder"))
    _w(os.path.join(tmpdir_path, "folder", "c.fa"), ">x\nCCC\n")
    for paths, want in (([os.path.join(tmpdir_path, "folder"), a], "AAA"), ([a, os.path.join(tmpdir_path, "folder")], "CCC"), ([a, os.path.join(tmpdir_path, "b*.fa")], "BBB")):
        assert [r["seq"] for r in sequence_lookup(read_fasta(spark, paths)).collect()] == [want]


def test_reference_is_one_file(spark, tmpdir_path):
    from motifspark.sources.fasta import only_file
    a = _w(os.path.join(tmpdir_path, "a.fa"), ">x\nAAA\n")
    assert only_file(spark, tmpdir_path + "/*.fa").endswith("a.fa") and a
    _w(os.path.join(tmpdir_path, "b.fa"), ">x\nAAA\n")
    import pytest
    with pytest.raises(ValueError):
        only_file(spark, tmpdir_path + "/*.fa")


def test_writers(spark, tmpdir_path):
    import pytest

    from motifspark.operators.predict import prediction_pairs
    from motifspark.plans.runplan import run_plan
    from motifspark.sources.tables import read_scoring, write_consensus, write_csv, write_predictions, write_tsv
    t = spark.createDataFrame([("A:1", 1.5), ("B:2", None)], "NAME string, f1 double")
    write_tsv(t, tmpdir_path + "/t", single=True)
    assert len([f for f in os.listdir(tmpdir_path + "/t") if f.startswith("part")]) == 1
    assert {tuple(r) for r in read_scoring(spark, tmpdir_path + "/t").collect()} == {("A:1", 1.5), ("B:2", 0.0)}
    write_csv(t, tmpdir_path + "/c")
    assert read_features(spark, tmpdir_path + "/c", sep=",").count() == 2
    cons = spark.createDataFrame([(100, f"s:{i:05d}") for i in range(3000)] + [(90, "a:1")], "pct int, name string").repartition(7)
    write_consensus(cons, tmpdir_path + "/cons")
    files = sorted(f for f in os.listdir(tmpdir_path + "/cons/pct=100") if f.startswith("part"))
    names = [x for f in files for x in open(tmpdir_path + "/cons/pct=100/" + f).read().split()]
    assert names == sorted(names) and len(names) == 3000
    plan = run_plan(spark, family="nn")
    ids = sorted(r["list_id"] for r in plan.collect())
    import numpy as np

    from motifspark.operators.predict import LinearModels
    scored = spark.createDataFrame([("x:1", 2, [5]), ("y:1", 0, [0])], "NAME string, support long, hits array<bigint>")
    write_predictions(prediction_pairs(scored, LinearModels(ids, np.zeros((len(ids), 1)), np.zeros(len(ids))), plan=plan), tmpdir_path + "/pred")
    back = spark.read.parquet(tmpdir_path + "/pred")
    assert sorted(r["list_id"] for r in back.collect()) == sorted([ids[0], ids[2]]) and {"family", "tag", "mult"} <= set(back.columns)
    os.makedirs(tmpdir_path + "/none")
    with pytest.raises(FileNotFoundError):
        read_prediction_lists(spark, tmpdir_path + "/none")


def test_parameter_cache_and_model_store(spark, tmpdir_path):
    from motifspark.sources.tables import read_models, read_params, write_models, write_params
    schema = "family string, crit string, tag string, mult int, n_feats int, model string, params string, score double"
    assert read_params(spark, tmpdir_path + "/p").count() == 0
    write_params(spark.createDataFrame([("linear", "f1", "PTM", 1, 69, "sgd", "{}", 0.5), ("linear", "f1", "PTM", 2, 69, "sgd", "{}", 0.6)], schema), tmpdir_path + "/p")
    write_params(spark.createDataFrame([("linear", "f1", "PTM", 1, 69, "sgd", '{"a": 1}', 0.7)], schema), tmpdir_path + "/p")
    assert sorted((r["mult"], r["params"], r["score"]) for r in read_params(spark, tmpdir_path + "/p").collect()) == [(1, '{"a": 1}', 0.7), (2, "{}", 0.6)]
    assert read_models(spark, tmpdir_path + "/m", required=False).count() == 0
    m = spark.createDataFrame([("a", [1.0, -2.5], 0.25)], "list_id string, weights array<double>, bias double")
    write_models(m, tmpdir_path + "/m")
    assert read_models(spark, tmpdir_path + "/m").collect() == m.collect()


def test_searches_that_save_one_key_at_once_leave_one_winner(spark, tmpdir_path, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    from motifspark.sources import tables
    schema = "family string, crit string, tag string, mult int, n_feats int, model string, params string, score double"
    path = tmpdir_path + "/p"
    first = spark.createDataFrame([("linear", "f1", "PTM", 1, 69, "sgd", "{}", 0.1)], schema)
    tables.write_params(first, path)
    monkeypatch.setattr(tables.F, "unix_micros", lambda _: tables.F.lit(2 ** 62))   # all of them in one microsecond
    commits = [spark.createDataFrame([("linear", "f1", "PTM", m, 69, "sgd", f'{{"by": {w}}}', float(w)) for m in (1, 2)], schema) for w in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda df: tables.write_params(df, path), commits))
    assert spark.read.option("recursiveFileLookup", True).json(path).count() == 13   # nobody's files are lost
    seen = [sorted((r["mult"], r["params"], r["commit"]) for r in tables.read_params(spark, path).repartition(n).collect()) for n in (1, 5)]
    assert seen[0] == seen[1] and len(seen[0]) == 2
    assert seen[0][0][1:] == seen[0][1][1:]      # both keys from the same commit
    assert seen[0][0][2] == spark.read.option("recursiveFileLookup", True).json(path).where(f"saved = {2 ** 62}").agg({"commit": "max"}).first()[0]
