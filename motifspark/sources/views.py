"""Domain views over the driver's Parquet test tables.

Each view is an ordinary DataFrame over the given tables, so its work grows
with them. The SQL twins used as oracles live in ``motifspark.sources.oracle``.

* ``sequences``  documents -> ``seq_id='D'||doc_id``, residues only, upper case (whole text)
* ``windows``    sliding windows of ``sequences``
* ``id_list``    ``'D'||doc_id`` of documents with ``quality = 0``
* ``features_small`` / ``features_dirty`` / ``features_text``  embeddings as a feature table
* ``features_big``   residue composition of every window
* ``importance`` per embedding position, |class-0 mean - class-1 mean|
* ``models_linear``  one linear model per list of a default run, md5 weights
* ``votes_wide`` lineitem as prediction lists (duplicates on purpose)
* ``candidates`` labels x a small md5 grid, for metric and best-candidate checks
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from motifspark.functions.hashing import hex8_int
from motifspark.functions.text import RESIDUES, clean_residues
from motifspark.operators.windows import sliding_windows
from motifspark.plans.runplan import run_plan

N_EMB = 64          # embedding width in the test tables
W = 15              # default window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("seq_id"),
                    clean_residues("text").alias("seq"),
                    F.lit("documents").alias("source"), F.octet_length("text").alias("raw_len"))


def windows(spark: SparkSession, sf_dir: str, w: int = W, step: int = 1, min_len: int = W) -> DataFrame:
    return sliding_windows(sequences(spark, sf_dir), w=w, step=step, min_len=min_len)


def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.where(F.col("quality") == 0).select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"))


def feature_names(n: int = N_EMB) -> list[str]:
    return [f"f{i}" for i in range(n)]


def features_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    name = F.concat(F.lit("E"), (F.col("vec_id") % 50).cast("string"), F.lit(":"), (F.col("vec_id") + 1).cast("string"))
    feats = [F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(N_EMB)]
    return e.select(name.alias("NAME"), *feats, F.when(F.col("label") == 0, 0).otherwise(1).alias("CLASS"))


def features_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features_small with NULL / NaN / +inf / -inf at cells where (vec_id + i) % 7 is 0 / 1 / 2 / 3."""
    e = table(spark, sf_dir, "embeddings")
    name = F.concat(F.lit("E"), (F.col("vec_id") % 50).cast("string"), F.lit(":"), (F.col("vec_id") + 1).cast("string"))
    cols = []
    for i in range(N_EMB):
        k = (F.col("vec_id") + i) % 7
        v = F.col("embedding")[i].cast("double")
        cols.append(F.when(k == 0, F.lit(None).cast("double"))
                    .when(k == 1, F.lit(float("nan")))
                    .when(k == 2, F.lit(float("inf")))
                    .when(k == 3, F.lit(float("-inf")))
                    .otherwise(v).alias(f"f{i}"))
    return e.select(name.alias("NAME"), *cols, F.when(F.col("label") == 0, 0).otherwise(1).alias("CLASS"))


def features_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature table read as text: numbers, blanks and words side by side."""
    e = table(spark, sf_dir, "embeddings")
    k = F.col("vec_id") % 4
    t1 = F.when(k == 0, F.lit("n/a")).when(k == 1, F.lit("")).otherwise(F.col("label").cast("string"))
    t2 = F.when(k == 2, F.lit("x")).otherwise((F.col("vec_id") * 3 - 7).cast("string"))
    return e.select(F.concat(F.lit("E"), F.col("vec_id").cast("string")).alias("NAME"),
                    F.col("vec_id").cast("string").alias("t0"), t1.alias("t1"), t2.alias("t2"))


def features_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motifspark.operators.features import composition_features
    return composition_features(windows(spark, sf_dir))


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """|mean(class 0) - mean(class 1)| per embedding position, rounded to 9 places."""
    fs = features_small(spark, sf_dir)
    aggs = []
    for i in range(N_EMB):
        c = F.col(f"f{i}")
        d = F.abs(F.avg(F.when(F.col("CLASS") == 0, c)) - F.avg(F.when(F.col("CLASS") == 1, c)))
        aggs.append(F.round(d, 9).alias(f"f{i}"))
    wide = fs.agg(*aggs)
    stack = "stack(%d, %s) as (feature, importance)" % (N_EMB, ", ".join(f"'f{i}', f{i}" for i in range(N_EMB)))
    return wide.selectExpr(stack)


def _h(expr) -> F.Column:
    return hex8_int(F.md5(expr))


def models_linear(spark: SparkSession, n_features: int = len(RESIDUES)) -> DataFrame:
    """One linear model per list of a default run (172), weights from md5.

    w_i = base_i + noise_(list,i), base_i in [-0.5, 0.5), noise in [-1/8, 1/8), all
    multiples of 1/1024; the bias is an odd multiple of 1/2048, so with
    composition features (multiples of 1/w) no margin is ever exactly 0.
    """
    plan = run_plan(spark).select("list_id")
    idx = F.sequence(F.lit(0), F.lit(n_features - 1))
    weights = F.transform(idx, lambda i: (
        ((_h(F.concat(F.lit("base:"), i.cast("string"))) % 1024) - 512) / F.lit(1024.0)
        + ((_h(F.concat(F.col("list_id"), F.lit(":"), i.cast("string"))) % 256) - 128) / F.lit(1024.0)))
    bias = ((_h(F.concat(F.col("list_id"), F.lit(":bias"))) % 256) - 128) / F.lit(1024.0) + F.lit(1.0 / 2048)
    return plan.select("list_id", weights.alias("weights"), bias.alias("bias"))


def votes_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction lists from lineitem: list = line number, name = part (50 to a sequence), so names grow with the data; duplicates kept."""
    li = table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey")
    name = F.concat(F.lit("P"), F.floor(part / 50).cast("string"), F.lit(":"), (part % 50 + 1).cast("string"))
    return li.select(F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("list_id"), name.alias("name"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels x 7 candidates; candidate g predicts 1 when u(g:doc) < min(g,5)/5.

    c0 never predicts 1 (zero precision denominator), c5 and c6 tie exactly.
    """
    lab = table(spark, sf_dir, "labels").where(F.col("quality").isNotNull())
    grid = F.explode(F.sequence(F.lit(0), F.lit(6))).alias("grid_ord")
    x = lab.select("doc_id", "quality", grid)
    g = F.least(F.col("grid_ord"), F.lit(5))
    u = _h(F.concat(g.cast("string"), F.lit(":"), F.col("doc_id").cast("string"))) / F.lit(4294967296.0)
    return x.select(F.concat(F.lit("c"), F.col("grid_ord").cast("string")).alias("cand"),
                    F.col("grid_ord").cast("int").alias("grid_ord"),
                    F.col("quality").cast("int").alias("y_true"),
                    F.when(u < g / F.lit(5.0), 1).otherwise(0).alias("y_pred"))


def benchmark_sequences(spark: SparkSession, sf_dir: str, prefix: str = "B") -> DataFrame:
    """Known fragments ("positives"): benchmark passages, residues only."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.concat(F.lit(prefix), F.col("item_id").cast("string")).alias("seq_id"),
                    clean_residues("text").alias("seq"), F.lit("benchmark").alias("source"))


def positive_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motifspark.operators.features import composition_features
    return composition_features(sliding_windows(benchmark_sequences(spark, sf_dir)))


def reference_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motifspark.operators.features import composition_features
    return composition_features(windows(spark, sf_dir))
