"""Exact k-nearest neighbours (J9, W6) and the resamplers built on it.

kNN plan: when the reference rows fit ``broadcast_bytes`` (checked by count and
width), they are sent to the tasks once and every query finds its neighbours
where it stands: no shuffle. Beyond that, rows go to the cells of pivots and a
query visits only the cells that distance bounds leave open (``pivotknn``). Both
are exact; ties are broken by neighbour id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from motifspark.functions.hashing import hex8_int
from motifspark.operators.pivotknn import nearest, pivot_knn
from motifspark.operators.windows import below_one_split_a_core
from motifspark.session import materialise

BROADCAST_BYTES = 64 << 20


def knn(df: DataFrame, k: int, id_col: str = "NAME", vec_col: str = "x", ref: DataFrame | None = None,
        exclude_self: bool = True, block_rows: int = 2048, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(id, nid, dist, rank)`` for the k nearest ``ref`` rows of every ``df`` row (Euclidean)."""
    ref = df if ref is None else ref
    size = ref.agg(F.count(F.lit(1)), F.sum(F.size(vec_col) * 8 + F.octet_length(F.col(id_col).cast("string")) + 64)).first()
    out = "id string, nid string, dist double, rank int"
    if (size[1] or 0) <= broadcast_bytes:
        rows = ref.select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).alias("x")).orderBy("id").collect()   # at most broadcast_bytes
        shared = df.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in rows], dtype=object),
                                                         np.array([r["x"] for r in rows], dtype=np.float64)))

        def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rid, R = shared.value
            for batch in batches:
                if not len(rid) or not batch.num_rows:
                    continue
                qid = np.array(batch.column(0).to_pylist(), dtype=object)
                Q = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(qid), -1)
                q, r, d2, rank = nearest(qid, Q, rid, R, k, exclude_self)
                yield pa.RecordBatch.from_arrays([pa.array(qid[q].tolist(), pa.string()), pa.array(rid[r].tolist(), pa.string()),
                                                  pa.array(np.sqrt(d2)), pa.array(rank.astype(np.int32))], ["id", "nid", "dist", "rank"])

        queries = df.select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
        if below_one_split_a_core(df):   # few bytes, but every row meets all references
            queries = queries.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "id")
        return queries.mapInArrow(here, out)

    return pivot_knn(df, ref, k, id_col, vec_col, exclude_self, block_rows)


def _u(*parts) -> F.Column:
    key = F.concat_ws(":", *[p.cast("string") if isinstance(p, F.Column) else F.lit(str(p)) for p in parts])
    return hex8_int(F.md5(key)) / F.lit(4294967296.0)


def smote(df: DataFrame, feature_cols: list[str], k: int = 5, seed: int = 0, label_col: str = "CLASS",
          name_col: str = "NAME", minority=None, block_rows: int = 2048) -> DataFrame:
    """Oversample the minority class to the majority size.

    Each minority row gets ``floor(need / n_min)`` synthetic rows, plus one more
    for the first ``need mod n_min`` rows in md5 order (an exact selection);
    synthetic j of row i = x_i + u * (x_nn - x_i) with the neighbour chosen
    among i's k nearest minority rows and u in [0, 1), both from md5(seed, i, j).
    Returns the input plus the synthetic rows (names ``<name>#s<j>``).
    """
    from motifspark.operators.sampling import class_sizes, first_n_by_key
    counts = class_sizes(df, label_col)
    if len(counts) < 2:
        return df
    mino = minority if minority is not None else min(counts, key=lambda c: (counts[c], c))
    majo = max(counts.values())
    n_min = counts[mino]
    need = majo - n_min
    if need <= 0:
        return df
    vec = F.array(*[F.col(c).cast("double") for c in feature_cols])
    mins = df.where(F.col(label_col) == F.lit(mino)).select(F.col(name_col).alias("NAME"), vec.alias("x"))
    nn = knn(mins, k, "NAME", "x", block_rows=block_rows)
    kk = min(k, n_min - 1)
    if kk <= 0:
        raise ValueError("SMOTE needs at least 2 minority rows")
    base, extra = divmod(need, n_min)
    plus = first_n_by_key(mins.select("NAME"), extra, f"{seed}:extra", "NAME") \
        .withColumn("plus", F.lit(1)) if extra else None
    m = mins.join(plus, "NAME", "left") if plus is not None else mins.withColumn("plus", F.lit(None).cast("int"))
    m = m.withColumn("c", F.lit(base) + F.coalesce(F.col("plus"), F.lit(0))).where(F.col("c") > 0)
    gen = m.select("NAME", "x", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j"))
    r = (hex8_int(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("NAME"), F.col("j").cast("string"), F.lit("nn"))))
         % kk + 1).cast("int")
    u = _u(seed, F.col("NAME"), F.col("j"), "u")
    gen = gen.select("NAME", "x", "j", r.alias("rank"), u.alias("u"))
    gen = gen.join(nn.select(F.col("id").alias("NAME"), "nid", "rank"), ["NAME", "rank"], "inner")
    gen = gen.join(mins.select(F.col("NAME").alias("nid"), F.col("x").alias("xn")), "nid", "inner")
    newx = F.zip_with("x", "xn", lambda a, b: a + F.col("u") * (b - a))
    syn = gen.select(F.concat(F.col("NAME"), F.lit("#s"), F.col("j").cast("string")).alias(name_col), newx.alias("_x"))
    syn = syn.select(name_col, *[F.col("_x")[i].alias(c) for i, c in enumerate(feature_cols)],
                     F.lit(mino).cast(df.schema[label_col].dataType).alias(label_col))
    return df.select(name_col, *feature_cols, label_col).unionByName(syn)


def edited_nn(df: DataFrame, feature_cols: list[str], k: int = 3, label_col: str = "CLASS", name_col: str = "NAME",
              kind: str = "all", classes=None, block_rows: int = 2048, broadcast_bytes: int = BROADCAST_BYTES, neighbours: DataFrame | None = None) -> DataFrame:
    """Drop rows whose k nearest neighbours disagree with their class.

    ``kind='all'``: keep a row only if all k neighbours share its class;
    ``'mode'``: keep it if most do. ``classes`` limits which classes are edited
    (default: all). Returns a subset of the input rows. ``neighbours``: what ``knn`` gave for these rows
    with at least this k, where several k edit one table.
    """
    vec = F.array(*[F.col(c).cast("double") for c in feature_cols])
    pts = df.select(F.col(name_col).cast("string").alias("NAME"), vec.alias("x"), F.col(label_col).alias("y"))
    nn = knn(pts.select("NAME", "x"), k, "NAME", "x", block_rows=block_rows, broadcast_bytes=broadcast_bytes) if neighbours is None else neighbours.where(F.col("rank") <= k)
    lab = pts.select(F.col("NAME").alias("nid"), F.col("y").alias("ny"))
    votes = nn.join(lab, "nid").join(pts.select(F.col("NAME").alias("id"), "y"), "id") \
              .groupBy("id").agg(F.sum(F.when(F.col("ny") == F.col("y"), 1).otherwise(0)).alias("same"),
                                 F.count(F.lit(1)).alias("n"))
    bad = F.col("same") < F.col("n") if kind == "all" else F.col("same") * 2 <= F.col("n")
    drop = votes.where(bad).select(F.col("id").alias("_drop"))
    out = df.join(drop, F.col(name_col).cast("string") == F.col("_drop"), "left_anti")
    if classes is not None:
        keep_cls = df.where(~F.col(label_col).isin(list(classes)))
        out = out.where(F.col(label_col).isin(list(classes))).unionByName(keep_cls)
    return out


def smote_enn(df: DataFrame, feature_cols: list[str], k_smote: int = 5, k_enn: int = 3, seed: int = 0,
              label_col: str = "CLASS", name_col: str = "NAME", scale: bool = True) -> DataFrame:
    """Min-max scale -> SMOTE -> ENN (the scaler is fitted on the input)."""
    from motifspark.operators.scaling import minmax_scale
    x = minmax_scale(df.select(name_col, *feature_cols, label_col), feature_cols) if scale else df
    more = materialise(smote(x, feature_cols, k_smote, seed, label_col, name_col), "oversampled")   # the editing reads it several times
    return edited_nn(more, feature_cols, k_enn, label_col, name_col)
