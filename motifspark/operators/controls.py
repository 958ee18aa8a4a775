"""Control pools and labelled training tables.

Controls are windows of the reference set: either those whose sequence is in an
ID list (semi join), or a seeded random draw from the windows whose sequence
is in none of the exclude lists (anti join, then exact-n sample).

ID lists grow with the data, so they are broadcast only behind a row-count
check; beyond it the join is a shuffle join and AQE sizes it at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from motifspark.functions.ids import id_part
from motifspark.operators.joins import checked_broadcast
from motifspark.operators.sampling import Source, bucket_samples, sample_n

ID_BROADCAST_ROWS = 1_000_000


def _ids(ids: DataFrame, col: str = "id") -> DataFrame:
    c = F.trim(F.col(col))
    return ids.select(c.alias("_id")).where(F.length("_id") > 0).distinct()


def union_ids(*id_lists: DataFrame, col: str = "id") -> DataFrame:
    """Union of several ID lists, deduplicated."""
    out = None
    for ids in id_lists:
        x = _ids(ids, col)
        out = x if out is None else out.unionByName(x)
    return out.distinct() if out is not None else None


def control_by_ids(features: DataFrame, ids: DataFrame, name_col: str = "NAME", id_col: str = "id",
                   broadcast_rows: int = ID_BROADCAST_ROWS) -> DataFrame:
    """Rows whose ID part (before the first ':') is in the list."""
    side = checked_broadcast(_ids(ids, id_col), broadcast_rows)
    return features.join(side, id_part(F.col(name_col)) == F.col("_id"), "left_semi")


def control_exclude(features: DataFrame, *exclude: DataFrame, name_col: str = "NAME", id_col: str = "id",
                    broadcast_rows: int = ID_BROADCAST_ROWS) -> DataFrame:
    """Rows whose ID part is in none of the exclude lists (IDs are never NULL: NOT IN == anti join)."""
    if not exclude:
        return features
    side = checked_broadcast(union_ids(*exclude, col=id_col), broadcast_rows)
    return features.join(side, id_part(F.col(name_col)) == F.col("_id"), "left_anti")


def sequences_by_ids(seqs: DataFrame, ids: DataFrame, id_col: str = "id", exclude: bool = False,
                     broadcast_rows: int = ID_BROADCAST_ROWS) -> DataFrame:
    """J1/J2 below the windows: the sequences whose ID part is (``exclude``: is not) in the list.

    A window's ID part is its sequence's, so the join can stand next to the scan
    and only the wanted sequences are ever cut into windows.
    """
    side = checked_broadcast(_ids(ids, id_col), broadcast_rows, persist=False)
    return seqs.join(side, id_part(F.col("seq_id")) == F.col("_id"), "left_anti" if exclude else "left_semi")


def random_controls(features: DataFrame, n: int, seed, *exclude: DataFrame, name_col: str = "NAME", source: Source | None = None) -> DataFrame:
    """F2 (random pool): anti join then exact-n seeded sample.

    The histograms read the name column only; the final filter on the name's key
    stands below the feature projection, so features are computed for the sample alone. ``source``: what makes
    ``features``, where nothing is excluded.
    """
    return sample_n(control_exclude(features, *exclude, name_col=name_col), n, seed, name_col, None if exclude else source)


def label_union(positives: DataFrame, controls: DataFrame, label_col: str = "CLASS") -> DataFrame:
    """Positives get class 0, controls class 1; columns unioned by name (missing -> NULL)."""
    p = positives.withColumn(label_col, F.lit(0))
    c = controls.withColumn(label_col, F.lit(1))
    return p.unionByName(c, allowMissingColumns=True)


def training_tables(positives: DataFrame, pools: dict, n_pos: int, mults=(1, 2, 5, 10), seed=0,
                    name_col: str = "NAME", sources: dict | None = None) -> DataFrame:
    """one labelled table per (tag, mult): positives (0) + bucket sample of the tag's pool (1).

    The positives are read once and repeated for the (tag, mult) pairs, which are configuration. ``sources``: what makes a tag's pool, where that is known.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(int(m)).alias("mult")) for t in pools for m in mults]))
    cols = positives.columns
    pos = positives.select(pairs.alias("_p"), *cols).select("_p.tag", "_p.mult", *cols)
    ctrl = None
    for tag, pool in pools.items():
        b = bucket_samples(pool, n_pos, mults, seed, name_col, (sources or {}).get(tag)).select(F.lit(tag).alias("tag"), "mult", *pool.columns)
        ctrl = b if ctrl is None else ctrl.unionByName(b, allowMissingColumns=True)
    return label_union(pos, ctrl)
