"""Merging kept fragments into regions.

Fragments are fixed-length windows ``[start, start + w - 1]``. Sorted by start,
a fragment joins the current region when ``start <= previous_start + w - 1``
(touching, ``= end + 1``, does not join). Regions keep ``min(start)``,
``max(start) + w - 1`` and the number of distinct starts; small ones are dropped.

Skew-safe plan (no window partition holds a whole sequence): starts are cut into
blocks of ``block`` positions; ``lag`` runs inside (key, seq_id, block); a
second, tiny window over per-block summaries carries the open region across
block borders; the region label is the start of its first fragment; one
partial-then-final aggregate per region finishes. A sequence holding a third of
all fragments is thus spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from motifspark.functions.ids import split_fragment_id
from motifspark.session import materialise

BLOCK = 1 << 20


def parse_fragments(frags: DataFrame, name_col: str = "name", keys=(), strict: bool = True) -> DataFrame:
    """``name`` -> ``(seq_id, start)``; blank names skipped."""
    n = F.trim(F.col(name_col))
    f = frags.where(F.length(n) > 0)
    seq_id, start = split_fragment_id(F.col(name_col), strict=strict)
    return f.select(*keys, seq_id.alias("seq_id"), start.alias("start"))


def merge_regions(starts: DataFrame, w: int = 15, min_frags: int = 2, keys=(),
                  distinct: bool = True, block: int = BLOCK) -> DataFrame:
    """``(*keys, seq_id, start)`` -> ``(*keys, seq_id, start, end, n_frags)``."""
    keys = list(keys)
    part = keys + ["seq_id"]
    s = starts.select(*part, "start")
    if distinct:
        s = s.distinct()                                              # A4
    # The starts feed both the per-row pass and the per-block summary; written
    # once so the (possibly expensive) upstream lineage runs once.
    s = materialise(s.withColumn("blk", F.floor((F.col("start") - 1) / F.lit(block)).cast("bigint")), "starts")
    w_in = Window.partitionBy(*part, "blk").orderBy("start")
    prev = F.lag("start").over(w_in)
    s = s.withColumn("prev", prev)
    new_local = F.col("prev").isNotNull() & (F.col("start") > F.col("prev") + F.lit(w - 1))
    s = s.withColumn("new_local", new_local)
    s = s.withColumn("begin_local", F.max(F.when(F.col("new_local"), F.col("start")))
                     .over(w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    blocks = s.groupBy(*part, "blk").agg(F.min("start").alias("first"), F.max("start").alias("last"),
                                         F.max(F.when(F.col("new_local"), F.col("start"))).alias("maxb"))
    w_b = Window.partitionBy(*part).orderBy("blk")
    prev_last = F.lag("last").over(w_b)
    blocks = blocks.withColumn("first_begins", prev_last.isNull() | (F.col("first") > prev_last + F.lit(w - 1)))
    blk_begin = F.coalesce(F.col("maxb"), F.when(F.col("first_begins"), F.col("first")))
    blocks = blocks.withColumn("blk_begin", blk_begin)
    blocks = blocks.withColumn("carried", F.max("blk_begin").over(w_b.rowsBetween(Window.unboundedPreceding, -1)))
    blocks = blocks.select(*part, "blk", "first", "first_begins", "carried")
    j = s.join(blocks, part + ["blk"], "inner")
    island = F.coalesce(F.col("begin_local"),
                        F.when(F.col("first_begins"), F.col("first")).otherwise(F.col("carried")))
    j = j.select(*part, "start", island.alias("island"))
    r = j.groupBy(*part, "island").agg(F.min("start").alias("start"),
                                       (F.max("start") + F.lit(w - 1)).alias("end"),
                                       F.count(F.lit(1)).alias("n_frags"))
    return r.where(F.col("n_frags") >= min_frags).select(*part, "start", "end", "n_frags")


def regions_from_names(frags: DataFrame, w: int = 15, min_frags: int = 2, keys=(), name_col: str = "name") -> DataFrame:
    """consensus names (optionally per key such as ``pct``) -> regions."""
    return merge_regions(parse_fragments(frags, name_col, keys), w=w, min_frags=min_frags, keys=keys)


def sort_regions(regions: DataFrame, keys=()) -> DataFrame:
    """Order by (keys, seq_id, start, end)."""
    return regions.orderBy(*keys, "seq_id", "start", "end")
