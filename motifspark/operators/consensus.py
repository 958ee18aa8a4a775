"""Voting across prediction lists.

Input is a table of prediction lists ``(list_id, name)``. A list is deduplicated,
blank names are ignored, and a list left empty does not count towards N.
``support(name)`` = number of lists containing the name; at threshold p a name
is kept when ``support >= ceil(p / 100 * N)`` (float arithmetic, as the
reference computes it).

Plan: one ``groupBy(name)`` over ``(list_id, name)`` pairs deduplicated with a
partial (map-side) aggregate, so a name repeated in one list -- even a third of
all rows -- is combined before the shuffle. N is a lazy scalar subquery. All
thresholds come out of one pass (explode of the thresholds each row meets).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from motifspark.plans.runplan import THRESHOLDS


def clean_lists(pairs: DataFrame, list_col: str = "list_id", name_col: str = "name") -> DataFrame:
    n = F.trim(F.col(name_col))
    return pairs.select(F.col(list_col).alias("list_id"), n.alias("name")).where(F.length("name") > 0)


def fragment_support(pairs: DataFrame, list_col: str = "list_id", name_col: str = "name") -> DataFrame:
    """``(name, support)``."""
    c = clean_lists(pairs, list_col, name_col).distinct()
    return c.groupBy("name").agg(F.count(F.lit(1)).alias("support"))


def n_lists(pairs: DataFrame, list_col: str = "list_id", name_col: str = "name") -> Column:
    """Number of lists with at least one non-blank name (scalar subquery)."""
    return clean_lists(pairs, list_col, name_col).agg(F.countDistinct("list_id").alias("n")).scalar()


class NoLists(ValueError):
    pass


def checked_n(n: Column) -> Column:
    """N, or an error where no list has a name: there is nothing to vote on."""
    none = F.raise_error(F.lit("all prediction lists are empty"))
    return F.when(F.coalesce(n, F.lit(0)) > 0, n).otherwise(none).cast("bigint")


def threshold_k(pct, n: Column) -> Column:
    """``ceil(p / 100 * N)`` in double arithmetic."""
    p = pct if isinstance(pct, Column) else F.lit(int(pct))
    return F.ceil(p.cast("double") / F.lit(100.0) * n.cast("double")).cast("bigint")


def consensus(support: DataFrame, n: Column, thresholds=THRESHOLDS, keep=()) -> DataFrame:
    """``(pct, name, support, *keep)`` for every threshold a name meets, one pass.

    A name needs a vote (support >= 1); N = 0 is an error (``checked_n``).
    """
    ths = sorted({int(t) for t in thresholds})
    n = checked_n(n)
    met = F.array_compact(F.array(*[F.when((F.col("support") >= 1) & (F.col("support") >= threshold_k(t, n)), F.lit(t)) for t in ths]))
    return support.select(F.explode(met).alias("pct"), "name", "support", *keep)


def consensus_from_pairs(pairs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """F5 from lists; raises ``NoLists`` when no list has a name (the rows alone could not tell)."""
    if clean_lists(pairs).limit(1).count() == 0:
        raise NoLists("all prediction lists are empty")
    return consensus(fragment_support(pairs), n_lists(pairs), thresholds)


def consensus_counts(consensus_df: DataFrame, n: Column, thresholds=THRESHOLDS) -> DataFrame:
    """A3: ``(pct, k, n_kept)`` for every threshold, 0 when none is kept.

    The thresholds table is the argument list itself (a handful of rows), so it
    is broadcast; the counts come from one partial aggregate.
    """
    spark = consensus_df.sparkSession
    ths = spark.createDataFrame([(int(t),) for t in sorted({int(t) for t in thresholds})], "pct int")
    counts = consensus_df.groupBy("pct").agg(F.count(F.lit(1)).alias("n_kept"))
    j = ths.join(F.broadcast(counts), "pct", "left")   # counts: at most len(thresholds) rows
    return j.select("pct", threshold_k(F.col("pct"), n).alias("k"),
                    F.coalesce(F.col("n_kept"), F.lit(0).cast("bigint")).alias("n_kept"))


def support_summary(support: DataFrame, n: Column) -> DataFrame:
    """N, distinct fragments, max support and its share in percent (2 decimals)."""
    s = support.agg(F.count(F.lit(1)).alias("n_unique"), F.max("support").alias("max_support"))
    return s.select(n.alias("n_lists"), "n_unique", "max_support",
                    F.round(F.lit(100.0) * F.col("max_support") / n.cast("double"), 2).alias("max_pct"))


def top_fragments(support: DataFrame, top: int = 20) -> DataFrame:
    """T4: top-N names by support (ties by name). The limit IS the feature here."""
    return support.orderBy(F.desc("support"), F.asc("name")).limit(top)


def uniq_lists(pairs: DataFrame) -> DataFrame:
    """K6/T5: sorted-unique companion of each list."""
    return clean_lists(pairs).distinct().sortWithinPartitions("list_id", "name")
