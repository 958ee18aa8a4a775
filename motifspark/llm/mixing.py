"""Mixing sources to target weights by Pareto order sampling.

Every source has a target number of words. A document gets the whole copies that its source's ratio (target over
size) makes certain; the rest of the target is a fixed-size sample with unequal chances. Document i has inclusion
odds ``f / (1 - f) * g_i``, f the fraction left over and g_i between 1/2 and 3/2, larger for longer documents. Its
rank is ``(u / (1 - u)) / odds`` with u uniform from a hash of the row, and the smallest ranks are taken until
their words are as near to the rest of the target as they can be.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motifspark.llm.common import materialise, n_words

#: A table of at most this many rows (one per source) is broadcast.
BROADCAST_ROWS = 100_000


def _null_safe_text(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))


def uniform(seed: str, *cols: Column) -> Column:
    """A number in (0, 1) from the md5 of a seed and of some columns; equal rows get equal numbers."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *map(_null_safe_text, cols)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(sources: DataFrame, weights: tuple[int, ...], total: float, most: float) -> DataFrame:
    """(source, source_size, n_docs) -> also target: shares of ``total`` times all words by repeating weights, filled level
    by level so that no source exceeds ``most`` times its size.

    One row per source goes through one task here; sources are names, not data, and their rows hold three numbers.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("place", F.row_number().over(ordered) - 1)
    w = w.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double"))
    w = w.withColumn("most", F.col("source_size") * F.lit(float(most)))
    filled = Window.orderBy(F.col("most") / F.col("w"), "place").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("all_words", F.sum("source_size").over(every) * F.lit(float(total))).withColumn("all_w", F.sum("w").over(every))
    w = w.withColumn("level", (F.col("all_words") - F.coalesce(F.sum("most").over(filled), F.lit(0.0)))
                     / (F.col("all_w") - F.coalesce(F.sum("w").over(filled), F.lit(0.0))))  # never 0: its own weight is in it
    w = w.withColumn("full", F.col("most") / F.col("w") <= F.col("level"))
    # the first source that its share does not fill sets the level of all that follow
    w = w.withColumn("level", F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(
        Window.orderBy(F.col("most") / F.col("w"), "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return w.select("source", "source_size", "n_docs", F.when(F.col("full"), F.col("most")).otherwise(F.col("w") * F.col("level")).alias("target"))


def _rank(rows: DataFrame) -> DataFrame:
    """Pareto rank ``q`` of each row of a source that has a fraction left over; null for others."""
    mean = F.col("source_size") / F.col("n_docs")
    rows = rows.withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("int"))
    rows = rows.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = rows.withColumn("f", F.try_divide("rest", "source_size"))  # null for a source without words
    odds = F.try_divide(F.col("f"), F.lit(1.0) - F.col("f")) * (F.lit(0.5) + F.try_divide(F.col("size"), F.col("size") + mean))
    return rows.withColumn("q", F.when(F.col("f") > 0, F.try_divide(F.col("u") / (F.lit(1.0) - F.col("u")), odds)))


def _join_sources(rows: DataFrame, by_source: DataFrame, n: int) -> DataFrame:
    right = by_source.withColumnRenamed("source", "__source")
    return rows.join(F.broadcast(right) if n <= BROADCAST_ROWS else right, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), total: float = 1.5, most: float = 2.0, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(decisions, mixed).

    decisions: one row per input row: id, source, size, source_size, target, copies, taken. mixed: every input column,
    each row as often as the mix takes it.

    Sizes are read once and kept in the shared folder; a source is cut by counting words in sqrt(rows) rank buckets
    and looking only into the bucket where the count crosses the target, so a source with a third of all rows is one
    partial sum per task. Null text: size 0, never taken (its size changes nothing). Null source: a source of its own,
    last in order. Rows that are equal in id and text share one rank, so they are taken together or not at all. An
    empty table gives two empty ones. The source of a text or id of another type is its string form.
    """
    facts = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
                        uniform(seed, F.col(id_col), F.md5(F.col(text_col).cast("binary"))).alias("u"))
    facts = materialise(facts, "mix_sizes")
    sources = materialise(facts.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "mix_sources")
    n_sources, n_rows = sources.agg(F.count(F.lit(1)), F.sum("n_docs")).first()
    targets = materialise(source_targets(sources, weights, total, most), "mix_targets")
    buckets = max(64, math.isqrt(n_rows or 0))

    def ranked(rows: DataFrame, by_source: DataFrame) -> DataFrame:
        q = F.col("q")
        return _rank(_join_sources(rows, by_source, n_sources)).withColumn("bucket", F.floor(q / (F.lit(1.0) + q) * buckets))

    rows = ranked(facts, targets)
    before = Window.partitionBy("source").orderBy("bucket")
    sums = (rows.where("q IS NOT NULL").groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
            .withColumn("till", F.sum("words").over(before)).withColumn("from", F.col("till") - F.col("words")))
    last = Window.partitionBy("source")
    sums = sums.withColumn("crosses", F.coalesce(F.min(F.when(F.col("till") >= F.col("rest"), F.col("bucket"))).over(last), F.max("bucket").over(last)))
    cross = materialise(sums.where("bucket = crosses").select("source", F.col("bucket").alias("cross"), F.col("from").alias("before")), "mix_cross")

    targets2 = targets.join(cross.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2")
    inside = ranked(facts, targets2).where("bucket = cross")
    so_far = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("q"))  # equal ranks count together
    ends = inside.select("source", "q", "rest", "before", so_far.alias("got"))
    ends = ends.groupBy("source").agg(F.min(F.struct(F.abs(F.col("got") - F.col("rest")).alias("off"), "got", "q")).alias("best"),
                                      F.min(F.abs(F.col("before") - F.col("rest"))).alias("none"))
    ends = ends.select(F.col("source").alias("s2"), F.when(F.col("none") <= F.col("best.off"), F.lit(-1.0)).otherwise(F.col("best.q")).alias("last_q"))
    final = materialise(targets2.join(ends, F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2"), "mix_final")

    def copies(ranked_rows: DataFrame) -> DataFrame:
        take = F.coalesce((F.col("bucket") < F.col("cross")) | (F.col("q") <= F.col("last_q")), F.lit(False))
        return ranked_rows.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + take.cast("int")).otherwise(F.lit(0)))

    decisions = copies(ranked(facts, final)).select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                                                    "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
    packed = docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
                         uniform(seed, F.col(id_col), F.md5(F.col(text_col).cast("binary"))).alias("u"))
    taken = copies(ranked(packed, final)).where("copies > 0")
    mixed = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
    return decisions, mixed


#: The same decisions in one SQL statement: whole windows instead of rank buckets.
ORACLE_SQL = r"""
WITH facts AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix:' || coalesce('=' || doc_id::VARCHAR, '~') || ':' || coalesce('=' || md5(text), '~')) AS h
  FROM documents),
rows_ AS (SELECT doc_id, source, size, (('0x' || substr(h, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM facts),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM rows_ GROUP BY source),
weighed AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w,
    source_size::DOUBLE * 2.0 AS most, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sources),
levels AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
      - coalesce(sum(most) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS lv
  FROM weighed),
targets AS (SELECT *, CASE WHEN most / w <= lv THEN most ELSE w * (SELECT arg_min(lv, struct_pack(a := most / w, b := place))
    FROM levels WHERE most / w > lv) END AS target FROM levels),
ranked AS (SELECT r.*, t.source_size, t.n_docs, t.target, floor(t.target / t.source_size) AS whole,
    t.target - floor(t.target / t.source_size) * t.source_size AS rest
  FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
q_ AS (SELECT *, rest / source_size AS f, CASE WHEN rest / source_size > 0 THEN u / (1.0 - u)
    / ((rest / source_size) / (1.0 - (rest / source_size)) * (0.5 + size / (size + source_size / n_docs))) END AS q FROM ranked),
cum AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q RANGE UNBOUNDED PRECEDING) AS got FROM q_ WHERE q IS NOT NULL),
ends AS (SELECT source, min(struct_pack(off := abs(got - rest), got := got, q := q)) AS best, min(rest) AS rest FROM cum GROUP BY source)
SELECT q_.doc_id, q_.size, q_.source_size, q_.target, CASE WHEN q_.size = 0 THEN 0 ELSE q_.size * (q_.whole
    + CASE WHEN q_.q <= e.best.q AND e.best.off < e.rest THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM q_ LEFT JOIN ends e ON q_.source IS NOT DISTINCT FROM e.source
"""
