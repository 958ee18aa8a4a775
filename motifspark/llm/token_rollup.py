"""Delta-maintained token counts by source, language and tokenizer version.

A change batch inserts, deletes or revises the count of documents under a tokenizer version. Applying it writes a new
version of those buckets of a ledger (the last known count of each document and version, bucketed by their hash) that
hold a key of the batch, and the signed sums by source, language and version that the batch adds. A batch reads the
newest version of these buckets and nothing else: neither other buckets nor older versions. Totals are the sum of the
committed batches' signed sums, so no document is read again. A batch counts once its commit marker, which names its
buckets, stands: it is written last, an unfinished batch is written anew under the same name, and a batch that is
already committed changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

KEYS = ("doc_id", "version")
GROUP = ("source", "lang", "version")
_LEDGER = "doc_id {id}, version string, source string, lang string, n_tokens long"
_DELTA = "source string, lang string, version string, n_docs long, n_tokens long, batch long"


class TokenRollup:
    """Totals kept in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, id_type: str = "bigint", buckets: int = 64):
        """``buckets``: of the ledger; the same for the life of the folder."""
        self.spark, self.folder, self.id_type, self.buckets = spark, folder.rstrip("/"), id_type, buckets

    def _read(self, schema: str, paths: list[str]) -> DataFrame:
        # only folders of committed batches are listed, so leftovers of a failed try are never seen
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], schema)

    def _commits(self) -> dict[int, dict[int, bool]]:
        """Committed batch -> bucket that it wrote -> whether anything is left in it."""
        try:
            rows = self.spark.read.schema("batch long, buckets map<int,boolean>").parquet(f"{self.folder}/commits/*").collect()  # one row per batch
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return {}
        return {r.batch: r.buckets for r in sorted(rows, key=lambda r: r.batch)}

    def committed(self) -> list[int]:
        """Numbers of the committed batches, in order."""
        return list(self._commits())

    def ledger(self, buckets: list[int] | None = None) -> DataFrame:
        """Last count of each document and version that is there, of some buckets or all: one folder per bucket is read."""
        newest = {k: f"ledger/batch-{b}/bucket={k}" * some for b, ks in self._commits().items() for k, some in ks.items()}
        return self._read(_LEDGER.format(id=self.id_type), [newest[k] for k in (sorted(newest) if buckets is None else buckets) if newest.get(k)])

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Apply ``changes`` (op, doc_id, source, lang, version, n_tokens, and seq if a key may occur more than once).

        op is ``insert``, ``revise`` or ``delete``; an insert of a known document or a revision of an unknown one sets its
        count all the same, a delete of an unknown one does nothing. Of several changes to one key the one with the
        highest seq counts; without seq, or with equal ones, a delete before a count, then the largest row. Null ids, sources,
        languages and versions are values like any other; a null count is 0; a null or unknown op is an error. False if the batch
        was committed before; batches come in rising order.
        """
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]} was committed")
        seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(0).cast("long")
        known = F.coalesce(F.col("op").isin("insert", "revise", "delete"), F.lit(False))
        op = F.when(known, F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
        new = changes.select("doc_id", "version", F.struct(seq.alias("seq"), (op == "delete").alias("gone"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"),
                                                           F.col("source").alias("source"), F.col("lang").alias("lang")).alias("c"))
        bucket = F.pmod(F.xxhash64("id2", "v2"), F.lit(self.buckets)).cast("int")
        new = new.groupBy(*KEYS).agg(F.max("c").alias("c")).select(F.col("doc_id").alias("id2"), F.col("version").alias("v2"), "c").withColumn("bucket", bucket)
        path = f"{self.folder}/changes/batch-{batch}"
        new.write.mode("overwrite").parquet(path)  # the changes are read once
        new = self.spark.read.schema(new.schema).parquet(path)
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most ``buckets``
        old = self.ledger(touched)
        both = new.join(old, F.col("id2").eqNullSafe(F.col("doc_id")) & F.col("v2").eqNullSafe(F.col("version")), "full")
        # a row has a change (c), a count before (n_tokens), or both
        changed, was = F.col("c").isNotNull(), F.col("n_tokens").isNotNull()
        before = F.when(was, F.struct("source", "lang", F.col("n_tokens").alias("n")))
        after = F.when(~changed, before).when(~F.col("c.gone"), F.struct(F.col("c.source").alias("source"), F.col("c.lang").alias("lang"), F.col("c.n_tokens").alias("n")))
        both = both.select(F.when(changed, F.col("id2")).otherwise(F.col("doc_id")).alias("id2"), F.when(changed, F.col("v2")).otherwise(F.col("version")).alias("v2"),
                           changed.alias("changed"), before.alias("before"), after.alias("after"))
        path = f"{self.folder}/joined/batch-{batch}"
        both.write.mode("overwrite").parquet(path)  # the join runs once; ledger and sums are read from it
        both = self.spark.read.schema(both.schema).parquet(path)
        entries = both.where("after IS NOT NULL").select(F.col("id2").alias("doc_id"), F.col("v2").alias("version"), "after.source", "after.lang", F.col("after.n").alias("n_tokens"), bucket.alias("bucket"))
        entries.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/ledger/batch-{batch}")
        left = {r[0] for r in entries.select("bucket").distinct().collect()}
        signed = both.where("changed").select("v2", F.explode(F.array(F.struct(F.lit(-1).alias("d"), F.col("before").alias("e")), F.struct(F.lit(1).alias("d"), F.col("after").alias("e")))).alias("s"))
        signed = signed.where("s.e IS NOT NULL").select("s.e.source", "s.e.lang", F.col("v2").alias("version"), F.col("s.d").alias("d"), (F.col("s.d") * F.col("s.e.n")).alias("t"))
        sums = signed.groupBy(*GROUP).agg(F.sum("d").alias("n_docs"), F.sum("t").alias("n_tokens")).withColumn("batch", F.lit(batch).cast("long"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/delta/batch-{batch}")
        marker = self.spark.createDataFrame([(batch, {k: k in left for k in touched})], "batch long, buckets map<int,boolean>")
        marker.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/batch-{batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) over all committed batches; groups that are down to nothing are left out."""
        added = self._read(_DELTA, [f"delta/batch-{b}" for b in self.committed()]).groupBy(*GROUP)
        return added.agg(F.sum("n_docs").cast("long").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")


def counts(docs: DataFrame, op: str, version: str, n_tokens: Column, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Change rows that set (or delete) the count of every document under one tokenizer version."""
    return docs.select(F.lit(op).alias("op"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(lang_col).cast("string").alias("lang"), F.lit(version).alias("version"), n_tokens.cast("long").alias("n_tokens"))
