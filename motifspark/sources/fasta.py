"""FASTA in and out.

Reading splits files on ``"\\n>"`` (a header starts a line), so every record is
one text row and Hadoop's record reader keeps records whole across file splits:
a huge file is read by many tasks. The ID is the first whitespace token of the
header; sequence lines are joined with all whitespace removed. Text before a
file's first header is dropped; a header without body gives an empty sequence.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from motifspark.functions.text import FASTA_WIDTH, fasta_record
from motifspark.operators.joins import checked_broadcast, sieve


def _plain(path: str) -> str:
    """A path without its scheme, absolute where it names a local file."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", path)
    return os.path.abspath(bare) if "://" not in path and not bare.startswith("/") else bare.rstrip("/") or "/"


def _file_order(file: Column, paths: list[str]) -> Column:
    """Position in the path list that a file was read for: an exact path by look-up, else a folder or pattern it falls under."""
    plain = [_plain(p) for p in paths]
    own = F.regexp_replace(F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))), "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")
    exact = F.try_element_at(F.create_map(*[F.lit(x) for i, p in reversed(list(enumerate(plain))) if p not in plain[:i] for x in (p, i)]), own)
    under = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(plain))):
        if any(c in p for c in "*?[{"):
            pattern = "".join("[^/]*" if c == "*" else "[^/]" if c == "?" else c if c in "[]" else "(" if c == "{" else ")" if c == "}" else "|" if c == "," else re.escape(c) for c in p)
            under = F.when(own.rlike(f"^{pattern}(/|$)"), F.lit(i)).otherwise(under)
        elif not os.path.splitext(p)[1]:  # a name without suffix may be a folder
            under = F.when(F.startswith(own, F.lit(p + "/")), F.lit(i)).otherwise(under)
    return F.coalesce(exact, under, F.lit(0)).cast("int")


def read_fasta(spark: SparkSession, paths, source: str | None = None, file_ord: int = 0) -> DataFrame:
    """``(seq_id, seq, source, file_ord, pos_block, pos_row)``, duplicates kept.

    All files are one scan. ``file_ord`` is the file's position in ``paths`` (plus the argument), ``source`` its path
    unless given. Nothing is persisted: which record comes first in its file is read from the row positions alone.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", "\n>").text(paths) \
        .select("value", F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("pos_block"),
                F.monotonically_increasing_id().alias("pos_row"))
    # the first chunk of each file: smallest row id within the file's first split
    firsts = raw.where(F.col("pos_block") == 0).groupBy("file").agg(F.min("pos_row").alias("first_row"))
    raw = raw.join(checked_broadcast(firsts, 1_000_000, persist=False), "file", "left")
    is_first = F.coalesce(F.col("pos_row") == F.col("first_row"), F.lit(False))
    v = F.col("value")
    # a file's first chunk is a record only when the file starts with '>'
    keep = ~is_first | v.startswith(">")
    rec = F.when(is_first, F.regexp_replace(v, "^>", "")).otherwise(v)
    x = raw.where(keep).select(rec.alias("rec"), "file", "pos_block", "pos_row")
    header = F.substring_index(F.col("rec"), "\n", 1)
    body = F.expr("substr(rec, length(substring_index(rec, '\\n', 1)) + 2)")
    seq_id = F.split(F.trim(header), r"\s+").getItem(0)
    out = x.select(seq_id.alias("seq_id"), F.regexp_replace(body, r"\s+", "").alias("seq"),
                   (F.lit(source) if source else F.col("file")).alias("source"), (_file_order(F.col("file"), paths) + F.lit(int(file_ord))).alias("file_ord"),
                   "pos_block", "pos_row", F.octet_length("rec").alias("raw_len"))
    return out.where(F.length("seq_id") > 0)


def read_fastas(spark: SparkSession, paths) -> DataFrame:
    """S3/U4: several FASTA files as one set, each tagged with its order (one scan, whatever their number)."""
    return read_fasta(spark, paths)


def only_file(spark: SparkSession, pattern: str) -> str:
    """The one file that ``pattern`` names; an error if there is none or more than one (the reference set is one file)."""
    found = [r[0] for r in spark.read.format("binaryFile").load(pattern).select("path").limit(3).collect()]
    if len(found) != 1:
        raise ValueError(f"{pattern} names {'no file' if not found else 'more than one file'}; exactly one is needed")
    return found[0]


def sequence_lookup(records: DataFrame, prefer: str = "last", only: DataFrame | None = None) -> DataFrame:
    """One sequence per ID; the later file (then the later record) wins.

    ``max_by`` over ``(file_ord, pos_block, pos_row)`` is a partial aggregate, so an ID repeated a third of all rows is still
    combined before the shuffle. ``only`` (a table with ``seq_id``): sequences of these IDs are wanted; others are left out
    where they are read, by a bitmap of the IDs' hashes, and don't travel. Records without the order columns must
    have one sequence per ID, else there is an error: nothing says which is the later one.
    """
    if only is not None:
        ids = only.select("seq_id").distinct()
        records = sieve(records, ids, "seq_id").join(ids, "seq_id", "left_semi")
    order = [c for c in ("file_ord", "pos_block", "pos_row") if c in records.columns]
    if not order:
        one = F.when(F.min("seq").eqNullSafe(F.max("seq")), F.min("seq")).otherwise(
            F.raise_error(F.concat(F.lit("no order columns, but different sequences named "), F.coalesce("seq_id", F.lit("null")))))
        return records.groupBy("seq_id").agg(one.alias("seq"))
    agg = F.max_by("seq", F.struct(*order)) if prefer == "last" else F.min_by("seq", F.struct(*order))
    return records.groupBy("seq_id").agg(agg.alias("seq"))


def write_fasta(df: DataFrame, path: str, name_col: str = "name", seq_col: str = "sub",
                width: int | None = None, mode: str = "overwrite") -> None:
    """K1 (``width=None``: one line per sequence) / K2 (``width=60``) as text part files."""
    rec = F.concat(F.lit(">"), F.col(name_col), F.lit("\n"), F.col(seq_col)) if not width else \
        fasta_record(F.concat(F.lit(">"), F.col(name_col)), F.col(seq_col), width)
    df.select(rec.alias("value")).write.mode(mode).text(path)


def write_records(df: DataFrame, path: str, record_col: str = "record", partition_by=(), mode: str = "overwrite") -> None:
    """Pre-built FASTA records (e.g. from ``extract_regions``), optionally one folder per threshold."""
    w = df.select(*partition_by, F.col(record_col).alias("value")).sortWithinPartitions(*partition_by) \
          .write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


__all__ = ["only_file", "read_fasta", "read_fastas", "sequence_lookup", "write_fasta", "write_records", "FASTA_WIDTH"]
