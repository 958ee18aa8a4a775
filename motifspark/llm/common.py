"""Small helpers that several of the operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motifspark.session import ensure_checkpoint_dir, materialise  # noqa: F401  (the operators import it from here)

#: A word is a run of characters outside these six ASCII blanks; ``bytes.split()`` cuts at exactly the same ones.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that go to a Python worker at a time: whole texts are long, so fewer than Spark's default.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of a table of texts, unless the session asks for less already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > int(ARROW_ROWS):
        spark.conf.set(key, ARROW_ROWS)


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def n_words(text: Column) -> Column:
    """Number of words of a text column, inside the JVM; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below ``spark.checkpoint.dir`` (set here only where it is unset, as in tests)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def file_bytes(path: str) -> bytes:
    """A vocabulary file that the caller names; read once on the driver and broadcast as tables."""
    with open(os.path.expanduser(path), "rb") as f:
        return f.read()


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each run of equal values in the first ``keys`` columns, from batches sorted by them."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns[:keys]), strict=True))
        start = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    kept.append(batch.slice(start, i - start))
                if kept:
                    yield pa.concat_batches(kept)
                kept, start, last = [], i, key
        if len(rows) > start:
            kept.append(batch.slice(start))
    if kept:
        yield pa.concat_batches(kept)
