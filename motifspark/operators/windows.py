"""Sliding windows over sequences.

A window is ``sub = seq[start : start + w - 1]`` (1-based) for starts
1, 1+step, ... while the window fits; sequences shorter than ``min_len`` give
nothing. Names are ``seq_id:start`` (or ``seq_id:k`` in index mode).

Scale: a sequence is exploded in two levels, first into *chunks* of windows
(each carries only its own slice of text), then each chunk into windows, all in
the task that read it: no shuffle. Only sequences with more than
``spread_above`` letters are dealt out by chunk first, so that one sequence
holding a third of all letters is not one task; an input too small to give each
core a split is dealt out whole. A column ``raw_len`` (an upper
bound of the length that costs nothing, such as the size of the raw text) lets
the scan tell long from short before any cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from motifspark.functions.ids import fragment_name


def window_count(length, w: int, step: int, min_len: int):
    """Number of windows a sequence of ``length`` yields (0 when too short)."""
    n = F.floor((length - F.lit(w)) / F.lit(step)).cast("bigint") + F.lit(1)
    return F.when((length >= F.lit(max(min_len, 0))) & (length >= F.lit(w)), n).otherwise(F.lit(0).cast("bigint"))


SPREAD_ABOVE = 1 << 22
DEAL = 4096                # windows per chunk that is dealt out


def _slice(text: str, start: Column, length: Column) -> Column:
    """``length`` characters from ``start`` (1-based): by bytes where each character is one."""
    # Character-position substring on a UTF-8 string scans from the start, which
    # makes windowing a long sequence quadratic. Sequence text is ASCII in
    # practice (FASTA), where bytes = characters and a BINARY substring is an
    # O(1) slice; any non-ASCII row keeps the character-based path.
    start, length = start.cast("int"), length.cast("int")
    return F.when(F.octet_length(text) == F.length(text), F.substring(F.col(text).cast("binary"), start, length).cast("string")) \
            .otherwise(F.substring(text, start, length))


def below_one_split_a_core(df: DataFrame) -> bool:
    """Is the input, by Spark's own estimate, too small to give every core a split? Then dealing it out is cheap and worth it."""
    spark = df.sparkSession
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size < split * spark.sparkContext.defaultParallelism


def window_chunks(seqs: DataFrame, w: int, step: int, min_len: int, chunk: int, spread_above: int | None = SPREAD_ABOVE) -> DataFrame:
    """``seqs(seq_id, seq)`` -> ``(seq_id, first, cnt, text)``: windows first .. first + cnt - 1 (0-based) and just their text."""
    if w < 1 or step < 1:
        raise ValueError("window and step must be >= 1")
    def cut(part: DataFrame, spread: bool) -> DataFrame:
        base = part.select("seq_id", "seq")
        n_win = window_count(F.length("seq"), w, step, min_len)
        n_chunks = F.floor((n_win - 1) / F.lit(chunk)).cast("int")
        # a sequence without windows gives a null array, hence no row: no filter that would clean its text a second time
        c = base.select("seq_id", n_win.alias("n_win"), F.explode(F.when(n_win > 0, F.sequence(F.lit(0), n_chunks))).alias("c"), "seq")
        first = F.col("c").cast("bigint") * F.lit(chunk)
        cnt = F.least(F.lit(chunk).cast("bigint"), F.col("n_win") - first)
        text = _slice("seq", first * step + 1, (cnt - 1) * step + w)
        out = c.select("seq_id", first.alias("first"), cnt.alias("cnt"), text.alias("text"))
        return out.repartition("seq_id", "first") if spread else out

    if spread_above is None:
        return cut(seqs, False)
    if below_one_split_a_core(seqs):
        return cut(seqs, False).repartition(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seq_id", "first")
    size = F.coalesce(F.col("raw_len") if "raw_len" in seqs.columns else F.length("seq"), F.lit(0))
    return cut(seqs.where(size <= spread_above), False).unionByName(cut(seqs.where(size > spread_above), True))


def sliding_windows(seqs: DataFrame, w: int = 15, step: int = 1, min_len: int = 15, id_mode: str = "start", chunk: int = 64,
                    spread_above: int | None = SPREAD_ABOVE) -> DataFrame:
    """``seqs(seq_id, seq)`` -> ``windows(name, seq_id, start, sub)``."""
    if id_mode not in ("start", "index"):
        raise ValueError("id_mode must be 'start' or 'index'")
    # What is dealt out is long chunks, whose text hardly overlaps; they are cut into short ones where they arrive.
    dealt = window_chunks(seqs, w, step, min_len, max(chunk, DEAL // chunk * chunk), spread_above)
    at = F.explode(F.sequence(F.lit(0), F.floor((F.col("cnt") - 1) / F.lit(chunk)).cast("int"))).alias("at")
    parts = dealt.select("seq_id", "first", "cnt", "text", at)
    cnt = F.least(F.lit(chunk).cast("bigint"), F.col("cnt") - F.col("at") * F.lit(chunk))
    chunks = parts.select("seq_id", (F.col("first") + F.col("at") * F.lit(chunk)).alias("first"), cnt.alias("cnt"),
                          _slice("text", F.col("at") * F.lit(chunk * step) + 1, (cnt - 1) * step + w).alias("text"))
    # Chunks are short (``chunk`` windows), so carrying the chunk text through the
    # generator costs a small copy per window and everything stays in codegen.
    j = F.explode(F.sequence(F.lit(0), (F.col("cnt") - 1).cast("int"))).alias("j")
    exploded = chunks.select("seq_id", "first", "text", j)
    idx = F.col("first") + F.col("j")                            # 0-based window index
    start = (idx * step + 1).cast("int")
    label = start if id_mode == "start" else (idx + 1).cast("int")
    return exploded.select(
        fragment_name("seq_id", label).alias("name"),
        "seq_id",
        start.alias("start"),
        F.substring("text", F.col("j") * step + 1, w).alias("sub"),
    )


def window_counts(seqs: DataFrame, w: int = 15, step: int = 1, min_len: int = 15) -> DataFrame:
    """Windows per sequence, from the length alone (no explode, no shuffle)."""
    return seqs.select("seq_id", window_count(F.length("seq"), w, step, min_len).alias("n_windows")) \
               .where(F.col("n_windows") > 0)


def prepare(seqs: DataFrame, enabled: bool = True, w: int = 15, step: int = 1, min_len: int = 15,
            id_mode: str = "start") -> DataFrame:
    """window a sequence set, or pass whole sequences through as single fragments."""
    if enabled:
        return sliding_windows(seqs, w=w, step=step, min_len=min_len, id_mode=id_mode)
    return seqs.select(F.col("seq_id").alias("name"), "seq_id", F.lit(1).alias("start"), F.col("seq").alias("sub"))
