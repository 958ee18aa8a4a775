"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from motifspark.session import materialise


def checked_broadcast(df: DataFrame, max_rows: int, persist: bool = True) -> DataFrame:
    """Hint ``broadcast`` only when the side has at most ``max_rows`` rows.

    The check is a bounded action (``limit(max_rows + 1).count()``). With
    ``persist`` the side is written first, so the check and the join share one
    computation. Beyond the bound the
    DataFrame is returned unhinted and Spark/AQE pick a shuffle join.
    """
    if persist:
        df = materialise(df, "join side")
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def sieve(df: DataFrame, keys: DataFrame, on: str, bits: int = 27) -> DataFrame:
    """Rows of ``df`` whose ``on`` may be among ``keys``: all that are, and few others; no shuffle of ``df``.

    The keys' hashes are set in a bitmap of ``2^bits`` bits (at most 16 MB, however many keys), which is what is broadcast.
    """
    h = F.pmod(F.xxhash64(on), F.lit(1 << bits))
    maps = keys.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("_bucket")) \
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_bits"))
    at = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    return df.join(F.broadcast(maps), F.bitmap_bucket_number(h) == F.col("_bucket")).where(hit).select(*[df[f"`{c}`"] for c in df.columns])
