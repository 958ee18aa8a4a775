"""Cutting regions out of their parent sequences.

Regions are few next to the sequences they come from, so the region side is
broadcast when its row count is proven small (checked, not assumed); the large
sequence table is then streamed once without a shuffle. Above the bound the
join falls back to a shuffle join (AQE splits a skewed ``seq_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from motifspark.functions.text import FASTA_WIDTH, fasta_header, wrap_text
from motifspark.operators.joins import checked_broadcast


def extract_regions(regions: DataFrame, seqs: DataFrame, keys=(), width: int | None = FASTA_WIDTH,
                    broadcast_rows: int = 2_000_000) -> DataFrame:
    """``(*keys, seq_id, start, end, n_frags)`` x ``(seq_id, seq)`` -> header, residues, record."""
    keys = list(keys)
    r = checked_broadcast(regions.select(*keys, "seq_id", "start", "end", "n_frags"), broadcast_rows)
    j = seqs.select("seq_id", "seq").join(r, "seq_id", "inner")
    ok = (F.col("start") >= 1) & (F.col("end") <= F.length("seq")) & (F.col("start") <= F.col("end"))
    j = j.where(ok)
    sub = F.substring("seq", F.col("start"), F.col("end") - F.col("start") + 1)
    header = fasta_header("seq_id", "start", "end", "n_frags")
    body = wrap_text(sub, width) if width else sub
    return j.select(*keys, "seq_id", "start", "end", "n_frags",
                    header.alias("header"), sub.alias("residues"),
                    F.concat(header, F.lit("\n"), body).alias("record"))
