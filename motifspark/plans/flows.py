"""Composite flows: windows -> features -> all-model scoring -> consensus -> regions -> FASTA.

F5-F7 run for every threshold in one job: ``pct`` is a column, not a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from motifspark.functions.text import RESIDUES
from motifspark.operators.consensus import NoLists, consensus
from motifspark.operators.extract import extract_regions
from motifspark.operators.predict import LinearModels, WindowScores, collect_models, composition_rows, least_votes
from motifspark.operators.regions import merge_regions
from motifspark.plans.runplan import THRESHOLDS


def window_features(seqs: DataFrame, w: int = 15, step: int = 1, min_len: int = 15, digits: int | None = None) -> DataFrame:
    return composition_rows(seqs, RESIDUES, w, step, min_len, digits=digits)


def window_scores(seqs: DataFrame, models: DataFrame | LinearModels, w: int = 15, step: int = 1, min_len: int = 15) -> WindowScores:
    """All windows of ``seqs`` against every model, on their residue composition."""
    lm = models if isinstance(models, LinearModels) else collect_models(models, len(RESIDUES))
    return WindowScores(seqs, lm, RESIDUES, w, step, min_len)


def consensus_windows(scores: WindowScores, thresholds=THRESHOLDS, n: int | None = None) -> DataFrame:
    """F5 over scored windows: ``(pct, name, seq_id, start, support)``.

    Votes and N come from one scoring pass; with ``n`` given, windows below the lowest vote threshold never leave the
    kernel. Raises ``NoLists`` when no model predicts anything.
    """
    if n is None:
        rows, n = scores.voted(min(thresholds))
    else:
        rows = scores.rows(least_votes(min(thresholds), n)) if n else None
    if n == 0:
        raise NoLists("all prediction lists are empty")
    s = rows.select(F.col("NAME").alias("name"), "seq_id", "start", "support")
    return consensus(s, F.lit(n).cast("bigint"), thresholds, keep=("seq_id", "start"))


def consensus_regions(cons: DataFrame, w: int = 15, min_frags: int = 2) -> DataFrame:
    """regions per threshold, ``(pct, seq_id, start, end, n_frags)``; names are unique per threshold already."""
    return merge_regions(cons.select("pct", "seq_id", "start"), w=w, min_frags=min_frags,
                         keys=("pct",), distinct=False)


def region_fasta(regions: DataFrame, seqs: DataFrame) -> DataFrame:
    """FASTA records per threshold; ``seqs`` is the lookup (one sequence per ID, S2)."""
    return extract_regions(regions, seqs, keys=("pct",))
