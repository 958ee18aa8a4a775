"""Sequence text helpers: residue cleaning, FASTA headers, line wrapping."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The twenty standard amino-acid one-letter codes.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
NOT_RESIDUE = "[^" + RESIDUES + RESIDUES.lower() + "]"

FASTA_WIDTH = 60


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_residues(text) -> Column:
    """Drop every character outside the 20 residue letters (either case), then upper-case."""
    return F.upper(F.regexp_replace(_col(text), NOT_RESIDUE + "+", ""))


def wrap_text(s, width: int = FASTA_WIDTH) -> Column:
    """Insert a newline after every ``width`` characters (none at the very end)."""
    return F.regexp_replace(_col(s), "(.{%d})(?=.)" % width, "$1\n")


def fasta_header(seq_id, start, end, n_frags) -> Column:
    """``>seq_id:start-end|n_frags=n``."""
    return F.concat(F.lit(">"), _col(seq_id), F.lit(":"), _col(start).cast("string"), F.lit("-"),
                    _col(end).cast("string"), F.lit("|n_frags="), _col(n_frags).cast("string"))


def fasta_record(header, seq, width: int | None = FASTA_WIDTH) -> Column:
    """One FASTA record as text (no trailing newline; ``write.text`` adds it)."""
    body = wrap_text(seq, width) if width else _col(seq)
    return F.concat(_col(header), F.lit("\n"), body)
