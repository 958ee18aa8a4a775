"""Fragment identifiers: ``<seq_id>:<start>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fragment_name(seq_id, start) -> Column:
    """``seq_id:start``."""
    return F.concat_ws(":", _col(seq_id), _col(start).cast("string"))


def id_part(name) -> Column:
    """The ID before the first ``:`` (the whole name when there is none)."""
    return F.substring_index(_col(name), ":", 1)


def split_fragment_id(name, strict: bool = True) -> tuple[Column, Column]:
    """Split at the last ``:`` into (seq_id, int start).

    strict=True raises on a name without ``:`` or with a non-integer start, as the
    reference does; strict=False returns NULLs instead so callers can quarantine.
    """
    n = F.trim(_col(name))
    seq_id = F.regexp_extract(n, r"^(.*):", 1)
    right = F.substring_index(n, ":", -1)
    if strict:
        bad = F.concat(F.lit("fragment id lacks ':' or integer start: "), n)
        start = F.when(n.contains(":") & right.rlike(r"^[+-]?[0-9]+$"), right.cast("int")) \
                 .otherwise(F.raise_error(bad).cast("int"))
        return seq_id, start
    ok = n.contains(":")
    return F.when(ok, seq_id), F.when(ok, right.try_cast("int"))
