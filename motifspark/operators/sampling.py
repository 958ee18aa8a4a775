"""Seeded, partition-independent sampling.

Order key: ``md5('<seed>:<NAME>')`` (hex), ties by NAME. The first n rows in
that order are the sample. No ``rand()``/``sample()``: the result must not
depend on partitioning, and md5 gives the same order in SQL.

Scale: "first n by key" is an exact distributed selection, never a window over
one group and never a driver collect of rows. Keys are uniform, so a row count
gives a bound below which a draw's rows lie; one scan for ALL draws keeps the
rows below their bounds in the shared folder (checked; a shortage is drawn from
all rows). Of what is left, one pass makes the histograms of the key's top bits (partial aggregation, a bounded number
of buckets per draw); the bucket where a draw's running count crosses its n
becomes literals, and one filter pass emits the rows before it. Only the rows
of the crossing buckets are ordered; a bucket above ``final_rows`` is cut again
first. Nothing is persisted, nothing is joined back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from motifspark.functions.hashing import hex8_int, md5_tops, seeded_key
from motifspark.session import materialise

BUCKET_BITS = 14
FINAL_ROWS = 100_000
MAX_CLASSES = 1_000


class NotEnoughRows(ValueError):
    pass


@dataclass(frozen=True)
class Draw:
    """The first ``n`` rows by the seed's key, of the rows where ``where`` holds (all rows if None)."""

    label: Any
    n: int
    seed: Any
    where: Column | None = None


@dataclass(frozen=True)
class Source:
    """What makes a table, where that knows its rows and keys without making them all: ``near(seeds, bounds)`` gives the rows
    whose key by the i-th seed is below its bound, with i in ``_i``."""

    rows: int
    near: Callable[[list, list[int]], DataFrame]


@dataclass
class Cut:
    """Rows with a prefix below ``lo`` are in; of those in [lo, hi) the first ``need`` by (key, name)."""

    lo: int
    hi: int
    need: int


def order_prefix(seed, key_col: str = "NAME"):
    """First 32 bits of ``md5('<seed>:<key>')`` as a BIGINT (orders like the hex key)."""
    return hex8_int(seeded_key(seed, F.col(key_col)))


def with_order_key(df: DataFrame, seed, key_col: str = "NAME", hcol: str = "_h") -> DataFrame:
    return df.withColumn(hcol, order_prefix(seed, key_col))


def _of(draw: Draw, cond: Column) -> Column:
    return F.coalesce(cond if draw.where is None else draw.where & cond, F.lit(False))


def _with_prefixes(df: DataFrame, draws: list[Draw], key_col: str) -> tuple[DataFrame, list]:
    """One row per row and distinct seed, with ``_s.j`` (the seed) and ``_s.h`` (the prefix): each md5 is computed once, whatever is asked of it."""
    seeds = list(dict.fromkeys(d.seed for d in draws))
    made = [F.struct(F.lit(j).alias("j"), order_prefix(x, key_col).alias("h")) for j, x in enumerate(seeds)]
    return df.select("*", F.explode(F.array(*made)).alias("_s")), [seeds.index(d.seed) for d in draws]


def _each(rows: DataFrame, cells: list[Column], alone: bool, name: str, *cols) -> DataFrame:
    """The cells of a row that are not null, as rows; ``alone``: at most one of them is."""
    if alone:
        return rows.select(F.coalesce(*cells).alias(name), *cols).where(F.col(name).isNotNull())
    return rows.select(F.explode(F.array_compact(F.array(*cells))).alias(name), *cols)


def cut_offs(df: DataFrame, draws: list[Draw], key_col: str, final_rows: int = FINAL_ROWS) -> list[Cut]:
    """Where each draw's first n rows end; one histogram pass for all draws, and one more for buckets above ``final_rows``."""
    cuts = [Cut(0, 1 << 32, d.n) for d in draws]
    active = [i for i, d in enumerate(draws) if d.n > 0]
    for i, d in enumerate(draws):
        if d.n <= 0:
            cuts[i] = Cut(0, 0, 0)
    first = True
    rows, seed_of = _with_prefixes(df, draws, key_col)
    alone, h = len(set(seed_of)) == len(draws), F.col("_s.h")
    while active:
        shift = {i: max(0, (cuts[i].hi - cuts[i].lo).bit_length() - 1 - BUCKET_BITS) for i in active}
        cells = []
        for i in active:
            inside = (F.col("_s.j") == seed_of[i]) & _of(draws[i], (h >= cuts[i].lo) & (h < cuts[i].hi))
            cells.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.shiftright(h - F.lit(cuts[i].lo), shift[i]).alias("b"))))
        found = _each(rows, cells, alone, "c").groupBy("c.i", "c.b").count().collect()
        again = []
        for i in active:
            counts = sorted((r["b"], r["count"]) for r in found if r["i"] == i)
            total = sum(c for _, c in counts)
            if first and total < draws[i].n:
                raise NotEnoughRows(f"requested {draws[i].n} rows, only {total} available")
            cut, before = cuts[i], 0
            for b, c in counts:
                if before + c >= cut.need:
                    cuts[i] = Cut(cut.lo + (b << shift[i]), cut.lo + ((b + 1) << shift[i]), cut.need - before)
                    if c > final_rows and shift[i] > 0:
                        again.append(i)
                    break
                before += c
        active, first = again, False
    return cuts


def _near_names(names: DataFrame, seeds: list[str], bounds: list[int]) -> DataFrame:
    """``(name, _i)`` for each key below its bound: names alone are hashed a batch at a time, once a seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                name = batch.column(0)
                for i, (seed, bound) in enumerate(zip(seeds, bounds, strict=True)):
                    found = name.filter(pc.less(md5_tops(name, f"{seed}:"), bound))   # null for a null name, which is left out
                    yield pa.RecordBatch.from_arrays([found, pa.array(np.full(len(found), i, np.int32))], [batch.schema.names[0], "_i"])

    return names.mapInArrow(run, f"`{names.columns[0]}` string, _i int")


def _likely(df: DataFrame, draws: list[Draw], key_col: str, source: Source | None = None) -> DataFrame | None:
    """Rows that a draw can want, with the draw's number in ``_i``: one scan in which each key meets a bound that its draw's
    rows are almost surely below. None where that doesn't help or a draw turns out to want more.

    Keys are uniform, so of N rows about n lie below n / N; six standard deviations are added, and the count is checked.
    """
    if any(d.where is not None or d.n <= 0 for d in draws) or "_i" in df.columns:
        return None
    n_rows = df.count() if source is None else source.rows
    for d in draws:
        if d.n > n_rows:
            raise NotEnoughRows(f"requested {d.n} rows, only {n_rows} available")
    bounds = [math.ceil((d.n + 6 * math.sqrt(d.n) + 30) / max(n_rows, 1) * (1 << 32)) for d in draws]
    if max(bounds) >= 1 << 31:
        return None
    if source is not None:
        near = source.near([d.seed for d in draws], bounds).select(*df.columns, "_i")
    elif df.schema.simpleString() == f"struct<{key_col}:string>" and not any(isinstance(d.seed, Column) for d in draws):
        near = _near_names(df, [str(d.seed) for d in draws], bounds)
    else:
        # hex keys compare like their numbers, so nothing is converted; the filter goes below whatever makes the other columns
        keys = [seeded_key(d.seed, F.col(key_col)) < F.lit(f"{b:08x}") for d, b in zip(draws, bounds)]
        cells = [F.when(k, F.lit(i)) for i, k in enumerate(keys)]
        near = df.where(reduce(or_, keys)).select("*", F.explode(F.array_compact(F.array(*cells))).alias("_i"))
    rows = materialise(near, "drawn rows")
    have = {r["_i"]: r["count"] for r in rows.groupBy("_i").count().collect()}   # one row a draw
    return rows if all(have.get(i, 0) >= d.n for i, d in enumerate(draws)) else None


def first_n(df: DataFrame, draws: list[Draw], key_col: str = "NAME", label_col: str = "draw", final_rows: int = FINAL_ROWS, source: Source | None = None) -> DataFrame:
    """``(label, *df)``: the exact first rows of every draw. What is returned was drawn already: one scan for all draws. ``source``: what makes ``df``."""
    likely = _likely(df, draws, key_col, source)
    if likely is not None:
        mine = [Draw(d.label, d.n, d.seed, F.col("_i") == i) for i, d in enumerate(draws)]
        return _first_n(likely, mine, key_col, label_col, final_rows).drop("_i")
    return _first_n(df, draws, key_col, label_col, final_rows)


def _first_n(df: DataFrame, draws: list[Draw], key_col: str, label_col: str, final_rows: int) -> DataFrame:
    cuts, cols = cut_offs(df, draws, key_col, final_rows), df.columns
    heads, edges = [], []
    if len(draws) == 1:   # plain filters, which go below whatever makes the other columns
        rows, seed_of, alone, h = df, [None], True, order_prefix(draws[0].seed, key_col)
    else:
        rows, seed_of = _with_prefixes(df, draws, key_col)
        alone, h = len(set(seed_of)) == len(draws), F.col("_s.h")
    for d, c, j in zip(draws, cuts, seed_of):
        mine = F.lit(True) if j is None else F.col("_s.j") == j
        heads.append(F.when(mine & _of(d, h < c.lo), F.lit(d.label)))
        edges.append(F.when(mine & _of(d, (h >= c.lo) & (h < c.hi)), F.struct(F.lit(d.label).alias("label"), F.lit(c.need).alias("need"), seeded_key(d.seed, F.col(key_col)).alias("k"))))
    head, edge = _each(rows, heads, alone, label_col, *cols), _each(rows, edges, alone, "_e", *cols)
    rank = F.row_number().over(Window.partitionBy("_e.label").orderBy("_e.k", key_col))   # at most final_rows rows a draw
    edge = edge.withColumn("_r", rank).where(F.col("_r") <= F.col("_e.need")).select(F.col("_e.label").alias(label_col), *cols)
    return head.unionByName(edge)


def first_n_by_key(df: DataFrame, n: int, seed, key_col: str = "NAME", hcol: str = "_h", final_rows: int = FINAL_ROWS, source: Source | None = None) -> DataFrame:
    """Exact first ``n`` rows of ``df`` by ``(md5('<seed>:<key>'), key)``."""
    return first_n(df.drop(hcol), [Draw(0, int(n), seed)], key_col, "_draw", final_rows, source).drop("_draw")


def sample_n(df: DataFrame, n: int, seed, key_col: str = "NAME", source: Source | None = None) -> DataFrame:
    """Exactly n rows without replacement, seeded; error if fewer are available."""
    return first_n_by_key(df, n, seed, key_col, source=source)


def bucket_samples(pool: DataFrame, n_pos: int, mults=(1, 2, 5, 10), seed=0, key_col: str = "NAME", source: Source | None = None) -> DataFrame:
    """For each multiple m an independent draw of m * n_pos rows with seed + m -> ``(mult, *pool)``."""
    return first_n(pool, [Draw(int(m), int(m) * int(n_pos), int(seed) + int(m)) for m in mults], key_col, "mult", source=source)


def class_counts(df: DataFrame, label_col: str = "CLASS") -> DataFrame:
    """Rows per class."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def class_sizes(df: DataFrame, label_col: str = "CLASS") -> dict:
    """A11 on the driver, for a label with at most ``MAX_CLASSES`` values."""
    rows = class_counts(df, label_col).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} classes")
    return {r[label_col]: r["n"] for r in rows}


def stratified_split(df: DataFrame, seed, test_frac: float = 0.2, label_col: str = "CLASS",
                     key_col: str = "NAME") -> DataFrame:
    """Add ``is_test``; per class the first ``round(test_frac * n_class)`` rows by md5 key.

    Every row comes out once, also where names repeat. Only the rows of each
    class's crossing bucket are ordered, so no class is ever a single task.
    """
    sizes = class_sizes(df, label_col)
    draws = [Draw(i, int(round(test_frac * n)), seed, F.col(label_col).eqNullSafe(F.lit(c))) for i, (c, n) in enumerate(sizes.items())]
    cuts = cut_offs(df, draws, key_col)
    h = order_prefix(seed, key_col)
    edge, head, need = F.lit(False), F.lit(False), F.lit(0)
    for d, c in zip(draws, cuts):
        inside = _of(d, (h >= c.lo) & (h < c.hi))
        edge, head = edge | inside, head | _of(d, h < c.lo)
        need = F.when(inside, F.lit(c.need)).otherwise(need)
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy(seeded_key(seed, F.col(key_col)), key_col))
    sure = df.where(~edge).withColumn("is_test", head)
    close = df.where(edge).withColumn("is_test", rank <= need)
    return sure.unionByName(close)
