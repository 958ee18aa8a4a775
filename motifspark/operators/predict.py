"""Scoring every row with every linear model in ONE scan.

The reference starts one process per model group and re-reads the feature table
each time. Here the coefficient table (one row per model) becomes a numpy
matrix shipped with the task, and one ``mapInArrow`` pass scores all models.

A row is predicted *positive* (class 0) when its margin is <= 0. Per row we
emit the number of models voting positive (``support``) and the set of those
models as a bitmask (``hits``, 64 models per BIGINT). The bitmask lets later
steps count non-empty lists (N), OR the votes of repeated names, and write the
per-model lists without a second scoring pass.

Window text never reaches Python window by window: a kernel gets a *chunk* of
sequence text once and takes the residue counts of each window in it from
running counts. Rows that are ingested as a feature table go through the same
core (``score_features``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from motifspark.functions.hashing import md5_tops
from motifspark.functions.ids import fragment_name
from motifspark.operators.windows import SPREAD_ABOVE, window_chunks
from motifspark.session import materialise

MODEL_BYTES = 1 << 30      # bound on the coefficient matrix that is shipped to tasks
GROUP = 512                # models scored at a time
BLOCK = 4096               # rows scored at a time
CHUNK = 4096               # windows per chunk of text


@dataclass(frozen=True)
class Mlp:
    """One fitted perceptron over some of the feature columns: sigmoid or rectified layers, two outputs, class 0 where its output is larger."""

    columns: np.ndarray    # positions of its features
    shift: np.ndarray
    scale: np.ndarray      # 0: a constant column, scaled to 0
    layers: list           # (weights (in, out), bias (out)) each
    rectified: bool = False

    @cached_property
    def narrow(self) -> list:
        """Layers in 32 bits over unscaled features, each with the largest sum of weights, and bias, that an output takes."""
        out = []
        for i, (w, b) in enumerate(self.layers):
            if not i:
                w = np.divide(w, self.scale[:, None], out=np.zeros_like(w), where=self.scale[:, None] != 0)
                b = b - self.shift @ w
            out.append((w.astype(np.float32), b.astype(np.float32), float(np.abs(w).sum(0).max()), float(np.abs(b).max())))
        return out

    def votes(self, X: np.ndarray) -> np.ndarray:
        """In 32 bits first; rows whose outputs are nearer to each other than twice the bound of their rounding errors are computed in 64."""
        if not self.rectified or not len(X):
            return self.exactly(X)
        with np.errstate(over="ignore", invalid="ignore"):
            x, error = X[:, self.columns].astype(np.float32), 0.0
            for i, (w, b, weight, bias) in enumerate(self.narrow):
                error = weight * error + (len(w) + 4) * 2.0 ** -23 * (weight * (float(np.abs(x).max(initial=0.0)) + error) + bias)
                x = x @ w
                x += b
                if i + 1 < len(self.narrow):
                    np.maximum(x, 0.0, out=x)
            margin = x[:, 0] - x[:, 1]
            out = margin >= 0
            near = np.flatnonzero(~(np.abs(margin) > 4 * error + 1e-30))   # all rows where something is no number
        if len(near):
            out[near] = self.exactly(X[near])
        return out

    def exactly(self, X: np.ndarray) -> np.ndarray:
        x = X[:, self.columns] - self.shift
        x = np.divide(x, self.scale, out=np.zeros_like(x), where=self.scale != 0)
        for i, (w, b) in enumerate(self.layers):
            x = x @ w + b
            if i + 1 < len(self.layers):
                x = np.maximum(x, 0.0) if self.rectified else 0.5 * (1.0 + np.tanh(0.5 * x))   # the sigmoid, without overflow
        return x[:, 0] >= x[:, 1]


@dataclass(frozen=True)
class Models:
    """Linear models first, then perceptrons; ``list_ids`` names them in that order."""

    list_ids: list
    W: np.ndarray          # (m, d) of the linear ones
    b: np.ndarray          # (m,)
    mlps: tuple = ()

    @classmethod
    def of(cls, linear: list, mlps: list, feature_cols: list) -> Models:
        """From coefficient rows (``list_id, weights, bias`` over all of ``feature_cols``) and perceptron rows."""
        at = {c: i for i, c in enumerate(feature_cols)}
        made = []
        for m in mlps:
            flat, layers, used = np.array(m["weights"], dtype=np.float64), [], 0
            for n_in, n_out in zip(m["layers"], m["layers"][1:]):
                w = flat[used:used + n_in * n_out].reshape(n_in, n_out)
                layers.append((w, flat[used + n_in * n_out:used + (n_in + 1) * n_out]))
                used += (n_in + 1) * n_out
            made.append(Mlp(np.array([at[c] for c in m["features"]], dtype=np.int64), np.array(m["shift"]), np.array(m["scale"]), layers, m.get("activation") == "relu"))
        W = np.array([r["weights"] for r in linear], dtype=np.float64).reshape(len(linear), len(feature_cols))
        return cls([r["list_id"] for r in linear] + [m["list_id"] for m in mlps], W, np.array([r["bias"] for r in linear], dtype=np.float64), tuple(made))

    @property
    def n_words(self) -> int:
        return (len(self.list_ids) + 63) // 64

    def votes(self, X: np.ndarray) -> np.ndarray:
        """Positive votes as a boolean (rows, models) matrix, in blocks of rows and groups of models; linear: ``X . W^T + b <= 0``.

        Margins are computed in 32 bits first. Where one is within twice the bound of its rounding error, the row is computed
        in 64 bits, so the votes are those of 64 bits throughout.
        """
        out = np.empty((len(X), len(self.list_ids)), dtype=bool)
        m = len(self.b)
        self._linear(X, out)
        for i in range(0, len(X), BLOCK):
            for j, mlp in enumerate(self.mlps):
                out[i:i + BLOCK, m + j] = mlp.votes(X[i:i + BLOCK])
        return out

    def votes_above(self, X: np.ndarray, fired: np.ndarray, pct: float) -> np.ndarray:
        """``votes`` for every row that can reach ``pct`` % of the models that have fired; ``fired``: votes of each model so far, brought up to date.

        A row that cannot, even with the votes of all perceptrons left, is not shown to them; it stays below the bound. A perceptron
        that has not fired yet is shown every row until it does, so the models that fire are those of ``votes``.
        """
        m = len(self.b)
        out = np.zeros((len(X), len(self.list_ids)), dtype=bool)
        self._linear(X, out)
        fired[:m] += out[:, :m].sum(axis=0)
        support = out[:, :m].sum(axis=1)
        for left, j in zip(range(len(self.mlps), 0, -1), m + np.argsort(fired[m:], kind="stable")):   # those that seldom fire rule out most
            able = support + left >= least_votes(pct, int((fired > 0).sum()))
            rows = np.concatenate([np.flatnonzero(able), np.flatnonzero(~able)])
            last = int(able.sum())
            for i in range(0, len(rows), BLOCK):
                if i >= last and fired[j]:
                    break
                some = rows[i:i + BLOCK] if not fired[j] else rows[i:min(i + BLOCK, last)]
                said = self.mlps[j - m].votes(X[some])
                out[some, j] = said
                support[some] += said
                fired[j] += int(said.sum())
        return out

    def _linear(self, X: np.ndarray, out: np.ndarray) -> None:
        m, d = len(self.b), X.shape[1]
        with np.errstate(over="ignore", invalid="ignore"):
            W32, b32, size = self.W.T.astype(np.float32), self.b.astype(np.float32), np.abs(self.W)
            for i in range(0, len(X), BLOCK):
                x = X[i:i + BLOCK]
                x32 = x.astype(np.float32)
                error = 2 * (d + 4) * 2.0 ** -23 * (size @ np.abs(x).max(axis=0) + np.abs(self.b)) + 1e-30
                sure = bool((error < 1e30).all())
                for g in range(0, m, GROUP):
                    to = out[i:i + BLOCK, g:min(g + GROUP, m)]
                    exactly = lambda x: x @ self.W[g:g + GROUP].T + self.b[g:g + GROUP] <= 0.0  # noqa: B023, E731
                    if not sure:
                        to[:] = exactly(x)
                        continue
                    margin = x32 @ W32[:, g:g + GROUP]
                    margin += b32[g:g + GROUP]
                    np.less_equal(margin, 0.0, out=to)
                    near = np.flatnonzero((np.abs(margin, out=margin) <= error[g:g + GROUP].astype(np.float32)).any(axis=1))
                    if len(near):
                        to[near] = exactly(x[near])

    def words(self, pos: np.ndarray) -> np.ndarray:
        """(rows, models) votes as (rows, n_words) int64 bitmasks, bit j of word j // 64."""
        packed = np.packbits(pos, axis=1, bitorder="little")
        buf = np.zeros((len(pos), self.n_words * 8), dtype=np.uint8)
        buf[:, :packed.shape[1]] = packed
        return buf.view("<i8")

    def counted(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``words`` of the votes and their number per row."""
        words = self.words(pos)
        return words, np.bitwise_count(words.view(np.uint64)).sum(axis=1, dtype=np.int64)

    def set_bits(self, words: np.ndarray) -> np.ndarray:
        """One bitmask as a boolean per model."""
        return np.unpackbits(words.view(np.uint8), bitorder="little")[:len(self.list_ids)].astype(bool)


LinearModels = Models


def collect_models(models: DataFrame, width: int, max_bytes: int = MODEL_BYTES) -> LinearModels:
    """Bring the coefficient table to the driver after checking its size."""
    n = models.count()
    if n * (width + 1) * 8 > max_bytes:
        raise ValueError(f"{n} models of width {width} exceed {max_bytes} bytes")
    rows = models.select("list_id", "weights", "bias").orderBy("list_id").collect()
    W = np.array([r["weights"] for r in rows], dtype=np.float64).reshape(len(rows), width)
    b = np.array([r["bias"] for r in rows], dtype=np.float64)
    return LinearModels([r["list_id"] for r in rows], W, b)


# ---------------------------------------------------------------- where the rows come from

def window_blocks(batches: Iterator[pa.RecordBatch], w: int, step: int, residues: str, rows: int = 1 << 15):
    """Chunks (seq_id, first, cnt, text) -> (seq_ids, starts, counts): counts of each residue (residues, windows) of all windows, some chunks at a time."""
    lut = np.full(256, 255, dtype=np.uint8)
    lut[[ord(a) for a in residues]] = np.arange(len(residues))
    for batch in batches:
        cnts = batch.column(2).to_numpy()
        at = 0
        while at < len(cnts):
            end = at + max(1, int(np.searchsorted(np.cumsum(cnts[at:]), rows, side="right")))
            part, n = batch.slice(at, end - at), cnts[at:end]
            letters = "".join(part.column(3).to_pylist())
            if letters.isascii():
                codes = lut[np.frombuffer(letters.encode(), np.uint8)]
            else:
                text = np.frombuffer(letters.encode("utf-32-le"), "<u4")
                codes = np.where(text < 256, lut[np.minimum(text, 255)], 255)
            begins = np.concatenate(([0], np.cumsum((n - 1) * step + w)[:-1]))
            row = np.repeat(np.arange(len(n)), n)
            j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            place = begins[row] + j * step
            counts = np.empty((len(residues), len(row)), dtype=np.int32)
            running = np.zeros(len(codes) + 1, dtype=np.int32)
            for k in range(len(residues)):
                np.cumsum(codes == k, out=running[1:])
                np.take(running[w:] - running[:-w], place, out=counts[k])
            starts = ((part.column(1).to_numpy()[row] + j) * step + 1).astype(np.int32)
            yield part.column(0).take(pa.array(row)), starts, counts
            at = end


def _lists(words: np.ndarray) -> pa.Array:
    n, k = words.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * k, k, dtype=np.int32), pa.array(words.reshape(-1), type=pa.int64()))


def least_votes(pct: float, n: int) -> int:
    """Votes a window needs at ``pct`` % of N lists; one at least."""
    return max(1, math.ceil(pct / 100.0 * n))


@dataclass(frozen=True)
class WindowScores:
    """All models over all windows of ``seqs`` (residue composition), evaluated when asked.

    Every method is one pass over the text. ``repeated`` holds the IDs that stand on several records: their
    windows share names, so their votes are united per name (``rows`` does it); other names occur once.
    """

    seqs: DataFrame
    models: LinearModels
    residues: str
    w: int = 15
    step: int = 1
    min_len: int = 15
    spread_above: int | None = SPREAD_ABOVE
    chunk: int = CHUNK

    def _pass(self, emit: Callable, schema: str, seqs: DataFrame | None = None) -> DataFrame:
        """``emit(blocks)`` over (seq_ids, starts, compositions) blocks of each task."""
        if len(self.residues) != self.models.W.shape[1]:
            raise ValueError("residue alphabet does not match model width")
        w, step, residues = self.w, self.step, self.residues

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from emit((ids, starts, (counts / float(w)).T) for ids, starts, counts in window_blocks(batches, w, step, residues))

        chunks = window_chunks(self.seqs if seqs is None else seqs, w, step, self.min_len, self.chunk, self.spread_above)
        return chunks.select("seq_id", "first", "cnt", "text").mapInArrow(run, schema)

    def _rows(self, least: int, seqs: DataFrame | None = None) -> DataFrame:
        models = self.models

        def emit(blocks):
            for ids, starts, x in blocks:
                words, support = models.counted(models.votes(x))
                keep = np.flatnonzero(support >= least)
                if len(keep):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep)), pa.array(starts[keep]), pa.array(support[keep]), _lists(words[keep])],
                                                     ["seq_id", "start", "support", "hits"])

        return self._pass(emit, "seq_id string, start int, support long, hits array<bigint>", seqs)

    def rows(self, least: int = 0) -> DataFrame:
        """``(NAME, seq_id, start, support, hits)`` of every window with at least ``least`` votes, one row per name."""
        dup = self.repeated()
        if dup is None:
            out = self._rows(least)
        else:
            ids = dup.withColumnRenamed("seq_id", "_id")
            same = F.col("seq_id") == F.col("_id")
            many = dedupe_support(self._rows(0, self.seqs.join(ids, same, "left_semi")), "seq_id", self.models.n_words, ("start",))
            out = self._rows(least, self.seqs.join(ids, same, "left_anti")).unionByName(many.where(F.col("support") >= least))
        return out.select(fragment_name("seq_id", "start").alias("NAME"), "seq_id", "start", "support", "hits")

    def voted(self, pct: float) -> tuple[DataFrame, int]:
        """N, and ``rows`` of the windows with at least ``ceil(pct / 100 * N)`` votes, from one scoring pass.

        A task knows which models it has seen fire: their number bounds N from below, so it hands over only rows that reach
        the threshold of that bound, and at its end the models themselves as a row without a start. N is the union of
        those; rows below its threshold go then. Windows of repeated IDs are united before they are judged.
        """
        models = self.models

        def emit_above(bounded: bool) -> Callable:
            def emit(blocks):
                fired = np.zeros(len(models.list_ids), dtype=np.int64)
                for ids, starts, x in blocks:
                    if bounded:
                        words, support = models.counted(models.votes_above(x, fired, pct))
                    else:
                        words, support = models.counted(models.votes(x))
                        fired += models.set_bits(np.bitwise_or.reduce(words, axis=0))
                    keep = np.flatnonzero(support >= (least_votes(pct, int((fired > 0).sum())) if bounded else 1))
                    if len(keep):
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep)), pa.array(starts[keep]), pa.array(support[keep]), _lists(words[keep])], names)
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([None], pa.int32()), pa.array([0], pa.int64()), _lists(models.words(fired[None, :] > 0))], names)
            return emit

        names, schema = ["seq_id", "start", "support", "hits"], "seq_id string, start int, support long, hits array<bigint>"
        dup = self.repeated()
        if dup is None:
            found, many = materialise(self._pass(emit_above(True), schema), "votes"), None
        else:
            ids = dup.withColumnRenamed("seq_id", "_id")
            same = F.col("seq_id") == F.col("_id")
            found = materialise(self._pass(emit_above(True), schema, self.seqs.join(ids, same, "left_anti")), "votes")
            many = materialise(self._pass(emit_above(False), schema, self.seqs.join(ids, same, "left_semi")), "votes of repeated ids")
        masks = found.where(F.col("start").isNull())
        n = self._count_lists(masks if many is None else masks.unionByName(many.where(F.col("start").isNull())))
        out = found.where(F.col("start").isNotNull())
        if many is not None:
            out = out.unionByName(dedupe_support(many.where(F.col("start").isNotNull()), "seq_id", models.n_words, ("start",)).select(*out.columns))
        out = out.where(F.col("support") >= least_votes(pct, n))
        return out.select(fragment_name("seq_id", "start").alias("NAME"), "seq_id", "start", "support", "hits"), n

    def _count_lists(self, masks: DataFrame) -> int:
        """Number of models in the union of the ``hits`` bitmasks."""
        n_words = self.models.n_words
        r = masks.agg(*[F.bit_or(F.col("hits")[j]).alias(f"w{j}") for j in range(n_words)]).first()
        return sum(((r[j] or 0) & ((1 << 64) - 1)).bit_count() for j in range(n_words))

    def repeated(self) -> DataFrame | None:
        """IDs of several records, or None; only IDs are counted, not text."""
        dup = self.seqs.groupBy("seq_id").count().where("count > 1").select("seq_id")
        n = dup.limit(1_000_001).count()
        return None if n == 0 else F.broadcast(dup) if n <= 1_000_000 else dup

    def n_lists(self) -> int:
        """N = number of models that predict at least one window positive.

        Each task stops reading once every model has had a positive window, so the usual case touches a few chunks
        per task; a model that never fires makes the tasks read everything. One bitmask per task reaches the driver.
        """
        models = self.models

        def emit(blocks):
            seen = np.zeros(len(models.list_ids), dtype=bool)
            for _, _, x in blocks:
                seen |= models.votes(x).any(axis=0)
                if seen.all():
                    break
            yield pa.RecordBatch.from_arrays([_lists(models.words(seen[None, :]))], ["hits"])

        return self._count_lists(self._pass(emit, "hits array<bigint>"))

    def list_digests(self) -> DataFrame:
        """``(list_id, n_positive, name_sum)`` of each non-empty list: its length and the sum of the first 8 hex digits of
        its names' md5 (``digest_sums``). Each task sums up its own lists, so a list is one row per task, not one per name. IDs must be unique.
        """
        models, ids = self.models, list(self.models.list_ids)

        def emit(blocks):
            n, total = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
            for seq_ids, starts, x in blocks:
                pos = models.votes(x)
                h = md5_tops(pc.binary_join_element_wise(seq_ids, pa.array(starts).cast(pa.string()), ":")).to_numpy()
                for i in range(0, len(h), BLOCK):
                    # exact in 32-bit floats: the hashes' bytes, and ones to count, summed over a block of rows
                    parts = np.stack([(h[i:i + BLOCK] >> s) & 0xFF for s in (0, 8, 16, 24)] + [np.ones_like(h[i:i + BLOCK])]).astype(np.float32)
                    sums = (parts @ pos[i:i + BLOCK].astype(np.float32)).astype(np.int64)
                    n += sums[4]
                    total += sums[0] + (sums[1] << 8) + (sums[2] << 16) + (sums[3] << 24)
            yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.string()), pa.array(n), pa.array(total)], ["list_id", "n", "h"])

        per_task = self._pass(emit, "list_id string, n bigint, h bigint")
        return digest_sums(per_task)


def digest_sums(parts: DataFrame) -> DataFrame:
    """``(list_id, n, h)`` of the tasks -> ``(list_id, n_positive, name_sum)`` of the non-empty lists.

    Four billion names of 32 bits go beyond a BIGINT: the sum is kept modulo 2^64, as a signed number. Sums that fit are themselves.
    """
    low = (1 << 32) - 1
    sums = parts.groupBy("list_id").agg(F.sum("n").alias("n_positive"), F.sum(F.shiftright("h", 32)).alias("hi"), F.sum(F.col("h").bitwiseAND(low)).alias("lo"))
    name_sum = F.shiftleft(F.col("hi") + F.shiftright("lo", 32), 32).bitwiseOR(F.col("lo").bitwiseAND(low))   # a shift drops what doesn't fit
    return sums.where(F.col("n_positive") > 0).select("list_id", "n_positive", name_sum.alias("name_sum"))


def composition_rows(seqs: DataFrame, residues: str, w: int = 15, step: int = 1, min_len: int = 15, chunk: int = CHUNK,
                     spread_above: int | None = SPREAD_ABOVE, digits: int | None = None) -> DataFrame:
    """X9 straight from the text: ``NAME, seq_id, start, f_A .. f_Y`` of every window, rounded half up to ``digits`` places if given.

    A fraction is one of w + 1 values, so it is looked up (and rounded) by its count.
    """
    names = [f"f_{a}" for a in residues]
    values = np.arange(w + 1) / float(w)
    if digits is not None:
        values = np.array([float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) for v in values.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, counts in window_blocks(batches, w, step, residues):
            yield pa.RecordBatch.from_arrays([ids, pa.array(starts), *(pa.array(values[c]) for c in counts)], ["seq_id", "start", *names])

    chunks = window_chunks(seqs, w, step, min_len, chunk, spread_above).select("seq_id", "first", "cnt", "text")
    out = chunks.mapInArrow(run, "seq_id string, start int, " + ", ".join(f"{n} double" for n in names))
    return out.select(fragment_name("seq_id", "start").alias("NAME"), "seq_id", "start", *names)


def composition_near(seqs: DataFrame, residues: str, seeds: list, bounds: list[int], w: int = 15, step: int = 1, min_len: int = 15) -> DataFrame:
    """``(NAME, f_A .. f_Y, _i)``: the rows of ``composition_rows`` whose key by the i-th seed (``md5('<seed>:<NAME>')``, first 32 bits) is below its bound.

    Names are hashed where the windows are cut; fractions are made for those rows alone, and no other row leaves the task.
    """
    names, seeds = [f"f_{a}" for a in residues], [str(s) for s in seeds]
    values = np.arange(w + 1) / float(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, counts in window_blocks(batches, w, step, residues):
            label = pc.binary_join_element_wise(ids, pa.array(starts).cast(pa.string()), ":", null_handling="skip")   # as fragment_name
            for i, (seed, bound) in enumerate(zip(seeds, bounds, strict=True)):
                at = np.flatnonzero(pc.fill_null(pc.less(md5_tops(label, f"{seed}:"), bound), False).to_numpy(zero_copy_only=False))
                if len(at):
                    yield pa.RecordBatch.from_arrays([label.take(pa.array(at)), *(pa.array(values[c[at]]) for c in counts), pa.array(np.full(len(at), i, np.int32))], ["NAME", *names, "_i"])

    chunks = window_chunks(seqs, w, step, min_len, CHUNK).select("seq_id", "first", "cnt", "text")
    return chunks.mapInArrow(run, "NAME string, " + ", ".join(f"{n} double" for n in names) + ", _i int")


def score_features(features: DataFrame, models: LinearModels, feature_cols: list[str], keep: list[str], least: int = 0) -> DataFrame:
    """``keep + support + hits`` for every row of an ingested feature table with at least ``least`` votes."""
    if len(feature_cols) != models.W.shape[1]:
        raise ValueError("feature count does not match model width")
    head = features.select(*keep, F.array(*[F.col(f"`{c}`").cast("double") for c in feature_cols]).alias("x"))
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pos = models.votes(batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                support = pos.sum(axis=1).astype(np.int64)
                sel = np.flatnonzero(support >= least)
                part = batch.take(pa.array(sel))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(k)), pa.array(support[sel]), _lists(models.words(pos[sel]))], [*keep, "support", "hits"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head.select(*keep).schema)
    return head.mapInArrow(run, f"{kinds}, support long, hits array<bigint>")


def hit_count(words) -> F.Column:
    """Number of set bits of some bitmask columns."""
    return sum((F.bit_count(x).cast("bigint") for x in words), F.lit(0).cast("bigint"))


def dedupe_support(scored: DataFrame, name_col: str, n_words: int, keep=()) -> DataFrame:
    """Exact A1 for repeated names: OR the bitmasks per name, then count bits (a partial aggregate)."""
    g = scored.groupBy(name_col, *keep).agg(*[F.bit_or(F.col("hits")[j]).alias(f"w{j}") for j in range(n_words)])
    words = [F.col(f"w{j}") for j in range(n_words)]
    return g.select(name_col, *keep, hit_count(words).alias("support"), F.array(*words).alias("hits"))


def n_lists_of(scored: DataFrame, n_words: int) -> F.Column:
    """N over scored rows (lazy scalar subquery): models with at least one positive row."""
    g = scored.agg(*[F.bit_or(F.col("hits")[j]).alias(f"w{j}") for j in range(n_words)])
    return g.select(F.coalesce(hit_count([F.col(f"w{j}") for j in range(n_words)]), F.lit(0).cast("bigint")).alias("n_lists")).scalar()


def prediction_pairs(scored: DataFrame, models: LinearModels, name_col: str = "NAME", plan: DataFrame | None = None) -> DataFrame:
    """Set bits of the bitmask -> per-model prediction lists ``(list_id, name)``, with the identity columns of ``plan``
    (``family, crit, tag, mult, n_feats, model``) where it is given (K5 input). Only set bits are exploded.
    """
    ids = F.array(*[F.lit(x) for x in models.list_ids])
    bits = F.filter(F.sequence(F.lit(0), F.lit(len(models.list_ids) - 1)),
                    lambda j: F.getbit(F.get("hits", F.floor(j / 64).cast("int")), j % 64) == 1)
    pairs = scored.where(F.col("support") > 0).select(F.col(name_col).alias("name"), F.explode(bits).alias("j"))
    pairs = pairs.select(F.get(ids, F.col("j")).alias("list_id"), "name")
    return pairs if plan is None else pairs.join(F.broadcast(plan), "list_id")   # plan: one row per model


def predict_positive_names(scored_one_model: DataFrame, name_col: str = "NAME", prediction_col: str = "prediction") -> DataFrame:
    """Names predicted as class 0 (positive) by one fitted Spark ML model."""
    return scored_one_model.where(F.col(prediction_col) == 0).select(F.col(name_col).alias("name"))
