"""Embedding near-dedup by sorted projection passes.

Each pass gives every vector a code, the concatenated signs of its projections on random directions, and sorts the
vectors by code; every vector is compared with the ``window`` vectors before it. Vectors at a small angle share long
code prefixes in some pass. Passes come in rounds, by turns on the vectors and on vectors centred on the mean of their
neighbourhood (where many vectors lie close together, plain codes share their prefixes with too many), until a round
joins next to nothing. The verified pairs of all passes are united to components. Windows are bounded, so a group
larger than a window gets its links counted exactly afterwards: inside each component, vectors within half the limit
angle of the component's mean are linked to each other by the triangle inequality and only counted; all others are
compared with the whole component, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motifspark.llm.common import materialise, runs
from motifspark.llm.graph import connected_components

BITS = 60


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision, of an Arrow column of equally long lists."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares of tiny or huge values stay in range
    return x / np.sqrt((x * x).sum(1, keepdims=True))


#: Dim -> (unit vectors that stand for neighbourhoods, mean of each neighbourhood; zero where few vectors are).
Centres = dict[int, tuple[np.ndarray, np.ndarray]]


def neighbourhoods(vectors: DataFrame, seed: int, pivots: int = 64, many: int = 256) -> Centres:
    """Means of the unit vectors next to each of ``pivots`` rows drawn by hash; neighbourhoods below ``many`` rows have none."""
    drawn = Window.partitionBy(F.size("vector")).orderBy(F.xxhash64("node", F.lit(seed)), "node")
    first = vectors.select("vector", F.row_number().over(drawn).alias("nth")).where(F.col("nth") <= pivots).orderBy(F.size("vector"), "nth").collect()
    at: dict[int, list] = {}
    for r in first:
        at.setdefault(len(r.vector), []).append(r.vector)
    units = {d: _matrix(pa.array(v, pa.list_(pa.float64()))) for d, v in at.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(0)])
            for dim in np.unique(dims):
                x = _matrix(batch.column(0).filter(pa.array(dims == dim)))
                near = np.argmax(x @ units[int(dim)].T, 1)
                n, s = sums.setdefault(int(dim), (np.zeros(len(units[int(dim)]), np.int64), np.zeros(units[int(dim)].shape)))
                np.add.at(n, near, 1)
                np.add.at(s, near, x)
        for dim, (n, s) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), dim, np.int32)), pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n),
                                              pa.array(s.tolist(), pa.list_(pa.float64()))], ["dim", "pivot", "n", "total"])

    made = vectors.select("vector").mapInArrow(run, "dim int, pivot int, n long, total array<double>")
    out = {d: (u, np.zeros(u.shape)) for d, u in units.items()}
    added = F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(max(units))]) if units else F.array()
    for r in made.groupBy("dim", "pivot").agg(F.sum("n").alias("n"), added.alias("total")).collect():
        if r.n >= many:
            out[r.dim][1][r.pivot] = np.array(r.total[:r.dim], np.float64) / r.n
    return out


def codes(vectors: DataFrame, passes: int, seed: int, turn: int = 0, centres: Centres | None = None) -> DataFrame:
    """(node, vector) -> one row (dim, pass, code, node, vector) per pass; each ``turn`` has its own directions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
        for run_ in batches:
            dims = np.array([len(v) for v in run_.column(1)])
            for dim in np.unique(dims):
                batch = run_.filter(pa.array(dims == dim))
                if dim not in directions:
                    directions[dim] = np.random.default_rng([seed, int(dim)] + [turn] * (turn > 0)).standard_normal((int(dim), passes * BITS))
                x = _matrix(batch.column(1))
                if centres is not None:
                    units, means = centres[int(dim)]
                    x = x - means[np.argmax(x @ units.T, 1)]
                signs = (x @ directions[dim] >= 0).reshape(len(batch), passes, BITS)
                made = signs @ weights
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), dim, np.int32)), pa.array(np.full(len(batch), p, np.int32)),
                                                      pa.array(made[:, p]), batch.column(0), batch.column(1)], ["dim", "pass", "code", "node", "vector"])

    return vectors.mapInArrow(run, "dim int, pass int, code long, node string, vector array<double>")


class _Forest:
    """Pairs that join what earlier pairs left apart; all that components need of them."""

    def __init__(self):
        self.up: dict[str, str] = {}

    def root(self, a: str) -> str:
        up = self.up
        while (b := up.get(a, a)) != a:
            up[a] = up.get(b, b)
            a = b
        return a

    def join(self, a: str, b: str) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _compare(names: list[str], x: np.ndarray, new: int, window: int, least: float, forest: _Forest, out: list[tuple[str, str]]) -> None:
    """Compare each row from ``new`` on with the ``window`` rows before it."""
    block = max(window, 64)
    for at in range(new, len(names), block):
        low = max(0, at - window)
        hit = x[at:at + block] @ x[low:at + block].T >= least
        for i, j in zip(*np.nonzero(hit), strict=True):
            a, b = at + int(i), low + int(j)
            if 0 < a - b <= window and forest.join(names[a], names[b]):
                out.append((names[a], names[b]))


_EDGES = "a string, b string, part int, side int, seq int, dim int, pass int, vector array<double>"
_ARROW = pa.schema([("a", pa.string()), ("b", pa.string()), ("part", pa.int32()), ("side", pa.int32()), ("seq", pa.int32()), ("dim", pa.int32()),
                    ("pass", pa.int32()), ("vector", pa.list_(pa.float64()))])


def window_links(coded: DataFrame, window: int, least: float, parts: int) -> DataFrame:
    """(a, b) of verified pairs: enough of them to connect whatever any window connects."""
    ordered = coded.repartitionByRange(parts, "dim", "pass", "code", "node").sortWithinPartitions("dim", "pass", "code", "node")

    def edge(part: int, side: int, rows: pa.RecordBatch) -> pa.RecordBatch:  # what the neighbouring part must see
        n = len(rows)
        return pa.RecordBatch.from_arrays([rows.column(3), pa.nulls(n, pa.string()), pa.array([part] * n, pa.int32()), pa.array([side] * n, pa.int32()),
                                           pa.array(range(n), pa.int32()), rows.column(0), rows.column(1), rows.column(4)], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, forest, kept, seen = TaskContext.get().partitionId(), _Forest(), None, 0
        first: list[pa.RecordBatch] = []
        for batch in batches:
            if seen < window:
                first.append(batch.slice(0, window - seen))
                seen += len(first[-1])
            both = pa.concat_batches([kept, batch]) if kept is not None else batch
            old, out = len(both) - len(batch), []
            for group in runs(iter([both]), 2):
                names = group.column(3).to_pylist()
                before = max(0, old - (group.column(3).offset - both.column(3).offset))
                if before < len(names):
                    _compare(names, _matrix(group.column(4)), min(before, len(names)), window, least, forest, out)
            kept = both.slice(max(0, len(both) - window))
            if out:
                n = len(out)
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in out]), pa.array([e[1] for e in out]), *(pa.nulls(n, f.type) for f in list(_ARROW)[2:])], schema=_ARROW)
        if kept is not None:
            yield edge(part, 0, pa.concat_batches(first))
            yield edge(part, 1, kept)

    found = materialise(ordered.mapInArrow(run, _EDGES), "window_links")
    # the last rows of each part and the first of the next that has any; one row per part goes through the window
    sides = found.where("part IS NOT NULL")
    after = sides.select("part").distinct().withColumn("before", F.lag("part").over(Window.orderBy("part")))
    sides = sides.where("side = 1").withColumn("gap", F.col("part")).unionByName(
        sides.where("side = 0").join(after, "part").where("before IS NOT NULL").withColumn("gap", F.col("before")).drop("before"))
    sides = sides.select("gap", "dim", "pass", F.expr("1 - side").alias("later"), "seq", "a", "vector")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            names, out = group.column(5).to_pylist(), []
            new = group.column(3).to_pylist().count(0)
            if 0 < new < len(names):
                _compare(names, _matrix(group.column(6)), new, window, least, _Forest(), out)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in out]), pa.array([e[1] for e in out])], ["a", "b"])

    crossing = sides.repartition("gap", "dim", "pass").sortWithinPartitions("gap", "dim", "pass", "later", "seq").mapInArrow(across, "a string, b string")
    return found.where("b IS NOT NULL").select("a", "b").unionAll(crossing)


def unite(comps: DataFrame, links: DataFrame, local: int = 100_000) -> tuple[DataFrame, int]:
    """(node, component) of all nodes with the links' components united, and how many joins that took.

    Up to ``local`` links between different components are united on the driver, more by ``connected_components``.
    """
    ends = links.join(comps.select(F.col("node").alias("a"), F.col("component").alias("x")), "a")
    ends = ends.join(comps.select(F.col("node").alias("b"), F.col("component").alias("y")), "b").where("x <> y")
    ends = materialise(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "joins")
    n = ends.count()
    if not n:
        return comps, 0
    if n <= local:
        forest = _Forest()
        for a, b in ends.toLocalIterator():
            forest.join(a, b)
        rows = [(a, forest.root(a)) for a in list(forest.up)]
        made = comps.sparkSession.createDataFrame(rows, "old string, new string")
    else:
        made = connected_components(ends).select(F.col("node").alias("old"), F.col("component").alias("new")).where("old <> new")
    made = materialise(made, "united")
    comps = comps.join(made, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    return materialise(comps, "components"), made.count()


def _unit(v: Column) -> Column:
    big = F.array_max(F.transform(v, F.abs))
    scaled = F.transform(v, lambda x: x / big)
    return F.transform(scaled, lambda x: x / F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda a, y: a + y * y)))


def link_counts(members: DataFrame, least: float, block: int) -> DataFrame:
    """(component, node, vector, copies) -> (node, n_links): how many other vectors of its component each is linked with."""
    half = math.sqrt((1 + least) / 2) + 1e-6  # within this of one point, two vectors are within the limit of each other
    members = materialise(members.withColumn("unit", _unit(F.col("vector"))), "members")
    centres = members.groupBy("component").agg(Summarizer.mean(array_to_vector("unit")).alias("mean"))
    centres = centres.select(F.col("component").alias("c2"), _unit(vector_to_array("mean")).alias("centre"))
    near = F.aggregate(F.zip_with("unit", "centre", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    placed = members.join(centres, F.col("component") == F.col("c2")).select("component", "node", "vector", "copies", (F.coalesce(near, F.lit(0.0)) >= half).alias("core"))
    placed = materialise(placed, "placed")
    totals = placed.groupBy("component").agg(F.sum(F.when(F.col("core"), F.col("copies")).otherwise(F.lit(0))).alias("core_copies"),
                                             F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("core"), True)).alias("n_outer"))
    known = placed.join(totals, "component")
    base = known.select("node", F.when(F.col("core"), F.col("core_copies") - 1).otherwise(F.col("copies") - 1).alias("n_links"))
    known = known.where("n_outer > 0").withColumn("rows_", F.ceil(F.col("n_outer") / block).cast("int")).withColumn("cols_", F.ceil(F.col("n") / block).cast("int"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    outer = known.where("NOT core").select("component", own("rows_").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols_") - 1)).alias("j"), F.lit(True).alias("outer"),
                                           "node", "vector", "copies", "core")
    every = known.select("component", F.explode(F.sequence(F.lit(0), F.col("rows_") - 1)).alias("i"), own("cols_").alias("j"), F.lit(False).alias("outer"),
                         "node", "vector", "copies", "core")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            outer_ = np.array(group.column(3).to_pylist())
            if not outer_.any() or outer_.all():
                continue
            names, copies, core = np.array(group.column(4).to_pylist()), np.array(group.column(6).to_pylist()), np.array(group.column(7).to_pylist())
            x = _matrix(group.column(5))
            hit = (x[outer_] @ x[~outer_].T >= least) & (names[outer_][:, None] != names[~outer_][None, :])
            got = np.concatenate([hit @ copies[~outer_], np.where(core[~outer_], copies[outer_] @ hit, 0)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([names[outer_], names[~outer_]]).tolist(), pa.string()), pa.array(got.astype(np.int64))], ["node", "n_links"])

    more = (outer.unionByName(every).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "outer", "node")
            .mapInArrow(run, "node string, n_links long"))
    return base.unionByName(more).groupBy("node").agg(F.sum("n_links").alias("n_links"))


def near_groups(vectors: DataFrame, least: float = 0.95, passes: int = 16, window: int = 64, block: int = 1024, seed: int = 7,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links (other rows linked directly), component_id (smallest id reachable), kept.

    Equal vectors are one node, however many. Null, empty and zero vectors, vectors with null or non-finite parts and
    rows without id link with nothing: component_id is their own id. Vectors of different length are never compared.
    Repeated rows are vectors like any other. Other columns are not read; an empty table gives an empty one. Rounds
    of passes go on until one adds at most a thousandth to the joins made so far, at least one on the vectors and one on
    the centred ones.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = (F.col("id").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
            & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)))
    rows = rows.select("id", F.when(good, F.col("vector")).alias("vector"), F.when(good, F.md5(F.col("vector").cast("string").cast("binary"))).alias("node"))
    classes = materialise(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "vectors")
    n = classes.count()
    parts = max(1, min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * passes // (16 * window)))
    nodes = classes.select("node", "vector")
    comps, joins, turn = nodes.select("node", F.col("node").alias("component")), 0, 0
    while n > 1:
        centres = neighbourhoods(nodes, turn) if turn % 2 else None
        comps, more = unite(comps, window_links(codes(nodes, passes, seed, turn, centres), window, least, parts))
        joins, turn = joins + more, turn + 1
        if turn > 1 and more <= joins // 1000:
            break
    comps = comps.join(comps.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("component"), "component")
    members = comps.join(classes, "node").select("component", "node", "vector", "copies")
    counts = link_counts(members, least, block)
    grouped = classes.select("node", "least", "copies").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    label = grouped.join(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "component").join(counts, "node", "left")
    label = label.select("node", "component_id", F.coalesce("n_links", F.col("copies") - 1).alias("n_links"))
    out = rows.select("id", "node").join(label, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
