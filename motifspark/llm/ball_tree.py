"""Ranked lexical search: exact inner products of sparse integer vectors through ball trees.

Every document is a sparse vector of integer term impacts, every query a vector of term counts; the score is their
inner product. Documents stay in the partition that read them and are cut into blocks of bounded size there; each block
becomes a ball tree by splitting along the line between two far documents. A node holds a centroid and, for every few
neighbouring dimensions, the radius of the ball around it in those dimensions. By Cauchy-Schwarz no document below the
node scores above ``q . centroid + sum(|q_g| radius_g)``; that bound is rounded up (see ``_up``), nodes are visited
best bound first, and a subtree goes unvisited once its bound is below the query's k-th best score so far. At the
leaves scores are exact 64-bit integers, so bounds decide what is skipped and never what is returned.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motifspark.llm.common import materialise

#: Lower-cases A-Z; every ASCII byte that is no letter or digit becomes a blank; other bytes stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: The sums behind a bound add at most 2^20 non-negative doubles, so they are off by less than 2^20 * 2^-52 of their size.
_MOST_DIMS = 1 << 20


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _up(x: np.ndarray) -> np.ndarray:
    """Above the exact value of a sum of non-negative products, whatever way the doubles were rounded."""
    return x * (1 + 2.0 ** -30) + 1


def _within(total: np.ndarray, node_of: np.ndarray, n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each node, and a row that has it. Every node has rows."""
    order = np.lexsort((-total, node_of))
    first = order[np.searchsorted(node_of[order], np.arange(n_nodes))]
    return total[first], first


class BallTree:
    """A ball tree over the rows of a sparse matrix in compressed rows: ``ptr``, ``col`` (ascending per row), ``val`` (positive int64)."""

    def __init__(self, ptr: np.ndarray, col: np.ndarray, val: np.ndarray, n_cols: int, leaf: int = 32, ball_dims: int = 2):
        n = len(ptr) - 1
        self.n_cols, self.ball_dims, self.n_groups = n_cols, ball_dims, -(-n_cols // ball_dims)
        self.depth = max(0, math.ceil(math.log2(max(1, n) / leaf)))
        self.order = np.arange(n)  # row at each place of the tree
        row_len = np.diff(ptr)
        row, x = np.repeat(np.arange(n), row_len), val.astype(np.float64)  # below 2^53, so exact
        norm = np.bincount(row, x * x, n)
        edges, self.centres, self.radii, self.edges = np.array([0, n]), [], [], []
        for level in range(self.depth + 1):
            k = len(edges) - 1
            node_of = np.empty(n, np.int64)
            node_of[self.order] = np.repeat(np.arange(k), np.diff(edges))
            at = node_of[row] * n_cols + col
            centre = np.bincount(at, x, k * n_cols).reshape(k, n_cols) / np.diff(edges)[:, None]
            c = centre.ravel()[at]
            self.edges.append(edges)
            self.centres.append(centre)
            self.radii.append(self._radii(centre, c, x, row, col, node_of, n, edges))
            if level == self.depth:
                break
            # farthest row from the centroid, farthest row from that one; halves along the line between them
            _, a = _within(norm - 2 * np.bincount(row, x * c, n), node_of, k)
            to_a = self._dot(a, ptr, col, x, row, node_of, k)
            _, b = _within(norm - 2 * to_a, node_of, k)
            along = to_a - self._dot(b, ptr, col, x, row, node_of, k)
            self.order = np.lexsort((np.arange(n), along, node_of))
            edges = np.unique(np.concatenate([edges, (edges[:-1] + edges[1:]) // 2]))
        taken = row_len[self.order]
        self.ptr = np.concatenate([[0], np.cumsum(taken)])
        source = np.repeat(ptr[self.order] - self.ptr[:-1], taken) + np.arange(self.ptr[-1])
        self.col, self.val = col[source], val[source]

    def _dot(self, pivot: np.ndarray, ptr: np.ndarray, col: np.ndarray, x: np.ndarray, row: np.ndarray, node_of: np.ndarray, k: int) -> np.ndarray:
        """Inner product of every row with its node's pivot row."""
        dense = np.zeros((k, self.n_cols))
        for i, p in enumerate(pivot):
            dense[i, col[ptr[p]:ptr[p + 1]]] = x[ptr[p]:ptr[p + 1]]
        return np.bincount(row, x * dense[node_of[row], col], len(node_of))

    def _radii(self, centre: np.ndarray, c: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray, node_of: np.ndarray, n: int, edges: np.ndarray) -> np.ndarray:
        """Per node and group of dimensions, at least the distance of its farthest row from the centroid."""
        groups = self.n_groups
        padded = np.zeros((len(centre), groups * self.ball_dims))
        padded[:, :self.n_cols] = centre * centre
        square = padded.reshape(len(centre), groups, self.ball_dims).sum(2)
        # |x - c|^2 = |c|^2 + sum over the row's own entries of (x - c)^2 - c^2; the slack covers the cancellation
        moved = np.bincount(row * groups + col // self.ball_dims, (x - c) ** 2 - c * c, n * groups).reshape(n, groups)
        most = np.maximum.reduceat(moved[self.order], edges[:-1], axis=0) if n else np.zeros_like(square)
        biggest = np.maximum(square, np.abs(most))
        return np.sqrt(np.maximum(square + most, 0) + biggest * 2.0 ** -40) * (1 + 2.0 ** -40)

    def bounds(self, queries: np.ndarray) -> list[np.ndarray]:
        """Per level, (nodes, queries): no row below the node scores higher. ``queries``: (dimensions, queries) counts."""
        padded = np.zeros((self.n_groups * self.ball_dims, queries.shape[1]))
        padded[:self.n_cols] = queries
        norm = np.sqrt((padded.reshape(self.n_groups, self.ball_dims, -1) ** 2).sum(1))
        return [_up(c @ queries + r @ norm) for c, r in zip(self.centres, self.radii, strict=True)]

    def search(self, query: np.ndarray, bound: list[np.ndarray], best: Best) -> int:
        """Offer ``best`` every row that can be among its k; how many leaves were scored. ``query``: int64 counts; ``bound``: its column of ``bounds``."""
        heap, scored = [(-float(bound[0][0]), 0, 0)], 0
        while heap:
            less, level, node = heapq.heappop(heap)
            if -less < best.least:
                break
            if level < self.depth:
                mid = np.searchsorted(self.edges[level + 1], self.edges[level][node:node + 2])
                for child in range(int(mid[0]), int(mid[1])):
                    if (b := float(bound[level + 1][child])) >= best.least:
                        heapq.heappush(heap, (-b, level + 1, child))
                continue
            low, high = int(self.edges[level][node]), int(self.edges[level][node + 1])
            s, e = int(self.ptr[low]), int(self.ptr[high])
            got = np.concatenate([[0], np.cumsum(query[self.col[s:e]] * self.val[s:e])])
            got = np.diff(got[self.ptr[low:high + 1] - s])
            scored += 1
            for i in np.flatnonzero(got >= best.least).tolist():
                best.offer(int(got[i]), int(self.order[low + i]))
        return scored


class Best:
    """The k best (score, id) of a query so far: high scores first, then small ids. ``ids``: of the block's rows, set block by block."""

    def __init__(self, k: int):
        self.k, self.kept, self.ids = k, [], []
        self.least = 1  # scores below this are of no use

    def offer(self, score: int, row: int) -> None:
        i = self.ids[row]
        self.kept.append((-score, i is not None, i))
        if len(self.kept) >= 2 * self.k or len(self.kept) == self.k:
            self.settle()

    def settle(self) -> None:
        self.kept = heapq.nsmallest(self.k, self.kept, key=lambda r: r if r[1] else r[:2])
        if len(self.kept) == self.k:
            self.least = -self.kept[-1][0]


@dataclass
class Queries:
    """A group of queries that one search answers: their numbers, and (dimensions x queries) counts over the group's own terms."""

    numbers: list[int]
    cols: np.ndarray  # ascending columns of the vocabulary
    counts: np.ndarray


def _grouped(items: list[Counter], vocabulary: dict[bytes, int], most_dims: int) -> list[Queries]:
    """Queries in groups of at most ``most_dims`` different terms (one query alone may have more)."""
    out: list[Queries] = []
    numbers: list[int] = []
    have: set[bytes] = set()

    def close() -> None:
        cols = np.array(sorted(vocabulary[t] for t in have), np.int64)
        counts = np.zeros((len(cols), len(numbers)), np.int64)
        for j, i in enumerate(numbers):
            for t, f in items[i].items():
                counts[np.searchsorted(cols, vocabulary[t]), j] = f
        out.append(Queries(numbers.copy(), cols, counts))

    for i, item in enumerate(items):
        if numbers and (len(have | item.keys()) > most_dims or len(numbers) >= 1024):
            close()
            numbers, have = [], set()
        if item:
            numbers.append(i)
            have |= item.keys()
    if numbers:
        close()
    return out


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, col, tf) of every document that has a term: its number of terms, and its counts of terms in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, n, sizes, cols, tfs = [], [], [0], [], []
            for i, text in enumerate(batch.column(1)):
                found = terms(text.as_py())
                if found:
                    known = sorted((vocabulary[t], f) for t, f in Counter(found).items() if t in vocabulary)
                    keep.append(i)
                    n.append(len(found))
                    cols.extend(c for c, _ in known)
                    tfs.extend(f for _, f in known)
                    sizes.append(len(cols))
            at = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(cols, pa.int32())),
                                              pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], ["id", "n", "col", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n long, col array<int>, tf array<long>")


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Number of documents of each term of the vocabulary; sums per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        col = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(col.astype(np.int32)), pa.array(total[col])], ["col", "n"])

    df = np.zeros(size, np.int64)
    for r in found.select("col").mapInArrow(run, "col int, n long").groupBy("col").agg(F.sum("n").alias("n")).collect():  # as many rows as the vocabulary
        df[r.col] = r.n
    return df


def impacts(col: np.ndarray, tf: np.ndarray, n: np.ndarray, row: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int, b: int = 75) -> np.ndarray:
    """The integer value of each entry: weight of its term times its saturated count in a text of that length."""
    m = 100 - b + (b * n * n_docs) // n_terms
    return weight[col] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    kept: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        while len(batch):
            kept.append(batch.slice(0, rows - have))
            have += len(kept[-1])
            batch = batch.slice(len(kept[-1]))
            if have == rows:
                yield pa.concat_batches(kept)
                kept, have = [], 0
    if have:
        yield pa.concat_batches(kept)


def _search(found: DataFrame, groups: list[Queries], weight: np.ndarray, n_docs: int, n_terms: int, k: int, rows: int, leaf: int, ball_dims: int) -> DataFrame:
    """(number, id, score): of every task, the k best documents of every query among its own."""
    kind = found.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(k) for g in groups for i in g.numbers}
        id_type = None
        for block in _blocks(batches, rows):
            ids, id_type = block.column(0).to_pylist(), block.column(0).type
            size = np.diff(block.column(2).offsets.to_numpy())
            row, col = np.repeat(np.arange(len(block)), size), block.column(2).flatten().to_numpy().astype(np.int64)
            val = impacts(col, block.column(3).flatten().to_numpy(), block.column(1).to_numpy(), row, weight, n_docs, n_terms)
            for g in groups:
                local = np.full(len(weight) + 1, -1, np.int64)
                local[g.cols] = np.arange(len(g.cols))
                mine = (local[col] >= 0) & (val > 0)
                there, at = np.unique(row[mine], return_inverse=True)  # rows without a term of these queries score 0
                if not len(there):
                    continue
                ptr = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(there)))])
                tree = BallTree(ptr, local[col[mine]], val[mine], len(g.cols), leaf, ball_dims)
                bound = tree.bounds(g.counts.astype(np.float64))
                mine_ids = [ids[i] for i in there]
                for j, i in enumerate(g.numbers):
                    best[i].ids = mine_ids
                    tree.search(np.ascontiguousarray(g.counts[:, j]), [b[:, j] for b in bound], best[i])
        out = []
        for i, b in best.items():
            b.settle()
            out += [(i, r[2], -r[0]) for r in b.kept]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], id_type), pa.array([r[2] for r in out], pa.int64())],
                                             ["number", "id", "score"])

    return found.mapInArrow(run, f"number int, id {kind}, score long")


def _top(found: DataFrame, k: int, by: list[Column]) -> DataFrame:
    place = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text",
           most_terms: int = 500_000, group_dims: int = 8192, block_rows: int = 4096, leaf: int = 32, ball_dims: int = 2) -> DataFrame:
    """(query id, rank, document id, score): the k best documents of every query, exactly; scores above 0 only.

    Queries are answered in rounds of about ``most_terms`` terms; the texts of a round's queries and their different
    terms are all that the driver and each task hold of them. A round reads the documents once, keeps their counts of
    the round's terms in the shared folder, and moves nothing but k rows per query and task. Blocks of documents and
    groups of queries bound a tree's size, whatever the input.

    Every row of ``queries`` is a query of its own, equal ids and texts included; null or empty ones, and queries
    without a term that any document has, give no rows. Null and empty documents have no terms and count nowhere. Rows
    that share a document id are documents of their own. Equal scores go by ascending id, null first. Other columns
    are not read. Empty tables give an empty one.
    """
    if group_dims > _MOST_DIMS:
        raise ValueError(f"group_dims above {_MOST_DIMS}: the bounds' rounding isn't proven there")
    spark = docs.sparkSession
    kinds = {"q": queries.schema[query_id].dataType.simpleString(), "d": docs.schema[id_col].dataType.simpleString()}
    asked = queries.select(F.col(query_id).alias("q"), F.col(query_text).alias("text")).where("text IS NOT NULL")
    letters = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-letters // (4 * most_terms)))
    out = spark.createDataFrame([], f"`{query_id}` {kinds['q']}, rank int, `{id_col}` {kinds['d']}, score long")
    for nth in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("q", "text"), F.lit(rounds)) == nth).collect()
        rows = sorted(rows, key=lambda r: (r.q is not None, r.q if r.q is not None else 0, r.text))
        items = [Counter(terms(r.text)) for r in rows]
        vocabulary: dict[bytes, int] = {}
        for item in items:  # in the order of the queries, so that terms of one query lie next to each other
            for t in item:
                vocabulary.setdefault(t, len(vocabulary))
        if not vocabulary:
            continue
        found = materialise(vectors(docs, vocabulary, id_col, text_col), "term_vectors")
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = document_frequencies(found, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        groups = _grouped(items, vocabulary, group_dims)
        best = _search(found.where(F.size("col") > 0), groups, weight, n_docs, n_terms, k, block_rows, leaf, ball_dims)
        best = _top(best.withColumn("part", F.spark_partition_id() % 64), k, [F.col("number"), F.col("part")]).drop("rank", "part")
        names = spark.createDataFrame([(i, r.q) for i, r in enumerate(rows)], f"number int, q {kinds['q']}")
        ranked = _top(best, k, [F.col("number")]).join(F.broadcast(names), "number")  # names: one round of queries
        out = out.unionAll(ranked.select(F.col("q").alias(query_id), "rank", F.col("id").alias(id_col), "score"))
    return out


def oracle_sql(k: int = 10) -> str:
    """The same ranking by joining every term of every query with every document that has it (DuckDB)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut = rf"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
q AS (SELECT row_number() OVER () AS num, item_id, text FROM benchmark),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, {cut} AS t FROM d) GROUP BY ALL),
ln AS (SELECT rid, sum(tf)::BIGINT AS n FROM tf GROUP BY rid),
al AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM ln),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, al GROUP BY t, n_docs),
qt AS (SELECT num, t, count(*) AS f FROM (SELECT num, {cut} AS t FROM q) GROUP BY ALL),
s AS (SELECT num, rid, sum(f * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM qt JOIN tf USING (t) JOIN w USING (t) JOIN ln USING (rid), al GROUP BY num, rid),
r AS (SELECT num, rid, score, row_number() OVER (PARTITION BY num ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r JOIN q USING (num) JOIN d USING (rid) WHERE rank <= {k}
"""
