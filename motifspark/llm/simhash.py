"""SimHash near-dedup by the general pigeonhole principle.

Fingerprints have 64 bits; two documents link when theirs differ in at most ``distance`` bits. The bits are grouped
into m partitions of correlated bits. If two fingerprints differ in at most d bits, then for any thresholds that sum
to d - m + 1 (each at least -1) some partition differs in at most its own threshold. The thresholds, and m itself,
are chosen by dynamic programming on estimated candidate counts; a partition with threshold -1 is never probed, one
with threshold e is probed with every pattern of at most e changed bits. All probes are one equi-join; the bit
distance is verified inside it. The choice changes the cost only: every choice finds all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import materialise, words
from motifspark.llm.graph import connected_components

BITS = 64
#: Fingerprints (smallest by hash) from which correlations and candidate counts are estimated.
SAMPLE = 4_000


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42, block: int = 1 << 16) -> int:
    """Majority bits of the XXH64 of all word shingles, A-Z lower-cased; a shorter text is one shingle, no word gives 0."""
    w = words(text)
    if not w:
        return 0
    joined = b" ".join(w).lower()
    size = np.fromiter(map(len, w), np.int64, len(w))
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    k = min(shingle, len(w))
    begins, ends = start[: len(w) - k + 1], (start + size)[k - 1:]
    hash64, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(begins), block):
        h = np.array([hash64(joined[a:b], seed) for a, b in zip(begins[at:at + block].tolist(), ends[at:at + block].tolist(), strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, fp): the text's hash and its fingerprint as a signed long, one row per input row, in one narrow Arrow pass."""
    head = docs.select(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("th"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["id", "th", "fp"])

    return head.mapInArrow(run, f"id {head.schema[0].dataType.simpleString()}, th long, fp long")


def correlated_partitions(bits: np.ndarray, m: int) -> list[list[int]]:
    """m groups of equal width: each grows from a free bit by the free bit that correlates most with the group so far."""
    x = bits - bits.mean(0)
    norm = np.sqrt((x * x).sum(0))
    c = np.abs(x.T @ x) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = set(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        group = [max(free, key=lambda b: (sum(c[b, o] for o in free), -b))]
        free.remove(group[0])
        while len(group) < width:
            best = max(free, key=lambda b: (c[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], budget: int) -> list[int]:
    """Thresholds (-1 or more) that sum to ``budget`` with the least total cost; ``costs[i][e + 1]`` is that of threshold e."""
    best = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for e, c in enumerate(row):
                cand = (cost + c, [*chosen, e - 1])
                if total + e - 1 not in nxt or cand < nxt[total + e - 1]:
                    nxt[total + e - 1] = cand
        best = nxt
    return best[budget][1]


def plan(sample: np.ndarray, n: int, distance: int) -> list[tuple[int, int, list[int]]]:
    """(mask, threshold, bits) of the partitions to probe, for n distinct fingerprints of which ``sample`` is a part."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    found = None
    for m in range(1, distance + 2):
        groups = correlated_partitions(bits, m)
        costs = []
        for g in groups:
            b, near = bits[:, g], np.zeros(distance + 1)
            for i in range(0, len(b), 256):  # some rows at a time: the driver holds little
                differ = b[i:i + 256] @ (1 - b).T + (1 - b[i:i + 256]) @ b.T
                near += [np.count_nonzero(differ <= e + 0.5) for e in range(distance + 1)]
            near = (near - len(b)) / 2
            # no smaller than for even bits, so that a small sample doesn't promise nothing
            chance = np.array([sum(comb(len(g), j) for j in range(e + 1)) for e in range(distance + 1)])
            rate = np.maximum(near / pairs, chance / 2.0 ** len(g))
            costs.append([0.0, *(n * (n - 1) / 2 * rate + 4 * n * chance)])
        chosen = allocate(costs, distance - m + 1)
        cost = sum(row[e + 1] for row, e in zip(costs, chosen, strict=True))
        if found is None or cost < found[0]:
            found = (cost, [(sum(1 << b for b in g), e, g) for g, e in zip(groups, chosen, strict=True) if e >= 0])
    return found[1]


def _long(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def near_pairs(fps: DataFrame, distance: int) -> DataFrame:
    """Distinct ``fp`` -> (a, b) with a < b that differ in at most ``distance`` bits, each pair once."""
    n = fps.count()
    picked = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()  # bounded by SAMPLE
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    parts = plan(np.array([r[0] for r in picked], np.int64).view(np.uint64), n, distance)

    def keys(fp: str, patterns: bool) -> Column:
        def of(i: int, mask: int, changes: list[int]) -> Column:
            own = F.col(fp).bitwiseAND(F.lit(_long(mask)))
            return F.transform(F.array(*[F.lit(_long(x)) for x in changes]), lambda x: F.struct(F.lit(i).alias("part"), own.bitwiseXOR(x).alias("key")))

        return F.explode(F.concat(*[of(i, mask, [sum(1 << b for b in c) for j in range((e if patterns else 0) + 1) for c in combinations(group, j)])
                                    for i, (mask, e, group) in enumerate(parts)]))

    left = fps.select(F.col("fp").alias("a"), keys("fp", True).alias("k")).select("a", "k.part", "k.key")
    right = fps.select(F.col("fp").alias("b"), keys("fp", False).alias("k")).select("b", "k.part", "k.key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)  # a pair that an earlier partition finds is not reported again
    for i, (mask, e, _) in enumerate(parts):
        first = first & ((F.col("part") <= i) | (F.bit_count(differ.bitwiseAND(F.lit(_long(mask)))) > e))
    found = left.join(right, ["part", "key"]).where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & first)
    return found.select("a", "b")


def _grouped(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """(id, th, fp, root, component_id), one row per input row; root names the component."""
    prints = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint_classes")
    comps = connected_components(near_pairs(classes.select("fp"), distance))
    grouped = classes.join(comps, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    label = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(label, "fp")


def near_groups(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id), one row per input row: component_id is the smallest id reachable over links.

    Documents with one fingerprint are one node, so thousands of copies cost one probe. Null and wordless texts have
    fingerprint 0 and link like any other. Null ids are passed over in the smallest id (a group of null ids only has a
    null component); repeated rows each give a row; an empty table gives an empty one.
    """
    found = _grouped(docs, shingle, distance, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, one row of each group of near copies: that with the smallest id.

    Ids that are null come last; of rows that share an id, the one with the smallest text hash stays; of rows that are equal in
    both, the one with the smallest hash of all its columns.
    """
    found = _grouped(docs, shingle, distance, id_col, text_col)
    stays = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("k")).select(F.struct("k.id", "k.th").alias("stays"))
    key = F.struct(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("th"))
    rows = docs.select(key.alias("key"), F.struct("*").alias("row"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h"))
    rows = rows.join(stays, F.col("key") == F.col("stays"), "left_semi")
    return rows.groupBy("key").agg(F.min_by("row", "h").alias("row")).select("row.*")
