"""Removal of repeated strings by deep-shallow suffix sorting.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier. Sorting all suffixes of the corpus
would move every byte a hundred times, so the suffixes that can matter are found first. Each window of ``length``
bytes names an anchor, the k-gram in it with the least hash; equal windows name equal anchors at equal places. The
windows around one anchor occurrence form a segment, about 40 windows long. Occurrences of equal segments need no
sorting: all but the first go. Only the first occurrences of different segments on one anchor are sorted, their text
from the anchor on and, reversed, up to it: multikey quicksort to a shallow depth, then a blind trie for the groups
whose common prefix is longer. Common prefixes of neighbours in the two orders tell which windows are equal.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from motifspark.llm.common import materialise

#: Windows of one text that are hashed at a time, and bytes of text whose segments are compared before the shuffle.
BLOCK, GATHER = 1 << 20, 24 << 20
#: Distinct segments on one anchor that one task sorts; anchors with more are settled window by window.
MOST_SORTED = 200_000
_RANDOM = np.random.default_rng(20_250_101)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(1 << 62, 1 << 63)) | 1
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
NO_ID = -(1 << 63)


# --- deep-shallow sorting -------------------------------------------------------------------------------------------

def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Orders strings by inserting them into a trie that keeps only branching depths and branching bytes.

    A node is [depth, bytes, children], children in byte order (-1: the string ends); a leaf is a list of equal strings.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.top = strings, None

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.top is None:
            self.top = [i]
            return
        node, path = self.top, []
        while isinstance(node[-1], list):  # go down blindly: bytes between branchings are not looked at
            path.append(node)
            c = s[node[0]] if node[0] < len(s) else -1
            at = bisect_left(node[1], c)
            node = node[2][at if at < len(node[1]) and node[1][at] == c else 0]
        other = self.strings[node[0]]
        depth = _common(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            return
        # the branch belongs above the first node on the path that is deeper
        k = next((k for k, p in enumerate(path) if p[0] >= depth), len(path))
        below = path[k] if k < len(path) else node
        mine, its = s[depth] if depth < len(s) else -1, other[depth] if depth < len(other) else -1
        if k < len(path) and below[0] == depth:
            at = bisect_left(below[1], mine)
            below[1].insert(at, mine)
            below[2].insert(at, [i])
            return
        new = [depth, [mine, its], [[i], below]] if mine < its else [depth, [its, mine], [below, [i]]]
        if k == 0:
            self.top = new
        else:
            up = path[k - 1]
            up[2][next(j for j, x in enumerate(up[2]) if x is below)] = new

    def order(self) -> list[int]:
        out: list[int] = []
        stack = [self.top] if self.top is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node[-1], list):
                stack.extend(reversed(node[2]))
            else:
                out.extend(node)
        return out


def deep_shallow_order(strings: list[bytes], members: list[int], shallow: int = 40, letter: int = 8) -> list[int]:
    """``members`` in the order of their strings; equal strings keep no particular order.

    Multikey quicksort on letters of ``letter`` bytes down to ``shallow``; longer common prefixes go to a blind trie.
    """
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(members, 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) < 2:
            out += group
            continue
        if depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            out += trie.order()
            continue
        letters = [strings[i][depth:depth + letter] for i in group]
        n = len(letters)
        pivot = sorted((letters[0], letters[n // 2], letters[-1]))[1]
        less, same, more = [], [], []
        for i, c in zip(group, letters, strict=True):
            (same if c == pivot else less if c < pivot else more).append(i)
        stack.append((more, depth))
        stack.append((same, depth + letter) if len(pivot) == letter else (same, 1 << 30))
        stack.append((less, depth))
    return out


def repeated_windows(groups: list[int], before: list[bytes], after: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """For members in document order: which windows ``r`` (starting r bytes before the anchor) stand in an earlier member of
    the same group. Member m has the windows low[m] to high[m]; ``before`` is reversed.
    """
    n, width = len(groups), int(high.max()) + 1
    key = np.asarray(groups)
    bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), n]

    def classes(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the members and each one's common prefix with the one before it (-1 at the start of a group)."""
        order = np.array([i for a, b in zip(bounds, bounds[1:]) for i in deep_shallow_order(strings, list(range(a, b)))])
        size = np.fromiter(map(len, strings), np.int64, n)[order]
        text = np.frombuffer(b"".join([strings[i].ljust(depth, b"\0") for i in order]), np.uint8).reshape(n, depth)
        same = np.full(n, -1)
        differ = text[1:] != text[:-1]
        first = np.where(differ.any(1), differ.argmax(1), depth)
        same[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
        same[bounds[:-1]] = -1
        return order, same

    right, right_same = classes(after, length)
    left, left_same = classes(before, max(1, width - 1))
    found = np.zeros((n, width), bool)
    by_right, by_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for r in range(width):
        by_right[right] = np.cumsum(right_same < length - r)
        by_left[left] = np.cumsum(left_same < r)
        own = np.flatnonzero((low <= r) & (r <= high))
        if len(own) > 1:
            _, first = np.unique(by_right[own] * (n + 1) + by_left[own], return_index=True)
            later = np.ones(len(own), bool)
            later[first] = False
            found[own[later], r] = True
    return found


# --- anchors and segments ------------------------------------------------------------------------------------------

def _hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-gram, by doubling."""
    done, h, part, n, size = 0, _BYTE[raw], None, len(raw), 1
    while size <= k:
        if k & size:
            part = h[:n - size + 1] if part is None else part[:n - done - size + 1] * np.uint64(pow(_BASE, size, 1 << 64)) + h[done:n - size + 1]
            done += size
        if 2 * size <= k:
            h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    x = (part ^ (part >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def segments(text: bytes, length: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, segment hash, start of the first window, windows, anchor's distance from that start), block by block."""
    grams, hash64 = length - k + 1, xxhash.xxh3_64_intdigest
    whole = np.frombuffer(text, np.uint8)
    for at in range(0, len(whole) - length + 1, BLOCK):
        raw = whole[at:at + BLOCK + length - 1]
        h = _hashes(raw, k)
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equals
        size = 1
        while 2 * size <= grams:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < grams:
            least = np.minimum(least[:len(least) - (grams - size)], least[grams - size:])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        ends = np.concatenate((starts[1:], [len(place)]))
        view = memoryview(raw)
        own = np.array([hash64(view[a:b]) for a, b in zip(starts.tolist(), (ends + (length - 1)).tolist(), strict=True)], np.uint64)
        anchor = place[starts]
        yield h[anchor], own, starts + at, ends - starts, anchor - starts


def _pack(tail: int, start: np.ndarray, n: np.ndarray, off: np.ndarray) -> np.ndarray:
    return (np.int64(tail) << 45) | (start << 14) | (n << 7) | off


def _unpack(at):
    return (at >> 14) & 0x7FFFFFFF, (at >> 7) & 127, at & 127


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b * _M1)) * _M2
    return x ^ (x >> np.uint64(31))


_PLACES = pa.schema([(c, pa.int64()) for c in ("g", "s", "a", "doc", "th", "at")])


def _gathered(found: list[tuple[np.ndarray, ...]], common: np.ndarray) -> pa.RecordBatch:
    """Segments of some documents, each distinct one once; later ones are marked as settled (s is null).

    A segment on a ``common`` anchor is sent by anchor and content, others by anchor; settled ones anywhere.
    """
    a, s, doc, th, at = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((at, th, doc, s, a))
    a, s, doc, th, at = a[order], s[order], doc[order], th[order], at[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    keep = new | (doc != doc[first]) | (th != th[first]) | (at != at[first])  # equal rows of one document are one
    a, s, doc, th, at, new = a[keep], s[keep], doc[keep], th[keep], at[keep], new[keep]
    salted = new & np.isin(a, common)
    g = np.where(salted, _mix(a, s), np.where(new, a, _mix(doc.view(np.uint64) ^ th.view(np.uint64), at.view(np.uint64))))
    return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(s.view(np.int64), mask=~new), pa.array(a.view(np.int64), mask=~salted),
                                       pa.array(doc), pa.array(th), pa.array(at)], schema=_PLACES)


def _places(docs: DataFrame, length: int, k: int, common: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for doc, th, tail, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for a, s, start, n, off in segments(raw, length, k):
                    found.append((a, s, np.full(len(a), doc, np.int64), np.full(len(a), th, np.int64), _pack(tail, start, n, off)))
                    size += int(n.sum())
                    if size >= GATHER:
                        yield _gathered(found, common)
                        found, size = [], 0
        if found:
            yield _gathered(found, common)

    return docs.mapInArrow(run, "g long, s long, a long, doc long, th long, at long")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (g, s, doc, th, at) -> (a, doc, th, at): a null if all windows of the segment go, else its anchor's hash for the
    first of each distinct segment, if its anchor has several.
    """
    last = None  # g, s, doc, th, at of the first row of the run at hand, and whether it is salted
    waiting = None  # (g, doc, th, at) of the only segment so far on the last anchor
    for batch in batches:
        if not len(batch):
            continue
        g, doc, th, at = (batch.column(i).to_numpy() for i in (0, 3, 4, 5))
        settled = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        s = batch.column(1).fill_null(0).to_numpy()
        salted = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        a = batch.column(2).fill_null(0).to_numpy()
        n = len(g)
        new = np.ones(n, bool)
        new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | settled[1:] | settled[:-1]
        new[0] = last is None or settled[0] or last[:2] != (g[0], s[0])
        first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        head_doc = np.where(first >= 0, doc[first], last[2] if last else 0)
        head_th = np.where(first >= 0, th[first], last[3] if last else 0)
        head_at = np.where(first >= 0, at[first], last[4] if last else 0)
        gone = settled | (~new & ((doc != head_doc) | (th != head_th) | (at != head_at)))
        # anchors with more than one distinct segment; the first and the last anchor may go beyond this batch
        heads = np.flatnonzero(new & ~settled & ~salted)
        several = np.zeros(n, bool)
        before: list[tuple[int, int, int, int]] = []
        if len(heads):
            hg = g[heads]
            start = np.concatenate(([0], np.flatnonzero(np.diff(hg)) + 1, [len(hg)]))
            many = np.repeat(np.diff(start) > 1, np.diff(start))
            if last is not None and not last[5] and hg[0] == last[0]:
                many[:start[1]] = True
                if waiting is not None and waiting[0] == hg[0]:
                    before = [tuple(int(x) for x in waiting)]
            several[heads[many]] = True
            waiting = None if many[-1] else (hg[-1], doc[heads[-1]], th[heads[-1]], at[heads[-1]])
        real = np.flatnonzero(~settled)
        if len(real):
            i = int(real[-1])
            last = (g[i], s[i], head_doc[i], head_th[i], head_at[i], bool(salted[i]))
        send = several | (new & salted)
        ids = np.where(salted, a, g)
        first_, k = np.array(before, np.int64).reshape(-1, 4), int(gone.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([first_[:, 0], ids[send], np.zeros(k, np.int64)]), mask=np.arange(len(first_) + int(send.sum()) + k) >= len(first_) + int(send.sum())),
             *(pa.array(np.concatenate([first_[:, j + 1], x[send], x[gone]])) for j, x in enumerate((doc, th, at)))], ["a", "doc", "th", "at"])


def _sort_chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first column, cut so that equal values stay together."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        kept.append(batch)
        size += len(batch)
        if size >= chunk:
            both = pa.concat_batches(kept)
            a = both.column(0).to_numpy()
            cut = int(np.searchsorted(a, a[-1]))
            if cut:
                yield both.slice(0, cut)
            kept, size = [both.slice(cut)], len(both) - cut
    if size:
        yield pa.concat_batches(kept)


def _ranges(text: bytes, length: int, at: list[int]) -> list[bytes]:
    out = []
    for x in at:
        start, n, _ = _unpack(x)
        out.append(text[start:start + n + length - 1])
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, doc, th, tail, text): doc orders as the ids do, null first; (doc, th, tail) names a document, 82 bits of its text's hashes among them.

    Whole numbers order themselves; other ids get numbers by a distributed sort of the different ones.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("raw"))
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        rows = rows.withColumn("doc", F.col("id").cast("long"))
    else:
        ids = rows.where("id IS NOT NULL").select(F.col("id").alias("id2")).distinct()
        order = materialise(ids.repartitionByRange("id2").sortWithinPartitions("id2").select("id2", F.monotonically_increasing_id().alias("doc")), "id_order")
        rows = rows.join(order, F.col("id") == F.col("id2"), "left").select("id", "raw", "doc")
    return rows.select("id", F.coalesce("doc", F.lit(NO_ID)).alias("doc"), F.coalesce(text_hash(F.col("raw")), F.lit(0)).alias("th"),
                       F.coalesce(F.hash("raw").cast("long").bitwiseAND(F.lit((1 << 18) - 1)), F.lit(0)).alias("tail"), F.coalesce("raw", F.lit("")).alias("text"))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def removed_windows(rows: DataFrame, length: int = 100, anchor: int = 24, most_sorted: int = MOST_SORTED, common_share: float = 0.002, sample: int = 10_000,
                    chunk: int = 20_000) -> DataFrame:
    """(doc, th, tail, start, n, by) of runs of ``n`` windows that also start earlier, for rows of ``_keyed``; by: what settled them.

    ``segment``: equal segments, by 64-bit hashes of anchor and segment; ``sort``: the deep-shallow sort; ``window``:
    128-bit hashes of single windows, for anchors with more than ``most_sorted`` distinct segments.
    """
    if not 0 < length - anchor + 1 < 128 or anchor < 1:
        raise ValueError("length and anchor do not fit")
    texts = rows.select("doc", "th", "tail", "text")
    long_ = texts.where(F.octet_length("text") >= length)

    n = max(1, rows.count())
    some = _places(long_.sample(min(1.0, sample / n), seed=1), length, anchor, np.zeros(0, np.uint64)).where("s IS NOT NULL")
    least = max(8, int(common_share * min(n, sample)))
    common = np.array([r[0] for r in some.groupBy("g").agg(F.countDistinct("s").alias("n")).where(F.col("n") >= least).select("g").collect()], np.int64)  # at most sampled segments / least

    placed = _places(long_, length, anchor, np.sort(common.view(np.uint64))).repartition("g").sortWithinPartitions("g", "s", "doc", "th", "at")
    settled = materialise(placed.mapInArrow(_settle, "a long, doc long, th long, at long"), "suffix_segments")
    tail = F.shiftright("at", 45)
    open_ = settled.where("a IS NOT NULL")
    large = open_.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_sorted).select("a")
    n_large = large.count()

    def with_text(places: DataFrame) -> DataFrame:
        per_doc = places.groupBy(F.col("doc").alias("doc2"), F.col("th").alias("th2"), tail.alias("tail2")).agg(F.collect_list(F.struct("a", "at")).alias("places"))
        return texts.join(per_doc, _same()).select("doc", "th", "tail", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text, places = batch.column(3)[i].as_py().encode("utf-8", "surrogatepass"), batch.column(4)[i].values
                at = places.field(1)
                yield pa.RecordBatch.from_arrays([places.field(0), *(pa.array([batch.column(j)[i].as_py()] * len(at), pa.int64()) for j in (0, 1)), at,
                                                  pa.array(_ranges(text, length, at.to_pylist()), pa.binary())], ["a", "doc", "th", "at", "part"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in _sort_chunks(batches, chunk):
            ids = np.stack([rows_.column(i).to_numpy() for i in range(4)])  # equal rows of the input cut equal parts
            rows_ = rows_.filter(pa.array(np.concatenate(([True], (ids[:, 1:] != ids[:, :-1]).any(0)))))
            start, n_, off = _unpack(rows_.column(3).to_numpy())
            parts, offs = rows_.column(4).to_pylist(), off.tolist()
            found = repeated_windows(rows_.column(0).to_pylist(), [p[:o][::-1] for p, o in zip(parts, offs, strict=True)],
                                     [p[o:o + length] for p, o in zip(parts, offs, strict=True)], off - n_ + 1, off, length)
            member, r = np.nonzero(found)
            if len(member):
                yield pa.RecordBatch.from_arrays([*(rows_.column(i).take(pa.array(member)) for i in (1, 2)), pa.array(rows_.column(3).to_numpy()[member] >> 45),
                                                  pa.array(start[member] + off[member] - r), pa.array(np.ones(len(member), np.int64))], ["doc", "th", "tail", "start", "n"])

    found = "doc long, th long, tail long, start long, n long"
    sorted_ = (with_text(open_.join(F.broadcast(large) if n_large <= 100_000 else large, "a", "left_anti") if n_large else open_).mapInArrow(cut, "a long, doc long, th long, at long, part binary")
               .repartition("a").sortWithinPartitions("a", "doc", "th", "at").mapInArrow(sort, found))
    whole = settled.where("a IS NULL").select("doc", "th", tail.alias("tail"), F.shiftright("at", 14).bitwiseAND(F.lit(0x7FFFFFFF)).alias("start"),
                                              F.shiftright("at", 7).bitwiseAND(F.lit(127)).alias("n"))
    removed = whole.withColumn("by", F.lit("segment")).unionByName(sorted_.withColumn("by", F.lit("sort")))
    if n_large:
        def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    text = memoryview(batch.column(3)[i].as_py().encode("utf-8", "surrogatepass"))
                    starts = sorted({s + j for x in batch.column(4)[i].values.field(1).to_pylist() for s, n_, _ in [_unpack(x)] for j in range(n_)})
                    keys = [xxhash.xxh3_128_digest(text[s:s + length]) for s in starts]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(pa.array([batch.column(j)[i].as_py()] * len(starts), pa.int64()) for j in range(3)),
                                                      pa.array(starts, pa.int64())], ["w", "doc", "th", "tail", "start"])

        place = F.struct("doc", "th", "tail", "start")
        windows = with_text(open_.join(large, "a", "left_semi")).mapInArrow(single, "w binary, doc long, th long, tail long, start long")
        firsts = windows.groupBy("w").agg(F.min(place).alias("first"))
        later = windows.join(firsts, "w").where(place > F.col("first")).select("doc", "th", "tail", "start", F.lit(1).cast("long").alias("n"), F.lit("window").alias("by"))
        removed = removed.unionByName(later)
    return removed


def _same() -> Column:
    return (F.col("doc") == F.col("doc2")) & (F.col("th") == F.col("th2")) & (F.col("tail") == F.col("tail2"))


def dedup_substrings(docs: DataFrame, length: int = 100, anchor: int = 24, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, spans (array of start, end of the maximal removed runs), kept (binary).

    Order of documents: by id, null first; rows that share an id (or lack one) by 82 bits of hashes of their text; rows equal in
    both are one document and get equal results. Ids may be of any type that can be ordered. Null text: no bytes. Texts
    shorter than ``length`` lose nothing. An empty table gives an empty one.

    Shuffled once: 48 bytes per distinct segment of a few thousand documents (compared before the shuffle, so that a
    passage in a third of all documents is a row per task), the documents for their bytes, and the segments to sort. Anchors on
    more than ``common_share`` of a sample of about ``sample`` documents are spread by segment; the sample steers where rows
    go, not what is found. Anchors with more than ``most_sorted`` distinct segments are settled by 128-bit hashes of their
    single windows, which any number of tasks share.
    """
    rows = _keyed(docs, id_col, text_col)
    removed = removed_windows(rows, length, anchor, **how)
    spans = removed.groupBy(F.col("doc").alias("doc2"), F.col("th").alias("th2"), F.col("tail").alias("tail2")).agg(F.collect_list(F.struct("start", "n")).alias("places"))
    both = rows.join(spans, _same(), "left").select("id", "text", "places")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, removed_, spans_, kept = [], [], [], []
            for i in range(len(batch)):
                raw, places = batch.column(1)[i].as_py().encode("utf-8", "surrogatepass"), batch.column(2)[i]
                runs_ = []
                if places.is_valid:
                    start = places.values.field(0).to_numpy()
                    order = np.argsort(start, kind="stable")
                    end = np.maximum.accumulate((start + places.values.field(1).to_numpy() + length - 1)[order])
                    start = start[order]
                    cut_ = np.flatnonzero(start[1:] > end[:-1]) + 1
                    runs_ = list(zip(start[np.concatenate(([0], cut_))].tolist(), end[np.concatenate((cut_ - 1, [len(end) - 1]))].tolist(), strict=True))
                edges = [0, *(x for ab in runs_ for x in ab), len(raw)]
                kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]) if runs_ else raw)
                ns.append(len(raw))
                removed_.append(len(raw) - len(kept[-1]))
                spans_.append([{"start": a, "end": b} for a, b in runs_])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(removed_, pa.int64()),
                                              pa.array(spans_, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                                             [id_col, "n_bytes", "n_removed", "spans", "kept"])

    kind = rows.schema["id"].dataType.simpleString()
    return both.mapInArrow(finish, f"`{id_col}` {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
