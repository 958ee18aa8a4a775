"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Every line has a hash. Several chunkings are united. In the first, a rolling hash over two line hashes ends a chunk
wherever it is divisible by ``divisor``: boundaries depend on nearby lines only, so a passage keeps its inner chunks
wherever it moves. The short ones are for passages of a few lines, which the first one's boundaries seldom meet: in
each of ``SHORT`` of them one bit of a line's hash says whether a chunk starts at it, and chunks have at most two lines,
so the two lines themselves decide that they are a chunk. Chunks of two or more lines, one of them with words at
least, that stand in several places are compared byte by byte; the lines of all but the first place are removed. The
first place is the one with the smallest (id, hash of the whole text, position): rows that are equal in both are one
document and never remove each other's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import WORD, let, materialise

MULTIPLIER, MODULUS = 1_000_003, 2_147_483_647
#: Chunkings of at most two lines; a pair of lines is a chunk in none of them with odds of (3/4)^SHORT.
SHORT = 12


def _hex_long(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def text_hash(text: Column) -> Column:
    return F.coalesce(_hex_long(F.md5(text.cast("binary")), 15), F.lit(-1))


def _hashed(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    return F.struct(lines.alias("lines"), F.transform(lines, lambda x: _hex_long(F.md5(x.cast("binary")), 8)).alias("h"))


def _ends(h: Column, divisor: int) -> Column:
    """Last line of each chunk of the first chunking."""
    n = F.size(h)
    roll = lambda i: (F.get(h, i - 1) * MULTIPLIER + F.get(h, i)) % MODULUS % divisor
    return F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | ((i >= 1) & (roll(i) == 0)))


def _spans(ends: Column) -> Column:
    return F.transform(ends, lambda end, k: F.struct(F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1).alias("at"),
                                                     (end + 1 - F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1)).alias("n_lines")))


def _cut(lines: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(lines, at + 1, n), "\n")


def chunks(text: Column, divisor: int = 3) -> Column:
    """Array of (at, n_lines, n_wordy, text) of the first chunking, in order; null text has none."""
    def cut(p: Column) -> Column:
        wordy = lambda x: F.size(F.filter(F.slice(p["lines"], x["at"] + 1, x["n_lines"]), lambda y: y.rlike(WORD)))
        return F.transform(p["spans"], lambda x: F.struct(x["at"].alias("at"), x["n_lines"].alias("n_lines"), wordy(x).alias("n_wordy"),
                                                          _cut(p["lines"], x["at"], x["n_lines"]).alias("text")))

    spans = lambda p: let(_ends(p["h"], divisor), _spans)
    return F.when(text.isNotNull(), let(_hashed(text), lambda p: let(F.struct(p["lines"].alias("lines"), spans(p).alias("spans")), cut)))


def candidates(text: Column, divisor: int = 3) -> Column:
    """Array of (at, n_lines, text) of the multi-line chunks of all chunkings, each once, that hold words; null text has none."""
    def found(p: Column) -> Column:
        h, n = p["h"], F.size(p["h"])
        starts = lambda i: F.get(h, i).bitwiseAND(F.lit((1 << SHORT) - 1))
        first = F.filter(let(_ends(h, divisor), _spans), lambda x: x["n_lines"] > 1)
        short = F.filter(F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.expr("cast(array() as array<int>)")),
                         lambda i: starts(i).bitwiseAND(F.bitwise_not(starts(i + 1))) != 0)
        return F.array_distinct(F.concat(first, F.transform(short, lambda i: F.struct(i.alias("at"), F.lit(2).alias("n_lines")))))

    def cut(p: Column) -> Column:
        texts = F.transform(p["spans"], lambda x: F.struct(x["at"].alias("at"), x["n_lines"].alias("n_lines"), _cut(p["lines"], x["at"], x["n_lines"]).alias("text")))
        return F.filter(texts, lambda x: x["text"].rlike(WORD))

    return F.when(text.isNotNull(), let(_hashed(text), lambda p: let(F.struct(p["lines"].alias("lines"), found(p).alias("spans")), cut)))


def dedup_lines(docs: DataFrame, divisor: int = 3, id_col: str = "doc_id", text_col: str = "text", name: str = "line_dedup") -> DataFrame:
    """Every row and column of ``docs`` plus a struct column ``name``: n_lines, n_chunks (multi-line ones with words, of all chunkings), n_removed_chunks,
    n_removed_lines, kept (the text without them).

    What is shuffled is one small row per multi-line chunk, the texts of chunks whose hash repeats (summed up in each
    task first, so a passage in a third of all documents is one row per task), and the documents once, for their new
    texts. Null text: no lines, ``kept`` null. Empty text: one line, kept. A text whose lines all stand earlier
    becomes empty. Null ids sort first. Repeated rows keep the same lines. An empty table gives an empty one.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    # one form of the input for both joins below, so that its exchange can serve both
    rows = docs.select(F.struct(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th")).alias("doc"), F.col(text_col).alias("text"),
                       *[F.col(f"`{c}`").alias(f"other{i}") for i, c in enumerate(others)])
    places = rows.select("doc", F.explode(candidates(F.col("text"), divisor)).alias("c")).select("doc", "c.at", "c.n_lines", F.xxhash64("c.text").alias("h"))
    places = materialise(places, "line_chunks")  # chunks are cut and hashed once
    again = places.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    repeated = materialise(places.join(again, "h"), "repeated_chunks")

    # bytes: the texts of all chunks whose hash repeats
    same = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["th"] == b["th"])
    per_doc = repeated.groupBy(F.col("doc").alias("doc2")).agg(F.array_sort(F.collect_set(F.struct("at", "n_lines", "h"))).alias("found"))
    texts = rows.join(per_doc, same(F.col("doc"), F.col("doc2"))).select("doc", F.explode(let(
        F.struct(F.split("text", "\n", -1).alias("lines"), F.col("found").alias("found")),
        lambda p: F.transform(p["found"], lambda x: F.struct(x["at"].alias("at"), x["n_lines"].alias("n_lines"), x["h"].alias("h"), _cut(p["lines"], x["at"], x["n_lines"]).alias("text"))))).alias("c"))
    classes = texts.select("c.h", "c.text", F.struct("doc", F.col("c.at").alias("at")).alias("place")).groupBy("h", "text").agg(F.min("place").alias("first"))
    sole = materialise(classes.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first")), "chunk_firsts")

    here = F.struct("doc", "at")
    by_hash = repeated.join(sole.where("n = 1").select("h", "first"), "h").where(here > F.col("first")).select("doc", "at", "n_lines")
    # hashes that different texts share, if there are any: the same, keyed by the bytes too
    if sole.where("n > 1").limit(1).count():
        mixed = texts.select("doc", "c.*").join(sole.where("n > 1").select("h"), "h", "left_semi")
        by_hash = by_hash.unionAll(mixed.join(classes, ["h", "text"]).where(here > F.col("first")).select("doc", "at", "n_lines"))
    removed = by_hash.groupBy("doc").agg(F.collect_set(F.struct("at", "n_lines")).alias("spans"))
    removed = removed.select(F.col("doc").alias("doc2"), F.size("spans").alias("n_removed"),
                             F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["at"], x["at"] + x["n_lines"] - 1))))).alias("gone"))
    # rows that are equal are one document, whose chunks were counted once for each
    known = places.select("doc", "at", "n_lines").distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("n_chunks"))
    known = known.join(removed, same(F.col("doc"), F.col("doc2")), "left").select(F.col("doc").alias("doc2"), "n_chunks", "n_removed", "gone")

    both = rows.join(known, same(F.col("doc"), F.col("doc2")), "left")
    both = both.select(rows["*"], "n_chunks", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("gone", F.expr("array()").cast("array<int>")).alias("gone"),
                       F.split("text", "\n", -1).alias("lines"))
    m, n = F.size("gone"), F.size("lines")

    def run(j: Column) -> Column:  # the lines between two removed ones
        start = F.when(j == 0, F.lit(0)).otherwise(F.get("gone", j - 1) + 1)
        end = F.when(j == m, n).otherwise(F.get("gone", j))
        return F.slice("lines", start + 1, end - start)

    kept = F.when(F.col("text").isNotNull(), F.when(m > 0, F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), m), run)), "\n")).otherwise(F.col("text")))
    both = both.withColumn("kept", kept).withColumn("sizes", F.struct(n.alias("n"), m.alias("m")))
    back = {id_col: F.col("doc.id"), text_col: F.col("text")} | {c: F.col(f"other{i}") for i, c in enumerate(others)}
    return both.select(*[back[c].alias(c) for c in docs.columns], F.struct(
        F.greatest(F.coalesce("sizes.n", F.lit(0)), F.lit(0)).cast("long").alias("n_lines"), F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"),
        F.col("n_removed").cast("long").alias("n_removed_chunks"), F.col("sizes.m").cast("long").alias("n_removed_lines"), F.col("kept")).alias(name))


#: The same decisions, every chunk grouped by its text.
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS th FROM documents),
l AS (SELECT rid, string_split(text, chr(10)) AS lines FROM d WHERE text IS NOT NULL),
h AS (SELECT rid, lines, list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h FROM l),
e AS (SELECT rid, list_filter(range(1, len(lines) + 1), lambda i: i = len(lines) OR (i >= 2 AND (h[i - 1] * {MULTIPLIER} + h[i]) % {MODULUS} % 3 = 0)) AS ends FROM h),
c AS (SELECT rid, unnest(range(1, len(ends) + 1)) AS pos, ends FROM e),
b AS (SELECT rid, CASE WHEN pos = 1 THEN 1 ELSE ends[pos - 1] + 1 END AS a, ends[pos] AS z FROM c),
s AS (SELECT rid, unnest(list_filter(range(1, len(lines)), lambda i: ((h[i] & {(1 << SHORT) - 1}) & ({(1 << SHORT) - 1} - (h[i + 1] & {(1 << SHORT) - 1}))) <> 0)) AS a FROM h),
p AS (SELECT rid, a, z FROM b WHERE z > a UNION SELECT rid, a, a + 1 FROM s),
k AS (SELECT rid, doc_id, th, a, z, array_to_string(lines[a:z], chr(10)) AS t FROM p JOIN l USING (rid) JOIN d USING (rid)),
f AS (SELECT *, dense_rank() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, th, a) > 1 AS gone FROM k WHERE regexp_matches(t, '[^\x20\x09-\x0D]')),
g AS (SELECT rid, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks FROM f GROUP BY rid),
r AS (SELECT DISTINCT rid, unnest(range(a, z + 1)) AS i FROM f WHERE gone),
x AS (SELECT rid, unnest(lines) AS t, unnest(range(1, len(lines) + 1)) AS i FROM l),
y AS (SELECT x.rid, count(*) AS n_lines, count(r.i) AS n_removed_lines, string_agg(x.t, chr(10) ORDER BY x.i) FILTER (r.i IS NULL) AS kept
  FROM x LEFT JOIN r ON x.rid = r.rid AND x.i = r.i GROUP BY x.rid)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_chunks, 0)::BIGINT AS n_chunks, coalesce(n_removed_chunks, 0)::BIGINT AS n_removed_chunks,
  coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g USING (rid) LEFT JOIN y USING (rid)
"""
