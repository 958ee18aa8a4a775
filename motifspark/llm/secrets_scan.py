"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong spans (assignments of secrets, access identifiers, long hex runs) are always reported. Weak candidates
(identifiers, mixed tokens, endpoints) say little alone; each is reported only when the parts that complete it stand
in the same scope (a paragraph) within ``reach`` characters: an identifier near a secret, a token near an identifier,
an endpoint near both. That is an interval join on (document, scope, bin): every span covers the bins it touches, so
a row meets the spans of its own bins only, and semi-joins report no pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import let, materialise


def either_case(text: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in text)


_SET = r"""["']?\x20*[:=]\x20*["']?"""
#: kind -> (pattern, its group that holds the value, least length of it, what the value must also match)
KINDS: dict[str, tuple[str, int, int, tuple[str, ...]]] = {
    "assign": (f"({either_case('password|passwd|secret|token|api_?key')}){_SET}([A-Za-z0-9+/_.=-]+)", 2, 6, ()),
    "access": ("AKIA[A-Z0-9]+", 0, 20, ()),
    "hex": ("[0-9a-f]{24,}", 0, 24, ()),  # runs are maximal, so shorter ones can be passed over at once
    "ident": (f"({either_case('access_?key_?id|client_?id|account_?id|user_?name|user|login')}){_SET}([A-Za-z0-9@._-]+)", 2, 3, ()),
    "blob": ("[A-Za-z0-9+/=_-]{28,}", 0, 28, ("[0-9]", "[a-z]", "[A-Z]")),
    "endpoint": (f"{either_case('http')}[sS]?://[A-Za-z0-9.-]+|(?:{either_case('host|endpoint|server')}){_SET}[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", 0, 8, ()),
}
ORDER = list(KINDS)
STRONG, WEAK = ORDER[:3], ORDER[3:]
IDENTIFIERS, SECRETS = ("access", "ident"), ("assign", "hex", "blob")
#: Scopes end at a blank line; no pattern above crosses one.
SCOPE_END = r"\n[\x20\t\r]*\n"


def running(xs: Column, amount: Callable[[Column], Column], none: str) -> Column:
    """Array of (x, before): each element with the sum of ``amount`` over those before it; ``none``: type of the elements.

    Sums run inside blocks of about the square root of the number of elements, then over the blocks, so appending to
    arrays costs n^1.5 copies and not n^2.
    """
    kind = f"array<struct<x:{none},before:int>>"
    size = lambda p: F.greatest(F.ceil(F.sqrt(F.size(p))).cast("int"), F.lit(1))

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["sum"] + amount(x)).alias("sum"), F.concat(acc["out"], F.array(F.struct(x.alias("x"), acc["sum"].alias("before")))).alias("out"))

    def blocks(p: Column) -> Column:
        n = F.ceil(F.size(p) / size(p)).cast("int")
        block = lambda i: F.aggregate(F.slice(p, i * size(p) + 1, size(p)), F.struct(F.lit(0).alias("sum"), F.expr(f"cast(array() as {kind})").alias("out")), add)
        return F.transform(F.sequence(F.lit(0), n - 1), block)

    def shifted(b: Column) -> Column:
        starts = F.aggregate(b, F.struct(F.lit(0).alias("sum"), F.expr("cast(array() as array<int>)").alias("out")),
                             lambda acc, x: F.struct((acc["sum"] + x["sum"]).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(b, starts, lambda x, s: F.transform(x["out"], lambda y: F.struct(y["x"].alias("x"), (y["before"] + s).alias("before")))))

    return let(xs, lambda p: F.when(F.size(p) > 0, let(blocks(p), shifted)).otherwise(F.expr(f"cast(array() as {kind})")))


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value) of all matches, in characters: lengths of what stands between and of the matches, summed up."""
    between, found, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0), F.regexp_extract_all(text, F.lit(pattern), group)
    steps = let(found, lambda f: F.zip_with(F.slice(between, F.lit(1), F.size(f)), F.zip_with(f, values, lambda m, v: F.struct(F.length(m).alias("n"), v.alias("value"))),
                                            lambda b, m: F.struct(F.length(b).alias("skip"), m["n"].alias("n"), m["value"].alias("value"))))
    summed = running(steps, lambda x: x["skip"] + x["n"], "struct<skip:int,n:int,value:string>")
    start = lambda y: y["before"] + y["x"]["skip"]
    made = F.transform(summed, lambda y: F.struct(start(y).alias("start"), (start(y) + y["x"]["n"]).alias("end"), y["x"]["value"].alias("value")))
    return F.when(text.rlike(pattern), made).otherwise(F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)"))


def of_kind(text: Column, kind: str) -> Column:
    """Array of (start, rank, end) of a kind's matches that pass its checks."""
    pattern, group, least, also = KINDS[kind]

    def passes(x: Column) -> Column:
        ok = F.length(x["value"]) >= least
        for p in also:
            ok = ok & x["value"].rlike(p)
        return ok

    return F.transform(F.filter(spans(text, pattern, group), passes),
                       lambda x: F.struct(x["start"].alias("start"), F.lit(ORDER.index(kind)).alias("rank"), x["end"].alias("end")))


def _written(found: Column) -> Column:
    names = F.array(*map(F.lit, ORDER))
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"])), ",")


def _binned(rows: DataFrame, reach: int, width: int) -> DataFrame:
    low, high = F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") - 1 + reach
    return rows.withColumn("bin", F.explode(F.sequence(F.floor(low / width).cast("int"), F.floor(high / width).cast("int"))))


def _near(weak: DataFrame, parts: DataFrame, reach: int, how: str, width: int = 256) -> DataFrame:
    """Rows of ``weak`` that have (left_semi) or lack (left_anti) a part within ``reach`` characters in their scope."""
    p = _binned(parts, reach, width).select(F.col("id").alias("id2"), F.col("th").alias("th2"), F.col("scope").alias("scope2"), F.col("bin").alias("bin2"),
                                            F.col("start").alias("start2"), F.col("end").alias("end2"))
    on = (F.col("id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2")) & (F.col("scope") == F.col("scope2")) & (F.col("bin") == F.col("bin2"))
          & (F.greatest("start", "start2") - F.least("end", "end2") <= reach - (1 if how == "left_anti" else 0)))
    hit = _binned(weak, 0, width).join(p, on, "left_semi").select(weak.columns).distinct()
    return hit if how == "left_semi" else weak.join(hit.select(*[F.col(c).alias(f"{c}3") for c in weak.columns]),
                                                    F.col("id").eqNullSafe(F.col("id3")) & (F.col("th") == F.col("th3")) & (F.col("start") == F.col("start3"))
                                                    & (F.col("rank") == F.col("rank3")), "left_anti")


def linked(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, start, rank, end) of the weak candidates that are reported; th is the hash of the text."""
    text = F.col("text")
    some = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text")).where(_any(text))
    found = some.select("id", "th", "text", F.concat(*[of_kind(text, k) for k in ORDER]).alias("all")).where(F.exists("all", lambda x: x["rank"] >= len(STRONG)))
    # a part's scope is the number of blank lines before it: a running count over both in one order
    ends = F.transform(spans(text, SCOPE_END), lambda e: F.struct(e["start"].alias("start"), F.lit(-1).alias("rank"), e["end"].alias("end")))
    scoped = running(F.array_sort(F.concat("all", ends)), lambda x: F.when(x["rank"] < 0, F.lit(1)).otherwise(F.lit(0)), "struct<start:int,rank:int,end:int>")
    found = found.select("id", "th", F.filter(scoped, lambda y: y["x"]["rank"] >= 0).alias("all")).distinct()
    found = found.select("id", "th", F.explode("all").alias("y")).select("id", "th", F.col("y.before").alias("scope"), "y.x.start", "y.x.rank", "y.x.end")
    found = materialise(found, "secret_parts")  # read by each of the joins below
    weak, strong = found.where(F.col("rank") >= len(STRONG)), found.where(F.col("rank") < len(STRONG))
    weak = _near(weak, strong, 0, "left_anti")  # part of a strong span already
    parts = strong.unionByName(weak)
    ranks = lambda kinds: F.col("rank").isin([ORDER.index(k) for k in kinds])
    names, keys = parts.where(ranks(IDENTIFIERS)), parts.where(ranks(SECRETS))
    by_key = _near(weak.where(ranks(("ident", "endpoint"))), keys, reach, "left_semi")
    by_name = _near(weak.where(ranks(("blob",))), names, reach, "left_semi")
    both = _near(by_key.where(ranks(("endpoint",))), names, reach, "left_semi")
    return by_key.where(ranks(("ident",))).unionByName(by_name).unionByName(both).drop("scope")


def _any(text: Column) -> Column:
    out = F.lit(False)
    for k in WEAK:
        out = out | text.rlike(KINDS[k][0])
    return out


def scan(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, n_linked, base_sha256, spans (all, by start and kind).

    The strong spans of a row are found in the row; only weak candidates are shuffled, and joined back by id and text
    hash. Null text: no spans. Null ids and repeated rows are scanned like any other. An empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), *[of_kind(text, k).alias(k) for k in STRONG])
    rows = rows.select("id", "th", *[F.size(k).cast("long").alias(f"n_{k}") for k in STRONG], F.concat(*STRONG).alias("strong"))
    extra = linked(docs, reach, id_col, text_col).groupBy(F.col("id").alias("id4"), F.col("th").alias("th4")).agg(
        F.collect_set(F.struct("start", "rank", "end")).alias("weak"))
    out = rows.join(extra, F.col("id").eqNullSafe(F.col("id4")) & (F.col("th") == F.col("th4")), "left")
    weak = F.coalesce("weak", F.expr("cast(array() as array<struct<start:int,rank:int,end:int>>)"))
    return out.select(F.col("id").alias(id_col), *[f"n_{k}" for k in STRONG], F.size(weak).cast("long").alias("n_linked"),
                      F.sha2(_written(F.col("strong")).cast("binary"), 256).alias("base_sha256"), _written(F.concat("strong", weak)).alias("spans"))


def oracle_sql(reach: int = 200) -> str:
    """The same rows with plain list functions and correlated EXISTS."""
    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    def kind(k: str) -> str:
        pattern, group, least, also = KINDS[k]
        checks = f"length(v) >= {least}" + "".join(f" AND regexp_matches(v, {quoted(p)})" for p in also)
        return f"""SELECT rid, {ORDER.index(k)} AS rnk, s AS start_, e AS end_ FROM (SELECT rid, v, s, s + length(m) AS e FROM (
  SELECT rid, ms[i] AS m, vs[i] AS v, (list_sum(list_transform(bs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
  FROM (SELECT rid, bs, ms, vs, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT rid, string_split_regex(t, {quoted(pattern)}) AS bs,
    regexp_extract_all(t, {quoted(pattern)}) AS ms, regexp_extract_all(t, {quoted(pattern)}, {group}) AS vs FROM d)))) WHERE {checks}"""

    near = f"f2.rid = w.rid AND f2.scope = w.scope AND greatest(f2.start_, w.start_) - least(f2.end_, w.end_) <= {reach}"
    has = lambda kinds: f"EXISTS (SELECT 1 FROM ok f2 WHERE {near} AND f2.rnk IN ({', '.join(str(ORDER.index(k)) for k in kinds)}))"
    scopes = f"""SELECT rid, (list_sum(list_transform(bs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
  FROM (SELECT rid, bs, ms, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT rid, string_split_regex(t, {quoted(SCOPE_END)}) AS bs, regexp_extract_all(t, {quoted(SCOPE_END)}) AS ms FROM d))"""
    name = "['" + "', '".join(ORDER) + "']"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(kind(k) for k in ORDER)}),
ends AS ({scopes}),
f AS (SELECT found.*, (SELECT count(*) FROM ends WHERE ends.rid = found.rid AND ends.s < found.start_) AS scope FROM found),
ok AS (SELECT * FROM f WHERE rnk < {len(STRONG)} OR NOT EXISTS (SELECT 1 FROM f f2 WHERE f2.rid = f.rid AND f2.rnk < {len(STRONG)}
    AND greatest(f2.start_, f.start_) < least(f2.end_, f.end_))),
w AS (SELECT * FROM ok w WHERE rnk < {len(STRONG)} OR CASE rnk WHEN {ORDER.index('ident')} THEN {has(SECRETS)} WHEN {ORDER.index('blob')} THEN {has(IDENTIFIERS)}
    ELSE {has(SECRETS)} AND {has(IDENTIFIERS)} END),
g AS (SELECT rid, count(*) FILTER (rnk = 0) AS a, count(*) FILTER (rnk = 1) AS b, count(*) FILTER (rnk = 2) AS c, count(*) FILTER (rnk > 2) AS x,
    string_agg(({name})[rnk + 1] || ':' || start_ || ':' || end_, ',' ORDER BY start_, rnk) FILTER (rnk < 3) AS base,
    string_agg(({name})[rnk + 1] || ':' || start_ || ':' || end_, ',' ORDER BY start_, rnk) AS spans FROM w GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex, coalesce(x, 0)::BIGINT AS n_linked,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)
"""
