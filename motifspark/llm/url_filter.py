"""URL filters: rules first; where none fits, the words of the host and the path decide.

Concatenated names (``cheappillsonline``) are split into words by unigram Viterbi with word counts of the whole corpus;
a multinomial naive Bayes model over the words of hosts and paths scores what the rules leave open. It learns from the
table of URLs itself: a host with a known bad word as a part of its own (``cheap-pills``, ``pills.shop``) is an example
of the class to block, a host whose split names hold none of them one of the class to allow, and the words that
stand beside the known ones carry the verdict to hosts that have none of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import materialise

#: Parts of names that mark a host as an example to block.
BLOCKED_WORDS = tuple("""adult ads adserver bet bets betting casino casinos cialis escort escorts gambling jackpot malware
    nude phishing pill pills poker porn porno pornhub roulette scam sex sexy slots spam torrent torrents viagra warez
    xxx""".split())
#: A part of a name: letters of any alphabet. Digits and marks separate parts.
PART = r"\p{L}+"
LONGEST = 24

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
Rule = tuple[str, str, str]  # host, path, allow or block


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_verdict(rules: list[Rule], host_: Column, path_: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; equally long ones in the order given."""
    rules = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    out = F
    for h, p, verdict in rules:
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        out = out.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    return out.otherwise(F.lit(None)) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over every whole text: runs of letters, A-Z lower-cased, of at most ``LONGEST`` letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0):
                if text.is_valid:
                    found.update(text.as_py().encode("utf-8", "surrogatepass").translate(_FOLD).split())
            words = {w: n for raw, n in found.items() if len(raw) <= 4 * LONGEST and len(w := raw.decode("utf-8", "replace")) <= LONGEST}
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(part: str, found: list[tuple[int, int, int]], total: int) -> list[str]:
    """The most probable split of ``part``; ``found``: (start, length, count) of the known words in it.

    A letter that no known word covers joins an unknown word; unknown words get ten times less likely by the letter.
    Equal splits: the fewest words, then the longest last word.
    """
    size = len(part)
    known: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    for start, length, n in found:
        if 0 < length <= size - start:
            known[start + length].append((start, n))
    log_total = math.log(max(total, 2))
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)] + [(-math.inf, 0, 0)] * size  # score, minus words, start of the last word
    for end in range(1, size + 1):
        options = [(best[s][0] + math.log(n) - log_total, best[s][1] - 1, s) for s, n in known[end]]
        options += [(best[s][0] - log_total - math.log(10) * (end - s), best[s][1] - 1, s) for s in range(max(0, end - LONGEST), end)]
        best[end] = max(options, key=lambda o: (round(o[0], 9), o[1], -o[2]))
    out, end = [], size
    while end:
        out.append(part[best[end][2]:end])
        end = best[end][2]
    return out[::-1]


def segment(parts: DataFrame, unigrams: DataFrame) -> DataFrame:
    """Distinct (part) -> (part, words): split by unigram Viterbi.

    Each part is joined with the corpus by its substrings of up to ``LONGEST`` letters, so no word list is held
    anywhere: a task sees the words of its own parts only.
    """
    total = unigrams.agg(F.sum("n")).first()[0] or 0
    size = F.char_length("part")
    spans = F.flatten(F.transform(F.sequence(F.lit(0), size - 1), lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), size - s)), lambda k: F.struct(s.alias("s"), k.alias("k")))))
    cut = parts.select("part", F.explode(spans).alias("at")).select("part", F.col("at.s").alias("s"), F.col("at.k").alias("k"),
                                                                   F.substring("part", F.col("at.s") + 1, F.col("at.k")).alias("word"))
    known = cut.join(unigrams, "word").groupBy("part").agg(F.collect_list(F.struct("s", "k", "n")).alias("found"))
    both = parts.join(known, "part", "left").select("part", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [viterbi(p, [(f["s"], f["k"], f["n"]) for f in found or []], total)
                     for p, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["part", "words"])

    return both.mapInArrow(run, "part string, words array<string>")


def parts_of(column: Column) -> Column:
    return F.regexp_extract_all(F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(PART), 0)


def naive_bayes(counts: DataFrame, strength: float = 50.0) -> DataFrame:
    """(word, n_block, n_allow) -> (word, odds): log odds of the class to block.

    Each class is smoothed towards the words' own shares of all counts with the weight of ``strength`` words, so a word seen once among
    many allowed hosts isn't evidence against it merely because the class to block is smaller.
    """
    n_block, n_allow = (int(x or 0) for x in counts.agg(F.sum("n_block"), F.sum("n_allow")).first())
    if not n_block or not n_allow:
        return counts.select("word", F.lit(0.0).alias("odds"))
    share = strength * (F.col("n_block") + F.col("n_allow")) / float(n_block + n_allow)
    return counts.select("word", (F.log((F.col("n_block") + share) / (n_block + strength)) - F.log((F.col("n_allow") + share) / (n_allow + strength))).alias("odds"))


def judge(pages: DataFrame, docs: DataFrame, rules: list[Rule], blocked: tuple[str, ...] = BLOCKED_WORDS, most_rules: int = 1000,
          id_col: str = "page_id", url_col: str = "url", text_col: str = "text") -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits), verdict (allow or block), odds (of the method, for every page).

    Null urls and urls without ``://`` have an empty host and path; without any word the prior decides, and that allows
    unless most examples are to block. Without examples of both classes the method allows. Words of the host's last
    label (com, net) aren't scored, nor are words outside all examples. Repeated rows and null ids each give their
    row; other columns are not read; an empty table gives an empty one. ``docs`` gives the word counts; null texts and
    an empty table have none, then only the parts of the urls themselves are words.

    Pages are reduced to distinct urls first (in each task, then by shuffle); parts of names, their words and
    odds are joined by shuffles on distinct parts, words and urls. A part in a third of all urls meets one row there,
    which Spark splits over tasks as a skewed join. Rules, at most ``most_rules``, are one conditional expression.
    """
    if len(rules) > most_rules:
        raise ValueError(f"more than {most_rules} rules")
    rows = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    urls = rows.select("host", "path").distinct()
    named = F.regexp_replace(F.regexp_replace("host", r"(:[0-9]*)?\.?$", ""), r"\.[^.]*$", "")  # without port and last label
    urls = materialise(urls.select("host", "path", parts_of(named).alias("names"), parts_of(F.col("path")).alias("steps"),
                                   F.filter(F.split(F.concat(named, F.lit("/"), F.col("path")), "[./]"), lambda x: F.size(parts_of(x)) > 1).alias("compound")), "urls")

    # words: those of the corpus, and what stands between marks or digits within a name; these are at least as frequent as 1 in a million
    corpus = materialise(word_counts(docs, text_col), "word_counts")
    least = F.lit(max(1, (corpus.agg(F.sum("n")).first()[0] or 0) // 1_000_000))
    own = urls.select(F.explode(F.array_distinct("compound")).alias("c")).distinct().select(F.explode(parts_of(F.col("c"))).alias("word"))
    if blocked:
        own = own.unionAll(docs.sparkSession.createDataFrame([(w,) for w in blocked], "word string"))
    own = own.where(F.char_length("word") <= LONGEST).groupBy("word").agg(F.greatest(F.count(F.lit(1)), least).alias("n"))
    unigrams = materialise(corpus.unionAll(own).groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    parts = urls.select(F.explode(F.concat("names", "steps")).alias("part")).distinct()
    words = materialise(segment(parts, unigrams).select("part", F.explode("words").alias("word")), "url_words")

    # examples: hosts with a blocked word as a part of its own; hosts that spell one inside a part are no example of either class
    hit = F.arrays_overlap("names", F.array(*[F.lit(w) for w in blocked])) if blocked else F.lit(False)
    spelled = words.where(F.col("word").isin(*blocked)).select("part").distinct()
    spelled = urls.select("host", F.explode("names").alias("part")).distinct().join(spelled, "part", "left_semi").select(F.col("host").alias("host2")).distinct()
    urls = urls.join(spelled, F.col("host") == F.col("host2"), "left").select(
        "host", "path", F.concat("names", "steps").alias("parts"), hit.alias("bad"), (F.col("host2").isNull()).alias("good"))
    urls = materialise(urls, "labelled_urls")
    per_part = urls.select(F.explode("parts").alias("part"), "bad", "good").groupBy("part").agg(
        F.count(F.when(F.col("bad"), True)).alias("n_block"), F.count(F.when(F.col("good"), True)).alias("n_allow"))
    counts = words.join(per_part, "part").groupBy("word").agg(F.sum("n_block").alias("n_block"), F.sum("n_allow").alias("n_allow"))
    model = naive_bayes(materialise(counts, "url_counts"))
    odds = words.join(model, "word").groupBy("part").agg(F.sum("odds").alias("odds"))
    n_bad, n_good = urls.agg(F.count(F.when(F.col("bad"), True)), F.count(F.when(F.col("good"), True))).first()
    known = n_bad > 0 and n_good > 0
    prior = math.log(n_bad / n_good) if known else 0.0
    scored = (urls.select("host", "path", F.explode("parts").alias("part")).join(odds, "part").groupBy("host", "path").agg(F.sum("odds").alias("odds")))
    scored = materialise(scored.withColumnsRenamed({"host": "host2", "path": "path2"}), "url_odds")

    out = rows.join(scored, (F.col("host") == F.col("host2")) & (F.col("path") == F.col("path2")), "left")
    total = F.round(F.coalesce("odds", F.lit(0.0)) + prior, 6)
    out = out.select("id", "host", "path", total.alias("odds"), rule_verdict(rules, F.col("host"), F.col("path")).alias("by_rule"))
    learned = F.when((F.col("odds") > 0) if known else F.lit(False), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("by_rule.rule").alias("rule"), F.coalesce("by_rule.verdict", learned).alias("verdict"), "odds")
