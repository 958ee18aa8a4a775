"""Quality rules: a learned decision list over text statistics.

Sequential covering on labelled documents: grow a conjunction of thresholds by information gain on two thirds of
what is left, prune its last conditions on the other third, keep it while it is precise there, take away what it
covers, and go on. The rules are read by people and applied as one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import words

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines", "n_capitals", "n_digits", "n_marks")
#: What the rules may look at: shares, so that a rule means the same for short and long texts.
FEATURES = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
}


def text_counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one whole text; null counts as empty."""
    text = text or ""
    w = words(text)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    triples = list(zip(w, w[1:], w[2:]))
    repeat = 0
    if len(set(triples)) < len(triples):
        often = Counter(triples)
        till = 0  # words before this one are counted
        for i, t in enumerate(triples):
            if often[t] > 1:
                repeat += i + 3 - max(till, i)
                till = i + 3
    lines = text.split("\n")
    wordy = [x for x in lines if x.strip(BLANKS)]
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    capitals = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    digits = int(np.count_nonzero((raw >= 48) & (raw <= 57)))
    return (len(w), word_chars, sum(map(text.count, SYMBOLS)), len(wordy) - len(set(wordy)), repeat, len(set(w)), len(lines), capitals, digits,
            text.count("!") + text.count("?"))


def counted(docs: DataFrame, text_col: str = "text", name: str = "counts") -> DataFrame:
    """``docs`` plus a struct column of the counts; one Arrow pass, no shuffle."""

    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(text: pa.Array) -> pa.Array:
        rows = [text_counts(t.as_py()) for t in text]  # one text at a time
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))], list(COUNTS))

    return docs.withColumn(name, counts.asNondeterministic()(F.col(text_col)))


def feature(name: str, counts: str = "counts") -> Column:
    text = FEATURES[name]
    for c in sorted(COUNTS, key=len, reverse=True):
        text = text.replace(c, f"`{counts}`.{c}")
    return F.expr(text)


def base_failed(counts: str = "counts") -> Column:
    n, repeat = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 50) | (100 * repeat > 50 * n)


@dataclass(frozen=True)
class Rule:
    """All of ``conditions`` (feature, is it at least, threshold) hold; precision and cover are of the pruning part."""

    conditions: tuple[tuple[str, bool, float], ...]
    precision: float
    cover: int

    def column(self, counts: str = "counts") -> Column:
        out = F.lit(True)
        for name, least, value in self.conditions:
            out = out & (feature(name, counts) >= value if least else feature(name, counts) < value)
        return out

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, least, value in self.conditions:
            out &= (x[name] >= value) if least else (x[name] < value)
        return out


def _grow(x: dict[str, np.ndarray], y: np.ndarray, thresholds: int, longest: int) -> list[tuple[str, bool, float]]:
    conditions: list[tuple[str, bool, float]] = []
    inside = np.ones(len(y), bool)
    while len(conditions) < longest and not y[inside].all():
        p0, n0 = int(y[inside].sum()), int((~y[inside]).sum())
        best = None
        for name, values in x.items():
            v = values[inside]
            for cut in _cuts(v, thresholds):
                for least in (True, False):
                    hit = v >= cut if least else v < cut
                    p, n = int(y[inside][hit].sum()), int((~y[inside][hit]).sum())
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        key = (round(float(gain), 9), -len(conditions), name, least, -cut)
                        if gain > 1e-9 and (best is None or key > best[0]):
                            best = (key, (name, least, float(cut)))
        if best is None:
            break
        conditions.append(best[1])
        inside &= Rule((best[1],), 0, 0).holds(x)
    return conditions


def _cuts(v: np.ndarray, thresholds: int) -> np.ndarray:
    """Midpoints between neighbouring distinct values, evenly spread if there are many."""
    u = np.unique(v)
    mid = (u[1:] + u[:-1]) / 2
    return mid if len(mid) <= thresholds else mid[np.linspace(0, len(mid) - 1, thresholds).astype(int)]


def learn(x: dict[str, np.ndarray], y: np.ndarray, fold: np.ndarray, thresholds: int = 64, longest: int = 4, precision: float = 0.9,
          least_cover: int = 2, most_rules: int = 20) -> list[Rule]:
    """The decision list for rejecting (``y`` true). ``fold``: 0 or 1 to grow on, 2 to prune on."""
    rules: list[Rule] = []
    left = np.ones(len(y), bool)
    while len(rules) < most_rules and y[left].any():
        part = {k: v[left] for k, v in x.items()}
        yl, grow = y[left], fold[left] < 2
        if not yl[grow].any():
            break
        conditions = _grow({k: v[grow] for k, v in part.items()}, yl[grow], thresholds, longest)
        held, best = {k: v[~grow] for k, v in part.items()}, None
        for size in range(len(conditions), 0, -1):  # drop last conditions while the pruning part likes it
            rule = Rule(tuple(conditions[:size]), 0, 0)
            hit = rule.holds(held)
            p, n = int(yl[~grow][hit].sum()), int((~yl[~grow][hit]).sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if best is None or worth > best[0] or (worth == best[0] and p >= best[1]):
                best = (worth, p, n, rule)
        if best is None or best[1] < least_cover or best[1] / (best[1] + best[2]) < precision:
            break
        rules.append(Rule(best[3].conditions, best[1] / (best[1] + best[2]), best[1] + best[2]))
        left &= ~rules[-1].holds(x)
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", **how) -> list[Rule]:
    """Learn from at most ``most_labelled`` labelled documents, those with the smallest id hashes.

    An id with several labels counts by its worst; null ids and labels and documents that fail the base rules are left
    out. No label, or labels of one kind only: no rules.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__good"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(most_labelled)
    text = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    joined = counted(text.join(F.broadcast(known), "__id"), "__text")  # broadcast: at most most_labelled rows of two numbers
    rows = (joined.where(~base_failed()).select("__id", "__good", *[feature(f).alias(f) for f in FEATURES])
            .orderBy(F.xxhash64("__id"), "__id", *FEATURES).limit(most_labelled).withColumn("__fold", F.pmod(F.xxhash64(F.lit("fold"), "__id"), F.lit(3)))
            .toPandas())  # bounded by most_labelled
    if not len(rows):
        return []
    return learn({f: rows[f].to_numpy(float) for f in FEATURES}, rows["__good"].to_numpy() == 0, rows["__fold"].to_numpy(), **how)


def verdict(rules: list[Rule], counts: str = "counts") -> Column:
    """Number of the first rule that holds, else 0: the list as one ordered conditional expression."""
    out = F
    for i, r in enumerate(rules, 1):
        out = out.when(r.column(counts), F.lit(i))
    return out.otherwise(F.lit(0)) if rules else F.lit(0)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", name: str = "quality_rules") -> DataFrame:
    """``docs`` plus a struct column ``name``: the counts, base_failed, rule (0: none), kept.

    Null and empty texts have no words and fail the base rules. Each row is judged by itself, whatever its id; an empty
    table gives an empty one.
    """
    out = counted(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), "text")
    out = out.select("row", "counts", base_failed().alias("base_failed"), verdict(rules).alias("rule"))
    return out.select("row.*", F.struct("counts.*", "base_failed", "rule", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept")).alias(name))
