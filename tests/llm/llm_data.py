"""Awkward rows that every operator on documents must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, source string, lang string, size long, u double, fp long, kept boolean, counts string, gone int, "
          "line_dedup string, quality_rules string, copies int, key string, row string")


def rows(n=60, seed=1):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    lines = [" ".join(r.choice(vocab) for _ in range(r.randint(2, 14))) for _ in range(80)]
    out = []
    for i in range(n):
        text = "\n".join(r.choice(lines) for _ in range(r.randint(1, 30)))
        out.append((i, text, r.choice(["a", "b", "c", None]), r.choice(["en", None])))
    block = "\n".join(lines[:12])
    out += [(100, None, "a", "en"), (None, out[3][1], None, None), (101, "", "b", None), (102, " \t\n\x0b", "b", "en"), (103, out[5][1], "a", "en"),
            (7, out[7][1], out[7][2], out[7][3]), (7, out[9][1], "z", "en"), (104, "word " * 30_000, "c", "en"), (105, block + "\n" + out[2][1], "c", "en"),
            (106, out[4][1] + "\n" + block, "c", "en"), (107, "x" * 5000, "d", "en"), (None, None, None, None), (108, "#*$ é漢 😀 !!", "", "")]
    return [(*x, 5, 0.5, 1, True, "c", 2, "l", "q", 3, "k", "r") for x in out]


def documents(spark, n=60, seed=1):
    return spark.createDataFrame(rows(n, seed), SCHEMA).repartition(5)


def like(got):
    """Rows in an order that takes nulls."""
    return sorted(map(repr, got))
