"""Ranked search, whitening and URL filters against brute force, and on awkward rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, documents, rows

from motifspark.llm import ball_tree, url_filter, whitening
from motifspark.llm.queries import URL_RULES


# ranked search

def ranked(docs, items, k=10):
    """Every item against every document, in Python integers."""
    found = [(d, Counter(ball_tree.terms(t)), len(ball_tree.terms(t))) for d, t in docs if ball_tree.terms(t)]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in found:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in ball_tree.terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is not None, d if d is not None else 0))
        out += [(item, i + 1, d if there else None, -s) for i, (s, there, d) in enumerate(sorted(scores)[:k])]
    return out


ITEMS = [(1, "word"), (1, "word"), (2, None), (3, ""), (4, "É漢 😀 nothing"), (None, "abc ab a b c")]


@pytest.mark.parametrize("how", [{}, {"most_terms": 600, "group_dims": 20, "block_rows": 7, "leaf": 2, "ball_dims": 1}, {"block_rows": 50, "leaf": 4, "ball_dims": 5}])
def test_search_equals_brute_force(spark, how):
    docs = rows(150)
    r = random.Random(5)
    items = ITEMS + [(10 + i, " ".join(r.choice(docs)[1].split()[:25]).upper() if i % 2 else " ".join(r.choices(docs[i][1].split(), k=12))) for i in range(20)]
    got = ball_tree.search(documents(spark, 150), spark.createDataFrame(items, "item_id long, text string"), **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(ranked([(x[0], x[1]) for x in docs], items), key=key)


def test_search_of_empty_tables(spark):
    docs, items = documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ball_tree.search(docs.limit(0), items).count() == 0
    assert ball_tree.search(docs, items.limit(0)).count() == 0
    assert ball_tree.search(spark.createDataFrame([(1, None), (2, " -- ")], "doc_id long, text string"), items).count() == 0


def test_bounds_hold_and_prune():
    r = np.random.default_rng(3)
    dense = np.where(r.random((600, 90)) < 0.1, r.integers(1, 2**33, (600, 90)), 0)
    dense[:, 0] += 1
    row, col = np.nonzero(dense)
    ptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=600))])
    queries = r.integers(0, 3, (90, 12)) * (r.random((90, 12)) < 0.1)
    scores = dense @ queries
    for dims in (1, 3, 90):
        tree = ball_tree.BallTree(ptr, col, dense[row, col], 90, leaf=8, ball_dims=dims)
        for edges, bound in zip(tree.edges, tree.bounds(queries.astype(float)), strict=True):
            for i in range(len(edges) - 1):
                below = scores[tree.order[edges[i]:edges[i + 1]]]
                assert (below <= bound[i]).all()
    tree = ball_tree.BallTree(ptr, col, dense[row, col], 90, leaf=8, ball_dims=1)
    bound, visited = tree.bounds(queries.astype(float)), 0
    for q in range(12):
        best = ball_tree.Best(5)
        best.ids = list(range(600))
        visited += tree.search(queries[:, q].copy(), [b[:, q] for b in bound], best)
        best.settle()
        want = sorted((-int(s), i) for i, s in enumerate(scores[:, q]) if s > 0)[:5]
        assert [(s, i) for s, _, i in best.kept] == want
    assert visited < 0.8 * 12 * (len(tree.edges[-1]) - 1)


# whitening

def singular(a):
    s = np.linalg.svd(a, compute_uv=False)
    return np.concatenate([s, np.zeros(a.shape[1] - len(s))])


def shapes():
    r = np.random.default_rng(1)
    q = np.linalg.qr(r.standard_normal((40, 40)))[0]
    return {"random": r.standard_normal((300, 40)), "equal": np.vstack([q] * 3), "clusters": (q * np.repeat([5.0, 1.0], [10, 30])) @ q.T,
            "nearly equal": (q * (1 + 1e-13 * r.standard_normal(40))) @ q.T, "graded": (q * 10.0 ** -np.arange(40)) @ q.T,
            "low rank": r.standard_normal((90, 3)) @ r.standard_normal((3, 40)), "few rows": r.standard_normal((3, 40)), "one column": r.standard_normal((9, 1)),
            "diagonal": np.diag(np.arange(12.0)), "huge": 1e150 * r.standard_normal((50, 8)), "tiny": 1e-150 * r.standard_normal((50, 8))}


@pytest.mark.parametrize("name", list(shapes()))
def test_solver(name):
    a = shapes()[name]
    values, v = whitening.solve(np.linalg.qr(a, mode="r"), 4)
    want = singular(a)
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert len(v) == min(4, int((want > a.shape[1] * np.finfo(float).eps * want[0]).sum()))
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-12
    unit = a / want[0]
    for z, s in zip(v, values / want[0], strict=False):
        assert np.abs(unit.T @ (unit @ z) - s * s * z).max() < 1e-12


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(0.0, 60, 4), 0.3 * 10.0 ** -np.arange(2.0, 58, 4)
    got = whitening.singular_values(a, b)
    assert math.isclose(math.prod(got), math.prod(a), rel_tol=1e-12)  # the determinant has every value in it
    assert got[-1] < 1e-54


def whitened(vectors, k=4):
    """id -> values, by the covariance's eigenvectors."""
    out, by_len = [], {}
    for i, v in vectors:
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            by_len.setdefault(len(v), []).append((i, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    for d, rows_ in by_len.items():
        fit = np.array(sorted({x for _, x in rows_}))
        n, s = len(fit), fit.sum(0)
        y = (n * fit - s) / n
        e, u = np.linalg.eigh(y.T @ y / n)
        e, u = e[::-1], u[:, ::-1]
        for i, x in rows_:
            dev = sum((n * int(c) - int(t)) ** 2 for c, t in zip(x, s, strict=True))
            for c in range(min(k, d)):
                if e[c] > 1e-9 * max(e[0], 1e-300) and e[0] > 0:
                    out.append((i, c + 1, n, dev, abs((np.array(x) - s / n) @ u[:, c]) / math.sqrt(e[c]), e[c] / e.sum()))
    return out


def vectors(seed=2):
    r = np.random.default_rng(seed)
    base = [[float(np.float32(c)) for c in v] for v in r.standard_normal((120, 6)) * [9, 5, 3, 2, 1, 0.5]]
    out = [(i, v) for i, v in enumerate(base)]
    out += [(200 + i, base[0]) for i in range(60)] + [(0, base[1]), (None, base[2]), (300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (302, [float("nan")] * 6),
            (303, [float("inf")] + [0.0] * 5), (304, []), (305, [-0.0] * 6), (306, [1.0, 2.0]), (307, [1.5, -2.0]), (308, [0.25, 9.0]), (309, [7.0]), (310, [7.0])]
    return out


def test_whitening_equals_brute_force(spark):
    data = vectors()
    df = spark.createDataFrame([(i, v, "a", 1, 2.0) for i, v in data], "vec_id long, embedding array<float>, x string, n int, whitened double").repartition(7)
    got = whitening.whiten(df).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3], round(abs(r[4]), 5))
    got_rows, want = sorted(((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got), key=key), sorted(whitened(data), key=key)
    assert [g[:4] for g in got_rows] == [w[:4] for w in want]
    assert np.allclose([abs(g[4]) for g in got_rows], [w[4] for w in want], rtol=1e-8, atol=1e-8)
    assert np.allclose([g[5] for g in got_rows], [w[5] for w in want], rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)
    again = whitening.whiten(df.repartition(3)).collect()  # signs stay
    assert np.allclose(sorted(r.whitened for r in got), sorted(r.whitened for r in again), atol=1e-9)


def test_whitening_of_empty_huge_and_constant_tables(spark):
    kinds = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kinds)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kinds)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [3.0, 4.0]), (2, [3.0, 4.0])], kinds)).count() == 0
    big = whitening.whiten(spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 5e14]), (4, [1e300, 1.0])], kinds)).collect()
    assert {r.vec_id for r in big} == {1, 2, 3} and all(r.deviation is None and r.identity_error < 1e-9 for r in big)


# URL filters

PAGES = [(1, "https://WWW.Example.com/en/1"), (2, "http://m.example.com/en/x?q=/es/"), (3, "http://example.com/fr/"), (4, "http://a.net/es/"), (5, "http://a.net/esx/"), (6, "http://net/fr/"),
         (7, "http://notnet.org"), (8, None), (9, ""), (10, "no scheme/es/"), (11, "x://y://z/w"), (12, "http://b.com?x"), (13, "http://b.com#/en/"), (14, "http://xexample.com/en/"),
         (15, "http://a.net:80/es/"), (16, "http://É漢.org/Pfad"), (None, "http://b.org/"), (17, "http://b.org/"), (17, "http://b.org/"), (18, "http://c.org/" + "longname" * 1000)]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in PAGES], "page_id long, url string, host string, path string")
    got = {r.page_id: r for r in url_filter.judge(pages, documents(spark), URL_RULES).collect()}

    def plain(url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
            path = rest[end:].split("?")[0].split("#")[0]
        fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        return host, path, best and best[0] + best[1], best[2] if best else "allow"

    for i, u in PAGES:
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == plain(u), u
    assert url_filter.judge(pages, documents(spark), URL_RULES).count() == len(PAGES)
    assert url_filter.judge(pages.limit(0), documents(spark), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, documents(spark).limit(0), [], blocked=()).collect()} == {"allow"}


def split_all_ways(part, counts, total):
    """Every split of a short part; the best by the same probabilities."""
    best = None
    for mask in range(1 << (len(part) - 1)):
        words, start = [], 0
        for i in range(1, len(part) + 1):
            if i == len(part) or mask >> (i - 1) & 1:
                words.append(part[start:i])
                start = i
        score = sum(max(math.log(counts[w]) if w in counts else -math.inf, -math.log(10) * len(w)) - math.log(total) for w in words)
        key = (round(score, 9), -len(words))
        if best is None or key > best[0]:
            best = (key, [words])
        elif key == best[0]:
            best[1].append(words)
    return best[1]


def test_segmentation_equals_all_splits(spark):
    r = random.Random(4)
    counts = {"".join(r.choice("abc") for _ in range(r.randint(1, 4))): r.randint(1, 900) for _ in range(40)} | {"cheap": 50, "pills": 9, "ch": 70}
    parts = ["cheappills", "x", "zzzabc"] + ["".join(r.choice("abcz") for _ in range(r.randint(1, 10))) for _ in range(30)]
    got = url_filter.segment(spark.createDataFrame([(p,) for p in set(parts)], "part string"), spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert len(got) == len(set(parts))
    for row in got:
        assert row.words in split_all_ways(row.part, counts, sum(counts.values())), row
    assert {r.part: r.words for r in got}["cheappills"] == ["cheap", "pills"]


def test_held_out_hosts(spark):
    """Hosts of held-out words, concatenated: what the method never saw as a whole is judged by its words."""
    r = random.Random(6)
    bad, beside, clean = ["casino", "pills", "bets", "poker", "xxx"], ["cheap", "win", "free", "lucky", "bonus", "hot"], ["garden", "school", "music", "river", "news", "travel", "kitchen", "history"]
    train = [f"http://{r.choice(beside)}-{r.choice(bad)}.org/en/{i}" for i in range(60)] + [f"http://{r.choice(clean)}-{r.choice(clean)}.org/en/{i}" for i in range(400)]
    train += [f"http://{r.choice(clean)}{r.choice(clean)}.org/{r.choice(clean)}" for _ in range(200)]
    held = [(f"http://{a}{b}.org/en/", "block") for a in beside for b in bad] + [(f"http://{a}{b}.info/", "block") for a in beside for b in beside if a != b]
    held += [(f"http://{a}{b}{c}.org/", "allow") for a in clean for b in clean for c in clean[:2]] + [(f"http://unseen{a}.org/", "allow") for a in clean]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(train + [u for u, _ in held])], "page_id long, url string")
    docs = spark.createDataFrame([(i, " ".join(r.choices(beside + clean + ["the", "and", "of"], k=200))) for i in range(30)], "doc_id long, text string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, docs, []).collect()}
    right = sum(got[len(train) + i] == v for i, (_, v) in enumerate(held))
    assert right / len(held) > 0.9
    assert all(got[i] == "block" for i in range(60)) and all(got[i] == "allow" for i in range(60, len(train)))


def test_schema_clashes(spark):
    """Columns of the input that share names with the operators' own."""
    assert {"source", "u", "key", "row"} < {c.split()[0] for c in SCHEMA.split(", ")}
    items = spark.createDataFrame([(1, "a b", 2, 3)], "item_id long, text string, rank int, score int")
    assert ball_tree.search(documents(spark), items).columns == ["item_id", "rank", "doc_id", "score"]
