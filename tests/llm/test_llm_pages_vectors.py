"""HTML extraction and embedding groups against brute force, and the pipeline's stages."""

import html as H
import os
import re

import numpy as np
import pytest
from llm_data import documents, like
from pyspark.sql import functions as F

from motifspark.llm import html_consensus, projection_passes

SF = "/root/testdata/sf0.001"


def page(body, cls="content", n=3):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><div class="nav bar"><a href=x>menu {n}</a></div><div class="{cls} post{n}">{body}</div><div id="comments"><p>a reader says</p></div><footer>end</footer></body></html>'


def test_consensus_decides_for_a_page_that_would_choose_otherwise(spark):
    long_box = "<div class='box'><p>" + "an unlabelled box with very many words in it " * 8 + "</p></div>"
    rows = [(i, "https://h.example.com/" + str(i), page(f"<h1>Title {i}</h1><p>" + f"words of page {i} " * 30 + "</p>", n=i)) for i in range(12)]
    odd = page("<p>short article</p>", n=99).replace("<footer>", long_box + "<footer>")
    rows += [(50, "https://H.example.com:8080/odd", odd), (51, "https://lonely.example.com/", odd)]
    got = {r.page_id: r.text for r in html_consensus.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Title 3 " + " ".join(["words of page 3"] * 30)
    assert got[50] == "short article"  # its host says where articles stand
    assert "unlabelled box" in got[51]  # nobody to ask


def test_awkward_pages(spark):
    cases = {
        None: "", "": "", "plain text only": "plain text only",
        "<p>a&nbsp;&lt;b&gt; &amp;amp; <b>c<br>d</b>\n\n e<p>f": "a <b> &amp; c d e f",
        "<article><header><h1>T</h1></header><p>x</p><aside>no</aside><form>no</form><script>if(a<b)'</p>'</script><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>": "T x one two 1 2",
        "<body><p>x<![foo[ bar ]]>y</p>": "xy", "<p>open <b>bold<p>more": "open bold more", "<div hidden>no</div><p>yes": "yes",
        "<nav>only menus</nav>": "", "<p>" + "long " * 50_000: ("long " * 50_000).strip(), "<p style='display: none'>no</p><p role=alert>no</p><p>ok": "ok",
    }
    rows = [(i, None if i % 2 else f"http://host{i}.example.com/", h, "x") for i, h in enumerate(cases)]
    rows += [rows[3], (None, "", "<p>no id", "x")]
    got = html_consensus.extract(spark.createDataFrame(rows, "page_id long, url string, html string, paths string")).collect()
    want = [(i, u, cases.get(h, "no id")) for i, u, h, _ in rows]
    assert like([(r.page_id, r.url, r.text) for r in got]) == like(want)
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_consensus.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrappers_named_like_boilerplate_keep_their_article():
    def text(h):
        return html_consensus.Page(h).text([])

    inner = "<h1>T</h1><p>the article</p><div class=comments><p>a reader</p></div>"
    for wrapper in ("<div class='layout has-sidebar'>", "<div class='post no-comments'>", "<div id='search-results'>", "<form>"):
        assert text(f"<body>{wrapper}<article>{inner}</article><div class=sidebar><article>other</article></div>") == "T the article"
        assert text(f"<body>{wrapper}<div class=body>{inner}</div>") == "T the article"
    assert text("<div class=comments><p>only readers</p></div>") == ""


def test_depth_never_outweighs_text():
    h = "<div class=post><h1>" + "h" * 60 + "</h1><div class=body><p>" + "word " * 1200 + "</p></div></div>"
    best = lambda p: p.name(p.best())
    assert best(html_consensus.Page(h)) == ">div.post"
    assert best(html_consensus.Page(h.replace("<h1>" + "h" * 60 + "</h1>", ""))) == ">div.post>div.body"


def test_classes_are_matched_as_whole_words():
    story = "<p>" + "a sentence of the story. " * 40 + "</p>"
    text = lambda h: html_consensus.Page(h).text()
    assert text(f"<div class='social-science'>{story}</div>").startswith("a sentence")
    assert text(f"<div class='ad-free-story'>{story}</div><div class=small><p>tiny</p></div>").startswith("a sentence")
    assert "related work" in text(f"<article>{story}<section class='related-work'><p>related work</p></section></article>")
    for cls in ("ad", "ads", "ad-banner", "comment-list", "sidebar_left", "cookie-notice-box", "nav-bar x", "widget2"):
        assert "no" not in text(f"<article>{story}<div class='{cls}'><p>no</p></div></article>").split(), cls


def test_a_teaser_is_not_the_article():
    """A host path wins on a page only where it holds most of the running text, or where all pages that have it vote for it."""
    page = html_consensus.Page("<div class=teaser><p>tiny</p></div><div class=story><p>" + "long story " * 70 + "</p></div>")
    number = {page.name(i): html_consensus._signed(p.number) for i, p in enumerate(page.paths)}
    assert page.text([(number[">div.teaser"], False)]).startswith("long story")
    assert page.text([(number[">div.teaser"], False), (number[">div.story"], False)]).startswith("long story")
    assert page.text([(number[">div.teaser"], True)]) == "tiny"


def test_hosts_of_many_templates_and_boilerplate_by_evidence(spark):
    r = np.random.default_rng(8)
    words = lambda n: " ".join("".join(map(chr, r.integers(97, 123, 6))) for _ in range(n))
    rows, want = [], {}
    for t in range(12):  # more templates than a short list would hold
        for i in range(10):
            body = words(60)
            html = (f"<div class=x1><a href=a>{words(2)}</a> <a href=b>{words(2)}</a></div><div class=t{chr(97 + t)}><p>{body}</p><div class=stripe><p>Read our terms before you go on reading, thank you.</p></div>"
                    f"<div class=more><a href=c>{words(3)}</a></div></div>")
            rows.append((len(rows), f"http://many.example.com/{t}/{i}", html))
            want[len(rows) - 1] = body
    got = {x.page_id: x.text for x in html_consensus.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert got == want


def test_deep_pages_take_linear_memory():
    import tracemalloc
    for html in ("<div>" * 50_000 + "x", "<form><div>" * 25_000 + "x", "<ul><li>" * 25_000 + "x", "<blockquote>" * 50_000 + "x" + "</section>" * 50_000):
        tracemalloc.start()
        assert html_consensus.Page(html).text() == "x"
        assert tracemalloc.get_traced_memory()[1] < 150e6
        tracemalloc.stop()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pages_table_equals_brute_force(spark):
    pages = spark.read.parquet(SF + "/pages.parquet")

    def brute(h):
        blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", h, re.S)[1])
        texts = [" ".join(H.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
        return " ".join(t for t in texts if t)

    want = {r.page_id: brute(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in html_consensus.extract(pages).collect()}
    assert got == want


def brute_vectors(rows, least):
    n = len(rows)
    ok = [i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    up, links = list(range(n)), [0] * n

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least - 1e-12:
                    links[i] += 1
                    links[j] += 1
                    up[root(i)] = root(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[root(i)] = min(low.get(root(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], low.get(root(i)), rows[i][0] is not None and rows[i][0] == low.get(root(i))) for i in range(n)]


@pytest.mark.parametrize("window, block", [(64, 1024), (8, 7)])
def test_vector_groups_equal_brute_force(spark, window, block):
    r = np.random.default_rng(3)
    base = r.standard_normal((12, 8))
    rows = [(i, [float(x) for x in (base[r.integers(12)] + r.standard_normal(8) * r.choice([0, 0.05, 0.12, 0.25])).astype(np.float32)]) for i in range(220)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [None] + [1.0] * 7), (1007, [float("inf")] * 8), (5, rows[5][1]), (5, rows[9][1]),
             (None, rows[5][1]), (1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (1008, [1e-30] * 8), (1009, [2e30] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, node int").repartition(4)
    got = projection_passes.near_groups(df, window=window, block=block, passes=24).collect()
    assert like(map(tuple, got)) == like(brute_vectors(rows, 0.95))
    assert projection_passes.near_groups(df.limit(0)).count() == 0


def test_windows_see_across_parts(spark):
    r = np.random.default_rng(4)
    v = r.standard_normal((400, 16))
    rows = [(f"n{i:04d}", [float(x) for x in v[i // 2] + r.standard_normal(16) * 0.02]) for i in range(400)]
    coded = projection_passes.codes(spark.createDataFrame(rows, "node string, vector array<double>"), 6, 1)
    few = {frozenset(x) for x in projection_passes.window_links(coded, 16, 0.95, 1).collect()}
    many = {frozenset(x) for x in projection_passes.window_links(coded, 16, 0.95, 40).collect()}
    want = {frozenset((f"n{2 * i:04d}", f"n{2 * i + 1:04d}")) for i in range(200)}
    assert few == many == want


def dense(n, seed=5):
    """Pairs at cosine 0.955, all of them in one group of mutual cosine 0.8."""
    r = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    middle = unit(r.standard_normal(64))
    one = unit(np.sqrt(0.8) * middle + np.sqrt(0.2) * unit(r.standard_normal((n // 2, 64))))
    away = r.standard_normal((n // 2, 64))
    away = unit(away - (away * one).sum(1, keepdims=True) * one)
    two = 0.955 * one + np.sqrt(1 - 0.955 ** 2) * away
    both = np.concatenate([one, two])
    return [(i, [float(x) for x in v]) for i, v in enumerate(both)]


def test_links_that_few_windows_hold(spark):
    rows = dense(2000)
    x = np.array([v for _, v in rows])
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r.n_links for r in projection_passes.near_groups(df, window=8).collect()}
    assert int(hit.sum()) >= sum(got.values()) >= 0.97 * int(hit.sum())


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_stages_keep_columns_and_take_awkward_rows(spark, tmpdir_path):
    import corpus_pipeline
    docs = documents(spark, 80)
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(tmpdir_path + "/labels.parquet")
    counts = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, tmpdir_path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns, name
        made.write.parquet(f"{tmpdir_path}/{i}")
        docs = spark.read.parquet(f"{tmpdir_path}/{i}")
        counts.append(docs.count())
    assert counts[0] >= counts[2] > 0 and counts[0] == counts[1] and counts[3] == counts[4]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, 10).limit(0), tmpdir_path).count() == 0, name


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline_equals_brute_force(spark):
    """Stage by stage: what each operator's own brute force tests establish, applied to whole tables."""
    import corpus_pipeline
    from test_llm_documents import brute_components, brute_counts, brute_fp
    from tokenizers import Tokenizer

    from motifspark.llm import line_chunks, queries
    docs = spark.read.parquet(SF + "/documents.parquet")
    one = corpus_pipeline.stage_quality(spark, docs, SF)
    left = {r.doc_id for r in one.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(SF + "/labels.parquet").collect()}
    for r in docs.collect():
        n = brute_counts(r.text)
        if n[0] < 50 or 100 * n[4] > 50 * n[0]:
            assert r.doc_id not in left
        elif labels.get(r.doc_id) == 1:
            assert r.doc_id in left  # clean documents stay
    two = corpus_pipeline.stage_lines(spark, one, SF)
    import duckdb
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", [(r.doc_id, r.text) for r in one.collect()])
    want = {r[0]: r[5] for r in c.execute(line_chunks.ORACLE_SQL).fetchall()}
    assert {r.doc_id: r.h for r in two.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("h")).collect()} == want
    assert all(r.n_chars == len(r.text) for r in two.collect())
    rows = sorted(two.collect(), key=lambda r: r.doc_id)
    fps = [brute_fp(r.text) for r in rows]
    roots = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for r, root in zip(rows, roots):
        first.setdefault(root, r.doc_id)
    three = corpus_pipeline.stage_near(spark, two, SF)
    assert sorted(r.doc_id for r in three.collect()) == sorted(first.values())
    four = corpus_pipeline.stage_mix(spark, three, SF)
    copies = {r.doc_id: r["count"] for r in four.groupBy("doc_id").count().collect()}
    assert set(copies) <= set(first.values()) and max(copies.values()) <= 2
    lib = Tokenizer.from_file(queries.tokenizer_file())
    lengths = {r.doc_id: len(lib.encode(r.text, add_special_tokens=False).ids) for r in three.collect()}
    five = corpus_pipeline.stage_tokens(spark, four, SF).collect()
    assert like([(r.doc_id, r.n_tokens) for r in five]) == like([(d, lengths[d]) for d, n in copies.items() for _ in range(n)])
    assert like(map(tuple, corpus_pipeline.run(spark, SF).collect())) == like(map(tuple, five))


@pytest.mark.parametrize("gone", [("motifspark.llm", "corpus_pipeline"), ("regex",), ("xxhash",)])
def test_guard_lets_the_rest_stand_without_this_subpackage(gone):
    """Also where only a module is missing that it imports."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            f"        if name.startswith({gone!r}):\n"
            "            raise ModuleNotFoundError('No module named ' + name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and e.oracle_sql() and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
