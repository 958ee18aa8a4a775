"""Main text of web pages by consensus of each host's pages.

Every page scores its containers (elements that hold blocks of text) by how much of the page's running text they
cover, how little link and boilerplate text they hold, and whether their tag says what they are. It votes for the
generalised tag-class path (digits become ``#``, ids are dropped) of its best one; votes, and scores to break ties, are
summed per host in Spark, along with what the host's pages tell about each path: on how many pages it stands, how much
of it is links, and on how many of them it says the very same. Then each page is read again. Paths whose text repeats
from page to page, or is links, are boilerplate there. A page's main container is its host's best voted path that holds
most of the page's running text, or that nearly all pages which have it vote for; a page with none uses its own best.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import materialise

#: Fixed values of HTML: what has no end tag, what only marks text up, what is a block but no container of its own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
BLOCKS = frozenset("address blockquote caption center dd dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre table tbody td tfoot th thead tr ul".split())
#: Never part of the article.
DROPPED = frozenset("head script style noscript template nav footer aside form button select textarea option iframe object svg math canvas audio video map dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
DROPPED_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie
    cookies disqus footer login menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted
    related replies search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget""".split())
#: Parts of a class or id that say where or how big an element is; a compound of dropped words and these is dropped, any other word keeps it.
PLACE_WORDS = frozenset("""area bar block body bottom box button buttons card col column container content fixed global group header heading inner item items
    left link links list main mobile outer page panel post posts right row section site slot sticky text title top unit wrap wrapper""".split())
#: An open element of these ends when one of its kind, or what stands on the right, begins.
CLOSES = {"p": BLOCKS - {"figcaption"} | {"div", "article", "section", "main", "header", "footer", "nav", "aside", "form"}, "li": {"li"}, "dd": {"dd", "dt"},
          "dt": {"dd", "dt"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}, "head": {"body", "div", "article", "nav", "p", "h1"}}
#: Words before these say what a page has or lacks, not what the element is.
STATE = re.compile(r"^(?:no|has|with|without)[-_]")


@lru_cache(100_000)
def names_boilerplate(token: str) -> bool:
    """Whether a whole class or id token names boilerplate: a dropped word, alone or with words of place and size."""
    words = [w for w in re.split(r"[-_\d]+", token) if w]
    return not STATE.match(token) and any(w in DROPPED_WORDS for w in words) and all(w in DROPPED_WORDS or w in PLACE_WORDS for w in words)


@dataclass(slots=True)
class Path:
    """A generalised tag-class path of a page; its number is the same on every page."""

    number: int
    up: int  # index of the path above
    label: str
    depth: int
    running: int = 0  # characters of its own blocks: kept ones outside links,
    linked: int = 0  # in links,
    chars: int = 0  # all
    good: int = 0  # running and all characters of it and what is below
    all: int = 0


class Page(HTMLParser):
    """Blocks of a page in order: (index of the container's path, text, characters in links, dropped).

    What is dropped by class or id words or as a form (a soft drop) is taken back where it holds all articles of a page
    (or, without any, all its main headings), or where it holds containers and the page would be left empty. Memory is
    linear in the page: paths and drops are numbered and point to those around them.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.paths = [Path(0, -1, "", 0)]
        self.by_label: dict[tuple[int, str], int] = {}
        self.stack: list[tuple[str, int, bool, int]] = [("", 0, False, -1)]  # tag, path, dropped for good, innermost soft drop around
        self.open: Counter = Counter()
        self.soft: list[int] = []  # of each block
        self.soft_up: list[int] = []  # the soft drop around each soft drop
        self.wraps: set[int] = set()  # soft drops with containers in them
        self.heads: dict[bool, list[int]] = {True: [], False: []}  # soft drops around articles, and around main headings
        self.parts: list[str] = []
        self.linked, self.in_link = 0, False
        try:
            self.feed(html)
            self.close()
        except AssertionError:  # the library refuses some marked sections; browsers take them for comments
            self.__init__(re.sub(r"<!\[[^>]*>?", "", html))
            return
        self.flush()
        self.settle()
        self.weigh()

    def around(self, soft: int) -> Iterator[int]:
        while soft >= 0:
            yield soft
            soft = self.soft_up[soft]

    def settle(self) -> None:
        heads = self.heads[True] or self.heads[False]
        depth = [0] * len(self.soft_up)
        for i, up in enumerate(self.soft_up):  # those around come first
            depth[i] = 1 + (depth[up] if up >= 0 else 0)
        lifted = set(self.around(min(heads, key=lambda s: depth[s] if s >= 0 else 0, default=-1)))
        kept = lambda soft: soft < 0 or soft in lifted  # noqa: E731  (drops around a lifted one are lifted)
        if not any(not dropped and kept(soft) for (*_, dropped), soft in zip(self.blocks, self.soft, strict=True)):
            for s in self.wraps:
                for x in self.around(s):
                    if x in lifted:
                        break
                    lifted.add(x)
        self.blocks = [(p, t, n, dropped or not kept(soft)) for (p, t, n, dropped), soft in zip(self.blocks, self.soft, strict=True)]

    def weigh(self) -> None:
        for p, text, linked, dropped in self.blocks:
            path = self.paths[p]
            path.running += 0 if dropped else len(text) - linked
            path.linked += linked
            path.chars += len(text)
        for path in self.paths:
            path.good, path.all = path.running, path.chars
        for path in reversed(self.paths[1:]):  # paths above come first
            self.paths[path.up].good += path.good
            self.paths[path.up].all += path.all

    def said(self) -> list[int]:
        """A hash of each path's own blocks' texts."""
        out = [0] * len(self.paths)
        for p, text, _, _ in self.blocks:
            out[p] = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), out[p])
        return out

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, path, dropped, soft = self.stack[-1]
            self.blocks.append((path, text, min(self.linked, len(text)), dropped))
            self.soft.append(soft)
        self.parts.clear()
        self.linked = 0

    def cut(self, i: int) -> None:
        for tag, *_ in self.stack[i:]:
            self.open[tag] -= 1
        del self.stack[i:]

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][2] or not self.stack[-1][0] in ("script", "style"):
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            return
        if not attrs and tag in INLINE:
            self.in_link = self.in_link or tag == "a"
            return
        own = dict(attrs)
        never = tag in ("html", "body", "article", "main")
        soft = hard = False
        if not never:
            hard = tag in DROPPED and tag != "form" or tag == "header" and not (self.open["article"] or self.open["main"])
            soft = tag == "form"
            if own:
                hard = (hard or own.get("role") in DROPPED_ROLES or "hidden" in own or own.get("aria-hidden") == "true"
                        or "display:none" in (own.get("style") or "").replace(" ", "").lower())
                soft = soft or any(map(names_boilerplate, f"{own.get('class') or ''} {own.get('id') or ''}".lower().split()))
        if tag in INLINE and not (soft or hard):
            self.in_link = self.in_link or tag == "a"
            return
        self.flush()
        self.in_link = False
        if any(self.open[t] for t in _CLOSED_BY.get(tag, ())):
            for i in range(len(self.stack) - 1, 0, -1):  # ends that are left out
                open_tag = self.stack[i][0]
                if tag in CLOSES.get(open_tag, ()):
                    self.cut(i)
                    break
                if open_tag not in BLOCKS and open_tag not in INLINE and open_tag not in CLOSES:
                    break
        _, path, inside, around = self.stack[-1]
        if tag not in BLOCKS and tag not in INLINE:
            classes = ".".join(sorted({re.sub(r"\d+", "#", c) for c in (own.get("class") or "").lower().split()}))
            path = self.below(path, f"{tag}.{classes}" if classes else tag)
            if around >= 0:
                self.wraps.add(around)
        if soft:
            self.soft_up.append(around)
            around = len(self.soft_up) - 1
        if tag in ("article", "main", "h1") and not (inside or hard):
            self.heads[tag != "h1"].append(around)
        self.stack.append((tag, path, inside or hard, around))
        self.open[tag] += 1

    def below(self, up: int, label: str) -> int:
        at = self.by_label.get((up, label))
        if at is None:
            at = self.by_label[up, label] = len(self.paths)
            above = self.paths[up]
            self.paths.append(Path(xxhash.xxh64_intdigest(label.encode("utf-8", "surrogatepass"), above.number), up, label, above.depth + 1))
        return at

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "iframe", "script"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE and not any(s[0] == tag for s in self.stack[-3:]):
            if tag == "a":
                self.in_link = False
            return
        self.flush()
        self.in_link = False
        if self.open[tag]:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == tag:
                    self.cut(i)
                    break

    def score(self, p: Path) -> float:
        """Covered share x purity, and a little for a telling tag."""
        return p.good / max(self.paths[0].good, 1) * (p.good / max(p.all, 1)) + 0.25 * (p.label.split(".")[0] in ("article", "main"))

    def best(self) -> int:
        """Index of the page's own best container; 0, the whole page, if nothing has running text. Depth only breaks ties."""
        some = [i for i, p in enumerate(self.paths) if p.good > 0 and i > 0]
        return max(some, key=lambda i: (round(self.score(self.paths[i]), 9), self.paths[i].depth, self.paths[i].number), default=0)

    def name(self, i: int) -> str:
        out = ""
        while i > 0:
            out, i = f">{self.paths[i].label}{out}", self.paths[i].up
        return out

    def text(self, ranked: list[tuple[int, bool]] = (), boilerplate: set[int] = frozenset()) -> str:
        """Kept blocks of the main container. ``ranked``: (number, whether nearly all pages that have it vote for it) of the host's paths."""
        out = [False] * len(self.paths)  # below a path that is boilerplate on this host
        if boilerplate:
            for i, p in enumerate(self.paths[1:], 1):
                out[i] = out[p.up] or _signed(p.number) in boilerplate
            if not any(p.running and not o for p, o in zip(self.paths, out, strict=True)):
                out = [False] * len(self.paths)
        good = [0 if o else p.running for p, o in zip(self.paths, out, strict=True)]
        for i in range(len(good) - 1, 0, -1):
            good[self.paths[i].up] += good[i]
        at = {_signed(p.number): i for i, p in enumerate(self.paths) if good[i] > 0}
        best = next((at[n] for n, sure in ranked if n in at and (sure or 2 * good[at[n]] > good[0])), None)
        if best is None:
            best = self.best()
        inside = [False] * len(self.paths)
        inside[best] = True
        for i, p in enumerate(self.paths[1:], 1):
            inside[i] = inside[i] or inside[p.up]
        return " ".join([t for p, t, _, dropped in self.blocks if inside[p] and not dropped and not out[p]])


_CLOSED_BY: dict[str, list[str]] = {}
for _open, _tags in CLOSES.items():
    for _tag in _tags:
        _CLOSED_BY.setdefault(_tag, []).append(_open)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def host(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = 0.01, sure: float = 0.8, pages_least: int = 5) -> DataFrame:
    """(host, paths, boilerplate): what the pages of a host agree on.

    ``paths``: array of (path, sure), best voted first, of the paths that at least ``share`` of the host's pages vote
    for (so there are at most 1 / ``share``); sure if at least ``sure`` of the pages with text in it, and three, do.
    ``boilerplate``: paths on at least ``pages_least`` and ``share`` of the pages that hold little of the running text
    (under 30 %) and either say the very same on half of the pages that have them or consist of links to four fifths.

    One row per path and page is summed up in each task first, then by (host, path, what it says), then by (host,
    path): neither a host with a third of all pages nor a text on all of them is a large group.
    """
    head = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    sums = ("votes", "score", "pages", "present", "chars", "linked", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, int, int], list[int]] = {}
            for h, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = Page(html.as_py() or "")
                best, total = page.best(), max(page.paths[0].good, 1)
                for i, (p, said) in enumerate(zip(page.paths, page.said(), strict=True)):
                    v = votes.setdefault((h, _signed(p.number), _signed(said)), [0] * len(sums))
                    # whole numbers add up alike in any order
                    for k, x in enumerate((i == best and i > 0, round(page.score(p) * 1e6) if p.good else 0, 1, p.good > 0, p.chars, p.linked, p.good * 1000 // total)):
                        v[k] += int(x)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], pa.string()), *(pa.array([k[i] for k in votes], pa.int64()) for i in (1, 2)),
                                              *(pa.array([v[i] for v in votes.values()], pa.int64()) for i in range(len(sums)))], ["host", "path", "said", *sums])

    found = head.mapInArrow(run, "host string, path long, said long, " + ", ".join(f"{c} long" for c in sums))
    added = [F.sum(c).alias(c) for c in sums]
    found = found.groupBy("host", "path", "said").agg(*added).groupBy("host", "path").agg(*added, F.max(F.when(F.col("chars") > 0, F.col("pages"))).alias("alike"))
    found = materialise(found, "path_votes")
    hosts = found.where("path = 0").select(F.col("host").alias("host2"), F.col("pages").alias("n"))  # the whole page is on every page
    found = found.where("path <> 0").join(hosts, F.col("host") == F.col("host2"))
    voted = (F.col("votes") > 0) & (F.col("votes") >= share * F.col("n"))
    dull = ((F.col("pages") >= pages_least) & (F.col("pages") >= share * F.col("n")) & (F.col("part") < 300 * F.col("pages")) & (F.col("chars") > 0)
            & ((2 * F.col("alike") > F.col("pages")) | (5 * F.col("linked") >= 4 * F.col("chars"))))
    entry = F.struct((-F.col("votes")).alias("votes"), (-F.col("score")).alias("score"), "path", ((F.col("votes") >= sure * F.col("present")) & (F.col("votes") >= 3)).alias("sure"))
    found = found.where(voted | dull).groupBy("host").agg(F.array_sort(F.collect_list(F.when(voted, entry))).alias("p"), F.collect_list(F.when(dull & ~voted, F.col("path"))).alias("boilerplate"))
    return found.select("host", F.transform("p", lambda x: F.struct(x["path"].alias("path"), x["sure"].alias("sure"))).alias("paths"), "boilerplate")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_hosts: int = 100_000) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    Null or empty html gives an empty text, as does a page that is boilerplate only. A null or odd url belongs to the
    host without name. Repeated rows and ids each give their row; other columns are not read; an empty table gives an
    empty one. The table of host paths is broadcast up to ``broadcast_hosts`` rows and joined by shuffle beyond it.
    """
    voted = materialise(host_paths(pages, url_col, html_col).withColumnRenamed("host", "host2"), "host_paths")
    voted = F.broadcast(voted) if voted.count() <= broadcast_hosts else voted
    head = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))
    joined = head.join(voted, F.col("host") == F.col("host2"), "left").select("id", "url", "html", "paths", "boilerplate")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h.as_py() or "").text([(x["path"], x["sure"]) for x in p.as_py() or ()], set(b.as_py() or ()))
                     for h, p, b in zip(batch.column(2), batch.column(3), batch.column(4), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [id_col, url_col, "text", "n_chars"])

    kinds = joined.schema
    return joined.mapInArrow(run, f"`{id_col}` {kinds['id'].dataType.simpleString()}, `{url_col}` {kinds['url'].dataType.simpleString()}, text string, n_chars long")
