"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged by path: pages share a node if tags and
classes on the way to it are the same. For each node of the merged tree two
entropies tell how much its branch varies from page to page, in presentation
(the tags in it) and in content (its text). A branch that looks and reads
about the same everywhere has a low importance and is removed from every page
of the host. Counts are combined before they are shuffled, by host, node and
variant, so a host with very many pages is no hot task; what meets the pages
again is the list of a host's low nodes, as long as its template at most.

What varies from page to page and is no content all the same (adverts, reader
comments, links to other pages) has a high importance, so elements that say
what they are go by their tag or name, on every host. A name never costs a
page its content: a branch that holds the only article, or most of the text
of a page without one, stays whatever it is called. Where articles hold a good
part of what is left, the text is taken from them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremart.llm.arrow_groups import small
from caremart.llm.names import free_names
from caremart.sources.tables import staged

#: Branches of a lower importance are removed, on hosts that have them on so many distinct pages at least.
IMPORTANCE, MIN_PAGES = 0.3, 10

# Elements of HTML and names that pages give to what is no content.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is no text; those of the second kind may hold elements of their own kind.
TEXT_ONLY = set("script style textarea title".split())
RAW = TEXT_ONLY | set("noscript template iframe svg canvas math object select".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var".split())
#: Always no content, and so unless the branch holds what the page is about.
NOISE_TAGS = set("nav footer button dialog menu head audio video map".split())
SOFT_TAGS = set("aside form fieldset".split())
NOISE_NAMES = set("ad ads adv advert adverts advertisement advertising adbox adsense adslot banner sponsor sponsored "
                  "promo promotion nav navbar navigation menu submenu sidebar side rail widget widgets footer masthead "
                  "topbar breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup "
                  "modal overlay newsletter subscribe subscription signup login search share sharing social related "
                  "recommended recommendations copyright legal disclaimer toolbar pagination pager skip hidden".split())
COMMENT_NAMES = set("comment comments commentlist reply replies respond discussion disqus".split())
#: What may stand in a class beside such a name: "ad-box", "site-footer", "comment-list".
BESIDE_NAMES = set("area bar block body bottom box button buttons container content form group icon icons inner item "
                   "items left link links list main outer page panel post posts primary right row secondary section "
                   "site slot text thread title top unit wrap wrapper".split())
#: An article's header is its own; these are the site's.
HEADER_NAMES, BESIDE_HEADER = {"header", "head"}, set("bar global main page site top wrap wrapper".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Containers that the tree may remove; articles, headings and paragraphs are content by themselves.
PRUNABLE = set("div section nav aside header footer form ul ol dl table center figure details fieldset".split())
MERGED = PRUNABLE | {"article", "main"}
#: An opening tag of the first kind ends an open element of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
#: Elements that such an end does not reach beyond.
BOUNDS = set("article main body html div section ul ol dl table blockquote td th aside nav footer header form".split())
#: Articles with so large a share of a page's text are its text.
ARTICLE_SHARE = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_INVISIBLE = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
_PART = re.compile(r"[a-z]{2,}")
_RAW_EDGE = {tag: re.compile(rf"<(/?){tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE) for tag in RAW}
#: Of the hash of a run: order counts, and the hash of a part follows from those of two beginnings.
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51

#: What an element is by its tag and names.
CONTENT, NOISE, SOFT, COMMENT = 0, 1, 2, 3


def _named(names: list[set[str]], known: set[str], beside: set[str] = BESIDE_NAMES) -> bool:
    """Whether a name is a known one, alone or with words that say where or how it stands; by the parts of each."""
    return any(parts & known and parts <= known | beside for parts in names)


def _kind(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return NOISE
    if attributes and tag not in ("html", "body", "main"):
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
        names = [set(_PART.findall(name)) for name in names]
        if _named(names, COMMENT_NAMES):
            return COMMENT
        if tag == "article":
            return CONTENT
        if (
            _named(names, NOISE_NAMES | COMMENT_NAMES) or _named(names, HEADER_NAMES, BESIDE_HEADER)
            or attributes.get("role", "").strip().lower() in NOISE_ROLES
            or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            or _INVISIBLE.search(attributes.get("style", ""))
        ):
            return SOFT
    return SOFT if tag in SOFT_TAGS else CONTENT


class Element:
    """An element, with the run of the page's pieces of text and of its tags that it holds."""

    __slots__ = ("tag", "kind", "article", "node", "first", "last", "tags_first", "tags_last")

    def __init__(self, tag, kind, article, node, first, tags_first):
        self.tag, self.kind, self.article, self.node = tag, kind, article, node
        self.first, self.last, self.tags_first, self.tags_last = first, first, tags_first, tags_first


class Page:
    """One pass over a page: its pieces of text, blocks set apart by a blank, and its elements in page order.

    Time grows with the page's length, however deeply elements are nested and
    whatever is left open.
    """

    def __init__(self, html: str):
        self.pieces: list[str] = []
        self.tags: list[str] = []
        self.elements: list[Element] = []
        self.open = [Element("", CONTENT, False, 0, 0, 0)]
        self.places: dict[str, list[int]] = {}  # of open elements, by tag
        self.bounds, self.blocks, self.articles = [0], [0], 0
        self.astray: dict[str, int] = {}  # kinds that are not closed properly, and their last end
        self._read(html)
        while len(self.open) > 1:
            self._close()

    def _text(self, raw: str) -> None:
        if raw:
            if "head" in self.places and not raw.isspace():
                self._close_to("head")
            self.pieces.append(unescape(raw) if "&" in raw else raw)

    def _close(self) -> None:
        top = self.open.pop()
        places = self.places[top.tag]
        places.pop()
        if not places:
            del self.places[top.tag]
        if self.bounds[-1] == len(self.open):
            self.bounds.pop()
        if self.blocks[-1] == len(self.open):
            self.blocks.pop()
        self.articles -= top.tag in ("article", "main")
        top.last, top.tags_last = len(self.pieces), len(self.tags)
        if top.tag not in INLINE:
            self.pieces.append(" ")

    def _close_to(self, tag: str) -> None:
        place = self.places[tag][-1]
        while len(self.open) > place:
            self._close()

    def _start(self, tag: str, raw: str) -> None:
        if "head" in self.places and tag not in VOID:
            self._close_to("head")
        if tag not in INLINE:
            ends = ENDS.get(tag) or (("p",) if tag not in VOID else ())
            place, end = max(((self.places[t][-1], t) for t in ends if t in self.places), default=(0, ""))
            if end and place >= self.bounds[-1]:
                self._close_to(end)
            self.pieces.append(" ")
        if tag in VOID:
            return
        attributes: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(raw) if raw else ():
            attributes.setdefault(name.lower(), unescape("".join(values)))
        kind = _kind(tag, attributes, self.articles > 0 or tag in ("article", "main"))
        node = _hash(f"{self.open[-1].node} {tag} {attributes.get('class', '')}")
        place = len(self.open)
        self.places.setdefault(tag, []).append(place)
        if tag in BOUNDS:
            self.bounds.append(place)
        if tag not in INLINE:
            self.blocks.append(place)
        self.articles += tag in ("article", "main")
        element = Element(tag, kind, tag in ("article", "main") and kind == CONTENT, node, len(self.pieces), len(self.tags))
        self.open.append(element)
        if tag not in INLINE or kind:
            self.elements.append(element)
        self.tags.append(tag)

    def _end(self, tag: str) -> None:
        if tag in self.places and (tag not in INLINE or self.places[tag][-1] > self.blocks[-1]):
            self._close_to(tag)
        elif tag == "p":
            self.pieces.append(" ")

    def _raw_end(self, html: str, tag: str, at: int) -> int:
        """Where an element without text ends that has begun before ``at``.

        One that is never closed takes the rest of the page if no markup is
        read in it. Else ends count from then on without regard to nesting,
        and where none is left the page goes on: each kind is looked through
        to the end of the page twice at most.
        """
        nested, last = tag not in TEXT_ONLY and tag not in self.astray, -1
        if self.astray.get(tag) == -1:
            return at
        depth = 1
        for edge in _RAW_EDGE[tag].finditer(html, at):
            if edge[1]:
                depth, last = depth - 1, edge.end()
                if not depth or not nested:
                    return last
            elif nested and not edge[0].endswith("/>"):
                depth += 1
        if tag in TEXT_ONLY:
            return len(html)
        self.astray[tag] = last
        return max(last, at)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            match = _TOKEN.search(html, at)
            if not match:
                self._text(html[at:])
                return
            self._text(html[at : match.start()])
            at = match.end()
            name = match[2] or match[5]
            if not name:
                if match[0].startswith("<![CDATA["):
                    self._text(match[0][9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            tag = name.lower()
            if match[1] or match[4]:
                self._end(tag)
                continue
            attributes = match[3] or match[6] or ""
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    at = self._raw_end(html, tag, at)
                self.pieces.append(" ")
                continue
            self._start(tag, attributes)

    def branches(self) -> list[tuple[int, int, int]]:
        """``(node, presentation, content)`` of the containers that a site's tree merges."""
        shape, words = _runs(self.tags), _runs([" ".join(p.split()) for p in self.pieces])
        return [
            (e.node, shape(e.tags_first, e.tags_last), words(e.first, e.last)) for e in self.elements if e.tag in MERGED
        ]

    def text(self, low: frozenset[int] = frozenset()) -> str:
        """The text without what is noise and without branches in ``low``."""
        gone = bytearray(len(self.pieces))

        def remove(element: Element) -> None:
            gone[element.first : element.last] = b"\1" * (element.last - element.first)

        done = 0
        for e in self.elements:
            if e.first >= done and (e.kind == NOISE or e.tag in PRUNABLE and e.node in low):
                remove(e)
                done = e.last
        soft = [e for e in self.elements if e.kind in (SOFT, COMMENT)]
        if soft:
            size = np.cumsum([0, *(0 if g else len(p.strip()) for p, g in zip(self.pieces, gone, strict=True))])
            main = np.zeros(len(self.pieces) + 1, np.int64)
            for e in self.elements:
                if e.article and e.last > e.first and size[e.last] > size[e.first]:
                    main[e.first] += 1
            main = np.concatenate([[0], np.cumsum(main)])
            done = 0
            for e in soft:
                if e.first < done:
                    continue
                held, all_of_it = size[e.last] - size[e.first], size[-1]
                inside = main[e.last] - main[e.first]
                if main[-1] > inside:
                    stays = False  # an article elsewhere
                elif inside:
                    stays = True
                else:
                    stays = held == all_of_it if e.kind == COMMENT else 2 * held > all_of_it
                if not stays:
                    remove(e)
                    done = e.last
        left = [" " if g else p for p, g in zip(self.pieces, gone, strict=True)]
        inside, done = [], 0
        for e in self.elements:
            if e.article and e.first >= done:
                inside += [" ", *left[e.first : e.last]]
                done = e.last
        text, article = (" ".join("".join(x).split()) for x in (left, inside))
        return article if article and len(article) >= ARTICLE_SHARE * len(text) else text


def _runs(parts: list[str]):
    """Hashes of runs of ``parts``, empty ones passed over, after one pass over them."""
    sums, powers, places = [0], [1], [0]
    for part in parts:
        if part:
            sums.append((sums[-1] * _BASE + _hash(part)) % _PRIME)
            powers.append(powers[-1] * _BASE % _PRIME)
        places.append(len(sums) - 1)

    def of(first: int, last: int) -> int:
        a, b = places[first], places[last]
        return (sums[b] - sums[a] * powers[b - a]) % _PRIME

    return of


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty if there is none, null for null."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The branches of each page, and two hashes of its tags, branches and text that are the same for copies."""
    for batch in small(batches):
        names, branches = [], []
        for html in batch.column(1).to_pylist():
            page = Page(html)
            branches.append(page.branches())
            # Branches are in it, so whichever copy stands for all, the tree is the same.
            names.append(f"{' '.join(page.tags)}\n{branches[-1]}\n{' '.join(''.join(page.pieces).split())}")
        flat = [branch for of_page in branches for branch in of_page]
        node, shape, words = zip(*flat, strict=True) if flat else ((), (), ())
        ends = pa.array(np.cumsum([0, *(len(of_page) for of_page in branches)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([_hash(n) for n in names], pa.int64()),
             pa.array([_hash("copy " + n) for n in names], pa.int64()),
             *[pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (node, shape, words)]],
            names=["host", "h1", "h2", "node", "shape", "words"],
        )


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, node, n, pages, importance)`` of the merged tree of each host's distinct pages.

    Pages of a host with the same tags, classes and text count once, under whatever
    URLs: copies of a page are no template. ``pages`` have the node. The
    importance is the larger one of the entropies of presentation and
    content over the branch's ``n`` occurrences, each as a share of the most
    that so many could have.
    """
    rows = pages.select(host_of(pages[url]).alias("host"), pages[html].alias("html")).where("html is not null")
    seen = rows.mapInArrow(
        _branches, "host string, h1 long, h2 long, node array<long>, shape array<long>, words array<long>"
    )
    each = [F.first(c).alias(c) for c in ("node", "shape", "words")]
    distinct = staged(seen.groupBy("host", "h1", "h2").agg(*each).drop("h1", "h2"), "distinct-pages")
    having = distinct.select("host", F.explode(F.array_distinct("node")).alias("node"))
    having = having.groupBy("host", "node").agg(F.count(F.lit(1)).alias("pages"))
    seen = distinct.select("host", F.explode(F.arrays_zip("node", "shape", "words")).alias("b")).select("host", "b.*")
    variants = staged(
        seen.groupBy("host", "node", "shape", "words").agg(F.count(F.lit(1)).alias("c")), "branch-variants"
    )

    def entropy(of: str) -> DataFrame:
        counts = variants.groupBy("host", "node", of).agg(F.sum("c").alias("c"))
        n = F.sum("c")
        # Of counts c that add up to n: log n - sum(c log c) / n.
        nats = F.log(n.cast("double")) - F.sum(F.col("c") * F.log(F.col("c").cast("double"))) / n
        share = F.when(n > 1, nats / F.log(n.cast("double"))).otherwise(1.0)
        return counts.groupBy("host", "node").agg(n.alias("n"), share.alias(of))

    both = entropy("shape").withColumn("words", F.lit(0.0)).union(entropy("words").select(
        "host", "node", "n", F.lit(0.0).alias("shape"), "words"))
    both = both.groupBy("host", "node").agg(
        F.max("n").alias("n"), F.max(F.greatest("shape", "words")).alias("importance")
    ).withColumnsRenamed({"host": "_of", "node": "_node"})
    # Null is a host of its own.
    met = having.join(both, having["host"].eqNullSafe(both["_of"]) & (having["node"] == both["_node"]))
    return met.select("host", "node", "n", "pages", "importance")


def _extracted(place: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            lows = [frozenset(x or ()) for x in batch.column(batch.num_columns - 1).to_pylist()]
            texts = [Page(h).text(low) if h else "" for h, low in zip(batch.column(place).to_pylist(), lows, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, "text"])

    return run


def main_text(pages: DataFrame, url: str = "url", html: str = "html", importance: float = IMPORTANCE,
              min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``text``, the main text (a column of this name, in any case of letters, is replaced).

    Null and empty pages have an empty text. White space of any kind becomes
    one blank, character references are decoded, and blocks stand in page
    order. A page is read to its end however long it is and whatever markup
    is left open. Pages without a host form a site of their own.
    """
    low = style_tree(pages, url, html).where((F.col("pages") >= min_pages) & (F.col("importance") < importance))
    of, nodes = free_names(pages, "host", "low")
    low = staged(low.groupBy(F.col("host").alias(of)).agg(F.collect_list("node").alias(nodes)), "low-nodes")
    rest = [c for c in pages.columns if c.lower() != "text"]
    joined = pages.join(low, host_of(pages[url]).eqNullSafe(low[of]), "left").select(*rest, nodes)
    schema = T.StructType([pages.schema[c] for c in rest]).add("text", "string")
    return joined.mapInArrow(_extracted(rest.index(html), rest), schema)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
