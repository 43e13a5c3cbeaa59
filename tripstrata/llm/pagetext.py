"""Main text of web pages: site templates found by counting element subtrees per host.

One pass hashes the subtree of every element that is not navigation or the like by its own tag, class or role, and
every block of text outside article and main elements, whatever elements it is made of.  Spark counts, per host, on
how many different pages each of them stands.  A second pass drops those that recur on many of the host's pages and
returns the blocks of what is left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import staged

#: A subtree is template if it stands on at least this many different pages of its host; inside an article or main
#: element it must also stand on this share of them, as texts quote each other.
MIN_PAGES = 5
MIN_SHARE = 0.3
#: Up to this many template subtrees over all hosts, the table is broadcast (16 bytes each); above, it is joined.
BROADCAST_TEMPLATES = 500_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "noembed", "noframes"))
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NOT_TEXT = frozenset(
    "head nav header footer aside form script style noscript template iframe object embed svg canvas audio video map button select option optgroup textarea title dialog menu menuitem datalist fieldset frameset xmp noembed noframes".split()
)
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tooltip".split())
#: Words of a class or id that mark what surrounds an article.
NOT_TEXT_WORDS = frozenset(
    "ad ads adbox adslot adsense adsbygoogle advert adverts advertisement advertising sponsor sponsors sponsored promo promos promotion banner banners "
    "cookie cookies consent gdpr notice notices popup modal overlay paywall sidebar nav navbar navigation menu menus breadcrumb breadcrumbs "
    "header masthead footer comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations "
    "newsletter subscribe signup login widget widgets toolbar pagination pager".split()
)
CONTAINERS = frozenset(("html", "body", "main", "article"))
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: An opening tag ends an open element of these names, up to the nearest of the scope's names.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
    "body": (("head",), ("html",)),
}
P_SCOPE = frozenset(("table", "td", "th", "button", "object", "html"))

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = re.compile(r"\s*[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)")


def host_key(url: str | None) -> int:
    """A 63-bit name of the host; 0 if there is none."""
    found = _HOST.match(url or "")
    return (xxhash.xxh3_64_intdigest(found[1].lower()) >> 1) or 1 if found else 0


def surrounds(tag: str, attributes: str) -> bool:
    """Whether an element by itself is a menu, header, advert, form, comment and so on."""
    if tag in NOT_TEXT:
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "role":
            if value.strip().lower() in NOT_TEXT_ROLES:
                return True
        elif name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return True
        elif name in ("hidden", "aria-hidden"):
            if value.strip().lower() != "false" and tag not in CONTAINERS:
                return True
        else:
            words = {w.lower() for w in _WORD.findall(value)} & NOT_TEXT_WORDS
            if words and (tag not in CONTAINERS or tag == "article" and words & {"comment", "comments", "reply"}):
                return True
    return False


def digest_of(kind: str, text: str, inside: bool) -> int:
    """A 63-bit name; the lowest bit tells whether it stands inside an article or main element."""
    return (xxhash.xxh3_64_intdigest(f"{kind}\0{text}") >> 2) << 1 | inside


class Element:
    __slots__ = ("article", "first", "outside", "parts", "tag")

    def __init__(self, tag: str, outside: bool, article: bool, first: int):
        self.tag, self.outside, self.article, self.first, self.parts = tag, outside, article, first, []


class Page:
    """One walk over the markup.  ``pieces`` are (text or None for a block's end, inside article or main, linked);
    ``subtrees`` the digests of closed elements; with ``templates`` their pieces are dropped as they close."""

    def __init__(self, html: str, templates: frozenset[int] | set[int] = frozenset()):
        self.templates, self.pieces, self.subtrees = templates, [], set()
        self.open = [Element("#", False, False, 0)]
        at = 0
        while found := _MARKUP.search(html, at):
            self.text(html[at : found.start()])
            at = found.end()
            tag = found[2] or found[5]
            if not tag:
                continue
            tag = tag.lower()
            if found[1] or found[4]:
                self.end(tag)
                continue
            self.start(tag, found[3] or found[6] or "")
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)
        self.text(html[at:])
        while len(self.open) > 1:
            self.close()

    def text(self, raw: str) -> None:
        top = self.open[-1]
        if raw and not top.outside:
            self.pieces.append((raw, top.article, any(e.tag == "a" for e in self.open[-3:])))
            top.parts.append(raw)

    def start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self.close_up_to(("p",), P_SCOPE)
        if tag in ENDS:
            self.close_up_to(*ENDS[tag])
        top = self.open[-1]
        if tag == "br" or tag not in INLINE:
            self.pieces.append((" " if tag == "br" else None, top.article, False))
        if tag in VOID:
            return
        outside = top.outside or surrounds(tag, attributes)
        article = top.article or tag in ("article", "main") or "main" in attributes and bool(re.search(r"""role\s*=\s*["']?main\b""", attributes))
        self.open.append(Element(tag, outside, article, len(self.pieces)))

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.start("br", "")
        if tag == "p" and not any(e.tag == "p" for e in self.open):
            self.pieces.append((None, self.open[-1].article, False))
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                while len(self.open) > depth:
                    self.close()
                return
            if tag in INLINE and self.open[depth].tag not in INLINE:
                return

    def close_up_to(self, tags: tuple[str, ...], scope) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].tag
            if name in scope:
                return
            if name in tags:
                outermost = depth
                while self.open[outermost - 1].tag in tags:
                    outermost -= 1
                while len(self.open) > outermost:
                    self.close()
                return

    def close(self) -> None:
        done = self.open.pop()
        if done.outside:
            return
        block = done.tag not in INLINE
        if done.tag not in CONTAINERS and any(not p.isspace() for p in done.parts):
            digest = digest_of(done.tag, " ".join(" ".join(done.parts).split()), self.open[-1].article)
            self.open[-1].parts.append(f"\1{digest}")
            if block:
                self.subtrees.add(digest)
            if digest in self.templates:
                del self.pieces[done.first :]
        elif done.parts:
            self.open[-1].parts.extend(done.parts[:1])
        if block:
            self.pieces.append((None, self.open[-1].article, False))

    def lines(self) -> Iterator[tuple[str, bool, bool]]:
        """(text, inside article or main, of links alone) of each block with text, in page order."""
        texts, linked, within = [], True, False
        for text, article, link in [*self.pieces, (None, False, False)]:
            if text is None or article != within:
                line = " ".join(unescape("".join(texts)).split())
                if line:
                    yield line, within, linked
                texts, linked, within = [], True, article
            if text is not None:
                texts.append(text)
                linked = linked and (link or text.isspace())

    def digests(self) -> set[int]:
        """What is counted: the subtrees of block elements, and blocks of text outside article and main."""
        return self.subtrees | {digest_of("#block", line, False) for line, within, _ in self.lines() if not within}

    def blocks(self) -> list[str]:
        """Blocks in page order: those of the article or main element where there is one with text, or else all
        but templates and lines that consist of links alone."""
        lines = list(self.lines())
        inside = any(within for _, within, _ in lines)
        return [
            line
            for line, within, linked in lines
            if (within if inside else not linked and not (self.templates and digest_of("#block", line, False) in self.templates))
        ]


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, subtrees, pages = [], [], []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            host = host_key(url)
            if host and html:
                found = Page(html).digests()
                page = xxhash.xxh3_64_intdigest(b"".join(d.to_bytes(8, "little") for d in sorted(found))) >> 1
                hosts += [host] * (len(found) + 1)
                subtrees += [0, *found]
                pages += [page] * (len(found) + 1)
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.int64()), "subtree": pa.array(subtrees, pa.int64()), "page": pa.array(pages, pa.int64())})


def template_subtrees(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, subtree) of the subtrees that recur.  Copies of a page count once, so an article that was published
    twice is no template; subtree 0 stands for the page itself and counts the pages of a host."""
    rows = pages.select("url", "html").mapInArrow(_subtree_rows, "host long, subtree long, page long").distinct()
    counts = rows.groupBy("host", "subtree").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    hosts = counts.filter("subtree = 0").select("host", F.col("n").alias("pages"))
    outside = F.col("subtree") % 2 == 0
    return counts.filter("subtree <> 0").join(hosts, "host").filter(outside | (F.col("n") >= min_share * F.col("pages"))).select("host", "subtree")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, limit: int = BROADCAST_TEMPLATES) -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Null html is empty text.  A page without a host has no site, so no template; neither has a host with fewer than
    ``min_pages`` different pages.  Rows with equal or null ids stay
    apart; other columns are not read; an empty table gives none.
    """
    spark = pages.sparkSession
    rows = staged(template_subtrees(pages, min_pages, min_share), "templates")
    # a host has at most its subtrees / min_pages templates; the number over all hosts is checked
    found = rows.groupBy("host").agg(F.collect_list("subtree").alias("subtrees"))
    small = rows.count() <= limit
    known = found.collect() if small else []
    shipped = spark.sparkContext.broadcast({r["host"]: frozenset(r["subtrees"]) for r in known})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column("url")
            own = batch.column("subtrees").to_pylist() if "subtrees" in batch.schema.names else [None] * batch.num_rows
            texts = [
                "\n".join(Page(html, shipped.value.get(host_key(url), frozenset()) if mine is None else frozenset(mine)).blocks()) if html else ""
                for url, html, mine in zip(urls.to_pylist(), batch.column("html").to_pylist(), own)
            ]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": urls, "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    rows = pages.select("page_id", "url", "html")
    if not small:
        named = rows.mapInArrow(_with_host, rows.withColumn("host", F.lit(0).cast("long")).schema)
        rows = named.join(found, "host", "left").select("page_id", "url", "html", "subtrees")
    return rows.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def _with_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(map(host_key, batch.column("url").to_pylist()), pa.int64())], names=[*batch.schema.names, "host"])
