"""Main text of web pages by wrappers inferred per host (union-free regular expressions).

A page is read as a stream of tags and texts. The streams of a host are aligned element by
element, one page after the other: an element is known by the tags and classes around it,
an element that returns inside its parent becomes a repeated group, one that some pages lack
an optional group, a text that the pages share stays fixed and one that differs becomes a
slot. Tasks read the pages, and grouping in Spark merges what they found, so all pages of a
host count however many there are. The article is what stands in slots: blocks that are
fixed on the host, or repeated groups of links, belong to its template.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.runtime import cut_lineage

# Size up to which the wrappers are sent to the pages; beyond it Spark joins by shuffling.
WRAPPER_BYTES = 16 << 20

# Fixed values of HTML: elements without an end, with raw text, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre search section "
    "select summary table caption tbody thead tfoot tr ul".split()
)
CELL = frozenset(("td", "th"))
# Elements whose start closes an open one of the second kind, unless one of the third is nearer.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "body": (("head",), ()),
}
# Elements and names of classes, ids and roles that never hold the article.
ASIDE = frozenset("head nav footer aside form button select dialog menu search label fieldset".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|promotions?|nav|navbar|navigation|"
    r"menus?|breadcrumbs?|pagination|pager|sidebars?|aside|rail|widgets?|footers?|foot|masthead|topbar|toolbar|"
    r"site-header|page-header|comments?|replies|disqus|respond|discussion|share|sharing|social|related|recommended|recommendations|"
    r"newsletter|subscribe|subscription|signup|login|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|disclaimer|"
    r"copyright|tags|tagcloud|skip-link|search|forms?|complementary|contentinfo)(?:$|[\s_-])"
)
# Whole names that say an element holds the article, whatever other names stand beside them,
# and names of what readers write.
ARTICLE_NAMES = frozenset("article article-body entry entry-content post post-content post-body story story-body content".split())
READERS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|disqus|respond)(?:$|[\s_-])")
ARTICLE = frozenset(("article", "main"))

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE) for tag in RAW}
_DIGITS = re.compile(r"\d+")


def _hash(text: str, seed: int = 0) -> int:
    value = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed)
    return value - (1 << 64) if value >> 63 else value


def tags(page: str) -> Iterator[tuple[str, str, str]]:
    """The page as (kind, name, rest): ``text``, ``open`` or ``close``, in one pass.

    Comments, declarations and the insides of scripts and the like are left out. Where a tag
    never ends because its quotes do not pair up, tags end at the next ``>`` from there on;
    a tag without any ``>`` after it is text.
    """
    at, begun, quoted = 0, 0, True
    while (start := page.find("<", at)) >= 0:
        close = page.startswith("/", start + 1)
        name = _NAME.match(page, start + 1 + close)
        if name is None and not (close or page.startswith(("!", "?"), start + 1)):
            at = start + 1  # a sign, not a tag
            continue
        if name is None:
            ends = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">"))
            ending = next(ending for opening, ending in ends if page.startswith(opening, start))
            stop = page.find(ending, start + 1)
            stop = len(page) if stop < 0 else stop + len(ending)
            if start > begun:
                yield "text", "", page[begun:start]
            at = begun = stop
            continue
        stop = -1
        if quoted:
            look = name.end()
            while mark := _STOP.search(page, look):
                if mark[0] == ">":
                    stop = mark.start()
                    break
                look = page.find(mark[0], mark.end()) + 1
                if not look:
                    break
            quoted = stop >= 0
        if stop < 0:
            stop = page.find(">", name.end())
            if stop < 0:
                break
        if start > begun:
            yield "text", "", page[begun:start]
        tag, rest = name[0].lower(), page[name.end() : stop]
        at = begun = stop + 1
        yield "close" if close else "open", tag, rest
        if tag in RAW and not close and not rest.rstrip().endswith("/"):
            end = _ENDS[tag].search(page, at)
            at = begun = end.end() if end else len(page)
    if begun < len(page):
        yield "text", "", page[begun:]


@dataclass
class Block:
    """A block of a page: its element, its text, whether all of it is links."""

    path: int
    key: str
    text: str
    links: bool
    marked: bool


@dataclass
class _Open:
    tag: str
    path: int
    key: str
    aside: bool
    marked: bool
    link: bool


@dataclass
class _Stack:
    """Open elements, with the depths of each tag, so that none is ever searched for."""

    items: list[_Open]
    depths: dict[str, list[int]] = field(default_factory=dict)

    def push(self, item: _Open) -> None:
        self.depths.setdefault(item.tag, []).append(len(self.items))
        self.items.append(item)

    def nearest(self, tags_: tuple[str, ...]) -> int:
        return max((self.depths[tag][-1] for tag in tags_ if self.depths.get(tag)), default=0)

    def close(self, tags_: tuple[str, ...], limits: tuple[str, ...] = ()) -> list[_Open]:
        """Close the nearest of these tags and all inside it; nothing beyond a limit."""
        depth = self.nearest(tags_)
        if not depth or self.nearest(limits) > depth:
            return []
        closed = self.items[depth:]
        del self.items[depth:]
        for item in closed:
            self.depths[item.tag].pop()
        return closed


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page that may belong to its article, however its tags are closed.

    Menus, forms, notices and the like are left out by their elements and names. Of a page
    with ``article`` or ``main`` elements that hold text only these count. The time is linear
    in the page's length.
    """
    stack = _Stack([_Open("", 0, "", False, False, False)])
    found: list[Block] = []
    held: list[str] = []
    place: list[_Open] = []
    linked = True

    def end() -> None:
        nonlocal linked
        if held and (text := " ".join(references.unescape("".join(held)).split())):
            first = place[0] if place else stack.items[-1]
            found.append(Block(first.path, first.key, text, linked, first.marked))
        held.clear()
        place.clear()
        linked = True

    def closed(items: list[_Open]) -> None:
        if any(item.tag in BLOCK for item in items):
            end()

    for kind, tag, rest in tags(page or ""):
        top = stack.items[-1]
        if kind == "text":
            if not top.aside:
                held.append(rest)
                if rest and not rest.isspace():
                    place.append(top)
                    linked = linked and top.link
            continue
        if kind == "close":
            closed(stack.close((tag,)))
            continue
        if tag in BLOCK:
            closed(stack.close(("p",), ("td", "th", "button", "table")))
        if tag in CLOSES:
            closed(stack.close(*CLOSES[tag]))
        top = stack.items[-1]
        if tag in BLOCK:
            end()
        elif not top.aside and (tag == "br" or tag in CELL):
            held.append(" ")
        if tag in VOID or tag in RAW or tag not in BLOCK and rest.rstrip().endswith("/"):
            continue
        names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(rest)}
        given = " ".join(names.get(k, "") for k in ("class", "id", "role")).lower()
        split = given.split()
        aside = top.aside or tag in ASIDE or "hidden" in names or names.get("aria-hidden", "").lower() == "true"
        aside = aside or not top.marked and (tag == "header" or "header" in split)
        if not aside and tag not in ("html", "body") and given.strip():
            aside = bool(NAMES.search(given)) and (ARTICLE_NAMES.isdisjoint(split) or bool(READERS.search(given)))
        kinds = _DIGITS.sub("0", " ".join(names.get("class", "").lower().split()))
        key = f"{tag}.{kinds}" if kinds else tag
        path = _hash(key, top.path & (1 << 64) - 1)
        stack.push(_Open(tag, path, key, aside, top.marked or tag in ARTICLE and not aside, top.link or tag == "a"))
    end()
    marked = [block for block in found if block.marked]
    return marked or found


def extract(page: str | None, fixed: frozenset = frozenset(), menus: frozenset = frozenset()) -> str:
    """The article's blocks, joined by empty lines; empty if the page has none.

    ``fixed`` holds the wrapper's (element, text) pairs by hash, ``menus`` the elements that
    are repeated groups of links. A block goes only if all of it is fixed.
    """
    kept = blocks(page)
    if fixed:
        kept = [b for b in kept if (b.path, _hash(b.text)) not in fixed]
    if menus:
        kept = [b for b in kept if not (b.links and not b.marked and b.path in menus)]
    return "\n\n".join(b.text for b in kept)


def host_of(url: str = "url"):
    """Host of an address, in lower case; empty for none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def infer_wrappers(
    pages: DataFrame, html: str = "html", url: str = "url", share: float = 0.9, least: int = 3, most: float = 0.3
) -> DataFrame:
    """The wrapper of every host, one row per element that holds text.

    ``host``, ``path`` and ``key`` (the element), ``pages`` that have it out of the host's
    ``of``, ``optional`` and ``repeated``, ``slot`` (some of its texts differ), ``menu`` (a
    repeated group of links), and ``fixed``: hashes of the texts that at least ``share`` of
    the pages with this element have in it.

    All pages of a host count. Copies of a page are one page: pages are told apart by their
    longest block. An element on fewer than ``least`` different pages has only slots. Where
    the fixed texts would be more than ``most`` of all text of the host, its pages are near
    copies of each other and not a template, so nothing is fixed. Empty pages and pages without a host have no
    wrapper; an empty table gives none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "path", "text", "page", "key", "size", "links", "times"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows: list[tuple] = []
            for host, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = blocks(body)
                if not found:
                    continue
                page = _hash(max((b.text for b in found), key=lambda text: (len(text), text)))
                elements: dict[int, list] = {}
                texts: dict[tuple[int, int], int] = {}
                for b in found:
                    element = elements.setdefault(b.path, [b.key, 0, 0, 0])
                    element[1] += len(b.text)
                    element[2] += len(b.text) if b.links and not b.marked else 0
                    element[3] += 1
                    texts[b.path, _hash(b.text)] = len(b.text)
                rows += [(host, path, None, page, key, size, links, times) for path, (key, size, links, times) in elements.items()]
                rows += [(host, path, text, page, None, size, 0, 1) for (path, text), size in texts.items()]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    known = pages.select(host_of(url).alias("host"), F.col(html).alias("html")).filter((F.col("host") != "") & (F.col("html") != ""))
    streams = known.mapInArrow(
        read, "host string, path long, text long, page long, key string, size long, links long, times long"
    )
    once = streams.groupBy("host", "path", "text", "page").agg(
        F.min("key").alias("key"), F.max("size").alias("size"), F.max("links").alias("links"), F.max("times").alias("times")
    )
    aligned = cut_lineage(
        once.groupBy("host", "path", "text").agg(
            F.count(F.lit(1)).alias("pages"), F.min("key").alias("key"), F.sum("size").alias("size"),
            F.sum("links").alias("links"), F.max("times").alias("times"),
        )
    )
    elements = aligned.filter(F.col("text").isNull())
    total = elements.groupBy("host").agg(F.sum("size").alias("__all"), F.max("pages").alias("of"))
    inside = elements.select("host", "path", F.col("pages").alias("__with"))
    same = (
        aligned.filter(F.col("text").isNotNull() & (F.col("pages") >= least))
        .join(inside, ["host", "path"])
        .filter(F.col("pages") >= share * F.col("__with"))
    )
    copies = (
        same.groupBy("host").agg(F.sum("size").alias("__same")).join(total, "host")
        .filter(F.col("__same") > most * F.col("__all")).select("host")
    )
    fixed = (
        same.join(copies, "host", "left_anti").groupBy("host", "path")
        .agg(F.sort_array(F.collect_list("text")).alias("fixed"), F.sum("size").alias("__fixed"))
    )
    return cut_lineage(
        elements.join(fixed, ["host", "path"], "left").join(total, "host").select(
            "host", "path", "key", "pages", "of",
            (F.col("pages") < F.col("of")).alias("optional"),
            (F.col("times") > 1).alias("repeated"),
            (F.coalesce("__fixed", F.lit(0)) < F.col("size")).alias("slot"),
            ((F.col("times") > 1) & (F.col("pages") >= least) & (F.col("links") >= 0.8 * F.col("size"))).alias("menu"),
            F.coalesce("fixed", F.array().cast("array<long>")).alias("fixed"),
        )
    )


def extract_pages(pages: DataFrame, wrappers: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Add ``text`` and ``n_chars`` to every page; columns of these names are replaced.

    A null page is empty and has an empty text. Pages of hosts without a wrapper are
    extracted by elements and names alone. Repeated rows stay.
    """

    @F.arrow_udf("string")
    def main_text(bodies: pa.Array, fixed: pa.Array, menus: pa.Array) -> pa.Array:
        texts, read, last = [], (frozenset(), frozenset()), (None, None)
        for body, same, links in zip(bodies.to_pylist(), fixed.to_pylist(), menus.to_pylist()):
            if (same, links) != last:
                last = same, links
                read = frozenset((f["path"], text) for f in same or () for text in f["fixed"]), frozenset(links or ())
            texts.append(extract(body, *read))
        return pa.array(texts, pa.string())

    pages = pages.drop("text", "n_chars")
    keyed = pages.withColumn("__host", host_of(url))
    # Only what changes a page is sent: elements with fixed texts, and menus.
    used = cut_lineage(
        wrappers.filter(F.col("menu") | (F.size("fixed") > 0)).groupBy(F.col("host").alias("__of")).agg(
            F.sort_array(F.collect_list(F.when(F.size("fixed") > 0, F.struct("path", "fixed")))).alias("__fixed"),
            F.sort_array(F.collect_list(F.when(F.col("menu"), F.col("path")))).alias("__menus"),
        )
    )
    hashes = F.size("__menus") + F.aggregate("__fixed", F.lit(0), lambda n, f: n + 4 + F.size(f["fixed"]))
    size = used.agg(F.coalesce(F.sum(F.octet_length("__of") + 64 + 8 * hashes), F.lit(0))).first()[0]
    if size <= WRAPPER_BYTES:
        used = F.broadcast(used)
    return (
        keyed.join(used, F.col("__host") == F.col("__of"), "left")
        .withColumn("text", main_text(F.col(html), F.col("__fixed"), F.col("__menus")))
        .select(*pages.columns, "text", F.length("text").cast("long").alias("n_chars"))
    )
