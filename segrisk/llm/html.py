"""Main text of web pages by nearest-URL page differencing.

Every page becomes a list of text lines, one per block. A page is paired with
the page of the nearest other URL path of its host, the lines of both are aligned
by their longest common subsequence, and shared lines are deleted. Articles share
a line by chance or by quoting, so a line of a content element falls only if all
of the ``NEAR`` nearest pages have it. Menus, adverts and footers that change from
page to page share no line with any other page, so a check of the markup follows:
what is left inside such elements goes too.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.llm.ranges import with_neighbours

# Elements of the HTML standard by their use.
NO_TEXT = set("script style noscript template svg head iframe object canvas math audio video noembed noframes title xmp".split())
#: Elements whose text ends only at their own closing tag, whatever stands in it.
RAW = set("script style iframe noembed noframes xmp title textarea".split())
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu"}
CONTENT = {"article", "main"}
BLOCKS = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p"
    " pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Elements beyond which the closing tag of a phrase does not reach.
SPECIAL = BLOCKS - VOID - {"option"} | NO_TEXT | set("applet marquee search hgroup".split())
#: Elements beyond which no closing tag but those of tables reaches.
SCOPE = set("applet caption marquee object table td template th".split())
#: Opening tags that end an open paragraph.
ENDS_P = BLOCKS - set("body br button caption head html legend option select tbody td textarea tfoot th thead title tr".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
TABLE_PARTS = set("caption tbody td tfoot th thead tr".split())
#: Opening tags that do not end an open head.
IN_HEAD = set("base link meta noscript script style template title".split())
#: What else an opening tag ends, and the elements beyond which it does not.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
    "button": (("button",), ("/scope",)),
    "a": (("a",), ("/special",)),
}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
#: Words of a class or id that mark an element as no part of the article.
BOILERPLATE_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices"
    " popup promo related replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar"
    " topbar widget".split()
)
#: Words that say where or in what shape a marked element stands. A name is one of a marked element
#: if it has a word of those above and no word but of these two lists: social-bar is, social-history is not.
SHAPE_NAMES = set(
    "area articles bar block bottom box btn button buttons center col column container content desktop fixed flex form"
    " global group icons inner item items js large layout left leaderboard link links list main mobile outer page"
    " panel posts primary rail region right row secondary section site slot small sticky stories sub top unit user"
    " wrap wrapper".split()
)

# A tag ends at the first > outside of a quoted value, or with the page. Every part is possessive: no sign is read twice.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""")
_REMARK = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
_NAMING = re.compile(r"class|id|role", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_BLANK = re.compile(r"\s+")
#: Pages of the host that must all have a line before it falls inside a content element.
NEAR = 4
#: The place of a line: in a content element, outside of them, boilerplate by its markup.
IN_CONTENT, OTHER, MARKED = 0, 1, 2


def names_boilerplate(name: str, inside: bool) -> bool:
    """All words of a class or id name are of the two lists, one at least of the first.

    ``inside`` a content element a header is the article's own.
    """
    for parts in (_PART.findall(name.lower()), [part.lower() for part in _PART.findall(name)]):
        marking = BOILERPLATE_NAMES.intersection(parts) - ({"header"} if inside else set())
        if marking and all(part in BOILERPLATE_NAMES or part in SHAPE_NAMES for part in parts):
            return True
    return False


def is_marked(tag: str, attributes: str, inside: bool = False) -> bool:
    """The element is no part of an article, by its tag, role, class or id."""
    if tag in BOILERPLATE or tag == "header" and not inside:
        return True
    if tag == "main" or not _NAMING.search(attributes):
        return False
    if tag == "article" and not inside:
        return False  # an article within an article can be a comment
    for kind, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if kind.lower() == "role":
            if value.strip().lower() in BOILERPLATE_ROLES:
                return True
        elif kind.lower() in ("class", "id") and any(names_boilerplate(name, inside) for name in value.split()):
            return True
    return False


NO_USE = (False, False, False)


class Open:
    """The open elements of a page, outermost first, each found without a search.

    An element stays open until its closing tag, that of an element around it, or an opening
    tag that ends it, as the HTML standard has it; phrases that a block leaves open end with the block.
    ``flush`` is called before the place of the text that follows changes.
    """

    def __init__(self, flush: Callable[[], None]) -> None:
        self.flush = flush
        self.tags: list[tuple[str, tuple[bool, bool, bool]]] = []  # tag; has no text, is marked, is content
        self.places: dict[str, list[int]] = {"/special": [], "/scope": []}  # in ``tags``, by tag and by kind
        self.dropped = self.marked = self.content = 0

    def last(self, *kinds: str) -> int:
        latest = -1
        for kind in kinds:
            places = self.places.get(kind)
            if places and places[-1] > latest:
                latest = places[-1]
        return latest

    def _count(self, use: tuple[bool, bool, bool], by: int) -> None:
        if use != NO_USE:
            self.flush()
            self.dropped += by * use[0]
            self.marked += by * use[1]
            self.content += by * use[2]

    def push(self, tag: str, dropped: bool, marked: bool) -> None:
        use = (dropped, marked, tag in CONTENT and not marked)
        for kind in _kinds(tag):
            self.places.setdefault(kind, []).append(len(self.tags))
        self.tags.append((tag, use))
        self._count(use, 1)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.tags) > place:
            tag, use = self.tags.pop()
            for kind in _kinds(tag):
                self.places[kind].pop()
            self._count(use, -1)

    def close(self, tag: str) -> None:
        """A closing tag; without effect if no such element is open within its reach."""
        place = self.last(*HEADINGS) if tag in HEADINGS else self.last(tag)
        if tag == "table":
            limit = -1
        elif tag in TABLE_PARTS:
            limit = self.last("table")
        elif tag == "li":
            limit = self.last("/scope", "ul", "ol")
        else:
            limit = self.last("/scope" if tag in SPECIAL else "/special")
        if place >= max(limit, 0):
            self.cut(place)

    def imply(self, tag: str) -> None:
        """Close what an opening tag ends."""
        if self.tags and self.tags[-1][0] == "head" and tag not in IN_HEAD or tag == "body" and self.last("head") >= 0:
            self.cut(self.last("head"))
        if self.dropped:
            return
        if tag in ENDS_P and self.last("p") > self.last("/scope", "button"):
            self.cut(self.last("p"))
        if tag in HEADINGS and self.tags and self.tags[-1][0] in HEADINGS:
            self.cut(len(self.tags) - 1)
        if tag in ENDS:
            ended, within = ENDS[tag]
            if self.last(*ended) > self.last(*within):
                self.cut(self.last(*ended))


@functools.lru_cache(1000)
def _kinds(tag: str) -> tuple[str, ...]:
    if tag in SCOPE:
        return tag, "/special", "/scope"
    return (tag, "/special") if tag in SPECIAL else (tag,)


def lines_of(page: str) -> list[tuple[str, int]]:
    """Text of every block in page order, with its place. Takes time in proportion to the page."""
    lines: list[tuple[str, int]] = []
    words: list[str] = []

    def flush() -> None:
        if words:
            text = _BLANK.sub(" ", html.unescape("".join(words))).strip()
            words.clear()
            if text:
                lines.append((text, MARKED if opened.marked else IN_CONTENT if opened.content else OTHER))

    opened = Open(flush)
    at = 0
    while at < len(page):
        start = page.find("<", at)
        start = len(page) if start < 0 else start
        if start > at and not opened.dropped:
            words.append(page[at:start])
        token = _TAG.match(page, start)
        if token is None:
            remark = _REMARK.match(page, start)
            at = remark.end() if remark else start + 1
            if not remark and not opened.dropped:
                words.append(page[start:at])
            continue
        at = token.end()
        tag, attributes = token[2].lower(), token[3]
        if tag in BLOCKS:
            flush()
        if token[1]:
            opened.close(tag)
            continue
        opened.imply(tag)
        if tag in ("html", "body") or tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = _RAW_ENDS[tag].search(page, at)
            at = end.start() if end else len(page)
        dropped = tag in NO_TEXT
        opened.push(tag, dropped, not dropped and not opened.dropped and is_marked(tag, attributes, opened.content > 0))
    flush()
    return lines


def line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both.

    Equal ends are taken off; the rest is a longest ascending chain of matching
    places, which costs the number of matches times a logarithm.
    """
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - last - 1, first - 1, -1):
        where.setdefault(b[j], []).append(j)
    tails: list[int] = []
    ends: list[tuple] = []
    for i in range(first, len(a) - last):
        for j in where.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(link)
            else:
                tails[k] = j
                ends[k] = link
    chain, link = [], ends[-1] if ends else None
    while link:
        chain.append(link[0])
        link = link[1]
    return [*range(first), *reversed(chain), *range(len(a) - last, len(a))]


def main_text(page: str, partner: list[int] | None, everywhere: list[int] | None = None) -> tuple[str, int]:
    """The article, and how many lines the differencing deleted.

    ``partner`` has the line hashes of the nearest page, ``everywhere`` those that
    all of the ``NEAR`` nearest pages have. Lines that are not on the partner stay,
    wherever they stand, unless their markup speaks against them. If the page shares
    more than half of its plain text with its partner, the two are copies. Only
    the markup decides on the shared plain lines of copies, on shared lines of a content
    element that are not everywhere, and on all lines of a page without a partner: if the
    page has a content element, what stands in it is the article.
    """
    lines = lines_of(page)
    plain = {i for i, (_, place) in enumerate(lines) if place != MARKED}
    hashes = [line_hash(text) for text, _ in lines] if partner else []
    shared = set(common(hashes, partner)) if partner else set()
    known = set(everywhere or ())
    if not partner:
        undecided = plain
    elif 2 * sum(len(lines[i][0]) for i in plain & shared) > sum(len(lines[i][0]) for i in plain):
        undecided = plain & shared
    else:
        undecided = {i for i in shared if lines[i][1] == IN_CONTENT and hashes[i] not in known}
    shared -= undecided
    kept = plain - shared
    wanted = IN_CONTENT if any(place == IN_CONTENT for _, place in lines) else OTHER
    left = [text for i, (text, place) in enumerate(lines) if i in kept and (i not in undecided or place == wanted)]
    return " ".join(left), len(shared)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Path without query, fragment, last slash and page suffix, so that forms of one address agree."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r"(/index)?(\.html?)?/*$", "")


def url_query(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)


def partners(pages: DataFrame) -> DataFrame:
    """``_address``, ``_copy``, ``_partner``, the line hashes of the page nearest to it on its host, and ``_everywhere``.

    ``pages`` has _address (host, tab, path), _copy (a hash of _html), _query, _html and _id.
    One page stands for all of an address with the same _copy. Pages stand in the order of
    path, query and id; nearest is the neighbour that has more path parts in common, at a
    tie the one before, or else the next one in order. Pages with which it shares more than half
    of its plain text are passed over while there are others. ``_everywhere``
    has the lines that all of the ``NEAR`` nearest have; null if there are fewer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [lines_of(page or "") for page in batch.column(3).to_pylist()]
            hashes = [[line_hash(text) for text, _ in lines] for lines in pages]
            plain = [
                [h & ~0xFFFF | min(len(text), 0xFFFF) for h, (text, place) in zip(*both, strict=True) if place != MARKED]
                for both in zip(hashes, pages, strict=True)
            ]  # the lowest bits are the length
            columns = [*batch.columns[:3], *[pa.array(x, pa.list_(pa.int64())) for x in (hashes, plain)]]
            yield pa.RecordBatch.from_arrays(columns, ["_address", "_copy", "_order", "_lines", "_plain"])

    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    narrow = pages.select("_address", "_copy", F.concat_ws("\t", "_query", F.to_json(order), "_copy").alias("_order"), "_html")
    place = F.concat_ws("\t", "_address", F.min("_order")).alias("_place")
    lines = narrow.mapInArrow(run, "_address string, _copy long, _order string, _lines array<bigint>, _plain array<bigint>")
    one = lines.groupBy("_address", "_copy").agg(place, *[F.min_by(c, "_order").alias(c) for c in ("_lines", "_plain")])
    valued = one.withColumn("_value", F.struct("_address", "_lines", "_plain"))
    around = with_neighbours(valued, "_place", "_value", NEAR, narrow.groupBy("_address", "_copy").agg(place))

    def nearness(side: str) -> Column:
        """Path parts in common, or null on another host or without a URL."""
        parts = [F.split(F.element_at(F.split(F.col(c), "\t"), 2), "/") for c in ("_address", f"{side}._address")]
        same = F.size(F.filter(F.zip_with(*parts, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
        host = [F.element_at(F.split(F.col(c), "\t"), 1) for c in ("_address", f"{side}._address")]
        return F.when((host[0] == host[1]) & (F.col("_address") != "\t"), same)

    def length(plain: Column) -> Column:
        return F.aggregate(F.array_distinct(plain), F.lit(0).cast("long"), lambda total, x: total + x.bitwiseAND(F.lit(0xFFFF)))

    def copied(side: Column) -> Column:
        return 2 * length(F.array_intersect("_plain", side["_plain"])) > length(F.col("_plain"))

    before_first = F.coalesce(nearness("before"), F.lit(-1)) >= F.coalesce(nearness("after"), F.lit(-1))
    sides = [f"{side}{'' if k == 1 else k}" for k in range(1, NEAR + 1) for side in ("before", "after")]
    swapped = [sides[i ^ 1] for i in range(len(sides))]
    on_host = [F.array(*[F.when(nearness(side).isNotNull(), F.col(side)) for side in way]) for way in (sides, swapped)]
    near = F.array_compact(F.when(before_first, on_host[0]).otherwise(on_host[1]))
    found = around.withColumn("_near", near).withColumn("_apart", F.filter("_near", lambda x: ~copied(x)))
    apart = F.transform(F.slice("_apart", 1, NEAR), lambda x: x["_lines"])
    shared = F.aggregate(F.slice(apart, 2, NEAR - 1), F.get(apart, 0), F.array_intersect)
    partner = F.coalesce(F.get("_apart", 0), F.get("_near", 0))
    everywhere = F.when(F.size("_apart") >= NEAR, shared)
    return found.select("_address", "_copy", partner["_lines"].alias("_partner"), everywhere.alias("_everywhere"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key``, ``url``, text, n_chars and n_shared (lines deleted by differencing) of every page.

    A null or empty page has an empty text. Pages without a URL have no
    partner; equal pages at forms of one address are not compared with each other. Repeated
    rows each get a row; other columns of ``pages`` are not used.
    """
    parts = [F.translate(part(F.col(url)), "\t", " ") for part in (url_host, url_path, url_query)]
    narrow = pages.select(
        F.col(key).alias("_id"), F.col(url).alias("_url"), F.concat_ws("\t", *parts[:2]).alias("_address"),
        parts[2].alias("_query"), F.xxhash64(page).alias("_copy"), F.col(page).alias("_html"),
    )
    paired = narrow.join(partners(narrow), ["_address", "_copy"], "left").select("_id", "_url", "_html", "_partner", "_everywhere")
    kinds = [narrow.schema[c].dataType.simpleString() for c in ("_id", "_url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(k).to_pylist() for k in (2, 3, 4)]
            found = [main_text(page or "", partner, everywhere) for page, partner, everywhere in zip(*given, strict=True)]
            texts = [t for t, _ in found]
            columns = [
                pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array(np.array([n for _, n in found], np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], [key, url, "text", "n_chars", "n_shared"]
            )

    return paired.mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string, n_chars long, n_shared long")
