"""HTML extraction by site template removal.

Every page is parsed into a tree (void elements, implied ends and raw text as the HTML standard has them, as far as
the text needs it). Each block element has a slot, the host and the chain of tags and classes down to it, and a hash
of its slot and subtree. Spark counts on how many different pages of the host each subtree stands, and deletes those
that recur, menus, notices, adverts and sidebars, wherever they stand:

* Pages speak for a template only if at least OWN_SHARE of their text stands on no other page of the host. Thus the copies
  of an article, however many, don't make its paragraphs a template.
* A container that stands on MIN_PAGES such pages is template if at least half of what stands in its slot recurs, or if it
  stands on half the pages that have the slot. So is all that stands in a slot of which nearly everything recurs
  (SLOT_SHARE), as where adverts rotate.
* A paragraph, heading or list item is template by itself only if it stands on half the pages that have its slot, and never
  inside article or main, where a line that an author repeats is text; table cells go with their table alone.

The counts are absolute or shares of a slot, so the size of a host doesn't matter.

Fallback, for what can't be told by recurrence (hosts of few pages, what differs from page to page): elements that hold no article
text by their tag (scripts, styles, menus, asides, footers, forms, headers outside the article), elements hidden, and elements
whose role, class or id says advert or comment. Class words of things that do recur, such as menu or sidebar, count only
where the slot isn't known to hold text that differs from page to page. No word or form takes what holds over half of
a page's text. If article or main elements are left, the text is read from them, without articles of less than a quarter of the
largest one's text (teasers).

Text: character references decoded, white space inside a block to one space, trimmed; blocks joined by two newlines.

Defined cases: null or empty html gives an empty text; a null url is a host of its own; unclosed and misnested elements end
where their parent does; pages of any length and nesting are read whole, in linear time; repeated rows are rows of their own
and count once for templates; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, column, cut, discard, pieces, read, salted_join

#: Pages on which a template stands at least, and on which a slot stands whose text is known to differ.
MIN_PAGES, KNOWN_PAGES = 5, 20
#: Share of a page's text that no other page has, if the page is to count; share of a slot that recurs in a template's slot, and in one of text.
OWN_SHARE, SLOT_SHARE, TEXT_SHARE = 0.2, 0.8, 0.2
#: Bytes of template hashes that are broadcast; beyond it they are joined by page.
BROADCAST = 32 << 20

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark meter option output picture progress q rp rt ruby s samp select small source span strike strong sub sup textarea time tt u var wbr".split())
# An open element on the left is ended by a start tag on the right, unless an element of SCOPE lies between.
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "legend"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "p": CLOSES_P}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("table",), "th": ("table",), "p": ("button", "td", "th", "caption")}
ENDED_BY = {tag: [own for own in ENDS if tag in ENDS[own]] for tag in frozenset().union(*ENDS.values())}
# End tags of these don't reach beyond a block of BARRIER.
WEAK = frozenset("p b i a em span strong".split())
BARRIER = ("article", "main", "section", "div", "td", "li")

# Elements that are never shown as text, and elements without article text by their meaning.
UNSHOWN = frozenset("script style noscript template iframe object svg canvas head title noframes xmp audio video map".split())
ASIDES = frozenset("nav footer aside button select textarea input label fieldset menu dialog search".split())
# Words of class and id for what differs from page to page, and for what recurs; roles of either.
VARYING = frozenset("ad ads advert advertisement advertising adsense adslot sponsor sponsored promo comment comments respond disqus replies reply related recommended recommendations share sharing social pagination pager popup modal overlay".split())
RECURRING = frozenset(
    "banner nav navbar navigation navi menu menubar breadcrumb breadcrumbs header masthead topbar toolbar footer foot bottombar sidebar side aside rail widget widgets notice notices cookie cookies consent gdpr alert newsletter subscribe subscription signup signin login copyright legal disclaimer skip search complementary contentinfo hidden promotion".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Parts of a text, which go by themselves only if they are everywhere; cells, which never do.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption summary".split())
CELLS = frozenset("td th tr tbody thead tfoot caption".split())
CONTAINER, PART, FIXED = 0, 1, 2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_WORDS, _DIGITS = re.compile(r"[a-z]+"), re.compile(r"\d+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element. size: characters of its own text, inline elements included; all: those of its subtree as well."""

    __slots__ = ("all", "attributes", "children", "gone", "hash", "inside", "kind", "size", "slot", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children, self.gone = tag, attributes, [], False


class _Open:
    """The open elements, with the places of each tag among them: every question takes the same time however many there are."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of the tags, 0 if none is open."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def end(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()


def parse(text: str) -> Node:
    """The tree of a page; children are nodes and undecoded strings. Linear in the text."""
    root = Node("#root", {})
    opened, at, n = _Open(root), 0, len(text)
    while at < n:
        found = _TOKEN.search(text, at)
        if not found:
            opened.stack[-1].children.append(text[at:])
            break
        if found.start() > at:
            opened.stack[-1].children.append(text[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if name is None:
            if found[0].startswith("<![CDATA["):
                opened.stack[-1].children.append(entities.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag, ending, rest = name.lower(), found[1] or found[4], found[3] or found[6] or ""
        if ending:
            place = opened.last(tag)
            if place and not (tag in WEAK and opened.last(*BARRIER) > place):
                opened.end(place)
            continue
        ended = [p for own in ENDED_BY.get(tag, ()) if (p := opened.last(own)) > opened.last(*SCOPE[own])]
        if ended:
            opened.end(min(ended))
        node = Node(tag, {a.lower(): b or c or d or "" for a, b, c, d in _ATTRIBUTE.findall(rest)} if "=" in rest or "hidden" in rest.lower() else {})
        opened.stack[-1].children.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(text, at)
            stop = end.start() if end else n
            node.children.append(text[at:stop])
            at = end.end() if end else n
        elif tag not in VOID:
            opened.push(node)
    return root


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", url or "")
    return found[1].lower() if found else ""


def read_page(text: str | None, url: str | None) -> list[Node]:
    """All elements, parents first, with slot, hash, kind and sizes; without recursion, as pages can nest deeply."""
    root = parse(text or "")
    root.slot, root.inside = xxhash.xxh64_intdigest(host_of(url)), False
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        for x in node.children:
            if isinstance(x, Node):
                name = f"{x.tag}.{_DIGITS.sub('', x.attributes.get('class', ''))}" if x.attributes else x.tag
                x.slot = node.slot if x.tag in INLINE else xxhash.xxh64_intdigest(name, seed=node.slot)
                x.inside = node.inside or x.tag in ("article", "main")
        todo.extend(x for x in reversed(node.children) if isinstance(x, Node))
    holds: set[int] = set()  # elements that hold an article or main
    for node in reversed(nodes):
        h = xxhash.xxh64(f"{node.tag}\0{node.attributes.get('class', '')}\0{node.attributes.get('id', '')}", seed=node.slot)
        node.size = node.all = 0
        for x in node.children:
            if isinstance(x, Node):
                if x.tag in UNSHOWN:
                    continue
                h.update(struct.pack("<Q", x.hash))
                node.size += x.size if x.tag in INLINE else 0
                node.all += x.all
                if x.tag in ("article", "main") or id(x) in holds:
                    holds.add(id(node))
            else:
                own = " ".join(x.split())
                h.update(b"\1" + own.encode("utf-8", "surrogatepass"))
                node.size += len(own)
                node.all += len(own)
        node.hash = h.intdigest()
        if node.tag in UNSHOWN:
            node.size = node.all = 0
        fixed = node.tag in CELLS or node.tag in ("#root", "html", "body", "article", "main") or id(node) in holds
        node.kind = FIXED if fixed or node.inside and node.tag in PARTS else PART if node.tag in PARTS else CONTAINER
    return nodes


def _said(node: Node, whole: int, codes: dict[int, int]) -> bool:
    """The fallback: True for elements that hold no article text by tag, class, id or role."""
    if node.tag in ASIDES or node.tag == "header" and not node.inside:
        return True
    most = 2 * node.all > whole  # of the page's text
    if node.tag == "form":
        return not most
    a = node.attributes
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(a.get("style", "")):
        return True
    if a.get("role", "").lower() in ROLES:
        return True
    if most or node.tag in ("article", "main", "body", "html"):
        return False
    differs = codes.get(node.slot) == DIFFERS
    for name in f"{a.get('class', '')} {a.get('id', '')}".split():
        words = _WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
        if words and words[0] not in ("no", "has", "with", "without", "is"):
            if any(w in VARYING for w in words) or not differs and any(w in RECURRING and not (w == "header" and node.inside) for w in words):
                return True
    return False


#: What the counts say of a hash or slot: it is template; what stands in the slot differs from page to page.
TEMPLATE, DIFFERS = 1, 2


def extract(nodes: list[Node], codes: dict[int, int], fallback: bool = True) -> str:
    """The main text of a page. codes: TEMPLATE or DIFFERS by hash and slot, of those that the page has."""
    whole = nodes[0].all
    for x in nodes:
        template = x.kind != FIXED and (codes.get(x.hash) == TEMPLATE or x.kind == CONTAINER and x.tag not in INLINE and codes.get(x.slot) == TEMPLATE)
        x.gone = template or x.tag in UNSHOWN or fallback and _said(x, whole, codes)
    roots = _roots(nodes[0]) if fallback else [nodes[0]]
    blocks, line = [], []

    def end() -> None:
        text = " ".join(entities.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for root in roots:
        todo = [root]
        while todo:
            x = todo.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                line.append(x)
            elif not x.gone:
                if x.tag == "br":
                    line.append(" ")
                    continue
                if x.tag in BLOCKS:
                    end()
                    todo.append(None)
                todo.extend(reversed(x.children))
        end()
    return "\n\n".join(blocks)


def _roots(top: Node) -> list[Node]:
    """The outermost article and main elements that are left, or the whole page; articles that are teasers go."""
    roots, articles, todo = [], [], [(top, True, True)]
    while todo:
        node, outermost, first = todo.pop()
        if node.gone:
            continue
        if node.tag in ("article", "main") and outermost:
            roots.append(node)
            outermost = False
        if node.tag == "article" and first:
            articles.append(node)
            first = False
        todo.extend((x, outermost, first) for x in reversed(node.children) if isinstance(x, Node))
    most = max((x.all for x in articles), default=0)
    for x in articles:
        x.gone = 4 * x.all < most
    return roots or [top]


def count_subtrees(pages: DataFrame) -> DataFrame:
    """slot, h, page (hash of host and html), size, kind: the block elements of every page, each subtree once a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "html", 4_000_000):
                slots, hashes, page, size, kind = [], [], [], [], []
                for url, text, key in zip(column(part, "url"), column(part, "html"), column(part, "page"), strict=True):
                    own = {x.hash: x for x in read_page(text, url)[1:] if x.all and x.tag not in INLINE and x.tag not in UNSHOWN and x.tag not in ("html", "body")}
                    hashes += own
                    slots += [x.slot for x in own.values()]
                    size += [x.size for x in own.values()]
                    kind += [x.kind for x in own.values()]
                    page += [key] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (slots, hashes)] + [pa.array(page, pa.int64()), pa.array(size, pa.int32()), pa.array(kind, pa.int32())], names=["slot", "h", "page", "size", "kind"])

    return _keyed(pages.where("html != ''").select("url", "html")).transform(arrow, run, "slot long, h long, page long, size int, kind int")


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("page", F.xxhash64(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "//([^/?#]*)", 1)), "html"))


def judge(rows: DataFrame, pool: list[str]) -> DataFrame:
    """key (a hash or slot), code, n (pages that have it), of the rows that count_subtrees gives."""
    rows = cut(rows.dropDuplicates(["h", "page"]), "html-subtrees", pool)
    alone = rows.groupBy("h").agg(F.count("*").alias("n"), F.max("page").alias("page"), F.max("size").alias("size")).where("n = 1")
    own = alone.groupBy("page").agg(F.sum("size").alias("own"))
    whole = rows.groupBy("page").agg(F.sum("size").alias("whole"))
    speaks = whole.join(own, "page").where(F.col("own") >= OWN_SHARE * F.col("whole")).where("whole > 0").select("page")
    told = cut(rows.join(speaks, "page", "left_semi"), "html-told", pool)
    subtrees = cut(told.groupBy("slot", "h").agg(F.count("*").alias("n"), F.max("kind").alias("kind")), "html-counts", pool)
    again = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    stood = told.groupBy("slot", "page").agg(F.lit(1).alias("one")).groupBy("slot").agg(F.count("*").alias("pages"))
    slots = subtrees.groupBy("slot").agg(F.sum("n").alias("rows"), again.alias("again"), F.max("kind").alias("kind")).join(stood, "slot")
    slots = cut(slots, "html-slots", pool)
    often = subtrees.drop("kind").where(F.col("n") >= MIN_PAGES).join(slots, "slot")
    often = often.where(f"kind < {FIXED} and (2 * n >= pages or kind = {CONTAINER} and 2 * again >= rows)")
    code = F.when((F.col("kind") == CONTAINER) & (F.col("pages") >= MIN_PAGES) & (F.col("again") >= SLOT_SHARE * F.col("rows")), TEMPLATE)
    code = code.when((F.col("pages") >= KNOWN_PAGES) & (F.col("again") <= TEXT_SHARE * F.col("rows")), DIFFERS)
    known = slots.select(F.col("slot").alias("key"), code.alias("code"), F.col("pages").alias("n")).where("code is not null")
    return often.select(F.col("h").alias("key"), F.lit(TEMPLATE).alias("code"), "n").unionByName(known)


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract_pages(pages: DataFrame, templates: bool = True, fallback: bool = True) -> DataFrame:
    """page_id, url, text, n_chars; with either of the two ways of finding what isn't text switched off if asked for."""
    pool: list[str] = []
    table = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    if not templates:
        return table.transform(arrow, _extractor(table.sparkSession.sparkContext.broadcast((np.empty(0, np.int64), np.empty(0, np.int8))), fallback), EXTRACTED)
    rows = count_subtrees(pages)
    found = cut(judge(rows, pool), "html-templates", kept := [])
    if found.count() * 9 <= BROADCAST:
        discard(pool)
        sent = found.select("key", F.col("code").cast("byte").alias("code")).orderBy("key").toArrow()
        discard(kept)
        keys, codes = (sent.column(c).to_numpy() for c in ("key", "code"))
        return table.transform(arrow, _extractor(table.sparkSession.sparkContext.broadcast((keys, codes)), fallback), EXTRACTED)
    subtrees = table.sparkSession.read.parquet(pool[0])  # what judge() wrote first
    met = salted_join(subtrees.select("page", F.explode(F.array("h", "slot")).alias("key")), found, "key")
    own = cut(met.groupBy("page").agg(F.collect_set(F.struct("key", "code")).alias("own")), "html-own")
    discard(pool + kept)
    met = _keyed(table).join(own, "page", "left").select("page_id", "url", "html", "own")
    return met.transform(arrow, _extractor(None, fallback), EXTRACTED)


def _extractor(sent, fallback: bool):
    """sent: the sorted keys and their codes; None if each row brings its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "html", 4_000_000):
                texts = []
                owns = [None] * part.num_rows if sent else column(part, "own")
                for url, text, own in zip(column(part, "url"), column(part, "html"), owns, strict=True):
                    nodes = read_page(text, url)
                    codes = _found(nodes, *sent.value) if sent else {x["key"] % 2**64: x["code"] for x in own or ()}
                    texts.append(extract(nodes, codes, fallback))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def _found(nodes: list[Node], keys: np.ndarray, codes: np.ndarray) -> dict[int, int]:
    """The codes of a page's hashes and slots, looked up in the sorted keys."""
    if not len(keys):
        return {}
    own = np.array([x.hash for x in nodes] + [x.slot for x in nodes], np.uint64).view(np.int64)
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == own)
    return dict(zip(own[hit].view(np.uint64).tolist(), codes[at[hit]].tolist(), strict=True))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))
