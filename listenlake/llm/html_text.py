"""Main text of web pages by wrapper induction: what same-host pages have in common is template."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_arrow, stored

# A reference node is template if it has the same text on this share of the pages aligned with it ...
TEMPLATE_SHARE = 0.8
# ... and on so many pages at least.
TEMPLATE_PAGES = 3
# References up to this number (some 10 KB each) are broadcast with their wrappers; more are joined.
BROADCAST_HOSTS = 2_000
# Alignments of page structures that a Python worker remembers; it then starts anew.
REMEMBERED_ALIGNMENTS = 5_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
# Which open elements a start tag ends, and where the search for them stops.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}
# What makes a page's layout: such elements in so many levels below the body.
STRUCTURE = frozenset("div section main article aside nav header footer form table center search".split())
LAYOUT_LEVELS = 2
STOPS = frozenset("html body table ul ol dl article section main td th div nav aside footer header".split())

# What marks elements as no main text. Marks pass to what is inside.
DOUBT, WRAPPER, SURE = 1, 2, 3
# Elements: always, whatever is inside, and wrappers from which an article or main element is taken out again.
BESIDE = frozenset(
    "nav footer aside script style noscript template svg math iframe button select option textarea dialog "
    "menu head title search label object canvas audio video".split()
)
WRAPPERS = {"header": WRAPPER, "form": DOUBT}
# Whole classes and ids, the first for comments, in which articles stand too.
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
BESIDE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "newsletter subscribe signup login pagination pager toolbar".split()
)
# Words that stand around real text as well: the host's template decides. So it does for parts of a class or id.
DOUBT_WORDS = frozenset("notice share sharing social related recommended reply replies respond widget skip".split())
# Classes and ids with such a part tell of something else than their own element: has-sidebar, page-with-menu.
TELLING = frozenset("has have no not non with without is".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Element:
    tag: str
    label: str
    mark: int
    main: bool
    parent: Element | None
    children: list = field(default_factory=list)  # elements that are blocks, and text
    number: int = -1


def _mark(tag: str, attributes: str) -> int:
    """How surely an element is no main text, by itself."""
    if tag in BESIDE:
        return SURE
    if tag in ("html", "body", "main"):
        return 0
    mark = WRAPPERS.get(tag, 0)
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        tokens = "".join(values).lower().split()
        if not COMMENT_WORDS.isdisjoint(tokens) and name.lower() != "role":
            return SURE
        if tag == "article":
            continue
        if name.lower() == "role":
            mark = max(mark, 0 if BESIDE_ROLES.isdisjoint(tokens) else WRAPPER, DOUBT if "form" in tokens else 0)
        elif not BESIDE_WORDS.isdisjoint(tokens):
            mark = WRAPPER
        elif mark == 0:
            mark = DOUBT if any(map(_in_doubt, tokens)) else 0
    return mark


def _in_doubt(token: str) -> bool:
    parts = set(_WORDS.split(token))
    return not (COMMENT_WORDS | BESIDE_WORDS | DOUBT_WORDS).isdisjoint(parts) and TELLING.isdisjoint(parts)


def _mark_inside(parent: Element, tag: str, attributes: str) -> int:
    """The mark of an element in ``parent``: an article or main element leaves the marks of wrappers, unless it is
    itself in another one and the wrapper with it."""
    own, above = _mark(tag, attributes), parent.mark
    if tag in ("article", "main") and above < (WRAPPER if parent.main else SURE):
        above = 0
    return max(own, above)


def parse(page: str) -> Element:
    """The block elements of a page as a tree, with the text that stands in each; inline tags vanish into text.

    Made for pages as they come: what is not closed ends with its parent, a new paragraph or
    list item ends the one before, stray end tags and unfinished tags are skipped.
    """
    root = Element("#root", "#root", 0, False, None)
    top, at, size = root, 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            top.children.append(page[at:])
            break
        if token.start() > at:
            top.children.append(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if tag in BLOCKS:
                node = top
                while node is not root and node.tag != tag:
                    node = node.parent
                if node is not root:
                    top = node.parent
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.IGNORECASE).search(page, at)
            at = end.end()
            continue
        if tag == "br":
            top.children.append(" ")
        if tag not in BLOCKS:
            continue
        node = top
        if node.tag == "p":
            top = node = node.parent
        ends = ENDS.get(tag, frozenset())
        while ends and node is not root:
            if node.tag in ends:
                top = node.parent
                if tag not in ("tr",):
                    break
            elif node.tag in STOPS:
                break
            node = node.parent
        attributes = token[3]
        mark = _mark_inside(top, tag, attributes)
        new = Element(tag, tag + _class(attributes), mark, top.main or tag in ("article", "main"), top)
        top.children.append(new)
        if tag not in VOID and not attributes.endswith("/"):
            top = new
    return root


def _class(attributes: str) -> str:
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        if name.lower() == "class":
            return "." + " ".join(sorted("".join(values).split()))
    return ""


def number(root: Element) -> list[Element]:
    """All elements in page order, each with its number."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        node.number = len(out)
        out.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return out


def _inner(node: Element) -> list[Element]:
    return [c for c in node.children if not isinstance(c, str)]


def shape(root: Element) -> str:
    """The tree without its text, as a string."""
    out: list[str] = []
    stack: list[Element | None] = [root]
    while stack:
        node = stack.pop()
        if node is None:
            out.append(")")
        else:
            out.append(f"{node.label}(")
            stack.append(None)
            stack.extend(reversed(_inner(node)))
    return "".join(out)


def layout(root: Element) -> int:
    """A hash of the kinds of structural elements in the top levels, without numbers in classes."""
    kinds: set[str] = set()
    stack = [(root, "", 0)]
    while stack:
        node, path, level = stack.pop()
        for child in node.children:
            if isinstance(child, str):
                continue
            if child.tag in ("html", "body"):
                stack.append((child, path, level))
            elif child.tag in STRUCTURE:
                kind = f"{path}/{_DIGITS.sub('', child.label)}"
                kinds.add(kind)
                if level + 1 < LAYOUT_LEVELS:
                    stack.append((child, kind, level + 1))
    found = xxhash.xxh64_intdigest("\n".join(sorted(kinds)).encode())
    return found - (1 << 64) if found >> 63 else found


def text_of(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


def blocks_of(nodes: list[Element]) -> list[tuple[int, str]]:
    """(element number, text) of each stretch of text between block borders, in page order."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[Element, int]] = [(nodes[0], 0)]
    pieces: list[str] = []

    def close(node: Element) -> None:
        text = text_of(pieces) if pieces else ""
        pieces.clear()
        if text:
            out.append((node.number, text))

    while stack:
        node, i = stack.pop()
        while i < len(node.children) and isinstance(node.children[i], str):
            pieces.append(node.children[i])
            i += 1
        close(node)
        if i < len(node.children):
            stack.append((node, i + 1))
            stack.append((node.children[i], 0))
    return out


def match_trees(a: Element, b: Element) -> list[tuple[int, int]]:
    """Simple tree matching: the largest set of pairs of elements that keeps labels, parents and order.

    For two elements of one label, the best order-keeping assignment of their children is found
    by dynamic programming over the scores of all pairs of children.
    """
    if a.label != b.label:
        return []
    # Pairs of elements of one label at one depth that both have children; pages may be thousands of levels deep.
    mine: dict[int, list[Element]] = {}
    other: dict[int, list[Element]] = {}
    found: set[tuple[int, int]] = set()
    open_ = [(a, b)]
    while open_:
        x, y = open_.pop()
        xs, ys = mine.setdefault(x.number, _inner(x)), other.setdefault(y.number, _inner(y))
        if xs and ys:
            found.add((x.number, y.number))
            open_ += [(cx, cy) for cx in xs for cy in ys if cx.label == cy.label and cx.children and cy.children]

    tables: dict[tuple[int, int], list[list[int]]] = {}

    def score(x: Element, y: Element) -> int:
        if x.label != y.label:
            return 0
        table = tables.get((x.number, y.number))
        return table[-1][-1] + 1 if table else 1

    # Elements are numbered in page order, so children have the greater numbers: they are scored first.
    for i, j in sorted(found, reverse=True):
        table = [[0] * (len(other[j]) + 1)]
        for cx in mine[i]:
            above, row = table[-1], [0]
            for k, cy in enumerate(other[j]):
                row.append(max(above[k + 1], row[k], above[k] + score(cx, cy)))
            table.append(row)
        tables[i, j] = table

    pairs: list[tuple[int, int]] = []
    traced = [(a, b)]
    while traced:
        x, y = traced.pop()
        pairs.append((x.number, y.number))
        table = tables.get((x.number, y.number))
        if table is None:
            continue
        xs, ys = mine[x.number], other[y.number]
        i, j = len(xs), len(ys)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                traced.append((xs[i], ys[j]))
    return pairs


class _Aligner:
    """Alignments with reference pages, remembered by the shapes of both trees."""

    def __init__(self) -> None:
        self.references: dict[str, tuple[Element, str, dict[int, str]]] = {}
        self.known: dict[tuple[str, str], dict[int, int]] = {}

    def align(self, root: Element, reference: str) -> tuple[dict[int, int], dict[int, str]]:
        """Reference element of each element of ``root``, and the text of each reference element."""
        if len(self.known) + len(self.references) > REMEMBERED_ALIGNMENTS:
            self.references.clear()
            self.known.clear()
        if reference not in self.references:
            other = parse(reference)
            self.references[reference] = (other, shape(other), _texts(blocks_of(number(other))))
        other, other_shape, texts = self.references[reference]
        key = (shape(root), other_shape)
        if key not in self.known:
            self.known[key] = dict(match_trees(root, other))
        return self.known[key], texts


def _texts(blocks: list[tuple[int, str]]) -> dict[int, str]:
    out: dict[int, str] = {}
    for at, text in blocks:
        out[at] = f"{out[at]}\n{text}" if at in out else text
    return out


_PARSED = (
    "page_id {id}, url string, host string, layout long, blocks array<struct<text:string,node:int,main:boolean,doubt:boolean>>, "
    "met array<int>, same array<int>"
)
_BLOCK = pa.struct([("text", pa.string()), ("node", pa.int32()), ("main", pa.bool_()), ("doubt", pa.bool_())])


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, whose last column is html, and the layout of each page with text."""
    for batch in batches:
        found: list[int | None] = []
        for page in batch.column(batch.num_columns - 1):
            root = parse(page.as_py() or "")
            found.append(layout(root) if blocks_of(number(root)) else None)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "layout"])


def _layouts_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _layouts(batches):
        keep = [i for i, name in enumerate(batch.schema.names) if name != "html"]
        yield batch.select(keep)


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each page that may be main text, and where its reference page has the same text."""
    aligner = _Aligner()
    for batch in batches:
        rows: list[list] = [[], [], []]
        for page, reference in zip(batch.column(4), batch.column(5), strict=True):
            root = parse(page.as_py() or "")
            nodes = number(root)
            blocks = blocks_of(nodes)
            to, texts = aligner.align(root, reference.as_py() or "")
            mine = _texts(blocks)
            met = [to[at] for at in mine if at in to]
            same = [to[at] for at, text in mine.items() if at in to and texts.get(to[at]) == text]
            if len(same) == len(mine) == len(texts):
                met, same = [], []  # the reference page itself, or a copy of it, tells nothing
            rows[0].append(
                [
                    {"text": text, "node": to.get(at, -1), "main": nodes[at].main, "doubt": nodes[at].mark == DOUBT}
                    for at, text in blocks
                    if nodes[at].mark <= DOUBT
                ]
            )
            rows[1].append(met)
            rows[2].append(same)
        columns = [
            batch.column(0),
            batch.column(1),
            batch.column(2),
            batch.column(3),
            pa.array(rows[0], pa.list_(_BLOCK)),
            pa.array(rows[1], pa.list_(pa.int32())),
            pa.array(rows[2], pa.list_(pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "layout", "blocks", "met", "same"])


def main_texts(
    pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES, broadcast_hosts: int = BROADCAST_HOSTS
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Pages of a host with the same layout, the kinds of structural elements in the top levels,
    have as reference the one of the smallest id; empty pages are none. Layouts of at most
    ``least`` pages use the reference of the host's commonest layout. The element trees of all
    pages are aligned with their reference's by simple tree matching; reference elements whose
    text stays the same on ``share`` of its pages, ``least`` at least, are template, the others slots. Counts are summed over all pages before they meet, so a host may have any
    number of pages.

    A page's text is that of its slots. Only where no slot has text, or there are fewer than
    ``least`` pages besides the reference to teach a template, is it that of the article or main
    element, if there is one with text. Menus, headers, footers, sidebars, adverts and comments,
    known by element, role or a whole class or id, are left out of both. Forms, notices, share
    and related blocks, and classes that only hold such a word (site-footer), are in doubt: the
    template decides; where nothing was learned they are left out if there is other text. An
    article or main element inside a marked wrapper counts as unmarked. Copies of the reference page count for no
    template. Null and empty html give an empty text, unfinished html what there is; a null or
    odd url is a host of its own kind (none). Repeated rows stay. Other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), "html")
    id_type = pages.schema["page_id"].dataType.simpleString()

    digest = F.xxhash64("html").alias("digest")
    seen = map_arrow(rows.select("host", "page_id", digest, "html"), _layouts_only, f"host string, page_id {id_type}, digest long, layout long")
    layouts = stored(
        seen.filter("layout IS NOT NULL")
        .groupBy("host", "layout")
        .agg(F.min(F.struct("page_id", "digest")).alias("page"), F.count("*").alias("pages")),
        "layouts",
    )
    commonest = layouts.groupBy("host").agg(F.min_by("layout", F.struct(-F.col("pages"), "layout")).alias("commonest"))
    kept = layouts.join(commonest, "host").filter((F.col("pages") > least) | (F.col("layout") == F.col("commonest")))
    kept = stored(
        kept.select("host", "layout", "page.digest", F.col("page.page_id").alias("of_page"), (F.col("layout") == F.col("commonest")).alias("common")),
        "layouts-kept",
    )
    few_hosts = kept.count() <= broadcast_hosts
    of_page = F.col("page_id").eqNullSafe(F.col("of_page"))
    references = (
        rows.select("host", "page_id", digest, F.col("html").cast("string").alias("reference"))
        .join(F.broadcast(kept) if few_hosts else kept, ["host", "digest"])
        .filter(of_page)
        .dropDuplicates(["host", "layout"])
        .select("host", "layout", "common", "reference")
    )
    references = stored(references, "references")
    own = references.select("host", "layout", "reference", F.col("layout").alias("own"))
    common = references.filter("common").select("host", F.col("layout").alias("common"), F.col("reference").alias("common_reference"))
    if few_hosts:
        own, common = F.broadcast(own), F.broadcast(common)
    laid = map_arrow(rows, _layouts, f"page_id {id_type}, url string, host string, html string, layout long")
    read = laid.join(own, ["host", "layout"], "left").join(common, "host", "left").select(
        "page_id", "url", "host", F.coalesce("own", "common").alias("layout"), "html",
        F.coalesce("reference", "common_reference").alias("reference"),
    )
    read = stored(map_arrow(read, _read_pages, _PARSED.format(id=id_type)), "parsed-pages")

    key = ["host", "layout"]
    met = read.select(*key, F.explode("met").alias("node")).groupBy(*key, "node").agg(F.count("*").alias("pages"))
    same = read.select(*key, F.explode("same").alias("node")).groupBy(*key, "node").agg(F.count("*").alias("equal"))
    template = met.join(same, [*key, "node"]).filter((F.col("equal") >= least) & (F.col("equal") >= F.col("pages") * share))
    taught = read.filter(F.size("met") > 0).groupBy(*key).agg(F.count("*").alias("pages")).filter(F.col("pages") >= least)
    lists = template.groupBy(*key).agg(F.collect_list("node").alias("template"))
    wrappers = taught.select(*key, F.lit(True).alias("taught")).join(lists, key, "left")
    if few_hosts:
        wrappers = F.broadcast(wrappers)

    wrapped = read.join(wrappers, key, "left")
    sure = F.filter("blocks", lambda b: ~b["doubt"])
    article = F.filter(sure, lambda b: b["main"])
    slots = F.filter(
        "blocks", lambda b: ~F.coalesce(F.array_contains(F.col("template"), b["node"]), F.lit(False))
    )
    article_or_doubt = F.filter("blocks", lambda b: b["main"])
    narrowed = (
        F.when(F.size(article) > 0, article)
        .when(F.size(article_or_doubt) > 0, article_or_doubt)
        .when(F.size(sure) > 0, sure)
        .otherwise(F.col("blocks"))
    )
    by_slots = F.coalesce("taught", F.lit(False)) & ((F.size(slots) > 0) | (F.size(article_or_doubt) == 0))
    chosen = F.when(by_slots, slots).otherwise(narrowed)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n")
    return wrapped.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
