"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: tags with their place in the tree, and whole text blocks with
theirs. Tokens that occur equally often on every page of a host share an occurrence vector and
form an equivalence class. A class of enough tokens on enough pages is valid if its tokens stand
in one order on all pages; the valid classes of a host, nested by the pages and gaps they stand
in, are its template, and what lies between template tokens are slots, which hold the data.

A vector is never built: its pages are summed up in a 64-bit signature, so a host of any size is
an aggregate that combines on the map side. Order is proved by the smallest and largest place of
each token, counted from the start and from the end of the page.

A page holds all tokens of a class or none, so the classes it holds are its own template, whatever
kinds of pages a host has. Classes on most pages of the host are its outer level; those on a
tenth or more are nested in them and are the templates of its kinds of pages.

The text is what is left in slots of the page's article: blocks of template text, and blocks
inside elements that by tag, role or class are menus, headers, footers, sidebars, notices,
adverts, forms or comments, are left out. A class name that holds such a word beside others
(related-work, share-price) proves nothing by itself: its element is furniture if it stands on a
tenth or more of the host's pages, and part of the article otherwise.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import stored

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|math|iframe|object|canvas|title|textarea|select)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+)>"
    r"|</?[a-zA-Z!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTES = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")

# Element names and words of HTML and of common page markup.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track".split())
CLOSES_ITSELF = frozenset("p li tr td th dt dd option".split())
BOILER_TAGS = frozenset("nav footer aside form button dialog menu head fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs masthead footer sidebar widget related recommended recommendations share sharing social "
    "comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe signup login searchform pagination pager toolbar form".split()
)
# Words that say nothing about the content when they stand beside one of the above.
NEUTRAL_WORDS = frozenset(
    "a all area article articles bar block body bottom box btn button buttons card cards center col column container content "
    "count entry fixed footer frame global grid group head header heading icon icons inline inner item items js l label left "
    "link links list main media message new node outer page panel post posts primary reader right row secondary section site "
    "slot small sticky strip sub tab text the thread title top ui unit user users view widgets wrap wrapper".split()
)
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

TAG, TEXT = 0, 1
MIN_PAGES, MIN_TOKENS = 3, 3
TEXT_PAGES = 8  # a text block is template text on no fewer pages
MOST, KIND = 0.9, 0.1  # shares of a host's pages: its outer template, the template of a kind of pages
# Elements that group blocks and so can be an article; others are parts of a text.
GROUPS = frozenset("body div section article main center td html".split())


@dataclass
class Block:
    token: int
    place: int  # among the tokens of the page
    text: str
    boiler: bool
    main: bool
    link_chars: int
    groups: tuple[int, ...]  # the grouping elements around it, outermost first, by number
    doubts: tuple[int, ...]  # tokens of the elements around it whose names may mark furniture


@dataclass
class Element:
    tag: str
    path: int
    boiler: bool
    main: bool
    header: bool
    groups: tuple[int, ...]
    doubts: tuple[int, ...]


def digest(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)))


def names_furniture(name: str) -> tuple[bool, bool]:
    """Whether a class name or id says furniture, and whether it only holds such a word among others."""
    words = {w for w in re.split(r"[^a-z]+", name) if w}
    if not words & BOILER_WORDS:
        return False, False
    sure = words <= BOILER_WORDS | NEUTRAL_WORDS
    return sure, not sure


def marked_boiler(tag: str, attributes: str) -> tuple[bool, bool, bool, str]:
    """Whether an element is furniture, may be, is a header, and the names that mark its place."""
    words, role, hidden, name = set(), "", False, ""
    sure = doubtful = False
    for key, a, b, c, bare in ATTRIBUTES.findall(attributes) if attributes.strip() else ():
        key, value = key.lower() or bare.lower(), (a or b or c).lower()
        if key in ("class", "id"):
            words.update(re.split(r"[^a-z0-9]+", value))
            for one in value.split():
                says, may = names_furniture(one)
                sure, doubtful = sure | says, doubtful | may
            name += f" {key}={re.sub('[0-9]+', '0', value)}"
        elif key == "role":
            role = value
        hidden |= key == "hidden" or (key == "aria-hidden" and value == "true")
        hidden |= key == "style" and "display:none" in value.replace(" ", "")
    frame = tag in ("html", "body", *MAIN_TAGS)
    boiler = tag in BOILER_TAGS or role in BOILER_ROLES or sure or hidden
    return boiler and not frame, doubtful and not frame, tag == "header" or "header" in words, name


def parse(page: str) -> tuple[list[tuple[int, int]], list[Block]]:
    """The tokens of a page as (token, kind) in order, and its text blocks."""
    tokens: list[tuple[int, int]] = []
    blocks: list[Block] = []
    stack = [Element("", 0, False, False, False, (0,), ())]
    held: list[str] = []
    link_chars, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal link_chars
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                token = digest(top.path, "#", text)
                # an article's own header keeps its headings
                heading = top.tag in HEADINGS and any(e.main for e in stack)
                furniture = top.boiler or (top.header and not heading)
                place = len(tokens)
                blocks.append(Block(token, place, text, furniture, top.main, link_chars, top.groups, top.doubts))
                tokens.append((token, TEXT))
        link_chars = 0

    for match in MARKUP.finditer(page):
        between = page[at : match.start()]
        at = match.end()
        if between:
            held.append(between)
            if in_link:
                link_chars += len(between)
        tag = (match.group(3) or "").lower()
        if not tag:
            continue
        closing = bool(match.group(2))
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        flush()
        if closing:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), 0)
            if depth:
                tokens.append((digest(stack[depth].path, "/"), TAG))
                del stack[depth:]
            continue
        if tag == "hr":
            continue
        if stack[-1].tag == "p" or (tag in CLOSES_ITSELF and stack[-1].tag == tag):
            stack.pop()
        boiler, doubtful, header, name = marked_boiler(tag, match.group(4))
        top = stack[-1]
        path = digest(top.path, tag, name)
        tokens.append((path, TAG))
        if not match.group(4).rstrip().endswith("/") or tag not in VOID:
            main = top.main or tag in MAIN_TAGS
            groups = (*top.groups, len(tokens)) if tag in GROUPS else top.groups
            doubts = (*top.doubts, path) if doubtful else top.doubts
            stack.append(Element(tag, path, top.boiler or boiler, main, top.header or header, groups, doubts))
    if page[at:] and not page[at:].lstrip().startswith("<"):
        held.append(page[at:])
    flush()
    return tokens, blocks


def page_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and distinct token: how often, and first and last place from either end."""
    for batch in batches:
        for piece in range(0, batch.num_rows, 500):
            part = batch.slice(piece, 500)
            rows = []
            hosts, keys = part.column("host").to_pylist(), part.column("page_key").to_pylist()
            for host, key, page in zip(hosts, keys, part.column("html").to_pylist(), strict=True):
                tokens, _ = parse(page or "")
                counts = Counter(tokens)
                first: dict = {}
                for place, token in enumerate(tokens):
                    first.setdefault(token, place)
                size = len(tokens)
                rows += [(host, t - (1 << 63), kind, key, n, first[t, kind], size - first[t, kind])
                         for (t, kind), n in counts.items()]
            names = ["host", "token", "kind", "page_key", "n", "front", "back"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def _classes(pages: DataFrame) -> DataFrame:
    """All classes of tokens on three pages or more: with ``ordered``, the tokens that stand in one order."""
    found = pages.select("host", "page_key", "html").mapInArrow(
        page_tokens, "host string, token long, kind int, page_key long, n int, front int, back int"
    )
    vectors = (
        found.groupBy("host", "token", "kind")
        .agg(
            F.count("*").alias("pages"),
            F.sum("n").alias("total"),
            F.bit_xor(F.xxhash64("page_key", "n")).alias("vector"),
            F.min("front").alias("front_min"),
            F.max("front").alias("front_max"),
            F.min("back").alias("back_min"),
            F.max("back").alias("back_max"),
        )
        .where(F.col("pages") >= MIN_PAGES)
    )
    hosts = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    fields = ["front_min", "token", "kind", "front_max", "back_min", "back_max"]
    classes = vectors.groupBy("host", "vector", "pages", "total").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("tokens")
    )

    def in_order(token: Column, i: Column) -> Column:
        before = F.get("tokens", i - 1)
        after = (before["front_max"] < token["front_min"]) | (before["back_min"] > token["back_max"])
        return (i == 0) | after

    return classes.withColumn("ordered", F.filter("tokens", in_order)).join(hosts, "host")


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """Valid classes: (host, host_pages, pages, total, tokens), tokens in the order they stand in."""
    return (
        _classes(pages)
        .where(F.size("ordered") >= MIN_TOKENS)
        .select("host", "host_pages", "pages", "total", F.col("ordered").alias("tokens"))
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, skeleton, kinds, constants, regular): the nested template of every host.

    ``skeleton`` are the tags of valid classes with one occurrence a page on nine tenths of the
    host's pages, in the order of their places; ``kinds`` those on a tenth or more, of which a page
    holds the ones of its kind. ``constants`` are text blocks of classes on most pages, or of those
    that hold tags of a kind too; on hosts, and in classes, of enough pages to tell them from a
    repeated line. ``regular`` are all tags on a tenth or more of the pages. Tokens on a tenth of
    the pages are at most ten times those of a page, so a template does not grow with its host.
    """

    def of(tokens: str, kind: int) -> Column:
        return F.filter(tokens, lambda t: t["kind"] == kind)

    valid = F.size("ordered") >= MIN_TOKENS
    most = F.col("pages") >= MOST * F.col("host_pages")
    once = valid & (F.col("total") == F.col("pages"))
    placed = F.transform(of("ordered", TAG), lambda t: F.struct(t["front_min"], t["token"]))
    structural = once & (F.size(of("ordered", TAG)) >= MIN_TOKENS)
    constant = valid & (most | structural) & (F.col("pages") >= MOST * TEXT_PAGES) & (F.col("host_pages") >= TEXT_PAGES)

    def tokens_of(found: Column) -> Column:
        return F.flatten(F.collect_list(found))

    def in_places(found: Column) -> Column:
        return F.transform(F.array_sort(tokens_of(found)), lambda t: t["token"])

    return (
        _classes(pages)
        .where(F.col("pages") >= KIND * F.col("host_pages"))
        .groupBy("host")
        .agg(
            in_places(F.when(once & most, placed)).alias("skeleton"),
            in_places(F.when(once, placed)).alias("kinds"),
            tokens_of(F.when(constant, F.transform(of("ordered", TEXT), lambda t: t["token"]))).alias("constants"),
            tokens_of(F.transform(of("tokens", TAG), lambda t: t["token"])).alias("regular"),
        )
    )


def slot_of(tokens: list[tuple[int, int]], skeleton: set[int]) -> list[int]:
    """For each token the number of template tags up to it: the slot it lies in."""
    slots, slot = [], 0
    for token, _ in tokens:
        slot += token - (1 << 63) in skeleton
        slots.append(slot)
    return slots


def article_at(kept: list[Block], slots: list[int]) -> int:
    """The smallest grouping element around the fullest slot, text of links not counted; of equal slots the first."""
    mass: Counter[int] = Counter()
    for block in kept:
        mass[slots[block.place]] += max(0, len(block.text) - block.link_chars)
    fullest = max(mass, key=lambda slot: (mass[slot], -slot))
    inside = [b.groups for b in kept if slots[b.place] == fullest]
    depth = next((d for d, ids in enumerate(zip(*inside, strict=False)) if len({*ids}) > 1), min(map(len, inside)))
    return inside[0][depth - 1]


def main_text(
    page: str,
    skeleton: set[int],
    constants: set[int],
    kinds: set[int] = frozenset(),
    regular: set[int] = frozenset(),
) -> str:
    """The blocks of the article, one per line.

    On pages that mark no article it is the smallest grouping element around the fullest slot of
    the template. If that is an element around all text of the page, the outer template does not
    tell the article, and the template of the page's kind is taken. A page without a template is
    one slot. Elements whose names only may mark furniture are furniture if they are regular, or
    if nothing is known of the host.
    """
    tokens, blocks = parse(page)

    def is_furniture(block: Block) -> bool:
        return block.boiler or any(not regular or d - (1 << 63) in regular for d in block.doubts)

    kept = [b for b in blocks if not is_furniture(b)]
    article = [b for b in kept if b.main]
    if article:
        fixed = [b for b in article if b.token - (1 << 63) in constants]
        # a template does not make up most of an article
        if 2 * sum(len(b.text) for b in fixed) < sum(len(b.text) for b in article):
            article = [b for b in article if b.token - (1 << 63) not in constants]
        return "\n".join(b.text for b in article)
    kept = [b for b in kept if b.token - (1 << 63) not in constants]
    if not kept:
        return ""
    for template in (skeleton, kinds):
        # the smallest element that holds the slot is the article: its headings, lead, lists and links stay too
        holder = article_at(kept, slot_of(tokens, template))
        found = [b for b in kept if holder in b.groups]
        if len(found) < len(kept):
            break
    return "\n".join(b.text for b in found)


TEMPLATE = ("skeleton", "constants", "kinds", "regular")


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict = {}
        texts = []
        columns = [batch.column(c) for c in ("html", "host", *TEMPLATE)]
        for page, host, *template in zip(*columns, strict=True):
            host = host.as_py()
            if host not in known:
                known[host] = [set(part.as_py() or ()) for part in template]
            texts.append(main_text(page.as_py() or "", *known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    text is the article: character references decoded, white space in a block folded to one
    space, one block per line; n_chars counts code points. A null or empty html, or one without
    an article, gives the empty text; a null or odd url belongs to the host without a name;
    repeated rows are pages of their own; other columns are not read; an empty table gives an
    empty result. Hosts of fewer than three pages have no template and are read by their markup.
    """
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        host_of(F.col("url")).alias("host"),
        F.xxhash64("page_id", "url", "html").alias("page_key"),
    )
    # written, so that its size is known: small tables are broadcast, others joined by shuffle
    found = stored(templates(read))
    return (
        read.join(found, "host", "left")
        .select("page_id", "url", "html", "host", *TEMPLATE)
        .mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
    )
