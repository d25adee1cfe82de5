"""Main text of web pages: the containers that pages of one host agree on."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage

# How HTML elements are laid out, and names that say what an element is for.
RAW = frozenset("script style noscript template iframe object svg math textarea title canvas video audio".split())
# what can stand in a head; anything else ends it, whether or not it is closed
HEAD = frozenset("base basefont bgsound link meta noframes noscript object script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = frozenset({"p"})
CLOSED_BY_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": set(), "tbody": {"thead", "tbody", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table div section article main aside nav body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_TAGS = frozenset("nav footer aside button select fieldset dialog menu".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion"
    " nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets toolbar topbar"
    " footer foot colophon copyright legal cookie cookies consent gdpr notice notices banner alert warning popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations"
    " trending pagination pager hidden masthead skip search form".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond reactions discussion".split())
# what follows these in a name is something that the page has or lacks, not what the element is
STATE_WORDS = frozenset("has have no not with without".split())
# and a name that ends in one of these tells the state of such a thing
STATE_ENDS = frozenset("open opened closed enabled disabled on off".split())
HEADER_WORDS = frozenset("header head".split())
ARTICLE_TAGS = frozenset({"article", "main"})

# an element that is noise by its name alone is the page's frame if what is left beside it is less than
# this share of its text
FRAME_SHARE = 0.1

# elements nested deeper than this share the path of the one at this depth; a start tag looks this
# far up for paragraphs and items that it ends
MAX_DEPTH = 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<tag2>/?[a-zA-Z][^\s>/]*+)[^>]*+(?:>|\Z)",
    re.DOTALL,
)
# one attribute after the other, so that no name is found inside another one or a value
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


class Block(NamedTuple):
    text: str
    tag: str
    link_chars: int
    # number of the innermost container in Page.nodes
    node: int


class Node(NamedTuple):
    tag: str
    path: str
    parent: int
    # what the element's own tag and names say
    own: str
    # "", "noise" or "header": this element, or one around it, is not part of an article
    role: str


class Page(NamedTuple):
    nodes: list[Node]
    blocks: list[Block]


# what an element's own tag and names say of it
_NOISE, _NAMED, _COMMENTS, _HEADER, _NAMED_HEADER = "noise", "named noise", "comments", "header", "named header"


def _name_words(names: str) -> set[str]:
    words: set[str] = set()
    for name in names.split():
        parts = [word.lower() for word in _NAME_WORD.findall(name)]
        state = next((n for n, word in enumerate(parts) if word in STATE_WORDS), len(parts))
        words.update(parts[:state] if parts and parts[-1] not in STATE_ENDS else ())
    return words


def _names(tag: str, attrs: str) -> tuple[str, str]:
    """An element's generalised name, and its role."""
    by_tag = _NOISE if tag in NOISE_TAGS else _HEADER if tag == "header" else _NAMED if tag == "form" else ""
    if not attrs.strip():
        return tag, by_tag
    found = {k.lower(): (a or b or c) for k, a, b, c in _ATTR.findall(attrs)}
    classes = unescape(found.get("class", ""))
    words = _name_words(f"{classes} {unescape(found.get('id', ''))}")
    name = ".".join([tag, *sorted({_DIGITS.sub("#", c) for c in classes.split()})])
    if not classes and found.get("id"):
        name += "#" + _DIGITS.sub("#", found["id"])
    if tag in ARTICLE_TAGS or tag == "body":
        # a whole article is not noise for one of its names
        return name, _COMMENTS if "comment" in words else _NAMED_HEADER if words & HEADER_WORDS else ""
    unseen = "hidden" in found or "display:none" in found.get("style", "").lower().replace(" ", "")
    role = found.get("role", "").lower()
    if tag in NOISE_TAGS or unseen or role in NOISE_ROLES - {"form"}:
        return name, _NOISE
    if words & COMMENT_WORDS:
        return name, _COMMENTS
    if words & NOISE_WORDS or role == "form" or by_tag == _NAMED:
        return name, _NAMED
    return name, by_tag or (_NAMED_HEADER if words & HEADER_WORDS else "")


def _roles(nodes: list[Node], frames: set[int], believed: frozenset[str]) -> list[str]:
    """"noise", "header" or "" of every node by itself and what is around it; ``frames`` count as nothing."""
    roles: list[str] = []
    for n, node in enumerate(nodes):
        own = node.own if node.own in believed and n not in frames else ""
        above = roles[node.parent] if node.parent >= 0 else ""
        if above == "noise" or own in (_NOISE, _NAMED, _COMMENTS):
            roles.append("noise")
        else:
            roles.append("header" if own else above)
    return roles


_ALL = frozenset((_NOISE, _NAMED, _COMMENTS, _HEADER, _NAMED_HEADER))
_BY_TAG = frozenset((_NOISE, _HEADER))


def _settled(nodes: list[Node], blocks: list[Block]) -> list[Node]:
    """Nodes with what their names and tags come to.

    Layouts name their outer elements after what they arrange: a frame called ``sidebar-right``, or a
    form around the whole page, is no sidebar and no form. An element around others that is noise by
    name alone counts as such a frame if hardly any text is left without it; reader comments are none,
    however long.
    """
    named = [n for n, node in enumerate(nodes) if node.own in (_NAMED, _NAMED_HEADER)]
    frames: set[int] = set()
    roles = _roles(nodes, frames, _ALL)
    if named:
        weight = [0] * len(nodes)
        for block in blocks:
            weight[block.node] += max(0, len(block.text) - block.link_chars)
        held, kept = [0] * len(nodes), _roles(nodes, frames, _ALL - {_NAMED, _NAMED_HEADER})
        for n in range(len(nodes) - 1, 0, -1):
            around = nodes[n].parent
            held[around] += held[n] + (weight[n] if kept[n] == "" else 0)
        # a frame holds those inside it, so the largest come first
        for n in sorted(named, key=lambda n: (-held[n], n)):
            left = sum(w for w, role in zip(weight, roles, strict=True) if role == "")
            if left >= FRAME_SHARE * held[n]:
                break
            frames.add(n)
            roles = _roles(nodes, frames, _ALL)
    return _with_roles(nodes, roles)


def _with_roles(nodes: list[Node], roles: list[str]) -> list[Node]:
    return [node if node.role == role else node._replace(role=role) for node, role in zip(nodes, roles, strict=True)]


def _by_tags(page: Page) -> Page:
    """The page with classes and ids out of account."""
    return page._replace(nodes=_with_roles(page.nodes, _roles(page.nodes, set(), _BY_TAG)))


def parse(html: str) -> Page:
    """Blocks of text with the containers around them; scripts, styles and comments are left out."""
    nodes = [Node("html", "", -1, "", "")]
    stack: list[tuple[str, int]] = [("html", 0)]
    blocks: list[Block] = []
    pieces: list[str] = []
    opened: Counter[str] = Counter()
    links, in_link, in_head = 0, False, False

    def flush() -> None:
        nonlocal links
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(text, stack[-1][0], links, stack[-1][1]))
            pieces.clear()
        links = 0

    def close(upto: int) -> None:
        flush()
        opened.subtract(tag for tag, _ in stack[upto:])
        del stack[upto:]

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() < at:
            continue
        between = html[at : token.start()]
        if between:
            pieces.append(between)
            in_head = in_head and between.isspace()
            if in_link:
                links += len(between)
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if token["close"] or tag[0] == "/":
            tag = tag.lstrip("/")
            if tag == "head":
                in_head = False
            if tag == "a":
                in_link = False
            elif tag in INLINE:
                pass
            elif not opened[tag]:
                flush()
            else:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
            continue
        if tag == "head":
            flush()
            in_head = True
            continue
        in_head = in_head and tag in HEAD
        if tag in RAW or in_head and tag == "noframes":
            if not (token["attrs"] or "").rstrip().endswith("/"):
                end = _raw_end(tag).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = True
            continue
        flush()
        if tag in VOID:
            continue
        for depth in range(len(stack) - 1, max(0, len(stack) - MAX_DEPTH), -1):
            open_tag = stack[depth][0]
            if open_tag in CLOSED_BY_BLOCK or open_tag in CLOSED_BY_SAME.get(tag, ()):
                close(depth)
                if open_tag in CLOSED_BY_SAME.get(tag, ()):
                    if open_tag == tag or tag in ("dt", "dd", "td", "th"):
                        break
                continue
            if open_tag in SCOPES:
                break
        name, role = _names(tag, token["attrs"] or "")
        parent = stack[-1][1]
        nested = tag not in ("html", "body") and len(stack) < MAX_DEPTH
        above = nodes[parent].path
        nodes.append(Node(tag, f"{above}>{name}" if nested else above, parent, role, ""))
        stack.append((tag, len(nodes) - 1))
        opened[tag] += 1
    if html[at:]:
        pieces.append(html[at:])
    flush()
    return Page(_settled(nodes, blocks), blocks)


_RAW_ENDS = {tag: re.compile(rf"(?i)</{tag}\b[^>]*>") for tag in RAW | {"noframes"}}


def _raw_end(tag: str) -> re.Pattern:
    return _RAW_ENDS[tag]


def _readable(page: Page, block: Block, inside_container: bool) -> bool:
    role = page.nodes[block.node].role
    return role == "" or role == "header" and inside_container and block.tag in HEADINGS


def _within(page: Page, chosen: set[int]) -> list[bool]:
    """For every node, whether it is one of ``chosen`` or inside one; parents come before children."""
    inside: list[bool] = []
    for n, node in enumerate(page.nodes):
        inside.append(n in chosen or node.parent >= 0 and inside[node.parent])
    return inside


def best_container(page: Page) -> tuple[int, int]:
    """The container that holds the page's text, and its score; ``(0, 0)`` if there is no text.

    A block counts its characters without links for the container around it, twice for a paragraph,
    and half of that for the next container out. The best one gives way to the article around it, or
    to the container that adds a heading to it.
    """
    scores: dict[int, int] = {}
    for block in page.blocks:
        if not _readable(page, block, False) or block.tag in HEADINGS:
            continue
        weight = len(block.text) - min(block.link_chars, len(block.text))
        own = block.node
        if block.tag == "p":
            weight *= 2
        if block.tag in ("p", "li", "pre", "blockquote", "td", "dd") and page.nodes[own].parent >= 0:
            own = page.nodes[own].parent
        scores[own] = scores.get(own, 0) + 2 * weight
        parent = page.nodes[own].parent
        if parent >= 0:
            scores[parent] = scores.get(parent, 0) + weight
    if not scores:
        return 0, 0
    best = min(scores, key=lambda n: (-scores[n], n))
    score, node = scores[best], best
    while node > 0:
        if page.nodes[node].tag in ARTICLE_TAGS:
            return node, score
        node = page.nodes[node].parent
    parent = page.nodes[best].parent
    if parent > 0 and page.nodes[parent].tag != "body":
        around, own = _within(page, {parent}), _within(page, {best})
        headings = [b for b in page.blocks if b.tag in ("h1", "h2") and around[b.node] and _readable(page, b, True)]
        if any(not own[b.node] for b in headings) and not any(own[b.node] and b.tag == "h1" for b in headings):
            best = parent
    return best, score


def article(page: Page, path: str | None) -> str:
    """Text of all containers at ``path``, or of the page's best one if there is none or it is empty.

    A page that is all noise by its names is read by its tags alone.
    """
    return _article(page, path) or _article(_by_tags(page), path)


def _article(page: Page, path: str | None) -> str:
    wanted = {n for n, node in enumerate(page.nodes) if path is not None and node.path == path and node.tag not in ("html", "body")}
    if path == "":
        wanted = {0}
    for chosen in (wanted, {best_container(page)[0]}):
        if chosen:
            inside = _within(page, chosen)
            found = [b.text for b in page.blocks if inside[b.node] and _readable(page, b, True)]
            if found:
                return "\n\n".join(found)
    return ""


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        host_of(F.col("url").cast("string")).alias("host"),
    )


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, path, votes)``: the container path that most pages of a host choose.

    A page votes for the path of its best container; ties go to the larger score, then the first path
    in order. Votes are summed in the task, then by host and path, so a host with a third of all
    pages is a row per task.
    """

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = parse(html.as_py() or "")
                node, score = best_container(page)
                if score:
                    entry = sums.setdefault((host, page.nodes[node].path), [0, 0])
                    entry[0] += 1
                    entry[1] += score
            rows = [(h, p, v, s) for (h, p), (v, s) in sums.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "path", "votes", "score"])

    votes = _rows(pages).select("host", "html").mapInArrow(voted, "host string, path string, votes long, score long")
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    order = F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), F.col("path").alias("path"), "votes")
    return sums.groupBy("host").agg(F.min(order).alias("best")).select("host", "best.path", "best.votes")


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``: the article, blocks joined by two line feeds.

    Pages are parsed twice: once to vote, once to take the text at the host's winning path. A page
    without such a container, or with an empty one, gives the text of its own best container.
    Within a container menus, headers but for their headings, footers, sidebars, notices, adverts,
    forms and reader comments are left out, by tag, role, class and id. Layout names do not make a
    page's frame noise: ``has-sidebar`` and its like say nothing, and an element that is noise by its
    name alone, but without which hardly any text is left, is read.

    A null or empty page has an empty text. Null addresses form one host, null ids stay null,
    repeated rows are extracted and counted each, other columns are not read, an empty table gives
    no rows. The winners are one short row per host; Spark broadcasts them below its threshold and
    splits the partition of a hot host above it.
    """
    winners = stage(host_paths(pages).select("host", "path"), fresh_path(pages.sparkSession, "host-paths"))
    rows = _rows(pages).join(winners, "host", "left").select("page_id", "url", "html", "path")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, htmls, paths = batch.columns
            texts = [article(parse(html.as_py() or ""), path) for html, path in zip(htmls, paths.to_pylist(), strict=True)]
            columns = [ids, urls, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
