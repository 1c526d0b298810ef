"""HTML extraction with a site style tree.

The DOMs of all of a host's pages are merged, articles included: nodes with equal tags
and classes along equal paths become one style node. Its content importance is the
entropy of the texts that stand there over the distinct pages, relative to that of as
many different texts; the presentation importance of the element around it is the same
entropy of that element's child lists. The more variants the child lists have, the more
the presentation counts of the two. What tags and classes say comes before both: a menu
or advert is no text, an article is all text. Other branches of low importance are
removed from each page, and the blocks that are left are its text. Copies of a page
count once, and a text that no other page repeats stays whatever its node.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import map_batches, saved, signed, small_batches, with_fields
from stagewise.llm.op3_url_filter import with_parts

#: A style node seen this often whose relative entropy is lower loses the texts that pages repeat.
SEEN, IMPORTANCE = 8, 0.4
#: To the power of the number of an element's child lists, the share of the contents in an importance.
CONTENTS = 0.9
#: Up to so many removed blocks (8 bytes each) go to every task; more are joined to their pages.
LISTED = 1_000_000

#: Elements without content of their own to read, and elements that hold no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE = frozenset("nav footer aside form menu dialog button select datalist iframe object svg canvas audio video map head title noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Names of a class, id or role, or their leading or last part, that mark a branch as no main text; those of reader comments apart.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners breadcrumb breadcrumbs consent cookie cookies "
    "dialog disclaimer footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pagination pager popup promo promotion related recommended search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription taboola toolbar widget widgets complementary contentinfo alert alertdialog".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A name that begins so says what a page has or a text is about (no-sidebar, category-social).
ABOUT = frozenset("no not non without with has is category tag topic type format".split())

# What stands between a tag's name and its end. A tag is given up at the next "<" outside
# quotes, and no part is tried twice, so a page of broken tags takes no longer than another.
_REST = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|xmp)\b(?:{_REST}|[^<>]*+)>.*?(?:</(?P=raw)\s*+>|\Z)|<[!?][^<>]*+>"
    rf"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<rest>{_REST})>""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""(?<![^\s=/"'<>])([^\s=/"'<>]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_PARTS = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Node:
    """An open element: its tag, path hash, whether it is noise or within the main text, whether it is noise by itself, where it begins, its parent's path and, if asked for, a hash of its children in order."""

    __slots__ = ("tag", "path", "noise", "comment", "main", "own", "at", "up", "children")

    def __init__(self, tag: str, path: str, noise: bool, comment: bool, main: bool, own: bool = False, at: int = 0, up: str = "") -> None:
        self.up, self.children = up, ""
        self.tag, self.path, self.noise, self.comment, self.main, self.own, self.at = tag, path, noise, comment, main, own, at


def _named(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in ``value`` is one of the words or begins or ends with it."""
    for name in value.split():
        parts = [x for x in _PARTS.split(name) if x]
        if parts and parts[0] not in ABOUT and not words.isdisjoint((parts[0], parts[-1], name)):
            return True
    return False


def _opened(tag: str, rest: str, parent: _Node, at: int = 0) -> _Node:
    names, said, noise, comment, main = [], [], tag in NOISE, False, tag in MAIN
    if tag == "header" and not parent.main:
        noise = True
    if "=" in rest or "hidden" in rest:
        for name, *values in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role"):
                if name != "id":
                    names.append(value)
                said.append((name, value))
                if name == "role" and "main" in value.split():
                    main = True
            elif name == "style" and _HIDDEN.search(value) or name == "aria-hidden" and value == "true":
                noise = True
        section = tag == "section" or any("section" in value.split() for name, value in said if name == "class")
        for name, value in said:
            if tag == "article":  # what its class says is about its text; a reader's comment is one still
                comment = comment or name != "id" and not {"comment", "reply"}.isdisjoint(value.split())
            elif tag not in ("html", "body", "main") and not (name == "role" and main) and not (
                    name == "id" and (tag in HEADINGS or section and (parent.main or value == "discussion"))):  # these ids are made from titles
                noise = noise or _named(value, NOISE_WORDS)
                comment = comment or _named(value, COMMENT_WORDS)
        if re.search(r"(?:^|\s)hidden(?:\s|/|$)", _ATTRIBUTE.sub(" ", rest)):
            noise = True
    comment = comment or parent.comment
    own, noise = noise, noise or parent.noise
    main = main and not comment and not noise
    path = xxhash.xxh3_64_hexdigest(f"{parent.path}>{tag}.{'.'.join(names)}".encode("utf-8", "surrogatepass"))
    return _Node(tag, path, noise or comment, comment, main or parent.main, own, at, parent.path)


def _ends(html: str) -> dict[int, int]:
    """Where the elements that are closed begin and end."""
    opened, ends = {}, {}
    for token in _TOKEN.finditer(html):
        if token["tag"] is not None:
            begun = opened.setdefault(token["tag"].lower(), [])
            if not token["end"]:
                begun.append(token.start())
            elif begun:
                ends[begun.pop()] = token.start()
    return ends


def page_blocks(html: str, rescue: bool = False, nodes: list[_Node] | None = None) -> tuple[list[tuple[str, str]], bool]:
    """``(path, text)`` of the page's blocks in order, noise left out; only those in its
    main element if it has one. Also whether it has.

    An article within noise that is closed after it is noise as well, unless the page has
    no other text (``rescue``); a menu or advert left open ends where the article begins.
    ``nodes`` gets the elements that are no noise, with their children's hashes.
    """
    root = _Node("", "", False, False, False)
    stack, blocks, parts, owner = [root], [], [], root
    any_main, ends, buried = False, None, False
    opened, closes = Counter(), {}

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append((owner.path, text, owner.main))
            parts = []

    at = skip = 0
    for token in _TOKEN.finditer(html):
        start = token.start()
        if skip and start < skip:
            at = token.end()
            if token["tag"] is None or token["tag"].lower() in INLINE:
                continue
            skip = 0  # a block begins or ends within: it was no inline element after all
        if start > at and not stack[-1].noise:
            parts.append(html[at:start])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag in ("wbr", "img") or token["rest"].find("=") < 0 and "hidden" not in token["rest"]:
                continue  # an inline element with nothing said about it
            if token["end"] or tag in VOID:
                continue
            node = _opened(tag, token["rest"], stack[-1])
            if not node.noise or stack[-1].noise:
                continue
            # A hidden or noisy inline element: its text goes up to its end, if it has one.
            if tag not in closes:
                closes[tag] = [m.end() for m in re.finditer(rf"</{re.escape(tag)}\s*+>", html, re.I)]
            close = bisect_right(closes[tag], at)
            skip = closes[tag][close] if close < len(closes[tag]) else skip
            continue
        if tag == "br":
            if not stack[-1].noise:
                parts.append(" ")
            continue
        if tag == "hr" or tag not in VOID:
            flush()
        if tag in VOID:
            continue
        if token["end"]:
            while opened[tag]:
                closed = stack.pop().tag
                opened[closed] -= 1
                if closed == tag:
                    break
        else:
            closing = {"li": ("li",), "p": (), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                       "th": ("td", "th"), "option": ("option",)}.get(tag, ())
            if stack[-1].tag == "p" or stack[-1].tag in closing:
                opened[stack.pop().tag] -= 1
            if tag in MAIN and stack[-1].noise and not stack[-1].main and not stack[-1].comment and not _opened(tag, token["rest"], root).noise:
                ends = _ends(html) if ends is None else ends
                end = ends.get(start, start)
                if tag == "main" or rescue or not any(n.own and ends.get(n.at, -1) > end for n in stack):
                    stack, opened = [root], Counter()
                else:
                    buried = True
            node = _opened(tag, token["rest"], stack[-1], start)
            if token["rest"].rstrip().endswith("/") and tag in ("svg", "path"):
                continue
            if nodes is not None and not node.noise:
                stack[-1].children = xxhash.xxh3_64_hexdigest(stack[-1].children + node.path)
                nodes.append(node)
            stack.append(node)
            opened[tag] += 1
        owner = stack[-1]
        any_main = any_main or owner.main
    if at < len(html) and not stack[-1].noise:
        parts.append(html[at:])
    flush()
    if buried and not blocks:
        if nodes is not None:
            nodes.clear()
        return page_blocks(html, True, nodes)
    return [(path, text) for path, text, main in blocks if main or not any_main], any_main


def _node(host: str, path: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{host}\0{path}".encode("utf-8", "surrogatepass"))


def _block(host: str, path: str, text: str) -> int:
    return _node(host, f"{path}\0{text}")


def _shape(host: str, path: str) -> int:
    return _node(host, f"{path}\0\0")


def style_blocks(pages: DataFrame) -> DataFrame:
    """``node, around, block, c, plain``: on how many distinct pages of its host a text stands at
    a style node, and whether on one without a main element. An element's child lists are blocks
    as well, of a node of their own that has no ``around``; a text's ``around`` is that node of
    the element around it.

    ``pages`` has ``host`` and ``html``. Pages with the same blocks are copies and count
    once, and so does a text that a page repeats. Copies are dropped before the shuffle.
    """
    def start():
        seen = set()

        def work(batch: pa.RecordBatch):
            rows = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                elements = []
                blocks, any_main = page_blocks(html or "", nodes=elements)
                page = _node(host, "\0".join(x for b in blocks for x in b)) if blocks else 0
                if blocks and page not in seen:
                    seen.add(page)
                    ups = {e.path: e.up for e in elements}
                    own = {(_node(host, path), _shape(host, ups.get(path, "")), _block(host, path, text)) for path, text in blocks}
                    own |= {(_shape(host, e.path), 0, _block(host, e.path, f"\0{e.children}")) for e in elements}
                    rows.append((page, not any_main, np.array(sorted(own), np.uint64)))
            bounds = np.cumsum([0, *(len(x) for _, _, x in rows)]).astype(np.int32)
            every = np.concatenate([np.zeros((0, 3), np.uint64), *(x for _, _, x in rows)])
            yield pa.RecordBatch.from_arrays(
                [signed(np.array([p for p, _, _ in rows], np.uint64)), pa.array([x for _, x, _ in rows], pa.bool_()),
                 *(pa.ListArray.from_arrays(pa.array(bounds), signed(every[:, k])) for k in range(3))], names=["page", "plain", "nodes", "arounds", "blocks"])
        return work
    found = map_batches(pages.select("host", "html"), start, "page long, plain boolean, nodes array<long>, arounds array<long>, blocks array<long>")
    each = found.dropDuplicates(["page"]).select("plain", F.inline(F.arrays_zip("nodes", "arounds", "blocks")).alias("node", "around", "block"))
    return (each.groupBy("node", "around", "block").agg(F.count("*").alias("c"), F.max("plain").alias("plain"))
            .select("node", F.when(F.col("around") != 0, F.col("around")).alias("around"), "block", "c", "plain"))


def style_nodes(blocks: DataFrame) -> DataFrame:
    """``node, m, importance`` of the style nodes of ``style_blocks`` that hold texts.

    The contents' importance is the entropy of the node's texts over that of ``m`` different
    ones, the presentation's that of the ``n`` child lists of the element around it; the
    importance is ``(1 - CONTENTS ** n)`` of the presentation and the rest of the contents.
    """
    entropies = (blocks.groupBy("node", "around").agg(F.sum("c").alias("m"), F.count("*").alias("n"), F.sum(F.col("c") * F.log("c")).alias("s"))
                 .withColumn("entropy", F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("m") * F.log("m"))).otherwise(F.lit(1.0))))
    shapes = entropies.where("around is null").select(F.col("node").alias("around"), F.col("entropy").alias("shape"), F.col("n").alias("shapes"))
    share = F.pow(F.lit(CONTENTS), F.coalesce("shapes", F.lit(0)))
    return (entropies.where("around is not null").join(shapes, "around", "left")
            .select("node", "m", ((1 - share) * F.coalesce("shape", F.lit(0.0)) + share * F.col("entropy")).alias("importance")))


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``text``, the main text of each page's html, to its other columns.

    Of a page with an article or main element all of that element but its noise is kept;
    it counts in the style tree like others. Elsewhere style nodes of low importance lose the
    texts that several distinct pages repeat. Null,
    empty and broken html give what text there is, else an empty one; a null url has the
    empty host. Rows are kept one for one, whatever their columns are called; an own ``text``
    is replaced. An empty table gives no rows. Time and memory grow with a page's length,
    however broken it is.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.drop("text")
    # The caller's columns travel as one, so none of their names clashes with those used here.
    hosted = with_parts(pages.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in pages.columns]).alias("_row"), F.col(url).alias("_url"),
                                     F.col(html).alias("_html")), "_url").select("_row", F.col("host").alias("_host"), "_html")
    found = saved(style_blocks(hosted.select(F.col("_host").alias("host"), F.col("_html").alias("html"))), "html-blocks")
    low = found.where("c > 1 and around is not null and plain").join(style_nodes(found).where((F.col("m") >= SEEN) & (F.col("importance") < IMPORTANCE)), "node").select("block")
    few = low.limit(LISTED + 1).toArrow().column("block").to_numpy()
    schema = with_fields(pages, "text string")
    if len(few) <= LISTED:
        shared = spark.sparkContext.broadcast(np.sort(few.view(np.uint64)))
        source, listed = hosted, False
    else:  # the list of each page's own low blocks, joined to it
        shared, listed = None, True
        marked = hosted.withColumn("_key", F.xxhash64("_host", "_html"))
        def paths():
            def work(batch: pa.RecordBatch):
                keys, blocks = [], []
                for key, host, text in zip(*(batch.column(c).to_pylist() for c in ("_key", "_host", "_html"))):
                    own = {_block(host, *b) for b in page_blocks(text or "")[0]}
                    keys += [key] * len(own)
                    blocks += own
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), signed(np.array(blocks, np.uint64))], names=["_key", "block"])
            return work
        own = map_batches(marked.select("_key", "_host", "_html"), paths, "_key long, block long")
        flags = own.join(low, "block").groupBy("_key").agg(F.collect_set("block").alias("_low"))
        source = marked.join(flags, "_key", "left").drop("_key")

    def start():
        gone = set(shared.value.tolist()) if shared is not None else set()

        def work(batch: pa.RecordBatch):
            texts = []
            lows = batch.column("_low").to_pylist() if listed else [None] * batch.num_rows
            for host, text, own in zip(batch.column("_host").to_pylist(), batch.column("_html").to_pylist(), lows):
                blocks, any_main = page_blocks(text or "")
                out = gone if own is None else {x % (1 << 64) for x in own}
                if out and not any_main:
                    blocks = [b for b in blocks if _block(host, *b) not in out]
                texts.append("\n\n".join(t for _, t in blocks))
            row = batch.column("_row")
            yield pa.RecordBatch.from_arrays([*row.flatten(), pa.array(texts, pa.string())], names=[*(f.name for f in row.type), "text"])
        return work
    return map_batches(source, start, schema)


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
