"""Main text of web pages: element subtrees that recur over the pages of a host are taken out as site template."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.base import query, slices, table
from reviewloom.plans.bounded import lookup_join
from reviewloom.plans.session import cut_lineage

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements whose text is never the article's.
DROPPED = frozenset(
    "script style noscript template head title iframe object svg canvas nav header footer aside form button select textarea "
    "dialog menu audio video map noembed noframes".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var br wbr img".split()
)
#: What closes an element that the page left open.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
    "body": {"head"},
}
SCOPES = frozenset("html body article main section div table ul ol dl td th blockquote aside nav header footer form".split())
#: Elements that are not counted: parts of a line of text, what goes anyway, and the page itself.
NO_TEMPLATE = VOID | INLINE | DROPPED | {"html", "body"}
#: Words in class, id or role that mark menus, notices, adverts and comments.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w*|"
    r"sidebar|side-bar|nav\w*|menu|breadcrumbs?|pagination|pager|header|masthead|footer|toolbar|share|sharing|social|related|"
    r"recommend\w*|comments?|commentlist|disqus|replies|respond|login|signup|search|skip-link|navigation|contentinfo|complementary)(?:$|[\s_-])", re.I,
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    marks: str = ""
    hidden: bool = False
    parts: list = field(default_factory=list)  # texts and nodes
    hash: int = 0


def parse(page: str) -> Node:
    """A tolerant element tree; what is left open is closed by its surroundings or by the end."""
    root = Node("#root")
    stack, at, size = [root], 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].parts.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(x.tag == "p" for x in stack):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in SCOPES and tag in INLINE:
                    break
            continue
        closes = CLOSES.get(tag, ())
        if tag not in INLINE and tag not in RAW and tag not in VOID:
            closes = {*closes, "p"}
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in closes:
                del stack[k:]
                if "p" in closes and len(closes) == 1:
                    break
            elif stack[k].tag in SCOPES:
                break
        node = Node(tag)
        if m[3]:
            node.marks = " ".join(next(filter(None, a[1:]), "") for a in _ATTR.findall(m[3]))
            node.hidden = "hidden" in m[3].lower() + ("hidden" if "display" in m[3].lower() else "") and bool(_HIDDEN.search(m[3]))
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else size
            node.parts.append(page[at:stop])
            at = (page.find(">", stop) + 1 or size) if end else size
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag not in INLINE:
            stack.append(node)
    return root


def hash_subtrees(node: Node) -> list[Node]:
    """Set the hash of every element from its tag, marks, text and children; elements in page order.

    Works from the leaves up without recursion, so depth does not matter.
    """
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(x for x in reversed(n.parts) if isinstance(x, Node))
    for n in reversed(order):
        h = xxhash.xxh3_64(f"{n.tag}\0{n.marks}")
        for x in n.parts:
            h.update(x.hash.to_bytes(8, "little") + b"\1" if isinstance(x, Node) else x.strip().encode("utf-8", "surrogatepass") + b"\2")
        n.hash = h.intdigest()
    return order


def unwanted(node: Node) -> bool:
    return node.hidden or node.tag in DROPPED or bool(node.marks and node.tag not in ("html", "body", "article", "main") and MARKED.search(node.marks))


def prune(root: Node, template: set[int]) -> Node:
    """Drop unwanted elements and those of the template, in place."""
    todo = [root]
    while todo:
        n = todo.pop()
        n.parts = [x for x in n.parts if isinstance(x, str) or not (unwanted(x) or x.hash in template)]
        todo.extend(x for x in n.parts if isinstance(x, Node))
    return root


def own_text(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        else:
            todo.extend(reversed(n.parts))
    return "".join(out)


def containers(root: Node) -> list[Node]:
    """The outermost article or main elements, else the whole page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            n = todo.pop()
            if n.tag == wanted:
                found.append(n)
            else:
                todo.extend(x for x in reversed(n.parts) if isinstance(x, Node))
        if any(own_text(n).strip() for n in found):
            return found
    return [root]


def blocks(nodes: list[Node]) -> list[str]:
    """Texts between block boundaries, white space as single blanks, character references decoded."""
    out, line = [], []

    def close() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [x for n in reversed(nodes) for x in (None, n, None)]
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif x.tag in INLINE:
            todo.extend(reversed(x.parts))
        else:
            todo.extend([None, *reversed(x.parts), None])
    close()
    return out


def _inside(order: list[Node], tops: list[Node]) -> set[int]:
    """Identities of the elements below the main containers."""
    todo, out = list(tops), set()
    while todo:
        n = todo.pop()
        out.add(id(n))
        todo.extend(x for x in n.parts if isinstance(x, Node))
    return out


def subtree_counts(pages: DataFrame) -> DataFrame:
    """(host, hash, inside, n): on how many pages of a host, counted by distinct main text, a subtree stands.

    Counted first over distinct (host, article, subtree) triples, which combine where they arise, so copies
    of one article count once and a host of any size is spread over all tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = set()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = parse(page)
                order = hash_subtrees(root)
                tops = containers(root)
                article = xxhash.xxh3_64_intdigest("".join(f"{n.hash}," for n in tops))
                inside = _inside(order, tops) if tops != [root] else set()
                rows.add((host, article, 0, False))
                rows.update((host, article, n.hash or 1, id(n) in inside) for n in order[1:] if n.tag not in NO_TEMPLATE)
            if rows:
                hosts, articles, hashes, within = zip(*rows, strict=True)
                signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (articles, hashes)]
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *signed, pa.array(within)], names=["host", "article", "hash", "inside"])

    seen = pages.select("host", "html").mapInArrow(run, "host string, article long, hash long, inside boolean")
    return seen.distinct().groupBy("host", "hash", "inside").agg(F.count(F.lit(1)).alias("n"))


def host_templates(pages: DataFrame, min_pages: int, share: float, inside_share: float) -> DataFrame:
    """(host, template): the subtrees that stand on many different pages of a host, as one list per host.

    A list can't outgrow a page: each entry stands on at least ``share`` of the host's pages.
    """
    counts = cut_lineage(subtree_counts(pages), "subtree-counts")
    total = F.max(F.when(F.col("hash") == 0, F.col("n")))
    wide = counts.groupBy("host").agg(total.alias("pages"))
    often = F.when(F.col("inside"), F.col("pages") * inside_share).otherwise(F.col("pages") * share)
    hot = counts.where((F.col("hash") != 0) & (F.col("n") >= min_pages)).join(wide, "host").where(F.col("n") >= often)
    return hot.groupBy("host").agg(F.collect_set("hash").alias("template"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = 10, share: float = 0.3, inside_share: float = 0.8,
) -> DataFrame:
    """(id, url, text, n_chars) of every page: the article's blocks in page order, joined by line breaks.

    A subtree that recurs on ``share`` of a host's different pages (``min_pages`` at least) is site template and
    goes; inside a marked article or main element that takes ``inside_share``. Menus, headers, footers, asides,
    forms, scripts, and elements whose class, id or role says notice, advert or comment go as well. Pages are
    different if their articles are, so copies of a page make no template. Null or empty html gives an empty
    text; a url without host belongs to the host ''; repeated rows and null ids are kept; other columns are not
    read. The template list goes to the pages by a join that is broadcast only if measured small.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))
    rows = rows.withColumn("host", host)
    templates = host_templates(rows, min_pages, share, inside_share)
    joined = lookup_join(rows, templates, "host", "left", spread_by=("id",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = []
            for page, hashes in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True):
                root = parse(page)
                if hashes:
                    hash_subtrees(root)
                gone = {h & 0xFFFFFFFFFFFFFFFF for h in hashes or ()}
                texts.append("\n".join(blocks(containers(prune(root, gone)))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    out = joined.select("id", "url", "html", "template").mapInArrow(run, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op6_html_text")
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))
