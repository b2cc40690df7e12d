"""Main text of web pages by a site style tree.

The pages of a host are merged by their elements' paths (tag, class and id from the body down). For each node of that
tree two entropies over the host's pages are taken: of the children's styles (presentation) and of the text (content).
A branch that looks and reads alike on many pages carries little; one that differs carries the page's own text.
The role of an element (tag, class, id, role) is the prior of its importance, and weighs less the more pages tell of
it. Branches of low importance are cut from each page, and what is left is its text.

The tree is gathered by counting (host, path, hash), so a host with a third of all pages is a few rows per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, stored
from tripgrain.llm.url_rules import host_of

MIN_IMPORTANCE = 0.4
MIN_PAGES, MANY_PAGES = 8, 512  # fewer pages of a host tell nothing about a node; from so many on the prior weighs least
ROLE_WEIGHT = 0.7, 0.3  # of the prior at MIN_PAGES and at MANY_PAGES, by the logarithm between; the rest is the entropy
PRESENTATION, CONTENT = 0.3, 0.7
ROLES = 0.0, 0.5, 1.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea title select".split())
BOILERPLATE = frozenset("nav footer header aside form menu dialog button head fieldset".split()) | RAW
MAIN = frozenset("article main".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split()) | INLINE
# Whole names of a class, id or role that tell of what is not the article.
HINTS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments complementary contentinfo consent cookie cookies copyright disqus"
    " footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted"
    " related replies reply respond search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe teaser toc toolbar widget".split()
)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body article section div main".split())


class Node:
    __slots__ = ("tag", "style", "hinted", "parts", "parent")

    def __init__(self, tag: str, style: str = "", hinted: bool = False, parent: Node | None = None):
        self.tag, self.style, self.hinted, self.parent = tag, style, hinted, parent
        self.parts: list[Node | str] = []


def parse(html: str) -> Node:
    """A tree of elements and texts. Tags left open end with their parents; stray end tags are ignored."""
    root = at = Node("body")
    place, length = 0, len(html)
    while place < length:
        found = TAG.search(html, place)
        if not found:
            at.parts.append(html[place:])
            break
        if found.start() > place:
            at.parts.append(html[place : found.start()])
        place = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if found[1] or found[4]:
            node = at
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node is not root:
                at = node.parent
            continue
        attributes = found[3] if found[2] else found[6]
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)|</{re.escape(tag)}\s[^>]*>", re.I).search(html, place)
            place = end.end() if end else length
            continue
        if tag in CLOSES_P or tag in CLOSES_SELF:
            ends = CLOSES_SELF.get(tag, ()) + ("p",) * (tag in CLOSES_P)
            node = at
            while node is not None and node.tag not in ends and (node.tag in INLINE or node.tag not in SCOPE) and node is not root:
                node = node.parent
            if node is not None and node.tag in ends:
                at = node.parent
        style, hinted = tag, False
        if attributes:
            names = [(k.lower(), a or b or c) for k, a, b, c in NAMED.findall(attributes)]
            hinted = any(w in HINTS for _, v in names for w in v.lower().split())
            style = tag + "".join(f".{v}" for k, v in names if k == "class") + "".join(f"#{re.sub(r'[0-9]+', '0', v)}" for k, v in names if k == "id")
        node = Node(tag, style, hinted, at)
        at.parts.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            at = node
    return root


def text_of(root: Node, cut) -> str:
    """Blocks in page order, white space within them made one space, joined by one space. `cut(node)` drops a branch."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        if line:
            if words := unescape("".join(line)).split():
                blocks.append(" ".join(words))
            line.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        part = todo.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            line.append(part)
        elif not cut(part):
            if part.tag == "br":
                line.append(" ")
            elif part.tag in INLINE:
                todo += reversed(part.parts)
            else:
                close()
                todo.append(None)
                todo += reversed(part.parts)
    close()
    return " ".join(blocks)


def _walk(root: Node) -> Iterator[tuple[Node, str]]:
    """Block elements and their style paths."""
    todo = [(p, p.style) for p in root.parts if isinstance(p, Node)]
    while todo:
        node, path = todo.pop()
        if node.tag in INLINE or node.tag in VOID:
            continue
        yield node, path
        todo += [(p, f"{path}/{p.style}") for p in node.parts if isinstance(p, Node)]


def _styles(html: str | None) -> Iterator[tuple[int, str, int, int]]:
    """hash of the whole page, path, hash of the children's styles, hash of the text: one row per path of a page. Pages
    of one hash have the same text and the same paths."""
    from xxhash import xxh64_intdigest

    seen: dict[str, list] = {}
    root = parse(html or "")
    for node, path in _walk(root):
        entry = seen.setdefault(path, [[], []])
        entry[0].append(" ".join(dict.fromkeys(p.style for p in node.parts if isinstance(p, Node))))
        entry[1].append(text_of(node, lambda _: False))
    signed = lambda s: xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)
    nodes = sorted((path, signed("|".join(styles)), signed("\n".join(texts))) for path, (styles, texts) in seen.items())
    page = signed(repr(nodes) + text_of(root, lambda _: False))
    for node in nodes:
        yield page, *node


def site_style_tree(pages: DataFrame, host: str, html: str) -> DataFrame:
    """host, path, pages, entropy: 0 where all pages of the host agree, 1 where all differ; weighted over children's
    styles and texts. Pages that are copies of each other count as one. Nodes on fewer than MIN_PAGES pages are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, *s) for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for s in _styles(page)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "page", "path", "look", "words"])

    nodes = pages.select(host, html).mapInArrow(run, "host string, page long, path string, look long, words long")
    nodes = nodes.groupBy("host", "page", "path").agg(F.first("look").alias("look"), F.first("words").alias("words"))
    kinds = F.array(F.struct(F.lit(PRESENTATION).alias("weight"), F.col("look").alias("value")), F.struct(F.lit(CONTENT).alias("weight"), F.col("words").alias("value")))
    counted = nodes.select("host", "path", F.explode(kinds).alias("k")).groupBy("host", "path", "k.weight", "k.value").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy("host", "path", "weight").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"))
    entropy = F.when(F.col("pages") > 1, F.lit(1.0) - F.col("s") / F.col("pages") / F.log("pages")).otherwise(1.0)
    tree = sums.groupBy("host", "path").agg(F.max("pages").alias("pages"), F.sum(F.col("weight") * entropy).alias("entropy"))
    return tree.where(F.col("pages") >= MIN_PAGES)


def least_role(pages: Column, entropy: Column) -> Column:
    """The least of ROLES that a branch needs to be kept; 2 if none suffices."""
    most, least = ROLE_WEIGHT
    grown = F.least(F.lit(1.0), F.log(pages / MIN_PAGES) / F.log(F.lit(MANY_PAGES / MIN_PAGES)))
    weight = most - (most - least) * grown
    enough = [(weight * role + (1 - weight) * entropy >= MIN_IMPORTANCE, role) for role in ROLES]
    return F.coalesce(*(F.when(rule, F.lit(role)) for rule, role in enough), F.lit(2.0))


def main_text(html: str | None, least: dict[str, float] | None = None) -> str:
    """The text that is left of a page. `least`: the role that a path needs on this host, ROLES[1] where not given."""
    root = parse(html or "")
    important: set[int] = set()  # nodes in, or above, an article
    inside: set[int] = set()
    paths = {id(node): path for node, path in _walk(root)}
    todo = [(root, False)]
    while todo:
        node, within = todo.pop()
        if node.hinted or node.tag in BOILERPLATE:
            continue
        if within or node.tag in MAIN:
            within = True
            inside.add(id(node))
            up = node
            while up is not None and id(up) not in important:
                important.add(id(up))
                up = up.parent
        todo += [(p, within) for p in node.parts if isinstance(p, Node)]

    needed = least or {}
    saved: set[int] = set()  # branches that their entropy has kept against their role, and what they hold

    def cut(node: Node) -> bool:
        if node is root or id(node) in important and id(node) not in inside:
            return False
        held = id(node.parent) in saved
        if node.hinted or node.tag in BOILERPLATE:
            role = 0.0
        elif held or id(node) in inside:
            role = 1.0 if node.tag in PROSE or node.tag in MAIN else 0.5
        else:
            role = 0.0 if important and node.tag not in INLINE and node.tag not in VOID else 0.5
        if role < needed.get(paths.get(id(node)), ROLES[1]):
            return True
        if held or role == 0.0:
            saved.add(id(node))
        return False

    if important:  # text beside the article that no other element holds
        root.parts = [p for p in root.parts if isinstance(p, Node)]
    return text_of(root, cut)


def extract_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`pages` without the html and with `text` (empty if none) and `n_chars` (its code points).

    Null html is empty. Null urls share the empty host. Repeated pages are extracted alike; they count as one page of
    their host. Columns named like a result are replaced.
    """
    rest = [c for c in pages.columns if c != html and c.lower() not in ("text", "n_chars")]
    host, raw, lows, owner = (free_name(pages, c) for c in ("sst_host", "sst_html", "sst_low", "sst_of"))
    hosted = pages.select(host_of(F.col(url)).alias(host), F.col(html).alias(raw), *rest)
    tree = site_style_tree(hosted, host, raw).withColumn("least", least_role(F.col("pages"), F.col("entropy"))).where(F.col("least") != ROLES[1])
    # written first, so that Spark knows its size and broadcasts it only if it is small
    low = stored(tree.groupBy("host").agg(F.collect_list(F.struct("path", "least")).alias(lows)).select(F.col("host").alias(owner), lows), "style-tree")
    joined = hosted.join(low, F.col(host) == F.col(owner), "left").drop(owner, host)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            low_paths = batch.column(names.index(lows)).to_pylist()
            needed = ({p["path"]: p["least"] for p in paths or ()} for paths in low_paths)
            texts = [main_text(h, n) for h, n in zip(batch.column(names.index(raw)).to_pylist(), needed, strict=True)]
            kept = [batch.column(names.index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"])

    schema = pages.select(*rest).withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema
    return joined.mapInArrow(run, schema)
