"""Main text of web pages by removal of site templates."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import extended, slices, stage

#: Pages of a host, of unlike contents, and their share of the host's, that have a subtree at least for it to be the site's template.
MIN_PAGES, MIN_SHARE = 5, 0.3
#: Fixed values of HTML: elements without an end tag; with raw text; that begin a new block; that end an open p.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math object".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose headers may hold a title.
TOPS = ("article", "main")
#: Hashes of templates that may be broadcast, 8 bytes each, and parts that the pages of a host are dealt over otherwise.
BROADCAST_ROWS, SALTS = 1_000_000, 32
#: Elements and words in class, id or role that are no main text.
DROPPED = frozenset("nav aside footer form script style noscript iframe template svg math object button select textarea input menu dialog head title canvas audio video".split())
WORDS = frozenset("ad ads advert adverts advertisement alert alerts banner bio breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer menu modal nav navbar navigation newsletter notice notices pager pagination popup promo recommendations recommended related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: Those of reader comments, which are no main text however long they are.
COMMENTS = frozenset("comment comments disqus".split())
#: Words that may stand beside those in one name and say where or in what shape it is; with another word, a name means something else.
BESIDE = frozenset("main site page top bottom left right primary secondary global header inner outer wrapper wrap container box bar block area section list item items body panel pane slot unit link links button buttons icons media post posts form mobile desktop sticky fixed article articles stories author reader readers user thread".split())
VERSION = re.compile(r"v?\d+")
NAME = re.compile(r"[_-]+")
#: Dropped elements that never hold the main text, and those that do only if they hold the articles.
EMPTY = RAW | frozenset("script style noscript head title canvas audio video button select menu dialog".split())
MENUS = frozenset("nav aside footer".split())
ATTRIBUTE = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"""<!--(?:(?!-->).)*+(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""", re.S)
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    attrs: str = ""
    parts: list = field(default_factory=list)  # texts and nodes, in order
    hash: int = 0
    kinds: int = -1  # 1: named as furniture, 2: as reader comments, once asked for


def parse(source: str) -> Node:
    """A tree that takes markup as browsers do in the main: end tags may lack, unknown ones are ignored."""
    root = Node("")
    stack, at = [root], 0
    while m := TOKEN.search(source, at):
        if m.start() > at:
            stack[-1].parts.append(source[at : m.start()])
        at = m.end()
        tag, attrs, close = (m[2] or m[5] or "").lower(), m[3] or m[6] or "", m[1] or m[4]
        if not tag:
            continue
        if close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS and tag not in BLOCKS:
                    break
            continue
        if tag in BLOCKS and stack[-1].tag != "":
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open p, with what is open in it
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag == "li" and stack[-1].tag == "li":
            stack.pop()
        node = Node(tag, attrs)
        stack[-1].parts.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>|\Z", re.I).search(source, at)
            node.parts.append(source[at : end.start()])
            at = end.end()
        else:
            stack.append(node)
    if at < len(source):
        stack[-1].parts.append(source[at:])
    return root


def hashed(node: Node) -> int:
    """Hash the subtree: tag, attributes and contents in order, white space as one space."""
    bits = [node.tag, "\0", node.attrs]
    todo = [(node, iter(node.parts), bits)]
    while todo:  # no recursion: markup may be nested deeply
        now, rest, bits = todo[-1]
        for part in rest:
            if isinstance(part, Node):
                todo.append((part, iter(part.parts), [part.tag, "\0", part.attrs]))
                break
            bits.append("\1")
            bits.append(SPACE.sub(" ", part))
        else:
            todo.pop()
            now.hash = xxhash.xxh3_64_intdigest("".join(bits).encode("utf-8", "surrogatepass")) - (1 << 63)
            if todo:
                todo[-1][2].append(f"\2{now.hash}")
    return node.hash


def named(name: str, words: frozenset[str] = WORDS) -> bool:
    """Is a class, id or role one of the furniture words, alone or only with words that go with it?"""
    parts = [p for p in NAME.split(name.lower()) if p and not VERSION.fullmatch(p)]
    return any(p in words for p in parts) and all(p in WORDS or p in BESIDE for p in parts)


def kinds(node: Node) -> int:
    """Has the element a furniture class, id or role (1), one of reader comments (2)? Those of the page and of articles say what they hold."""
    if node.kinds < 0:
        names = [] if not node.attrs or node.tag in ("html", "body", *TOPS) else [n for a, b, c in ATTRIBUTE.findall(node.attrs) for n in (a or b or c).split()]
        node.kinds = any(named(n) for n in names) + 2 * any(named(n, COMMENTS) for n in names)
    return node.kinds


def length(node: Node, without: frozenset[str] = EMPTY, within: tuple[str, ...] = ()) -> int:
    """Characters in the subtree, not counting those in elements `without` and in reader comments; with `within`, only those in such elements."""
    n, todo = 0, [(node, not within or node.tag in within)]
    while todo:
        now, counts = todo.pop()
        for p in now.parts:
            if not isinstance(p, Node):
                n += len("".join(p.split())) if counts else 0
            elif p.tag not in without and kinds(p) < 2:
                todo.append((p, counts or p.tag in within))
    return n


class Page:
    """A parsed page that tells which elements are by their kind no main text."""

    def __init__(self, source: str):
        self.root = parse(source)
        self.articles = length(self.root, within=TOPS)
        self.whole = 0 if self.articles else length(self.root, EMPTY | MENUS)

    def furniture(self, node: Node, inside: bool) -> bool:
        """A header that belongs to an article may hold its title. What holds most of the page's text isn't furniture.

        That is text in articles and main elements, if it has such, or else text outside menus; a menu, aside or footer
        goes then, whatever its length. Reader comments and a form within an article always go.
        """
        if kinds(node) > 1 or inside and node.tag == "form":
            return True
        if node.tag in DROPPED or node.tag == "header" and not inside:
            if node.tag in EMPTY:
                return True
        elif not kinds(node):
            return False
        if self.articles:
            return 2 * length(node, within=() if inside else TOPS) <= self.articles
        return node.tag in MENUS or 2 * length(node, EMPTY | MENUS) <= self.whole


def blocks(page: Page, node: Node, template: frozenset[int]) -> list[str]:
    """Texts of the blocks in page order, without furniture and without the site's template."""
    out: list[str] = []
    text: list[str] = []

    def flush() -> None:
        line = SPACE.sub(" ", "".join(text)).strip()
        if line:
            out.append(line)
        text.clear()

    todo: list = [(node, iter(node.parts), node.tag in TOPS)]
    while todo:
        now, rest, inside = todo[-1]
        for part in rest:
            if not isinstance(part, Node):
                text.append(html.unescape(part))  # each piece by itself: markup parts references
            elif part.hash in template or page.furniture(part, inside):
                if part.tag in BLOCKS:
                    flush()
            elif part.tag == "br":
                text.append(" ")
            else:
                if part.tag in BLOCKS:
                    flush()
                todo.append((part, iter(part.parts), inside or part.tag in TOPS))
                break
        else:
            todo.pop()
            if now.tag in BLOCKS:
                flush()
    flush()
    return out


def main_text(source: str, template: frozenset[int] = frozenset()) -> str:
    page = Page(source)
    if template:
        hashed(page.root)
    return "\n".join(blocks(page, page.root, template))


def kept(page: Page) -> Iterator[Node]:
    """The elements that blocks() comes to when there is no template."""
    todo = [(page.root, False)]
    while todo:
        now, inside = todo.pop()
        yield now
        inside = inside or now.tag in TOPS
        todo += [(p, inside) for p in now.parts if isinstance(p, Node) and not page.furniture(p, inside)]


def every(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        now = todo.pop()
        yield now
        todo += [p for p in now.parts if isinstance(p, Node)]


def subtrees(source: str) -> tuple[int, set[int]]:
    """Hash of what the page has of its own, and hashes of the subtrees that may be template: blocks with some contents, furniture too.

    Its own are its articles (or main elements), if they hold half of its text, so one article among changing adverts is
    one content, while pages that only share a teaser are many; else all of it.
    """
    page = Page(source)
    root = page.root
    hashed(root)
    found = list(kept(page))
    whole, tops = sum(map(len, blocks(page, root, frozenset()))), [root]
    for tag in TOPS:
        these = [n for n in found if n.tag == tag]
        if whole and 2 * sum(len(line) for n in these for line in blocks(page, n, frozenset())) >= whole:
            tops = these
            break
    own = xxhash.xxh3_64_intdigest(",".join(str(n.hash) for n in tops)) - (1 << 63)
    return own, {n.hash for n in every(root) if n.tag in BLOCKS and n.tag not in ("html", "body", "hr", *TOPS) and n.parts}


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """(host, content, subtree), once for each content of a page, and with a null subtree for the content itself; staged."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hosts, keys, trees = [], [], []
            for h, source in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):
                content, own = subtrees(source) if source else (0, set())
                hosts += [h] * (len(own) + 1)
                keys += [content] * (len(own) + 1)
                trees += [None, *own]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(trees, pa.int64())], ["host", "content", "subtree"])

    rows = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(found, "host string, content long, subtree long")
    return stage(rows.distinct(), "subtrees")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text (main text; empty if none) for every row.

    1. Per page the hashes of its block subtrees; 2. counted per host; 3. subtrees on at least min_pages pages of
    unlike contents of the host, and on at least min_share of all such, are its template and are deleted, in articles and main elements as elsewhere; pages with
    one article in other surroundings are one content. What lies outside an article stays unless it is template or goes
    by its kind, as menus, forms, adverts, comments and the like do.
    Character references are decoded, white space in a block becomes one space, blocks are joined by line ends. A null
    or empty html gives an empty text; a null url is a host of its own; repeated rows give repeated rows; other columns
    are left out; an empty table gives no row.
    """
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    seen = page_subtrees(pages)
    counted = seen.filter("subtree is not null").groupBy("host", "subtree").count().filter(F.col("count") >= min_pages)
    total = seen.filter("subtree is null").groupBy("host").agg(F.count("*").alias("pages"))
    counted = counted.join(total, "host").filter(F.col("count") >= F.col("pages") * min_share)
    templates = stage(counted.groupBy("host").agg(F.collect_list("subtree").alias("template"), F.count("*").alias("size")), "templates")
    rows = templates.agg(F.coalesce(F.sum(F.col("size") + 10), F.lit(0))).first()[0]
    keyed = pages.withColumn("host", host(F.col("url")))
    if rows <= BROADCAST_ROWS:
        keyed = keyed.join(F.broadcast(templates), "host", "left")
    else:  # a host of very many pages is dealt over many tasks
        spread = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int")).join(spread, ["host", "salt"], "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [main_text(source, frozenset(template or ())) if source else "" for source, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    schema = extended(pages.select("page_id", "url"), "text string")
    return keyed.select("page_id", "url", "html", "template").mapInArrow(texts, schema)
