"""Operator 4, HTML extraction by site template removal.

Every page is cut into its element tree. Each element's subtree has a hash of
its tags, names and text; per host, Spark counts on how many pages each
subtree occurs, and a subtree that recurs on many pages of its host is part of
the site's template: it is deleted. Counting is one grouped sum over
(host, hash), pre-aggregated before the shuffle, so a host with any share of
all pages is never gathered.

Only boxes are template candidates (``div``, ``section``, ``ul``, ``table``,
``header``, ...). The page's main element and the running text in it
(paragraphs, headings, quotes, ...) are not: an article or a passage that is
published on many pages is still content. Boxes that name themselves as
something other than the article (``nav``, ``footer``, ``aside``, ``form``, a
class such as ``ad`` or ``comments``) are deleted on any page, recurring or
not.

The rest is the text: of ``article`` or ``main`` elements if the page has any,
else of the body. Character references are decoded, white space inside a
block becomes one space, blocks are joined in page order by one space.

Defined results: null and empty html give an empty text; a page without a
host shares the empty host; truncated and unclosed markup is read like a
browser would; repeated rows (same page_id) get equal results and count as one
page; other columns never reach the result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace, table

#: A subtree is template if it is on at least this many pages of its host ...
MIN_PAGES = 5
#: ... and on at least this share of them.
MIN_SHARE = 0.05

#: Deepest nesting that the tree keeps.
MAX_DEPTH = 200

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; their text never counts.
RAW = frozenset("script style textarea noscript template iframe noembed noframes xmp title svg math object canvas select".split())
#: Elements that end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
#: Boxes that are never the article.
OUTSIDE = frozenset("nav footer aside form menu dialog button header head search fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Boxes that may be template; running text may not.
BOX = frozenset("div section ul ol dl table header footer nav aside form menu figure details center span dialog hgroup iframe".split())
#: Words of a class or id that mark a box as no part of the article.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertis\w+|adsense|adslot|banner|promo\w*|sponsor\w*|sidebar\w*|side|aside|rail|"
    r"nav\w*|menu\w*|breadcrumb\w*|crumbs?|footer\w*|foot|header|masthead|topbar|toolbar|cookie\w*|consent|gdpr|notice\w*|alert|"
    r"disclaimer|popup|modal|overlay|newsletter|subscri\w+|signup|login|share|sharing|social|follow|related|recommend\w*|"
    r"comment|comments|commentlist|respond|reply|replies|disqus|pagination|pager|paging|widget\w*|skip|hidden|copyright|legal|"
    r"search\w*|tags?|toc)(?:$|[\s_-])",
    re.I,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Opening one of these closes an open element of the named kinds.
_CLOSES = {
    **dict.fromkeys(BLOCK - {"br", "html", "body", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}, ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
#: Such a search for an element to close stops at these.
_SCOPE = frozenset("table ul ol dl article main section div body html aside nav footer header form blockquote td th select".split())


class Node:
    """An element: tag, names (class, id, role), children (text or Node)."""

    __slots__ = ("tag", "names", "role", "hidden", "kids", "hash", "size")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.names, self.role, self.hidden = tag, "", "", False
        self.kids: list[str | Node] = []
        if attrs:
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    self.names = f"{self.names} {value}"
                elif name == "role":
                    self.role = value.strip().lower()
                elif name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    self.hidden = True
            if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", _ATTR.sub(" ", attrs), re.I):
                self.hidden = True


def parse(text: str | None) -> Node:
    """The element tree. Every character of the page is looked at once."""
    text = text or ""
    root = Node("#root")
    stack, at = [root], 0
    while m := _TOKEN.search(text, at):
        if m.start() > at:
            stack[-1].kids.append(text[at : m.start()])
        at = m.end()
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        if m["close"]:
            if any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            elif tag == "p":
                stack[-1].kids.append(Node("br"))
            continue
        if shut := _CLOSES.get(tag):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in shut:
                    if tag != "p" or stack[k].tag == "p":
                        del stack[k:]
                elif stack[k].tag in _SCOPE:
                    break
        node = Node(tag, m["attrs"])
        stack[-1].kids.append(node)
        if tag in RAW:
            if not m["attrs"].endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(text, at)
                at = end.end() if end else len(text)
        elif tag not in VOID and len(stack) < MAX_DEPTH:  # deeper elements become siblings, as in browsers
            stack.append(node)
    if at < len(text):
        rest = text[at:]
        stack[-1].kids.append(rest[: rest.find("<")] if re.search(r"<[a-zA-Z/!?][^>]*$", rest) else rest)
    return root


def _hash(node: Node) -> bytes:
    """Hash of tag, names and all that is in the subtree; also its text size."""
    h = xxhash.xxh3_128(f"<{node.tag} {node.names}>".encode("utf-8", "surrogatepass"))
    node.size = 0
    for k in node.kids:
        if isinstance(k, str):
            words = k.split()
            if words:
                node.size += sum(map(len, words))
                h.update(" ".join(words).encode("utf-8", "surrogatepass"))
        else:
            h.update(_hash(k))
            node.size += k.size
    node.hash = h.digest()
    return node.hash


def _walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))


def _named_outside(node: Node) -> bool:
    if node.tag in RAW or node.hidden or node.role in OUTSIDE_ROLES:
        return True
    if node.tag in OUTSIDE:
        return True
    return bool(node.names) and node.tag not in ("article", "main", "body", "html") and bool(NAMED.search(node.names))


def _main(root: Node) -> list[Node]:
    """The outermost main content elements that are not outside themselves."""
    for tags, roles in ((("article",), ("article",)), (("main",), ("main",))):
        found, stack = [], [root]
        while stack:
            n = stack.pop()
            if n is not root and _named_outside(n) and n.tag != "header":
                continue
            if n.tag in tags or n.role in roles:
                found.append(n)
            else:
                stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))
        if found:
            return found
    return []


def candidates(root: Node) -> dict[int, int]:
    """Hash (signed 64 bits) to text size of the subtrees that may be template."""
    _hash(root)
    mains = set(map(id, _main(root)))
    holds = set()  # boxes around a main element are no candidates

    def mark(n: Node) -> bool:
        inside = [mark(k) for k in n.kids if isinstance(k, Node)]
        if id(n) in mains or any(inside):
            holds.add(id(n))
            return True
        return False

    mark(root)
    return {key(n): n.size for n in _walk(root) if n.tag in BOX and id(n) not in holds and n.size}


def key(node: Node) -> int:
    return int.from_bytes(node.hash[:8], "little", signed=True)


def _blocks(node: Node, template: frozenset, out: list[list[str]], protected: frozenset) -> None:
    for k in node.kids:
        if isinstance(k, str):
            out[-1].append(k)
            continue
        block = k.tag in BLOCK
        if block:
            out.append([])
        header = k.tag == "header" and node.tag in ("article", "main")  # an article's own head line
        skip = (_named_outside(k) and not header) or (bool(template) and k.tag in BOX and id(k) not in protected and key(k) in template)
        if not skip:
            _blocks(k, template, out, protected)
        if block:
            out.append([])


def text_of(root: Node, template: frozenset = frozenset()) -> str:
    """The page's main text once the subtrees in ``template`` are deleted."""
    if template and not hasattr(root, "hash"):
        _hash(root)
    mains = _main(root)
    protected = frozenset(map(id, mains))
    blocks: list[list[str]] = [[]]
    for n in mains or [root]:
        blocks.append([])
        _blocks(n, template, blocks, protected)
    joined = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return " ".join(b for b in joined if b)


def host(url: Column) -> Column:
    """Lower-case host of a url without port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, html) to (host, hash, pages), added up within the task."""
    sums: Counter = Counter()
    for df in batches:
        for h, text in zip(df["host"], df["html"], strict=True):
            sums.update((h, k) for k in candidates(parse(text)))
            sums[h, None] += 1
        if len(sums) > 500_000:
            yield _frame(sums)
            sums.clear()
    if sums:
        yield _frame(sums)


def _frame(sums: Counter) -> pd.DataFrame:
    hosts, hashes = zip(*sums, strict=True)
    return pd.DataFrame({"host": hosts, "hash": pd.array(hashes, dtype="Int64"), "pages": np.fromiter(sums.values(), np.int64, len(sums))})


def templates(pages: DataFrame, work: Workspace) -> DataFrame:
    """(host, hash) of the subtrees that recur across many pages of a host.
    ``pages`` has host and html, one row a page. The counts are staged: the
    hosts' page numbers and the frequent subtrees both read them."""
    counts = pages.select("host", "html").mapInPandas(_count, "host string, hash long, pages long")
    counts = work.put(counts.groupBy("host", "hash").agg(F.sum("pages").alias("pages")), "counts")
    total = counts.where("hash is null").select("host", F.col("pages").alias("total"))
    often = counts.where(F.col("hash").isNotNull() & (F.col("pages") >= MIN_PAGES))
    return often.join(total, "host").where(F.col("pages") >= MIN_SHARE * F.col("total")).select("host", "hash")


def extract(df: DataFrame, work: Workspace, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A host has at most 1 / MIN_SHARE disjoint full-size templates, nested ones
    multiply that by their depth; the list of a host joins its pages as one
    array, by a join that Spark broadcasts or shuffles by size."""
    rows = df.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")
    )
    found = work.put(templates(rows, work), "templates").groupBy("host").agg(F.collect_list("hash").alias("template"))

    @F.pandas_udf("string")
    def main_text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages, template in batches:
            yield pd.Series(
                [text_of(parse(p), frozenset(t) if t is not None else frozenset()) for p, t in zip(pages, template, strict=True)], dtype=object
            )

    out = rows.join(found, "host", "left").select("page_id", "url", main_text("html", "template").alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), Workspace(spark, "op4"))
