"""Main text of web pages by removal of site templates.

1. Each page is read into a light tree; every element that holds text gets a hash of its
   tag, classes, text and children.
2. Spark counts, per host, on how many different pages a subtree occurs. Pages whose main
   part has the same first heading or paragraph count once, so copies of an article do not make it a template.
3. Subtrees on at least `min_pages` pages and on a share of at least `min_share` of the
   host's pages are the host's template and are deleted (paragraphs of an article stay), and
   so is what its markup names as menu, header, footer, sidebar, notice, advert, form, script, style or comments.
4. What remains inside the article or articles (else the main part, else the body) is the text: one
   line per block, white space inside a block as one blank.

Null or empty html gives an empty text. Pages without a host (null or malformed url) are
extracted by their markup alone. Broken and cut-off markup is read as far as it goes.
Repeated rows are extracted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import checked_small, in_batches
from textmill.runtime import materialize

MIN_PAGES = 5
MIN_SHARE = 0.2

RAW = "script style noscript template textarea title iframe svg math select object".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var""".split())
DROPPED_TAGS = frozenset("nav footer aside form button dialog menu head".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu".split())
# Words in class names and ids that mark parts that are not the article.
DROPPED_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login sidebar widget menu
nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar comment comments disqus reply
replies respond discussion related recommended share sharing social toolbar""".split())
# Of these, words that an author may use for a part of the article. Inside it, a part so named goes only if it has no
# paragraph, or is named as reader comments as well.
AUTHORED_NAMES = frozenset("discussion related recommended menu social promotion widget".split())
# Elements that end an open element of the same group when they begin.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Running text of an article: never a template there, since copies of articles share paragraphs.
PROSE = HEADINGS | frozenset("p li dt dd td th tr blockquote pre article main".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b[^>]*(?:/>|>.*?(?:</\1\s*>|\Z)|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|[^<]+|<", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


class Node:
    __slots__ = ("tag", "cls", "rule", "kids", "size", "core", "hash", "heading", "prose")

    def __init__(self, tag: str, cls: str = "", rule: str = ""):
        self.tag, self.cls, self.rule = tag, cls, rule
        self.kids: list[Node | str] = []
        self.size, self.core, self.hash, self.heading, self.prose = 0, False, 0, tag in HEADINGS, False


def _named(names: str) -> str:
    rule = ""
    for name in names.split():
        if name.startswith(("has-", "with-", "no-")):
            continue
        for part in _NAME_PARTS.findall(name):
            if (word := part.lower()) in DROPPED_NAMES:
                if word not in AUTHORED_NAMES:
                    return "header" if word == "header" else "drop"
                rule = "authored"
    return rule


def _open(tag: str, attributes: str) -> Node:
    cls, rule = "", "header" if tag == "header" else "drop" if tag in DROPPED_TAGS else ""
    if attributes and not attributes.isspace():
        found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        cls = found.get("class", "")
        if not rule and tag not in ("html", "body", "main"):
            rule = _named(f"{cls} {found.get('id', '')}")
        if found.get("role", "").lower() in DROPPED_ROLES or found.get("aria-hidden") == "true" or re.search(
                r"(?:^|\s)hidden(?=\s|/|=|$)", re.sub(_ATTRIBUTE, " ", attributes)):
            rule = "drop"
    return Node(tag, cls, rule)


def parse(html: str) -> Node:
    """The tree of a page: block elements, and inline ones only if their markup says that they go."""
    root = Node("#")
    stack = [root]

    def close() -> None:
        node = stack.pop()
        up = stack[-1]
        up.size += node.size
        up.core |= node.core or node.tag in ("article", "main")
        up.heading |= node.heading
        up.prose |= node.prose or node.tag == "p" and node.size > 0
        if node.size:
            x = xxhash.xxh3_64(f"{node.tag}\0{node.cls}")
            for k in node.kids:
                x.update(b"\1" + k.encode() if isinstance(k, str) else k.hash.to_bytes(8, "little"))
            node.hash = x.intdigest()

    for m in _TOKEN.finditer(html):
        tag = m[3]
        if tag is None:
            s = m[0]
            if s[0] != "<" or s == "<":
                text = unescape(s)
                stack[-1].kids.append(text)
                stack[-1].size += len(text.strip())
            continue
        tag = tag.lower()
        if m[2]:
            if any(n.tag == tag for n in stack):
                # An end tag inside an article does not end what is around it.
                depth = max(i for i, n in enumerate(stack) if n.tag == tag)
                if tag in ("article", "main", "body", "html") or not any(n.tag == "article" for n in stack[depth + 1:]):
                    while len(stack) > depth:
                        close()
            elif tag == "p":
                stack[-1].kids.append(Node("p"))
            continue
        if tag in VOID:
            stack[-1].kids.append(" " if tag in ("br", "wbr", "img") else Node(tag))
            continue
        if tag in INLINE:
            node = _open(tag, m[4])
            if not node.rule:
                continue
        else:
            node = _open(tag, m[4])
            ends = CLOSES.get(tag, {"p"})
            while stack[-1].tag in ends or stack[-1].tag in INLINE and len(stack) > 1 and stack[-2].tag in ends:
                close()
        stack[-1].kids.append(node)
        if not (m[4] and m[4].endswith("/")):
            stack.append(node)
    while len(stack) > 1:
        close()
    return root


def _dropped(node: Node, template: frozenset | set, inside: bool) -> bool:
    """Whether a subtree goes. What holds the article stays; a header inside keeps its headings."""
    if node.core or node.tag in ("article", "main") and not node.rule:
        return False
    if inside and (node.rule == "header" and node.heading or node.rule == "authored" and node.prose):
        return False
    return bool(node.rule) or node.hash in template and not (inside and node.tag in PROSE)


def _regions(root: Node, template: frozenset | set) -> list[Node]:
    """The articles, else the main part, else the whole page."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in found and not (node.rule and not node.core):
            found[node.tag].append(node)
            if node.tag == "article":
                continue
        todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not _dropped(k, template, False)]
    return found["article"] or found["main"] or [root]


def main_text(root: Node, template: frozenset | set = frozenset()) -> str:
    lines: list[str] = []
    part: list[str] = []

    def end() -> None:
        if part and (line := " ".join("".join(part).split())):
            lines.append(line)
        part.clear()

    for region in _regions(root, template):
        # (node, whether only headings are kept); None ends a block.
        todo: list = [(k, False) for k in reversed(region.kids)]
        while todo:
            node, only = todo.pop()
            if node is None:
                end()
            elif isinstance(node, str):
                if not only:
                    part.append(node)
            elif not _dropped(node, template, True):
                inner = (only or node.rule == "header") and node.tag not in HEADINGS
                if node.tag not in INLINE:
                    end()
                    todo.append((None, False))
                todo += [(k, inner) for k in reversed(node.kids)]
        end()
    return "\n".join(lines)


def subtree_hashes(root: Node) -> set[int]:
    out, todo = set(), [root]
    while todo:
        node = todo.pop()
        if node.size and node.tag not in ("#", "html", "body"):
            out.add(node.hash)
        todo += [k for k in node.kids if isinstance(k, Node)]
    return out


def article_mark(root: Node) -> int:
    """The hash of the first heading or paragraph with text in the main part (else of the whole text): copies share it."""
    for region in _regions(root, frozenset()):
        todo = list(reversed(region.kids))
        while todo:
            node = todo.pop()
            if isinstance(node, Node) and not _dropped(node, frozenset(), True):
                if node.size and (node.tag == "p" or node.tag in HEADINGS):
                    return node.hash
                todo += reversed(node.kids)
    return xxhash.xxh3_64_intdigest(main_text(root))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def host_of(url: Column) -> Column:
    """The lower-case host of a url; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def site_templates(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES,
                   min_share: float = MIN_SHARE) -> DataFrame:
    """`host, template`: the hashes of each host's recurring subtrees."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            hosts, subtrees, page = [], [], []
            for host, h in zip(batch.column("host").to_pylist(), batch.column("html")):
                root = parse(h.as_py() or "")
                own = _signed(article_mark(root))
                found = subtree_hashes(root)
                hosts += [host] * len(found)
                subtrees += map(_signed, found)
                page += [own] * len(found)
            yield {"host": hosts, "subtree": subtrees, "page": page}

    narrow = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).where(F.col("host").isNotNull())
    found = materialize(in_batches(narrow.withColumn("host", F.xxhash64("host")), work,
                                   "host long, subtree long, page long").distinct(), "subtrees")
    sizes = checked_small(found.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages")),
                          name="hosts")
    counted = found.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    return (counted.join(sizes, "host").where(F.col("n") >= min_share * F.col("pages"))
            .groupBy("host").agg(F.collect_list("subtree").alias("template")))


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None,
                 min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """For every row: the columns `keep`, and text."""
    keep = ["page_id", "url"] if keep is None else keep
    templates = checked_small(site_templates(pages, url, html, min_pages, min_share), 20_000, "templates")
    rows = (pages.select(*keep, F.xxhash64(host_of(F.col(url))).alias("_host"), F.col(html).alias("_html"))
            .join(templates.select(F.col("host").alias("_host"), F.col("template").alias("_template")), "_host", "left"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {**{c: batch.column(c) for c in keep}, "text": [
                main_text(parse(h.as_py() or ""), {x & (1 << 64) - 1 for x in t.as_py() or ()})
                for h, t in zip(batch.column("_html"), batch.column("_template"))]}

    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    return in_batches(rows, work, schema)
