"""Main text of web pages by wrappers inferred per host.

A page's token stream has its block elements and texts. A wrapper is a union-free
regular expression over such streams: elements, text slots, optional groups and
repeated groups, each from a start tag to its end tag. Streams of a host are aligned
element by element: the same tag and class under aligned parents is the same element.
What a parent lacks becomes optional, what comes again under one parent becomes a
repeated group. A text that all pages of the host have at a place is part of the
template; where pages differ there is a slot. All of this is counts, so wrappers are
summed in any order and a host with a third of all pages sends a row per element and
text of a task.

The slots, with how much text went through each, tell which element holds the article.
A page's text is what lies in that element, without the template's texts and the parts
that are never article text.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.storage import stored
from metricloom.llm.url_rules import host_of

# How elements are read.
RAW = "script style textarea title noscript iframe xmp"
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd label mark nobr q"
    " s samp small span strike strong sub sup time tt u var wbr br".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figure"
    " figcaption footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section"
    " table ul li tr td th tbody thead tfoot".split()
)
ENDS_SAME = frozenset("p li dt dd tr td th option".split())
NEVER_TEXT = frozenset(
    "nav header footer aside button select option head object svg canvas dialog menu"
    " template script style noscript iframe textarea title".split()
)
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " cookie cookies consent notice notices comment comments commentlist disqus reply replies"
    " respond sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead"
    " share sharing social related recommended newsletter subscribe popup modal widget widgets"
    " pagination pager login signup search feedback teaser teasers".split()
)
# Words that say nothing beside one of these: "site-footer" is a footer, "has-sidebar" is not a sidebar.
PLAIN_NAMES = frozenset(
    "site page main global top bottom left right center primary secondary upper lower box block"
    " bar container wrapper wrap inner outer area section zone list item items entry post article"
    " link links button buttons icon icons form slot unit thread title text toggle panel user users"
    " reader readers visitor visitors".split()
)
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split()
)
MAIN_TAGS = ("article", "main")

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?P<raw>{RAW.replace(" ", "|")})\b[^>]*+>.*?(?:</(?P=raw)[^>]*+>|\Z)
    |<(?P<shut>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:"[^"]*+"|'[^']*+'|[^'">])*+)>
    |<(?P<shut2>/?)(?P<tag2>[A-Za-z][A-Za-z0-9:-]*)(?P<rest2>[^>]*+)>
    |<[!?/][^>]*+(?:>|\Z)
    |<[A-Za-z][^>]*+\Z
    |(?P<text>[^<]++|<)""",
    re.S | re.I | re.X,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-z0-9]+")
# A text at a place is the template's if all of so many pages or more have it there.
LEAST_PAGES = 10
# Elements and texts that a task counts before it sends them.
ROWS_AT_ONCE = 200_000


# Why an element is never text: its names, which may be wrong, or what it is.
BY_NAME, BY_KIND = 1, 2


def _never_name(name: str) -> bool:
    """Whether a whole name, not just a word in it, says that it is no article text."""
    found = NAME.findall(name)
    return not NEVER_NAMES.isdisjoint(found) and all(
        w in NEVER_NAMES or w in PLAIN_NAMES or w.isdigit() for w in found
    )


def _attributes(rest: str) -> tuple[str, int]:
    """The class to know the element by, and why it is no article text: 0, BY_NAME or BY_KIND."""
    name, never = "", 0
    for kind, *values in NAMED.findall(rest):
        value = "".join(values).lower()
        if kind.lower() == "role":
            never = max(never, BY_KIND * (value.strip() in NEVER_ROLES))
            continue
        never = max(never, BY_NAME * any(map(_never_name, value.split())))
        if kind.lower() == "class" and value.split() and not re.search("[0-9]", value):
            name = value.split()[0]
    return name, never


ROOT, SLOT = 0, "#"
# An element of a page or wrapper: its parent, tag and class, pages that have it, how often
# it comes, parents that have it, most under one parent, sum over pages of its place among
# its parent's elements, characters in it.
PARENT, STEP, PAGES, TIMES, PARENTS, MOST, PLACE, HELD = range(8)


def child(node: int, step: str) -> int:
    """The number of an element or text in a node; the same on every page."""
    n = xxhash.xxh64_intdigest(step, seed=node & (1 << 64) - 1)
    return n - (1 << 64) if n >> 63 else n


class Tree:
    """The elements of one page that hold text, aligned with each other."""

    def __init__(self) -> None:
        self.nodes: dict[int, list] = {}
        self.texts: dict[int, tuple[int, int]] = {}
        self.open: list[tuple[int, dict[int, int]]] = [(ROOT, {})]

    def start(self, step: str) -> int:
        parent, inside = self.open[-1]
        at = child(parent, step)
        if at not in self.nodes:
            self.nodes[at] = [parent, step, 1, 0, 0, 0, len(inside), 0]
        n = inside[at] = inside.get(at, 0) + 1
        node = self.nodes[at]
        node[TIMES] += 1
        node[PARENTS] += n == 1
        node[MOST] = max(node[MOST], n)
        self.open.append((at, {}))
        return at

    def end(self) -> None:
        self.open.pop()

    def text(self, text: str) -> int:
        """Adds a text to the innermost open element, and returns that."""
        at = self.open[-1][0]
        self.nodes[self.start(SLOT)][HELD] += len(text)
        self.end()
        self.texts[child(at, text)] = at, len(text)
        return at

    def holding(self) -> dict[int, list]:
        """The elements that hold text, with how much."""
        held = {at: node[HELD] for at, node in self.nodes.items()}
        # A parent comes before what is in it.
        for at, node in reversed(self.nodes.items()):
            if node[PARENT] != ROOT:
                held[node[PARENT]] += held[at]
        return {at: [*n[:HELD], held[at]] for at, n in self.nodes.items() if held[at]}


class Page:
    """The blocks of a page as (element, text), and its tree.

    An article or main is text whatever the names of the elements around it, and in a
    form, unless these lie in an article or main themselves. Without ``names``, no
    block element's names count, and forms are like other elements.
    """

    def __init__(self, source: str, names: bool = True) -> None:
        self.names, self.named = names, False
        self.blocks: list[tuple[int, str]] = []
        self.tree = Tree()
        # Open elements: tag, why it or what it lies in is never text, and whether the
        # tree has it.
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]
        self.pieces: list[str] = []
        for token in TOKEN.finditer(source):
            if token["text"] is not None:
                if not self.open[-1][1]:
                    self.pieces.append(token["text"])
            elif tag := token["tag"] or token["tag2"]:
                rest = token["rest"] if token["tag"] else token["rest2"]
                if token["shut"] or token["shut2"]:
                    self._shut(tag.lower())
                else:
                    self._start(tag.lower(), rest or "")
        self._block()
        while len(self.open) > 1:
            self._pop()

    def _block(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            self.pieces = []
            if text:
                self.blocks.append((self.tree.text(text), text))

    def _pop(self) -> None:
        if self.open.pop()[2]:
            self.tree.end()

    def _start(self, tag: str, rest: str) -> None:
        if tag in INLINE and tag != "br":
            # An inline element matters only if it is never text, or lies in the same.
            if tag in VOID or rest.endswith("/"):
                return
            outer, never, _ = self.open[-1]
            if (never and outer == tag) or (rest and _attributes(rest)[1]):
                self.open.append((tag, BY_KIND, False))
            return
        if tag == "br":
            self.pieces.append(" ")
            return
        self._block()
        if tag in ENDS_PARAGRAPH:
            self._imply(tag)
        if tag in VOID:
            return
        name, never = _attributes(rest)
        if tag in ("html", "body"):
            never = 0
        elif tag in MAIN_TAGS:
            # "post comments-open" is an article, "comment-body" is not.
            never = BY_NAME * (not NEVER_NAMES.isdisjoint(NAME.findall(name)[:1]))
        elif tag == "form":
            never = max(never, BY_NAME)
        if never == BY_NAME:
            self.named = True
            never *= self.names
        if tag in NEVER_TEXT:
            never = BY_KIND
        step = tag + ("." + name if name else "")
        above = self.open[-1][1]
        if above == BY_NAME and tag in MAIN_TAGS and not never:
            above = BY_NAME * any(t in MAIN_TAGS and not why for t, why, _ in self.open)
        if above:
            self.open.append((tag, max(above, never), False))
            return
        self.tree.start(step)
        self.open.append((tag, never, True))

    def _imply(self, tag: str) -> None:
        """Ends an open paragraph, or the open item that this one follows."""
        while self.open[-1][0] in INLINE:
            self._pop()
        if self.open[-1][0] == "p" or (tag in ENDS_SAME and self.open[-1][0] == tag):
            self._pop()

    def _shut(self, tag: str) -> None:
        if tag in INLINE:
            if self.open[-1][0] == tag:
                self._pop()
            return
        self._block()
        if any(tag == t for t, *_ in self.open):
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()


def page_of(source: str | None) -> Page:
    """The page; if names leave nothing of it, the page read without them."""
    page = Page(source or "")
    return Page(source or "", names=False) if page.named and not page.blocks else page


def add(into: dict[int, list], nodes: dict[int, list]) -> None:
    """Aligns a page's or wrapper's elements with a wrapper's."""
    for at, node in nodes.items():
        if (known := into.get(at)) is None:
            into[at] = list(node)
            continue
        for i in (PAGES, TIMES, PARENTS, PLACE, HELD):
            known[i] += node[i]
        known[MOST] = max(known[MOST], node[MOST])


def _children(nodes: dict[int, list]) -> dict[int, list[int]]:
    """Each element's own, in the order in which most pages have them."""
    inside: dict[int, list[int]] = defaultdict(list)
    for at, node in sorted(nodes.items(), key=lambda x: (x[1][PLACE] / x[1][PAGES], x[1][STEP])):
        inside[node[PARENT]].append(at)
    return inside


def expression(nodes: dict[int, list]) -> str:
    """The wrapper as a regular expression: ? optional, + repeated, * both, # a text."""
    inside, out = _children(nodes), []
    left: list[int | str] = list(reversed(inside[ROOT]))
    while left:
        at = left.pop()
        if isinstance(at, str):
            out.append(at)
            continue
        parent, step, *_ = node = nodes[at]
        optional = parent in nodes and node[PARENTS] < nodes[parent][TIMES]
        again = node[MOST] > 1
        mark = "*" if optional and again else "+" if again else "?" if optional else ""
        start, end = "(" * bool(mark), ")" * bool(mark) + mark
        if step == SLOT:
            out.append(start + step + end)
        else:
            out.append(start + step)
            left.append(f"/{step}{end}")
            left += reversed(inside[at])
    return " ".join(out)


def path_of(nodes: dict[int, list], at: int) -> str:
    steps = []
    while at != ROOT:
        steps.append(nodes[at][STEP])
        at = nodes[at][PARENT]
    return "".join("/" + step for step in reversed(steps))


def main_element(nodes: dict[int, list], fixed: dict[int, int] | None = None) -> int:
    """The element that holds the article: article or main, else the one with most text.

    ``fixed`` has the characters of the template's texts by element; they do not count
    where others are left. A main is preferred to an article that holds less than half
    of its text. On the way down, an element that holds most of what its parent does is
    the better choice.
    """
    held = {at: node[HELD] for at, node in nodes.items() if node[STEP] != SLOT}
    for at, characters in (fixed or {}).items():
        while at != ROOT:
            held[at] -= characters
            at = nodes[at][PARENT]
    held = {at: n for at, n in held.items() if n > 0}
    if not held:
        return main_element(nodes) if fixed else ROOT
    depth: dict[int, int] = {ROOT: 0}
    inside: dict[int, list[int]] = defaultdict(list)
    for at in held:
        way = [at]
        while way[-1] not in depth:
            way.append(nodes[way[-1]][PARENT])
        for outer, inner in zip(way[:0:-1], way[-2::-1], strict=True):
            depth[inner] = depth[outer] + 1
        inside[nodes[at][PARENT]].append(at)
    article, main = (
        max(
            (at for at in held if nodes[at][STEP].partition(".")[0] == tag),
            key=lambda at: (held[at], -depth[at], at),
            default=ROOT,
        )
        for tag in MAIN_TAGS
    )
    if article or main:
        return article if 2 * held.get(article, 0) >= held.get(main, 0) else main
    best = ROOT
    while inside[best]:
        top = max(inside[best], key=lambda at: (held[at], nodes[at][STEP]))
        if not inside[top] or 2 * held[top] < held.get(best, held[top]):
            break
        best = top
    return best


def main_text(source: str | None, main: int | None, fixed: list[int] | None = None) -> str:
    """The text blocks in the wrapper's main element, else those in the page's own.

    Blocks of the template's texts go, unless they are most of the text: then the page is
    one of few articles that the host has many copies of.
    """
    page = page_of(source)
    if not page.blocks:
        return ""
    holds = {ROOT: main == ROOT}

    def inside(at: int) -> bool:
        way = []
        while at not in holds and at != main:
            way.append(at)
            at = page.tree.nodes[at][PARENT]
        within = at == main or holds[at]
        holds.update(dict.fromkeys(way, within))
        return within

    found = [(at, t) for at, t in page.blocks if inside(at)] if main is not None else []
    if not found:
        main = main_element(page.tree.holding())
        holds = {ROOT: main == ROOT}
        found = [(at, t) for at, t in page.blocks if inside(at)]
    elif fixed:
        template = set(fixed)
        own = [(at, t) for at, t in found if child(at, t) not in template]
        if 2 * sum(len(t) for _, t in own) >= sum(len(t) for _, t in found):
            found = own
    return "\n".join(t for _, t in found)


COUNTED = (
    "host string, node long, key long, parent long, step string, pages long, times long,"
    " parents long, most long, place long, held long"
)


def _counted(pages: DataFrame) -> DataFrame:
    """Rows of elements (key null) and of their texts, summed by host."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str | None, dict[int, list]] = defaultdict(dict)
        texts: dict[tuple, list[int]] = {}
        n = 0

        def rows() -> pa.RecordBatch:
            found = [(h, at, None, *node) for h, nodes in hosts.items() for at, node in nodes.items()]
            found += [(h, at, key, None, None, times, 0, 0, 0, 0, size) for (h, key), (at, times, size) in texts.items()]
            hosts.clear()
            texts.clear()
            names = [c.split()[0] for c in COUNTED.split(",")]
            kinds = [pa.string() if c.endswith("string") else pa.int64() for c in COUNTED.split(",")]
            columns = list(zip(*found, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        for batch in batches:
            for host, source in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                tree = page_of(source).tree
                add(hosts[host], tree.holding())
                for key, (at, size) in tree.texts.items():
                    row = texts.setdefault((host, key), [at, 0, 0])
                    row[1] += 1
                    row[2] += size
                n += len(tree.texts) + len(tree.nodes)
                if n >= ROWS_AT_ONCE:
                    n = 0
                    if any(hosts.values()):
                        yield rows()
        if any(hosts.values()):
            yield rows()

    summed = ("pages", "times", "parents", "place", "held")
    return (
        pages.select(host_of(F.col("url")).alias("host"), "html")
        .mapInArrow(partial, COUNTED)
        .groupBy("host", "node", "key")
        .agg(
            F.first("parent").alias("parent"),
            F.first("step").alias("step"),
            F.max("most").alias("most"),
            *[F.sum(c).alias(c) for c in summed],
        )
    )


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, main, main_node, fixed), from all pages of the host.

    The wrapper is written as a regular expression, main is the path of its main element
    and fixed has the template's texts in it, by number. A host's row is made from its
    distinct elements and template texts.
    """

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        is_node = part["key"].isna()
        columns = ["parent", "step", "pages", "times", "parents", "most", "place", "held"]
        nodes = {
            int(at): [int(row[0]), row[1], *map(int, row[2:])]
            for at, *row in part.loc[is_node, ["node", *columns]].itertuples(index=False)
        }
        fixed: dict[int, int] = defaultdict(int)
        keys = []
        for at, key, held in part.loc[~is_node, ["node", "text_key", "held"]].itertuples(index=False):
            fixed[int(at)] += int(held)
            keys.append(int(key))
        main = main_element(nodes, dict(fixed))
        return pd.DataFrame(
            {
                "host": [part["host"].iloc[0]],
                "wrapper": [expression(nodes)],
                "main": [path_of(nodes, main)],
                "main_node": [main],
                "fixed": [sorted(keys)],
            }
        )

    counted = _counted(pages).where(F.col("key").isNull() | (F.col("pages") >= LEAST_PAGES))
    # A text directly in the page has no element; it is held against all that are.
    of_element = F.max(F.when(F.col("key").isNull(), F.col("pages"))).over(
        Window.partitionBy("host", "node")
    )
    # Numbers of texts as strings: they must not pass through floating point beside nulls.
    kept = (
        counted.withColumn("of_element", of_element)
        .where(F.col("key").isNull() | (F.col("pages") == F.col("of_element")))
        .withColumn("text_key", F.col("key").cast("string"))
        .withColumn("key", F.col("text_key"))
        .withColumn("parent", F.coalesce("parent", F.lit(ROOT)))
        .drop("of_element")
    )
    return kept.groupBy("host").applyInPandas(
        whole, "host string, wrapper string, main string, main_node long, fixed array<long>"
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars.

    A null html is an empty page; its text is empty. Pages without a host (null
    url) form one host of their own. Null ids and repeated rows stay rows of their
    own; other columns are left out. A page that lacks its host's main element is
    read by a wrapper of its own.
    """
    wrappers = stored(infer_wrappers(pages), "wrappers")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls = batch.column(0), batch.column(1)
            rest = (batch.column(i).to_pylist() for i in (2, 3, 4))
            found = [main_text(*row) for row in zip(*rest, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array(found, pa.string())], ["page_id", "url", "text"]
            )

    placed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    return (
        placed.join(wrappers.select("host", "main_node", "fixed"), "host", "left")
        .select("page_id", "url", "html", "main_node", "fixed")
        .mapInArrow(texts, "page_id long, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
