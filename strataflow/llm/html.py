"""Main text of web pages by consensus host paths.

Every page scores its containers and names the path of the best one: tags and classes from
the body down, numbers in them generalised. The pages of a host vote in Spark; then each
page is extracted again with the path that won on its host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflow.llm.common import stored

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
NUMBER = re.compile(r"\d+")
WORD = re.compile(r"[a-z]+")

# Names of elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div main section td".split())
DROPPED = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object select svg template".split()
)
#: An element of the same kind is closed by the start of another, up to the element that holds them.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in a class or id that mark what is not the article, and those that mark the article.
OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "notices alert menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget widgets footer masthead comment "
    "comments disqus reply replies respond share sharing social related recommended newsletter subscribe signup login "
    "search popup modal overlay toolbar pagination pager tags".split()
)
INSIDE = frozenset("article body content entry main post story text".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

#: Share of a page's good text that its best container holds at least.
SHARE = 0.7
#: Paths kept of each host, for pages without the first.
RUNNERS_UP = 3


def outside(tag: str, rest: str) -> tuple[bool, str]:
    """Whether an element is not part of the article, and its step of the path."""
    classes, drop = "", tag in DROPPED
    if "=" in rest:
        for m in ATTRIBUTE.finditer(rest):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "role":
                drop = drop or value.strip() in ROLES
                continue
            if name == "class":
                classes = ".".join(sorted(NUMBER.sub("#", c) for c in value.split()))
            if tag not in ("html", "body"):
                words = set(WORD.findall(value))
                drop = drop or bool(words & OUTSIDE and not words & INSIDE)
    return drop, f"{tag}.{classes}" if classes else tag


class Page:
    """A page's containers and the blocks of text in them, without what is never article.

    ``paths``, ``parents``: of each container. ``blocks``: (container, text, characters
    outside links). Missing end tags are put where the next block starts.
    """

    def __init__(self, html: str):
        self.paths, self.parents = ["body"], [-1]
        self.blocks: list[tuple[int, str, int]] = []
        # Of open elements: tag, container they are in, whether dropped, inside a link, inside a header.
        self.stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
        self.steps: list[str] = []
        self.text: list[str] = []
        self.linked, self.owner = 0, 0
        self.read(html)

    def flush(self) -> None:
        if self.text:
            joined = "".join(self.text)
            if "&" in joined:
                joined = unescape(joined)
            block = " ".join(joined.split())
            if block:
                self.blocks.append((self.owner, block, max(0, len(block) - self.linked)))
            self.text, self.linked = [], 0

    def add(self, text: str) -> None:
        _, container, dropped, link, header = self.stack[-1]
        if dropped or (header and not any(tag in ("h1", "h2", "h3") for tag, *_ in self.stack)):
            return
        if not self.text:
            self.owner = container
        self.text.append(text)
        if link:
            self.linked += len(text.strip())

    def close(self, tags: set[str] | frozenset[str], within: set[str] | frozenset[str]) -> None:
        """Pop the innermost open element of ``tags``, not looking beyond ``within``."""
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k][0]
            if tag in tags:
                del self.stack[k:]
                return
            if tag in within:
                return

    def open(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self.flush()
            self.close({"p"}, CONTAINERS | {"li", "blockquote", "figure"})
        if tag in SIBLINGS:
            self.close(*SIBLINGS[tag])
        if tag in VOID:
            self.add(" ")
            return
        _, container, dropped, link, header = self.stack[-1]
        drop, step = outside(tag, rest)
        drop = drop or (tag == "header" and container == 0)  # of the page; an article's own may hold its title
        if tag in CONTAINERS and tag != "body":
            self.parents.append(container)
            self.paths.append(f"{self.paths[container]}>{step}")
            container = len(self.paths) - 1
        self.stack.append((tag, container, dropped or drop, link or tag == "a", header or tag == "header"))

    def read(self, html: str) -> None:
        at = 0
        while True:
            m = MARKUP.search(html, at)
            if m is None:
                break
            if m.start() > at:
                self.add(html[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                if tag in BLOCKS:
                    self.flush()
                if tag not in ("html", "body"):
                    self.close({tag}, frozenset())
            else:
                rest = m["rest"] or m["rest2"] or ""
                if tag in RAW:
                    ends = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(html, at)
                    end = html.find(">", ends.start()) if ends else -1
                    at = end + 1 if end >= 0 else len(html)
                elif rest.endswith("/") and tag in ("svg", "path", "use", "math"):
                    continue
                elif tag not in ("html", "body"):
                    self.open(tag, rest)
        self.add(html[at:])
        self.flush()

    def within(self) -> list[int]:
        """Characters outside links below each container."""
        totals = [0] * len(self.paths)
        for container, _, plain in self.blocks:
            while container >= 0:
                totals[container] += plain
                container = self.parents[container]
        return totals

    def best(self) -> int:
        """The innermost container with most of the page's good text; an article element first."""
        totals = self.within()
        least = SHARE * totals[0]
        fit = [k for k, total in enumerate(totals) if total >= least and total]
        if not fit:
            return 0
        named = [k for k in fit if self.paths[k].rpartition(">")[2].partition(".")[0] in ("article", "main")]
        return max(named or fit, key=lambda k: (self.paths[k].count(">"), -k))

    def extract(self, paths: list[str]) -> str:
        """The blocks below the containers of the first path that this page has with text."""
        for path in paths:
            chosen = {k for k, p in enumerate(self.paths) if p == path}
            if chosen and (text := self.below(chosen)):
                return text
        return self.below({self.best()})

    def below(self, chosen: set[int]) -> str:
        kept: list[bool] = []
        for k, parent in enumerate(self.parents):
            kept.append(k in chosen or (parent >= 0 and kept[parent]))
        return "\n".join(text for container, text, _ in self.blocks if kept[container])


def host() -> Column:
    """Host in lower case; empty if there is none."""
    return F.coalesce(F.lower(F.try_parse_url(F.col("url").cast("string"), F.lit("HOST"))), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, pages``: how many pages of a host have their best container there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = [], []
            for name, html in zip(batch["host"].to_pylist(), batch["html"]):
                page = Page(html.as_py() or "")
                if page.blocks:
                    hosts.append(name)
                    paths.append(page.paths[page.best()])
            yield pa.record_batch({"host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string())})

    cast = pages.select(host().alias("host"), F.col("html").cast("string").alias("html"))
    return cast.mapInArrow(run, "host string, path string").groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))


def winners(counted: DataFrame) -> DataFrame:
    """``host, paths``: the paths with most votes of each host, best first."""
    order = Window.partitionBy("host").orderBy(F.desc("pages"), "path")
    return (
        counted.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= RUNNERS_UP)
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("nth", "path"))).alias("best"))
        .select("host", F.transform("best", lambda b: b["path"]).alias("paths"))
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page.

    A null or empty page has an empty text. A page without a valid host votes with the
    others without one. A page that lacks the paths of its host is extracted with its own
    best container. Null and repeated ``page_id`` pass through; other columns are ignored.
    """
    best = stored(winners(votes(pages)), "winners")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    # Hosts grow with the data: without a hint, the size of ``best`` decides how it is joined.
    joined = rows.withColumn("host", host()).join(best, "host", "left").select("page_id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h.as_py()).extract(p or []) for h, p in zip(batch["html"], batch["paths"].to_pylist())]
            yield pa.record_batch({
                "page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
