"""Main text of pages: a style tree per site tells which branches carry content."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwait.llm.common import staged, table
from fairwait.session import shared_path

DECAY = 0.9  # weight of the children in a branch's importance, per child
LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 5  # a site with fewer pages tells nothing about a branch

# Elements that are never main text, and elements whose content is not text at all.
CHROME = frozenset(
    "nav footer aside form menu dialog button select textarea input fieldset label noscript "
    "template iframe object embed applet svg math canvas audio video map head title".split()
)
RAW = frozenset(["script", "style"])
CORE = frozenset(["article", "main"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
# A block ends an open paragraph; an item ends the item before it.
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
HOLDS_ITEMS = frozenset("ul ol dl table tbody thead tfoot select".split())
# Words in class, id or role that mark chrome.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment "
    "comments respond disqus reply replies social share sharing related recommended newsletter subscribe "
    "popup modal widget pagination pager copyright login search complementary contentinfo".split()
)
PAGE_MARKS = frozenset(["header", "masthead", "topbar"])  # chrome outside an article only
PARTS = re.compile(r"[^a-z0-9]+")


def number(*parts) -> int:
    """A signed 64-bit name of ``parts``."""
    digest = blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(digest.digest(), "little", signed=True)


class Node:
    __slots__ = ("tag", "path", "chrome", "core", "children", "texts", "parent", "depth")

    def __init__(self, tag, path, chrome, core, parent):
        self.tag, self.path, self.chrome, self.core, self.parent = tag, path, chrome, core, parent
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[str] = []
        self.texts: list[str] = []


class Page(HTMLParser):
    """The element tree of a page as it is read: blocks of text, each with the elements above it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.names: dict[tuple, int] = {}
        self.node = Node("", 0, False, False, None)
        self.nodes = [self.node]
        self.depths: Counter = Counter()
        self.blocks: list[tuple[Node, str]] = []
        self.parts: list[str] = []
        self.holder = self.node
        self.feed(html)
        self.close()
        self.flush()

    def flush(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.blocks.append((self.holder, text))
                self.holder.texts.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            if self.depths["p"]:
                self.leave({"p"}, HOLDS_ITEMS | CORE)
            if tag in ENDS_ITSELF:
                self.leave(ENDS_ITSELF[tag], HOLDS_ITEMS if tag not in ("td", "th") else HOLDS_ITEMS | {"tr"})
        if tag in VOID:
            return
        above = self.node
        named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
        words = {w for w in PARTS.split(named.lower()) if w} if named else set()
        chrome, core = above.chrome, above.core
        if tag in CORE and not words & MARKS:
            # An unclosed notice before the article does not hide it; an article in a list of comments stays hidden.
            core = True
            chrome = chrome and above.tag not in ("div", "section", "p", "span")
        elif tag in CHROME or tag in RAW or words & MARKS:
            chrome = True
        elif (tag == "header" or words & PAGE_MARKS) and not core:
            chrome = True
        key = (above.path, tag, named)
        if key not in self.names:
            self.names[key] = number(*key)
        self.node = Node(tag, self.names[key], chrome, core, above)
        above.children.append(tag)
        self.nodes.append(self.node)
        self.depths[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append(" ")
        elif self.depths[tag]:
            if tag not in INLINE:
                self.flush()
            self.leave({tag}, CORE - {tag} if tag in INLINE or tag == "p" else frozenset())

    def leave(self, tags, walls):
        """Close the nearest open element of ``tags``, unless one of ``walls`` is nearer."""
        node = self.node
        while node.parent is not None and node.tag not in tags:
            if node.tag in walls:
                return
            node = node.parent
        if node.parent is not None:
            while self.node is not node.parent:
                self.depths[self.node.tag] -= 1
                self.node = self.node.parent

    def handle_data(self, data):
        if self.node.tag in RAW:
            return
        if not self.parts:
            self.holder = self.node
            while self.holder.tag in INLINE and self.holder.parent is not None:
                self.holder = self.holder.parent
        if self.node.chrome and not self.holder.chrome:  # an inline advert within a sentence
            return
        self.parts.append(data)


def statistics(html: str, key: int = 0) -> set[tuple]:
    """What a page adds to its site's tree: per branch its parent, its depth, its children's tags and its texts.

    It also names, with its ``key``, the branches above its text.
    """
    page, rows = Page(html), set()
    for node in page.nodes[1:]:
        runs = [t for k, t in enumerate(node.children) if k == 0 or node.children[k - 1] != t]
        rows.add((node.path, node.parent.path, "depth", node.depth))
        rows.add((node.path, node.parent.path, "style", number(*runs)))
        for text in node.texts:
            rows.add((node.path, node.parent.path, "text", number(text)))
    for node in {node for node, _ in page.blocks if not node.chrome}:
        while node.parent and (row := (node.path, node.parent.path, "page", key)) not in rows:
            rows.add(row)
            node = node.parent
    return rows


def extract(html: str, low: frozenset[int]) -> str:
    """Blocks of the article, or without one of the whole page, but those of branches that the site's tree finds unimportant.

    Within an article such a branch lies below the article itself, and some text is left beside it: where a site repeats a
    whole article, all of its branches are unimportant, and all stay.
    """
    page = Page(html)
    clear = [(node, text) for node, text in page.blocks if not node.chrome]
    core = [(node, text) for node, text in clear if node.core]

    def kept(node, article):
        while node is not None and not (article and node.tag in CORE):
            if node.path in low:
                return False
            node = node.parent
        return True

    left = [text for node, text in core or clear if kept(node, bool(core))]
    return "\n".join(left or [text for _, text in core])


def low_branches(branches: DataFrame) -> DataFrame:
    """(host, path) of the branches of low importance, from a branch's own importance and that of its children.

    ``own`` is the entropy of the children's tags over pages for a branch with children, and for
    a branch of texts one less the mean entropy of its texts: texts that many pages share say
    little. A branch leans on its children the less, the more there are.

    Levels are settled from the deepest up. Children are summed per parent ahead of the shuffle,
    so neither a site nor a branch with very many children is a group in one task. What was counted
    once has importance 1, as has a branch with nothing else below it, so levels begin at the
    deepest branch that was counted more often. Each is a round of its own.
    """
    path = shared_path(branches.sparkSession, "importance")
    deepest = branches.where("pages > 1").agg(F.max("depth")).first()[0] or 0
    level = branches.where(F.col("depth") == deepest + 1).withColumn("value", F.lit(1.0))
    level = level.select("host", "path", "parent", "pages", "value")
    kind = level.schema
    own = F.col("text_importance")
    for depth in range(deepest, 0, -1):
        below = level.groupBy("host", F.col("parent").alias("path")).agg(
            (F.sum(F.col("pages") * F.col("value")) / F.sum("pages")).alias("mean"),
            F.pow(F.lit(DECAY), F.count("*")).alias("share"),
        )
        mixed = (1 - F.col("share")) * F.col("style_importance") + F.col("share") * F.col("mean")
        value = F.coalesce(F.greatest(mixed, own), F.lit(1.0))  # greatest passes over NULL
        here = branches.where(F.col("depth") == depth).join(below.hint("merge"), ["host", "path"], "left")
        at = f"{path}/level={depth}"
        here.select("host", "path", "parent", "pages", value.alias("value")).write.parquet(at)
        level = branches.sparkSession.read.schema(kind).parquet(at)
    if not deepest:
        return level.select("host", "path").where("false")
    settled = branches.sparkSession.read.schema(kind).parquet(path)
    return settled.where((F.col("value") < LEAST_IMPORTANCE) & (F.col("pages") >= LEAST_PAGES)).select("host", "path")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def site_trees(pages: DataFrame) -> DataFrame:
    """(_host, _key, _low): for pages the branches of low importance on their site that they have, by
    number. ``_key`` is the hash of the html.

    Pages are merged by counting: a row per branch and distinct feature with its number of
    pages, aggregated before the shuffle, so a site with a third of all pages is many keys, and no
    task or row ever holds more of a site than the branches of one page.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for host, key, html in zip(*[c.to_pylist() for c in batch.columns]):
                counts.update((host, *row) for row in statistics(html or "", key))
            columns = list(zip(*[(*key, n) for key, n in counts.items()])) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, STATISTICS.types)], schema=STATISTICS
            )

    counted = staged(
        pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("key"), "html")
        .mapInArrow(rows, "host string, path long, parent long, kind string, feature long, n long")
        .groupBy("host", "path", "parent", "kind", "feature")
        .agg(F.sum("n").alias("n")),
        "site-counts",
    )
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    # Every page that has the branch counts once among its styles, or more often for repeats.
    branches = (
        counted.where("kind <> 'page'")
        .groupBy("host", "path", "parent")
        .agg(
            F.max(F.when(F.col("kind") == "depth", F.col("feature"))).cast("int").alias("depth"),
            of("style", F.col("n")).alias("pages"),
            of("style", F.col("n") * F.log2("n")).alias("style_bits"),
            F.count_if(F.col("kind") == "text").alias("texts"),
            of("text", F.log2("n")).alias("text_bits"),
        )
        .withColumn("scale", F.log2("pages"))
        .select(
            "host",
            "path",
            "parent",
            "depth",
            "pages",
            F.when(F.col("scale") > 0, 1 - F.col("style_bits") / F.col("pages") / F.col("scale"))
            .otherwise(1.0)
            .alias("style_importance"),
            F.when((F.col("texts") > 0) & (F.col("scale") > 0), 1 - F.col("text_bits") / F.col("texts") / F.col("scale"))
            .when(F.col("texts") > 0, 1.0)
            .alias("text_importance"),
        )
    )
    low = staged(low_branches(staged(branches, "branches")), "low")
    held = counted.where("kind = 'page'").select("host", "path", "feature").join(low.distinct(), ["host", "path"])
    return held.groupBy(F.col("host").alias("_host"), F.col("feature").alias("_key")).agg(
        F.collect_set("path").alias("_low")
    )


STATISTICS = pa.schema(
    [("host", pa.string()), ("path", pa.int64()), ("parent", pa.int64()), ("kind", pa.string()),
     ("feature", pa.int64()), ("n", pa.int64())]
)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html, any others).

    * The text is that of ``article`` and ``main`` without the chrome inside them, or of a page with
      neither what is left of its body without chrome. The site's tree judges both: branches of low importance on
      the site go. NULL or empty html, or nothing left, gives ''.
    * Pages that repeat one article would make it look like boilerplate, so an article whose branches are all
      of low importance stays whole.
    * NULL urls, and urls without a host, are one site. Repeated rows and ids are kept row by
      row. An empty table gives an empty one.

    Two passes read the html, and only counts are shuffled. What the trees say of each page
    that has such branches is written first, so the join to the pages is a broadcast where its size on
    disk allows it, and else a shuffle that splits a page that very many rows repeat.
    """
    trees = staged(site_trees(pages), "site-trees")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [frozenset(x or ()) for x in batch.column(3).to_pylist()]
            out = [extract(h or "", x) for h, x in zip(batch.column(2).to_pylist(), low)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"]
            )

    joined = (
        pages.select(
            "page_id", "url", "html", host_of(F.col("url")).alias("_host"), F.xxhash64("html").alias("_key")
        )
        .join(trees, ["_host", "_key"], "left")
        .select("page_id", "url", "html", "_low")
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string")


def op7_extract_main_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
