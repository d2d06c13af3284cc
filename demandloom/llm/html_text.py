"""Main text of web pages by paths that the pages of a host agree on.

Each page is parsed and its containers are scored by the text they hold outside links,
menus, notices and the like. The best container votes for its path, the tags and classes
from the root with digits made alike. Spark counts the votes by host; paths with a fifth of
a host's votes win. Each page is then extracted from the containers at a winning path: that
of its own vote if it won, else the one with most votes that the page has, else its own. So
a page whose text is short or unusual is cut where its siblings are.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.durable import durable
from demandloom.llm.words import slices

SLICE_BYTES = 16_000_000
WINNING = 0.2  # share of a host's votes
HOLDS = 0.9  # share of a container's text that a part must hold to be chosen in its place
SEMANTIC = 0.5  # share of the page's text that an article or main element must hold
SALTS = 64
BROADCAST_ROWS = 100_000

# Element names of HTML by how they are treated here.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option "
    "datalist input textarea iframe svg canvas object embed audio video map dialog menu".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("html body div section article main td center table tbody tr".split())
# an opening tag ends open elements of these names, inside the nearest of the second list
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
# words in classes and ids that mark what is not the article
MARKED = frozenset(
    "nav navbar navigation menu menus submenu sidebar sidenav footer foot masthead topbar comment "
    "comments commentlist disqus replies respond ad ads adv advert adverts advertisement "
    "advertising adsense sponsor sponsored promo promoted promotion banner cookie cookies consent "
    "gdpr notice notices notification notifications alert popup modal overlay share sharing "
    "sharebar social related recommended recommendations breadcrumb breadcrumbs newsletter "
    "subscribe subscription signup login search searchbox widget widgets pagination pager paging "
    "toolbar skip copyright hidden".split()
)
BESIDE = frozenset("has with no without is".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"""
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """A page's elements, in page order, and the blocks of text that are not dropped."""

    def __init__(self, source: str, forms: bool = False):
        """``forms`` keeps what is in form elements."""
        self.dropped = DROPPED - {"form"} if forms else DROPPED
        self.parents, self.tags, self.labels, self.kept, self.main = [-1], ["#"], ["#"], [True], [False]
        self.within = [False]  # inside an article or main element
        self.blocks: list[tuple[int, str, int]] = []
        self._parse(source)

    def _attributes(self, text: str) -> dict[str, str]:
        return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(text)}

    def _open(self, tag: str, text: str, parent: int) -> int:
        given = self._attributes(text) if text.strip(" /\n\t\r") else {}
        names = given.get("class", "")
        parts = [[w.lower() for w in WORD.findall(n)] for n in [*names.split(), given.get("id", "")]]
        # "has-sidebar" and the like tell of another element
        words = {w for part in parts if part and part[0] not in BESIDE for w in part}
        role = given.get("role", "").lower()
        inside = self.within[parent]
        header = tag == "header" or "header" in words
        dropped = (
            tag in self.dropped
            or (tag not in ("html", "body") and not MARKED.isdisjoint(words))
            or (header and not inside and tag not in ("html", "body", "article", "main"))
            or role in ROLES
            or "hidden" in given
            or given.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "")) is not None
        )
        semantic = tag in ("article", "main") or role == "main" or given.get("itemprop", "") == "articleBody"
        classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in names.split()})
        self.parents.append(parent)
        self.tags.append(tag)
        self.labels.append(".".join([tag, *classes]))
        self.kept.append(self.kept[parent] and not dropped)
        self.main.append(semantic)
        self.within.append(inside or semantic)
        return len(self.tags) - 1

    def _parse(self, source: str) -> None:
        stack = [0]
        runs: list[str] = []
        linked = links = 0

        def end_block():
            nonlocal linked
            text = " ".join("".join(runs).split())
            runs.clear()
            if text and self.kept[stack[-1]]:
                self.blocks.append((stack[-1], text, min(linked, len(text))))
            linked = 0

        def close(place: int):
            """Ends the elements from a place of the stack on; blocks end with them."""
            nonlocal links
            for node in reversed(stack[place:]):
                if self.tags[node] in BLOCKS:
                    end_block()
                links -= self.tags[node] == "a"
                stack.pop()

        def read(text: str):
            nonlocal linked
            if text and self.kept[stack[-1]]:
                runs.append(html.unescape(text) if "&" in text else text)
                if links:
                    linked += len(text)

        at = 0
        while True:
            token = TOKEN.search(source, at)
            read(source[at : token.start() if token else None])
            if token is None:
                break
            at = token.end()
            if token[1]:
                tag = token[1].lower()
                for place in range(len(stack) - 1, 0, -1):
                    found = self.tags[stack[place]]
                    if found == tag:
                        close(place)
                        break
                    if tag not in BLOCKS and found in BLOCKS:
                        break
                continue
            tag = (token[2] or token[4] or "").lower()
            if not tag:
                continue
            attributes = token[3] if token[2] else token[5]
            if tag == "br":
                read(" ")
                continue
            if tag in BLOCKS:
                end_block()
                for place in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[place]] == "p":
                        close(place)
                        break
                    if self.tags[stack[place]] in BLOCKS:
                        break
            if tag in IMPLIED:
                ended, bound = IMPLIED[tag]
                last = None
                for place in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[place]] in bound:
                        break
                    if self.tags[stack[place]] in ended:
                        last = place
                if last is not None:
                    close(last)
            if tag in RAW:
                ending = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
                at = ending.end() if ending else len(source)
                continue
            if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS and tag != "a":
                continue
            stack.append(self._open(tag, attributes, stack[-1]))
            links += tag == "a"
        end_block()
        close(1)

    def best(self) -> int:
        """The container of the main text."""
        held = [0] * len(self.tags)
        for node, text, linked in self.blocks:
            held[node] += len(text) - linked
        inside: dict[int, list[int]] = {}
        for node in range(len(self.tags) - 1, 0, -1):
            held[self.parents[node]] += held[node]
            if self.tags[node] in CONTAINERS or self.main[node]:
                inside.setdefault(self.parents[node], []).append(node)
        chosen = 0
        for node in range(1, len(self.tags)):
            # deeper elements come later; one is taken for the part of an outer it holds
            if self.main[node] and held[node] >= (SEMANTIC if not self.main[chosen] else HOLDS) * max(1, held[chosen]):
                if not self.main[chosen] or self._under(node, chosen):
                    chosen = node
        if self.main[chosen]:
            return chosen
        while parts := [n for n in inside.get(chosen, ()) if held[n] >= HOLDS * max(1, held[chosen])]:
            chosen = max(parts, key=lambda n: held[n])
        return chosen

    def _under(self, node: int, other: int) -> bool:
        while node > other:
            node = self.parents[node]
        return node == other

    def path(self, node: int) -> str:
        labels = []
        while node > 0:
            labels.append(self.labels[node])
            node = self.parents[node]
        return ">".join(reversed(labels))

    def at_path(self, path: str) -> set[int]:
        labels = path.split(">") if path else []
        depth, found = {0: 0}, set() if labels else {0}
        for node in range(1, len(self.tags)):
            above = depth.get(self.parents[node])
            if above is not None and above < len(labels) and self.labels[node] == labels[above]:
                depth[node] = above + 1
                if above + 1 == len(labels):
                    found.add(node)
        return found

    def text(self, nodes: set[int]) -> str:
        inside = [False] * len(self.tags)
        for node in range(len(self.tags)):
            inside[node] = node in nodes or (node > 0 and inside[self.parents[node]])
        return "\n\n".join(text for node, text, _ in self.blocks if inside[node])


def parsed(source: str) -> Page:
    """The page; one that is a single form is read with what its forms hold."""
    page = Page(source)
    return page if page.blocks or "<form" not in source.lower() else Page(source, forms=True)


def page_text(source: str, winning: list[str]) -> str:
    """Main text of one page, given the paths that won at its host, most votes first."""
    page = parsed(source)
    own = page.best()
    if page.path(own) not in winning:
        for path in winning:
            if nodes := page.at_path(path):
                return page.text(nodes)
        return page.text({own})
    return page.text(page.at_path(page.path(own)))


def host(url):
    """Host of a url in lower case; empty where there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.coalesce(found, F.lit(""))


def _votes(pages: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for start, length in slices(batch.column(1), SLICE_BYTES):
                paths = []
                for source in batch.column(1).slice(start, length).to_pylist():
                    page = parsed(source or "")
                    paths.append(page.path(page.best()) if page.blocks else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, length), pa.array(paths, pa.string())], ["host", "path"]
                )

    return pages.select("host", "html").mapInArrow(run, "host string, path string").where("path is not null")


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): the winning paths of each host of ``pages(host, html)``, by votes."""
    counted = _votes(pages.where("host <> ''")).groupBy("host", "path").agg(F.count("*").alias("votes"))
    ranked = counted.join(counted.groupBy("host").agg(F.sum("votes").alias("all"), F.max("votes").alias("top")), "host")
    won = ranked.where((F.col("votes") >= F.col("all") * WINNING) | (F.col("votes") == F.col("top")))
    # one path may win with few votes where none has a fifth: the smallest of those
    kept = won.groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(F.col("votes") >= F.col("all") * WINNING, F.struct((-F.col("votes")).alias("v"), "path")))).alias("paths"),
        F.min(F.when(F.col("votes") == F.col("top"), F.col("path"))).alias("first"),
    )
    return kept.select(
        "host",
        F.when(F.size("paths") > 0, F.transform("paths", lambda x: x["path"])).otherwise(F.array("first")).alias("paths"),
    )


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages(page_id, url, html)``.

    Whole pages are read. White space in a block is one space, blocks are joined by two
    newlines in page order. Null, empty and textless pages have the empty text; a null url
    or one without host has no siblings and is extracted by its own best container. A row
    given twice is returned twice, and votes twice. An empty table gives none.
    """
    pages = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    # counted and joined: the pages are parsed for it once
    winners = durable(host_paths(pages))
    # a host may have a third of all pages: its row goes to many tasks
    if winners.count() <= BROADCAST_ROWS:
        joined = pages.join(F.broadcast(winners), "host", "left")
    else:
        salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
            salted, ["host", "salt"], "left"
        )

    def run(batches):
        for batch in batches:
            for start, length in slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(start, length)
                texts = [
                    page_text(source, paths or []) if source else ""
                    for source, paths in zip(part.column(2).to_pylist(), part.column(3).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return joined.select("page_id", "url", "html", "paths").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
