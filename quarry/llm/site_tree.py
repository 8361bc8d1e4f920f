"""Main text of web pages by a site style tree.

Each page is read once into its element tree (block elements; a start tag closes what HTML lets it close). The pages of a host are merged:
a style node is a path of tags and classes (without digits), and knows how often it occurs, which sequences of child styles
it had, and which texts.

- Presentation importance of a node: the entropy of its child sequences, to the base of its occurrences. A menu that always
  looks alike has 0, an article whose every page is built differently 1. A node seen once has 1.
- Content importance of a text node: 1 less the mean of log n / log m over its texts, where a text occurs n times among m.
- A branch has half the content importance of its text node and half the presentation importance of the nodes above it,
  the nearer the more (``DAMPING``).

Names are a prior, combined with the tree. Whole names of elements, classes, ids and roles for menus, page headers, footers, side bars,
notices, adverts and forms ask for an importance of ``LEAST["away"]`` and for more characters than the page has otherwise: content of
its own on each page outweighs them if it is the most of the page (menus, adverts and footers often differ by page, too, but are the
less of it). ``article``
and ``main`` ask for ``LEAST["here"]`` only, also within a branch of such a name: content equal on most pages outweighs them. All
else needs ``LEAST["open"]``. On fewer than ``FEW_PAGES`` pages of a host a name is not outweighed. What HTML does not show as text
(head, scripts, controls, hidden elements) goes. Reader comments go by their name as well: they differ on every page as an article
does, so entropy cannot tell them; ``main``, and an ``article`` that no other is around, within them are text again.

The tree of a host is rows of counts, added up before they are shuffled, never one object; the pages are stored once in
parsed form, and the paths where the tree outweighs the names (or removes what has none) are joined to them by host.

Defined results: null html or url counts as empty; a page without text gives an empty string; broken markup is read as far as it
goes, an unclosed comment or script to the end; repeated pages are one page of the tree and give a row each; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

DAMPING = 0.7
#: Importance that a branch needs, by what names say of it.
LEAST = {"away": 0.5, "open": 0.3, "here": 0.25}
FEW_PAGES = 4
#: Priors by name. Below 0 the tree is not asked: not shown, comments within article or main, other comments.
UNSEEN, TALK, TALK_ALONE, AWAY, OPEN, HERE = -1.0, -0.5, -0.25, 0.0, 0.5, 1.0

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: What a start tag closes if it is open, up to the next of the elements after the bar.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
PRIORS = {"away": AWAY, "open": OPEN, "here": HERE}
#: Names that say that a branch is not, or is, the main text.
UNSEEN_TAGS = frozenset("head script style noscript template button select textarea iframe object svg".split())
AWAY_TAGS = frozenset("nav footer aside form dialog menu".split())
TALK_NAMES = frozenset("comment comments disqus replies respond".split())
AWAY_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs complementary "
    "consent contentinfo cookie cookies copyright dialog footer form gdpr header login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices overlay pager pagination popup promo promotion recommended related "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
HERE_TAGS = frozenset(("article", "main"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|=|$)", re.I)
DIGITS = re.compile(r"\d+")


class Parser:
    """Reads pages into text blocks and style nodes. Paths are numbered by hashes, remembered over pages."""

    def __init__(self) -> None:
        self.paths: dict[tuple, tuple[int, float, str]] = {}

    def child(self, parent: tuple, tag: str, rest: str) -> tuple[int, float, str]:
        """(path, prior, style) of an element below a (path, prior, style, tag) parent."""
        key = parent[0], parent[1], tag, rest
        found = self.paths.get(key)
        if found is None:
            if len(self.paths) > 100_000:
                self.paths.clear()
            classes, names = [], set()
            # The attribute alone, not the word in another one's value.
            hidden = bool(HIDDEN.search(VALUE.sub("=", rest)))
            for name, value in ATTRIBUTE.findall(rest):
                value = value.strip("\"'").lower()
                if name.lower() == "class":
                    classes = sorted(set(DIGITS.sub("", value).split()))
                if name.lower() in ("class", "id", "role"):
                    names.update(DIGITS.sub("", value).split())
                hidden |= name.lower() == "aria-hidden" and value == "true"
                hidden |= name.lower() == "style" and "display:none" in value.replace(" ", "")
            prior = parent[1]
            if tag not in ("html", "body"):
                talk = bool(names & TALK_NAMES)
                here = tag in HERE_TAGS or bool(names & HERE_TAGS) and not names & AWAY_NAMES
                away = tag in AWAY_TAGS or (tag == "header" and prior < HERE) or bool(names & AWAY_NAMES)
                if hidden or tag in UNSEEN_TAGS or prior == UNSEEN:
                    prior = UNSEEN
                elif talk:
                    prior = min(prior, TALK if prior == HERE else TALK_ALONE)
                elif here and (prior != TALK or tag == "main"):
                    prior = HERE
                elif away and prior >= AWAY:
                    prior = AWAY
            style = ".".join([tag, *classes])
            path = xxhash.xxh3_64_intdigest(style, parent[0]) >> 1
            found = self.paths[key] = path, prior, style
        return found

    def parse(self, page: str) -> tuple[list, list, dict]:
        """Blocks (path, prior, text), nodes (path, hash of the child styles), and the nodes above each text node."""
        blocks: list[tuple[int, float, str]] = []
        nodes: list[tuple[int, int]] = []
        above: dict[int, list[int]] = {}
        # path, prior, style, tag, child styles
        stack: list[tuple] = [(0, OPEN, "", "", [])]
        text: list[str] = []

        def end_block() -> None:
            if text:
                words = html.unescape("".join(text)).split()
                text.clear()
                if words:
                    path, prior = stack[-1][:2]
                    blocks.append((path, prior, " ".join(words)))
                    if path not in above:
                        above[path] = [x[0] for x in stack[1:]]

        def close(depth: int) -> None:
            end_block()
            while len(stack) > depth:
                path, _, _, _, children = stack.pop()
                nodes.append((path, xxhash.xxh3_64_intdigest(",".join(children)) >> 1))

        done = 0
        for token in TOKEN.finditer(page):
            if token.start() > done:
                text.append(page[done : token.start()])
            done = token.end()
            tag = token["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if token["close"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][3] == tag:
                        close(depth)
                        break
                continue
            rest = token["rest"]
            if tag in INLINE:
                if tag == "br":
                    text.append(" ")
                # Inline elements are part of the text around them, unless they are to go.
                if tag in VOID or not rest or not self.child(stack[-1], tag, rest)[1] < min(stack[-1][1], OPEN):
                    continue
            end_block()
            shut, within = CLOSES.get(tag, ((), ()))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][3] in within:
                    break
                if stack[depth][3] in shut or (stack[depth][3] == "p" and tag not in INLINE):
                    close(depth)
                    break
            found = self.child(stack[-1], tag, rest)
            stack[-1][4].append(found[2])
            if tag not in VOID and not rest.endswith("/"):
                stack.append((*found, tag, []))
        if done < len(page):
            text.append(page[done:])
        close(1)
        return blocks, nodes, above


PARSED = (
    "page_id long, url string, host string, page long, path array<long>, prior array<float>, hash array<long>, text array<string>, "
    "node array<long>, children array<long>, leaf array<long>, above array<array<long>>"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser = Parser()
    longs, floats, strings = pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.string())
    for batch in batches:
        columns: list[list] = [[] for _ in range(8)]
        for page in batch.column("html"):
            blocks, nodes, above = parser.parse(page.as_py() or "")
            row = (
                [b[0] for b in blocks],
                [b[1] for b in blocks],
                [xxhash.xxh3_64_intdigest(b[2]) >> 1 for b in blocks],
                [b[2] if b[1] >= AWAY else None for b in blocks],
                [n[0] for n in nodes],
                [n[1] for n in nodes],
                list(above),
                list(above.values()),
            )
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        kinds = (longs, floats, longs, strings, longs, longs, longs, pa.list_(longs))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("page_id", "url", "host", "page")),
                *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
            ],
            ["page_id", "url", "host", "page", "path", "prior", "hash", "text", "node", "children", "leaf", "above"],
        )


def parsed(pages: DataFrame) -> DataFrame:
    """The pages as blocks and style nodes, written."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(host, F.lit("")).alias("host"),
        F.xxhash64("html").alias("page"), "html",
    )
    return stored(rows.mapInArrow(_parse, PARSED))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages, importance of each text node, and which priors it has, from the parsed pages; pages that are alike are one page of the tree."""
    pages = pages.select("host", "page", "path", "prior", "hash", "node", "children", "leaf", "above").dropDuplicates(["host", "page"])
    nodes = pages.select("host", F.explode(F.arrays_zip("node", "children")).alias("x"))
    kinds = nodes.groupBy("host", F.col("x.node").alias("path"), F.col("x.children").alias("c")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Entropy to the base m: 1 less the mean of log n / log m.
    importance = lambda df, *more: (
        df.groupBy("host", "path")
        .agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.ln("n")).alias("s"), *more)
        .withColumn("i", F.when(F.col("m") > 1, 1 - F.col("s") / F.col("m") / F.ln("m")).otherwise(F.lit(1.0)))
        .drop("m", "s")
    )
    presentation = importance(kinds)
    texts = pages.select("host", F.explode(F.arrays_zip("path", "prior", "hash")).alias("x"))
    priors = [F.max(F.col("x.prior") == prior).alias(name) for name, prior in PRIORS.items()]
    texts = texts.groupBy("host", F.col("x.path").alias("path"), F.col("x.hash").alias("h")).agg(F.count(F.lit(1)).alias("n"), *priors)
    content = importance(texts, *(F.max(name).alias(name) for name in PRIORS))
    leaves = (
        pages.select("host", F.explode(F.arrays_zip("leaf", "above")).alias("x"))
        .select("host", F.col("x.leaf").alias("leaf"), F.col("x.above").alias("above"))
        .groupBy("host", "leaf")
        .agg(F.first("above").alias("above"), F.count(F.lit(1)).alias("pages"))
        .select("host", "leaf", "pages", F.size("above").alias("depth"), F.posexplode("above").alias("at", "path"))
        .withColumn("w", F.pow(F.lit(DAMPING), F.col("depth") - 1 - F.col("at")))
    )
    above = (
        leaves.join(presentation, ["host", "path"])
        .groupBy("host", "leaf", "pages")
        .agg((F.sum(F.col("w") * F.col("i")) / F.sum("w")).alias("above"))
    )
    return above.join(content, (above["host"] == content["host"]) & (above["leaf"] == content["path"])).select(
        above["host"], F.col("leaf").alias("path"), "pages", *PRIORS, ((F.col("above") + F.col("i")) / 2).alias("importance")
    )


def extract(pages: DataFrame, least: dict[str, float] = LEAST) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page."""
    read = parsed(pages)
    i, many = F.col("importance"), F.col("pages") >= FEW_PAGES
    # Where the tree is against what names alone would do.
    against = {"away": many & (i >= least["away"]), "open": i < least["open"], "here": many & (i < least["here"])}
    tree = style_tree(read).select("host", "path", *((F.col(n) & c).alias(n) for n, c in against.items()))
    tree = tree.where(F.col("away") | F.col("open") | F.col("here"))
    turned = stored(tree.groupBy("host").agg(*(F.collect_set(F.when(F.col(n), F.col("path"))).alias(n) for n in PRIORS)))
    blocks = F.arrays_zip("path", "prior", "text")
    turns = lambda name, b: F.coalesce(F.array_contains(name, b["path"]), F.lit(False))
    main = lambda b: ((b["prior"] == OPEN) & ~turns("open", b)) | ((b["prior"] == HERE) & ~turns("here", b))
    own = lambda b: (b["prior"] == AWAY) & turns("away", b)
    chars = lambda kept: F.aggregate(F.filter(blocks, kept), F.lit(0), lambda n, b: n + F.length(b["text"]))
    joined = read.join(turned, "host", "left").withColumn("most", chars(own) > chars(main))
    kept = F.filter(blocks, lambda b: main(b) | (own(b) & F.col("most")))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
