"""HTML extraction with site style trees.

Every page is read once into elements. An element's path is the chain of styles (tag, id, classes) from
the root; merging the elements of one path over all pages of a host gives the host's style tree. Each
node has two distributions over the pages that contain it: the sequences of child styles (presentation)
and the texts below it (content). With m pages, the importance of either is its entropy divided by
log m, and that of the node is the larger one; a node on fewer than MIN_PAGES pages has importance 1.
Pages of a host with the same text count as one page, so that copies do not look like a template.
Branches with an importance below LOW are removed from every page of the host.

What markup says about itself is the prior of presentation: elements that are menus, headers, footers,
sidebars, notices, adverts, forms, comments or not displayed at all have importance 0. A class or id says
so by its whole name: all its words are noise words or plain fillers (comment-list), or its last word is a
noise word and none is a negation (article-sidebar, but not share-price, with-sidebar or no-comments). Names
of headings, of regions and of what holds the page's main element say nothing. The style tree
decides on all the rest, inside of article and main regions too. Of what it leaves, the regions of a
page are the article where they hold at least DOMINANT of the characters; where they hold less, as
teasers do, nothing more is left out.

Text is joined by block. White space inside a block becomes one space; br is white space. Character
references are decoded. Unclosed and stray tags are read as browsers do for the usual cases: a block
ends an open paragraph, list items and table cells end their predecessors, an end tag without start is
ignored, an unclosed comment or raw element reaches to the end of the page.

Tables by host and path are aggregated from counts; what low branches a host has is sent to the pages
by a broadcast up to BROADCAST_HOSTS rows, and beyond by a join with the hosts spread over SALTS keys.

Defined results: null and empty html give an empty text; a null url belongs to the empty host; repeated
rows are answered one by one; deep nesting is no recursion, and takes linear time and memory; an empty
table gives no rows; only page_id, url and html are read, and kept columns stay whatever their names,
but for text and n_chars, which the results replace.
"""

import html as references
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns, unused_names
from tillgrain.session import stage

MIN_PAGES = 3
LOW = 0.2
DOMINANT = 0.5
BROADCAST_HOSTS = 20_000
SALTS = 16

# Names of HTML elements and of usual roles and classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head script style noscript template svg math iframe object canvas audio video map".split()
)
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math"
NOISE_TAGS = frozenset("nav footer aside form button select textarea input dialog menu".split())
REGIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header menu modal nav navbar navigation newsletter notice pagination popup "
    "promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar".split()
)
# Words that say nothing about what a named element holds.
FILLERS = frozenset(
    "area articles bar body bottom box button buttons col column container content icons inner "
    "item items label left link links list main outer page panel posts primary right row secondary section "
    "signup site slot text thread top unit widget widgets wrap wrapper".split()
)
NEGATIONS = frozenset("has hide no non not off show with without".split())
# These end names of other things, too: entry-header, market-share.
NOT_LAST = frozenset("header notice related share social".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog menu navigation search".split())
# An element that starts ends an open element of these names, up to the given container.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "thead", "tbody", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b[^>]*>(?:.*?</\1\s*>|.*\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-z][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(id|class|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WORDS = re.compile(r"[^\s_-]+")
AUTHORITY = re.compile(r"\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)

RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def host_of(url: str | None) -> str:
    found = AUTHORITY.match(url or "")
    return found[1].lower() if found else ""


def digest(*parts) -> int:
    """Signed 64-bit hash of strings and numbers."""
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace")) - (1 << 63)


def is_noise_name(name: str) -> bool:
    """Whether a class or id as a whole names something that is not the article."""
    words = [w for w in WORDS.findall(name) if not w.isdigit()]
    if not words or not NOISE_WORDS.intersection(words) or not NEGATIONS.isdisjoint(words):
        return False
    last = words[-1] in NOISE_WORDS and (len(words) == 1 or words[-1] not in NOT_LAST)
    return last or all(w in NOISE_WORDS or w in FILLERS for w in words)


def style_of(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """(style, noise, named): the style of an element, and whether markup or its names call it noise."""
    if not attributes or attributes.isspace():
        return tag, tag in NOISE_TAGS, False
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    names = sorted({*found.get("class", "").split(), *found.get("id", "").split()})
    noise, named = tag in NOISE_TAGS, False
    if tag not in ("html", "body", *REGIONS):
        named = tag not in HEADINGS and any(map(is_noise_name, names))
        noise |= found.get("role") in NOISE_ROLES
        noise |= "hidden" in found or found.get("aria-hidden") == "true"
    return ".".join([tag, *names]), noise, named


class Page:
    """Blocks of text and the tree of paths they stand in.

    A path is stored once with the place of its parent, so that deep pages take linear room. Parents stand
    before their children. The root is place 0.
    """

    def __init__(self, source: str | None):
        # Pieces of text, each with the innermost noise by name, then place, region above or here.
        self.pieces: list[tuple[list[tuple[str, int]], int, bool]] = []
        self.paths: list[int] = [0]
        self.parents: list[int] = [0]
        self.children: list[list[str]] = [[]]
        self.places: dict[int, int] = {0: 0}
        # Elements with a name of noise: the one around it, and whether it holds the main element.
        self.around: list[int] = [0]
        self.cleared: list[bool] = [True]
        # Open elements: tag, place, noise above or here, region above or here, innermost named noise.
        self.open: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 0)]
        self.count: Counter[str] = Counter()
        self.texts: list[tuple[str, int]] = []
        at = 0
        for m in TOKEN.finditer(source or ""):
            self._text(source[at : m.start()])
            at = m.end()
            if m[3]:
                (self._end if m[2] else self._start)(m[3].lower(), m[4])
            elif m[1] and m[1].lower() not in INLINE:
                self._flush()
        self._text((source or "")[at:])
        self._flush()
        self.blocks: list[tuple[str, int, bool]] = list(self._shown())

    def _text(self, text: str) -> None:
        if text and not self.open[-1][2]:
            self.texts.append((text, self.open[-1][4]))

    def _flush(self) -> None:
        if self.texts:
            self.pieces.append((self.texts, self.open[-1][1], self.open[-1][3]))
            self.texts = []

    def _shown(self):
        """Blocks as (text, place, region), without what is noise by name."""
        shown = [True]
        for i in range(1, len(self.around)):
            shown.append(self.cleared[i] and shown[self.around[i]])
        for texts, place, inside in self.pieces:
            text = "".join([t for t, named in texts if shown[named]])
            text = " ".join(references.unescape(text).split())
            if text:
                yield text, place, inside

    def _clear(self, named: int) -> None:
        """The named elements around the main element are no noise."""
        while not self.cleared[named]:
            self.cleared[named] = True
            named = self.around[named]

    def _close(self, i: int) -> None:
        """Close the open element i and all within."""
        if any(x[0] not in INLINE for x in self.open[i:]):
            self._flush()
        self.count.subtract(x[0] for x in self.open[i:])
        del self.open[i:]

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "wbr":
            self._text(" " if tag == "br" else "")
            return
        block = tag not in INLINE
        if block:
            self._flush()
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] == "p":
                    self._close(i)
                    break
                if self.open[i][0] not in INLINE:
                    break
        if tag in ENDS and any(self.count[t] for t in ENDS[tag][0]):
            ended, container = ENDS[tag]
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] in container:
                    break
                if self.open[i][0] in ended:
                    self._close(i)
                    break
        if tag in VOID:
            return
        _, above, noise, region, named = self.open[-1]
        style, own_noise, own_name = style_of(tag, attributes)
        # A header outside of an article is the page's, one inside may hold the title.
        own_noise |= tag in HIDDEN or (tag == "header" and not region)
        place = above
        if tag not in INLINE:
            place = self._place(above, style)
        if tag == "main":
            self._clear(named)
        if own_name:
            self.around.append(named)
            self.cleared.append(False)
            named = len(self.around) - 1
        self.count[tag] += 1
        self.open.append((tag, place, noise or own_noise, region or tag in REGIONS, named))

    def _place(self, above: int, style: str) -> int:
        """Where the child of this style stands."""
        siblings = self.children[above]
        if not siblings or siblings[-1] != style:
            siblings.append(style)
        path = digest(self.paths[above], style)
        place = self.places.setdefault(path, len(self.paths))
        if place == len(self.paths):
            self.paths.append(path)
            self.parents.append(above)
            self.children.append([])
        return place

    def _end(self, tag: str, _: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self._close(i)
                return
            if tag in INLINE and self.open[i][0] not in INLINE:
                return

    def main_text(self, low: frozenset[int] = frozenset()) -> str:
        """Text below no branch of low importance; that of the regions alone where they dominate."""
        gone = [False]
        for place in range(1, len(self.paths)):
            gone.append(gone[self.parents[place]] or self.paths[place] in low)
        left = [(text, inside) for text, place, inside in self.blocks if not gone[place]]
        regions = [text for text, inside in left if inside]
        size = sum(map(len, regions))
        if size and size >= DOMINANT * sum(len(text) for text, _ in left):
            return "\n\n".join(regions)
        return "\n\n".join([text for text, _ in left])

    def nodes(self):
        """(path, presentation, content) of the nodes on this page that have text, as hashes.

        The content of a node is that of its own blocks, in order, and of its children's contents.
        """
        content: dict[int, xxhash.xxh64] = {}
        for text, place, _ in self.blocks:
            content.setdefault(place, xxhash.xxh64()).update(text.encode("utf-8", "replace") + b"\n")
        for place in range(len(self.paths) - 1, 0, -1):
            if place in content:
                seen, parent = content[place], self.parents[place]
                yield self.paths[place], digest(*self.children[place]), seen.intdigest() - (1 << 63)
                if parent:
                    part = seen.digest() + self.paths[place].to_bytes(8, "little", signed=True)
                    content.setdefault(parent, xxhash.xxh64()).update(part)


def style_nodes(pages: DataFrame) -> DataFrame:
    """host, path, page, presentation, content: one row for every node of every distinct page."""
    schema = "host string, path long, page long, presentation long, content long"

    def run(batches):
        for batch in batches:
            rows = set()
            for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page, host = Page(source), host_of(url)
                whole = digest(*(text for text, _, _ in page.blocks))
                rows.update((host, path, whole, p, c) for path, p, c in page.nodes())
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds)],
                names=["host", "path", "page", "presentation", "content"],
            )

    return pages.select("url", "html").mapInArrow(run, schema).distinct()


def importance(nodes: DataFrame) -> DataFrame:
    """host, path, pages, importance of the nodes of all style trees."""
    kinds = F.explode(
        F.array(
            *(
                F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value"))
                for kind in ("presentation", "content")
            )
        )
    )
    counted = (
        nodes.select("host", "path", kinds.alias("x"))
        .groupBy("host", "path", F.col("x.kind").alias("kind"), F.col("x.value").alias("value"))
        .count()
    )
    m = F.sum("count")
    entropy = F.log(m) - F.sum(F.col("count") * F.log("count")) / m
    by_kind = counted.groupBy("host", "path", "kind").agg(
        m.alias("pages"), F.when(m > 1, entropy / F.log(m)).otherwise(1.0).alias("importance")
    )
    return by_kind.groupBy("host", "path").agg(
        F.max("pages").alias("pages"), F.max("importance").alias("importance")
    )


def low_branches(pages: DataFrame) -> DataFrame:
    """host and the paths of its branches of low importance."""
    low = importance(style_nodes(pages)).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LOW))
    return low.groupBy("host").agg(F.collect_list("path").alias("paths"))


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns of pages(url, html) with text and n_chars of the main text."""
    low = stage(low_branches(pages), "html-low-branches")

    host_name, paths_name, salt_name = unused_names(pages.columns, "host", "paths", "salt")
    low = low.withColumnsRenamed({"host": f"{host_name}_low", "paths": paths_name})

    def make_host():
        return lambda urls: {host_name: [host_of(u) for u in urls.to_pylist()]}

    host = T.StructType([T.StructField(host_name, T.StringType())])
    hosts = low.count()

    def make():
        def compute(sources, lows):
            texts = [
                Page(source).main_text(frozenset(paths or ()))
                for source, paths in zip(sources.to_pylist(), lows.to_pylist())
            ]
            return {"text": texts, "n_chars": list(map(len, texts))}

        return compute

    if not hosts:
        joined = pages.withColumn(paths_name, F.array().cast("array<bigint>"))
    else:
        named = append_columns(pages, make_host, ["url"], host)
        on = named[host_name] == low[f"{host_name}_low"]
        if hosts <= BROADCAST_HOSTS:
            joined = named.join(F.broadcast(low), on, "left")
        else:
            low = low.withColumn(f"{salt_name}_low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            named = named.withColumn(salt_name, F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int"))
            on = [F.col(name) == F.col(f"{name}_low") for name in (host_name, salt_name)]
            joined = named.join(low, on, "left")
    return append_columns(joined, make, ["html", paths_name], RESULT, keep)
