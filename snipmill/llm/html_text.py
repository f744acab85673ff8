"""Main text of web pages by gradient-boosted trees over the nodes of the page.

A page becomes a tree of its block elements. Each block is described by its size,
its share of links, marks and form fields, its depth, its place among its siblings
and their sizes, and by the tokens of its tag, class, id and role and of those of
its ancestors. Boosted trees turn that into log-odds of holding main text.

Decoding is hierarchical: a block may only be kept if all blocks around it are.
The best consistent choice is found by one pass from the leaves: a block is worth
its log-odds plus the better of keeping or dropping each block inside, against
dropping all of them. So no ancestor contradicts a descendant. White space and
references are then resolved, and kept blocks are joined in page order.

There is no hand-labelled table of blocks. The trees learn from pages that mark
their article: blocks around and inside it hold main text, except those inside it
that name themselves as something else. Each such page is learned from three times:
as it is, with these marks hidden from the features, so that the trees learn what
such blocks look like, and with text of its article grafted into blocks that name
themselves as something else, so that a name counts where the look does not tell.
Training takes a bounded sample (``Forest.sample_pages``, smallest hashes of url
and html); every page is extracted from its whole html.

Results, defined for every input: a null or empty page has an empty text. Broken
markup never fails: unclosed elements end with what they stand in, stray end tags
are ignored, text outside all blocks belongs to the page. A head ends before the first
text or element that cannot stand in it. Drawings, objects and templates end with their
parent, drawings also before a block; one without any end tag behind it is empty. Pages are handled one by
one, so ties, repeated rows and further columns do not matter. Without a page that
marks its article, all blocks that name themselves as something else are dropped.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snipmill.llm.common import sampled, texts_of

# Elements whose text is never shown as text of the page, and those without content.
RAW = "script style noscript iframe title textarea".split()
HIDDEN = {"head", "select", "datalist", "button", "audio", "video", "map"}
# Elements that are no blocks of the page, nor is what they hold. They end with their parent.
FOREIGN = {"template", "object", "svg", "canvas"}
# What may stand in a head; anything else ends it.
_HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", *RAW, "template"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
    "meter nobr output progress q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var".split()
)
# An open element of the key ends where one of these begins.
_BLOCK_BEGINS = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
    "table ul".split()
)
ENDS_WITH = {
    "p": _BLOCK_BEGINS,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option", "optgroup"},
}
# How blocks name themselves, by tag, class, id or role.
OTHER = set(
    "ad ads adv advert adverts advertisement advertising aside banner bar bottom breadcrumb "
    "breadcrumbs button buttons byline comment comments complementary consent contentinfo "
    "cookie cookies copyright credits dialog discussion disqus feedback footer form forms gdpr "
    "header hidden links login masthead menu menubar meta modal nav navbar navigation "
    "newsletter notice notices notification outbrain overlay pager pagination popup privacy "
    "promo promoted promotion recommended related replies reply respond rss search share "
    "sharing shoutbox sidebar sidenav signup skip skyscraper social sponsor sponsored "
    "subscribe tags teaser thread toolbar topbar warning widget widgets".split()
)
MAIN = set(
    "article articlebody blog body content entry main maincontent post postbody prose story "
    "storybody text".split()
)
LANDMARKS = {"article", "main"}

FEATURES = (
    "letters words_per_block links marks blocks depth own_other own_main around_other "
    "around_main siblings place share paragraphs fields punctuation heading item "
    "sibling_letters symbols"
).split()
HIDEABLE = [FEATURES.index(f) for f in ("own_other", "own_main", "around_other", "around_main")]

# A quote after "=" ends with the next one, however far; elsewhere it may be a stray one.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')"
    r"|\"[^\"]{0,4000}\"|'[^']{0,4000}'|[\"'=])*+)>"
    r"|<[!?/][^<>]*>",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
_FOREIGN_END = re.compile(rf"</({'|'.join(sorted(FOREIGN))})(?=[\s/>])", re.I)


class Page:
    """Blocks of a page in page order; the first is the page itself."""

    def __init__(self, html: str):
        self.tags, self.parents, self.tokens = ["#page"], [-1], [frozenset()]
        self.runs: list[tuple[int, str]] = []  # block and text, in page order
        self.linked, self.inner, self.fields = [0], [0], [0]
        self._read(html)

    def _read(self, html: str) -> None:
        # Open blocks with their tag and the links open in them, and how often a tag is open.
        stack: list[list] = [["#page", 0, 0]]
        open_tags: Counter[str] = Counter()
        links = hidden = foreign = 0
        last_end: dict[str, int] | None = None  # of foreign elements

        def close() -> None:
            nonlocal links, hidden, foreign
            tag, _, own_links = stack.pop()
            open_tags[tag] -= 1
            links -= own_links
            hidden -= tag in HIDDEN or tag in FOREIGN
            foreign -= tag in FOREIGN

        at, end = 0, len(html)
        while at < end:
            found = _TAG.search(html, at)
            stop = found.start() if found else end
            if stop > at and stack[-1][0] == "head" and not html[at:stop].isspace():
                close()
            block = stack[-1][1]
            if stop > at and not hidden:
                self.runs.append((block, html[at:stop]))
                if links:
                    self.linked[block] += stop - at
            if not found:
                break
            at = found.end()
            name = found[2]
            if not name:
                continue
            tag = name.lower()
            if not found[1] and stack[-1][0] == "head" and tag not in _HEAD:
                close()
                block = stack[-1][1]
            if tag in INLINE:
                if found[1]:
                    if tag == "a" and stack[-1][2]:
                        stack[-1][2] -= 1
                        links -= 1
                else:
                    self.inner[block] += not foreign
                    if tag == "a":
                        stack[-1][2] += 1
                        links += 1
                continue
            if found[1]:
                if open_tags[tag]:
                    while stack[-1][0] != tag:
                        close()
                    close()
                if not hidden:
                    self.runs.append((stack[-1][1], " "))
                continue
            if tag in _RAW_END:
                over = _RAW_END[tag].search(html, at)
                at = over.end() if over else end
                continue
            if open_tags["svg"] and not open_tags["foreignobject"] and (tag == "p" or tag in _BLOCK_BEGINS):
                while open_tags["svg"]:
                    close()
            while tag in ENDS_WITH.get(stack[-1][0], ()):
                close()
            block = stack[-1][1]
            if tag in FOREIGN or foreign:
                whole = (tag == "svg" or open_tags["svg"]) and found[3].endswith("/")
                if tag in FOREIGN and not whole:
                    if last_end is None:
                        last_end = {m[1].lower(): m.start() for m in _FOREIGN_END.finditer(html, at)}
                    whole = last_end.get(tag, 0) < at
                if not whole and tag not in VOID:
                    hidden += tag in HIDDEN or tag in FOREIGN
                    foreign += tag in FOREIGN
                    open_tags[tag] += 1
                    stack.append([tag, block, 0])
                continue
            if not hidden:
                self.runs.append((block, " "))
            if tag in VOID:
                self.fields[block] += tag == "input"
                continue
            self.tags.append(tag)
            self.parents.append(block)
            names = " ".join(m.strip("\"'") for m in _NAMES.findall(found[3])) if found[3] else ""
            own = {t.lower() for t in _TOKEN.findall(names)} | set(names.lower().split())
            self.tokens.append(frozenset(own | {tag}))
            self.linked.append(0)
            self.inner.append(0)
            self.fields.append(int(tag in ("form", "fieldset", "button", "select")))
            hidden += tag in HIDDEN
            open_tags[tag] += 1
            stack.append([tag, len(self.tags) - 1, 0])

    def features(self) -> np.ndarray:
        """One row of ``FEATURES`` per block."""
        n = len(self.tags)
        parents = self.parents
        own_letters, own_words, own_stops, own_symbols = [0] * n, [0] * n, [0] * n, [0] * n
        for block, text in self.runs:
            if text != " ":
                own_letters[block] += len(text)
                own_words[block] += text.count(" ") + 1
                own_stops[block] += text.count(".") + text.count(",")
                own_symbols[block] += text.count("|") + text.count("&copy;") + text.count("©")
        letters, words, stops = own_letters[:], own_words[:], own_stops[:]
        links, inner, fields, symbols = self.linked[:], self.inner[:], self.fields[:], own_symbols
        blocks, paragraphs, children = [1] * n, [t == "p" for t in self.tags], [0] * n
        place, depth = [0] * n, [0] * n
        other, main = [0] * n, [0] * n
        around_other, around_main = [0] * n, [0] * n
        for i in range(1, n):
            p = parents[i]
            place[i] = children[p]
            children[p] += 1
            depth[i] = depth[p] + 1
            known = self.tokens[i]
            other[i], main[i] = len(known & OTHER), len(known & MAIN)
            around_other[i] = around_other[p] + other[p]
            around_main[i] = around_main[p] + (main[p] if self.tags[p] != "body" else 0)
        paragraphs = [int(x) for x in paragraphs]
        for i in range(n - 1, 0, -1):
            p = parents[i]
            for sums in (letters, words, stops, links, inner, fields, symbols, blocks, paragraphs):
                sums[p] += sums[i]
        total = max(letters[0], 1)
        rows = []
        for i in range(n):
            p = max(parents[i], 0)
            size = max(letters[i], 1)
            tag = self.tags[i]
            rows.append(
                (
                    letters[i], words[i] / blocks[i], links[i] / size, inner[i] / (words[i] + 1),
                    blocks[i], depth[i], other[i], main[i] if tag != "body" else 0,
                    around_other[i], around_main[i], children[p], place[i] / max(children[p], 1),
                    letters[i] / total, paragraphs[i], fields[i], stops[i] / (words[i] + 1),
                    tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
                    tag in ("li", "ul", "ol", "dl", "dt", "dd"),
                    (letters[p] - letters[i]) / max(children[p], 1), symbols[i],
                )
            )
        return np.array(rows, np.float32)

    def marked(self) -> np.ndarray | None:
        """Whether each block holds main text, on a page that marks its article."""
        n = len(self.tags)
        roots = {
            i for i in range(1, n)
            if self.tags[i] in LANDMARKS or "articlebody" in self.tokens[i]
        }
        if not roots:
            return None
        inside, other = [False] * n, [False] * n
        for i in range(1, n):
            p = self.parents[i]
            other[i] = other[p] or bool(self.tokens[i] & OTHER - {"body"})
            inside[i] = i in roots or inside[p]
        good = [a and not b for a, b in zip(inside, other)]
        for i in range(n - 1, 0, -1):
            if good[i]:
                good[self.parents[i]] = True
        return np.array(good)

    def kept(self, odds: np.ndarray) -> list[bool]:
        """The consistent choice of blocks of the highest sum of log-odds."""
        n = len(self.tags)
        keep, drop = odds.tolist(), (-odds).tolist()
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            keep[p] += max(keep[i], drop[i])
            drop[p] += drop[i]
        chosen = [True] * n
        for i in range(1, n):
            chosen[i] = chosen[self.parents[i]] and keep[i] > drop[i]
        return chosen

    def text(self, chosen: list[bool]) -> str:
        """Text of the chosen blocks."""
        parts = (run if chosen[block] else " " for block, run in self.runs)
        return " ".join(unescape("".join(parts)).split())


@dataclass(frozen=True)
class Forest:
    """Parameters of training."""

    sample_pages: int = 800
    trees: int = 30
    depth: int = 4
    rate: float = 0.3
    bins: int = 24
    least_weight: float = 4.0
    shrink: float = 1.0
    seed: int = 11


@dataclass(frozen=True)
class Trees:
    """Boosted trees of a fixed depth: per inner node a feature and a limit, per leaf a value."""

    start: float
    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.features, self.limits, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(len(leaf).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            out += leaf[at - len(feature)]
        return out


def boosted(x: np.ndarray, y: np.ndarray, forest: Forest = Forest()) -> Trees:
    """Fit trees to labels by second-order boosting of the logistic loss over histograms."""
    n_inner, n_leaves = (1 << forest.depth) - 1, 1 << forest.depth
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    edges = [
        np.unique(np.quantile(c, np.linspace(0, 1, forest.bins + 1)[1:-1])) for c in x.T
    ]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    score = np.full(len(y), start)
    trees = []
    width = forest.bins + 1
    for _ in range(forest.trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, limit = np.zeros(n_inner, np.int64), np.full(n_inner, np.inf, np.float32)
        at = np.zeros(len(y), np.int64)
        for level in range(forest.depth):
            first, size = (1 << level) - 1, 1 << level
            local = at - first
            best, cut = np.full(size, 1e-9), np.zeros((size, 2), np.int64) - 1
            for f, edge in enumerate(edges):
                code = local * width + binned[:, f]
                gs = np.bincount(code, g, size * width).reshape(size, width).cumsum(axis=1)
                hs = np.bincount(code, h, size * width).reshape(size, width).cumsum(axis=1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + forest.shrink) + (ga - gs) ** 2 / (ha - hs + forest.shrink)
                gain -= ga**2 / (ha + forest.shrink)
                gain[(hs < forest.least_weight) | (ha - hs < forest.least_weight)] = 0
                gain[:, len(edge) :] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(size), top] > best
                best[better] = gain[np.arange(size), top][better]
                cut[better] = np.column_stack([np.full(size, f), top])[better]
            for k, (f, b) in enumerate(cut):
                if f >= 0:
                    feature[first + k], limit[first + k] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        leaf = at - n_inner
        value = np.bincount(leaf, g, n_leaves) / (np.bincount(leaf, h, n_leaves) + forest.shrink)
        value *= forest.rate
        score += value[leaf]
        trees.append((feature, limit, value))
    return Trees(start, *(np.array(t) for t in zip(*trees)))


def grafted(html: str, random: np.random.Generator) -> str:
    """A page with parts of its article's text in blocks that name themselves otherwise."""
    end = html.rfind("</article>")
    paragraphs = re.findall(r"<p>([^<]{40,})", html[: max(end, 0)])
    if not paragraphs:
        return html
    names, out = sorted(OTHER), []
    for _ in range(random.integers(1, 4)):
        text = paragraphs[random.integers(len(paragraphs))]
        tag = ("div", "section", "div")[random.integers(3)]
        out.append(f'<{tag} class="{names[random.integers(len(names))]}"><p>{text}</p></{tag}>')
    at = end if random.integers(2) else end + len("</article>")
    return html[:at] + "".join(out) + html[at:]


def by_names_only() -> Trees:
    """Trees for when nothing can be learned: drop what names itself as something else."""
    features = np.array([[FEATURES.index("own_other")]])
    return Trees(0.0, features, np.array([[0.5]], np.float32), np.array([[1.0, -4.0]]))


def train(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", forest: Forest = Forest()
) -> Trees:
    """Trees of a bounded sample of pages that mark their article."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            random = np.random.default_rng(forest.seed)
            for text in texts_of(batch.column(0)):
                html = text.decode("utf-8", "replace")
                for kind, source in enumerate((html, html, grafted(html, random))):
                    page = Page(source)
                    labels = page.marked()
                    if labels is not None:
                        x = page.features()
                        if kind == 1:
                            x[:, HIDEABLE] = 0
                        xs.append(x[1:])
                        ys.append(labels[1:])
            x = np.concatenate(xs) if xs else np.empty((0, len(FEATURES)), np.float32)
            y = np.concatenate(ys) if ys else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.tolist(), pa.list_(pa.float32())), pa.array(y)], names=["x", "y"]
            )

    some = pages.where(F.octet_length(html_col) > 0).select(
        F.col(html_col).alias("html"), F.xxhash64(url_col, html_col).alias("draw")
    )
    drawn = sampled(some, "draw", forest.sample_pages)
    table = drawn.select("html").mapInArrow(rows, "x array<float>, y boolean").toArrow()
    y = table["y"].to_numpy().astype(np.float64)
    if not len(y) or not 0 < y.mean() < 1:
        return by_names_only()
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return boosted(x.reshape(len(y), -1), y, forest)


def main_text(
    pages: DataFrame,
    trees: Trees,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per row: ``page_id``, ``url`` and the main ``text`` of the page."""
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("binary").alias("html"),
    )
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                found = [Page(t.decode("utf-8", "replace")) for t in texts_of(part.column(2))]
                x = [p.features() for p in found]
                odds = trees.odds(np.concatenate(x)) if x else np.empty(0)
                cuts = np.cumsum([len(v) for v in x])[:-1]
                texts = [p.text(p.kept(o)) for p, o in zip(found, np.split(odds, cuts))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
