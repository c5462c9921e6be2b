"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements (marks inside a line belong to the block they stand in). Every node has
features of its subtree (text, links, density), its attribute tokens and those above it, its depth and its siblings.
Boosted trees give the log-odds that a node belongs to the article. They are fitted on weak labels: on pages that mark
their article, nodes inside it are text and marked menus, notices, forms or comments are not. Each training page is also
shown with its marks hidden, so that the trees learn to judge unmarked pages by density and place.

Decoding finds the best consistent labelling: an article begins at some node and covers its subtree, except for whole
subtrees that are cut out; nothing inside a cut-out subtree comes back and no text stands outside an article.
"""

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches, received, send

# Groups of element names, and words that authors use in names, classes, ids and roles.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = set("script style template noscript head title meta link base iframe object svg canvas select option textarea button audio video math".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ENDS_P = set(
    "address article aside blockquote details div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split()
)
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS_AT = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
MAIN_WORDS = set("article main content post entry story articlebody mainentity body text".split())
MAIN_TAGS = {"article", "main"}
OTHER_WORDS = set(
    "nav navigation navbar menu menubar header masthead topbar banner footer footnote colophon sidebar aside rail complementary widget notice alert cookie cookies consent gdpr "
    "popup modal overlay ad ads adv advert adverts advertisement sponsor sponsored promo promotion commercial form search login signup subscribe newsletter comment comments "
    "respond reply replies discussion disqus share sharing social breadcrumb breadcrumbs pagination pager related recommended recommendations tags toolbar contentinfo".split()
)
OTHER_TAGS = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "fieldset"}
SPLIT = re.compile(r"[^a-z0-9]+")
NAMED = ("class", "id", "role", "itemprop", "itemtype", "aria-label")
GROUPS = [MAIN_TAGS, {"section"}, {"div"}, {"p", "pre", "blockquote"}, HEADINGS, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tr", "td", "th"}, OTHER_TAGS, {"body", "html"}]
OTHER_ORDER, WORD_ORDER, MAIN_ORDER = sorted(OTHER_TAGS), sorted(OTHER_WORDS), sorted(MAIN_WORDS)
ARTICLE_PARTS = ["p", "blockquote", "div", "h2", "h3", "pre", "ul li", "ol li", "table tr td", "section h2", "div p", "figure figcaption"]
# Features before this one stay when the marks of a page are hidden.
PLAIN = 15
WIDTH = PLAIN + 5 + len(GROUPS)


def _tokens(attributes: list[tuple[str, str | None]]) -> set[str]:
    found: set[str] = set()
    for name, value in attributes:
        if name in NAMED and value:
            # articleBody and ad-box alike become words
            found.update(SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()))
            found.update(SPLIT.split(value.lower()))
    found.discard("")
    return found


class Page(HTMLParser):
    """Block nodes in page order (parents first) and the text pieces with the node they stand in."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.words = ["#page"], [-1], [set()]
        self.pieces: list[tuple[int, str, bool]] = []  # node, text, inside a link; node -1: a break
        self.open: list[tuple[str, int]] = [("#page", 0)]
        self.unseen = self.links = 0
        self.feed(html)
        self.close()

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_starttag(self, tag, attrs):
        if tag in SAME_ENDS:
            self._end(SAME_ENDS[tag], STOPS_AT[tag])
        if tag in ENDS_P:
            self._end({"p"}, {"td", "th", "li", "div", "article", "section", "blockquote", "button", "object"})
        words, hidden = _tokens(attrs), False
        for name, value in attrs:
            hidden = hidden or name == "hidden" or (name == "style" and "display:none" in (value or "").replace(" ", "").lower())
        inline = tag in INLINE and words.isdisjoint(OTHER_WORDS)
        if not inline or tag == "br":
            self.pieces.append((-1, "", False))
        if tag in VOID:
            return
        node = self.open[-1][1]
        if not inline:
            node = len(self.tags)
            self.tags.append(tag)
            self.parents.append(self.open[-1][1])
            self.words.append(words)
        self.open.append((f"{tag}!" if hidden else tag, node))
        self.unseen += tag in UNSEEN or hidden
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (tag in UNSEEN or tag in INLINE):
            self.handle_endtag(tag)

    def _pop(self):
        tag, _ = self.open.pop()
        name = tag.rstrip("!")
        self.unseen -= name in UNSEEN or tag.endswith("!")
        self.links -= name == "a"
        if name not in INLINE:
            self.pieces.append((-1, "", False))

    def _end(self, tags: set[str], stops: set[str]):
        """Close the nearest open element of these, unless one of the stops is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0].rstrip("!")
            if name in tags:
                while len(self.open) > i:
                    self._pop()
                return
            if name in stops:
                return

    def handle_endtag(self, tag):
        stops = set()
        if tag in INLINE:
            for name, _ in reversed(self.open):
                if name.rstrip("!") not in INLINE:
                    stops = {name.rstrip("!")}
                    break
        self._end({tag}, stops)

    def handle_data(self, data):
        if not self.unseen:
            self.pieces.append((self.open[-1][1], data, self.links > 0))


def features(pages: list[Page]) -> np.ndarray:
    """One row per node of all the pages, in order."""
    rows: list[tuple] = []
    for page in pages:
        rows.extend(_node_rows(page))
    table = np.array(rows, dtype=float).reshape(len(rows), 12 + 5 + 1)
    letters, own, linked, nodes, depth, children, place, around, alike, signs, spaces, pieces = table[:, :12].T
    share, begin = _within_page(pages, letters, table[:, 17])
    some = np.maximum(letters, 1)
    plain = [np.log1p(letters), np.log1p(own), linked / some, np.log1p(nodes), np.log1p(letters / nodes), depth, np.log1p(children), place,
             place / np.maximum(around, 1), np.log1p(around), alike, signs / some, (spaces + pieces) / np.maximum(pieces, 1), share, begin]
    names = {}
    groups = np.array([names.get(t) or names.setdefault(t, [t in g for g in GROUPS]) for page in pages for t in page.tags], dtype=float)
    return np.concatenate([np.stack(plain, axis=1), table[:, 12:17], groups.reshape(len(rows), len(GROUPS))], axis=1)


def _within_page(pages: list[Page], letters: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's part of the letters of its page, and where in them it begins."""
    sizes = [len(p.tags) for p in pages]
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
    total = np.maximum(np.repeat(letters[roots], sizes), 1)
    return letters / total, np.maximum(begin, 0) / total


def _node_rows(page: Page) -> list[tuple]:
    """Sums over the subtree of every node, its place among its siblings, and its marks."""
    n, parents, tags = len(page.tags), page.parents, page.tags
    letters, own, linked, signs, spaces, pieces, nodes = ([0] * n for _ in range(7))
    begin, at = [-1] * n, 0
    for node, text, in_link in page.pieces:
        size = len(text)
        if node < 0 or not size or text.isspace():
            continue
        own[node] += size
        linked[node] += size * in_link
        signs[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
        spaces[node] += text.count(" ")
        pieces[node] += 1
        if begin[node] < 0:
            begin[node] = at
        at += size
    letters[:] = own
    for i in range(n - 1, -1, -1):
        nodes[i] += 1
        p = parents[i]
        if p < 0:
            continue
        letters[p] += letters[i]
        linked[p] += linked[i]
        signs[p] += signs[i]
        spaces[p] += spaces[i]
        pieces[p] += pieces[i]
        nodes[p] += nodes[i]
        if begin[i] >= 0 and (begin[p] < 0 or begin[i] < begin[p]):
            begin[p] = begin[i]
    depth, place, children, kinds = [0] * n, [0] * n, [0] * n, {}
    own_main, own_other, main_above, other_above = ([False] * n for _ in range(4))
    for i in range(n):
        tag, words, p = tags[i], page.words[i], parents[i]
        own_main[i] = tag in MAIN_TAGS or not words.isdisjoint(MAIN_WORDS)
        own_other[i] = other_above[i] = tag in OTHER_TAGS or not words.isdisjoint(OTHER_WORDS)
        if p >= 0:
            depth[i] = depth[p] + 1
            place[i] = children[p]
            children[p] += 1
            kinds[p, tag] = kinds.get((p, tag), 0) + 1
            main_above[i] = main_above[p] or own_main[p]
            other_above[i] = other_above[i] or other_above[p]
    marked = any(own_main)
    return [
        (letters[i], own[i], linked[i], nodes[i], depth[i], children[i], place[i], children[p] if p >= 0 else 1,
         kinds[p, tags[i]] / children[p] if p >= 0 else 1, signs[i], spaces[i], pieces[i],
         own_main[i], own_other[i], main_above[i], other_above[i], marked, begin[i])
        for i, p in enumerate(parents)
    ]


def weak_labels(page: Page, by_words: bool = False) -> np.ndarray | None:
    """1 inside a marked article, 0 elsewhere, for pages that mark one by an element (or by_words, by a name); None for others."""
    n = len(page.tags)
    inside, cut = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    for i in range(n):
        p = page.parents[i]
        tag, words = page.tags[i], page.words[i]
        cut[i] = tag in OTHER_TAGS or not words.isdisjoint(OTHER_WORDS) or (p >= 0 and cut[p])
        marked = tag in MAIN_TAGS or (by_words and not words.isdisjoint(MAIN_WORDS))
        inside[i] = marked or (p >= 0 and inside[p])
    return (inside & ~cut).astype(np.int64) if inside.any() else None


def disturbed(html: str, paragraphs: list[str], random: np.random.Generator) -> str:
    """A training page whose article has further parts of its own, and blocks of its own sentences marked as something else.

    The marked blocks stand inside the article and around it, so the marks and not the density tell them from it. The
    article itself may be marked by a name instead of its element, and may stand alone.
    """

    def pick(options):
        return options[int(random.integers(len(options)))]

    def some_text() -> str:
        text = pick(paragraphs)
        return text[: int(random.integers(1, len(text) + 1))] if random.random() < 0.7 else text

    def own_part() -> str:
        outer, _, last = pick(ARTICLE_PARTS).rpartition(" ")
        tags = outer.split()
        items = "".join(f"<{last}>{some_text()}</{last}>" for _ in range(int(random.integers(1, 5)) if tags else 1))
        return "".join(f"<{t}>" for t in tags) + items + "".join(f"</{t}>" for t in reversed(tags))

    def block() -> str:
        if random.random() < 0.3:
            return ""
        inner = own_part() if random.random() < 0.7 else some_text()
        return f"<{t}>{inner}</{t}>" if random.random() < 0.4 and (t := pick(OTHER_ORDER)) else f'<div class="{pick(WORD_ORDER)}">{inner}</div>'

    open_tag = re.search(r"<(article|main)\b[^>]*>", html, re.I)
    if not open_tag or not paragraphs:
        return html
    close = re.compile(f"</{open_tag[1]}>", re.I).search(html, open_tag.end())
    end = close.start() if close else len(html)
    inner = html[open_tag.end() : end]
    ends = [m.end() for m in re.finditer(r"</p>", inner)] or [len(inner)]
    if random.random() < 0.4:  # a short article
        inner, ends = inner[: ends[0]], ends[:1]
    for at in sorted({pick(ends) for _ in range(4)}, reverse=True):
        inner = inner[:at] + own_part() + block() + inner[at:]
    before, after = html[: open_tag.start()], html[end + (len(close[0]) if close else 0) :]
    if random.random() < 0.4:
        before, after = "<html><body>", "</body></html>"
    before, after = before + block(), block() + after
    if random.random() < 0.4:
        return f'{before}<div class="{pick(MAIN_ORDER)}">{inner}</div>{after}'
    return f"{before}{open_tag[0]}{inner}</{open_tag[1]}>{after}"


class BoostedTrees:
    """Logistic boosting of small trees on binned features."""

    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        cells = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)  # cell b: value <= edge b
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        value = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-value))
            tree, leaf_of = self._grow(cells, edges, y - p, p * (1 - p))
            self.trees.append(tree)
            value += tree[2][leaf_of]
        return self

    def _grow(self, cells, edges, slope, curve):
        """Complete tree: at inner node i the children are 2i + 1 and 2i + 2; leaves carry values."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(cells), dtype=np.int64)
        for i in range(inner):
            rows = np.flatnonzero(node == i)
            best = (1e-6, 0, None)
            if len(rows) > 1:
                g, h = slope[rows].sum(), curve[rows].sum()
                whole = g * g / (h + self.least)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    c = cells[rows, f]
                    gl = np.cumsum(np.bincount(c, weights=slope[rows], minlength=len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(c, weights=curve[rows], minlength=len(e) + 1))[:-1]
                    gain = gl**2 / (hl + self.least) + (g - gl) ** 2 / (h - hl + self.least) - whole
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[2] is None:
                node[rows] = 2 * i + 1
            else:
                feature[i], cut[i] = best[1], edges[best[1]][best[2]]
                node[rows] = 2 * i + 1 + (cells[rows, best[1]] > best[2])
        leaf_of = node - inner
        leaves = 1 << self.depth
        values = self.rate * np.bincount(leaf_of, weights=slope, minlength=leaves) / (np.bincount(leaf_of, weights=curve, minlength=leaves) + self.least)
        return (feature, cut, values), leaf_of

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = (1 << self.depth) - 1
        for feature, cut, values in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += values[node - inner]
        return out


def decode(parents: list[int], odds: np.ndarray) -> list[bool]:
    """Which nodes are text: the consistent labelling with the largest sum of log-odds."""
    n = len(parents)
    outside, inside = [0.0] * n, odds.tolist()
    for i in range(n - 1, 0, -1):
        p = parents[i]
        outside[p] += max(outside[i], inside[i])
        inside[p] += max(inside[i], 0.0)
    text, cut = [False] * n, [False] * n
    for i, p in enumerate(parents):
        if p >= 0 and cut[p]:
            cut[i] = True
        elif p >= 0 and text[p]:
            text[i] = inside[i] > 0
            cut[i] = not text[i]
        else:
            text[i] = inside[i] > outside[i] and inside[i] > 0
    return text


def main_text(page: Page, text: list[bool]) -> str:
    return " ".join("".join(piece if node >= 0 and text[node] else " " if node < 0 else "" for node, piece, _ in page.pieces).split())


def without_marks(rows: np.ndarray) -> np.ndarray:
    """The features as if article and menu elements were like any other and no name told anything."""
    out = rows.copy()
    out[:, PLAIN : PLAIN + 5] = 0
    for marks in (0, len(GROUPS) - 2):
        out[:, PLAIN + 7] += out[:, PLAIN + 5 + marks]
        out[:, PLAIN + 5 + marks] = 0
    return out


def training_rows(html: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and weak labels of a marked page: as it is, with its marks hidden, and disturbed."""
    page = Page(html)
    labels = weak_labels(page)
    if labels is None:
        return []
    plain = features([page])
    hidden = without_marks(plain)
    paragraphs = [text for node, text, _ in page.pieces if node >= 0 and labels[node] and len(text) > 20]
    random = np.random.default_rng(len(html))
    others = [Page(disturbed(html, paragraphs, random)) for _ in range(3)]
    alone = Page(f"<article>{''.join(f'<p>{p}</p>' for p in paragraphs[: int(random.integers(1, 6))])}</article>")
    return [
        (plain, labels),
        (hidden, labels),
        (without_marks(features([alone])), weak_labels(alone)),
        *[(features([o]), weak_labels(o, by_words=True)) for o in others],
    ]


def learn(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = 250, most_chars: int = 200_000) -> BoostedTrees:
    """Trees fitted on the marked pages among `sample` pages (smallest hashes of the id) of up to `most_chars` characters.

    Without a marked page among them the trees are empty and every page's text is what decoding keeps of even odds: none.
    """
    bounded_batches(pages.sparkSession, 256)
    able = pages.select(F.col(page_id).alias("_id"), F.col(html).alias("_html"))
    chosen = able.filter(F.length("_html") <= most_chars).select(F.col("_id").alias("_chosen")).distinct().orderBy(F.xxhash64("_chosen"), "_chosen").limit(sample)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            examples = [e for value in batch.column("_html").to_pylist() for e in training_rows(value)]
            x = np.concatenate([np.zeros((0, WIDTH)), *[e[0] for e in examples]])
            y = np.concatenate([np.zeros(0, dtype=np.int64), *[e[1] for e in examples]])
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array(y)], ["x", "y"])

    rows = able.join(F.broadcast(chosen), able["_id"].eqNullSafe(chosen["_chosen"])).filter("_html is not null").select("_html")  # at most `sample` ids
    found = rows.mapInArrow(describe, "x array<double>, y long").toPandas()
    model = BoostedTrees()
    if len(found) and found["y"].nunique() == 2:
        model.fit(np.array(found["x"].tolist()), found["y"].to_numpy(dtype=float))
    return model


def extract(pages: DataFrame, model: BoostedTrees, page_id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """One row per input row: _id, _url, text and n_chars (code points).

    A null or empty page has an empty text, and so has a page without an article. Unclosed and stray tags are repaired as
    browsers do for blocks. Rows that repeat repeat their text.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 256)
    shared = send(spark, model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = received(shared)
        for batch in batches:
            parsed = [Page(h or "") for h in batch.column("_html").to_pylist()]
            odds = trees.log_odds(features(parsed)) if parsed else np.zeros(0)
            parts = np.split(odds, np.cumsum([len(p.tags) for p in parsed])[:-1]) if parsed else []
            texts = [main_text(p, decode(p.parents, o)) for p, o in zip(parsed, parts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())], ["_id", "_url", "text"])

    rows = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    found = rows.mapInArrow(apply, f"_id {kinds['_id']}, _url {kinds['_url']}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
