"""HTML extraction: gradient-boosted trees score DOM nodes as main text or not, and a
decoding over the tree picks the best choice without contradictions.

Every block element of a page is a row of features: its tag and attribute tokens, those of
its ancestors, depth, text and link density of its subtree, sibling statistics. Down a path
of the tree a choice goes from outside to main text and at most once to left out again
(reader comments inside an article), never back; the best such labelling is found by
dynamic programming.

The trees are fitted to a bounded sample of pages whose main text is marked by ``article``
or ``main``. The sample's pages are also fitted with other markup around the same text (the
element renamed, menus, notices, adverts, forms, comments and sidebars put in), so that the
model does not lean on one element's name.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import chunks, map_texts

SAMPLE_PAGES = 150        # bound: pages that the trees are fitted to
SAMPLE_CHARS = 60_000     # bound: longer pages are not fitted to
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 24

# HTML's element classes.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var "
             "math annotation annotation-xml maction menclose merror mfrac mi mlabeledtr mmultiscripts mn mo "
             "mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable "
             "mtd mtext mtr munder munderover none semantics".split())
CLOSES_P = set("address article aside blockquote center details div dl fieldset figure footer form "
               "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "option": {"select"}}
NEVER = set("head button select option input datalist iframe object audio video canvas map".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S | re.I)
_ATTR = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")

TAG_GROUPS = [{"article", "main"}, {"div", "section"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"},
              {"ul", "ol", "li", "dl", "dt", "dd", "menu"}, {"nav"}, {"header"}, {"footer"}, {"aside"},
              {"form", "fieldset"}, {"table", "tr", "td", "th", "tbody", "thead"},
              {"blockquote", "pre", "figure", "figcaption"}]
TOKEN_GROUPS = [set("article content post entry story main articlebody text body".split()),
                set("nav menu navbar breadcrumb breadcrumbs pagination pager toc".split()),
                set("header masthead topbar branding banner".split()),
                set("footer foot copyright legal colophon".split()),
                set("sidebar side aside widget rail complementary".split()),
                set("ad ads advert advertisement sponsor sponsored promo promotion adsense".split()),
                set("comment comments reply replies discussion disqus respond".split()),
                set("cookie cookies notice alert consent gdpr popup modal overlay warning".split()),
                set("newsletter subscribe signup login search form".split()),
                set("share social related recommended more tags meta author byline".split())]
UNDER_TAGS = [{"article", "main"}, {"nav"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset"}]


class Node:
    __slots__ = ("parent", "tag", "tokens", "block", "kids", "text", "links", "marks", "nodes", "order")

    def __init__(self, parent, tag, tokens, block):
        self.parent, self.tag, self.tokens, self.block = parent, tag, tokens, block
        self.kids: list[Node] = []
        self.text = self.links = self.marks = self.nodes = 0


def _unfinished(m: re.Match) -> bool:
    """True for a comment, or an element whose content is no markup, that nothing ends."""
    if m["raw"]:
        return re.search(rf"</{m['raw']}\s*>\Z", m[0], re.I) is None
    return m[0].startswith("<!--") and not (m[0].endswith("-->") and len(m[0]) >= 7)


def parse(page: str) -> tuple[Node, list[Node], list[tuple[Node, str]]]:
    """Root, block nodes in page order, and the page's runs of text with their block;
    ``None`` instead of a text marks the edge of a block. Never fails: stray end tags
    are passed over, missing ones are supplied."""
    root = Node(None, "", frozenset(), True)
    blocks = [root]
    runs: list = []
    stack = [root]          # open elements
    within = [root]         # of each, the block it is or lies in
    opened: dict[str, list[int]] = {}   # places in the stack by tag
    at, links, hidden = 0, 0, 0

    def put(raw: str):
        if not hidden and raw:
            owner = within[-1]
            text = html.unescape(raw) if "&" in raw else raw
            n = len(text) - text.count(" ")
            if n:
                owner.text += n
                owner.links += n if links else 0
                owner.marks += text.count(".") + text.count(",")
            runs.append((owner, text))

    def pop():
        nonlocal links, hidden
        node = stack.pop()
        within.pop()
        opened[node.tag].pop()
        links -= node.tag == "a"
        hidden -= node.tag in NEVER
        if node.block:
            runs.append((node, None))

    def close(place: int):
        while len(stack) > place:
            pop()

    def innermost(tags: set[str]) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    last = page.rfind(">") + 1     # behind it there is no tag: looking for one's end would read all of it
    unfinished = False
    for m in _TOKEN.finditer(page, 0, last):
        put(page[at:m.start()])
        unfinished = m.end() == last and _unfinished(m)
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if opened.get(name):
                close(opened[name][-1])
            continue
        if name in VOID:
            if name in ("br", "hr"):
                put(" ")
            continue
        if name in CLOSES_P:
            if within[-1].tag == "p":
                close(opened["p"][-1])
        elif name in CLOSES:
            place = innermost(CLOSES[name])
            if place > innermost(STOPS[name]):
                close(place)
        attrs = m["attrs"] or m["attrs2"] or ""
        tokens = frozenset(_WORD.findall(" ".join(_ATTR.findall(attrs)).lower())) if attrs else frozenset()
        block = name not in INLINE
        node = Node(within[-1], name, tokens, block)
        if block:
            within[-1].kids.append(node)
            blocks.append(node)
            runs.append((node, None))
        links += name == "a"
        hidden += name in NEVER
        opened.setdefault(name, []).append(len(stack))
        stack.append(node)
        within.append(node if block else within[-1])
    if not unfinished:
        put(page[at:].partition("<!--")[0])
    return root, blocks, runs


def features(root: Node, blocks: list[Node]) -> np.ndarray:
    """A row for each block node, the root's first."""
    own = [n.text for n in blocks]
    for n in reversed(blocks):          # page order: kids come after their parent
        n.nodes += 1
        if n.parent is not None:
            p = n.parent
            p.text += n.text
            p.links += n.links
            p.marks += n.marks
            p.nodes += n.nodes
    beside = {id(n): n.text - t for n, t in zip(blocks, own)}   # the text of all kids of a block
    total = max(1, root.text)
    seen = 0
    under: dict[int, tuple] = {id(None): (0, (0,) * len(UNDER_TAGS), (0,) * len(TOKEN_GROUPS))}
    rows = []
    for i, n in enumerate(blocks):
        depth, tags, toks = under[id(n.parent)]
        mine = [1.0 if n.tag in g else 0.0 for g in TAG_GROUPS]
        has = [1.0 if n.tokens and not n.tokens.isdisjoint(g) else 0.0 for g in TOKEN_GROUPS]
        kids = n.parent.kids if n.parent is not None else [n]
        text = n.text
        around = beside[id(n.parent)] - text if n.parent is not None else 0
        rows.append([*mine, *has, *tags, *toks, depth, np.log1p(text), text / total,
                     n.links / (text or 1), n.marks / (text or 1), text / n.nodes, np.log1p(own[i]),
                     np.log1p(len(kids)), np.log1p(around / max(1, len(kids) - 1)),
                     np.log1p(len(n.kids)), seen / total])
        seen += own[i]
        under[id(n)] = (depth + 1, tuple(max(a, float(n.tag in g)) for a, g in zip(tags, UNDER_TAGS)),
                        tuple(map(max, toks, has)))
    return np.array(rows)


@dataclass
class Trees:
    """Boosted regression trees in heap order: a row goes right where its feature is
    above the threshold; ``leaves`` hold log-odds."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 7), np.int64))
    above: np.ndarray = field(default_factory=lambda: np.zeros((0, 7)))
    leaves: np.ndarray = field(default_factory=lambda: np.zeros((0, 8)))
    base: float = -3.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.above, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (2 ** DEPTH - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss over binned features."""
    if not len(x) or y.min() == y.max():
        return Trees()
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    out = np.zeros(len(x))
    feature, above, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-out))
        g, h = y - p, p * (1 - p) + 1e-6
        f, t = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
        at = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                here = np.flatnonzero(at == node)
                best = 1e-3
                G, H = g[here].sum(), h[here].sum()
                for j, c in enumerate(cuts):
                    if not len(c) or not len(here):
                        continue
                    b = binned[here, j]
                    gl = np.cumsum(np.bincount(b, g[here], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h[here], len(c) + 1))[:-1]
                    gain = gl ** 2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G ** 2 / (H + 1)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, f[node], t[node] = gain[k], j, c[k]
                at[here] = 2 * node + 1 + (x[here, f[node]] > t[node])
        leaf_of = at - (2 ** DEPTH - 1)
        value = RATE * np.bincount(leaf_of, g, 2 ** DEPTH) / (np.bincount(leaf_of, h, 2 ** DEPTH) + 1)
        out += value[leaf_of]
        feature.append(f)
        above.append(t)
        leaves.append(value)
    return Trees(np.array(feature), np.array(above), np.array(leaves), 0.0)


def decode(blocks: list[Node], odds: np.ndarray) -> set[int]:
    """``id`` of every block node that is main text in the best labelling
    outside* main* left-out* down each path. Ties leave a node out."""
    main = -np.logaddexp(0, -odds)
    rest = -np.logaddexp(0, odds)
    best = {}
    for i in range(len(blocks) - 1, -1, -1):
        n = blocks[i]
        o, m, x = rest[i], main[i], rest[i]
        for k in n.kids:
            ko, km, kx = best[id(k)]
            o += max(ko, km)
            m += max(km, kx)
            x += kx
        best[id(n)] = (o, m, x)
    state, chosen = {}, set()
    for n in blocks:
        o, m, x = best[id(n)]
        up = state.get(id(n.parent), "o")
        if up == "x":
            s = "x"
        elif up == "m":
            s = "m" if m > x else "x"
        else:
            s = "m" if m > o else "o"
        state[id(n)] = s
        if s == "m":
            chosen.add(id(n))
    return chosen


def join_blocks(runs: list, chosen: set[int]) -> str:
    """Texts of the chosen nodes: one white space inside a block, two line breaks
    between blocks."""
    out: list[str] = []
    buffer: list[str] = []

    def close():
        if buffer:
            if text := " ".join("".join(buffer).split()):
                out.append(text)
            buffer.clear()

    for node, text in runs:
        if text is None:
            close()
        elif id(node) in chosen:
            buffer.append(text)
    close()
    return "\n\n".join(out)


class Extractor:
    def __init__(self, trees: Trees):
        self.trees = trees

    def __call__(self, pages: list[str]) -> list[str]:
        parsed = [parse(p) for p in pages]
        rows = [features(root, blocks) for root, blocks, _ in parsed]
        odds = self.trees(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for (_, blocks, runs), r in zip(parsed, rows):
            out.append(join_blocks(runs, decode(blocks, odds[at:at + len(r)])))
            at += len(r)
        return out


# ------------------------------------------------------------------- learning

MAIN_OPEN = re.compile(r"<(article|main)\b[^>]*>", re.I)


def _region(page: str) -> tuple[int, int, int, int] | None:
    """Where the marked main text's element begins and its content begins and ends."""
    m = MAIN_OPEN.search(page)
    if not m:
        return None
    end = page.lower().rfind(f"</{m[1].lower()}")
    if end < m.end():
        end = len(page)
    stop = page.find(">", end)
    return m.start(), m.end(), end, len(page) if stop < 0 else stop + 1


def _filler(rng: random.Random, words: list[str], n: int) -> str:
    return html.escape(" ".join(rng.choice(words) for _ in range(n)))


def _boilerplate(rng: random.Random, words: list[str]) -> str:
    """One piece of page furniture with the words of other pages."""
    say = lambda lo, hi: _filler(rng, words, rng.randint(lo, hi))
    links = "".join(f'<li><a href="/x">{say(1, 3)}</a></li>' for _ in range(rng.randint(3, 8)))
    return rng.choice([
        lambda: f'<nav class="menu"><ul>{links}</ul></nav>',
        lambda: f'<header class="site-header"><h1>{say(2, 5)}</h1><p>{say(3, 10)}</p></header>',
        lambda: f'<div id="header"><h2>{say(2, 5)}</h2><ul>{links}</ul></div>',
        lambda: f'<footer class="footer"><p>&copy; {say(3, 12)}</p></footer>',
        lambda: f'<aside class="sidebar"><h3>{say(2, 4)}</h3><p>{say(8, 50)}</p><ul>{links}</ul></aside>',
        lambda: f'<div class="sidebar widget"><p>{say(8, 50)}</p><ul>{links}</ul></div>',
        lambda: f'<div class="cookie-notice"><p>{say(8, 40)}</p><button>{say(1, 2)}</button></div>',
        lambda: f'<div class="notice" role="alert">{say(5, 30)}</div>',
        lambda: f'<div class="ad">{say(3, 30)}</div>',
        lambda: f'<div class="advertisement"><p>{say(5, 40)}</p></div>',
        lambda: f'<form action="/s"><label>{say(1, 3)}</label><input name="q"><p>{say(3, 15)}</p></form>',
        lambda: f'<div class="newsletter"><p>{say(5, 25)}</p><form><input></form></div>',
        lambda: '<section class="comments" id="comments"><h3>' + say(1, 3) + "</h3>" + "".join(
            f'<div class="comment"><p>{say(5, 80)}</p></div>' for _ in range(rng.randint(1, 4))) + "</section>",
        lambda: f'<div class="related"><h3>{say(1, 3)}</h3><ul>{links}</ul></div>',
        lambda: f'<div class="share social"><ul>{links}</ul></div>',
    ])()


def variants(page: str, rng: random.Random, words: list[str]) -> list[tuple[str, str]]:
    """``(page, its main text's element marked)`` pairs: as it is, and with other
    markup. The mark is an attribute token that no feature reads."""
    where = _region(page)
    if where is None:
        return []
    a, b, c, d = where
    before, opened, body, after = page[:a], page[a:b], page[b:c], page[d:]
    out = [(before, opened, body, after)]
    if (cut := body.find("<p", body.find("<p") + 2)) > 0:   # main texts can be very short
        out.append((before, opened, body[:cut], after))
    for k in range(2):
        if k and cut > 0 and rng.random() < 0.5:
            body = body[:cut]
        name, attrs = rng.choice([("article", ""), ("main", ""), ("div", ' class="content"'),
                                  ("div", ' id="main-content"'), ("div", ' class="post-body"'),
                                  ("section", ' class="article"'), ("div", ' class="entry"')])
        lead = "".join(_boilerplate(rng, words) for _ in range(rng.randint(0, 3)))
        tail = "".join(_boilerplate(rng, words) for _ in range(rng.randint(0, 3)))
        inner = "".join(_boilerplate(rng, words) for _ in range(rng.randint(0, 2)))
        shell = rng.random() < 0.5
        inner_left = f"<div data-leave>{inner}</div>" if inner else ""
        out.append((before + ('<div class="page">' if shell else "") + lead, f"<{name}{attrs}>",
                    body + inner_left, tail + ("</div>" if shell else "") + after))
    made = []
    for before, opened, body, after in out:
        name = re.match(r"<(\w+)", opened)[1]
        tagged = opened[:-1] + ' class="zzmain">' if "class=" not in opened else \
            opened.replace('class="', 'class="zzmain ', 1)
        inner = body.replace("<div data-leave>", '<div class="zzleave">')
        made.append((before + tagged + inner + f"</{name}>" + after, opened))
    return made


def training_rows(pages: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(seed)
    words = sorted({w for p in pages for w in re.sub(r"<[^>]*>", " ", p).split()[:200]}) or ["x"]
    xs, ys = [], []
    for page in sorted(pages):
        for text, _ in variants(page, rng, words):
            root, blocks, _ = parse(text)
            x = features(root, blocks)
            label = {id(None): 0}
            y = []
            for n in blocks:
                up = label[id(n.parent)]
                label[id(n)] = 0 if "zzleave" in n.tokens else 1 if "zzmain" in n.tokens else up
                y.append(label[id(n)])
            xs.append(x)
            ys.append(np.array(y, float))
    if not xs:
        return np.zeros((0, 1)), np.zeros(0)
    return np.concatenate(xs), np.concatenate(ys)


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Trees:
    """Fits the trees to a bounded sample, drawn by a hash of the url; without a page
    whose main text is marked, nothing is taken for main text."""
    known = pages.where(F.col("html").isNotNull() & (F.char_length("html") <= SAMPLE_CHARS)
                        & F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    share = min(1.0, 4 * sample / max(1, known.count()))   # of the marked pages, however rare they are
    draw = F.pmod(F.xxhash64("page_id", F.coalesce("url", F.lit(""))), F.lit(1_000_000))
    drawn = (known.where(draw < int(1_000_000 * share) + 1)
             .orderBy(draw, "page_id").limit(sample).select("html"))
    x, y = training_rows([r["html"] for r in drawn.collect()])
    return fit_trees(x, y)


def extract(pages: DataFrame, trees: Trees) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row from its whole html.

    Null or empty html, and pages without main text, give an empty text. Broken markup
    never fails. Repeated rows are extracted each; other columns are ignored."""
    def make():
        pull = Extractor(trees)

        def work(texts):
            got = []
            for some in chunks(texts, 1_000_000):
                got += pull(some)
            return [got, [len(t) for t in got]]
        return work

    return map_texts(pages, make, "text string, n_chars bigint", keep=("page_id", "url"), text="html")
