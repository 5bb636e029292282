"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded over the tree.

A page is parsed into its element tree (standard-library tokenizer, implied end tags).
Every element gets features of its subtree (text, density of tags, links, marks and
paragraphs), of its attribute tokens and tag, of those of its ancestors, its depth and
its siblings. Boosted trees (numpy) give the probabilities that an element is wholly
main text, wholly boilerplate, or mixed. Decoding finds the most probable assignment in
which all descendants of a main element are main and those of a boilerplate element are
boilerplate, by one pass up and one down the tree: no contradictory choices remain.

The trees learn from layouts with known main text: ``layouts`` generated pages whose
texts are drawn from the paragraphs of at most ``sample`` pages of the table (least hash
of their key). Scripts, styles, templates, the head and form controls never give text; a head
or control that was left open ends at the first tag (of a head: or text) that it cannot
hold. Text in noscript, svg, object and math is left to the trees.

Output text: character references decoded, a run of white space is one space, blocks
joined by one space in page order. Null or empty html gives the empty string. Whole
pages are read, however long. Repeated rows are extracted alike and all returned; columns
other than those named are not read; an empty table gives no rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import bounded_sample, strings

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template head title textarea select option button iframe datalist".split())
#: What may stand in a head; any other tag, and any text, ends a head that is open.
IN_HEAD = frozenset("html head base link meta title script style template noscript".split())
CONTROLS = frozenset("button select option textarea datalist iframe".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption label option".split())
ENDS_CONTROL = BLOCK - {"br", "hr", "label", "legend", "option"}
ENDS_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "label", "legend", "option"}
SIBLING_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
                "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Tags with a feature of their own.
TAGS = ["article", "main", "section", "div", "p", "ul", "ol", "li", "a", "nav", "header", "footer", "aside", "form", "h1", "h2", "h3",
        "table", "td", "blockquote", "pre", "figure", "span", "b", "body", "label", "address", "details"]
#: Groups of attribute tokens, by the starts of the tokens.
GROUPS = [("nav", "menu", "breadcrumb", "toolbar", "pagination", "pager", "tabs"), ("header", "masthead", "top", "logo", "branding"),
          ("foot", "copyright", "legal", "colophon"), ("side", "aside", "rail", "widget", "complementary"),
          ("ad", "ads", "advert", "sponsor", "promo", "banner", "dfp", "commercial"), ("cookie", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "warning", "dialog"),
          ("form", "login", "signup", "subscribe", "newsletter", "search", "contact"), ("comment", "reply", "replies", "disqus", "discussion", "respond", "review"),
          ("share", "social", "related", "recommend", "more", "tags", "popular", "trending"), ("content", "main", "page", "primary"),
          ("article", "post", "entry", "story", "blog", "news"), ("body", "text", "copy", "prose", "paragraph"), ("title", "headline", "heading")]
EXACT = {"ad", "ads", "top", "more", "text", "page", "tags", "tabs", "post", "body", "copy", "main", "rail"}
FEATURES = 24 + 2 * len(GROUPS) + 2 * len(TAGS)
MAIN, PLAIN, MIXED = range(3)


def token_groups(value: str) -> int:
    """Bits of the groups that the tokens of an attribute value belong to."""
    bits = 0
    for token in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
        for g, starts in enumerate(GROUPS):
            if any(token == s or (s not in EXACT and token.startswith(s)) for s in starts):
                bits |= 1 << g
    return bits


class Tree(HTMLParser):
    """Elements of a page in order of their starts, with the texts between them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.end, self.depth = ["#"], [-1], [0], [0]
        self.groups, self.place, self.children = [0], [0], [0]
        self.over_tags, self.over_groups = [0], [0]
        self.stack, self.silent, self.open_head = [0], 0, False
        self.parts: list[tuple[int, str]] = []  # (element, text); (-1, "") between blocks
        self.seen: dict[str, int] = {}

    def _pop(self, to: int) -> None:
        for node in self.stack[to:]:
            self.end[node] = len(self.tag)
            if self.tag[node] in SILENT:
                self.silent -= 1
            if self.tag[node] == "head":
                self.open_head = False
            if self.tag[node] in BLOCK:
                self.parts.append((-1, ""))
        del self.stack[to:]

    def _close(self, names, stop=()) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[k]]
            if name in names:
                self._pop(k)
                return
            if name in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._close(("p",), ("table", "td", "li", "div", "article", "section", "body", "button"))
        if tag in SIBLING_ENDS:
            self._close(*SIBLING_ENDS[tag])
        if tag not in IN_HEAD and self.open_head:
            self._end_head()
        if self.silent and tag in ENDS_CONTROL and self.tag[self.stack[-1]] in CONTROLS:
            self._end_controls()
        up = self.stack[-1]
        bits = 0
        for name, value in attrs:
            if value and name in ("class", "id", "role", "itemprop", "aria-label"):
                if value not in self.seen:
                    self.seen[value] = token_groups(value)
                bits |= self.seen[value]
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.groups.append(bits)
        self.place.append(self.children[up])
        self.children[up] += 1
        self.children.append(0)
        self.over_groups.append(self.over_groups[up] | self.groups[up])
        self.over_tags.append(self.over_tags[up] | 1 << TAG_AT.get(self.tag[up], len(TAGS)))
        self.end.append(node + 1)
        if tag in BLOCK:
            self.parts.append((-1, ""))
        if tag not in VOID:
            self.stack.append(node)
            self.silent += tag in SILENT
            self.open_head = self.open_head or tag == "head"

    def _end_head(self) -> None:
        """A head ends where something stands that it cannot hold, templates apart."""
        names = [self.tag[k] for k in self.stack]
        if "template" not in names[names.index("head"):]:
            self._close(("head",))

    def _end_controls(self) -> None:
        """A block cannot stand in a form control: one that was left open ends here."""
        k = len(self.stack) - 1
        while self.tag[self.stack[k - 1]] in CONTROLS:
            k -= 1
        self._pop(k)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close((tag,))

    def handle_data(self, data):
        if self.open_head and self.tag[self.stack[-1]] in ("head", "noscript") and data.strip():
            self._end_head()
        if not self.silent:
            self.parts.append((self.stack[-1], data))

    def finish(self) -> Tree:
        self.close()
        self._pop(0)
        return self


TAG_AT = {t: k for k, t in enumerate(TAGS)}


def parse(html: str) -> Tree:
    tree = Tree()
    tree.feed(html)
    return tree.finish()


def features(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(a row of features per element, characters of text per subtree)."""
    n = len(tree.tag)
    end, parent, depth = np.array(tree.end), np.array(tree.parent), np.array(tree.depth)
    own, marks, words, stops = (np.zeros(n) for _ in range(4))
    for node, text in tree.parts:
        if node >= 0 and text:
            own[node] += len(text) - text.count(" ")
            words[node] += text.count(" ")
            marks[node] += text.count(",") + text.count(".")
            stops[node] += text.count("|") + text.count("©") + text.count("»")
    tags = np.array([TAG_AT.get(t, len(TAGS)) for t in tree.tag])
    over_tags, groups, over_groups = (np.array(x, np.int64) for x in (tree.over_tags, tree.groups, tree.over_groups))
    in_link = (tags == TAG_AT["a"]) | (over_tags >> TAG_AT["a"] & 1).astype(bool)

    def below(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(x)])
        return total[end] - total[np.arange(n)]

    chars, link, mark, word, stop = below(own), below(own * in_link), below(marks), below(words), below(stops)
    elements = below(np.ones(n))
    paras = below((tags == TAG_AT["p"]).astype(float))
    items = below((tags == TAG_AT["li"]).astype(float))
    fields = below(np.isin(np.array(tree.tag), ["input", "select", "textarea", "button", "label"]).astype(float))
    whole = max(chars[0], 1.0)
    before = np.concatenate([[0.0], np.cumsum(own)])[:-1]
    up = np.maximum(parent, 0)
    count = np.maximum(np.array(tree.children)[up], 1)
    # siblings: next starts where this one ends, if the parent still holds it
    nxt = np.where((end < end[up]) & (end < n), np.minimum(end, n - 1), 0)
    prev = np.zeros(n, np.int64)
    has = np.flatnonzero(nxt > 0)
    prev[nxt[has]] = has
    safe = np.maximum(chars, 1)
    base = [np.log1p(chars), chars / whole, link / safe, mark / safe, word / safe, np.log1p(elements), np.log1p(safe / elements), stop / safe,
            np.log1p(paras), np.log1p(items), np.log1p(fields), own / safe, depth, np.array(tree.place), np.array(tree.place) / count, np.log1p(count),
            before / whole, (before + chars) / whole, chars / np.maximum(chars[up], 1), np.where(prev > 0, np.log1p(chars[prev]), -1), np.where(nxt > 0, np.log1p(chars[nxt]), -1),
            np.where(nxt > 0, (link / safe)[nxt], -1), (tags[prev] == tags) * (prev > 0) + (tags[nxt] == tags) * (nxt > 0), np.array(tree.children)]
    bits = lambda x, m: (x[:, None] >> np.arange(m) & 1)
    return np.column_stack([np.column_stack(base), bits(groups, len(GROUPS)), bits(over_groups, len(GROUPS)),
                            tags[:, None] == np.arange(len(TAGS)), bits(over_tags, len(TAGS))]).astype(np.float32), chars


@dataclass
class Boosted:
    """Trees of fixed depth over binned features; one tree per class and round."""
    cuts: list[np.ndarray]
    feature: np.ndarray  # tree, inner place
    cut: np.ndarray
    leaf: np.ndarray  # tree, leaf

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)]).astype(np.uint8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self.bins(x), np.arange(len(x))
        out = np.zeros((len(x), 3))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(self.leaf.shape[1]))):
                at = 2 * at + 1 + (binned[rows, self.feature[t, at]] > self.cut[t, at])
            out[:, t % 3] += self.leaf[t, at - self.feature.shape[1]]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 4, rate: float = 0.25, bins: int = 16, seed: int = 1) -> Boosted:
    """Softmax boosting with second-order leaf values; each tree sees half of the features."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    model = Boosted(cuts, np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth)))
    binned = model.bins(x).astype(np.int64)
    n, width = x.shape
    score, goal = np.zeros((n, 3)), np.eye(3)[y]
    trees = []
    for _ in range(rounds):
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for c in range(3):
            g, h = p[:, c] - goal[:, c], np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
            some = [k for k in rng.choice(width, (width + 1) // 2, replace=False).tolist() if len(cuts[k])]
            feature, cut, at = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, bins), np.zeros(n, np.int64)
            for level in range(depth):
                first, nodes = 2 ** level - 1, 2 ** level
                place = (at - first) * bins
                best = np.full(nodes, 1e-6)
                for k in some:
                    slot = place + binned[:, k]
                    gs = np.bincount(slot, g, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                    hs = np.bincount(slot, h, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                    j = gain.argmax(axis=1)
                    top = gain[np.arange(nodes), j]
                    better = np.flatnonzero(top > best)
                    best[better] = top[better]
                    feature[first + better], cut[first + better] = k, j[better]
                at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > cut[at])
            leaf_at = at - (2 ** depth - 1)
            leaf = -rate * np.bincount(leaf_at, g, 2 ** depth) / (np.bincount(leaf_at, h, 2 ** depth) + 1)
            score[:, c] += leaf[leaf_at]
            trees.append((feature, cut, leaf))
    model.feature, model.cut, model.leaf = (np.array([t[k] for t in trees]) for k in range(3))
    return model


def decode(tree: Tree, logs: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """True per element whose own text is main, for the most probable consistent assignment."""
    n = len(tree.tag)
    logs = np.where((chars > 0)[:, None], logs, 0.0)  # elements without text have no say
    main, plain, mixed = logs[:, MAIN].tolist(), logs[:, PLAIN].tolist(), logs[:, MIXED].tolist()
    parent = tree.parent
    for k in range(n - 1, 0, -1):
        up = parent[k]
        main[up] += main[k]
        plain[up] += plain[k]
        mixed[up] += max(main[k], plain[k], mixed[k] if tree.children[k] else main[k])
    state = [MIXED] * n
    for k in range(n):
        over = state[parent[k]] if k else MIXED
        if over != MIXED:
            state[k] = over
        elif tree.children[k] and mixed[k] >= max(main[k], plain[k]):
            state[k] = MIXED
        else:
            state[k] = MAIN if main[k] >= plain[k] else PLAIN
    return np.array([s == MAIN or s == MIXED and logs[k, MAIN] > logs[k, PLAIN] for k, s in enumerate(state)])


def log_probabilities(model: Boosted, x: np.ndarray) -> np.ndarray:
    z = model.scores(x)
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def main_text(tree: Tree, chosen: np.ndarray) -> str:
    return " ".join("".join(" " if node < 0 else text if chosen[node] else "" for node, text in tree.parts).split())


# --- layouts with known main text, for training ---

MARK = ""  # starts every piece of main text in a layout


def layout(rng: np.random.Generator, paragraphs: list[str]) -> str:
    """A page of random layout; its main texts start with MARK."""
    pick = lambda xs: xs[rng.integers(len(xs))]
    chance = lambda p: rng.random() < p
    many = lambda a, b, f: "".join(f() for _ in range(rng.integers(a, b + 1)))

    def words(a, b):
        w = pick(paragraphs).split() or ["a"]
        at = rng.integers(len(w))
        return " ".join((w[at:] + w[:at])[:rng.integers(a, b + 1)])

    def sentence():
        return words(5, 25) + pick([".", ".", "!", "?"])

    def attrs(names):
        name = pick(names)
        extra = pick(["", "", " clearfix", " col-md-4", " row", f" x{rng.integers(99)}"])
        return f' {pick(["class", "class", "id"])}="{name}{extra}"'

    def box(tags, names, body, plain=0.3):
        tag = pick(tags)
        named = attrs(names) if tag in ("div", "section", "ul", "span") and not chance(plain * 0.3) or chance(1 - plain) else ""
        return f"<{tag}{named}>{body}</{tag}>"

    def links(a, b):
        return "<ul>" + many(a, b, lambda: f'<li><a href="/{rng.integers(999)}">{words(1, 3)}</a></li>') + "</ul>" if chance(0.7) else many(
            a, b, lambda: f'<a href="#">{words(1, 3)}</a> {pick(["", "| ", "» "])}')

    def para():
        text = pick(paragraphs) if chance(0.8) else sentence()
        if chance(0.15):
            text = f'{text} <a href="#">{MARK}{words(1, 4)}</a> {MARK}{words(2, 9)}'
        if chance(0.2):
            text = f"<b>{MARK}{text}" + pick(["</b>", "", "<br>"])
        return f"<p>{MARK}{text}" + pick(["</p>", "</p>", "</p>", ""])

    ad = lambda: box(["div", "div", "aside", "span"], ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner", "advertisement"],
                     pick([sentence(), f"<p>{sentence()}</p>", words(1, 5), f'<a href="#">{words(2, 8)}</a>']), 0)
    share = lambda: box(["div"], ["share", "social-links", "related", "related-posts", "tags"], links(2, 5), 0)

    def heading(level, marked=MARK):
        return f"<h{level}>{marked}{words(2, 10)}</h{level}>"

    def piece():
        kind = rng.random()
        if kind < 0.72:
            return para()
        if kind < 0.8:
            return heading(pick([2, 3]))
        if kind < 0.86:
            return f"<ul>{many(1, 5, lambda: f'<li>{MARK}{sentence()}</li>')}</ul>"
        if kind < 0.9:
            return f"<blockquote>{pick([para(), MARK + sentence()])}</blockquote>"
        if kind < 0.92:
            return f"<table><tr>{many(1, 4, lambda: f'<td>{MARK}{words(1, 5)}</td>')}</tr></table>"
        if kind < 0.94:
            return f"<figure><figcaption>{MARK}{sentence()}</figcaption></figure>"
        return pick([ad, share])() if chance(0.5) else f"<div>{MARK}{sentence()}</div>"

    def article():
        body = (heading(pick([1, 1, 2])) if chance(0.8) else "") + many(1, pick([1, 3, 8, 20]), piece)
        if chance(0.12):  # boilerplate inside the article
            body += pick([comments, form, notice, footer, share, side])()
        if chance(0.3):
            body = f"<div{attrs(['body', 'article-body', 'entry-content', 'text', 'post-content', 'prose'])}>{body}</div>"
        tag = pick(["article", "article", "article", "main", "div", "div", "section", ""])
        if not tag:
            return body
        named = "" if tag in ("article", "main") and chance(0.7) else attrs(
            ["content", "main-content", "post", "article", "entry", "story", "page-content", "blog-post", "main", "container", f"c{rng.integers(99)}"])
        body = f"<{tag}{named}>{body}</{tag}>"
        return f"<main>{body}</main>" if tag == "article" and chance(0.2) else body

    def comment():
        return box(["div", "li", "article"], ["comment", "comment-item", "reply", "comment-body"],
                   f"<b>{words(1, 2)}</b> " + many(1, 2, lambda: pick([f"<p>{sentence()}</p>", sentence(), f"<p>{pick(paragraphs)}</p>"])), 0.1)

    comments = lambda: box(["section", "div", "ol"], ["comments", "comment-list", "discussion", "replies", "reader-comments", "disqus_thread"],
                           (heading(3, "") if chance(0.6) else "") + many(1, 6, comment), 0.05)
    nav = lambda: box(["nav", "nav", "div", "ul"], ["nav", "menu", "main-menu", "navbar", "breadcrumbs", "top-nav"], links(2, 9))
    header = lambda: box(["header", "header", "div"], ["header", "site-header", "masthead", "top-bar"],
                         pick([heading(1, ""), f'<a href="/">{words(1, 3)}</a>', f"<p>{sentence()}</p>", f"<div>{words(1, 4)}</div>"]) + (nav() if chance(0.4) else ""))
    notice = lambda: box(["div", "div", "section", "aside"], ["cookie-notice", "cookies", "consent", "gdpr", "alert", "notice", "popup", "modal"],
                         many(1, 2, lambda: f"<p>{sentence()}</p>" if chance(0.6) else sentence()) + pick(["", "<button>OK</button>", f'<a href="#">{words(1, 2)}</a>']), 0)
    form = lambda: f"<form{pick(['', attrs(['search', 'newsletter', 'login', 'subscribe', 'contact-form'])])}>" + many(
        1, 4, lambda: f'<label>{words(1, 3)}</label><input name="a">') + pick(["", f"<p>{sentence()}</p>"]) + "<button>Go</button></form>"
    side = lambda: box(["aside", "aside", "div"], ["sidebar", "side", "widget", "related", "right-rail", "popular"],
                       (heading(3, "") if chance(0.5) else "") + pick([links(2, 7), many(1, 3, lambda: f"<p>{sentence()}</p>"), f"<p>{pick(paragraphs)}</p>", ad()]), 0.15)
    footer = lambda: box(["footer", "footer", "div"], ["footer", "site-footer", "copyright", "legal", "bottom-links footer"],
                         pick(["&copy; ", "", "© "]) + pick([sentence(), words(1, 6) + " &middot; " + sentence(), links(1, 6), f"<p>{sentence()}</p>" + links(1, 4)]), 0.2)
    style = "<style>p{margin:0}</style>" if chance(0.5) else ""
    top = [f() for f, p in ((notice, 0.2), (header, 0.4), (nav, 0.6), (ad, 0.35), (form, 0.15), (side, 0.15)) if chance(p)]
    rng.shuffle(top)
    tail = [f() for f, p in ((share, 0.2), (comments, 0.35), (form, 0.2), (side, 0.35), (ad, 0.2), (nav, 0.1)) if chance(p)]
    rng.shuffle(tail)
    inner = article() + "".join(tail)
    if chance(0.3):
        inner = f"<div{attrs(['wrapper', 'container', 'row', 'layout'])}>{inner}</div>"
    last = (footer() if chance(0.75) else "") + (notice() if chance(0.15) else "")
    return f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title>{style}</head><body>{''.join(top)}{inner}{last}<script>var a='<p>';</script>" + pick(["</body></html>", ""])


def labelled(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(class per element, its characters) of a parsed layout."""
    n = len(tree.tag)
    own, good = np.zeros(n), np.zeros(n)
    for node, text in tree.parts:
        if node >= 0:
            size = len(text) - text.count(" ") - text.count(MARK)
            own[node] += size
            good[node] += size * (MARK in text)
    end = np.array(tree.end)
    total = [np.concatenate([[0.0], np.cumsum(x)]) for x in (own, good)]
    chars, main = (t[end] - t[np.arange(n)] for t in total)
    share = main / np.maximum(chars, 1)
    return np.where(share > 0.999, MAIN, np.where(share < 0.001, PLAIN, MIXED)), chars


def train(paragraphs: list[str], layouts: int, seed: int = 11) -> Boosted:
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for _ in range(layouts):
        tree = parse(layout(rng, paragraphs))
        y, chars = labelled(tree)
        tree.parts = [(node, text.replace(MARK, "")) for node, text in tree.parts]
        x, _ = features(tree)
        some = chars > 0
        xs.append(x[some])
        ys.append(y[some])
    return boost(np.concatenate(xs), np.concatenate(ys))


def sample_paragraphs(pages: DataFrame, id_col: str, html_col: str, sample: int) -> list[str]:
    """Block texts of a bounded sample of pages (at most ``sample``, of at most 100,000
    characters each; a text is cut after 1,200); they fill the layouts."""
    short = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).filter("length(html) BETWEEN 1 AND 100000")
    rows = bounded_sample(short, F.xxhash64("id", "html"), sample).collect()
    out = []
    for r in rows:
        tree, block = parse(r["html"]), []
        for node, text in [*tree.parts, (-1, "")]:
            if node >= 0:
                block.append(text)
            elif block:
                out.append(" ".join("".join(block).split())[:1200])
                block = []
    out = sorted(t for t in set(out) if len(t) > 40)
    return out or ["a quick look at the day, and more of the same. some words follow here, as they do."]


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",),
            sample: int = 100, layouts: int = 700) -> DataFrame:
    """(id_col, *keep, text string, n_chars long) for every row of ``pages``."""
    model = train(sample_paragraphs(pages, id_col, html_col, sample), layouts)
    # plain values: a broadcast is pickled by reference, and executors may lack this package
    shared = pages.sparkSession.sparkContext.broadcast((model.cuts, model.feature, model.cut, model.leaf))
    kept = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Boosted(*shared.value)
        for batch in batches:
            texts: list[str] = []
            htmls = strings(batch.column(len(kept)))
            for k in range(0, len(htmls), 100):
                trees = [parse(h) for h in htmls[k:k + 100]]
                made = [features(t) for t in trees]
                logs = log_probabilities(model, np.concatenate([x for x, _ in made]))
                at = 0
                for tree, (x, chars) in zip(trees, made, strict=True):
                    texts.append(main_text(tree, decode(tree, logs[at:at + len(x)], chars)))
                    at += len(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*kept, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)
    return pages.select(*kept, F.col(html_col).cast("string").alias("html")).mapInArrow(run, f"{kinds}, text string, n_chars long")
