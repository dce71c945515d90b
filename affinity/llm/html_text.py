"""Main-text extraction by scoring the containers of a page.

A page becomes a light tree of block elements. Every paragraph gives points
for its length and its commas to its parent and, halved, to its grandparent; a
container's points are discounted by the share of its text that is in links.
The best container and its siblings are kept, from the first to the last that
is article text, without those that are mostly links; their text is read block
by block.

Elements that are never article text (scripts, styles, navigation, page headers
and footers, asides) are not entered. Forms, and containers whose class, id or
role names them as menus, adverts, notices, sidebars or reader comments, are
left out only if the points of the page's paragraphs agree: never if they hold
most of them (but reader comments beside an article), and forms and layout
names only with a small share or many links. A section with a heading whose id
is such a word (``discussion``) is left out only if it is mostly links.

Defined results: a null or empty page, or one without text outside such
elements, gives an empty text; a truncated page is read as far as it goes,
open elements ending with it; every row has a result, repeated rows alike;
other columns pass through, ``text`` and ``n_chars`` are replaced if present.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import ship_code

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template head title nav footer aside button select textarea option "
                 "iframe object svg math canvas audio video dialog menu".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
ENDS_P = BLOCK - {"caption", "legend"}
# kinds of elements that an opening tag closes, and what bounds the search for them
SCOPES = {"p": ({"p"}, {"td", "th", "table", "button", "article", "body"}), "li": ({"li"}, {"ul", "ol"}),
          "term": ({"dt", "dd"}, {"dl"}), "row": ({"tr", "td", "th"}, {"table"}), "cell": ({"td", "th"}, {"tr", "table"}),
          "own": ({"article", "main"}, set())}
SCOPED = frozenset().union(*(tags | bound for tags, bound in SCOPES.values()))
CLOSES = {"li": "li", "dt": "term", "dd": "term", "tr": "row", "td": "cell", "th": "cell"}
# words that name a container which is a menu, header, footer, sidebar, notice, advert, form or reader comments
BOILER = re.compile(
    r"ads?|ad(?:slot|box|unit|space)s?|advert(?:s|isement|isements|ising|orial)?|adsense|banners?|sponsor(?:s|ed)?|promos?|sidenav|"
    r"widgets?|nav|navbar|navigation|topnav|menus?|menubar|breadcrumbs?|pagination|pager|toolbar|comments?|commentlist|disqus|respond|"
    r"replies|reply|discussion|share|sharing|social|related|recommend(?:ed|ations?)?|newsletter|subscribe|subscription|signup|login|"
    r"search|cookies?|consent|gdpr|popup|modal|overlay|paywall|notices?|notifications?|alerts?|warning|masthead|footer|header|"
    r"copyright|skip", re.I)
# parts that may stand beside such a word without changing what it names: places, kinds of boxes, whose they are
BESIDE = re.compile(
    r"\d+|[a-z]|area|bar|block|body|bottom|box|btn|button|buttons|col|column|container|content|first|fixed|form|global|group|holder|home|icons?|"
    r"inner|item|items|js|last|left|links?|list|main|mobile|module|outer|page|pane|panel|policy|post|posts|primary|reader|readers|right|"
    r"secondary|section|site|sticky|story|stories|top|user|users|view|widget|wrap|wrapper|zone|to|us|by|media|email|article|articles|print", re.I)
# layout words name a container only as its whole name, as the last part, or before a place
LAYOUT = re.compile(r"(?:^|\s)(?!(?:no|not|without|with|has)[-_])(?:[^\s]*[-_])?(sidebar|sidebars|side|rail|hidden)"
                    r"(?:(?<!hidden)[-_](?:left|right|top|bottom|primary|secondary|inner|\d+))*(?=$|\s)", re.I)
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
# what a section of an article may be about
TOPIC = re.compile(r"discussion|related|recommend\w*|search|social|shar(?:e|ing)|notices?|notification\w*|warning|alert|"
                   r"copyright|subscription|advert\w*|nav\w*|sponsor\w*", re.I)
FORM, SIDE, NAMED, READERS, SECTION = range(1, 6)  # kinds of containers that their points decide on
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
BOILER_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar "
                        "alertdialog status toolbar note".split())
STRONG = re.compile(r"(?:^|[-_\s])(?:article|post|entry|content|main|story|body|text)(?:$|[-_\s])", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CUT_TAG = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")  # a tag that the end of the page cuts off
NEVER_NAMED = frozenset("html body main h1 h2 h3 h4 h5 h6 b i em strong a".split())
OWN = frozenset("div section article main body html center blockquote".split())  # score the text directly in them
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLANK = re.compile(r"\s+")


def _boiler_words(names: str) -> set[str]:
    """Of each name, the words that say it is boilerplate: where every part of
    the name is such a word or stands beside one. ``share-price`` or
    ``search-results`` name something else."""
    out = set()
    for name in names.split():
        parts = [x for x in re.split(r"[-_]+", name) if x]
        words = [x.lower() for x in parts if BOILER.fullmatch(x)]
        if words and all(BOILER.fullmatch(x) or BESIDE.fullmatch(x) for x in parts):
            out.update(words)
    return out


class Node:
    __slots__ = ("near", "tag", "parent", "kids", "skip", "points", "chars", "linked", "strong", "kind", "prose", "start", "end")

    def __init__(self, tag: str, parent: "Node | None", skip: bool = False, strong: bool = False, kind: int = 0):
        self.tag, self.parent, self.skip, self.strong, self.kind = tag, parent, skip, strong, kind
        self.kids: list[Node | str] = []
        self.points = self.prose = 0.0
        self.chars = self.linked = self.start = self.end = 0
        # the nearest open element of each kind that another tag may close, within its bounds
        self.near: dict[str, Node] = parent.near if parent is not None else {}
        if tag in SCOPED:
            self.near = {k: n for k, n in self.near.items() if tag not in SCOPES[k][1]}
            self.near.update((k, self) for k, (tags, _) in SCOPES.items() if tag in tags)


def _skipped(tag: str, attrs: list[tuple[str, str | None]], parent: Node) -> bool:
    """Whether the element is left out. A header within an article holds its title."""
    if tag in SKIP:
        return True
    if tag == "header" and "own" not in parent.near:
        return True
    return any(key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value or "")
               for key, value in attrs)


def _kind(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """What the element's tag, role and names say that it is; 0 is nothing."""
    kinds = {FORM} if tag == "form" else set()
    section = tag == "section" or any(k == "class" and "section" in (v or "").lower().split() for k, v in attrs)
    for key, value in attrs:
        value = value or ""
        if key == "role" and value.lower() in BOILER_ROLE:
            kinds.add(FORM if value.lower() == "form" else NAMED)
        if key in ("class", "id") and tag not in NEVER_NAMED:
            value = CAMEL.sub("-", value)
            words = _boiler_words(value)
            if STRONG.search(value) or tag in ("article", "header"):
                words.discard("header")  # an article's own header holds its title
            if words & COMMENTS:
                kinds.add(READERS)
            elif words:
                kinds.add(SECTION if section and key == "id" and all(map(TOPIC.fullmatch, words)) else NAMED)
            if LAYOUT.search(value):
                kinds.add(SIDE)
    for kind in (READERS, NAMED, SIDE, FORM, SECTION):
        if kind in kinds:
            return kind
    return 0


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.open = Counter()  # elements from the root to ``at``, by tag

    def _leave(self, node: Node) -> None:
        """Close everything up to and including ``node``."""
        while True:
            left, self.at = self.at, self.at.parent
            self.open[left.tag] -= 1
            if left is node:
                return

    def _close(self, kind: str) -> None:
        while kind in self.at.near:
            self._leave(self.at.near[kind])

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._close("p")
        if tag in CLOSES:
            self._close(CLOSES[tag])
        if tag == "br":
            self.at.kids.append(" ")
        if tag in VOID:
            if tag == "hr":
                self.at.kids.append(Node("hr", self.at))
            return
        named = any(k in ("class", "id", "itemprop") and v and STRONG.search(v) for k, v in attrs)
        node = Node(tag, self.at, _skipped(tag, attrs, self.at), tag in ("article", "main") or named, _kind(tag, attrs))
        self.at.kids.append(node)
        self.at = node
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        node = self.at
        while node is not self.root and node.tag != tag:
            # an inline end tag never closes the block around it
            if node.tag in BLOCK and tag not in BLOCK and tag not in SKIP:
                return
            node = node.parent
        if node is not self.root:
            self._leave(node)

    def handle_data(self, data):
        self.at.kids.append(data)


def _kept(root: Node) -> list[Node]:
    """Every kept element, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node) and not k.skip)
    return order


def _measure(root: Node) -> list[Node]:
    """Characters and linked characters of every kept element, bottom up; returns them in page order."""
    order = _kept(root)
    for node in reversed(order):
        own = sum(len(BLANK.sub(" ", k).strip()) for k in node.kids if isinstance(k, str))
        node.chars += own
        node.linked = node.chars if node.tag == "a" else node.linked
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    return order


def _paragraphs(order: list[Node]):
    """(element, points) of everything that counts as a paragraph."""
    for node in order:
        if node.tag not in ("p", "pre", "td", "li", "dd", "h1", "h2", "h3") and not (
                node.tag in OWN and any(
                    isinstance(k, str) and k.strip() for k in node.kids)):
            continue
        text = "".join(_inline(node))
        if not text.strip():
            continue
        yield node, 1 + text.count(",") + min(len(text) / 100, 3)


def _within(node: Node, box: Node) -> bool:
    return box.start <= node.start < box.end


def _leave_out(root: Node) -> None:
    """Mark the forms and named containers that their share of the page's
    paragraph points, links not counted, shows to be no article text."""
    order = _measure(root)
    if not any(n.kind for n in order):
        return
    for node, points in _paragraphs(order):
        node.prose += points * (1 - _density(node))
    for i, node in enumerate(order):  # page order: a subtree is a range
        node.start, node.end = i, i + 1
    for node in reversed(order):
        if node.parent is not None:
            node.parent.prose += node.prose
            node.parent.end = max(node.parent.end, node.end)
    total, strong = root.prose, [n for n in order if n.strong]
    readers = [n.start for n in order if n.kind == READERS]
    stack = [root]
    while stack:
        node = stack.pop()
        if node.kind:
            most = node.prose > 0.5 * total
            if node.kind == SECTION:
                titled = any(isinstance(k, Node) and k.tag in HEADINGS for k in node.kids)
                replies = bisect_left(readers, node.start) < bisect_left(readers, node.end)
                node.skip = not most and (_density(node) >= 0.25 or not titled or replies)
            elif node.kind == READERS and most:
                # an article beside them, or around them
                node.skip = any(not _within(n, node) and n.prose - node.prose * _within(node, n) >= 2 for n in strong)
            elif node.kind in (READERS, NAMED):
                node.skip = not most
            else:
                node.skip = not most and (node.prose < 10 or node.prose <= 0.25 * total or _density(node) >= 0.25)
        if not node.skip:
            stack.extend(k for k in node.kids if isinstance(k, Node) and not k.skip)
    for node in order:
        node.chars = node.linked = 0


def _give_points(order: list[Node]) -> None:
    for node, points in _paragraphs(order):
        own = node.tag in OWN
        up = node if own else node.parent
        for share in (1.0, 0.5):
            if up is not None:
                up.points += points * share
                up = up.parent


def _inline(node: Node):
    """Text of an element without its block descendants."""
    stack = node.kids[::-1]
    while stack:
        k = stack.pop()
        if isinstance(k, str):
            yield k
        elif not k.skip and k.tag not in BLOCK:
            stack.extend(reversed(k.kids))


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _score(node: Node) -> float:
    return (node.points + 25 * node.strong) * (1 - _density(node))


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Append the text pieces of each block; ``out[-1]`` is the open block."""
    stack: list = [node]
    while stack:
        k = stack.pop()
        if k is None:
            out.append([])
        elif isinstance(k, str):
            out[-1].append(k)
        elif not k.skip:
            if k.tag in BLOCK:
                out.append([])
                stack.append(None)
            stack.extend(reversed(k.kids))


PLAIN = frozenset("p pre ul ol dl table figure details".split())
CONTAINERS = frozenset("article main section div body html td center blockquote".split())


def _siblings(best: Node) -> list[Node | str]:
    """The best container and what beside it is article text. At the ends: lists,
    paragraphs, titles, tables and the like and containers of paragraphs, with
    few links, and containers that score near the best. Between these, all that
    is not mostly links; a run of inline text counts as one block."""
    limit = max(10.0, 0.2 * _score(best))
    runs: list[list[Node | str]] = []
    loose = False
    for k in best.parent.kids:
        inline = isinstance(k, str) or k.tag not in BLOCK and k is not best
        if isinstance(k, Node) and k.skip:
            loose = False
        elif inline and loose:
            runs[-1].append(k)
        else:
            runs.append([k])
            loose = inline
    few, ends = [], []
    for i, run in enumerate(runs):
        k = run[0]
        if isinstance(k, str) or k.tag not in BLOCK and k is not best:
            chars = sum(len(x.strip()) if isinstance(x, str) else x.chars for x in run)
            few.append(chars > 0 and sum(x.linked for x in run if isinstance(x, Node)) < 0.25 * chars)
            continue
        few.append(k.chars > 0 and _density(k) < 0.25 or k is best)
        title = k.tag in HEADINGS and (k.linked == 0 or best.parent.tag not in ("body", "html"))
        if k is best or k.tag in CONTAINERS and _score(k) >= limit or few[i] and (
                k.tag in PLAIN or title or k.tag in CONTAINERS and _has_paragraphs(k)):
            ends.append(i)
    near = [k.tag in CONTAINERS and _score(k) >= limit if isinstance(k := run[0], Node) else False for run in runs]
    return [k for i in range(ends[0], ends[-1] + 1) if few[i] or near[i] for k in runs[i]]


def _has_paragraphs(box: Node) -> bool:
    """Two paragraphs, or a title and one, of some length: an own part of the article."""
    long = titles = 0
    for node in _kept(box):
        long += node.tag in ("p", "pre", "blockquote", "li", "dd") and len("".join(_inline(node)).strip()) >= 40
        titles += node.tag in HEADINGS
    return long >= 2 or long == 1 and (titles > 0 or box.tag == "blockquote")


def main_text(html: str | None) -> str:
    """The article text of one page, one line per block."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(CUT_TAG.sub("", html))
    builder.close()
    _leave_out(builder.root)
    order = _measure(builder.root)
    _give_points(order)
    boxes = [n for n in order if n.tag in CONTAINERS and n.chars]
    if not boxes:
        return ""
    best = up = max(boxes, key=_score)  # the first of equals
    while up is not None:  # an article element around the best container is the article
        best, up = up if up.tag == "article" else best, up.parent
    kept = [best]
    if best.parent is not None and best.tag not in ("article", "main"):
        kept = _siblings(best)
    elif best.parent is not None and best.tag == "article":
        kept = [k for k in best.parent.kids if k is best or isinstance(k, Node) and not k.skip and k.tag == "article" and k.strong
                and _score(k) >= 0.2 * _score(best)]
    lines: list[list[str]] = [[]]
    for k in kept:
        if isinstance(k, str):
            lines[-1].append(k)
        else:
            _blocks(k, lines)
            if k.tag in BLOCK or k is best:
                lines.append([])
    joined = (BLANK.sub(" ", "".join(x)).strip() for x in lines)
    return "\n".join(x for x in joined if x)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points)."""

    @F.pandas_udf("string")
    def read(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h if isinstance(h, str) else None) for h in html], dtype=object)

    ship_code(pages.sparkSession)
    plain = [F.col(c) for c in pages.columns if c not in ("text", "n_chars")]
    out = pages.select(*plain, read(F.col(html_col)).alias("__text"))
    return out.select(*[c for c in pages.columns if c not in ("text", "n_chars")], F.col("__text").alias("text"),
                      F.char_length("__text").cast("long").alias("n_chars"))
