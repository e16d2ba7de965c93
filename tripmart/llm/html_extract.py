"""Main text of web pages by tree scoring.

The page becomes a tree of blocks. Menus, forms, scripts, notices and other
furniture, known by tag, role or the words in class and id, are cut first.
Each paragraph then earns points for its length and commas, and passes them
to its ancestors: all to the parent, half to the grandparent, less and less
further up. A container's points are discounted by its link density. The best
container is kept, with its siblings that score well or read like prose, and
with the headings beside it; an article or main element that holds it is kept
whole.

Defined results: null, empty and text-free pages give an empty text; a page
without any container of score falls back to what the body holds; cut-off
markup ends where the page ends, a tag with an open quote at its first ``>``; of containers with equal
scores the first is best; very long and deeply nested pages are read whole, in time linear in their
length; repeated rows are handled one by one; an empty table gives no rows; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
CUT = frozenset("head nav footer aside form button select option template svg math object canvas audio video dialog menu figure map fieldset label input datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var ruby rb rt rp nobr wbr img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPES = frozenset("ul ol table div section article main body td blockquote".split())
PARAGRAPH = frozenset("p pre blockquote td li dd div section article main body".split())
ROLES_CUT = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words in class or id that mark furniture, and those that mark the article.
CUT_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|comments?|commentlist|comment\w*|disqus|respond|replies|reply|sidebars?|side-?bar|footers?|menus?|nav|navbar|navigation|navi"
    r"|breadcrumbs?|crumbs?|cookies?|cookie\w*|consent|gdpr|notices?|alerts?|popups?|modal\w*|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommend\w*|outbrain"
    r"|taboola|widgets?|toolbar|pager|pagination|tags?|tagcloud|masthead|skip\w*|hidden|shoutbox|trending|popular|teaser\w*|paywall|disclaimer|copyright|site-?header|page-?header|topbar|toplinks?|legal)(?:$|[\s_-])",
    re.I)
COMMENT_WORDS = re.compile(r"(?:^|[\s_-])(?:comments?|comment-\w+|repl(?:y|ies)|advert\w*|ads?|sponsor\w*|related|teaser\w*|promo\w*)(?:$|[\s_-])", re.I)
GOOD_WORDS = re.compile(r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|main|page|post|story|text|blog)(?:$|[\s_-])", re.I)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
HIDES = re.compile(r"hidden|style", re.I)
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "items", "cut", "words", "score", "own", "below", "deeper", "chars", "links", "prose")

    def __init__(self, tag: str, parent: "Node | None", cut: bool, words: str):
        self.tag, self.parent, self.cut, self.words = tag, parent, cut, words
        self.items: list = []  # text pieces (str, is in a link) and child nodes, in page order
        self.score = self.own = self.below = self.deeper = 0.0
        self.chars = self.links = self.prose = 0


def _attributes(token: str, tag: str) -> dict[str, str]:
    return {a.lower(): x or y or z or "" for a, x, y, z in ATTR.findall(token, len(tag) + 1)} if len(token) > len(tag) + 2 else {}


def _hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(HIDING.search(attrs.get("style", "")))


def _cut(tag: str, attrs: dict[str, str], inside_article: bool) -> bool:
    if tag in CUT or (tag == "header" and not inside_article):
        return True
    if _hidden(attrs):
        return True
    if attrs.get("role", "").lower() in ROLES_CUT:
        return True
    words = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return bool(COMMENT_WORDS.search(words))
    return len(words) > 1 and bool(CUT_WORDS.search(words)) and not (GOOD_WORDS.search(words) and tag in ("section", "div") and not COMMENT_WORDS.search(words))


def parse(html: str) -> Node:
    """The tree of a page's blocks; inline markup only tells whether text is in a link."""
    root = Node("html", None, False, "")
    at, link, articles = root, 0, 0
    pos, n = 0, len(html)
    open_tags = Counter()
    muted: list[tuple[str, Node]] = []  # hidden inline elements, and those of the same name within, with their blocks

    def close(node: Node) -> Node:
        nonlocal articles
        if node.tag in ("article", "main"):
            articles -= 1
        open_tags[node.tag] -= 1
        while muted and muted[-1][1] is node:
            muted.pop()
        return node.parent

    while pos < n:
        m = TOKEN.search(html, pos)
        stop = m.start() if m else n
        if stop > pos and not at.cut and not muted:
            at.items.append((html[pos:stop], link > 0))
        if not m:
            break
        pos = m.end()
        token = m.group()
        name = NAME.match(token)
        if not name:
            continue
        tag = name.group(1).lower()
        if token[1] == "/":
            if tag == "a":
                link = max(0, link - 1)
            if tag in INLINE:
                if muted and muted[-1] == (tag, at):
                    muted.pop()
                continue
            if tag == "br" or tag == "p" and not open_tags["p"]:
                at.items.append((" ", False))
                continue
            if open_tags[tag]:
                link = 0
                while at.tag != tag:
                    at = close(at)
                at = close(at) or root
            continue
        if not token.endswith(">"):
            break  # cut off within a tag
        if tag in INLINE and tag not in VOID:
            # few inline elements have an attribute that hides them; those within a hidden one are counted
            if muted and muted[-1] == (tag, at) or HIDES.search(token) and _hidden(_attributes(token, tag)):
                muted.append((tag, at))
            link = 1 if tag == "a" else link
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, pos)
            pos = end.end() if end else n
            continue
        if tag in ("br", "hr"):
            at.items.append((" ", False))
            continue
        if tag in INLINE or tag in ("html", "body") or tag in VOID and tag not in CUT:
            continue
        if tag in CLOSES_P and open_tags["p"] and (p := _open(at, "p", SCOPES)):
            while at is not p:
                at = close(at)
            at = close(at)
        if tag in CLOSES_SAME:
            same = next((t for t in CLOSES_SAME[tag] if open_tags[t] and _open(at, t, SCOPES - CLOSES_SAME[tag])), None)
            if same and tag != "p":
                while at.tag not in CLOSES_SAME[tag]:
                    at = close(at)
                at = close(at)
        if tag in VOID:
            continue
        attrs = _attributes(token, tag)
        node = Node(tag, at, at.cut or bool(muted) or _cut(tag, attrs, articles > 0), f"{attrs.get('class', '')} {attrs.get('id', '')}")
        if tag == "header" and articles:
            node.words += " inner-header"
        at.items.append(node)
        open_tags[tag] += 1
        at, link = node, 0
        if tag in ("article", "main"):
            articles += 1
        if token.endswith("/>") and tag in ("svg", "path"):
            at = close(at)
    return root


def _open(at: Node, tag: str, stop: frozenset = frozenset()) -> Node | None:
    while at is not None:
        if at.tag == tag:
            return at
        if at.tag in stop:
            return None
        at = at.parent
    return None


def _walk(root: Node) -> Iterator[Node]:
    """Kept nodes, parents before children; no recursion, as pages may nest deep."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [x for x in node.items if isinstance(x, Node) and not x.cut]


def score(root: Node) -> list[Node]:
    """Points of every container; the kept nodes, parents first."""
    nodes = list(_walk(root))
    for node in reversed(nodes):
        own = linked = commas = 0
        for x in node.items:
            if isinstance(x, Node):
                if not x.cut:
                    node.chars += x.chars
                    node.links += x.links
                    node.prose += x.prose
            else:
                size = len(x[0].strip())
                own += size
                linked += size if x[1] else 0
                commas += x[0].count(",")
        node.chars += own
        node.links += linked
        if own >= 25 and node.tag in PARAGRAPH:
            points = (1 + commas + min(own / 100, 10)) * (1 - linked / own)
            node.prose += own - linked
            up = node if node.tag in ("div", "section", "article", "main", "html") else node.parent
            up.own += points
    # points pass on once, bottom-up: all to the container, 1/2 to its parent, then 1/6, 1/9 and 2/3 of it each further up
    for node in reversed(nodes):
        node.score = node.own + node.below / 2 + node.deeper
        if node.parent is not None:
            node.parent.below += node.own
            node.parent.deeper += node.below / 6 + node.deeper * 2 / 3
    for node in nodes:
        bonus = 25 if node.tag in ("article", "main") else 5 if node.tag in ("div", "section") and GOOD_WORDS.search(node.words) else 0
        if node.score > 0:
            node.score = (node.score + bonus) * (1 - node.links / max(1, node.chars))
    return nodes


def best_parts(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    nodes = [x for x in score(root) if x.score > 0 and x.tag not in ("p", "pre", "li", "td", "dd", "tr", "ul", "ol", "dl")]
    if not nodes:
        articles = [x for x in _walk(root) if x.tag in ("article", "main")]
        return articles[:1] or [root]
    best = max(nodes, key=lambda x: x.score)
    up = best.parent
    while up is not None:  # the article that holds it, whole
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    if best.parent is None or best.tag in ("article", "main") and not any(x.tag == best.tag for x in best.parent.items if isinstance(x, Node) and x is not best):
        return [best]
    least = max(10.0, 0.2 * best.score)
    kept = []
    for x in best.parent.items:
        if not isinstance(x, Node) or x.cut:
            continue
        density = x.links / max(1, x.chars)
        prose = x.tag == "p" and (x.chars > 80 and density < 0.25 or 0 < x.chars <= 80 and density == 0)
        if x is best or x.score >= least or prose or x.tag in HEADINGS:
            kept.append(x)
    return kept


def text_of(parts: list[Node]) -> str:
    """Blocks in page order, joined by one space; references decoded, white space folded."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        if run:
            blocks.append(WHITE.sub(" ", entities.unescape("".join(run))).strip())
            run.clear()

    stack: list = list(reversed(parts))
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, Node):
            end()
            if x.cut:
                continue
            items = x.items
            if x.words.endswith(" inner-header"):
                items = [y for y in items if isinstance(y, Node) and (y.tag in HEADINGS or y.tag in ("hgroup", "div"))]
            stack.append(None)
            stack += reversed(items)
        else:
            run.append(x[0])
    end()
    return " ".join(b for b in blocks if b)


def extract(html: str | None) -> str:
    return text_of(best_parts(parse(html))) if html else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per page of pages (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(h) for h in b.column("html").to_pylist()]
            yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    df = pages.select("page_id", pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    kind = df.schema["page_id"].dataType.simpleString()
    return df.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
