"""Main text of web pages by wrapper induction.

A host's distinct pages are counted first (hashes only) and dealt by their hash to groups
of about ``GROUP`` to 2 x ``GROUP``, whatever the number of partitions; rows are shuffled
once, by (host, group). Of each page a tree of block elements is made, with runs of like siblings (paragraphs, menu items) as one repeated
node. Within a group every tree is aligned with a reference page by simple tree
matching: the largest common top-down mapping that keeps sibling order. Aligned nodes
whose text is the same on nearly all distinct pages are template; slots that vary are
content, unless their element or class says menu, footer, comments, advert and the like.
Reading a page and aligning two takes time in proportion to their size: see ``_tokens``,
``MAX_DEPTH`` and ``MAX_PAIRS``.

Inside an article element the alignment decides as well; only the title stays when it is
constant, and pages with one title vote once, so that copies of a page on one host do not
become template.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import checked_broadcast
from flowguard.session import checkpointed

GROUP = 24
PARTITION_BYTES = 16 << 20
MIN_PAGES = 5
CONSTANT_SHARE = 0.9
COPIES = 8
COPY_ROWS = 1000

# Fixed values of the HTML language: elements by role.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
          "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "head", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "object", "ol",
          "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "svg", "table", "tbody", "td",
          "tfoot", "th", "thead", "tr", "ul"}
_CLOSES_P = _BLOCK - {"button", "object", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "svg"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
_FENCE = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "body", "html"}

# What page furniture is called.
_FURNITURE_TAGS = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "svg", "object",
                   "search", "fieldset"}
_FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer",
    "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# Furniture that other people write or that leads to other articles: an article in it is not the page's.
_OTHERS_WORDS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "related", "recommended",
                 "sponsored", "ad", "ads", "advert", "advertisement"}
# Words that say what an element is, and words that make a name a state or a property of it.
_CONTENT_WORDS = {"content", "post", "article", "entry", "main", "story", "text", "page", "body"}
_STATE_WORDS = {"on", "off", "open", "closed", "enabled", "disabled", "active", "visible", "has", "with", "without", "no", "is"}
_NEVER_NAMED = {"html", "body", "main"}
_FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu"}
# Headings; and elements whose lines are prose, not cells or items that may be alike by chance.
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PROSE = {"p", "div", "section", "article", "main", "blockquote"}

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTED_END = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_ENDS = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in _RAW}
#: Block elements inside each other that become nodes; deeper ones only end blocks.
MAX_DEPTH = 150
#: Pairs of nodes that the alignment of two pages compares one by one.
MAX_PAIRS = 20_000
#: How far apart like siblings are sought beyond that.
WINDOW = 64


class Node:
    """A block element: ``items`` are texts (blocks) and child nodes in page order."""
    __slots__ = ("tag", "label", "items", "furniture", "header", "named", "others", "shape")

    def __init__(self, tag: str, label, furniture: bool, header: bool, named: int = 0, others: bool = False):
        self.tag, self.label, self.furniture, self.header, self.named = tag, label, furniture, header, named
        self.others = others
        self.items: list = []
        self.shape = 0

    def kids(self) -> list["Node"]:
        return [x for x in self.items if isinstance(x, Node)]


def _named(tag: str, names: list[str]) -> tuple[int, bool]:
    """What class and id names say: 2 if one of them is a furniture word, alone or as the first
    or last word of a compound (``comment-list``, ``site-footer``) and none says content; 1 if such a word is
    in some other place; 0. And whether the word is one of _OTHERS_WORDS. Names like
    ``has-sidebar`` or ``comments-open`` are properties of an element, not its kind."""
    if tag in _NEVER_NAMED:
        return 0, False
    firm = hint = others = content = False
    for name in names:
        words = re.findall(r"[a-z0-9]+", name)
        if not words:
            continue
        hits = [w for w in words if w in _FURNITURE_WORDS]
        if not hits:
            content |= words[0] in _CONTENT_WORDS
            continue
        hint = True
        ends = [w for w in (words[0], words[-1]) if w in _FURNITURE_WORDS]
        if ends and not any(w in _STATE_WORDS for w in words):
            firm = True
            others |= any(w in _OTHERS_WORDS for w in ends)
    if tag == "article":
        return (2, True) if firm and others and not content else (0, False)
    return (2 if firm and not content else 1 if hint else 0), others


def _element(tag: str, attrs: str) -> Node:
    names, role, hidden = "", "", False
    if attrs:
        found = {}
        for k, a, b, c in _ATTR.findall(attrs):
            found.setdefault(k.lower(), a or b or c)
        names = f"{found.get('class', '')} {found.get('id', '')}".lower().strip()
        role = found.get("role", "").lower()
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get(
            "style", "").replace(" ", "").lower()
    named, others = _named(tag, names.split()) if names else (0, False)
    furniture = tag in _FURNITURE_TAGS or role in _FURNITURE_ROLES or hidden
    label = (tag, re.sub(r"\d+", "0", names), role)
    return Node(tag, label, furniture, tag == "header" or (names == "header" and tag not in _NEVER_NAMED), named, others)


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes) and ("close", tag, "") in page order. Every
    character is looked at a bounded number of times: beyond the last ``>`` all is text, a
    comment or raw element that never ends takes the rest, and after a tag whose
    quotes never close, quotes protect no ``>`` any more."""
    at, end, last = 0, len(page), page.rfind(">")
    quotes = True
    while at < end:
        lt = page.find("<", at)
        if lt < 0 or lt > last:
            # a comment that never ends is none of the text
            cut = page.find("<!--", at)
            yield "text", page[at:cut if cut >= 0 else end], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        if page.startswith(("<!", "<?"), lt):
            at = page.find(">", lt) + 1
            continue
        m = _TAG.match(page, lt)
        if not m:
            yield "text", "<", ""
            at = lt + 1
            continue
        stop = _QUOTED_END.match(page, m.end()) if quotes else None
        quotes = stop is not None
        at = stop.end() if stop else page.find(">", m.end()) + 1
        tag = m.group(1).lower()
        if page[lt + 1] == "/":
            yield "close", tag, ""
            continue
        if tag in _RAW:
            found = _RAW_ENDS[tag].search(page, at)
            gt = page.find(">", found.end()) if found else -1
            at = gt + 1 if gt >= 0 else end
            continue
        yield "open", tag, page[m.end():at - 1]


def parse(page: str) -> Node:
    """Tree of block elements; inline elements are part of their block's text, a line
    break ends a block, and unclosed elements end where HTML says. Blocks inside more than
    MAX_DEPTH others belong to the last of these."""
    root = Node("html", ("html", "", ""), False, False)
    stack, text = [root], []
    opened: Counter = Counter()

    def flush() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line:
                stack[-1].items.append(line)

    def close(tags: set, fence: set) -> None:
        if not any(opened[t] for t in tags):
            return
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in tags:
                flush()
                opened.subtract(n.tag for n in stack[at:])
                del stack[at:]
                return
            if stack[at].tag in fence:
                return

    for kind, tag, rest in _tokens(page):
        if kind == "text":
            text.append(tag)
        elif kind == "close":
            if tag in _BLOCK:
                close({tag}, set())
            elif tag == "br":
                flush()
        elif tag in ("br", "hr"):
            flush()
        elif tag in _BLOCK:
            flush()
            if tag in ("html", "body") and opened[tag]:
                continue
            if tag in _CLOSES_P:
                close({"p"}, _FENCE)
            if tag in _CLOSES:
                close(_CLOSES[tag], _FENCE - {"div", "section"} if tag != "li" else {"ul", "ol"})
            node = _element(tag, rest)
            if len(stack) < MAX_DEPTH:
                stack[-1].items.append(node)
            else:
                node.items = stack[-1].items
            if not (rest.endswith("/") and tag in ("svg", "object")):
                stack.append(node)
                opened[tag] += 1
    flush()
    _fold(root)
    return root


def _fold(node: Node) -> None:
    """Runs of like children that hold text only become one repeated node; every node gets
    the hash of its skeleton."""
    out: list = []
    for x in node.items:
        if isinstance(x, Node):
            _fold(x)
            plain = all(isinstance(i, str) for i in x.items)
            last = out[-1] if out else None
            if plain:
                if isinstance(last, Node) and last.label == (*x.label, "*"):
                    last.items += x.items
                    continue
                x.label = (*x.label, "*")
                x.shape = hash((x.label, ()))
        out.append(x)
    node.items = out
    node.shape = hash((node.label, tuple(k.shape for k in node.kids())))


def simple_tree_matching(a: Node, b: Node, budget: list[int] | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Size and pairs of the largest top-down mapping of two trees that keeps the order
    of siblings and pairs equal labels only.

    Trees of one shape map node by node, and so do equal first and last children; only what
    is between is compared pair by pair, while that makes no more than MAX_PAIRS pairs for the
    whole page. Beyond, a child takes the next like sibling within WINDOW.
    """
    budget = [MAX_PAIRS] if budget is None else budget
    if a.label != b.label:
        return 0, []
    if a.shape == b.shape:
        pairs = list(zip(_walk(a), _walk(b)))
        return len(pairs), pairs
    ka, kb = a.kids(), b.kids()
    head = 0
    while head < min(len(ka), len(kb)) and ka[head].shape == kb[head].shape:
        head += 1
    tail = 0
    while tail < min(len(ka), len(kb)) - head and ka[-1 - tail].shape == kb[-1 - tail].shape:
        tail += 1
    pairs = [(a, b)]
    for x, y in [*zip(ka[:head], kb[:head]), *zip(ka[len(ka) - tail:], kb[len(kb) - tail:])]:
        pairs += zip(_walk(x), _walk(y))
    ka, kb = ka[head:len(ka) - tail], kb[head:len(kb) - tail]
    budget[0] -= len(ka) * len(kb)
    pairs += _in_order(ka, kb, budget) if budget[0] >= 0 else _nearby(ka, kb, budget)
    return len(pairs), pairs


def _in_order(ka: list[Node], kb: list[Node], budget: list[int]) -> list[tuple[Node, Node]]:
    """The pairs of the best order-keeping mapping of two lists of siblings."""
    best = [[(0, None)] * (len(kb) + 1) for _ in range(len(ka) + 1)]
    for i, x in enumerate(ka, 1):
        for j, y in enumerate(kb, 1):
            up, left = best[i - 1][j][0], best[i][j - 1][0]
            n, pairs = simple_tree_matching(x, y, budget)
            both = best[i - 1][j - 1][0] + n
            if n and both >= up and both >= left:
                best[i][j] = (both, pairs)
            else:
                best[i][j] = (up, "up") if up >= left else (left, "left")
    pairs, i, j = [], len(ka), len(kb)
    while i and j:
        step = best[i][j][1]
        if step == "up":
            i -= 1
        elif step == "left":
            j -= 1
        else:
            pairs += step or []
            i, j = i - 1, j - 1
    return pairs


def _nearby(ka: list[Node], kb: list[Node], budget: list[int]) -> list[tuple[Node, Node]]:
    """Pairs of very long lists: each child with the next of its shape, or else of its label."""
    pairs, at = [], 0
    for x in ka:
        ahead = range(at, min(len(kb), at + WINDOW))
        j = next((j for j in ahead if kb[j].shape == x.shape), next((j for j in ahead if kb[j].label == x.label), None))
        if j is not None:
            pairs += simple_tree_matching(x, kb[j], budget)[1]
            at = j + 1
    return pairs


def _walk(node: Node) -> Iterator[Node]:
    yield node
    for k in node.kids():
        yield from _walk(k)


def _own(node: Node) -> str:
    return "\n".join(x for x in node.items if isinstance(x, str))


def _texts(node: Node) -> str:
    return "\n".join(x if isinstance(x, str) else _texts(x) for x in node.items)


def _is_article(node: Node) -> bool:
    return (node.tag in ("article", "main") or node.label[2] == "main") and node.named < 2


def _inside(node: Node, inside: bool = False) -> Iterator[bool]:
    """In the order of _walk: whether a node lies in an article or main element."""
    inside = inside or _is_article(node)
    yield inside
    for k in node.kids():
        yield from _inside(k, inside)


def _title(region: Node) -> Node | None:
    """The first heading."""
    return next((n for n in _walk(region) if n.tag in _HEADINGS and _own(n)), None)


def _page_title(tree: Node) -> str:
    region = next((n for n in _walk(tree) if _is_article(n)), None)
    title = _title(region) if region else None
    return _own(title) if title else ""


def _most(votes: dict) -> str | None:
    """The value of nearly all of at least MIN_PAGES votes, if there is one."""
    if len(votes) < MIN_PAGES:
        return None
    value, n = Counter(votes.values()).most_common(1)[0]
    return value if value and n >= CONSTANT_SHARE * len(votes) else None


def template_nodes(trees: list[Node]) -> tuple[dict[int, set[str] | None], set[int]]:
    """The nodes that hold template, by id, aligned over the pages of a host: None if all of
    a node's own text is template, else the lines of it that are. And the ids of the
    nodes whose text varies.

    A slot is template if it is the same on nearly all of at least MIN_PAGES distinct
    pages. Inside an article pages with the same title have one vote (near copies of a
    page are no template) unless the host's pages have fewer than MIN_PAGES titles;
    with that many, a line that is on nearly all pages is template in a run of
    paragraphs that varies, too.
    """
    whole = [_texts(t) for t in trees]
    if len(set(whole)) < MIN_PAGES:
        return {}, set()
    shapes = [t.shape for t in trees]
    common = Counter(shapes).most_common(1)[0][0]
    reference = trees[shapes.index(common)]
    order = {id(n): i for i, n in enumerate(_walk(reference))}
    inside = list(_inside(reference))
    titled = [_page_title(t) or w for t, w in zip(trees, whole)]
    by_title = len(set(titled)) >= MIN_PAGES
    slots: list[dict] = [{} for _ in order]
    aligned: list[list[tuple[int, Node]]] = []
    for tree, shape, text, title in zip(trees, shapes, whole, titled):
        if shape == common:
            pairs = list(enumerate(_walk(tree)))
        else:
            pairs = [(order[id(r)], n) for r, n in simple_tree_matching(reference, tree)[1]]
        aligned.append(pairs)
        for i, n in pairs:
            slots[i].setdefault(title if inside[i] and by_title else text, _own(n))
    constant = {i: value for i, votes in enumerate(slots) if (value := _most(votes))}
    lines: dict[int, set[str]] = {}
    for (i, n), votes in zip(enumerate(_walk(reference)), slots):
        if i not in constant and inside[i] and by_title and n.tag in _PROSE and len(votes) >= MIN_PAGES:
            seen = Counter(line for own in votes.values() for line in set(own.split("\n")) if line)
            lines[i] = {line for line, k in seen.items() if k >= CONSTANT_SHARE * len(votes)}
    out: dict[int, set[str] | None] = {}
    varying: set[int] = set()
    for pairs in aligned:
        for i, n in pairs:
            if i in constant and _own(n) == constant[i]:
                out[id(n)] = None
                continue
            if i not in constant and len(slots[i]) >= MIN_PAGES and _own(n):
                varying.add(id(n))
            if lines.get(i):
                out[id(n)] = lines[i]
    return out, varying


def furniture_nodes(tree: Node, template: dict[int, set[str] | None], varying: set[int]) -> set[int]:
    """ids of the elements that are left out with all they hold.

    A firm name (see ``_named``) holds whatever the alignment says of the text: comments, adverts
    and teasers vary from page to page by nature. It does not hold for an element with an
    article in it, unless it names what others write (``comments``, ``related``). A weak name
    (``page-sidebar-wrap``) leaves it to the alignment: an element with text that varies stays, and so does one
    with half of the page's text or more. An article inside one with prose of its own is a
    comment. If a page has no other text, firmly named elements whose text varies stay, or that hold the
    only article.
    """
    out: set[int] = set()
    named: set[int] = set()
    doubtful: list[tuple[Node, int, bool]] = []

    def measure(node: Node, inner: list[tuple[int, int]] | None) -> tuple[int, bool, bool, bool]:
        """Characters that are not template, whether an article is inside, whether text varies,
        whether some of it is prose. ``inner`` takes the articles inside an article."""
        size, article, varies, prose = 0, _is_article(node), id(node) in varying, False
        skip = template.get(id(node), ())
        own: list[tuple[int, int]] | None = [] if node.tag == "article" else inner
        for x in node.items:
            if isinstance(x, str):
                if skip is not None and x not in skip:
                    size += len(x)
                    prose |= node.tag not in _HEADINGS
            else:
                n, a, v, p = measure(x, own)
                size, article, varies, prose = size + n, article or a, varies or v, prose or p and not x.header
        if node.tag == "article" and own and prose:
            out.update(i for i, _ in own)
            size -= sum(n for _, n in own)
        if node.furniture and not (article and node.tag in ("form", "fieldset")):
            out.add(id(node))
            return 0, False, False, False
        if node.named == 2 and (not article or node.others):
            out.add(id(node))
            if varies or article:
                named.add(id(node))
            return 0, False, varies, False
        if node.named and not article:
            doubtful.append((node, size, varies))
        if node.tag == "article" and inner is not None:
            inner.append((id(node), size))
            prose = False
        return size, article, varies, prose

    total = measure(tree, None)[0]
    if not total:
        out -= named
    out.update(id(n) for n, size, varies in doubtful if not varies and (not size or 2 * size < total))
    return out


def _find_articles(node: Node, tags: set, dropped: set[int], out: list) -> None:
    for k in node.kids():
        if id(k) in dropped:
            continue
        if k.tag in tags or (tags == {"main"} and k.label[2] == "main"):
            out.append(k)
        else:
            _find_articles(k, tags, dropped, out)


def main_text(tree: Node, template: dict[int, set[str] | None], varying: set[int]) -> str:
    """Blocks of the content regions that are neither furniture nor template: the
    articles with text of their own, else such main elements, else the page."""
    dropped = furniture_nodes(tree, template, varying)

    def take(node: Node, inside: bool, title: Node | None, blocks: list[str]) -> list[str]:
        skip = template.get(id(node), ()) if node is not title else ()
        for x in node.items:
            if isinstance(x, str):
                if skip is not None and x not in skip:
                    blocks.append(x)
            elif id(x) not in dropped and (inside or not x.header):
                take(x, inside, title, blocks)
        return blocks

    for tags in ({"article"}, {"main"}):
        found: list[Node] = []
        _find_articles(tree, tags, dropped, found)
        found = [n for n in found if take(n, True, None, [])]
        if found:
            return "\n".join(x for n in found for x in take(n, True, _title(n), []))
    return "\n".join(take(tree, False, None, []))


def extract_group(pages: list[str]) -> list[str]:
    """Texts of pages of one host."""
    trees = [parse(p) for p in pages]
    template, varying = template_nodes(trees) if len(trees) >= MIN_PAGES else ({}, set())
    return [main_text(t, template, varying) for t in trees]


def _groups(src: DataFrame, group: int, copies: int) -> tuple[DataFrame, int]:
    """``src`` (page_id, url, html, host, h) with ``bucket``, the group of a page inside its
    host, and ``salts``, which is null unless the page has more than ``copies`` copies;
    and the bytes of all pages.

    A host of n distinct pages has n // group buckets, dealt by the hash of the page, so
    the groups do not depend on partitions. A bucket with too few pages to align is
    added to its host's largest. Only hosts of two groups and more need an entry.
    """
    counts = checkpointed(src.groupBy("host", "h").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("html")).alias("b")))
    total = int(counts.select(F.sum(F.col("n") * F.col("b")).alias("b")).first()["b"] or 0)
    hosts = (counts.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= 2 * group)
             .select("host", F.floor(F.col("pages") / group).cast("long").alias("k")))
    dealt = (counts.select("host", F.col("h").alias("h")).join(checked_broadcast(hosts), "host")
             .groupBy("host", "k", F.pmod("h", F.col("k")).alias("bucket")).agg(F.count(F.lit(1)).alias("pages")))
    plan = dealt.groupBy("host", "k").agg(
        F.max_by("bucket", F.struct("pages", "bucket")).alias("largest"),
        F.collect_list(F.when(F.col("pages") < MIN_PAGES, F.col("bucket"))).alias("short"))
    hot = counts.where(F.col("n") > copies).select(
        "host", "h", F.ceil(F.col("n") / COPY_ROWS).cast("long").alias("salts"))
    out = src.join(checked_broadcast(plan), "host", "left").join(checked_broadcast(hot), ["host", "h"], "left")
    bucket = F.pmod("h", F.col("k"))
    bucket = F.when(F.col("k").isNull(), F.lit(0)).when(F.array_contains("short", bucket), F.col("largest")).otherwise(bucket)
    return out.withColumn("bucket", bucket.cast("long")).drop("k", "largest", "short"), total


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  group: int = GROUP, partition_bytes: int = PARTITION_BYTES, copies: int = COPIES) -> DataFrame:
    """``page_id``, ``url``, ``text`` (blocks joined by a line feed, empty if none) and
    ``n_chars`` (code points) of every row.

    Null html counts as empty. Pages without a host (null or relative url) are not
    aligned with others; neither are hosts with fewer than MIN_PAGES different pages:
    element and class names alone decide there. Copies of a page on a host are extracted
    once for a group, count as one page in the alignment and get the same text; of
    more than ``copies`` copies one goes to the group and its text is joined back.
    Only the three named columns are read. An empty table gives no rows.
    """
    url = F.col(url_col).cast("string")
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    src = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), page.alias("html"), host.alias("host"),
                       F.xxhash64(page).alias("h"))
    spark = pages.sparkSession
    rows, total = _groups(src, group, copies)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / partition_bytes))
    kind = pages.schema[id_col].dataType.simpleString()
    digest = F.sha2(F.concat_ws("\n", "host", "html"), 256)
    few = rows.where(F.col("salts").isNull()).select(
        "host", "bucket", "h", "page_id", "url", "html", F.lit(None).cast("string").alias("digest"))
    many = rows.where(F.col("salts").isNotNull()).withColumn("digest", digest)
    some = not many.limit(1).isEmpty()
    if some:
        ones = many.groupBy("host", "bucket", "h", "digest").agg(F.first("html").alias("html"))
        few = few.unionByName(ones.select(
            "host", "bucket", "h", F.lit(None).cast(kind).alias("page_id"), F.lit(None).cast("string").alias("url"),
            "html", "digest"))
    placed = few.repartition(parts, "host", "bucket").sortWithinPartitions("host", "bucket", "h")

    def extractor(repeated: bool):
        """Texts of the rows themselves, or of the pages that stand for many copies."""
        def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def done() -> pa.RecordBatch:
                wanted = [r for r in held if (r[3] is not None) == repeated]
                if not wanted:
                    texts = []
                elif key[0]:
                    texts = extract_group(list(distinct))
                else:
                    texts = [extract_group([p])[0] for p in distinct]
                out = [texts[r[2]] for r in wanted]
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in wanted], id_type), pa.array([r[1] for r in wanted], pa.string()),
                     pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()),
                     pa.array([r[3] for r in wanted], pa.string())],
                    ["page_id", "url", "text", "n_chars", "digest"])

            held: list[tuple] = []
            distinct: dict[str, int] = {}
            key = None
            for batch in batches:
                id_type = batch.schema.field("page_id").type
                for at in range(0, batch.num_rows, 4 * group):
                    part = batch.slice(at, 4 * group)
                    for h, b, i, u, p, d in zip(*[part.column(c).to_pylist() for c in (
                            "host", "bucket", "page_id", "url", "html", "digest")]):
                        if held and ((h, b) != key or not h and len(held) >= 2 * group):
                            yield done()
                            held, distinct = [], {}
                        key = (h, b)
                        held.append((i, u, distinct.setdefault(p, len(distinct)), d))
            if held:
                yield done()

        return extract

    schema = f"page_id {kind}, url string, text string, n_chars long, digest string"
    out = placed.mapInArrow(extractor(False), schema).drop("digest")
    if some:
        # a page's text is there once for every COPY_ROWS of its copies, so no task gets them all
        texts = placed.mapInArrow(extractor(True), schema).select("digest", "text", "n_chars")
        salts = many.groupBy("digest").agg(F.max("salts").alias("salts"))
        texts = texts.join(salts, "digest").select(
            "digest", "text", "n_chars", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        salt = F.pmod(F.xxhash64("page_id", "url", F.spark_partition_id()), F.col("salts"))
        back = many.select("page_id", "url", "digest", salt.alias("salt")).join(texts, ["digest", "salt"])
        out = out.unionByName(back.select("page_id", "url", "text", "n_chars"))
    return out
