"""Main text of web pages by composite text density.

A page is parsed into a tree of elements (unclosed and stray tags as browsers
take them, where text is concerned). Parts that say what they are - menus,
headers, footers, sidebars, notices, adverts, forms, scripts, reader comments
- are taken out by tag, role, class or id, at any length. A class or id alone
does not take out the only part with a title, a main or an article with a
heading, nor the largest part if all else on the page is links and headings.
Words that have other meanings too (notice, share, banner) count alone or with
words of layout only: a "notice-period" is no notice. The same holds for forms, dialogs and objects. A form around most paragraphs,
or around headings and most of the text, only loses its controls and labels.
For every remaining node the
link-adjusted density is its characters per tag, scaled by the logarithm of
how far characters and tags are not links; the node whose children's densities
have the largest sum is where the article is. Parts beside the path from it to
the body belong to it if they are at least as dense as the least dense node of
that path (the body, as a rule). The choice is lifted to the node that holds
them all: of an <article> or <main> all is taken, of another node what lies
from the first to the last such part, headings above and paragraphs below
included, blocks of links between them left out. A choice inside an <article>
is always lifted to it; what is not an <article> and stands beside one must be
as dense as every node of the path.

All text of the chosen nodes is kept, whole, one line per block: character
references decoded, white space (that of str.split) turned into one space.

Defined results: a null, empty or textless page gives the empty string; text
outside any element counts as the body's; a tag cut off by the end of the page
is no text; repeated rows and null ids are ordinary; other columns are ignored.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A quote only opens a value after an equals sign; anywhere else, an unquoted
# value included, it is a character like others.
_NAME = r"(?:=|[^\s/>=])[^\s/>=]*+"
_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)?+"""
TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[\s/]++|{_NAME}(?:{_VALUE})?+)*+)>
    |<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S | re.X)
ATTR = re.compile(rf"""(?P<name>{_NAME})
    (?:\s*+=\s*+(?:"(?P<a>[^"]*+)"|'(?P<b>[^']*+)'|(?!["'])(?P<c>[^\s>]++))?+)?+""", re.X)

# Elements of the HTML standard, by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label "
                   "mark q s samp small span strike strong sub sup time tt u var wbr br math semantics maction "
                   "menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms "
                   "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
                     "table ul".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
# Parts that are not the article, by tag, role, and words of class or id.
OUT_TAGS = frozenset("nav footer aside button select menu embed canvas head".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary menu menubar".split())
# Parts that may be around the article, looked into before they go.
FORM_TAGS = frozenset("form fieldset".split())
FORM_ROLES = frozenset("form search".split())
BOX_TAGS = frozenset("dialog object".split())
BOX_ROLES = frozenset("alert alertdialog dialog".split())
CONTROLS = frozenset("label legend option optgroup datalist output".split())
FIELDS = frozenset("input select textarea button label".split())
# Words of a class or id. The first kind says it in any compound; the second
# only alone or with words of layout, since "notice-period" is no notice.
OUT_WORDS = frozenset(
    "advert adverts advertisement advertising advertisements breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter pagination popup "
    "sidebar sponsor sponsored toolbar".split())
OUT_MAYBE = frozenset(
    "ad ads banner header notice notices pager promo promoted recommended related respond share sharing social "
    "subscribe widget".split())
LAYOUT_WORDS = frozenset(
    "area articles bar block bottom box btn button buttons center col column container content fixed form group "
    "holder home icon icons inner item items label large layout left link links list main media mobile module outer "
    "overlay page panel post posts primary right row secondary section side site slot small stories sticky strip "
    "text title top unit widget widgets wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
FLOW = HEADINGS | frozenset("p ul ol dl pre blockquote figure hr".split())
# Words of a layout that only say whether such a part is on the page.
LAYOUT = re.compile(r"(?<![^\s_-])(?:has|with|without|no)[_-][\w-]*")
KEEP_TAGS = frozenset("html body main article".split())


def _says_out(names: str) -> bool:
    """Whether a class or id names a part that is not the article."""
    for name in LAYOUT.sub("", names).split():
        words = [w for w in re.split(r"[_-]+", name) if w and not w.isdigit()]
        if any(w in OUT_WORDS for w in words):
            return True
        if any(w in OUT_MAYBE for w in words) and all(w in OUT_MAYBE or w in LAYOUT_WORDS for w in words):
            return True
    return False


E = math.e


class Node:
    __slots__ = ("tag", "parent", "kids", "out", "own", "chars", "tags", "link_chars", "link_tags",
                 "density", "total", "core", "form", "field", "text", "para")

    def __init__(self, tag, parent):
        self.tag, self.parent, self.kids, self.out, self.own = tag, parent, [], 0, 0
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.core = 0  # it holds 3: a main or an article with a heading; 2: a title; 1: a heading
        self.form = self.field = False
        self.text = self.para = 0  # characters but links and controls, and in paragraphs


def _marked(tag: str, attrs: str, inside: bool) -> int:
    """2: not the article by tag or role, 4: a box, 3: a form, 1: by class or
    id, 0: none of these."""
    if tag in OUT_TAGS or (tag == "header" and not inside):
        return 2
    if tag in KEEP_TAGS:
        return 0
    mark = 3 if tag in FORM_TAGS else 4 if tag in BOX_TAGS else 0
    seen = set()
    for m in ATTR.finditer(attrs):
        name, value = m["name"].lower(), (m["a"] or m["b"] or m["c"] or "").lower()
        if name in seen:  # the first of two attributes counts
            continue
        seen.add(name)
        role = value.strip() if name == "role" else ""
        if role in OUT_ROLES or name == "hidden" or \
                name == "aria-hidden" and value == "true" or \
                name == "style" and "display:none" in value.replace(" ", ""):
            return 2
        if role in FORM_ROLES:
            mark = mark or 3
        elif role in BOX_ROLES:
            mark = 4
        elif name in ("class", "id") and _says_out(value):
            mark = mark if mark == 4 else 1
    return mark


def parse(page: str) -> Node:
    """The tree of a page; texts are strings among ``kids``."""
    root = Node("body", None)
    stack, at, open_ = [root], 0, Counter()

    def close(i: int) -> None:
        """Takes element i of the stack and all it holds off it."""
        open_.subtract(n.tag for n in stack[i:])
        del stack[i:]

    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            top = stack[-1]
            top.kids.append(text)
            top.own += len("".join(text.split()))  # characters other than white space
        if not m:
            return root
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, attrs = tag.lower(), m["attrs"] or m["attrs2"] or ""
        if m["end"] or m["end2"]:
            if tag in ("html", "body") or tag in VOID and tag != "br" or open_[tag] <= 0:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        if tag in RAW:
            if not attrs.endswith("/") or tag != "svg":
                end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P and open_["p"] > 0:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        elif tag in SIBLINGS:
            same, scope = SIBLINGS[tag]
            for i in range(len(stack) - 1, 0, -1) if any(open_[t] > 0 for t in same) else ():
                if stack[i].tag in same:
                    close(i)
                    break
                if stack[i].tag in scope:
                    break
        if tag == "head":
            continue
        node = Node(tag, stack[-1])
        node.out = _marked(tag, attrs, open_["article"] > 0 or open_["main"] > 0)
        stack[-1].kids.append(node)
        if tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
            open_[tag] += 1


def _order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(k for k in n.kids if not isinstance(k, str))
    return out


def _prune(root: Node) -> None:
    """Takes out marked parts by what remains without them."""
    nodes = _order(root)
    if not any(n.out for n in nodes):
        return
    for n in nodes:
        n.form = n.out == 3 or n.tag in FORM_TAGS or n.parent is not None and n.parent.form
        gone = {id(k) for k in n.kids if not isinstance(k, str)
                and (k.out == 2 or n.form and k.tag in CONTROLS)}
        n.field = any(id(k) in gone and k.tag in FIELDS for k in n.kids) or n.tag in FIELDS
        n.kids = [k for k in n.kids if id(k) not in gone]
    nodes = _order(root)
    for n in reversed(nodes):
        n.chars += n.own
        # reader comments are articles too, but without a heading
        if n.chars and (n.tag == "main" or n.tag == "article" and n.core):
            n.core = 3
        elif n.chars and n.tag in HEADINGS and n.tag != "header":
            n.core = max(n.core, 2 if n.tag == "h1" else 1)
        n.text = 0 if n.tag == "a" else n.text + n.own
        if n.tag == "p":
            n.para = 0 if n.field else n.text
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.core = max(n.parent.core, n.core)
            n.parent.field |= n.field
            if n.out not in (1, 4):
                n.parent.text += n.text
                n.parent.para += n.para
    chars, core, marked = 0, False, []

    def around(n: Node) -> bool:
        """A form around most paragraphs, or around headings and most text."""
        return n.out == 3 and (2 * n.para > root.para or n.core > 0 and 2 * n.text > root.text)

    def open_up(part: Node) -> list[Node]:
        """Counts what is outside the marked parts of ``part``, which are returned."""
        nonlocal chars, core
        part.out, todo, found = 0, [(part, False, True)], []
        while todo:
            n, title, plain = todo.pop()
            if n.out and not around(n):
                found.append(n)
                continue
            n.out = 0
            title = title or n.tag in ("main", "h1") or n.tag == "article" and n.core > 1
            plain = plain and n.tag != "a" and n.tag not in HEADINGS
            core = core or title and n.own > 0
            chars += n.own * plain
            todo.extend((k, title, plain) for k in n.kids if not isinstance(k, str))
        return found

    # marked parts around the only title or article are wrappers of it
    new = open_up(root)
    while new:
        sole, wrappers = not core, []
        for n in new:
            (wrappers if sole and n.core > (2 if n.out == 4 else 1) else marked).append(n)
        new = [k for n in wrappers for k in open_up(n)]
    # if all else is links and headings, the largest marked part is not taken out
    heap = [(-n.chars, i, n) for i, n in enumerate(marked)]
    heapq.heapify(heap)
    while not chars and heap and heap[0][2].chars:
        for n in open_up(heapq.heappop(heap)[2]):
            heapq.heappush(heap, (-n.chars, len(marked), n))
            marked.append(n)
    for n in nodes:
        n.kids = [k for k in n.kids if isinstance(k, str) or not k.out]


def _measure(nodes: list[Node]) -> None:
    for n in nodes:
        n.chars, n.tags, n.link_chars, n.link_tags, n.total = n.own, 0, 0, 0, float(n.own)
    for n in reversed(nodes):
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.tags + 1
        up = n.parent
        if up is not None:
            up.chars += n.chars
            up.tags += n.tags + 1
            up.link_chars += n.link_chars
            up.link_tags += n.link_tags
    share = nodes[0].link_chars / max(1, nodes[0].chars)
    for n in nodes:
        c, t = n.chars, max(1, n.tags)
        if not c:
            n.density = 0.0
            continue
        lc, lt, plain = max(1, n.link_chars), max(1, n.link_tags), max(1, c - n.link_chars)
        # the logarithm's base is at least e, so pages without links stay finite
        base = E - 1 + math.log(c / plain * n.link_chars + share * c + E)
        n.density = c / t * math.log(c / lc * t / lt + 1) / math.log(base)
        if n.parent is not None:
            n.parent.total += n.density


def _flow(k) -> bool:
    """Text, a heading, a paragraph or a list that is not mostly links."""
    if isinstance(k, str):
        return True
    return (k.tag in FLOW or k.tag in INLINE) and 2 * k.link_chars <= k.chars


def _chosen(nodes: list[Node]) -> list:
    # a block of text is not split: only nodes that hold blocks are compared
    holders = {id(n.parent): n.parent for n in nodes[1:] if n.tag not in INLINE}
    best = max(holders.values(), key=lambda n: n.total, default=nodes[0])
    path, n = [], best
    while n is not None:
        path.append(n)
        n = n.parent
    threshold, most, dense = min(n.density for n in path), max(n.density for n in path), set()
    article = False
    for n, parent in zip(path, path[1:]):
        article |= n.tag == "article"
        dense |= {id(k) for k in parent.kids if not isinstance(k, str) and k.tag not in INLINE
                  and k.density >= (most if article and k.tag != "article" else threshold) > 0}
    # the highest node with a dense part beside the path, or the article around the choice
    top, article = 0, path[0].tag == "article"
    for i in range(1, len(path)):
        beside = any(id(k) in dense and k is not path[i - 1] for k in path[i].kids)
        if beside or path[i].tag == "article" and not article:
            top = i
        article |= path[i].tag == "article"
    if path[top].tag in ("article", "main"):
        return [path[top]]
    # nothing beside the choice: only a heading may still stand above it
    alone = top == 0
    if alone and len(path) > 1:
        top = 1
    if top == 0:
        return [best]
    kids = path[top].kids
    at = [i for i, k in enumerate(kids) if k is path[top - 1] or not alone and id(k) in dense]
    first, last = at[0], at[-1]
    for i in range(first - 1, -1, -1):
        if not _flow(kids[i]):
            break
        if not isinstance(kids[i], str) and kids[i].tag in HEADINGS:
            first = i
    while not alone and path[top].parent is not None and last + 1 < len(kids) \
            and _flow(kids[last + 1]):
        last += 1
    # between two parts only what is mostly links is no part of the article
    return [k for i, k in enumerate(kids[first:last + 1], first) if i in at or isinstance(k, str)
            or 2 * k.link_chars <= k.chars]


def _blocks(node: Node) -> list[str]:
    lines, run = [], []

    def flush():
        line = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if line:
            lines.append(line)

    todo: list = [node]
    while todo:
        k = todo.pop()
        if k is None:
            flush()
        elif isinstance(k, str):
            run.append(k)
        elif k.tag == "br":
            run.append(" ")
        else:
            if k.tag not in INLINE:
                flush()
                todo.append(None)
            todo.extend(reversed(k.kids))
    flush()
    return lines


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    nodes = _order(root)
    _measure(nodes)
    chosen = _chosen(nodes)
    whole = Node("body", None)
    whole.kids = chosen
    return "\n".join(_blocks(whole))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            b = batch.slice(lo, 256)
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html") \
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
