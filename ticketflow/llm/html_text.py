"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text.  A logistic classifier gives each block the
costs of calling it content or boilerplate; they become capacities to the two
terminals.  Neighbours on the page, and blocks that follow each other in the
same container, are tied by smoothness edges that are the stronger the closer
they stand in the page's tree.  The minimum cut of that graph is the labelling
of least total cost; the blocks on the content side, in page order, are the text.

The classifier is trained in numpy, from fixed starting weights that also
regularise it, on the blocks of a bounded sample of the pages themselves: inside
and outside of the elements whose names say what they hold.  Half of the
training blocks have those names hidden, so that links, length, punctuation and how
many of the page's words stand together with a block carry pages that have none.

Defined results: a null or empty html gives an empty text; repeated rows are
extracted each; unclosed and stray tags are tolerated; a page of any length is
read whole; an empty table gives no rows; columns that are not named are ignored.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, strings

# Element names by their role.
_RAW = frozenset("script style noscript template svg iframe object canvas select title audio video".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
_BOILER_TAGS = frozenset("nav footer aside form menu dialog button head fieldset label search".split())
_ENDS_P = _BLOCK - {"body", "html", "head"}

# Whole parts of class and id names.
#: What an element itself is, also an article; ...
_BOILER_ITSELF = frozenset(
    "comment comments commenting commenter commentlist commentform advert adverts advertise advertisement advertisements "
    "advertising advertorial sponsor sponsors sponsored promo promos promoted promotion promotions promotional related "
    "relatedposts relatedarticles recommended recommendation recommendations teaser teasers outbrain taboola disqus".split())
#: ... and what outweighs neither an article or main element nor a content name.
_BOILER_NAMES = frozenset(
    "sidebar sidebars nav navs navbar navigation navlist navmenu sidenav subnav topnav foot footer footers cookie cookies "
    "cookiebar cookiebanner cookieconsent consent subscribe subscriber subscribers subscription subscriptions newsletter "
    "newsletters recommend share shares sharing sharebar sharebuttons sharethis sharedaddy social socials socialmedia "
    "socialbar sociallinks breadcrumb breadcrumbs menu menus menubar menuitem widget widgets popup popups modal modals overlay "
    "overlays disclaimer disclaimers copyright copyrights masthead banner banners login signup signin paginate pagination "
    "paginator toolbar toolbars respond responses discuss discussion discussions notice notices notification notifications "
    "alert alerts gdpr trending skip skiplink skiplinks topbar dropdown dropdowns".split())
_BOILER_WORDS = frozenset("ad ads adv side aside reply replies tags meta byline feedback form search more top".split())
_CONTENT_WORDS = frozenset("article content main post entry story body text maincontent prose".split())
_HIDDEN_NAMES = frozenset(("hidden", "is-hidden", "visually-hidden"))
#: A name with one of these parts tells of what is around or inside, as in has-sidebar or comments-open.
_ABOUT = frozenset("has have with without no open closed".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _mark(name: str, attrs: str, inside_article: bool) -> int:
    """1 content, -1 boilerplate, 0 nothing said."""
    if name == "header":
        return 0 if inside_article else -1
    if name in _BOILER_TAGS:
        return -1
    said = 1 if name in ("article", "main") else 0
    if attrs and name not in ("body", "html"):
        names = []
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key == "hidden" and value.lower() != "until-found" or key == "aria-hidden" and value == "true" or \
                    key == "style" and "display:none" in value.replace(" ", "").lower():
                return -1
            if key == "role":
                if value in ("main", "article"):
                    said = 1
                elif value in ("navigation", "banner", "complementary", "contentinfo", "search", "form", "alert", "dialog",
                               "alertdialog", "menu", "menubar"):
                    return -1
            elif key in ("class", "id"):
                names += value.split()
        boiler = content = False
        for one in names:
            if one.lower() in _HIDDEN_NAMES:
                return -1
            parts = {p.lower() for p in _NAME_PART.findall(one)}
            if parts & _ABOUT:
                continue
            if parts & _BOILER_ITSELF:
                return -1
            if parts & _BOILER_NAMES:
                boiler = True
            elif parts & _CONTENT_WORDS:
                content = True
            elif parts & _BOILER_WORDS or not inside_article and parts & {"header", "head"}:
                boiler = True
                if name == "article" and parts & {"ad", "ads", "adv", "reply", "replies"}:
                    return -1
        if content:
            said = 1
        if boiler and not said:
            return -1
    return said


class Holder:
    """A block element, by its parent; the root of a page has none."""
    __slots__ = ("name", "parent", "depth")

    def __init__(self, name, parent):
        self.name, self.parent, self.depth = name, parent, parent.depth + 1 if parent else 0


class Block:
    """A text, its linked characters, the block element around it, what names say (1, -1, 0), and whether
    it is inside an article element."""
    __slots__ = ("text", "linked", "holder", "mark", "article")

    def __init__(self, text, linked, holder, mark, article):
        self.text, self.linked, self.holder, self.mark, self.article = text, linked, holder, mark, article


def blocks(html: str) -> list[Block]:
    """Blocks with a text, in page order.  Linear: an open element knows the mark and the block element
    that hold at it, and the places of open elements are kept by name, so nothing walks the stack."""
    out: list[Block] = []
    root = Holder("", None)
    # open elements: (name, mark in force, block element in force, place of the latter in the stack)
    stack: list[tuple[str, int, Holder, int]] = [("", 0, root, 0)]
    places: dict[str, list[int]] = {}
    parts: list[str] = []
    linked = 0

    def close():
        nonlocal linked
        if not parts:
            return
        text = " ".join("".join(parts).split())
        if text:
            _, mark, holder, _ = stack[-1]
            out.append(Block(text, min(linked, len(text)), holder, mark, bool(places.get("article"))))
        parts.clear()
        linked = 0

    def pop(to: int):
        while len(stack) > to:
            places[stack.pop()[0]].pop()

    def last(name: str) -> int:
        """Place of the innermost open element of that name, 0 if none is."""
        return places[name][-1] if places.get(name) else 0

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at:
            piece = unescape(html[at:stop])
            parts.append(piece)
            if places.get("a"):
                linked += len(" ".join(piece.split()))
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        closing = m["end"] or m["end2"]
        if closing:
            i = last(name)
            if name in _BLOCK:
                if i or name == "p":
                    close()
                if i:
                    pop(i)
            elif i > stack[-1][3]:  # an inline element ends within its block only
                pop(i)
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if (name in _RAW or name == "textarea") and not attrs.endswith("/"):
            e = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            parts.append(f" {unescape(html[at:e.start() if e else end])} " if name == "textarea" else " ")
            at = e.end() if e else end
            continue
        if name == "br" or name in _VOID:
            if name == "hr":
                close()
            else:
                if name == "br":
                    parts.append(" ")
            continue
        if name in _BLOCK:
            close()
            # what an opening tag closes: an open paragraph, an item by the next item, a cell by the next cell
            if name in _ENDS_P and stack[-1][2].name == "p":
                pop(stack[-1][3])
            same = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"),
                    "dd": ("dt", "dd")}.get(name, ())
            while stack[-1][2].name in same:
                pop(stack[-1][3])
        if not attrs.endswith("/"):
            _, mark, holder, place = stack[-1]
            mark = _mark(name, attrs, bool(places.get("article"))) or mark
            if name in _BLOCK:
                holder, place = Holder(name, holder), len(stack)
            places.setdefault(name, []).append(len(stack))
            stack.append((name, mark, holder, place))
    close()
    return out


#: bias, said to be content, said to be boilerplate, outside of the page's articles, share of linked
#: characters, log of the number of words, ends like a sentence, heading, list item, weight of its container
START = (-3.0, 6.0, -8.0, -4.0, -4.0, 0.6, 0.8, 0.3, -0.6, 4.0)


def _container(b: Block) -> Holder:
    """The element around the one that holds a block: siblings have it in common."""
    return b.holder.parent or b.holder


def container_weights(page: list[Block]) -> list[float]:
    """For each block how many unlinked words its container holds itself, and half of those of the
    container right around it (a list or quotation within an article), as a share of the page's
    most: an article's paragraphs stand together, whatever the names of the elements are."""
    own: dict[Holder, float] = {}
    for b in page:
        words = (b.text.count(" ") + 1) * (1 - b.linked / len(b.text))
        own[_container(b)] = own.get(_container(b), 0.0) + words
    weight = dict(own)
    for c in own:
        if c.parent in own:
            weight[c] += own[c.parent] / 2
    most = max(weight.values(), default=0.0)
    return [weight[_container(b)] / most if most else 0.0 for b in page]


def features(page: list[Block]) -> list[tuple[float, ...]]:
    has = any(b.article for b in page)
    return [(1.0, float(b.mark > 0), float(b.mark < 0), float(has and not b.article), b.linked / len(b.text),
             math.log1p(b.text.count(" ") + 1), float(b.text[-1] in ".!?…:;\"'”’»)"), float(b.holder.name in _HEADS),
             float(b.holder.name in _LISTS), w) for b, w in zip(page, container_weights(page))]


_HEADS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_LISTS = frozenset(("li", "dt", "dd", "td", "th"))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.3, pull: float = 0.02) -> tuple[float, ...]:
    """Logistic regression by gradient descent, pulled to the starting weights; both classes weigh the same."""
    w = np.array(START)
    if not len(y) or y.min() == y.max():
        return START
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= rate * (x.T @ (weight * (p - y)) + pull * (w - np.array(START)))
    return tuple(w.tolist())


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source's side of a minimum cut.

    A node whose terminal capacity left over is more than all its edges together
    is on that terminal's side in every minimum cut, and its edges become
    capacities of its neighbours; what remains is solved by augmenting paths.
    """
    n = len(source)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b and c > 0:
            near[a][b] = near[a].get(b, 0.0) + c
            near[b][a] = near[b].get(a, 0.0) + c
    left = [s - t for s, t in zip(source, sink)]
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is not None or abs(left[i]) < sum(near[i].values()) or not left[i] and near[i]:
            continue
        side[i] = left[i] > 0
        for j, c in near[i].items():
            del near[j][i]
            left[j] += c if side[i] else -c
            todo.append(j)
        near[i] = {}
    free = [i for i in range(n) if side[i] is None]
    # The rest: shortest augmenting paths, from one node with source capacity at a time.  Nodes that such a node
    # reaches without finding sink capacity are the source's for good, as nothing flows out of them.
    for start in free:
        while side[start] is None and left[start] > 1e-12:
            back: dict[int, int | None] = {start: None}
            queue, goal = deque(back), None
            while queue and goal is None:
                i = queue.popleft()
                for j, c in near[i].items():
                    if c > 1e-12 and j not in back and side[j] is None:
                        back[j] = i
                        if left[j] < -1e-12:
                            goal = j
                            break
                        queue.append(j)
            if goal is None:
                for i in back:
                    side[i] = True
                break
            flow, j = min(-left[goal], left[start]), goal
            while back[j] is not None:
                flow, j = min(flow, near[back[j]][j]), back[j]
            left[start] -= flow
            left[goal] += flow
            j = goal
            while back[j] is not None:
                i = back[j]
                near[i][j] -= flow
                near[j][i] = near[j].get(i, 0.0) + flow
                j = i
    return [bool(s) for s in side]


#: Strength of smoothness between neighbours on the page, and between blocks of the same container.
ADJACENT, CONTAINED = 0.6, 0.6


def _apart(a: Holder, b: Holder) -> int:
    """Steps between two elements of the tree.  Over a page's neighbours they add up to at most
    its opened and closed elements."""
    n = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a, n = a.parent, n + 1
    return n


def _ties(page: list[Block]) -> list[tuple[int, int, float]]:
    out, last = [], {}
    for i, b in enumerate(page):
        if i:
            out.append((i - 1, i, ADJACENT / (1 + max(_apart(page[i - 1].holder, b.holder) - 2, 0))))
        container = _container(b)
        if container in last:
            out.append((last[container], i, CONTAINED))
        last[container] = i
    return out


def main_text(html: str, weights: tuple[float, ...] = START) -> str:
    page = blocks(html)
    content, boiler = [], []
    for f in features(page):
        z = max(-9.0, min(9.0, sum(a * b for a, b in zip(weights, f))))
        content.append(math.log1p(math.exp(z)))   # what it costs to call it boilerplate
        boiler.append(math.log1p(math.exp(-z)))   # ... and content
    side = minimum_cut(content, boiler, _ties(page))
    return "\n".join(b.text for b, s in zip(page, side) if s)


def train(pages: DataFrame, id_col: str = "page_id", html: str = "html", sample: int = 400,
          per_page: int = 64) -> tuple[float, ...]:
    """Weights from the ``sample`` pages with the smallest id hashes, at most ``per_page`` evenly
    spread blocks of each; only their few numbers come to the driver."""
    h = F.xxhash64(F.col(id_col), F.lit(9))
    edge = pages.select(h.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if edge is None:
        return START

    def work(batches):
        for b in batches:
            rows = []
            for page in strings(b.column(0)).to_pylist():
                page = blocks(page)
                named = any(x.mark > 0 for x in page)
                every = features(page)
                step = -(-len(page) // per_page) or 1
                rows += [[*f, float(x.mark > 0)] for x, f in list(zip(page, every))[::step] if named]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["f"])

    rows = (pages.where(h <= edge).groupBy(F.col(id_col)).agg(F.min(html).alias("html")).select("html")
            .mapInArrow(work, "f array<double>").collect())
    if not rows:
        return START
    got = np.array(sorted(r.f for r in rows))
    x, y = got[:, :-1], got[:, -1]
    hidden = x.copy()
    hidden[:, 1:4] = 0
    return fit(np.concatenate([x, hidden]), np.concatenate([y, y]))


def extract(pages: DataFrame, weights: tuple[float, ...], keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns, text and n_chars of every row."""
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def work(batches):
        for b in batches:
            texts = [main_text(p, weights) for p in strings(b.column(0)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.select(F.col(html).alias("_html"), *[F.col(c) for c in keep]).mapInArrow(work, schema)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract(pages, train(pages), ["page_id", "url"])


QUERIES = {"op4_html_text": op4_html_text}
