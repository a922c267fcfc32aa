"""Main text of web pages by composite text density.

For every node of the page's tree: density = C/T * log_b(C/LC * T/LT), where C and T count the
characters and tags below it, LC and LT those inside links, and b = ln(C/(C-LC)*LC +
LC_body/C_body*C + e); a zero below a fraction counts as one. A node's sum adds up its
children's densities. The element with the greatest sum is the seed; the least density on its
path to the body is the threshold. The main text is the seed's subtree with what stands beside
its path at or above the threshold, headings in any case, up to the main element around it, or
else one level up; an article around the seed counts whole.

Elements that never hold an article's text are left out first, by name (nav, footer, aside,
scripts, a header outside an article ...) or as hidden. Forms and elements with a word of HINTS in
their class, id or role are suspects: they and the sums inside count a tenth, for each once more.
Those around the seed stay, as do those with more than half of its text; the others go.

Defined cases: null, empty and text-free pages give empty text; text outside any element
counts as the body's; unclosed, nested and stray tags are repaired like a browser does for
paragraphs, list items and table cells; a tag that the page's end cuts off is no text; time and
memory are linear in the page, however deep its tree; repeated rows give repeated results; of
equal sums the outermost, then the first counts; whole pages are read; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import html as entities
import math
import operator
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import table

#: Possessive, so that a failure is found in one pass; quotes count after an equals sign only.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(>|\Z)""", re.S
)
_HINT_ATTRS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=\s|=|/|$)|display\s*:\s*none""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg canvas object math".split())
_DROP = _RAW | frozenset("nav footer aside head button select menu dialog label fieldset audio video".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_NO_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_TEXT = ("p", *_HEADINGS)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay sidebar side rail widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead "
    "topbar toolbar share sharing social follow comment comments respond replies disqus discussion related recommended newsletter subscribe signup "
    "login search form tags complementary contentinfo skip".split()
)


class _Node:
    __slots__ = ("tag", "parent", "kids", "chars", "tags", "link_chars", "link_tags", "drop", "suspect", "density")

    def __init__(self, tag: str, parent: _Node | None, drop: bool = False) -> None:
        self.tag, self.parent, self.drop, self.suspect = tag, parent, drop, False
        self.kids: list = []  # nodes and pieces of text, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def _dropped(tag: str, attrs: str, inside: bool) -> bool:
    if tag in _DROP or (tag == "header" and not inside):
        return True
    return bool(attrs) and tag not in ("html", "body", "main") and _HIDDEN.search(attrs) is not None


def _hinted(tag: str, attrs: str, inside: bool) -> bool:
    if tag == "form":
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    for m in _HINT_ATTRS.finditer(attrs):
        words = set(re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()))
        if words & HINTS and not (inside and words & {"header", "banner"} and tag == "header"):
            return True
    return False


def parse(page: str) -> _Node:
    """The page's tree below a body; boilerplate elements are kept as empty, dropped nodes."""
    root = top = _Node("body", None)
    at, end = 0, len(page)
    inside = 0  # open article or main elements
    live: defaultdict[str, list[tuple[int, _Node]]] = defaultdict(list)  # open elements by name, with their depths
    depth = 0

    def text(piece: str) -> None:
        if piece and not top.drop:
            top.kids.append(entities.unescape(piece))

    def close(node: _Node) -> None:
        nonlocal top, inside, depth
        while top is not node.parent:
            inside -= top.tag in ("article", "main")
            live[top.tag].pop()
            depth -= 1
            top = top.parent

    def opened(names: tuple[str, ...], stop: tuple[str, ...]) -> _Node | None:
        """The outermost open element of these names below all open ones of the names in stop."""
        floor = max((live[x][-1][0] for x in stop if live[x]), default=0)
        found = [live[x][k] for x in names if (k := bisect.bisect_right(live[x], floor, key=operator.itemgetter(0))) < len(live[x])]
        return min(found, key=operator.itemgetter(0))[1] if found else None

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if m[0].startswith("<![CDATA["):
            text(entities.escape(m[0][9:].removesuffix("]]>")))
        if not tag or tag in ("html", "body") or not m[4]:
            continue
        if m[1]:
            if tag == "br":
                top.kids.append(" ")
            elif live[tag]:
                close(live[tag][-1][1])
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at) if not m[3].endswith("/") else None
            at = stop.end() if stop else at if m[3].endswith("/") else end
            continue
        if tag in _NO_P and (p := opened(("p",), ("button", "table", "td", "th", "article", "section", "div", "li", "blockquote"))) is not None:
            close(p)
        if tag in _ENDS and (old := opened(_ENDS[tag], _SCOPE[tag])) is not None:
            close(old)
        if top.tag == "head" and tag not in _VOID:
            close(top)
        if tag in _VOID:
            if tag in ("br", "img", "wbr", "hr") and not top.drop:
                top.kids.append(" " if tag != "wbr" else "")
                if tag == "hr":
                    top.kids.append(_Node("hr", top, True))
            continue
        node = _Node(tag, top, top.drop or _dropped(tag, m[3], inside > 0))
        node.suspect = not node.drop and _hinted(tag, m[3], inside > 0)
        if not m[3].endswith("/"):
            top.kids.append(node)
            top = node
            depth += 1
            live[tag].append((depth, node))
            inside += tag in ("article", "main")
        elif not top.drop:
            top.kids.append(node)
    return root


def _order(root: _Node) -> list[_Node]:
    """Kept nodes, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [k for k in reversed(node.kids) if isinstance(k, _Node) and not k.drop]
    return out


def densities(root: _Node) -> list[_Node]:
    """The kept nodes with their counts and densities filled in."""
    nodes = _order(root)
    for node in reversed(nodes):
        own = sum(len(" ".join(k.split())) for k in node.kids if isinstance(k, str))
        node.chars += own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    ratio = root.link_chars / max(root.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
            node.density = c / t * (math.log(max(c / max(lc, 1) * t / lt, 1.0)) / math.log(base) if base > 1 else 1.0)
    return nodes


def _blocks(node: _Node) -> list[str]:
    """Texts of the blocks below a node: white space is one space, blocks end at block elements."""
    out, now = [], []

    def flush() -> None:
        if line := " ".join("".join(now).split()):
            out.append(line)
        now.clear()

    todo: list = [(node, False)]
    while todo:
        item, done = todo.pop()
        if isinstance(item, str):
            now.append(item)
        elif done:
            flush()
        else:
            block = item.tag not in _INLINE
            if block:
                flush()
                todo.append((item, True))
            if not item.drop:
                todo += [(k, False) for k in reversed(item.kids)]
    flush()
    return out


PENALTY = 0.1


def seed_of(nodes: list[_Node]) -> _Node:
    """The element with the greatest density sum; parents stand before their children."""
    best, most, weight = nodes[0], -1.0, {}
    for n in nodes:
        weight[n] = (weight[n.parent] if n.parent is not None else 1.0) * (PENALTY if n.suspect else 1.0)
        if n.tag not in _INLINE and n.tag not in _TEXT:
            total = weight[n] * sum(k.density * (PENALTY if k.suspect else 1.0) for k in n.kids if isinstance(k, _Node) and not k.drop)
            if total > most:
                best, most = n, total
    return best


def main_text(page: str) -> str:
    """The text of the page's article: blocks joined by two line feeds."""
    root = parse(page)
    nodes = densities(root)
    if not root.chars:
        return ""
    seed = up = seed_of(nodes)
    path = []
    while up is not None:
        path.append(up)
        up = up.parent
    spared = set(path) | {n for n in _order(seed) if 2 * n.chars > seed.chars}
    for n in nodes:
        n.drop = n.suspect and n not in spared
    threshold = min(n.density for n in path)
    tops = [k for k, n in enumerate(path) if n.tag == "article"]
    if tops:
        return "\n\n".join(_blocks(path[tops[0]]))
    tops = [k for k, n in enumerate(path) if n.tag == "main"] or [min(1, len(path) - 1)]
    for below, n in zip(path, path[1 : tops[0] + 1], strict=False):
        heading = lambda k: k.tag in _HEADINGS and 2 * k.link_chars <= k.chars
        n.kids = [k for k in n.kids if k is below or (isinstance(k, _Node) and (k.density >= threshold or heading(k)))]
    return "\n\n".join(_blocks(path[tops[0]]))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(x.decode("utf-8", "replace")) for x in bytesops.texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    shape = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(run, shape)


def op10_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
