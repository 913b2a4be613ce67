"""Main text of web pages by wrapper induction.

Pages of a host are built from one template. Every page is parsed into a tree in which runs of
like siblings are one repeated node. Trees of a host are aligned by simple tree matching
(Yang, 1991) and merged; over all pages of the host a node whose text never changes is
template, one whose text changes is a slot. The wrapper is the path to the content - the
article if the template has one, else the part that holds most of the changing text - and
the constant nodes inside it. Menus, notices, forms and the like are left out by what their
elements are; what they are named counts only for elements that do not hold the content.

All pages count but those without a tree: a task folds its pages into one row per host and
shape of tree. The shapes of a host are merged in buckets until one template is left. What is
constant is told by counting, per node and text, the pages that have them.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.llm.common import ready
from cohortix.session import written

SHAPES = 64
WIDE = 64
FOLDED = 20_000
FOLDED_TEXTS = 500_000
MIN_PAGES = 3
NEARLY = 0.9
SHARE = 0.6
WRAPPER_BYTES = 32 << 20
DEPTH = 200  # of the trees; deeper elements follow one another there

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html li dd dt tr td th tbody thead tfoot caption legend summary figcaption".split())
CLOSED_BY = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
SCOPE = frozenset("html body table ul ol dl select article section div td th".split())
LEFT_OUT = frozenset(
    "nav header footer aside form script style noscript template iframe svg button select textarea input dialog menu "
    "head title object canvas audio video".split())
WHOLE = frozenset("html body main article".split())
LEFT_OUT_NAMES = re.compile(
    r"^(?:nav\w*|menus?|breadcrumbs?|header|masthead|footer|sidebar|aside|ads?|advert\w*|banner|sponsor\w*|promo\w*|"
    r"cookies?|consent|notices?|popup|modal|overlay|newsletter|subscri\w+|share\w*|sharing|social|related|recommend\w*|"
    r"comment\w*|respond|disqus|paginat\w+|pager|search|login|signup|toolbar|widgets?|skip|complementary|contentinfo|"
    r"navigation|alert|hidden)$")

_token = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s>/]*)[^>]*(?:>|$)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|$)", re.S)
_attribute = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_bare_hidden = re.compile(r"(?:^|\s)hidden(?:\s|/|$)")
_name = re.compile(r"[^a-z0-9]+")
_state = re.compile(r"(?:has|with|without|no|is|js|can)[-_]")  # says what an element has, not what it is
_digits = re.compile(r"\d+")

TEXT = "#"


class Node:
    """An element; ``children`` are elements and strings."""

    __slots__ = ("tag", "label", "out", "named", "children")

    def __init__(self, tag: str, label: str, out: bool, named: bool = False):
        self.tag, self.label, self.out, self.named = tag, label, out or named, named and not out
        self.children: list[Node | str] = []


def _described(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """The label an element is aligned by, whether it is no content, and whether its names say so."""
    if not attributes or "=" not in attributes:
        return tag, tag in LEFT_OUT or bool(attributes and _bare_hidden.search(attributes)), False
    found = {}
    for name, a, b, c in _attribute.findall(attributes):
        found.setdefault(name.lower(), entities.unescape(a or b or c).lower())
    said = " ".join(found.get(key, "") for key in ("class", "id", "role")).split()
    names = [] if tag in WHOLE else [n for word in said if not _state.match(word) for n in _name.split(word) if n]
    label = ".".join([tag, *_digits.sub("", found.get("class", "")).split()])
    hidden = found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    return label, tag in LEFT_OUT or hidden or bool(_bare_hidden.search(_attribute.sub("", attributes))), any(
        map(LEFT_OUT_NAMES.match, names))


def parse(html: str) -> Node:
    """The tree of a page; broken nesting is mended as browsers do in the common cases.

    Elements nested deeper than ``DEPTH`` lie in the tree one after another, in page order, and
    left out with what holds them.
    """
    root = Node("", "", False)
    stack, at, n = [root], 0, len(html)

    def add(child: Node | str) -> None:
        if len(stack) <= DEPTH:
            stack[-1].children.append(child)
            return
        # marks inside a line hold nothing themselves; what they hold is their block's
        i = len(stack) - 1
        while i >= DEPTH and not stack[i].out and stack[i].tag not in BLOCK:
            i -= 1
        level = stack[DEPTH - 1].children
        if isinstance(child, Node):
            child.out, child.named = child.out or stack[-1].out, child.named or stack[-1].named
            if child.tag in BLOCK or child.out:
                level.append(child)
                return
            if child.tag not in VOID:
                return
        if i >= DEPTH and level[-1] is not stack[i]:  # the block goes on behind one inside it
            again = Node(stack[i].tag, stack[i].label, stack[i].out)
            again.named = stack[i].named
            level.append(again)
            stack[i] = again
        stack[i].children.append(child)

    while at < n:
        m = _token.search(html, at)
        end = m.start() if m else n
        if end > at and not (text := html[at:end]).isspace():
            add(entities.unescape(text) if "&" in text else text)
        elif end > at:
            add(" ")
        if m is None:
            break
        at = m.end()
        if m.group(1):
            _close(stack, m.group(1).lower())
        elif m.group(2):
            tag = m.group(2).lower()
            _make_room(stack, tag)
            node = Node(tag, *_described(tag, m.group(3)))
            add(node)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(html, at)
                at = close.end() if close else n
            elif tag not in VOID and not m.group(3).endswith("/"):
                stack.append(node)
    _take_in(root)
    return root


def _take_in(root: Node) -> None:
    """Elements that only their names leave out stay in if they hold the content.

    That is the article or main part with most text, if all of them are so named or within
    such an element; on a page without one, whatever holds ``SHARE`` of the text.
    """
    sizes: dict[int, int] = {}
    found: list[tuple[int, bool, list[Node]]] = []  # text, whether it is left out by names, the way to it

    def look(node: Node, way: list[Node], linked: bool) -> int:
        linked = linked or node.tag == "a"
        way = [*way, node] if node.named else way
        size = 0
        for c in node.children:
            if isinstance(c, str):
                size += 0 if linked else len(c.strip())
            elif (not c.out or c.named) and c.tag not in RAW:
                size += look(c, way, linked)
        sizes[id(node)] = size
        if node.tag in ("article", "main"):
            found.append((size, bool(way), way))
        return size

    whole = look(root, [], False)
    with_text = [f for f in found if f[0]]
    if with_text:
        if all(named for _, named, _ in with_text):
            for node in max(with_text, key=lambda f: f[0])[2]:
                node.out = node.named = False
        return

    def widen(node: Node) -> None:
        for c in node.children:
            if isinstance(c, Node) and sizes.get(id(c), 0) >= SHARE * whole > 0:
                if c.named:
                    c.out = c.named = False
                widen(c)

    widen(root)


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in SCOPE and tag not in BLOCK:
            return


def _make_room(stack: list[Node], tag: str) -> None:
    """End the open elements that a new ``tag`` ends by itself."""
    if tag in CLOSES_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in BLOCK:
                break
    ends = CLOSED_BY.get(tag)
    while ends:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                del stack[i:]
                break
            if stack[i].tag in SCOPE and stack[i].tag not in ends:
                return
        else:
            return


def text_key(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:12]


def tidy(text: str) -> str:
    return " ".join(text.split())


# ---- templates: [label, out, children], text leaves are [TEXT, keys, chars, changes] ---------
def template(node: Node, linked: bool = False) -> list:
    """The tree with runs of like siblings merged into one.

    A text leaf keeps the keys of its texts, how many characters outside links they hold, and
    whether pages differ in them.
    """
    runs: list[list[list]] = []
    if node.tag not in RAW:
        linked = linked or node.tag == "a"
        for c in node.children:
            if isinstance(c, str):
                text = tidy(c)
                if not text:
                    continue
                child = [TEXT, [text_key(text)], 0 if linked else len(text), False]
            else:
                child = template(c, linked)
            if runs and runs[-1][0][0] == child[0]:
                runs[-1].append(child)
            else:
                runs.append([child])
    return [node.label, node.out, [merged_run(run) for run in runs]]


def merged_run(run: Sequence[list]) -> list:
    """Like siblings of one page as one node; those of one shape at once, others by halves."""
    if len(run) == 1:
        return run[0]
    first = run[0]
    if first[0] == TEXT:
        return [TEXT, sorted({key for t in run for key in t[1]}), sum(t[2] for t in run), any(t[3] for t in run)]
    labels = [c[0] for c in first[2]]
    if all([c[0] for c in t[2]] == labels for t in run):
        return [first[0], first[1], [merged_run([t[2][i] for t in run]) for i in range(len(labels))]]
    half = len(run) // 2
    return merged(merged_run(run[:half]), merged_run(run[half:]), one_page=True)


Sizes = dict[tuple[int, int], int]


def match_size(a: list, b: list, known: Sizes | None = None) -> int:
    """Simple tree matching: the most nodes that two trees can pair in order, below paired parents.

    ``known`` remembers the pairs of trees of one merge.
    """
    if a[0] != b[0]:
        return 0
    if a[0] == TEXT:
        return 1
    known = {} if known is None else known
    key = id(a), id(b)
    if key not in known:
        x, y = a[2], b[2]
        start, end = _same_ends(x, y)
        same = sum(map(nodes, [*x[:start], *x[len(x) - end:]]))
        known[key] = 1 + same + _aligned(x[start:len(x) - end], y[start:len(y) - end], known)[-1][-1]
    return known[key]


def nodes(t: list) -> int:
    return 1 if t[0] == TEXT else 1 + sum(map(nodes, t[2]))


def alike(a: list, b: list) -> bool:
    """Whether two templates have the same labels throughout."""
    return a[0] == b[0] and (a[0] == TEXT or len(a[2]) == len(b[2]) and all(map(alike, a[2], b[2])))


def _same_ends(x: Sequence[list], y: Sequence[list]) -> tuple[int, int]:
    """How many trees are alike at the beginning and at the end; pairing those is best."""
    most, start, end = min(len(x), len(y)), 0, 0
    while start < most and alike(x[start], y[start]):
        start += 1
    while end < most - start and alike(x[-1 - end], y[-1 - end]):
        end += 1
    return start, end


def _aligned(a: Sequence[list], b: Sequence[list], known: Sizes) -> list[list[int]]:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            pair = match_size(x, y, known) if x[0] == y[0] else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + pair)
    return best


def merged(a: list, b: list, one_page: bool = False, known: Sizes | None = None) -> list:
    """Two templates of one label as one: paired nodes merged, the others side by side.

    Leaves of different pages keep the texts that all of them have, like siblings of one page
    all of their texts.
    """
    known = {} if known is None else known
    if a[0] == TEXT:
        keys = sorted({*a[1], *b[1]} if one_page else {*a[1]} & {*b[1]})
        changes = a[3] or b[3] or (not one_page and sorted(a[1]) != sorted(b[1]))
        return [TEXT, keys, a[2] + b[2], changes]
    x, y = a[2], b[2]
    if [c[0] for c in x] == [c[0] for c in y]:
        return [a[0], a[1], [merged(c, d, one_page, known) for c, d in zip(x, y)]]
    alone = (lambda t: t) if one_page else _optional
    start, end = _same_ends(x, y)
    lead = [merged(c, d, one_page, known) for c, d in zip(x[:start], y[:start])]
    tail = [merged(c, d, one_page, known) for c, d in zip(x[len(x) - end:], y[len(y) - end:])]
    x, y = x[start:len(x) - end], y[start:len(y) - end]
    best, i, j, out = _aligned(x, y, known), len(x), len(y), []
    while i or j:
        pair = match_size(x[i - 1], y[j - 1], known) if i and j and x[i - 1][0] == y[j - 1][0] else 0
        if pair and best[i][j] == best[i - 1][j - 1] + pair:
            i, j = i - 1, j - 1
            out.append(merged(x[i], y[j], one_page, known))
        elif i and best[i][j] == best[i - 1][j]:
            i -= 1
            out.append(alone(x[i]))
        else:
            j -= 1
            out.append(alone(y[j]))
    return [a[0], a[1], [*lead, *out[::-1], *tail]]


def _optional(t: list) -> list:
    """A node that some pages lack holds no constant text."""
    return [TEXT, [], t[2], True] if t[0] == TEXT else [t[0], t[1], [_optional(c) for c in t[2]]]


def shape(t: list) -> str:
    """The labels of a template; equal shapes merge leaf by leaf."""
    return TEXT if t[0] == TEXT else f"{t[0]}{'!' if t[1] else ''}({','.join(map(shape, t[2]))})"


def leaves(t: list) -> list[list]:
    return [t] if t[0] == TEXT else [x for c in t[2] for x in leaves(c)]


def slot_chars(t: list) -> int:
    """Characters of changing text outside links and outside what is left out."""
    if t[0] == TEXT:
        return t[2] if t[3] else 0
    return 0 if t[1] else sum(map(slot_chars, t[2]))


def content_path(t: list) -> list[str]:
    """Labels from the root to the content."""
    paths: list[tuple[int, list[str]]] = []

    def look(node: list, path: list[str]) -> None:
        for c in node[2]:
            if c[0] == TEXT or c[1]:
                continue
            tag = c[0].split(".")[0]
            if tag in ("article", "main"):
                # an article inside the main part wins unless it holds little of it
                paths.append((slot_chars(c) * (2 if tag == "article" else 1), [*path, c[0]]))
            look(c, [*path, c[0]])

    look(t, [])
    if paths and max(paths, key=lambda p: p[0])[0]:
        return max(paths, key=lambda p: p[0])[1]
    path: list[str] = []
    while True:
        inner = [c for c in t[2] if c[0] != TEXT]
        top = max(inner, key=slot_chars, default=None)
        if top is None or not slot_chars(top) or slot_chars(top) < SHARE * slot_chars(t) or top[0].split(".")[0] == "p":
            return path
        path.append(top[0])
        t = top


def spots(t: list) -> list[tuple[str, list]]:
    """The text leaves outside what is left out, each with the labels that lead to it."""
    out: list[tuple[str, list]] = []

    def collect(node: list, labels: str) -> None:
        for c in node[2]:
            if c[0] == TEXT:
                out.append((labels, c))
            elif not c[1]:
                collect(c, f"{labels}/{c[0]}")

    collect(t, "")
    return out


def compact(t: list) -> list:
    """Runs of like siblings merged into one, in a list of more than ``WIDE`` all like siblings."""
    if t[0] == TEXT:
        return t
    runs: list[list[list]] = []
    places: dict[str, int] = {}
    wide = len(t[2]) > WIDE
    for c in t[2]:
        at = places.get(c[0]) if wide else len(runs) - 1
        if at is not None and at >= 0 and runs[at][0][0] == c[0]:
            runs[at].append(c)
        else:
            places[c[0]] = len(runs)
            runs.append([c])
    return [t[0], t[1], [compact(merged_run(run)) for run in runs]]


def merged_all(templates: Sequence[list]) -> list:
    whole = compact(templates[0])
    for t in templates[1:]:
        whole = compact(merged(whole, compact(t)))
    return whole


def wrapper_of(whole: list, fixed: dict[str, tuple[list[str], bool]]) -> dict:
    """The wrapper of a host from its merged template: ``path`` and ``constants``.

    ``fixed`` holds for the labels of a node the keys of its constant texts, and whether it
    has hardly any others. Constants are believed only if something else changes.
    """
    for labels, leaf in spots(whole):
        leaf[3] = not fixed.get(labels, ([], False))[1]
    changing = slot_chars(whole)
    path = content_path(whole if changing else _optional(whole))
    lead = "".join(f"/{label}" for label in path)
    below = sorted((labels[len(lead):], key) for labels, (keys, _) in fixed.items()
                   if labels == lead or labels.startswith(f"{lead}/") for key in keys) if changing else []
    return {"path": path, "constants": [f"{labels}{TEXT}{key}" for labels, key in below]}


def main_text(html: str, wrapper: dict | None) -> str:
    """The blocks of the content, one per line. Without a wrapper that fits, the page is its own.

    A page of nothing but constants, such as a copy made many times, keeps them.
    """
    root = parse(html)
    path, fixed = (wrapper["path"], wrapper["constants"]) if wrapper else ([], frozenset())
    found = _at(root, path) if path else []
    if not found:
        own = _optional(template(root))
        found, fixed = _at(root, content_path(own)), frozenset()
    blocks = _content(found, fixed)
    return "\n".join(blocks or _content(found, frozenset()))


def _content(nodes: Sequence[Node], fixed) -> list[str]:
    blocks: list[str] = []
    for node in nodes:
        held: list[str] = []
        _blocks(node, "", fixed, held, blocks)
        _flush(held, blocks)
    return blocks


def _at(node: Node, path: Sequence[str]) -> list[Node]:
    nodes = [node]
    for label in path:
        nodes = [c for x in nodes for c in x.children if isinstance(c, Node) and c.label == label and not c.out]
    return nodes


def _flush(held: list[str], blocks: list[str]) -> None:
    if text := tidy("".join(held)):
        blocks.append(text)
    held.clear()


def _blocks(node: Node, labels: str, fixed, held: list[str], blocks: list[str]) -> None:
    for c in node.children:
        if isinstance(c, str):
            if fixed and f"{labels}{TEXT}{text_key(tidy(c))}" in fixed:
                continue
            held.append(c)
        elif c.tag == "br":
            held.append(" ")
        elif not c.out:
            if block := c.tag in BLOCK:
                _flush(held, blocks)
            _blocks(c, f"{labels}/{c.label}", fixed, held, blocks)
            if block:
                _flush(held, blocks)


# ---- Spark ---------------------------------------------------------------------------------
def host(url_col: str):
    """The host of an address in lower case; empty if there is none."""
    found = F.regexp_extract(F.col(url_col), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def induce(pages: DataFrame, html_col: str, host_col: str) -> DataFrame:
    """``host, wrapper`` (JSON) of every host, from all of its pages that have a tree."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], Folded] = {}
        texts = 0
        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = template(parse(page or ""))
                if not t[2]:
                    continue
                key = name, shape(t)
                if key not in found:
                    found[key] = Folded(t)
                texts += found[key].add(t)
                if len(found) >= FOLDED or texts >= FOLDED_TEXTS:
                    yield _folded(found)
                    found, texts = {}, 0
        if found:
            yield _folded(found)

    folded = written(pages.select(host_col, html_col).mapInArrow(
        fold, "host string, shape string, tree string, n long, chars array<bigint>, "
              "spots array<struct<labels: string, total: bigint, keys: array<struct<key: string, n: bigint>>>>"), "shapes")
    place = ["host", "shape"]
    chars = (
        folded.select(*place, F.posexplode("chars").alias("i", "chars")).groupBy(*place, "i").agg(F.sum("chars").alias("chars"))
        .groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("i", "chars")))["chars"].alias("chars")))
    trees = folded.groupBy(*place).agg(F.min("tree").alias("tree"), F.sum("n").alias("n"))
    rows = written(trees.join(chars, place, "left"), "templates")

    def whole_of(group: pa.Table) -> list:
        templates = []
        for r in sorted(group.to_pylist(), key=lambda r: (-r["n"], r["shape"])):
            t = json.loads(r["tree"])
            for own, size in zip(leaves(t), r["chars"] or []):
                own[2] = size
            templates.append(t)
        return merged_all(templates)

    def merge(group: pa.Table) -> pa.Table:
        return pa.table({
            "host": group["host"].slice(0, 1), "shape": group["bucket"].slice(0, 1).cast(pa.string()),
            "tree": [json.dumps(whole_of(group))], "n": pa.array([sum(group["n"].to_pylist())], pa.int64()),
            "chars": pa.array([None], pa.list_(pa.int64()))})

    # each turn leaves about a template for SHAPES of the host with most
    while (most := rows.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > SHAPES:
        bucket = F.pmod(F.xxhash64("shape"), F.lit(-(-most // SHAPES))).alias("bucket")
        rows = written(rows.select("*", bucket).groupBy("host", "bucket").applyInArrow(
            merge, "host string, shape string, tree string, n long, chars array<bigint>"), "templates")

    spot = folded.select("host", "n", F.explode("spots").alias("spot")).select("host", "n", "spot.*")
    have = spot.groupBy("host", "labels").agg(F.sum("n").alias("pages"), F.sum("total").alias("total"))
    said = spot.select("host", "labels", F.explode("keys").alias("k")).groupBy("host", "labels", "k.key").agg(
        F.sum("k.n").alias("found")).where(F.col("found") >= MIN_PAGES * NEARLY)
    fixed = (
        said.join(have, ["host", "labels"])
        .where((F.col("pages") >= MIN_PAGES) & (F.col("found") >= NEARLY * F.col("pages")))
        .groupBy("host", "labels").agg(
            F.sort_array(F.collect_list("key")).alias("keys"),
            (F.first("total") - F.sum("found") <= (1 - NEARLY) * F.first("pages")).alias("steady")))

    def finish(group: pa.Table, known: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"host": pa.array([], pa.string()), "wrapper": pa.array([], pa.string())})
        wrapper = wrapper_of(whole_of(group), {r["labels"]: (r["keys"], r["steady"]) for r in known.to_pylist()})
        return pa.table({"host": group["host"].slice(0, 1), "wrapper": [json.dumps(wrapper)]})

    return rows.groupBy("host").cogroup(fixed.groupBy("host")).applyInArrow(finish, "host string, wrapper string")


class Folded:
    """The pages of one host and shape: how often each node has which text, on how many pages."""

    def __init__(self, t: list):
        self.tree, self.n, self.chars = json.dumps(_bare(t)), 0, [0] * len(leaves(t))
        self.spots: dict[str, dict[str, int]] = {}

    def add(self, t: list) -> int:
        """Add a page; how many texts are new to their nodes."""
        self.n += 1
        self.chars = [a + x[2] for a, x in zip(self.chars, leaves(t))]
        own: dict[str, set[str]] = {}
        for labels, leaf in spots(t):
            own.setdefault(labels, set()).update(leaf[1])
        new = 0
        for labels, keys in own.items():
            counts = self.spots.setdefault(labels, {})
            for key in keys:
                new += key not in counts
                counts[key] = counts.get(key, 0) + 1
        return new


def _folded(found: dict[tuple[str, str], Folded]) -> pa.RecordBatch:
    kept = pa.list_(pa.struct([("key", pa.string()), ("n", pa.int64())]))
    spot = pa.struct([("labels", pa.string()), ("total", pa.int64()), ("keys", kept)])
    rows = [(name, key, f.tree, f.n, f.chars,
             [{"labels": labels, "total": sum(c.values()), "keys": [{"key": k, "n": n} for k, n in c.items()]}
              for labels, c in f.spots.items()]) for (name, key), f in found.items()]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(spot))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["host", "shape", "tree", "n", "chars", "spots"])


def _bare(t: list) -> list:
    """The template without its texts."""
    return [TEXT, [], 0, False] if t[0] == TEXT else [t[0], t[1], [_bare(c) for c in t[2]]]


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text`` of every page; ``text`` is empty where there is none.

    Missing pages count as empty, pages without a host form a group of their own, repeated
    pages come back repeated. Other columns are dropped; an empty table stays empty.
    """
    ready(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host(url_col).alias("host"))
    wrappers = written(induce(rows, "html", "host"), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper")), F.lit(0))).first()[0]
    side = F.broadcast(wrappers) if size <= WRAPPER_BYTES else wrappers

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            out = []
            for page, written_ in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if written_ is not None and written_ not in known:
                    if len(known) >= 1_000:
                        known.clear()
                    w = json.loads(written_)
                    known[written_] = {"path": w["path"], "constants": frozenset(w["constants"])}
                out.append(main_text(page or "", known.get(written_)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string())], [id_col, url_col, "text"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return rows.join(side, "host", "left").select("id", "url", "html", "wrapper").mapInArrow(
        texts, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string")
