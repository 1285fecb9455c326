"""Main text of web pages by wrappers inferred for each host.

A wrapper is a union-free regular expression over the tokens of a host's pages: tags, texts, optional
and repeated groups. Pages are aligned with it one after another. Where two texts differ, a slot takes
their place; where one side has more of a block that ends there, the block becomes repeated; what only
one side has becomes optional. Wrappers align with each other just so, which lets every map task
infer its own and the parts be combined.

From a host's wrapper follows where its article stands: in an element that says so, else where the
slots hold most of the text. Pages are read by that rule; a page the rule does not fit is read as if
it were the only one of its host.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import text_of
from fleetwarden.operators.lookup import look_up

SALTS = 16
HOSTS_PER_TASK = 1_000  # wrappers a task holds before it sends them on
DEPTH = 200  # elements below this depth are read as part of their parent, unless they are outside
GROUP = 4  # blocks in a repeated group, at most

# HTML's elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style template noscript iframe object svg math canvas audio video select textarea".split())
SPACED = frozenset(("br", "hr"))
# All others are inline: they end no block.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option "
    "p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements that end an open one of the same kind, or of the kinds named with them.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Blocks that hold text, and those that an end tag of such a block does not reach beyond.
NO_TEXT = frozenset("p h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("table ul ol dl article section div main body html aside nav header footer form".split())
# What an article does not include, by element and by word of class, id or role.
OUTSIDE = frozenset("nav header footer aside form dialog menu button head title".split())
WHOLE = ("html", "body")  # never left out
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer discussion disqus footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notification pagination pager popup promo promoted promotion recommended related replies reply "
    "respond share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
# Of these, words that also name a page's layout: an article inside shows that they do.
LAYOUT_WORDS = frozenset(
    "banner breadcrumb breadcrumbs consent cookie cookies footer header login masthead menu nav navbar navigation "
    "pagination share sharing sidebar social toolbar widget".split()
)
INSIDE = ("article", "main")
INSIDE_WORDS = frozenset("article articlebody content entry main post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*)(?:>|$)",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNREAD_END = {name: re.compile(f"</{name}(?=[\\s/>]|$)[^>]*(?:>|$)", re.I) for name in UNREAD}


class Node:
    """An element of a page: label "name.words", children in order, texts as str."""

    __slots__ = ("children", "label", "outside")

    def __init__(self, label: str, outside: bool = False):
        self.label, self.children, self.outside = label, [], outside


def _label(name: str, rest: str) -> tuple[str, bool]:
    words: list[str] = []
    if "=" in rest:
        for _, *values in _NAMED.findall(rest):
            words += re.findall(r"[a-z]+", "".join(values).lower())
    outside = name in OUTSIDE or (name not in WHOLE and any(w in OUTSIDE_WORDS for w in words))
    return ".".join([name, *sorted(set(words))]), outside


def _is_layout(node: Node) -> bool:
    """Whether an element counts as outside for words only that may name a page's layout."""
    name, *words = node.label.split(".")
    return name not in OUTSIDE and not any(w in OUTSIDE_WORDS - LAYOUT_WORDS for w in words)


def _rejoin(stack: list[Node]) -> None:
    """Elements below ``DEPTH`` that are no longer outside become part of their parents."""
    before = stack[min(len(stack), DEPTH) - 1].children
    for parent, node in zip(stack[DEPTH - 1 :], stack[DEPTH:], strict=False):
        own = node.children
        if not node.outside:
            if own is not before:  # outside until now, and the last child of its parent
                parent.children.pop()
                parent.children.extend(own)
            node.children = parent.children
        before = own


def parse(page: str) -> Node:
    """The blocks of a page as a tree. Inline elements and markup without text leave no trace."""
    root = Node("#root")
    stack = [root]
    opened: Counter[str] = Counter()  # elements on the stack by name: a search for one that is not there is spared
    at = 0
    held: list[str] = []

    def close(i: int) -> None:
        opened.subtract(node.label.partition(".")[0] for node in stack[i:])
        del stack[i:]

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                stack[-1].children.append(text)

    while True:
        token = _TOKEN.search(page, at)
        held.append(page[at : token.start() if token else len(page)])
        if token is None:
            break
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if name in VOID:
            held.append(" " if name in SPACED else "")
            continue
        if token["end"]:
            if name not in BLOCKS:
                if stack[-1].label.partition(".")[0] == name:  # an inline notice or advert
                    flush()
                    close(len(stack) - 1)
                continue
            flush()
            for i in range(len(stack) - 1, 0, -1) if opened[name] else ():
                own = stack[i].label.partition(".")[0]
                if own == name:
                    close(i)
                    break
                if name in NO_TEXT and own in SCOPES:
                    break
            continue
        if name in UNREAD:
            if not token["rest"].rstrip().endswith("/"):
                closing = _UNREAD_END[name].search(page, at)
                at = closing.end() if closing else len(page)
            continue
        label, outside = _label(name, token["rest"])
        if name not in BLOCKS and not outside:
            continue  # inline; a notice or advert is a block of its own all the same
        flush()
        ended = ENDS.get(name, ())
        for i in range(len(stack) - 1, 0, -1) if opened["p"] or any(opened[e] for e in ended) else ():
            own = stack[i].label.partition(".")[0]
            if own in ended or (own == "p" and name in BLOCKS):
                close(i)
                break
            if own in SCOPES:
                break
        node = Node(label, outside)
        if name in INSIDE and not outside:
            for above in stack:
                above.outside = above.outside and not _is_layout(above)
            _rejoin(stack)
        if len(stack) < DEPTH or outside:
            stack[-1].children.append(node)
        else:
            node.children = stack[-1].children
        if not token["rest"].rstrip().endswith("/"):
            stack.append(node)
            opened[name] += 1
    flush()
    return root


# A wrapper's item is [label, how often, children, characters] or, for a text, ["#", how often, value,
# characters]; value None is a slot. How often: "1", "?", "+" or "*".
_MORE = {"1": "+", "+": "+", "?": "*", "*": "*"}
_LESS = {"1": "?", "?": "?", "+": "*", "*": "*"}


def _either(a: str, b: str) -> str:
    if a == b:
        return a
    if "*" in (a, b) or {a, b} == {"?", "+"}:
        return "*"
    return "?" if "?" in (a, b) else "+"


def _merge(a: list, b: list) -> list:
    """One item for two of the same label."""
    chars = a[3] + b[3]
    often = _either(a[1], b[1])
    if a[0] == "#":
        return ["#", often, a[2] if a[2] == b[2] else None, chars]
    return [a[0], often, align(a[2], b[2]), chars]


def _fold(items: list) -> list:
    """Repeated blocks and groups of blocks as one."""
    for size in range(1, GROUP + 1):
        out: list = []
        for item in items:
            out.append(item)
            if len(out) >= 2 * size:
                one, two = out[-2 * size : -size], out[-size:]
                if [x[0] for x in one] == [x[0] for x in two] and (size > 1 or one[0][0] != "#"):
                    joined = [_merge(x, y) for x, y in zip(one, two, strict=True)]
                    out[-2 * size :] = [[x[0], _MORE[x[1]], *x[2:]] for x in joined]
        items = out
    return items


def align(a: list, b: list) -> list:
    """The union-free expression of two sequences: common items in order, all others optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_merge(x, y) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], _LESS[a[i][1]], *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], _LESS[b[j][1]], *b[j][2:]])
            j += 1
    return _fold(out)


def expression(node: Node) -> list:
    """A page's own expression; texts are kept as digests, which is enough to tell whether they differ."""
    items, chars = [], 0
    for child in node.children:
        if isinstance(child, str):
            items.append(["#", "1", hash_of(child), len(child)])
            chars += len(child)
        elif not child.outside:
            item = expression(child)
            chars += item[3]
            items.append(item)
        else:
            items.append([child.label, "1", [], 0])
    return [node.label, "1", _fold(items), chars]


def hash_of(text: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(text.encode("utf-8", "replace"))


def _slots(item: list) -> int:
    """Characters in the slots below an item."""
    if item[0] == "#":
        return item[3] if item[2] is None else 0
    return sum(map(_slots, item[2]))


def _says_inside(label: str) -> int:
    name, *words = label.split(".")
    return 2 if name in INSIDE else int(any(w in INSIDE_WORDS for w in words))


def article_path(wrapper: list) -> list[str]:
    """Labels from the root down to the element that holds the article.

    The outermost element that names itself an article (an element's name counts more than its class,
    then the one with most text), else the lowest one that holds three fifths of its parent's slots,
    or of its parent's text where the host has a single page and so no slots.
    """
    named: list[tuple[int, int, list[str]]] = []

    def search(item: list, path: list[str]) -> None:
        for child in item[2]:
            if child[0] == "#":
                continue
            here = [*path, child[0]]
            if child[3] and (rank := _says_inside(child[0])):
                named.append((rank, child[3], here))
                if rank == 2:
                    continue
            search(child, here)

    search(wrapper, [])
    if named:
        return max(named, key=lambda x: x[:2])[2]
    weigh = _slots if _slots(wrapper) else (lambda item: item[3])
    path: list[str] = []
    while True:
        children = [c for c in wrapper[2] if c[0] != "#"]
        top = max(children, key=weigh, default=None)
        if top is None or not weigh(top) or weigh(top) < 0.6 * weigh(wrapper) or top[0].partition(".")[0] in NO_TEXT:
            return path
        path.append(top[0])
        wrapper = top


def _reach(node: Node, path: list[str]) -> list[Node]:
    nodes = [node]
    for label in path:
        nodes = [c for n in nodes for c in n.children if not isinstance(c, str) and c.label == label and not c.outside]
    return nodes


def _texts(node: Node) -> Iterator[str]:
    for child in node.children:
        if isinstance(child, str):
            yield child
        elif not child.outside:
            yield from _texts(child)


def main_text(page: str, path: list[str] | None) -> str:
    """The article's blocks joined by a space."""
    root = parse(page)
    found = _reach(root, path) if path is not None else []
    if not any(True for n in found for _ in _texts(n)):
        found = _reach(root, article_path(expression(root)))
    return " ".join(t for n in found for t in _texts(n))


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port; empty for NULL and for what is no URL."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) as JSON, of pages (host, html): every page takes part.

    Each task sends one wrapper for each of its hosts; they are combined over salts and then by host,
    so that a host with a third of all pages is one small row for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def send() -> pa.RecordBatch:
            texts = [json.dumps(w, separators=(",", ":")) for w in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                own = expression(parse(page))
                held[host] = _merge(held[host], own) if host in held else own
                if len(held) >= HOSTS_PER_TASK:
                    yield send()
                    held = {}
        if held:
            yield send()

    def combine(parts: pd.DataFrame) -> pd.DataFrame:
        wrapper = None
        for text in sorted(parts["wrapper"]):
            wrapper = json.loads(text) if wrapper is None else _merge(wrapper, json.loads(text))
        joined = json.dumps(wrapper, separators=(",", ":"))
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "wrapper": [joined]})

    parts = pages.select("host", "html").mapInArrow(run, "host string, wrapper string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInPandas(combine, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(combine, "host string, wrapper string")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    The article without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
    markup and comments; character references are decoded, white space inside a block becomes one
    space, blocks are joined in order by one space. NULL or empty pages, and pages without text, give
    the empty text. A NULL URL counts as a host without name. Ids are not used: they may be NULL or
    repeated. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), text_of(html_col).alias("html")
    )

    @F.arrow_udf("string")
    def path_of(column: pa.Array) -> pa.Array:
        return pa.array([json.dumps(article_path(json.loads(w))) for w in column.to_pylist()], pa.string())

    @F.arrow_udf("string")
    def text(html: pa.Array, paths: pa.Array) -> pa.Array:
        known: dict[str | None, list[str] | None] = {None: None}
        out = []
        for page, path in zip(html, paths.to_pylist(), strict=True):
            if path not in known:
                known[path] = json.loads(path)
            out.append(main_text(page.as_py(), known[path]))
        return pa.array(out, pa.string())

    rules = infer_wrappers(rows).select("host", path_of("wrapper").alias("path"))
    read = look_up(rows, rules, ["host"]).select("page_id", "url", text("html", "path").alias("text"))
    return read.withColumn("n_chars", F.char_length("text").cast("bigint"))
