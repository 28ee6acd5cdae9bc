"""Main text of pages, by wrappers inferred from the pages of a host.

A wrapper is a union-free expression over tags: a sequence of elements, text
slots, optional parts and repeated groups. It starts as the tokens of one page
and is aligned with those of the next, level by level: where both have the same
tag the contents are aligned in turn; text against text becomes a slot; what
only one side has becomes optional; what follows itself, alone or as a group of
a few elements, becomes a repeated group. Aligning two wrappers is the same
step, so tasks infer partial wrappers of their pages, and these are aligned per
host in turn. A wrapper grows with the variety of a host's pages, not with their
number, and every page is used.

The wrapper tells where a host keeps its text: in its articles, else its main
element, else the deepest element that holds nearly all text over all pages. Each
page is then read along that path; one that lacks it is judged by itself.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import texts
from newsloom.session import stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.DOTALL,
)
MARK = re.compile(r"(?i)\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
RAW = frozenset("script style noscript template svg textarea title iframe object math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the first kind ends an open element of these kinds.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
ENDS |= {tag: {"p"} for tag in BLOCKS - {"br", *ENDS}}
#: Elements and marks of what is not the article.
FURNITURE = frozenset("nav footer aside form head button select menu dialog".split()) | RAW
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer banner breadcrumb breadcrumbs ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo cookie cookies consent notice notices popup modal newsletter subscribe share "
    "sharing social comment comments reply replies respond related recommended widget toolbar login search pagination "
    "pager disqus complementary contentinfo".split()
)
#: Elements that their marks never make furniture.
KEPT = frozenset("html body main article".split())
#: Elements that may hold an article, and the share of the text outside of furniture that is nearly all of it.
HOLDERS = frozenset("html body div section table tbody tr td center".split())
NEARLY_ALL = 0.95
#: Elements nested deeper are taken as siblings; their closing tags close no others.
DEPTH = 150


def _named(token: str) -> bool:
    """Whether a whole class, id, role or property is made of words for furniture, as ``ad-banner``."""
    words = [w for w in re.split(r"[\W\d_]+", token.lower()) if w]
    return bool(words) and all(w in FURNITURE_WORDS for w in words)


@lru_cache(maxsize=20_000)
def marked(sig: str) -> bool:
    """Whether marks make an element furniture."""
    tag, _, marks = sig.partition(" ")
    return tag not in KEPT and any(_named(token.rpartition("=")[2]) for token in marks.split())


def furniture(sig: str) -> bool:
    return sig.split(" ", 1)[0] in FURNITURE or marked(sig)


class Node:
    """An element or (tag ``#``) a text; in a wrapper also a group (tag ``()``)."""

    __slots__ = ("sig", "children", "text", "chars", "many", "maybe")

    def __init__(self, sig: str, text: str = "", chars: int = 0):
        self.sig, self.text, self.chars = sig, text, chars
        self.children: list[Node] = []
        self.many = self.maybe = False

    @property
    def tag(self) -> str:
        return self.sig.split(" ", 1)[0]

    @property
    def key(self) -> str:
        return self.sig if self.sig != "()" else f"({' '.join(c.key for c in self.children)})"


def _signature(tag: str, rest: str) -> str:
    marks = " ".join(f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in MARK.finditer(rest)) if "=" in rest else ""
    return f"{tag} {re.sub('[0-9]+', '0', marks)}" if marks else tag


def parsed(page: str) -> Node:
    """Tree of a page. Open elements end as HTML has it, at the latest with the page."""
    root = Node("")
    stack, at, n = [root], 0, len(page)
    deeper: dict[str, int] = {}
    while at < n:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else n]
        if text and not text.isspace():
            stack[-1].children.append(Node("#", text, len(text)))
        elif text and stack[-1].children and stack[-1].children[-1].sig == "#":
            stack[-1].children[-1].text += " "
        elif text and stack[-1].tag not in BLOCKS:
            stack[-1].children.append(Node("#", " "))
        if not m:
            break
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if deeper.get(tag):
                deeper[tag] -= 1
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    deeper.clear()
                    break
            continue
        if tag in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[tag]:
                    if len(stack) == DEPTH and deeper.get(stack[k].tag):
                        break
                    del stack[k:]
                    deeper.clear()
                    break
                if stack[k].tag in BLOCKS and not (tag in ("tr", "td", "th") and stack[k].tag in ("td", "th", "tr")):
                    break
        node = Node(_signature(tag, m["rest"]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not m["rest"].endswith("/"):
            if len(stack) < DEPTH:
                stack.append(node)
            else:
                deeper[tag] = deeper.get(tag, 0) + 1
    return root


def _copy(node: Node) -> Node:
    """The page's node as a wrapper: texts become slots, contents are folded."""
    found = Node(node.sig, "", node.chars)
    found.children = folded([_copy(c) for c in node.children if not (c.sig == "#" and not c.chars)])
    return found


def joined(a: Node, b: Node) -> Node:
    found = Node(a.sig, "", a.chars + b.chars)
    found.many, found.maybe = a.many or b.many, a.maybe or b.maybe
    found.children = aligned(a.children, b.children)
    return found


def aligned(xs: list[Node], ys: list[Node]) -> list[Node]:
    """One sequence for two: same keys in order are joined, all else becomes optional."""
    import difflib

    kx, ky = [x.key for x in xs], [y.key for y in ys]
    if kx == ky:
        return [joined(x, y) for x, y in zip(xs, ys)]
    found: list[Node] = []
    for kind, a, b, c, d in difflib.SequenceMatcher(None, kx, ky, autojunk=False).get_opcodes():
        if kind == "equal":
            found += [joined(x, y) for x, y in zip(xs[a:b], ys[c:d])]
        else:
            for node in (*xs[a:b], *ys[c:d]):
                node.maybe = True
                found.append(node)
    return folded(found)


def folded(nodes: list[Node]) -> list[Node]:
    """Neighbours that repeat, alone or in groups of two or three, become one repeated part."""
    for period in (1, 2, 3):
        found: list[Node] = []
        at = 0
        while at < len(nodes):
            group = nodes[at : at + period]
            keys = [g.key for g in group]
            end = at + period
            while len(keys) == period and [x.key for x in nodes[end : end + period]] == keys:
                group = [joined(x, y) for x, y in zip(group, nodes[end : end + period])]
                end += period
            if end == at + period:
                found.append(nodes[at])
                at += 1
                continue
            if period == 1:
                part = group[0]
            else:
                part = Node("()")
                part.children = group
            part.many = True
            found.append(part)
            at = end
        nodes = found
    return nodes


def written(node: Node) -> list:
    return [node.sig, node.chars, int(node.many), int(node.maybe), [written(c) for c in node.children]]


def read(data: list) -> Node:
    node = Node(data[0], "", data[1])
    node.many, node.maybe = bool(data[2]), bool(data[3])
    node.children = [read(c) for c in data[4]]
    return node


def expression(node: Node) -> str:
    """A wrapper as text: ``<p>#</p>+`` and the like."""
    inner = "".join(expression(c) for c in node.children)
    if node.sig == "#":
        shown = "#"
    elif node.sig in ("", "()"):
        shown = f"({inner})" if node.sig else inner
    else:
        shown = f"<{node.sig}>{inner}</{node.tag}>"
    bound = {(0, 0): "", (1, 0): "+", (0, 1): "?", (1, 1): "*"}[int(node.many), int(node.maybe)]
    return f"({shown}){bound}" if bound and node.sig != "()" else shown + bound


def _paths(
    node: Node, skipped: Callable[[str], bool] = furniture, path: tuple[str, ...] = ()
) -> Iterator[tuple[tuple[str, ...], Node]]:
    """Elements outside of furniture with their paths; groups are no step of a path."""
    for child in node.children:
        if child.sig == "#" or skipped(child.sig):
            continue
        if child.sig == "()":
            yield from _paths(child, skipped, path)
        else:
            yield (*path, child.sig), child
            yield from _paths(child, skipped, (*path, child.sig))


def _unmarked(sig: str) -> bool:
    """Furniture by its tag; a form may hold the whole page."""
    tag = sig.split(" ", 1)[0]
    return tag in FURNITURE and tag != "form"


def _own_text(node: Node) -> int:
    """Characters of an element's texts outside of furniture."""
    total = 0
    for child in node.children:
        if child.sig == "#":
            total += child.chars
        elif child.sig == "()" or not furniture(child.sig):
            total += _own_text(child)
    return total


def _any_text(node: Node) -> bool:
    return any(c.chars if c.sig == "#" else not furniture(c.sig) and _any_text(c) for c in node.children)


def _main(sig: str) -> bool:
    return sig.split(" ", 1)[0] == "main" or "role=main" in sig or "itemprop=articleBody" in sig


def text_paths(wrapper: Node) -> list[tuple[str, ...]]:
    """Where the article stands."""
    places = list(_paths(wrapper))
    # What holds the article is no furniture, whatever its marks say, if no other place has text.
    for held in (places, list(_paths(wrapper, _unmarked))):
        for wanted in (lambda s: s.split(" ", 1)[0] == "article", _main):
            found = [(p, node) for p, node in held if wanted(p[-1]) and not any(wanted(s) for s in p[:-1])]
            if any(_any_text(node) for _, node in found):
                return [p for p, _ in found]
    path: tuple[str, ...] = ()
    nodes = [wrapper]
    while step := _heir(nodes):
        path, nodes = (*path, step[0].sig), step
    return [path] if path else []


def _heir(nodes: list[Node]) -> list[Node]:
    """The children of one signature that hold nearly all text of the nodes, if they are no blocks of the text itself."""
    by: dict[str, list[Node]] = {}
    total, todo = 0, [c for node in nodes for c in node.children]
    while todo:
        child = todo.pop()
        if child.sig == "()":
            todo += child.children
        elif child.sig == "#":
            total += child.chars
        elif not furniture(child.sig):
            total += _own_text(child)
            by.setdefault(child.sig, []).append(child)
    for sig, found in by.items():
        if sig.split(" ", 1)[0] in HOLDERS and sum(map(_own_text, found)) >= max(1, NEARLY_ALL * total):
            return found
    return []


def _reached(root: Node, paths: list[tuple[str, ...]]) -> list[Node]:
    """Elements of a page at one of the paths, in page order, none inside another."""
    wanted, steps = set(paths), {p[:k] for p in paths for k in range(1, len(p))}
    found: list[Node] = []
    todo = [((c.sig,), c) for c in reversed(root.children)]
    while todo:
        path, node = todo.pop()
        if path in wanted:
            found.append(node)
        elif path in steps:
            todo += [((*path, c.sig), c) for c in reversed(node.children)]
    return found


def _blocks(nodes: list[Node]) -> Iterator[str]:
    """Texts of blocks in page order, without furniture inside the nodes."""
    held: list[str] = []
    chosen = set(map(id, nodes))

    def ended() -> Iterator[str]:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            yield text

    todo: list[Node | None] = list(reversed(nodes))
    while todo:
        node = todo.pop()
        if node is None:
            yield from ended()
        elif node.sig == "#":
            held.append(node.text)
        elif id(node) in chosen or not furniture(node.sig):
            if node.tag in BLOCKS:
                yield from ended()
                todo.append(None)
            todo += reversed(node.children)
    yield from ended()


def main_text(page: str, paths: list[tuple[str, ...]]) -> str:
    """Article of a page along a host's paths; a page without them is its own host."""
    root = parsed(page)
    nodes = _reached(root, paths)
    if not nodes:
        nodes = _reached(root, text_paths(_copy(root)))
    return "\n".join(_blocks(nodes or [root]))


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, html) -> (host, wrapper): one wrapper per host, as JSON.

    Partial wrappers, one per host and task, are aligned in two steps, so that
    a host with a third of all pages is dealt to several tasks first. Each step
    streams sorted rows and holds one wrapper at a time.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, known = TaskContext.get().partitionId(), {}
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), texts(batch, "html")):
                found = _copy(parsed(page))
                known[host] = joined(known[host], found) if host in known else found
            if len(known) > 2000:
                yield rows([(h, part % 16, w) for h, w in known.items()])
                known = {}
        yield rows([(h, part % 16, w) for h, w in known.items()])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            done = []
            for host, salt, data in zip(*(batch.column(c).to_pylist() for c in ("host", "salt", "wrapper"))):
                found = read(json.loads(data))
                if held is not None and (host, salt) == last:
                    held = joined(held, found)
                else:
                    if held is not None:
                        done.append((*last, held))
                    last, held = (host, salt), found
            yield rows(done)
        if held is not None:
            yield rows([(*last, held)])

    def rows(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _, _ in found], pa.string()),
                pa.array([s for _, s, _ in found], pa.int32()),
                pa.array([json.dumps(written(w)) for _, _, w in found], pa.string()),
            ],
            ["host", "salt", "wrapper"],
        )

    schema = "host string, salt int, wrapper string"
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partial = pages.select("host", "html").mapInArrow(first, schema)
    salted = partial.repartition(n, "host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(again, schema)
    whole = salted.withColumn("salt", F.lit(0)).repartition(n, "host").sortWithinPartitions("host", "salt", "wrapper")
    return whole.mapInArrow(again, schema).select("host", "wrapper")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> page_id, url, text, n_chars: the article of every page.

    Blocks in page order, one per line; inside a block references are decoded
    and white space is one blank. A null or empty page, or one without text, has
    an empty text. A null or odd url belongs to the host ''. Rows are
    independent but for their host's wrapper: repeated rows and null ids come
    out as they went in. An empty table gives no rows.
    """
    pages = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), _host(F.col("url")).alias("host")
    )

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(text_paths(read(json.loads(w)))) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.string())], ["host", "paths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            found = []
            for page, paths in zip(texts(batch, "html"), texts(batch, "paths")):
                if paths not in known:
                    known[paths] = [tuple(p) for p in json.loads(paths or "[]")]
                found.append(main_text(page, known[paths]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    places = stored(wrappers(pages).mapInArrow(chosen, "host string, paths string"), "wrappers")
    # One narrow row per host: small enough to be sent along, or joined by host with hot hosts split.
    return (
        pages.join(places, "host", "left")
        .select("page_id", "url", "html", "paths")
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
    )
