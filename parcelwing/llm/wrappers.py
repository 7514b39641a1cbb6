"""Main text of web pages by wrapper induction.

Pages of one host are aligned node by node with simple tree matching. A node
that all pages fill with the same text is template; a slot that varies may be
content. Menus, notices and the like vary too, so slots inside elements that
HTML or their class names mark as such never count as content.

Sibling nodes with the same label are one slot of the tree. Each task merges the
pages of a host into one wrapper, the wrappers of the tasks are merged per host,
so a host with a third of all pages sends one small tree per task.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, stored

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select")
INLINE = frozenset((
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr").split())
ENDS_PARAGRAPH = frozenset((
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul").split())
BOILERPLATE = frozenset("nav header footer aside form button head menu dialog input".split())
MAIN = ("article", "main")
# fixed values: words in class and id that mark what is not the article
MARKED = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer footer header legal login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion related replies reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget").split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
SURE_AFTER = 8     # pages that must agree before an unvarying node inside the article counts as template

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_CUT = re.compile(r"<[a-zA-Z/!][^>]*\Z")     # a tag that the end of the page cuts
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")     # one whole, so no value is a name
_NAME = re.compile(r"[a-z]+", re.I)


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """Node label and whether the element is marked as something else than the article."""
    label, other = tag, tag in BOILERPLATE
    if attributes and ("=" in attributes or "hidden" in attributes):
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("class", "id"):
                label += "." + re.sub(r"\d+", "0", value.strip())
                other |= any(part.lower() in MARKED for part in _NAME.findall(value)) and tag not in ("body", "html", *MAIN)
            elif name == "role":
                other |= value.lower() in ROLES
            elif name in ("hidden", "aria-hidden"):
                other |= name == "hidden" or value.lower() == "true"
    return label, other


def parse(page: str) -> list[tuple[str, bool, bool, str]]:
    """Blocks (path, boilerplate, inside the article, text) of a page, in order.

    Unclosed and stray tags are taken as browsers do: a paragraph ends where a
    block begins, list items and cells end at the next, the rest closes with its
    parent. Markup inside a block leaves its text; white space becomes one space.
    """
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]   # tag, path, boilerplate, in the article
    blocks: list[tuple[str, bool, bool, str]] = []
    held: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            _, path, other, inside = stack[-1]
            blocks.append((path, other, inside, text))

    def close(upto: int) -> None:
        if len(stack) > upto:
            flush()
            del stack[upto:]

    def find(*tags: str, stop: tuple[str, ...] = ()) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                return k
            if stack[k][0] in stop:
                return 0
        return 0

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            held.append(page[at:token.start()])
        at = token.end()
        tag = token.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if token.group(2):
            if tag in INLINE:
                continue
            if k := find(tag):
                close(k)
            continue
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            continue
        flush()
        if tag in ENDS_PARAGRAPH and (k := find("p", stop=("td", "th", "button"))):
            close(k)
        if tag == "li" and (k := find("li", stop=("ul", "ol", "menu"))):
            close(k)
        elif tag in ("dt", "dd") and (k := find("dt", "dd", stop=("dl",))):
            close(k)
        elif tag in ("td", "th", "tr") and (k := find(*(("td", "th") if tag != "tr" else ("tr",)), stop=("table",))):
            close(k)
        elif tag == "body" and (k := find("head")):
            close(k)
        label, other = _label(tag, token.group(4))
        if tag in VOID:
            continue
        _, path, above, inside = stack[-1]
        marked = other and not (tag == "header" and inside)
        stack.append((tag, f"{path}/{label}", above or marked, inside or tag in MAIN))
    held.append(_CUT.sub("", page[at:]))
    flush()
    return blocks


# -- wrappers ----------------------------------------------------------------
# a node is [label, pages, text checksum or None when it varies, children]

def page_tree(blocks: list[tuple[str, bool, bool, str]]) -> list:
    """Tree of the paths that hold text, in order of first sight, with a checksum of each slot's text."""
    root: list = ["", 1, 0, []]
    sums: dict[int, int] = {}
    for path, _, _, text in blocks:
        node = root
        for label in path.split("/")[1:]:
            node = next((c for c in node[3] if c[0] == label), None) or node[3].append([label, 1, 0, []]) or node[3][-1]
        sums[id(node)] = zlib.crc32(text.encode("utf-8", "replace"), sums.get(id(node), 0))
        node[2] = sums[id(node)]
    return root


def match(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: size of the best ordered matching of two trees, and the matched children."""
    if a[0] != b[0]:
        return 0, []
    x, y = a[3], b[3]
    if [c[0] for c in x] == [c[0] for c in y]:
        return 1 + sum(match(c, d)[0] for c, d in zip(x, y)), [(k, k) for k in range(len(x))]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, c in enumerate(x):
        for j, d in enumerate(y):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + match(c, d)[0])
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return 1 + best[-1][-1], pairs[::-1]


def merge(a: list, b: list) -> list:
    """Wrapper of two aligned trees: matched nodes vary if their texts differ, others are optional."""
    _, pairs = match(a, b)
    children, i, j = [], 0, 0
    for k, m in [*pairs, (len(a[3]), len(b[3]))]:
        children += a[3][i:k] + b[3][j:m]
        if k < len(a[3]) and m < len(b[3]):
            children.append(merge(a[3][k], b[3][m]))
        i, j = k + 1, m + 1
    once: dict[str, list] = {}
    for child in children:      # an unmatched node may stand on both sides of a match
        held = once.get(child[0])
        once[child[0]] = child if held is None else merge(held, child)
    return [a[0], a[1] + b[1], a[2] if a[2] == b[2] else None, list(once.values())]


def unvarying(wrapper: list) -> set[str]:
    """Paths of the slots that every page with them fills with the same text, on SURE_AFTER pages or more."""
    out: set[str] = set()

    def walk(node: list, path: str) -> None:
        if node[2] and node[1] >= SURE_AFTER:
            out.add(path)
        for child in node[3]:
            walk(child, f"{path}/{child[0]}")

    walk(wrapper, "")
    return out


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parsed blocks of each page, as columns that the next passes read."""
    kind = pa.list_(pa.struct([("path", pa.string()), ("other", pa.bool_()), ("inside", pa.bool_()), ("text", pa.string())]))
    for batch in bounded(batches, "html", 4 << 20):
        rows = [[{"path": p, "other": o, "inside": i, "text": t} for p, o, i, t in parse(page or "")]
                for page in batch.column("html").to_pylist()]
        names = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(rows, kind)],
                                         names=[*names, "blocks"])


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of this task. Pages whose article is the same text count once."""
    wrappers: dict[str, list] = {}
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        for host, blocks in zip(batch.column("host").to_pylist(), batch.column("blocks").to_pylist()):
            rows = [(b["path"], b["other"], b["inside"], b["text"]) for b in blocks]
            article = zlib.crc32("\n".join(t for _, other, _, t in rows if not other).encode("utf-8", "replace"))
            if (host, article) in seen:
                continue
            seen.add((host, article))
            tree = page_tree(rows)
            wrappers[host] = merge(wrappers[host], tree) if host in wrappers else tree
        if len(seen) > 200_000:
            seen.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(wrappers), pa.string()),
                                      pa.array([json.dumps(w) for w in wrappers.values()], pa.string())],
                                     names=["host", "wrapper"])


def _join_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the wrappers of each host; rows are sorted by host."""
    host, held = None, None
    for batch in batches:
        for name, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            tree = json.loads(text)
            if name == host:
                held = merge(held, tree)
                continue
            if held is not None:
                yield _slots(host, held)
            host, held = name, tree
    if held is not None:
        yield _slots(host, held)


def _slots(host: str, wrapper: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([host]), pa.array([sorted(unvarying(wrapper))], pa.list_(pa.string()))],
                                      names=["host", "template"])


def main_text(blocks: list[dict], template: set[str]) -> str:
    """Blocks of the content slots, joined by line feeds.

    If the page has an article, only what stands in it counts. If every block
    that is left is template (pages that are copies of one another), there is
    nothing to tell it from, and all of them count.
    """
    left = [b for b in blocks if not b["other"]]
    inside = [b for b in left if b["inside"]]
    left = inside or left
    varying = [b for b in left if b["path"] not in template]
    return "\n".join(b["text"] for b in (varying or left))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(blocks or [], set(template or ()))
                 for blocks, template in zip(batch.column("blocks").to_pylist(), batch.column("template").to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages(page_id, url, html).

    A null or empty page has an empty text. Pages without a host in their url
    form one host. Rows repeat as they came; other columns are not looked at.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        host.alias("host"), "html")
    kind = "array<struct<path: string, other: boolean, inside: boolean, text: string>>"
    parsed = stored(base.mapInArrow(_prepare, f"page_id long, url string, host string, blocks {kind}"), "blocks")
    parts = parsed.select("host", "blocks").mapInArrow(_induce, "host string, wrapper string")
    dealt = parts.repartition("host").sortWithinPartitions("host")
    templates = stored(dealt.mapInArrow(_join_wrappers, "host string, template array<string>"), "templates")
    joined = parsed.join(templates, "host", "left").select("page_id", "url", "blocks", "template")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
