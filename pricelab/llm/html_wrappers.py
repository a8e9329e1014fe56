"""Main text of web pages through wrappers: union-free regular expressions over the pages of a host.

A page is read into its token stream: open and close tags of structural elements (the ends that HTML implies are
filled in) and texts. Streams of one host are aligned one after the other. What matches stays; texts that differ
become slots; elements that one side lacks become optional; neighbours that repeat, alone or as a sequence of up
to ``PERIOD``, become a repeated group. The wrapper that results says of each text place whether it is always
the same on the host.

Wrappers are folded inside batches, then over at most ``FOLD`` of them at a time until each host has one, so no
task holds a host. Pages meet their host's wrapper in a join on the host (its one row; a frequent host's pages
are split by adaptive execution), are aligned with it, and give their text: first what no menu, header, footer,
sidebar, notice, advert, form or comment element holds, of that the article element, else the main element, else
the element named as content, else - where a page has no such mark - what the wrapper does not fix and links do
not fill, in the element that holds nearly all of it.
"""

from __future__ import annotations

import difflib
import html as entities
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

FOLD = 64  # wrappers of a host that one step folds
PERIOD = 4  # longest sequence of elements that counts as one repeated group
DEPTH = 64  # elements nested deeper belong to the element at this depth
ALIGN_CELLS = 250_000  # beyond this product of lengths, numpy finds the same blocks faster than difflib
FIXED_PAGES = 3  # a text is the host's, not the page's, if it is the same on at least so many pages
FRAME = 3  # fixed texts up to so many times the others are the host's frame; beyond that the pages are copies
MOST = 0.8  # share of the text that an element must hold to be taken for the article

ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+"[^"]*"|=\s*+'[^']*'|=|["'])*+"""
RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp|noscript|template|svg|canvas|object|audio|video|select"
TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<raw>{RAW})(?=[\s/>]){ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>{ATTRIBUTES})>|<[!?/][^>]*(?:>|\Z)|</?[a-z][^>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+(?:\d(?!\d))?|[A-Z]+(?![a-z])")  # a single digit may tell elements apart, a number is the page's

INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br label output meter progress".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
IGNORED = set("html body head".split())
# an element of the first set ends where another of its own set opens, up to the nearest of the second
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
SIDE_TAGS = set("nav header footer aside form button dialog menu fieldset".split())
SIDE_ROLES = set("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
SIDE_NAMES = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets ad ads adbox adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent notice notices gdpr alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended teaser comment comments commentlist respond "
    "reply replies disqus pagination pager toolbar".split()
)
LAYOUT_NAMES = set("with has no without".split())  # `layout with sidebar` is not the sidebar
COMMENT_NAMES = set("comment comments commentlist respond reply replies disqus".split())
CONTENT_NAMES = set("article articlebody content post entry story main maincontent text".split())
SIDE, ARTICLE, MAIN, CONTENT, HEADER = 1, 2, 4, 8, 16


@lru_cache(maxsize=65536)
def element_kind(tag: str, attrs: str) -> tuple[str, int]:
    """(label, marks) of an element: its tag and names without numbers, and what they say about its text."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attrs)}
    names = [w.lower() for k in ("class", "id") for w in NAME.findall(found.get(k, ""))]
    role, known = found.get("role", "").lower(), {w.rstrip("0123456789") for w in names}
    label = ".".join([tag, *dict.fromkeys(names)])
    marks = 0
    shell = tag in ("article", "main") or role in ("main", "article") or known & LAYOUT_NAMES
    if tag in SIDE_TAGS or role in SIDE_ROLES or (known & SIDE_NAMES and not shell) or known & COMMENT_NAMES:
        marks |= SIDE
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        marks |= SIDE
    if tag == "header" or (marks & SIDE and "header" in known):
        marks |= HEADER
    if tag == "article" or role == "article":
        marks |= ARTICLE
    if tag == "main" or role == "main":
        marks |= MAIN
    if known & CONTENT_NAMES or found.get("itemprop", "").lower() == "articlebody":
        marks |= CONTENT
    return label, marks


class Element:
    __slots__ = ("tag", "label", "marks", "items")

    def __init__(self, tag: str, label: str, marks: int):
        self.tag, self.label, self.marks, self.items = tag, label, marks, []


class Text:
    __slots__ = ("text", "links", "fixed")

    def __init__(self, text: str, links: int):
        self.text, self.links, self.fixed = text, links, False


def read_page(page: str) -> Element:
    """The page as a tree of structural elements; texts are decoded, white space is one space, ends trimmed."""
    root = Element("", "", 0)
    stack, parts, state = [root], [], {"anchor": False, "links": 0}

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                stack[-1].items.append(Text(text, min(state["links"], len(text))))
            parts.clear()
        state["links"] = 0

    def add(raw: str):
        if "&" in raw:
            raw = entities.unescape(raw)
        parts.append(raw)
        if state["anchor"]:
            state["links"] += len(raw)

    def pop_to(tags: set[str], stop: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag, attrs = m["tag"].lower(), m["attrs"]
        if tag == "a":
            state["anchor"] = not m["end"]
        if tag in IGNORED:
            flush()
            continue
        if m["end"]:
            if tag in INLINE and not any(e.tag == tag for e in stack):
                continue
            flush()
            if tag not in VOID:
                pop_to({tag}, set() if tag in ("table", "article", "main") else {"table"} if tag not in ("td", "th", "tr", "tbody", "thead", "tfoot") else set())
            continue
        label, marks = element_kind(tag, attrs)
        if tag in INLINE and not marks & SIDE:
            if tag in ("br", "img"):
                parts.append(" ")
            continue
        flush()
        if tag not in INLINE:
            while len(stack) > 1 and stack[-1].tag in INLINE and any(e.tag == "p" for e in stack):
                stack.pop()
            if stack[-1].tag == "p" or (tag in HEADINGS and stack[-1].tag in HEADINGS):
                stack.pop()
            if tag in CLOSES:
                pop_to(*CLOSES[tag])
        if tag in VOID or len(stack) > DEPTH:
            continue
        element = Element(tag, label, marks)
        stack[-1].items.append(element)
        stack.append(element)
    if at < len(page):
        add(page[at:])
    flush()
    return root


# A wrapper is a list of items: {"t": checksum or None, "n": pages} is a text place, {"l": label, "c": items} an
# element, {"g": items} a repeated sequence; "o" marks what some page lacks, "r" what some page repeats.


def name(item: dict) -> str:
    if "t" in item:
        return "#"
    return item["l"] if "l" in item else "(" + " ".join(map(name, item["g"])) + ")"


def key(item: dict) -> str:
    """What items must share to be one: the name and the names directly inside."""
    if "l" in item:
        return item["l"] + "[" + " ".join(sorted({name(x) for i in item["c"] for x in i.get("g", [i])})) + "]"
    return "#" if "t" in item else "(" + " ".join(map(key, item["g"])) + ")"


def stream_of(element: Element) -> list[dict]:
    """A page as a wrapper of one page."""
    out = []
    for x in element.items:
        if isinstance(x, Text):
            out.append({"t": zlib.crc32(x.text.encode()) << 32 | zlib.adler32(x.text.encode()), "n": 1})
        else:
            out.append({"l": x.label, "c": stream_of(x)})
    return folded(out, 1)


def united(a: dict, b: dict, across: int) -> dict:
    """Two items of one key as one; ``across`` is 1 if they are of one page (repeats), 0 if of two."""
    out = {k: 1 for k in ("o", "r") if a.get(k) or b.get(k)}
    if "t" in a:
        return out | {"t": a["t"] if a["t"] == b["t"] else None, "n": max(a["n"], b["n"]) if across else a["n"] + b["n"]}
    if "l" in a:
        return out | {"l": a["l"], "c": aligned(a["c"], b["c"], across)}
    return out | {"g": [united(x, y, across) for x, y in zip(a["g"], b["g"])]}


def folded(items: list[dict], across: int) -> list[dict]:
    """Equal neighbours, and then sequences that repeat at once, as repeated items."""
    out: list[dict] = []
    for x in items:
        if out and key(out[-1]) == key(x):
            out[-1] = united(out[-1], x, across) | {"r": 1}
        else:
            out.append(x)
    for period in range(2, PERIOD + 1):
        keys, done, i = [key(x) for x in out], [], 0
        while i < len(out):
            group, j = None, i
            while j + 2 * period <= len(out) and keys[j : j + period] == keys[j + period : j + 2 * period]:
                group = group or {"g": out[i : i + period]}
                group = united(group, {"g": out[j + period : j + 2 * period]}, across) | {"r": 1}
                j += period
            done.append(group or out[i])
            i = j + period if group else i + 1
        out = done
    return out


def grouped(items: list[dict], groups: list[dict]) -> list[dict]:
    """Sequences that the other side knows as a repeated group, as that group met once."""
    for g in groups:
        want, out, i = [key(x) for x in g["g"]], [], 0
        while i < len(items):
            if [key(x) for x in items[i : i + len(want)]] == want:
                out.append({"g": items[i : i + len(want)]})
                i += len(want)
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal keys, rising on both sides: the longest common block (of these the first in ``a``,
    then in ``b``), and so again before and after it. Both ways to find the blocks give the same ones."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    if len(a) * len(b) <= ALIGN_CELLS:
        blocks = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
        return [(x + i, y + i) for x, y, n in blocks for i in range(n)]
    return long_matches(a, b)


def long_matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The blocks of ``difflib`` for long sequences: a row of lengths at a time in numpy, and a search ends with the
    first block that is as long as the longest around it, as none inside can be longer."""
    places: dict[str, list[int]] = {}
    for j, k in enumerate(b):
        places.setdefault(k, []).append(j)
    at = {k: np.array(v) for k, v in places.items()}
    none = np.zeros(0, np.int64)
    rows = [at.get(k, none) for k in a]
    ending = np.zeros((2, len(b) + 1), np.int64)  # [j + 1]: length of the block that ends at b[j]; zero between searches
    out, open_ = [], [(0, len(a), 0, len(b), min(len(a), len(b)))]
    while open_:
        low, high, left, right, most = open_.pop()
        most = min(most, high - low, right - left)
        if most < 1:
            continue
        n = x = y = 0
        before, now, old = ending[0], ending[1], none
        for i in range(low, high):
            js = rows[i]
            if len(js) and (js[0] < left or js[-1] >= right):
                js = js[np.searchsorted(js, left) : np.searchsorted(js, right)]
            if not len(js) and not len(old):
                continue
            sizes = before[js] + 1
            now[js + 1] = sizes
            before[old] = 0
            old, before, now = js + 1, now, before
            if len(js) and (longest := int(sizes.max())) > n:
                j = int(js[int(sizes.argmax())])
                n, x, y = longest, i - longest + 1, j - longest + 1
                if n == most:
                    break
        before[old] = 0
        if n:
            out += [(x + i, y + i) for i in range(n)]
            open_ += [(low, x, left, y, n), (x + n, high, y + n, right, n)]
    return sorted(out)


def pairs_of(a: list[dict], b: list[dict]) -> list[tuple[int, int]]:
    """Positions to unite: items of one key, and between these items of one name."""
    out, i, j = [], 0, 0
    for x, y in [*matches([key(x) for x in a], [key(x) for x in b]), (len(a), len(b))]:
        if x > i and y > j:
            out += [(i + u, j + v) for u, v in matches([name(z) for z in a[i:x]], [name(z) for z in b[j:y]])]
        if x < len(a):
            out.append((x, y))
        i, j = x + 1, y + 1
    return out


def aligned(a: list[dict], b: list[dict], across: int = 0) -> list[dict]:
    """The wrapper of both: matching items united, the others optional, repeats folded."""
    a, b = grouped(a, [x for x in b if "g" in x]), grouped(b, [x for x in a if "g" in x])
    out, i, j = [], 0, 0
    for x, y in [*pairs_of(a, b), (len(a), len(b))]:
        out += [item | {"o": 1} for item in a[i:x]] + [item | {"o": 1} for item in b[j:y]]
        if x < len(a):
            out.append(united(a[x], b[y], across))
        i, j = x + 1, y + 1
    return folded(out, across)


def mark_fixed(element: Element, wrapper: list[dict]) -> None:
    """Mark the texts of a page whose place in the wrapper has one text on several pages."""
    places: dict[str, list[tuple[int, int, dict]]] = {}  # (position, where to go on after it, item)
    at = 0
    for outer in wrapper:
        inner, first = outer.get("g", [outer]), at
        for item in inner:
            again = first if "g" in outer else at if item.get("r") else at + 1
            for k in {key(item), name(item)}:
                places.setdefault(k, []).append((at, again, item))
            at += 1
    low = 0
    for x in element.items:
        if isinstance(x, Text):
            k = label = "#"
        else:
            k, label = key({"l": x.label, "c": [{"t": 0} if isinstance(y, Text) else {"l": y.label, "c": []} for y in x.items]}), x.label
        found = next((p for n in (k, label) for p in places.get(n, ()) if p[0] >= low), None)
        if found is None:
            continue
        low = found[1]
        if isinstance(x, Element):
            mark_fixed(x, found[2]["c"])
        else:
            x.fixed = found[2]["t"] is not None and found[2]["n"] >= FIXED_PAGES


def main_texts(root: Element) -> list[str]:
    """The blocks of the article in page order."""
    rows: list[tuple[Text, tuple[Element, ...]]] = []

    def walk(element: Element, path: tuple[Element, ...], side: bool, article: bool):
        for x in element.items:
            if isinstance(x, Text):
                if not side:
                    rows.append((x, path))
            elif x.marks & HEADER and article and not side:
                walk_heads(x, (*path, x))
            else:
                walk(x, (*path, x), side or bool(x.marks & SIDE), article or bool(x.marks & (ARTICLE | MAIN)))

    def walk_heads(element: Element, path: tuple[Element, ...]):
        """An article's own header gives its headings."""
        for x in element.items:
            if isinstance(x, Element):
                if x.tag in HEADINGS:
                    walk(x, (*path, x), False, True)
                else:
                    walk_heads(x, (*path, x))

    walk(root, (), False, False)
    for mark in (ARTICLE, MAIN):
        inside = [(t, p) for t, p in rows if any(e.marks & mark for e in p)]
        if mark == ARTICLE and any(e.marks & MAIN for _, p in inside for e in p):
            inside = [(t, p) for t, p in inside if any(e.marks & MAIN for e in p)]
        if inside:
            return [t.text for t, _ in inside]
    held: dict[int, int] = {}
    for t, p in rows:
        for e in p:
            if e.marks & CONTENT:
                held[id(e)] = held.get(id(e), 0) + len(t.text) - t.links
    if held and max(held.values()) > 0:
        best = max(held, key=held.get)  # the first of equals is the outermost
        return [t.text for t, p in rows if any(id(e) == best for e in p)]
    free = [(t, p) for t, p in rows if not t.fixed]
    if FRAME * sum(len(t.text) for t, _ in free) >= sum(len(t.text) for t, _ in rows if t.fixed):
        rows = free
    rows = [(t, p) for t, p in rows if 2 * t.links <= len(t.text)]
    depth = 0
    while rows:
        total, inner = sum(len(t.text) for t, _ in rows), {}
        for t, p in rows:
            if len(p) > depth:
                inner.setdefault(id(p[depth]), []).append((t, p))
        best = max(inner.values(), key=lambda v: sum(len(t.text) for t, _ in v), default=[])
        block = best and best[0][1][depth].tag in ("p", "li", "td", "th", "tr", "dd", "dt", "blockquote", "pre", *HEADINGS)
        if not best or block or sum(len(t.text) for t, _ in best) < MOST * total:
            break
        rows, depth = best, depth + 1
    return [t.text for t, _ in rows]


def fold_all(wrappers: list[list[dict]]) -> list[dict]:
    out = wrappers[0]
    for w in wrappers[1:]:
        out = aligned(out, w)
    return out


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one row per host, from (host, html)."""

    def first(batches):
        for batch in batches:
            found: dict[str, list[dict]] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stream = stream_of(read_page(html))
                found[host] = aligned(found[host], stream) if host in found else stream
            yield record(found)

    def record(found):
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([json.dumps(w, separators=(",", ":")) for w in found.values()], pa.string())], ["host", "wrapper"])

    def fold(batches):
        now, held = None, []
        for batch in batches:
            done = {}
            for host, part, wrapper in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if now != (host, part) and now is not None:
                    done[now] = fold_all(held)
                    held = []
                now = (host, part)
                held.append(json.loads(wrapper))
            yield listed(done)
        if now is not None:
            yield listed({now: fold_all(held)})

    def listed(done):
        return pa.RecordBatch.from_arrays([pa.array([h for h, _ in done], pa.string()), pa.array([json.dumps(w, separators=(",", ":")) for w in done.values()], pa.string())], ["host", "wrapper"])

    now = staged(pages.mapInArrow(first, "host string, wrapper string"), "wrappers")
    while True:
        most = now.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return now
        parts = -(-most // FOLD)
        dealt = now.withColumn("part", F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(parts)) if parts > 1 else F.lit(0).cast("long"))
        dealt = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper").select("host", "part", "wrapper")
        now = staged(dealt.mapInArrow(fold, "host string, wrapper string"), "wrappers")


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null and empty html gives an empty text; so does a page that has nothing but menus and the like. Pages
    without a host in their url are read without a wrapper. Repeated rows, null ids and null urls are rows of
    their own, further columns are ignored, an empty table gives an empty result. White space is what Python's
    ``split`` takes for it; a line break element inside a block is white space. Character references are decoded
    once. Broken mark-up is read to its end: unclosed elements end with their parent, an unclosed tag at the end
    of a page is dropped."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\\\s]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    wrappers = host_wrappers(rows.where("host <> '' and html <> ''").select("host", "html"))
    met = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batches):
        last, wrapper = None, []
        for batch in batches:
            texts = []
            for html, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                page = read_page(html)
                if packed is not None:
                    if packed != last:
                        last, wrapper = packed, json.loads(packed)
                    mark_fixed(page, wrapper)
                texts.append("\n".join(main_texts(page)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(met.dtypes)
    return met.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
