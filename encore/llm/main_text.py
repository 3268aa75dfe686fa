"""Main text of web pages by tag-path ratios.

A page is cut into blocks: stretches of text without a block element's tag between
them, each under the path of elements (with class and id) from the root to it.  For every
path of a page the text length, the marks of punctuation and the text inside links are
summed over its blocks.  Length per block and marks per block are smoothed over
neighbouring blocks, fused to one number with the share of text outside links, and
paths whose number reaches a share of the page's mean (weighted by length) are content.

Elements that never hold the article (menus, forms, scripts, hidden parts and the like, by
tag, role, or a word in class or id) have no blocks.  The content nodes are

* where the page marks its article (``article``, ``main``) and content paths put at least
  half of their text there: all blocks of that element,
* otherwise the blocks of content paths and all blocks of elements most of whose text is
  on content paths, so that a short paragraph or heading stays with its neighbours;

in both cases without the blocks of paths that are mostly links in lists.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by one space in page order.  Nothing else is dropped and nothing is cut.

The sums are taken with numpy over many pages at a time; a page is judged by itself, so
the operator is a narrow transformation that hot hosts cannot skew.

Edge cases: a null or empty page has an empty text, as has a page without content; markup is
read as browsers do where it is broken (elements left open, stray end tags, comments and
scripts without an end, which reach to the end of the page); rows are handled one by one:
repeated rows and null ids are kept; other columns are dropped but for those named in ``keep``.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the page's mean from which a path is content.
LEAST = 0.25
#: Weights of a block and of its neighbours when ratios are smoothed.
KERNEL = (0.1, 0.2, 0.4, 0.2, 0.1)
#: Characters of pages whose blocks are in memory at a time (a longer page is alone).
BATCH_CHARS = 4_000_000

# --- fixed values: element names of HTML and words that name parts of pages ---------------
_RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var img input picture wbr".split())
_DROPPED = frozenset(
    "nav header footer aside form head button select option dialog menu noscript template svg canvas object audio video "
    "map fieldset label datalist math applet frameset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_PARTS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup nav navbar navigation menu menus "
    "breadcrumb breadcrumbs pagination pager header masthead topbar footer bottombar sidebar sidenav aside widget widgets related "
    "recommended recommendations share sharing social comment comments commentlist disqus respond reply replies login search "
    "searchform toolbar skip copyright disclaimer hidden form".split())
_MARKS = re.compile(r"[.,;:!?…。，、；：！？]")
# -----------------------------------------------------------------------------------------

_TAG = re.compile(r"""<!--(?:-?>|.*?--!?>|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
                  re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: A start tag of the key closes an open element of these, up to the nearest of the second set.
_CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
_TABLE = frozenset({"table", "html", "td", "th", "button", "object"})


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}


def _kind(tag: str, rest: str) -> tuple[str, str]:
    """The element's name in paths, and ``drop``, ``article``, ``main`` or nothing."""
    if not rest.strip(" \t\r\n/"):
        return tag, "drop" if tag in _DROPPED else tag if tag in ("article", "main") else ""
    at = _attributes(rest)
    names = f"{at.get('class', '')} {at.get('id', '')}"
    label = tag + "".join(f".{w}" for w in names.split())
    role = at.get("role", "").lower()
    if (tag in _DROPPED or role in _ROLES or "hidden" in at or at.get("aria-hidden", "").lower() == "true"
            or _NOT_SHOWN.search(at.get("style", ""))):
        return label, "drop"
    if tag not in ("html", "body", "main"):
        for name in names.split():
            words = [w.lower() for w in _WORD.findall(name)] + re.findall("[a-z]+", name.lower())
            # "has-sidebar" or "no-ads" speaks of another element
            if words and words[0] not in ("has", "no", "with", "without", "not") and not _PARTS.isdisjoint(words):
                return label, "drop"
    if tag in ("article", "main") or role in ("article", "main") or at.get("itemprop", "").lower() == "articlebody":
        return label, "main" if tag == "main" or role == "main" else "article"
    return label, ""


class _Page:
    """Blocks of one page: text, path, element, characters in all and in links, marks."""

    def __init__(self, source: str, kinds: dict):
        self.texts: list[str] = []
        self.path: list[int] = []
        self.node: list[int] = []
        self.chars: list[int] = []
        self.linked: list[int] = []
        self.marks: list[int] = []
        self.parent = [-1]  # per element that is no inline one
        self.kind = [""]
        self.paths: dict[tuple[int, str], int] = {}
        self.list_path = [False]  # per path: whether a list item is on it
        self._read(source, kinds)

    def _read(self, source: str, kinds: dict) -> None:
        # open elements: name, node, path, whether it is dropped, whether it is in an article
        stack: list[tuple[str, int, int, bool, bool]] = [("", 0, 0, False, False)]
        opened: dict[str, int] = defaultdict(int)  # open elements by name, so that no search is in vain
        held: list[str] = []
        link_at = 0  # depth of the stack at an open link, 0: none
        linked = 0
        at, size = 0, len(source)

        def flush() -> None:
            nonlocal linked
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                top = stack[-1]
                self.texts.append(text)
                self.path.append(top[2])
                self.node.append(top[1])
                self.chars.append(len(text))
                self.linked.append(min(linked, len(text)))
                self.marks.append(len(_MARKS.findall(text)))
            linked = 0

        def close(index: int) -> None:
            nonlocal link_at
            flush()
            for e in stack[index:]:
                opened[e[0]] -= 1
            del stack[index:]
            if link_at > len(stack):
                link_at = 0

        while at < size:
            m = _TAG.search(source, at)
            piece = source[at:m.start() if m else size]
            if m is None:  # a tag that the page's end cuts off is no text
                cut = re.search(r"<[a-zA-Z/!][^<>]*\Z", piece)
                piece = piece[:cut.start()] if cut else piece
            if piece and not stack[-1][3]:
                if "&" in piece:
                    piece = html.unescape(piece)
                held.append(piece)
                if link_at:
                    linked += len(piece.strip())
            if m is None:
                break
            at = m.end()
            end, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag in _INLINE:
                if tag == "a":
                    link_at = 0 if end else len(stack)
                continue
            if end:
                if tag == "br":
                    held.append(" ")
                    continue
                for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if stack[k][0] == tag:
                        close(k)
                        break
                continue
            if tag in _RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                at = stop.end() if stop else size
                if tag in ("title", "textarea", "iframe"):
                    flush()
                continue
            if tag in _VOID:
                if tag == "hr":
                    flush()
                held.append(" ")
                continue
            # elements the start tag closes
            shut, stops = _CLOSES.get(tag, (frozenset(), _TABLE))
            for k in range(len(stack) - 1, 0, -1) if opened["p"] or any(opened[t] for t in shut) else ():
                name = stack[k][0]
                if name in shut or name == "p":
                    close(k)
                elif name in stops:
                    break
            flush()
            key = (tag, rest)
            if (found := kinds.get(key)) is None:
                if len(kinds) > 20_000:
                    kinds.clear()
                found = kinds[key] = _kind(tag, rest)
            label, kind = found
            over = stack[-1]
            if over[4] and (kind == "article" or (kind == "drop" and label == "header")):
                kind = ""  # a part, or the heading, of an article
            number = len(self.parent)
            self.parent.append(over[1])
            self.kind.append(kind)
            step = (over[2], label)
            path = self.paths.get(step)
            if path is None:
                path = self.paths[step] = len(self.list_path)
                self.list_path.append(self.list_path[over[2]] or tag == "li")
            opened[tag] += 1
            stack.append((tag, number, path, over[3] or kind == "drop", over[4] or kind == "article"))
        flush()


def _smooth(values: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Weighted means of each block's value and its neighbours' on the same page."""
    out, weight = np.zeros(len(values)), np.zeros(len(values))
    half = len(KERNEL) // 2
    for shift, w in zip(range(-half, half + 1), KERNEL, strict=True):
        a, b = max(0, -shift), len(values) - max(0, shift)
        if a < b:
            same = page[a:b] == page[a + shift:b + shift]
            out[a:b] += np.where(same, w * values[a + shift:b + shift], 0)
            weight[a:b] += np.where(same, w, 0)
    return out / np.maximum(weight, 1e-12)


def path_ratios(page: np.ndarray, path: np.ndarray, chars: np.ndarray, linked: np.ndarray, marks: np.ndarray,
                n_paths: int) -> tuple[np.ndarray, np.ndarray]:
    """Of blocks of many pages in order (``path`` counts over all pages): which paths are content, and
    each path's share of text in links."""
    sums = lambda w: np.bincount(path, w, n_paths)
    blocks = np.maximum(np.bincount(path, minlength=n_paths), 1)
    total = sums(chars)
    in_links = sums(linked) / np.maximum(total, 1)
    length, mark = total / blocks, sums(marks) / blocks
    fused = _smooth(length[path], page) * (0.5 + _smooth(mark[path], page)) * (1 - in_links[path])
    ratio = sums(fused) / blocks
    n_pages = int(page.max(initial=-1)) + 1
    mean = np.bincount(page, fused * chars, n_pages) / np.maximum(np.bincount(page, chars, n_pages), 1)
    of = np.zeros(n_paths, np.int64)
    of[path] = page
    content = (ratio > 0) & (ratio >= LEAST * mean[of]) if n_pages else np.zeros(n_paths, bool)
    return content, in_links


def _chosen(p: _Page, content: np.ndarray, in_links: np.ndarray) -> list[str]:
    """The texts of the page's content nodes, in order."""
    n = len(p.texts)
    node, path, chars = np.array(p.node, np.int64), np.array(p.path, np.int64), np.array(p.chars, np.int64)
    good = content[path]
    if not good.any():
        return []
    all_in, good_in = (np.bincount(node, w, len(p.parent)).tolist() for w in (chars, chars * good))
    for k in range(len(p.parent) - 1, 0, -1):  # elements come after the ones they are in
        all_in[p.parent[k]] += all_in[k]
        good_in[p.parent[k]] += good_in[k]
    menu = in_links[path] > 0.5
    menu &= np.array([p.list_path[k] for k in p.path])
    marked = [k for k, kind in enumerate(p.kind) if kind in ("article", "main")]
    best = max(marked, key=lambda k: (p.kind[k] == "article", good_in[k])) if marked else 0
    if marked and good_in[best] < 0.5 * good_in[0]:
        best = max(marked, key=lambda k: good_in[k])
    inside = [False] * len(p.parent)
    if marked and good_in[best] >= 0.5 * good_in[0]:
        inside[best] = True
        for k in range(best + 1, len(p.parent)):
            inside[k] = inside[p.parent[k]]
        return [p.texts[k] for k in range(n) if inside[p.node[k]] and not menu[k]]
    # elements of the page's outer frame hold everything, so they say nothing
    frame = {0}
    for k in range(1, len(p.parent)):
        if p.parent[k] in frame and all_in[k] == all_in[0]:
            frame.add(k)
    for k in range(1, len(p.parent)):
        inside[k] = inside[p.parent[k]] or (k not in frame and 2 * good_in[k] >= all_in[k] > 0)
    return [p.texts[k] for k in range(n) if (good[k] or inside[p.node[k]]) and not menu[k]]


def page_texts(sources: Sequence[str | None]) -> list[str]:
    """The main text of each page."""
    kinds: dict = {}
    pages = [_Page(s or "", kinds) for s in sources]
    count = np.array([len(p.texts) for p in pages], np.int64)
    n_paths = np.array([len(p.list_path) for p in pages], np.int64)
    first = np.cumsum(n_paths) - n_paths
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    page = np.repeat(np.arange(len(pages)), count)
    content, in_links = path_ratios(page, flat("path") + first[page], flat("chars"), flat("linked"), flat("marks"), int(n_paths.sum()))
    return [" ".join(_chosen(p, content[a:a + n], in_links[a:a + n]))
            for p, a, n in zip(pages, first.tolist(), n_paths.tolist(), strict=True)]


def extract_main_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: Sequence[str] = ("url",)) -> DataFrame:
    """The id, the columns in ``keep``, ``text`` and ``n_chars`` (its code points), for every row."""
    source = df.select(F.col(id_col).alias("id"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)),
                       F.col(html_col).cast("string").alias("html"))
    names = source.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(len(names))), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + BATCH_CHARS)))
                part = batch.slice(at, end - at)
                texts = page_texts(part.column(len(names)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*names, "text", "n_chars"])
                at = end

    schema = source.drop("html").schema.add("text", "string").add("n_chars", "long")
    out = source.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "text", "n_chars")
