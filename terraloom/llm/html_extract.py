"""Main text of web pages by wrapper induction over aligned trees of pages of one host."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.frames import BATCH_CHARS, by_characters, map_texts
from terraloom.session import checkpointed

#: Pages of a host that layouts are founded on in one round: those with the smallest hashes of all that have none yet.
PAGES = 6
#: Wider nodes are aligned without a full table, by halving; the pairs are the same.
WIDE = 400
#: A text at the same aligned place in all pages of a layout is template; of only two pages, if no article or main has it.
LEAST_PAGES = 3
#: Pages are of one layout if at least this share of the smaller one's nodes is matched.
LAYOUT_SHARE = 0.5
#: What a row of `tallies` is about: a section, a layout, that texts of a layout vary, or a page that has no layout yet.
SECTION, LAYOUT, VARIES, LEFT = range(4)
#: Parts that a host's pages are ranked in first, and that hosts are salted with where wrappers can't be broadcast.
SPREAD = 64
#: Rows of page hashes, and bytes of wrappers or founding pages, that are broadcast at most.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20

#: Where a tag, a comment or a declaration may begin; a tag in which quotes after = may hold a >; and one in which not.
#: Both are matched without going back, so a page is read in time linear in its length.
BEGIN = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp".split())
BLOCK = frozenset("address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("article aside body div footer form header main nav section table ul ol dl blockquote html fieldset figure".split())
ASIDE = frozenset("nav footer aside form head button select menu dialog object figure.ad".split()) | RAW
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer related share sharing social comment comments reply replies disqus widget toolbar pagination pager".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())


def squeezed(text: str) -> str:
    """White space inside is one space, that at the ends is none."""
    return " ".join(text.split())


class Node:
    __slots__ = ("children", "inner", "name", "outside", "plain", "tag")

    def __init__(self, tag: str, name: str, outside: bool) -> None:
        self.tag, self.name, self.outside = tag, name, outside
        self.children: list = []
        self.inner: list | None = None
        self.plain: tuple | None = None


def _node(tag: str, raw: str, in_article: bool) -> Node:
    if not raw.strip(" /"):
        return Node(tag, tag, tag in ASIDE or (tag == "header" and not in_article))
    attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)}
    words = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    outside = (
        tag in ASIDE
        or (tag == "header" and not in_article)
        or (tag not in ("html", "body", "article", "main") and not ASIDE_NAMES.isdisjoint(re.split(r"[\s_-]+", words)))
        or attributes.get("role", "").lower() in ASIDE_ROLES
        or attributes.get("aria-hidden", "").lower() == "true"
        or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", raw)) is not None
        or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    )
    return Node(tag, f"{tag}.{attributes.get('class', '')}", outside)


def tags_of(page: str):
    """(start, end, match or None) of each tag, comment and declaration. What is left open at the end of a page is text if
    it is a tag, and nothing if it is a comment; after a tag whose quotes do not close, quotes mean nothing any more."""
    at, pattern = 0, TAG
    while True:
        m = BEGIN.search(page, at)
        if not m:
            return
        start = m.start()
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, None
        elif page[start + 1] in "!?":
            end = page.find(">", start)
            at = end + 1 if end >= 0 else len(page)
            yield start, at, None
        else:
            tag = pattern.match(page, start)
            if not tag and pattern is TAG:
                pattern = PLAIN_TAG
                tag = pattern.match(page, start)
            if not tag:
                return
            to = yield start, tag.end(), tag
            at = tag.end() if to is None else to


def parse(page: str) -> Node:
    """A tree of elements and decoded texts. Broken markup never fails: what is left open ends with its parent."""
    root = Node("#", "#", False)
    stack, at, articles = [root], 0, 0
    opened: Counter = Counter()

    def close(i: int) -> None:
        nonlocal articles
        for n in stack[i:]:
            opened[n.tag] -= 1
            articles -= n.tag in ("article", "main")
        del stack[i:]

    scan = tags_of(page)
    found = next(scan, None)
    while found:
        start, end, m = found
        if start > at:
            stack[-1].children.append(html.unescape(page[at:start]))
        at = end
        skip = None
        if m and m[1]:
            tag = m[2].lower()
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in HOLDS and tag not in HOLDS:
                    break
        elif m:
            tag = m[2].lower()
            closes = CLOSES.get(tag, ())
            if tag in BLOCK and (opened["p"] or any(opened[t] for t in closes)):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p" or stack[i].tag in closes:
                        close(i)
                        if not (opened["p"] or any(opened[t] for t in closes)):
                            break
                    elif stack[i].tag in HOLDS:
                        break
            elif tag in CLOSES and stack[-1].tag in closes:
                close(len(stack) - 1)
            node = _node(tag, m[3], articles > 0)
            stack[-1].children.append(node)
            if tag in RAW:
                last = re.compile(rf"</{re.escape(tag)}", re.I).search(page, at)
                stop = page.find(">", last.end()) if last else -1
                skip = at = stop + 1 if stop >= 0 else len(page)
            elif tag not in VOID and not m[3].rstrip().endswith("/"):
                stack.append(node)
                opened[tag] += 1
                articles += tag in ("article", "main")
        try:
            found = scan.send(skip)
        except StopIteration:
            found = None
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def down(path: int, name: str) -> int:
    """The digest of a path and one more name: paths take the same room however deep they are."""
    return xxhash.xxh64_intdigest(name.encode("utf-8", "replace"), path)


def entry_of(path: int, text: str) -> int:
    """The digest, as a signed number, of a text at a path."""
    return (down(path, text) ^ (1 << 63)) - (1 << 63)


def texts_of(root: Node) -> list[tuple[int, str]]:
    """(path, text) of each text that isn't blank and not in a part that is marked as no content."""
    out: list[tuple[int, str]] = []
    todo: list = [(root, 0)]
    while todo:
        node, path = todo.pop()
        if isinstance(node, str):
            if node.strip():
                out.append((path, squeezed(node)))
        elif not node.outside:
            path = down(path, node.name)
            todo += [(c, path) for c in reversed(node.children)]
    return out


def has_article(root: Node) -> bool:
    """Whether an article or main part that is content has a text."""
    todo: list = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if isinstance(node, str):
            if inside and node.strip():
                return True
        elif not node.outside:
            todo += [(c, inside or node.tag in ("article", "main")) for c in node.children]
    return False


def _inner(n: Node) -> list:
    """The children that the alignment looks at, of a tree that is whole."""
    if n.inner is None:
        n.inner = [c for c in n.children if (c.strip() if isinstance(c, str) else not c.outside)]
    return n.inner


def _plain(n) -> tuple:
    """(name, worth, text): what a match of names is worth if that is plain to see (a text, or an element with at most one
    text), else 0, and that text. Of two plain ones it is worth the lesser, and one more if they have one text."""
    if isinstance(n, str):
        return None, 1, n
    if n.plain is None:
        inner = _inner(n)
        n.plain = (n.name, 1, None) if not inner else (n.name, 2, inner[0]) if len(inner) == 1 and isinstance(inner[0], str) else (n.name, 0, None)
    return n.plain


def nodes_of(root: Node) -> int:
    """Nodes and texts of a tree that the alignment looks at."""
    n, todo = 0, [root]
    while todo:
        n += 1
        node = todo.pop()
        todo += [] if isinstance(node, str) else _inner(node)
    return n


def _kinds(nodes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node: a hash of its name, one of its text, and what a match of names is worth if that is plain to see
    (a text, or an element with at most one text); else 0."""
    names, texts, worth = [], [], []
    for n in nodes:
        name, value, text = _plain(n)
        names.append(hash((name is None or name, text is None)))
        texts.append(hash(text))
        worth.append(value)
    return np.array(names, np.int64), np.array(texts, np.int64), np.array(worth, np.int64)


def wide_pairs(x: list, y: list, weight) -> tuple[int, list[tuple[int, int]]]:
    """The heaviest matching in order of two long lists, in memory linear in their length but for a logarithm: the very pairs
    that the full table of `matched` gives."""
    (xn, xt, xw), (yn, yt, yw) = _kinds(x), _kinds(y)
    has_text = np.array([isinstance(q, str) or bool(_inner(q)) for q in y])

    def row(i: int, low: int, high: int) -> np.ndarray:
        if xw[i]:
            same = (yn[low:high] == xn[i]) & (yw[low:high] == xw[i])
            w = np.where(same, xw[i] + ((yt[low:high] == xt[i]) & has_text[low:high]), 0)
            rest = np.flatnonzero(~same)
        else:
            w, rest = np.zeros(high - low, np.int64), np.arange(high - low)
        for j in rest.tolist():
            w[j] = weight(x[i], y[low + j])
        return w

    def further(best: np.ndarray, i: int, to: int) -> np.ndarray:
        """The best weights with row i, from those without it."""
        best = best.copy()
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + row(i, start, to)))
        return best

    start = 0
    while start < min(len(x), len(y)) and xw[start] and xw[start] == yw[start] and xn[start] == yn[start] and xt[start] == yt[start]:
        start += 1
    # From the end, as in `matched`: a node of x that isn't needed is skipped, else one of y, else they are a pair. A stretch of
    # x knows the best weights above it and is halved until it is one row.
    to, hit, todo = len(y), [], [(start, len(x), np.zeros(len(y) - start + 1, np.int64))]
    while todo and to > start:
        low, high, best = todo.pop()
        best = best[: to - start + 1]
        if high - low > 1:
            mid, lower = (low + high) // 2, best
            for i in range(low, mid):
                lower = further(lower, i, to)
            todo += [(low, mid, best), (mid, high, lower)]
        elif high > low:
            with_it = further(best, low, to)
            if with_it[-1] != best[-1]:
                to = start + int(np.searchsorted(with_it, with_it[-1])) - 1
                hit.append((low, to))
    hit = [*((i, i) for i in range(start)), *hit[::-1]]
    return sum(weight(x[i], y[j]) for i, j in hit), hit


def matched(a: Node, b: Node) -> tuple[int, list[tuple[int, str, str, bool]]]:
    """The number of matched nodes and texts, and the texts that simple tree matching puts together: (path, text in a,
    text in b, in an article or main part).

    Two trees match if their roots have one name; their children are matched in order so that the number of matched
    nodes is largest. Parts that are marked as no content are left out. Pairs of nodes are done from the leaves up with a
    stack of their own, so trees may be as deep as they like.
    """
    known: dict[tuple[int, int], int] = {}

    def pairs(x: list, y: list) -> tuple[int, list[tuple[int, int]]]:
        if len(x) > WIDE or len(y) > WIDE:
            return wide_pairs(x, y, weight)
        if not x or not y:
            return 0, []
        best = [[0] * (len(y) + 1)]
        plain = [_plain(q) for q in y]
        for p in x:
            name, worth, text = _plain(p)
            above = best[-1]
            row, last = [0], 0
            for j, (other, value, own) in enumerate(plain):
                if other == name:
                    w = ((worth if worth < value else value) + (text == own and text is not None)) if worth and value else weight(p, y[j])
                    if above[j] + w > last:
                        last = above[j] + w
                if above[j + 1] > last:
                    last = above[j + 1]
                row.append(last)
            best.append(row)
        i, j, hit = len(x), len(y), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                hit.append((i, j))
        return best[-1][-1], hit[::-1]

    def below(p: Node, q: Node):
        """Pairs of inner nodes that must be known before p and q."""
        y: dict[str, list[Node]] = {}
        for v in _inner(q):
            if not isinstance(v, str):
                y.setdefault(v.name, []).append(v)
        for u in _inner(p) if y else ():
            if not isinstance(u, str):
                yield from ((u, v) for v in y.get(u.name, ()) if not (_plain(u)[1] and _plain(v)[1]) and (id(u), id(v)) not in known)

    def weight(p, q) -> int:
        (name, worth, text), (other, value, own) = _plain(p), _plain(q)
        if name != other:
            return 0
        if worth and value:
            return min(worth, value) + (text == own and text is not None)
        key = (id(p), id(q))
        if key in known:
            return known[key]
        stack = [(p, q, below(p, q))]
        while stack:
            u, v, rest = stack[-1]
            pair = next(rest, None)
            if pair is None:
                known[id(u), id(v)] = 1 + pairs(_inner(u), _inner(v))[0]
                stack.pop()
            else:
                stack.append((*pair, below(*pair)))
        return known[key]

    count, out, todo = 0, [], [(a, b, 0, False)]
    while todo:
        p, q, path, inside = todo.pop()
        count += 1
        path = down(path, p.name)
        inside = inside or p.tag in ("article", "main")
        x, y = _inner(p), _inner(q)
        for i, j in pairs(x, y)[1]:
            if isinstance(x[i], str):
                count += 1
                out.append((path, squeezed(x[i]), squeezed(y[j]), inside))
            elif not isinstance(y[j], str):
                todo.append((x[i], y[j], path, inside))
    return count, out


def in_layout(pivot: Node, page: Node) -> list | None:
    """What `matched` puts together of a page that is of the layout of another one; None if it is not."""
    count, found = matched(pivot, page)
    return found if found and count >= LAYOUT_SHARE * min(nodes_of(pivot), nodes_of(page)) else None


def induce(pages: list[str]) -> dict[str, list[int]]:
    """The wrapper of a host whose pages are all in memory (of tables `wrappers` finds the same): {"constant": entries (path and text) of the template's texts, "slot": paths of all texts that vary}.

    Exact copies count once. The first page is aligned with each other one; those that match it for LAYOUT_SHARE of the
    smaller tree are of its layout, the others are dealt with among themselves in the same way. A text is constant if
    it stands at its aligned place in all pages of a layout, so a page of another kind takes nothing from a template.
    """
    trees = [parse(p) for p in dict.fromkeys(pages)]
    rest = list(range(len(trees)))
    constant: set[int] = set()
    slots: set[int] = set()
    while rest:
        pivot, left, aligned = rest[0], [], 0
        same: dict[tuple[int, bool], int] = {}
        for k in rest[1:]:
            found = in_layout(trees[pivot], trees[k])
            if found is None:
                left.append(k)
                continue
            aligned += 1
            for key in {(entry_of(path, t), inside) for path, t, u, inside in found if t == u}:
                same[key] = same.get(key, 0) + 1
            slots.update(path for path, t, u, _ in found if t != u)
        for (key, inside), n in same.items():
            if n == aligned and (n >= LEAST_PAGES - 1 or not inside):
                constant.add(key)
        rest = left
    signed = lambda v: (v ^ (1 << 63)) - (1 << 63)
    return {"constant": sorted(constant), "slot": sorted(map(signed, slots))}


def section_of(root: Node) -> int:
    """A digest of the names of the body's parts: pages with the same ones are compared with each other over a whole host."""
    names, todo = set(), [(root, 0)]
    while todo:
        node, depth = todo.pop()
        names.add(f"{depth}{node.name}")
        todo += [(c, depth + 1) for c in _inner(node) if depth < 3 and not isinstance(c, str)]
    return down(0, "\n".join(sorted(names)))


def founders(pages: list[str]) -> list[str]:
    """Those of a few pages that begin a layout: each that is of none of the layouts before it."""
    out: list[tuple[str, Node]] = []
    for page in dict.fromkeys(pages):
        tree = parse(page)
        if all(in_layout(other, tree) is None for _, other in out):
            out.append((page, tree))
    return [page for page, _ in out]


def tallies(pages: DataFrame, sections: bool) -> DataFrame:
    """What each page of (host, key, html, pivots) adds to the counts of its layout, and of its section if `sections`: (kind,
    group, entry, inside, page, host, n). Every page is aligned with the founding pages of its group, in their order, until one has
    it; one that none has is LEFT, with its section as group, unless it has no text to align. Rows with a page say that the
    group has it, those with an entry how many pages have that text. Sums are made in a batch before they are made in a shuffle."""

    def work(frames):
        trees: dict[str, Node] = {}
        held = 0
        for frame in by_characters(frames, "html"):
            n: Counter = Counter()
            for host, page, key, pivots in zip(frame["host"], frame["html"], frame["key"], frame["pivots"], strict=True):
                root = parse(page)
                texts = texts_of(root)
                section = section_of(root)
                if sections:
                    group = entry_of(section, host)
                    n[SECTION, group, None, None, key, host] += 1
                    n.update({(SECTION, group, entry_of(section ^ path, text), None, None, None) for path, text in texts})
                for pivot in pivots if texts else ():
                    if pivot == page:
                        break
                    if pivot not in trees:
                        if held > BATCH_CHARS:
                            trees, held = {}, 0
                        trees[pivot] = parse(pivot)
                        held += len(pivot)
                    found = in_layout(trees[pivot], root)
                    if found is not None:
                        group = entry_of(down(0, pivot), host)
                        n[LAYOUT, group, None, None, key, host] += 1
                        n.update({(LAYOUT, group, entry_of(path, t), inside, None, None) for path, t, u, inside in found if t == u})
                        if any(t != u for _, t, u, _ in found):
                            n[VARIES, group, None, None, None, host] += 1
                        break
                else:
                    if texts:
                        n[LEFT, entry_of(section, host), None, None, key, host] += 1
            # As objects: numbers beside None would become floats, and digests lose their last digits.
            out = pd.DataFrame([(*k, c) for k, c in n.items()], columns=["kind", "group", "entry", "inside", "page", "host", "n"], dtype=object)
            yield out.astype({"kind": "int32", "group": "int64", "n": "int64"})

    rows = pages.select("host", "html", "key", "pivots").mapInPandas(work, "kind int, group long, entry long, inside boolean, page long, host string, n long")
    return rows.groupBy("kind", "group", "entry", "inside", "page", "host").agg(F.sum("n").alias("n"))


def extract(page: str, constant: frozenset | set = frozenset(), slots: list[int] | bool | None = None, everywhere: frozenset | set = frozenset()) -> str:
    """The main text. With a template (texts that are constant or slots that vary, which are not named), the aligned trees decide: all that is
    not constant, in any slot, without the parts that are marked as no content. Without one, what is in an article or
    main part, or else the whole body. Each block's white space is one space; blocks are joined by line ends."""
    root = parse(page)
    section = section_of(root) if everywhere else 0

    def known(path: int, text: str) -> bool:
        text = squeezed(text)
        return not text or entry_of(path, text) in constant or (bool(everywhere) and entry_of(section ^ path, text) in everywhere)

    in_article = not constant and not slots and not everywhere and has_article(root)
    blocks: list[list] = [[]]  # texts, each with whether the template has it
    todo: list = [(root, 0, False, True)]
    while todo:
        node, path, inside, enter = todo.pop()
        if isinstance(node, str):
            if inside or not in_article:
                blocks[-1].append((node, known(path, node)))
            continue
        if node.outside:
            blocks[-1].append((" ", True)) if node.tag not in BLOCK else blocks.append([])
            continue
        if node.tag in BLOCK and blocks[-1]:
            blocks.append([])
        if not enter:
            continue
        if node.tag == "br":
            blocks[-1].append((" ", True))
        if node.tag in BLOCK:
            todo.append((node, path, inside, False))
        inside = inside or node.tag in ("article", "main")
        path = down(path, node.name)
        todo += [(c, path, inside, True) for c in reversed(node.children)]
    lines = (squeezed("".join(t for t, _ in b)) for b in blocks if not all(template for _, template in b))
    return "\n".join(x for x in lines if x)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def candidates(pages: DataFrame, most: int) -> DataFrame:
    """(host, part, key, html): `most` distinct pages of each part of a host, those with the smallest hashes.

    They found layouts and are no sample to count in: `wrappers` aligns all pages with them. Only hosts and hashes are ranked, in
    SPREAD parts of a host first, so no task sees more than `most` rows a part of a hot host; copies have one hash and take
    one place. The pages are then fetched by their hashes, which are as many as distinct pages, so a hot host does not meet in
    one task there either."""
    keys = pages.select("host", "part", "key").distinct()
    for by in (["host", "part", F.pmod("key", F.lit(SPREAD))], ["host", "part"]):
        keys = keys.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("key"))).where(F.col("k") <= most).drop("k")
    keys = checkpointed(keys)
    small = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    return pages.join(small, ["host", "part", "key"]).dropDuplicates(["host", "part", "key"])


def with_founders(pages: DataFrame, most: int) -> DataFrame:
    """`pages` with `pivots`, the founding pages of each one's part of its host; they are broadcast if they are small."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": frame["host"].iloc[:1], "part": frame["part"].iloc[:1], "pivots": [founders(list(frame.sort_values(["key", "html"])["html"]))]})

    found = checkpointed(candidates(pages, most).groupBy("host", "part").applyInPandas(work, "host string, part long, pivots array<string>"))
    size = found.agg(F.sum(F.aggregate("pivots", F.lit(64).cast("long"), lambda n, p: n + F.octet_length(p)))).head()[0] or 0
    return pages.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, ["host", "part"])


def wrappers(pages: DataFrame, most: int = PAGES) -> DataFrame:
    """(host, constant, everywhere, slot) of every host, from all of its pages: the entries of texts that stand at their aligned
    place in all pages of a layout; digests of section, path and text of what stands in all pages of one section that has
    LEAST_PAGES distinct pages; and whether any aligned text varies.

    Layouts are those of `induce` with the pages in the order of their hashes: the first page founds one, the first that is not of
    it the next. A round founds those among `most` pages of a host and aligns all pages with them; pages that have no layout
    then go to another round, in which those of one section are a part of their own, until none is left. Copies change no
    count, as all pages must have a text. Rounds are as many as a section's layouts over `most`, at most; one is the rule."""
    given = pages.select(host_of(F.col("url")).alias("host"), "html").where("html <> ''").withColumn("key", F.xxhash64("html"))
    rest, rounds = given.withColumn("part", F.lit(0).cast("long")), []
    while True:
        kept = checkpointed(tallies(with_founders(rest, most), not rounds).where(f"kind <> {SECTION} OR page IS NOT NULL OR n >= {LEAST_PAGES}"))
        rounds.append(kept.where(F.col("kind") != LEFT))
        left = kept.where(F.col("kind") == LEFT).select("host", F.col("page").alias("key"), F.col("group").alias("part"))
        number = left.count()
        if not number:
            break
        rest = given.join(F.broadcast(left) if number <= BROADCAST_ROWS else left, ["host", "key"])
    rows = reduce(DataFrame.unionByName, rounds)
    totals = rows.where("page IS NOT NULL").groupBy("kind", "group", "host").agg(F.sum("n").alias("all"), F.count("*").alias("distinct"))
    least = F.when(F.col("kind") == SECTION, LEAST_PAGES).when(F.col("inside"), LEAST_PAGES - 1).otherwise(1)
    found = rows.where("entry IS NOT NULL").select("kind", "group", "entry", "inside", "n").join(totals, ["kind", "group"]).where((F.col("n") == F.col("all")) & (F.col("distinct") >= least))
    known = found.select("host", "kind", "entry").unionByName(rows.where(F.col("kind") == VARIES).select("host", "kind", "entry"))
    of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("entry")))
    return known.groupBy("host").agg(of(LAYOUT).alias("constant"), of(SECTION).alias("everywhere"), F.max(F.col("kind") == VARIES).alias("slot"))


def with_wrappers(pages: DataFrame, wrapped: DataFrame) -> DataFrame:
    """`pages` with the wrapper of each one's host. Where all wrappers together are small, which is counted first, they are
    broadcast and no page moves; else hosts are salted and wrappers copied to each part, so a hot host is split."""
    kept = checkpointed(wrapped)
    size = kept.agg(F.sum(8 * sum(F.coalesce(F.size(c), F.lit(0)) for c in ("constant", "everywhere")) + F.octet_length("host") + 64)).head()[0] or 0
    if size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(kept), "host", "left")
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SPREAD)))
    copies = kept.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    return salted.join(copies, ["host", "salt"], "left").drop("salt")


def extract_pages(pages: DataFrame, most: int = PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    Null or empty html: an empty text. Pages without a host share one wrapper. On a host with one page, or copies of
    one, nothing can be aligned, and the markup alone decides. Broken, deep and very long pages are read in time linear
    in their length; the alignment of a page with its layout's first one takes time with the product of their nodes' children. Repeated rows stay
    repeated; extra columns are not read. An empty table: no rows.
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        empty: frozenset = frozenset()
        known: dict[str, tuple] = {}
        texts = []
        for host, page, slot, *wrapper in zip(*(frame[c] for c in ("host", "html", "slot", "constant", "everywhere")), strict=True):
            if host not in known:
                known[host] = tuple(frozenset(w.tolist()) if w is not None else empty for w in wrapper)
            constant, everywhere = known[host]
            texts.append(extract(page, constant, bool(slot), everywhere))
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    given = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    return map_texts(with_wrappers(given, wrappers(pages, most)), ["page_id", "url"], work, "text string, n_chars long", "html")
