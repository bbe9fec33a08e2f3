"""Main text of pages by wrapper induction over the pages of a host.

Every page becomes a tree of its block elements. One page of a host serves as its axis: all other
trees are aligned with it by simple tree matching, the largest order-preserving match of equally
labelled nodes. Per host and aligned place the texts of all pages are compared: what is the
same on most pages is template, what varies is a slot. The text of a page is all of its blocks but the template, wherever
they stand. Elements made for other purposes (menus, footers, forms, adverts and so on) hold no
content wherever they are. Where only a word of class or id says so, it does not count for an
element that holds most of the text on the pages of the host that have it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .shipping import ship

#: A text is template when it stands at its place on at least so many different pages and this share of the host's.
LEAST_PAGES, SHARE = 5, 0.5
#: Lists of subtrees with no more pairs of nodes than this are matched pair by pair, longer ones by whole rows of pairs; both give the same match.
EXACT = 1 << 16
#: Bits of a table of common subsequences, bytes of a table of matches, and bytes of known rows that are held at once; what is not is computed again.
TABLE_BITS, TABLE_BYTES, KNOWN_BYTES = 1 << 28, 1 << 26, 1 << 26

# Fixed values of the HTML standard: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr picture source audio video canvas map area object output progress meter".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: Start tag -> open elements it closes, and the elements that shield them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}),
          "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "body": ({"head"}, set())}

# Elements and roles that mark what is no content, and words of class and id that are a hint of it.
OTHER_TAGS = frozenset("head nav footer aside form script style noscript template iframe button select textarea svg menu dialog object "
                       "audio video canvas xmp noembed noframes title".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
OTHER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation "
                        "breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription "
                        "comment comments disqus share sharing social related widget skip login signup".split())
#: Of these, only those outside the article.
PAGE_WORDS = frozenset("header masthead banner".split())
ARTICLES = frozenset(("article", "main"))
#: Elements whose words say nothing.
WHOLE = ARTICLES | {"html", "body"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
#: A tag as HTML reads it: a quote counts only where a value begins, and only if it is closed.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+|=)*+)>""")
#: What is left of a tag with a quoted value that holds its only end.
_REST = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


class Page:
    """Block elements in document order and the text blocks they hold."""

    def __init__(self, source: str):
        self._read(source, True)
        if self.lost > sum(len(text) for _, text in self.blocks):
            self._read(source, False)  # most of the text is in inline elements with a word

    def _open(self, label: str, parent: int, other: bool, key: str, lost: bool) -> int:
        self.label.append(label)
        self.parent.append(parent)
        self.children.append([])
        self.other.append(other or self.other[parent])
        #: The innermost element with a hint at or around the node, 0 if there is none, and the name of its kind.
        self.hint.append(len(self.label) - 1 if key else self.hint[parent])
        self.key.append(key)
        self.dropped.append(self.dropped[parent] or lost)
        self.children[parent].append(len(self.label) - 1)
        return len(self.label) - 1

    def _read(self, source: str, inline: bool) -> None:
        """``inline``: inline elements with a word are left out; they are no blocks, so the page alone decides."""
        self.label, self.parent, self.children, self.other = ["#root"], [-1], [[]], [False]
        self.hint, self.key, self.dropped, self.lost = [0], [""], [False], 0
        self.blocks: list[tuple[int, str]] = []
        stack: list[tuple[str, int]] = [("#root", 0)]
        text: list[str] = []
        in_article = 0
        at = 0

        def flush():
            if text:
                block = " ".join(entities.unescape("".join(text)).split())
                if block and not self.other[stack[-1][1]]:
                    self.blocks.append((stack[-1][1], block))
                elif self.dropped[stack[-1][1]]:
                    self.lost += len(block)
                text.clear()

        def close(k):
            """Close the open elements from place ``k`` on."""
            nonlocal in_article
            if any(tag not in INLINE for tag, _ in stack[k:]):
                flush()
            in_article -= sum(tag in ARTICLES for tag, _ in stack[k:])
            del stack[k:]

        while at < len(source):
            begin = source.find("<", at)
            if begin < 0:
                begin = len(source)
            if begin > at:
                if not (self.other[stack[-1][1]] and stack[-1][0] in INLINE):
                    text.append(source[at:begin])
                elif self.dropped[stack[-1][1]]:
                    self.lost += begin - at
            if begin == len(source):
                break
            found = _TOKEN.match(source, begin)
            if (not found and source[begin + 1:begin + 2] not in "!?") or (found and found[2] and ("<" in found[3] or ">" in found[3])):
                found = _TAG.match(source, begin) or _REST.match(source, begin)
            if not found:
                if re.match(r"</?[a-zA-Z]", source[begin:begin + 3]):
                    break  # a tag that the end of the page cuts off
                text.append("<")
                at = begin + 1
                continue
            at = found.end()
            name = found[2]
            if not name:
                continue
            tag = name.lower()
            if found[1]:
                if tag == "br":
                    text.append(" ")
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
                if k:
                    close(k)
                elif tag not in INLINE:
                    flush()
                continue
            if tag in CLOSES_P:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in ("p", "td", "th", "button", "table")), 0)
                if k and stack[k][0] == "p":
                    close(k)
            elif tag in CLOSES:
                gone, shields = CLOSES[tag]
                k = len(stack) - 1
                last = 0
                while k > 0 and stack[k][0] not in shields:
                    if stack[k][0] in gone:
                        last = k
                    k -= 1
                if last:
                    close(last)
            if tag == "br":
                text.append(" ")
                continue
            attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(found[3])} if found[3] else {}
            names = set(_WORD.findall((attributes.get("class", "") + " " + attributes.get("id", "")).lower()))
            other = tag in OTHER_TAGS or attributes.get("role", "").lower() in OTHER_ROLES
            hints = set() if tag in WHOLE else names & OTHER_WORDS if in_article else names & (OTHER_WORDS | PAGE_WORDS)
            key, lost = "", False
            if not other and (hints or tag == "header" and not in_article):
                if tag in INLINE:
                    other = lost = inline
                else:  # ids may differ on every page, so of them only the words that are hints count
                    key = ".".join([tag, *sorted(hints | set(_WORD.findall(attributes.get("class", "").lower())))])
            if tag in VOID or (tag in INLINE and not other):
                if tag not in INLINE:
                    flush()
                continue
            if tag not in INLINE:
                flush()
            label = tag + ("." + ".".join(sorted(names)) if names else "")
            node = self._open(label, stack[-1][1], other, key, lost)
            if tag in RAW:
                end = re.compile(f"</{tag}[\\s/>]", re.I).search(source, at)
                stop = source.find(">", end.start()) if end else -1
                at = stop + 1 if stop >= 0 else len(source)
                continue
            if found[3].endswith("/") and tag == "svg":
                continue
            stack.append((tag, node))
            in_article += tag in ARTICLES
        flush()

    def hints(self, node: int) -> list[str]:
        """Kinds of the elements with a hint around a node."""
        found, at = set(), self.hint[node]
        while at:
            found.add(self.key[at])
            at = self.hint[self.parent[at]]
        return sorted(found)

    def held(self) -> dict[str, int]:
        """Length of the text in the largest element of each kind that has a hint."""
        if not any(self.hint[node] for node, _ in self.blocks):
            return {}
        n = [0] * len(self.label)
        for node, text in self.blocks:
            n[node] += len(text)
        found: dict[str, int] = {}
        for node in range(len(n) - 1, 0, -1):
            n[self.parent[node]] += n[node]
            if self.key[node] and n[node]:
                found[self.key[node]] = max(found.get(self.key[node], 0), n[node])
        return found


def _lcs_rows(left: list, right: list) -> Iterator[int]:
    """Per element of ``left``, where the longest common subsequence with the beginnings of ``right`` does not grow: a bit for each."""
    masks: dict = {}
    for j, y in enumerate(right):
        masks[y] = masks.get(y, 0) | 1 << j
    full = row = (1 << len(right)) - 1
    for x in left:
        both = row & masks.get(x, 0)
        row = ((row + both) | (row - both)) & full
        yield row


def _lcs_lengths(left: list, right: list) -> np.ndarray:
    row = (1 << len(right)) - 1
    for row in _lcs_rows(left, right):
        pass
    flat = np.unpackbits(np.frombuffer(row.to_bytes(len(right) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(right)]
    return np.concatenate(([0], np.cumsum(flat == 0)))


def common_subsequence(left: list, right: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; halves of ``left`` on their own where the table would be too large."""
    if not left or not right:
        return []
    if len(left) > 1 and len(left) * len(right) > TABLE_BITS:
        half = len(left) // 2
        cut = int((_lcs_lengths(left[:half], right) + _lcs_lengths(left[half:][::-1], right[::-1])[::-1]).argmax())
        return common_subsequence(left[:half], right[:cut]) + [
            (i + half, j + cut) for i, j in common_subsequence(left[half:], right[cut:])]
    table = [0, *_lcs_rows(left, right)]
    i, j, found = len(left), len(right), []
    while i and j:
        if table[i] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or table[i] >> (j - 1) & 1:
            j -= 1
            found.append((i, j))
    return found[::-1]


class _Known(dict):
    """Arrays by key; the oldest go when all are more than ``KNOWN_BYTES``."""

    held = 0

    def put(self, key, value: np.ndarray) -> np.ndarray:
        self[key] = value
        self.held += value.nbytes
        while self.held > KNOWN_BYTES and len(self) > 1:
            self.held -= self.pop(next(iter(self))).nbytes
        return value


class _Kind:
    """The different subtrees of one label in a level, their children one after the other."""

    def __init__(self, begin: int, children: list[list[int]], most: int):
        count = np.array([len(c) for c in children])
        self.begin, self.end = begin, begin + len(children)
        #: Places of the children in the next level.
        self.cells = np.array([c for row in children for c in row], np.int64)
        #: Numbers of each subtree's row lie above those of the one before, so that one running maximum serves all.
        self.base = np.repeat(np.arange(len(children)) * most, count)
        self.some = np.flatnonzero(count)
        self.last = np.cumsum(count)[self.some] - 1
        self.first = self.last + 1 - count[self.some]


class _Rows:
    """Largest matches of an axis subtree with all subtrees below a list of the page's at once, level by level."""

    def __init__(self, axis: Page, page: Page, shape_a: list[int], shape_b: list[int], nodes: int, most: int, right: list[int], known: _Known):
        self.axis, self.page, self.shape_a, self.shape_b, self.nodes, self.known = axis, page, shape_a, shape_b, nodes, known
        #: Per level: the place of each different subtree, and the kinds by label.
        self.place: list[dict[int, int]] = []
        self.kinds: list[dict[str, _Kind]] = []
        level = self._different(right)
        while level:
            below = self._different([c for n in level for c in page.children[n]])
            place = {shape_b[n]: i for i, n in enumerate(below)}
            kinds, i = {}, 0
            while i < len(level):
                j, label = i, page.label[level[i]]
                while j < len(level) and page.label[level[j]] == label:
                    j += 1
                kinds[label] = _Kind(i, [[place[shape_b[c]] for c in page.children[n]] for n in level[i:j]], most)
                i = j
            self.place.append({shape_b[n]: i for i, n in enumerate(level)})
            self.kinds.append(kinds)
            level = below
        self.kinds.append({})

    def _different(self, nodes: list[int]) -> list[int]:
        return sorted({self.shape_b[n]: n for n in nodes}.values(), key=self.page.label.__getitem__)

    def sizes(self, x: int, level: int) -> np.ndarray:
        """Matched pairs of subtree ``x`` with each subtree of ``level``; its label is one of the level's."""
        open_: list[tuple[int, _Kind, np.ndarray, Iterator[int]]] = []
        value = self._start(x, level, open_)
        while open_:
            node, kind, row, rest = open_[-1]
            if value is not None:
                self._step(kind, row, value)
                value = None
            at = level + len(open_)
            for child in rest:
                if self.axis.label[child] in self.kinds[at]:
                    value = self._start(child, at, open_)
                    break
            else:
                open_.pop()
                found = np.zeros(len(self.place[at - 1]), np.int32)
                found[kind.begin:kind.end] = 1
                found[kind.begin + kind.some] += (row - kind.base)[kind.last].astype(np.int32)
                value = self.known.put((self, at - 1, self.shape_a[node]), found)
        return value

    def _start(self, node: int, level: int, open_: list) -> np.ndarray | None:
        """What is known of a node, else its children are to be matched first."""
        key = (self, level, self.shape_a[node])
        if key in self.known:
            return self.known[key]
        kind, children = self.kinds[level][self.axis.label[node]], self.axis.children[node]
        if children and len(kind.cells):
            open_.append((node, kind, kind.base.copy(), iter(children)))
            return None
        found = np.zeros(len(self.place[level]), np.int32)
        found[kind.begin:kind.end] = 1
        return self.known.put(key, found)

    @staticmethod
    def _step(kind: _Kind, row: np.ndarray, value: np.ndarray) -> None:
        """A row of every table of children from the one above it."""
        both = np.empty_like(row)
        both[1:] = row[:-1]
        both[kind.first] = kind.base[kind.first]
        both += value[kind.cells]
        np.maximum(both, row, out=both)
        np.maximum.accumulate(both, out=row)

    def matched(self, left: list[int], right: list[int], level: int) -> list[tuple[int, int]]:
        """Pairs of the largest match of two lists; ``right`` stands in ``level``. Rows that do not fit are computed again on the way back."""
        labels = {self.axis.label[x] for x in left} & {self.page.label[y] for y in right}
        left = [x for x in left if self.axis.label[x] in labels]
        right = [y for y in right if self.page.label[y] in labels]
        places = np.array([self.place[level][self.shape_b[y]] for y in right], np.int64)
        spread, chosen, room = _Known(), [], np.empty(len(right), np.int32)

        def after(row: np.ndarray, i: int) -> np.ndarray:
            shape, n = self.shape_a[left[i]], len(row) - 1
            value = spread[shape] if shape in spread else spread.put(shape, self.sizes(left[i], level)[places])
            out = np.empty(n + 1, np.int32)
            out[0] = 0
            both = np.add(row[:-1], value[:n], out=room[:n])
            np.maximum(both, row[1:], out=both)
            np.maximum.accumulate(both, out=out[1:])
            return out

        def back(row: np.ndarray, begin: int, end: int, j: int) -> int:
            """Go from column ``j`` of row ``end`` to row ``begin``, which is ``row``; the column there."""
            most = max(2, TABLE_BYTES // (4 * (j + 1)))
            step = 1 if end - begin <= most else -(-(end - begin) // most)
            rows = [row[:j + 1]]
            for i in range(begin, end if step == 1 else begin + (end - begin - 1) // step * step):
                row = after(rows[-1] if i == begin else row[:j + 1], i)
                if (i + 1 - begin) % step == 0:
                    rows.append(row)
            if step > 1:
                for k in range(len(rows) - 1, -1, -1):
                    j = back(rows.pop()[:j + 1], begin + k * step, min(end, begin + (k + 1) * step), j)
                return j
            i = end
            while i > begin and j:
                here = rows[i - begin]
                if here[j] == rows[i - 1 - begin][j]:
                    i -= 1
                elif here[j] == here[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    chosen.append((left[i], right[j]))
            return j

        if left and right:
            back(np.zeros(len(right) + 1, np.int32), 0, len(left), len(right))
        return chosen


def tree_match(axis: Page, page: Page) -> dict[int, int]:
    """Simple tree matching: node of ``page`` -> node of ``axis``.

    Of two equally labelled nodes, the children are matched by dynamic programming over both lists. Equal subtrees at the
    starts and ends of the lists match at once, which loses nothing. The match is the largest one on pages of any width and
    depth. Where the subtrees left have more than ``EXACT`` pairs of nodes, an axis node meets all page nodes of its depth and
    label at once, equal subtrees as one; time grows with the pairs of different subtrees of a depth, memory with the page. Of
    several largest matches both ways take the same.
    """
    shapes: dict[tuple, int] = {}

    def measured(p: Page) -> tuple[list[int], list[int]]:
        """Nodes of each subtree, and a number that equal subtrees share."""
        size, shape = [1] * len(p.label), [0] * len(p.label)
        for n in range(len(p.label) - 1, -1, -1):  # parents stand before their children
            shape[n] = shapes.setdefault((p.label[n], *(shape[c] for c in p.children[n])), len(shapes))
            if n:
                size[p.parent[n]] += size[n]
        return size, shape

    (size_a, shape_a), (size_b, shape_b) = measured(axis), measured(page)
    memo: dict = {}

    def trimmed(left: list[int], right: list[int]) -> tuple[list, list, list]:
        """Pairs of equal subtrees at the starts and ends, and the lists between them."""
        start, n, m = 0, len(left), len(right)
        while start < n and start < m and shape_a[left[start]] == shape_b[right[start]]:
            start += 1
        while n > start and m > start and shape_a[left[n - 1]] == shape_b[right[m - 1]]:
            n, m = n - 1, m - 1
        return [*zip(left[:start], right[:start]), *zip(left[n:], right[m:])], left[start:n], right[start:m]

    def sizes(a: int, b: int) -> tuple[int, list]:
        """Matched pairs below a and b, themselves included, and the pairs of their children."""
        if shape_a[a] == shape_b[b]:
            return size_a[a], list(zip(axis.children[a], page.children[b]))
        if (a, b) not in memo:
            pairs, left, right = trimmed(axis.children[a], page.children[b])
            total, chosen = table(left, right)
            memo[a, b] = 1 + sum(size_a[x] for x, _ in pairs) + total, pairs + chosen
        return memo[a, b]

    def table(left: list[int], right: list[int]) -> tuple[int, list]:
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, x in enumerate(left):
            row, above = best[i + 1], best[i]
            for j, y in enumerate(right):
                most = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if axis.label[x] == page.label[y]:
                    with_both = above[j] + sizes(x, y)[0]
                    most = with_both if with_both > most else most
                row[j + 1] = most
        i, j, chosen = len(left), len(right), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                chosen.append((left[i - 1], right[j - 1]))
                i, j = i - 1, j - 1
        return best[len(left)][len(right)], chosen[::-1]

    small = lambda left, right: sum(size_a[x] for x in left) * sum(size_b[y] for y in right) <= EXACT
    matched = {0: 0}

    def settle(left: list[int], right: list[int]) -> None:
        """Match short lists with all that is below them."""
        below = table(left, right)[1]
        while below:
            a, b = below.pop()
            matched[b] = a
            below += sizes(a, b)[1]
        memo.clear()

    known = _Known()
    todo: list[tuple[int, int, _Rows | None, int]] = [(0, 0, None, 0)]
    while todo:
        a, b, rows, level = todo.pop()
        matched[b] = a
        if shape_a[a] == shape_b[b]:
            todo += [(x, y, None, 0) for x, y in zip(axis.children[a], page.children[b])]
            continue
        pairs, left, right = trimmed(axis.children[a], page.children[b])
        todo += [(x, y, None, 0) for x, y in pairs]
        if small(left, right):
            settle(left, right)
            continue
        if len(left) == len(right) == 1:
            chosen = [(left[0], right[0])] if axis.label[left[0]] == page.label[right[0]] else []
        else:
            nodes = sum(size_b[y] for y in right)
            if rows is None or 2 * nodes < rows.nodes:  # else what is known of these levels is used on
                rows, level = _Rows(axis, page, shape_a, shape_b, nodes, 1 + max(size_b[y] for y in right), right, known), 0
            chosen = rows.matched(left, right, level)
        todo += [(x, y, rows, level + 1) for x, y in chosen]
    return matched


def aligned_blocks(axis: Page, page: Page, hinted: bool = False) -> list[tuple[str, list[str], str]]:
    """(place, hints, text) of each block, of those in elements with a hint only if ``hinted``: ``place`` is its node on the axis and its turn in it, and a digest of its labels from
    the root and its text where the node has no match, so that a text the axis page lacks is counted as well."""
    matched = tree_match(axis, page)
    turns: dict[int, int] = {}
    paths: list[int] = []
    for node, label in enumerate(page.label):  # parents stand before their children
        paths.append(xxhash.xxh3_64_intdigest(label, paths[page.parent[node]] if node else 0))
    hints: dict[int, list[str]] = {0: []}
    out = []
    for node, text in page.blocks:
        turns[node] = turns.get(node, -1) + 1
        around = page.hint[node]
        if around not in hints:
            hints[around] = page.hints(node)
        if hinted or not around:
            place = f"{matched[node]}:{turns[node]}" if node in matched else f"{xxhash.xxh3_64_intdigest(text, paths[node]):x}"
            out.append((place, hints[around], text))
    return out


BLOCKS = "array<struct<place:string,hints:array<string>,text:string>>"
HELD = "array<struct<kind:string,n:bigint,total:bigint>>"


def _align(batches):
    kind = pa.list_(pa.struct([("place", pa.string()), ("hints", pa.list_(pa.string())), ("text", pa.string())]))
    sizes = pa.list_(pa.struct([("kind", pa.string()), ("n", pa.int64()), ("total", pa.int64())]))
    for batch in batches:
        hosts, sources, axes = (batch.column(k).to_pylist() for k in range(2, 5))
        found, held = [None] * len(hosts), [None] * len(hosts)
        axis: tuple = (None, None)
        for i in sorted(range(len(hosts)), key=hosts.__getitem__):  # so that a batch reads the axis of a host once
            if axis[0] != hosts[i]:
                axis = (hosts[i], Page(axes[i] or ""))
            page = Page(sources[i] or "")
            found[i] = [{"place": p, "hints": h, "text": t} for p, h, t in aligned_blocks(axis[1], page, True)]
            total = sum(len(text) for _, text in page.blocks)
            held[i] = [{"kind": k, "n": n, "total": total} for k, n in page.held().items()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(held, sizes), pa.array(found, kind)],
                                         names=["page_id", "url", "host", "held", "blocks"])


def host_of(url: Column) -> Column:
    """Host of an address in small letters; the empty string where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def overruled(aligned: DataFrame) -> DataFrame:
    """(host, kinds): elements with a hint that hold most of the text on the pages of the host that have them."""
    held = aligned.select("host", F.explode("held").alias("e")).groupBy("host", F.col("e.kind").alias("kind")).agg(
        F.sum("e.n").alias("n"), F.sum("e.total").alias("total"))
    return held.where(2 * F.col("n") > F.col("total")).groupBy("host").agg(F.collect_set("kind").alias("kinds"))


def wrappers(aligned: DataFrame) -> DataFrame:
    """(host, template places) from the aligned pages; pages with the same text count once."""
    pages = aligned.groupBy("host").agg(F.count_distinct("mark").alias("pages"))
    blocks = aligned.select("host", "mark", F.explode("blocks").alias("b")).select(
        "host", "mark", F.col("b.place").alias("place"), F.xxhash64("b.text").alias("h"))
    # both steps are reduced before their shuffle, so a host of any size is spread by place
    seen = blocks.groupBy("host", "place", "mark").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    places = seen.groupBy("host", "place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("seen"))
    constant = places.where((F.col("lo") == F.col("hi")) & (F.col("seen") >= LEAST_PAGES)).join(pages, "host")
    return constant.where(F.col("seen") >= SHARE * F.col("pages")).groupBy("host").agg(F.collect_set("place").alias("template"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null pages are empty and empty pages have no text. Pages without a host are one host of their own. All blocks
    outside of other-purpose elements are text, less the template; a host whose pages do not vary (one page, or copies) has no
    template. Blocks are joined by line breaks in page order, white space in a block is one space. Repeated rows and ids
    give a row each; extra columns are ignored; an empty table gives an empty result.
    """
    ship(pages.sparkSession)
    scratch = Scratch(pages.sparkSession, "wrapper")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    # the axis of a host: of its pages with an element the one of the least id (and least text, if rows share the id), one
    # candidate per task and host. It is written, so that Spark knows its size: it is sent to all tasks where that is small, else joined by host
    bare = ~F.coalesce(F.col("html").rlike("<[A-Za-z]"), F.lit(False))
    first = F.struct(bare.alias("bare"), F.col("page_id").isNull().alias("none"), "page_id", F.xxhash64("html").alias("h"), "html")
    axes = scratch.keep(rows.groupBy("host").agg(F.min(first).alias("first")).select("host", F.col("first.html").alias("axis")), "axes")
    joined = rows.join(axes, "host").select("page_id", "url", "host", "html", "axis")
    kind = pages.schema[page_id].dataType.simpleString()
    aligned = scratch.keep(joined.mapInArrow(_align, f"page_id {kind}, url string, host string, held {HELD}, blocks {BLOCKS}"), "aligned")
    content = aligned.join(scratch.keep(overruled(aligned), "overruled"), "host", "left")
    counts = lambda b: F.forall(b["hints"], lambda h: F.coalesce(F.array_contains(F.col("kinds"), h), F.lit(False)))
    content = content.select("page_id", "url", "host", F.filter("blocks", counts).alias("blocks"))
    marked = content.select("host", F.xxhash64(F.transform("blocks", lambda b: b["text"])).alias("mark"), "blocks")
    judged = content.join(scratch.keep(wrappers(marked), "wrappers"), "host", "left")
    kept = F.filter("blocks", lambda b: ~F.coalesce(F.array_contains(F.col("template"), b["place"]), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return judged.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
