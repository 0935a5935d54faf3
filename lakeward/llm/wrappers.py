"""Main text of web pages by wrappers: union-free regular expressions inferred
from pages of the same host.

A page is a stream of tags and texts.  Runs of equal groups of tokens become
repeated groups.  All pages of a host are then aligned one after the other with
the expression so far: tokens that only one side has become optional, and texts
that differ become slots.  Tasks align the pages they have, and the expressions
of a host are aligned with each other.  What varies from page to page is content,
what nearly all pages share is template; the wrapper's region is the innermost
element that holds nearly all varying text (an ``article`` or ``main`` element if
most pages have one).  Every page of the host is then aligned with the whole
expression: the place of its tokens there tells where the region begins and which
of its texts are template and which stand in slots and repeated groups.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import isqrt
from operator import eq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut
from lakeward.operators.joins import join_aggregated
from lakeward.session import small_batches

#: Longest group of tokens looked at for repetition.
GROUP = 12
#: Share of the varying text that the region holds.
REGION_SHARE = 0.8
#: Share of a host's different pages that have a text of the template.
TEMPLATE_SHARE = 0.8
#: Shares are summed as whole numbers of this part, so that their order does not count.
UNIT = 1_000_000
#: Entries that a task gathers before it hands them on; tasks' expressions of a host that meet at first.
GATHERED, MERGED = 500_000, 32
#: Hosts whose expressions a Python worker keeps ready for reading.
READINGS = 64

# HTML elements by kind, and words of classes and ids that name what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe object svg math select option xmp".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul""".split())
NAMED = ("article", "main")
CONTAINERS = set("body article main section div td".split())
OUTSIDE = set("nav aside footer form button dialog menu head".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMES = set("""ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies
consent gdpr notice notices alert comment comments commentlist disqus replies respond sidebar aside menu nav navbar navigation
breadcrumb breadcrumbs footer share sharing social related recommended recommendations newsletter subscribe signup popup modal
overlay pagination pager widget widgets toolbar login search skip""".split())
#: Only outside the region, as articles have headers of their own.
HEADER_NAMES = set("header masthead topbar".split())

TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, attributes): kind '<' start, '/' end, '#' text (as it stands).

    Comments, declarations and the content of raw elements give nothing; a
    tag or comment that never ends swallows the rest."""
    at, n, tag = 0, len(page), TAG
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "#", page[at:], ""
            return
        if start > at:
            yield "#", page[at:start], ""
        after = page[start + 1:start + 2]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
        elif after in ("!", "?") and after:
            end = page.find(">", start)
            at = n if end < 0 else end + 1
        elif after.isalpha() or after == "/":
            m = tag.match(page, start)
            if m is None and tag is TAG:
                # a quote that never ends: quotes are not heeded from here on
                m = LOOSE.match(page, start)
                tag = LOOSE if m else tag
            if m is None:
                if page.find(">", start) < 0:
                    return
                at = page.find(">", start) + 1
                continue
            name, at = m[1].lower(), m.end()
            if after == "/":
                yield "/", name, ""
                continue
            yield "<", name, m[2]
            if name in RAW:
                m = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = m.end() if m else n
                yield "/", name, ""
        else:
            yield "#", "<", ""
            at = start + 1


def names(attributes: str) -> tuple[str, set[str], str]:
    """The first class or id (the element's sign), all their words, the role."""
    sign, words, role = "", set(), ""
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "role":
            role = value
        elif key == "hidden":
            words.add("popup")
        else:
            sign = sign or value
            words.update(w for w in re.split(r"[^a-z]+", value) if w)
            words.update(value.split())
    return sign, words, role


class Element:
    __slots__ = ("name", "sign", "outside", "header")

    def __init__(self, name: str, attributes: str):
        sign, words, role = names(attributes)
        self.name, self.sign = name, f"{name}.{sign}" if sign else name
        self.outside = name in OUTSIDE or role in ROLES or not words.isdisjoint(NAMES)
        self.header = name == "header" or not words.isdisjoint(HEADER_NAMES)


def walk(page: str) -> Iterator[tuple[str, object, list[Element]]]:
    """The page's tokens with the open elements: ('<', element, open),
    ('/', element, open), ('#', text, open).  Void and raw elements do not
    stay open; what HTML closes by itself is closed here, too."""
    open_: list[Element] = []
    for kind, name, attributes in tokens(page):
        if kind == "#":
            yield "#", name, open_
        elif kind == "<":
            if name in BLOCK:               # a block ends a paragraph that is open
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k].name == "p":
                        while len(open_) > k:
                            yield "/", open_.pop(), open_
                        break
                    if open_[k].name in BLOCK:
                        break
            element = Element(name, attributes)
            yield "<", element, open_
            if name not in VOID:
                open_.append(element)
        elif any(e.name == name for e in open_):
            while open_[-1].name != name:
                yield "/", open_.pop(), open_
            yield "/", open_.pop(), open_


# --- the expression ---------------------------------------------------------------------------

def item(kind: str, what) -> tuple[str, str] | None:
    """(symbol, text) of a token: tags by sign, texts that are not blank as '#'."""
    if kind != "#":
        return ("</" if kind == "/" else "<") + what.sign + ">", ""
    text = " ".join(htmllib.unescape(what).split())
    return ("#", text) if text else None


def stream(page: str) -> list[tuple[str, str]]:
    """(symbol, text) of a page's tokens."""
    return [x for kind, what, _ in walk(page) if (x := item(kind, what))]


def fold(items: list[list], known: set[tuple] = frozenset()) -> list[list]:
    """Replace adjacent equal groups of the items (see :class:`Expression`), and
    any groups ``known`` to be repeated, by one repeated group: ('+', symbols).
    Groups begin with a start tag and close all that they open, short ones first."""
    firsts: dict[int, set[str]] = {}
    for _, group in known:
        firsts.setdefault(len(group), set()).add(group[0])
    symbols, starts = [], []
    for size in range(2, GROUP + 1):
        if len(symbols) != len(items):
            symbols = [x[0] for x in items]
            starts = [s if s[0][0] == "<" and s[1] != "/" else k for k, s in enumerate(symbols)]
        begin = firsts.get(size)
        hits = [i for i, same in enumerate(map(eq, starts, starts[size:])) if same]
        if begin:
            hits = sorted({*hits, *(i for i, s in enumerate(starts[:len(starts) - size + 1]) if s in begin)})
        out, at = [], 0
        for i in hits:
            if i < at:
                continue
            group = tuple(symbols[i:i + size])
            n = 1
            if symbols[i + size:i + size + 1] == [group[0]] and balanced(group):
                while tuple(symbols[i + n * size:i + (n + 1) * size]) == group:
                    n += 1
            if n > 1 or ("+", group) in known:
                optional = all(x[1] for x in items[i:i + n * size])
                count = sum(x[3] for x in items[i:i + n * size])
                out += items[at:i]
                at = i + n * size
                if out and out[-1][0] == ("+", group):
                    out[-1] = [out[-1][0], out[-1][1] and optional, "", out[-1][3] + count, None]
                else:
                    out.append([("+", group), optional, "", count, None])
        if at:
            items = out + items[at:]
    return items


def balanced(group: tuple) -> bool:
    if not isinstance(group[0], str) or not group[0].startswith("<") or group[0].startswith("</"):
        return False
    depth = 0
    for s in group:
        if isinstance(s, str) and s.startswith("</"):
            depth -= 1
        elif isinstance(s, str) and s.startswith("<") and s[1:-1].split(".")[0] not in VOID:
            depth += 1
        if depth < 0:
            return False
    return depth == 0


def align(a: list, b: list) -> list[tuple[int | None, int | None]]:
    """Longest common subsequence of two lists of symbols, as pairs of positions
    with None for what one side lacks; equal ends are matched first.

    A row of the table is one number, whose bit is 0 where the length grows; only
    some rows are kept, those between are made again on the way back."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start:len(a) - end], b[start:len(b) - end]
    where: dict = {}
    for j, s in enumerate(y):
        where[s] = where.get(s, 0) | 1 << j
    full = (1 << len(y)) - 1

    def after(row: int, s) -> int:
        u = row & where.get(s, 0)
        return (row + u | row - u) & full
    stride = isqrt(len(x)) + 1
    kept, row = [full], full
    for i, s in enumerate(x, 1):
        row = after(row, s)
        if i % stride == 0:
            kept.append(row)
    back: list[tuple[int | None, int | None]] = []
    i, j, part, rows = len(x), len(y), -1, []
    while i and j:
        if i // stride != part:
            part = i // stride
            rows = [kept[part]]
            for s in x[part * stride:i]:
                rows.append(after(rows[-1], s))
        if rows[i - part * stride] >> j - 1 & 1:
            j -= 1
            back.append((None, start + j))
            continue
        i -= 1
        above = rows[i - part * stride] if i >= part * stride else after_row(x, kept, stride, i, after)
        if i and not above >> j - 1 & 1:
            back.append((start + i, None))
        else:
            j -= 1
            back.append((start + i, start + j))
    back += [(start + k, None) for k in range(i - 1, -1, -1)] + [(None, start + k) for k in range(j - 1, -1, -1)]
    return ([(k, k) for k in range(start)] + back[::-1] + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)])


def after_row(x: list, kept: list[int], stride: int, i: int, after) -> int:
    """Row ``i`` of the table of :func:`align`."""
    row = kept[i // stride]
    for s in x[i // stride * stride:i]:
        row = after(row, s)
    return row


def vote(a: list, b: list) -> list:
    """Text, count and lead of two aligned items: a text of most of them stays in the lead."""
    if a[2] is not None and a[2] == b[2]:
        return [a[2], a[3] + b[3], None]
    x, y = (digest(i[2]) if i[2] is not None else i[4] for i in (a, b))
    if x == y:
        return [None, a[3] + b[3], x]
    return [None, a[3] - b[3], x] if a[3] >= b[3] else [None, b[3] - a[3], y]


class Expression:
    """A union-free regular expression: ``items`` of [symbol, optional, text, count,
    lead], a symbol being a tag, '#' or ('+', group).  ``text`` is the one text seen
    there in all ``pages`` that have it, or None where texts differ (a slot); there,
    ``lead`` is the digest of the text that most pages have, if any does, and
    ``count`` by how many it leads.  In a single page, ``count`` is the tokens of an item."""

    def __init__(self, page: str | list[tuple[str, str]]):
        self.pages = 1
        self.items = fold([[s, False, t, 1, None] for s, t in (stream(page) if isinstance(page, str) else page)])

    def groups(self) -> set[tuple]:
        return {x[0] for x in self.items if x[0][0] == "+"}

    def known(self, groups: set[tuple]) -> list[list]:
        """The items; a group that is repeated elsewhere is one, also where it occurs once."""
        mine = self.groups()
        return self.items if groups <= mine else fold(self.items, mine | groups)

    def add(self, other: str | Expression) -> None:
        """Align with one more page, or with another expression, and resolve the mismatches."""
        if isinstance(other, str):
            other = Expression(other)
        a, b = self.known(other.groups()), other.known(self.groups())
        merged = []
        for i, j in align([x[0] for x in a], [x[0] for x in b]):
            if i is None or j is None:
                symbol, _, *rest = a[i] if j is None else b[j]
                merged.append([symbol, True, *rest])
            else:
                symbol, optional = a[i][:2]
                merged.append([symbol, optional or b[j][1], *(vote(a[i], b[j]) if symbol == "#" else ["", 1, None])])
        self.items, self.pages = merged, self.pages + other.pages

    def dump(self) -> str:
        return json.dumps([self.pages, self.items])

    @classmethod
    def load(cls, text: str) -> Expression:
        e = cls([])
        e.pages, items = json.loads(text)
        e.items = [[loaded(s), *rest] for s, *rest in items]
        return e

    def __str__(self) -> str:
        def show(s) -> str:
            return "(" + "".join(map(show, s[1])) + ")+" if s[0] == "+" else s
        out = ""
        for s, optional, text, *_ in self.items:
            shown = show(s) if s != "#" else "#SLOT" if text is None or self.pages == 1 else text
            out += f"({shown})?" if optional else shown
        return out


def loaded(symbol: str | list) -> str | tuple:
    """A symbol as it was before it went through JSON."""
    return symbol if isinstance(symbol, str) else (symbol[0], tuple(map(loaded, symbol[1])))


def flat(symbol: str | tuple) -> Iterator[str]:
    """The tags and texts of a symbol; a repeated group once."""
    if isinstance(symbol, str):
        yield symbol
    else:
        for s in symbol[1]:
            yield from flat(s)


def region_starts(items: list[list], region: str) -> Iterator[list[str]]:
    """For each item of an expression, its start tags with which the region begins:
    by name, or by the path that leads there with or without optional elements."""
    open_: list[tuple[str, bool]] = []
    last = region.rsplit("/", 1)[-1]
    for symbol, optional, *_ in items:
        starts = []
        for s in flat(symbol):
            if s == "#":
                continue
            close = s.startswith("</")
            sign = s[2 if close else 1:-1]
            name = sign.split(".")[0]
            if close:
                at = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == sign), None)
                del open_[at if at is not None else len(open_):]
                continue
            if region in NAMED:
                begins = name == region
            elif begins := name in CONTAINERS and sign.endswith(last):
                parts = [e for e in open_ if e[0].split(".")[0] in CONTAINERS]
                begins = region in ("/".join([e for e, _ in parts] + [sign]), "/".join([e for e, o in parts if not o] + [sign]))
            if begins:
                starts.append(s)
            if name not in VOID:
                open_.append((sign, optional))
        yield starts


class Reading:
    """What it takes to find a page's tokens in an expression: the symbols, the start
    tags of each with which the region begins, and the template text (digest) of each."""

    def __init__(self, symbols: list, starts: list[list[str]], fixed: list[int | None]):
        self.symbols, self.starts, self.fixed = symbols, starts, fixed
        self.groups = {s for s in symbols if s[0] == "+"}

    @classmethod
    def of(cls, expression: Expression, region: str, template: Iterable[str | int]) -> Reading:
        shared = {t if isinstance(t, int) else digest(t) for t in template}
        leads = [lead if text is None else digest(text) if symbol == "#" else None for symbol, _, text, _, lead in expression.items]
        return cls([x[0] for x in expression.items], list(region_starts(expression.items, region)),
                   [lead if lead in shared else None for lead in leads])

    def dump(self) -> str:
        return json.dumps([self.symbols, {k: x for k, x in enumerate(self.starts) if x}, {k: x for k, x in enumerate(self.fixed) if x is not None}],
                          ensure_ascii=False, separators=(",", ":"))

    @classmethod
    def load(cls, text: str) -> Reading:
        symbols, starts, fixed = json.loads(text)
        at = list(map(str, range(len(symbols))))
        return cls(list(map(loaded, symbols)), [starts.get(k, []) for k in at], [fixed.get(k) for k in at])

    def places(self, items: list[tuple[str, str]]) -> list[int | None]:
        """For each (symbol, text) of a page its item of the expression."""
        page = Expression(items).known(self.groups)
        places: list[int | None] = []
        for i, j in align(self.symbols, [x[0] for x in page]):
            if j is not None:
                places += [i] * page[j][3]
        return places

    def is_template(self, place: int | None, text: str) -> bool:
        """Whether a text that nearly all pages share is template at its place:
        in a slot it is not, unless the slot is the text's own in most pages."""
        return place is None or self.symbols[place] != "#" or self.fixed[place] == digest(text)


@lru_cache(maxsize=READINGS)
def ready(text: str) -> Reading:
    return Reading.load(text)


def paths(open_: list[Element]) -> Iterator[tuple[str, Element]]:
    """The open containers with the signs that lead to them."""
    path = ""
    for e in open_:
        if e.name in CONTAINERS:
            path = f"{path}/{e.sign}" if path else e.sign
            yield path, e


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


class Template:
    """Texts, or digests of texts, that nearly all pages of a host share."""

    def __init__(self, texts: Iterable[str | int] = ()):
        self.texts = set(texts)
        self.digests = any(not isinstance(t, str) for t in self.texts)

    def __contains__(self, text: str) -> bool:
        return bool(self.texts) and (text in self.texts or self.digests and digest(text) in self.texts)


def shares(page: str, template: Template) -> dict[str, float] | None:
    """The share of the page's varying text by path, and by ``<article>`` and
    ``<main>`` 1 if such an element has some; None without varying text."""
    total, own, named = 0, Counter(), {}
    for kind, what, open_ in walk(page):
        if kind != "#" or any(e.outside or e.name == "a" for e in open_):
            continue
        text = " ".join(htmllib.unescape(what).split())
        if text and text not in template:
            total += len(text)
            named.update((f"<{e.name}>", 1.0) for e in open_ if e.name in NAMED)
            for path, element in paths(open_):
                own[path, element] += len(text)
    most: dict[str, float] = named           # by the element that holds most of those with the same path
    for (path, _), n in own.items():
        most[path] = max(most.get(path, 0.0), n / total)
    return most if total else None


def region_of(weights: dict[str, float]) -> str:
    """The region by the pages' mean shares."""
    held = [path for path, w in weights.items() if w >= REGION_SHARE - 1e-9 and path[0] != "<"]
    named = next((n for n in NAMED if weights.get(f"<{n}>", 0) >= 0.5), None)
    return named or max(held, key=lambda x: (x.count("/"), x), default="body")


def infer(pages: list[str]) -> dict:
    """The wrapper of pages of a host: ``region`` (``article`` or ``main``, else the path
    of signs to the element that holds the article), ``template`` (texts that nearly
    all pages share), ``expression``, and how it is read.  :func:`wrappers` does it for
    all pages of all hosts."""
    expression = Expression(pages[0])
    for page in pages[1:]:
        expression.add(page)
    texts = [{t for s, t in stream(page) if s == "#"} for page in set(pages)]
    seen = Counter(t for own in texts for t in own)
    template = {t for t, n in seen.items() if len(texts) > 2 and n >= TEMPLATE_SHARE * len(texts)}
    # pages that are nearly copies of each other tell nothing
    if 2 * sum(len(t) * seen[t] for t in template) > sum(len(t) * n for t, n in seen.items()):
        template = set()
    found = [w for w in (shares(page, Template(template)) for page in pages) if w]
    weights = {path: sum(w.get(path, 0.0) for w in found) / len(found) for path in set().union(*found)}
    region = region_of(weights)
    return {"region": region, "template": sorted(template), "expression": str(expression),
            "reading": Reading.of(expression, region, template)}


# --- reading pages ----------------------------------------------------------------------------

def blocks(page: str, wrapper: dict) -> list[str]:
    """The article's blocks in page order.

    The page is aligned with the wrapper's expression.  The region is the elements
    whose start tags are found where the expression's region begins, or that have
    the region's name or path in the page; without one, it is all of the page.
    Elements in it that are something else by kind, role, class or id are left out.
    If the region is not an ``article`` or ``main`` element, blocks of nothing but
    template are left out, too: texts that nearly all pages share, in a repeated
    group or at the place of the expression that is theirs.  Regions inside an
    element that is something else only count if no other is."""
    region, reading = wrapper["region"], wrapper["reading"]
    named = region in NAMED
    template = Template(() if named else wrapper["template"])
    tokens_ = [(kind, what, item(kind, what)) for kind, what, _ in walk(page)]
    places = iter(reading.places([x for _, _, x in tokens_ if x]))
    found: dict[int, list[str]] = {0: [], 1: [], 2: []}
    parts: dict[int, list[str]] = {0: [], 1: [], 2: []}
    own: set[int] = set()       # kinds of whose open block some text is not template

    def end_block() -> None:
        for k, texts in parts.items():
            if k in own:
                found[k].append(" ".join("".join(texts).split()))
            texts.clear()
        own.clear()
    # of the open elements: those that are something else, these and headers, and the path as long as it may lead to the region
    open_: list[tuple[int, int, str | None]] = []
    first = None
    for kind, what, about in tokens_:
        place = next(places) if about else None
        if kind == "/":
            open_.pop()
            first = None if first == len(open_) else first
        if kind != "#":
            if what.name in BLOCK:
                end_block()
            elif what.name == "br" and kind == "<":
                for texts in parts.values():
                    texts.append(" ")
            if kind == "<" and what.name not in VOID:
                outside, other, path = open_[-1] if open_ else (0, 0, "")
                if path is not None and what.name in CONTAINERS:
                    path = f"{path}/{what.sign}" if path else what.sign
                begins = what.name == region if named else what.name in CONTAINERS and path == region
                if first is None and (begins or place is not None and about[0] in reading.starts[place]):
                    first = len(open_)
                if path and not region.startswith(path + "/"):
                    path = None
                open_.append((outside + what.outside, other + (what.outside or what.header), path))
            continue
        outside, other, _ = open_[-1] if open_ else (0, 0, "")
        if first is None:
            k = 2 if not other else None
        else:
            before, before_other, _ = open_[first - 1] if first else (0, 0, "")
            k = None if outside > before else 1 if before_other else 0
        if k is not None:
            parts[k].append(htmllib.unescape(what))
            if about and not (about[1] in template and reading.is_template(place, about[1])):
                own.add(k)
    end_block()
    return found[0] or found[1] or found[2]


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#:]*)", 1))


def _learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page its digest and its different texts' digests and lengths; per host
    the expression of the task's pages, handed on when all have grown to GATHERED items."""
    known: dict[str, Expression] = {}
    pages: dict[str, set[int]] = {}

    def states() -> pd.DataFrame:
        out = pd.DataFrame({"host": list(known), "page": None, "texts": None, "state": [e.dump() for e in known.values()]})
        known.clear()
        pages.clear()
        return out
    for batch in batches:
        rows = []
        for at, html in zip(batch["host"], batch["html"]):
            items, page = stream(html), digest(html)
            rows.append((at, page, [{"h": digest(t), "n": len(t)} for t in {t for s, t in items if s == "#"}], None))
            if page not in pages.setdefault(at, set()):
                pages[at].add(page)
                if at in known:
                    known[at].add(Expression(items))
                else:
                    known[at] = Expression(items)
        yield pd.DataFrame(rows, columns=["host", "page", "texts", "state"])
        if sum(len(e.items) for e in known.values()) + sum(map(len, pages.values())) > GATHERED:
            yield states()
    if known:
        yield states()


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    whole, *others = map(Expression.load, sorted(group["state"]))
    for e in others:
        whole.add(e)
    return pd.DataFrame({"host": group["host"][:1], "state": [whole.dump()]})


def _weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of :func:`shares` by host and path; path '' counts the pages."""
    sums: Counter = Counter()

    def out() -> pd.DataFrame:
        rows = [(at, path, n) for (at, path), n in sums.items()]
        sums.clear()
        return pd.DataFrame(rows, columns=["host", "path", "weight"])
    for batch in batches:
        for at, html, shared in zip(batch["host"], batch["html"], batch["template"]):
            found = shares(html, Template(() if shared is None else map(int, shared)))
            if found is not None:
                sums[at, ""] += UNIT
                for path, share in found.items():
                    sums[at, path] += round(share * UNIT)
        if len(sums) > GATHERED:
            yield out()
    yield out()


def wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``region``, ``template`` (digests), ``expression`` and ``reading``
    (:class:`Reading`) of every host, from all its pages that are not empty.

    The pages are read twice: for texts and expressions, then for the region.
    Tasks hand on digests, expressions and sums, never pages; a host's pages do
    not meet in a task."""
    rows = pages.where(F.length("html") > 0).select(host().alias("host"), "html")
    learned = cut(rows.mapInPandas(_learn, "host string, page long, texts array<struct<h:long,n:int>>, state string"), "learned")
    merged = (learned.where("state is not null").select("host", "state", F.pmod(F.xxhash64("state"), F.lit(MERGED)).alias("part"))
              .groupBy("host", "part").applyInPandas(_merge, "host string, state string")
              .groupBy("host").applyInPandas(_merge, "host string, state string"))
    shown = F.udf(lambda state: str(Expression.load(state)), "string")
    # copies of a page count once
    single = learned.where("page is not null").dropDuplicates(["host", "page"])
    counts = single.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    texts = single.select("host", F.inline("texts")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("seen"), F.max("n").alias("n"))
    texts = join_aggregated(texts, counts, [("host", "host")], "inner")
    shared = (F.col("pages") > 2) & (F.col("seen") >= F.lit(TEMPLATE_SHARE) * F.col("pages"))
    mass = F.col("seen") * F.col("n")
    template = texts.groupBy("host").agg(F.sum(mass).alias("all"), F.sum(F.when(shared, mass)).alias("same"),
                                         F.array_sort(F.collect_list(F.when(shared, F.col("h")))).alias("template"))
    # pages that are nearly copies of each other tell nothing
    template = cut(template.where((2 * F.col("same") <= F.col("all")) & (F.size("template") > 0)).select("host", "template"), "template")
    sums = (rows.join(template, "host", "left").select("host", "html", "template")
            .mapInPandas(_weigh, "host string, path string, weight long")
            .groupBy("host", "path").agg(F.sum("weight").alias("weight")))
    sums = cut(sums, "weights")
    mean = F.col("weight") / F.col("whole")
    sums = join_aggregated(sums.where("path <> ''"), sums.where("path = ''").select("host", F.col("weight").alias("whole")),
                           [("host", "host")], "inner")
    depth = F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))
    held = (mean >= REGION_SHARE - 1e-5) & ~F.col("path").startswith("<")
    named = [F.max(F.when((F.col("path") == f"<{n}>") & (mean >= 0.5), F.lit(n))) for n in NAMED]
    region = sums.groupBy("host").agg(F.coalesce(*named, F.max_by("path", F.when(held, F.struct(depth, "path"))), F.lit("body")).alias("region"))
    reading = F.udf(lambda state, region, template: Reading.of(Expression.load(state), region, template).dump(), "string")
    return (merged.join(region, "host", "left").join(template, "host", "left")
            .select("host", F.coalesce("region", F.lit("body")).alias("region"),
                    F.coalesce("template", F.array().cast("array<long>")).alias("template"), "state")
            .select("host", "region", "template", shown("state").alias("expression"), reading("state", "region", "template").alias("reading")))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` (the article's blocks, joined by newlines)
    and ``n_chars`` of every row of ``pages`` (page_id, url, html).

    Null and empty pages give an empty text.  A null address, or one without a
    host, belongs to the host ''.  Repeated rows each give a row."""
    @F.pandas_udf("string")
    def read(htmls: pd.Series, region: pd.Series, template: pd.Series, reading: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(blocks(page, {"region": r, "template": () if r in NAMED else map(int, t), "reading": ready(how)}))
                          if page else "" for page, r, t, how in zip(htmls, region, template, reading)], dtype=object)
    small_batches(pages.sparkSession)       # a page brings its host's expression along
    of = cut(wrappers(pages), "wrappers").select("host", "region", "template", "reading")
    rows = pages.select("page_id", "url", "html", host().alias("host")).join(of, "host", "left")
    return (rows.select("page_id", "url", read("html", "region", "template", "reading").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
