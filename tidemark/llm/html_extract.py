"""HTML extraction: template deduction by equivalence classes of tokens.

1. Every page becomes tokens: tags with their class, and text runs.  A token's
   occurrence vector over the pages of its host is reduced to a fingerprint (an
   exclusive-or of hashes of page and count), so hosts of any size are summed in
   parallel; tokens of one fingerprint form an equivalence class.  Pages with the same
   text are one page here, so copies of an article do not become template.
2. A class is valid if its tokens occur in at least half of the pages of the host, or of
   the host's pages of one frame (the set of container elements and their names), and it
   has at least two members, one of them text.  Members without a place of their own in
   the order of first occurrence are left out.
3. On a page the valid classes are nested into a template tree, those with most pages
   first.  A class holds there if all its members do, those that occur once in the
   class's order, and if its stretch of the page lies inside one slot of each class
   already in the tree, or around it (``nested``).  The text in the tree is boilerplate;
   what varies stands in its slots.
4. The main slot is the part of the element tree that holds most of the varying text
   outside links, found from the largest ``article`` or ``main`` element, else from the
   root.  No element around it is ever dropped.  Of the rest, regions that are not the
   article are dropped, by element (menus, forms, asides) or by name (weak evidence: a
   class, id or role made only of words for such regions).

A host with fewer than four different pages of a kind has no template; there elements and
names decide alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_batches, materialise, text_of

# Element names of HTML and words of class and id names.
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp", "noembed", "noframes"))
ASIDE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "head", "object", "canvas", "audio", "video"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
SIDE_NAMES = frozenset(("ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "footer", "form", "header", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promotion", "related", "reply", "replies", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"))
#: Words that say nothing beside one of the former.
PLAIN_NAMES = frozenset(("area", "bar", "block", "bottom", "box", "button", "buttons", "column", "container", "content", "google", "group", "icons", "inline", "inner", "item", "items", "left", "link", "links", "list", "main", "media", "outer", "page", "panel", "primary", "reader", "right", "secondary", "section", "site", "slot", "sticky", "thread", "top", "unit", "user", "wrap", "wrapper"))

TAG_NAME = re.compile(r"[a-zA-Z][^\s/<>]*")
UNQUOTED = re.compile(r"[^>\"']*")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
RAW_END = {name: re.compile(f"</{name}", re.I) for name in RAW}
SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
DIGITS = re.compile(r"[0-9]+")
PARTS = re.compile(r"[a-z]+")
#: Elements that content brings along; they do not tell kinds of pages apart.
FLOW = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "picture", "details", "summary", "center"))
CONTENT = INLINE | VOID | RAW | FLOW
#: A class is part of a template if its tokens are in this share of at least so many pages of the host or of one frame.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 4
#: The main slot is followed down to the child that holds this share of an element's varying text.
MAIN_SHARE = 0.5
#: The hash of the empty token, which counts pages.
NO_TOKEN = 0x2D06800538D394C2 - (1 << 63)


def token_hash(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode()) - (1 << 63)


def events(page: str) -> Iterator[tuple[str, str, tuple[str, ...]]]:
    """(kind, value, names): 'text' with raw text, 'open' and 'close' with an element's name; names are those of its class, id and role.

    One pass: what is searched for in vain once is never searched for again.
    """
    at, text_from, n = 0, 0, len(page)
    absent: set[str] = set()

    def find(what: str, start: int) -> int:
        if what in absent:
            return -1
        found = page.find(what, start)
        if found < 0:
            absent.add(what)
        return found

    while True:
        at = page.find("<", at)
        if at < 0 or at + 1 >= n:
            break
        mark, raw = page[at + 1], ""
        close, name, names = mark == "/", "", ()
        if page.startswith("<!--", at):
            end = find("-->", at + 4)
            end = n if end < 0 else end + 3
        elif mark in "!?":
            end = find(">", at) + 1
        else:
            m = TAG_NAME.match(page, at + 1 + close)
            end = 0
            if m and find(">", m.end()) >= 0:
                name, end = m[0].lower(), m.end()
                while True:  # to the bracket outside quotes
                    end = UNQUOTED.match(page, end).end()
                    if end >= n or page[end] == ">":
                        break
                    shut = find(page[end], end + 1)
                    end = end + 1 if shut < 0 else shut + 1
                if end >= n:
                    end = find(">", m.end())
                raw = page[m.end() : end]
                end += 1
        if end <= 0:  # no tag
            at += 1
            continue
        if at > text_from:
            yield "text", page[text_from:at], ()
        at = text_from = end
        if not name:
            continue
        if close:
            yield "close", name, ()
            continue
        if "=" in raw:
            found = (DIGITS.sub("", t) for x in NAMES.findall(raw) for t in "".join(x).lower().split())
            names = tuple(t for t in found if t)
        yield "open", name, names
        if name in RAW and not raw.endswith("/"):
            m = None if name in absent else RAW_END[name].search(page, at)
            if not m:
                absent.add(name)
            end = page.find(">", m.end()) if m else -1
            at = text_from = n if end < 0 else end + 1
            yield "close", name, ()
    if text_from < n:
        yield "text", page[text_from:], ()


Events = list[tuple[str, str, tuple[str, ...]]]


def parsed(page: str | Events) -> Events:
    """The events of a page, read once for all that looks at them; text comes with its references decoded."""
    if not isinstance(page, str):
        return page
    return [(kind, html.unescape(value) if kind == "text" and "&" in value else value, names) for kind, value, names in events(page)]


def even(text: str) -> str:
    """A text run with white space made even, as tokens have it."""
    return " ".join(text.split())


def tokens(page: str | Events) -> Iterator[str]:
    """Template tokens: tags with class words, and even text runs."""
    for kind, value, names in parsed(page):
        if kind == "text":
            run = even(value)
            if run:
                yield f"t:{run}"
        elif names:
            yield f"{kind[0]}:{value}.{'.'.join(names)}"
        else:
            yield f"{kind[0]}:{value}."


def frame(page: str | Events) -> int:
    """A number for the set of container elements and their names: pages of one kind share it."""
    found = {f"{value}.{'.'.join(names)}" for kind, value, names in parsed(page) if kind == "open" and value not in CONTENT}
    return token_hash("|".join(sorted(found)))


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        frames = pa.array([frame(page) for page in batch["html"].to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, frames], names=[*batch.schema.names, "frame"])


def _hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and distinct token: host, frame, hashes of the token, of the page's text, of (text, count)."""
    for batch in batches:
        hosts, frames, keys, contents, prints, first, texts = [], [], [], [], [], [], []
        for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
            page = parsed(page)
            counts = Counter(tokens(page))
            kind, content = frame(page), token_hash(extract(page))
            for place, (token, c) in enumerate({"": 1, **counts}.items()):  # '' counts pages
                hosts.append(host)
                frames.append(kind)
                keys.append(token_hash(token))
                contents.append(content)
                prints.append(token_hash(f"{content}:{c}"))
                first.append(place)
                texts.append(token.startswith("t:"))
        arrays = [pa.array(hosts, pa.string()), *(pa.array(x, pa.int64()) for x in (frames, keys, contents, prints)), pa.array(first, pa.int32()), pa.array(texts, pa.bool_())]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "frame", "token", "content", "print", "place", "is_text"])


#: (pages, tokens in the order of their first occurrence) of each class.
Classes = list[tuple[int, tuple[int, ...]]]


def nested(stretches: list[tuple[int, list[int]]]) -> list[int]:
    """The numbers of the classes that make a tree.  stretches: by class (pages, its places on a page in order).

    Classes with more pages, then more members, come first.  The next one joins if for
    each class in the tree it lies within one slot of that class (before, between or
    after its places), or that class lies within one slot of it.
    """
    tree: list[int] = []
    for i in sorted(range(len(stretches)), key=lambda i: (-stretches[i][0], -len(stretches[i][1]), stretches[i][1])):
        mine = stretches[i][1]
        if all(_in_one_slot(mine, stretches[j][1]) or _in_one_slot(stretches[j][1], mine) for j in tree):
            tree.append(i)
    return tree


def _in_one_slot(inner: list[int], outer: list[int]) -> bool:
    return not inner or not any(inner[0] < p < inner[-1] for p in outer)


def template_of(page: str | Events, classes: Classes) -> frozenset[int]:
    """The tokens of the template tree that the classes make on this page."""
    if not classes:
        return frozenset()
    counts = Counter(map(token_hash, tokens(page)))
    place = {t: i for i, t in enumerate(counts)}
    holding: list[tuple[int, ...]] = []
    stretches: list[tuple[int, list[int]]] = []
    for pages, members in classes:
        if all(t in counts for t in members):
            single = [place[t] for t in members if counts[t] == 1]
            if single == sorted(single):
                holding.append(members)
                stretches.append((pages, single))
    return frozenset(t for i in nested(stretches) for t in holding[i])


class Element:
    """An element, how much varying text outside links it holds, and whether text directly in it is the article's."""

    __slots__ = ("name", "names", "parent", "children", "weight", "around_main", "inside", "aside")

    def __init__(self, name: str, names: tuple[str, ...], parent: Element | None):
        self.name, self.names, self.parent, self.children = name, names, parent, []
        self.weight, self.around_main, self.inside, self.aside = 0, False, False, False
        if parent:
            parent.children.append(self)


def is_side_name(name: str) -> bool:
    """Whether a class, id or role names a region beside the article and says nothing else."""
    parts = PARTS.findall(name)
    return any(p in SIDE_NAMES for p in parts) and all(p in SIDE_NAMES or p in PLAIN_NAMES for p in parts)


def element_tree(page: str | Events, template: frozenset[int]) -> tuple[Element, list[tuple[Element, str]]]:
    """The root, and the text of the page in order with its elements; block borders are spaces, template runs are gone."""
    root = here = Element("", (), None)
    out: list[tuple[Element, str]] = []
    links = 0
    still_open: Counter[str] = Counter()
    for kind, text, names in parsed(page):
        if kind == "text":
            if template and (run := even(text)) and token_hash(f"t:{run}") in template:
                text = " "
            out.append((here, text))
            if not links:
                here.weight += len(text.strip())
            continue
        value = text
        if value not in INLINE:
            out.append((here, " "))
            links = 0
        if value in VOID or value in RAW:
            continue
        if value in INLINE:
            links = max(0, links + (kind == "open") - (kind == "close")) if value == "a" else links
            continue
        if kind == "open":
            if value == "body":  # ends a head that was left open
                while here.name == "head":
                    still_open["head"] -= 1
                    here = here.parent
            here = Element(value, names, here)
            still_open[value] += 1
        elif still_open[value]:
            while True:  # with what is left open in it
                still_open[here.name] -= 1
                name, here = here.name, here.parent
                if name == value:
                    break
    return root, out


def judge(root: Element) -> None:
    """Find the main slot and mark every element: inside an article and its likes (or the root, without any), and aside or not."""
    every, at = [root], 0
    while at < len(every):
        every.extend(every[at].children)
        at += 1
    for e in reversed(every):  # sums from the leaves up
        if e.parent:
            e.parent.weight += e.weight
    mains: list[Element] = []
    for e in every:  # outermost first
        e.inside = bool(e.parent) and e.parent.inside
        if not e.inside and e.name in ("article", "main"):
            mains.append(e)
            e.inside = True
    start = max(mains, key=lambda e: e.weight, default=root)
    e: Element | None = start
    while e:
        e.around_main, e = True, e.parent
    e = start
    while e.children and (best := max(e.children, key=lambda c: c.weight)).weight > MAIN_SHARE * e.weight:
        best.around_main, e = True, best
    for e in every:
        above = e.parent
        e.inside = e.inside or not mains
        e.aside = bool(above) and above.aside
        if above and not e.aside and not e.around_main:
            named = bool(e.names) and e.name not in ("html", "body") and any(map(is_side_name, e.names))
            own_head = e.name == "header" and e.inside and bool(mains)  # an article's title
            e.aside = named or (e.name in ASIDE and not own_head)


def extract(page: str | Events, template: frozenset[int] = frozenset()) -> str:
    """The article's text: blocks in page order, joined by one space."""
    root, runs = element_tree(page, template)
    judge(root)
    return SPACE.sub(" ", "".join([text if e.inside and not e.aside else " " for e, text in runs])).strip(" ")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        rows = zip(batch["html"].to_pylist(), batch["of_host"].to_pylist(), batch["of_frame"].to_pylist(), strict=True)
        for page, of_host, of_frame in rows:
            page = parsed(page)
            out.append(extract(page, template_of(page, [(c["n"], tuple(c["members"])) for c in (of_host or []) + (of_frame or [])])))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host_of(url):
    """The lower-cased authority of a URL without user and port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _valid(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, classes``: the valid classes that hold text, from ``*keys, token, vector, n, place, is_text``.

    A class has several tokens, each in the share of the distinct pages; so a template has
    few tokens (a page's tokens over the share), however many pages there are.
    """
    pages = F.col("token") == NO_TOKEN
    sizes = counted.where(pages).select(*keys, F.col("n").alias("pages"))
    frequent = counted.where(~pages & (F.col("n") >= TEMPLATE_PAGES)).join(sizes, keys).where(F.col("n") >= F.col("pages") * TEMPLATE_SHARE)
    members = F.array_sort(F.collect_list(F.struct("place", "token")))
    classes = frequent.groupBy(*keys, "vector", "n").agg(members.alias("members"), F.max("is_text").alias("is_text")).where(F.col("is_text") & (F.size("members") >= 2))
    # tokens with a fixed order have places of their own
    ordered = classes.withColumn("members", F.expr("filter(members, m -> size(filter(members, x -> x.place = m.place)) = 1)"))
    return ordered.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("n"), F.col("members.token").alias("members")))).alias("classes"))


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, of_host`` and ``host, frame, of_frame``: valid classes of each host and of each frame, from ``host, html``."""
    rows = map_batches(pages, _hosts, "host string, frame long, token long, content long, print long, place int, is_text boolean")
    once = rows.groupBy("host", "frame", "token", "content").agg(F.min("print").alias("print"), F.min("place").alias("place"), F.first("is_text").alias("is_text"))
    summed = lambda df, keys, vector, n: df.groupBy(*keys, "token").agg(F.expr(f"bit_xor({vector})").alias("vector"), n.alias("n"), F.min("place").alias("place"), F.first("is_text").alias("is_text"))
    by_frame = materialise(summed(once, ["host", "frame"], "print", F.count("*")), "frames")
    by_host = summed(by_frame, ["host"], "vector", F.sum("n"))
    return _valid(by_host, ["host"]).withColumnRenamed("classes", "of_host"), _valid(by_frame, ["host", "frame"]).withColumnRenamed("classes", "of_frame")


def _small(found: DataFrame, column: str) -> bool:
    tokens_, rows = found.agg(F.sum(F.expr(f"aggregate({column}, 0L, (n, c) -> n + size(c.members) + 2)")), F.count("*")).first()
    return (tokens_ or 0) * 8 + rows * 64 <= 16 << 20


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Null or empty html gives the empty text.  Pages without a host share the host ''.
    Repeated rows get a row each but count as one page of their host.  Very long or
    malformed html is read in one pass.  An empty table gives an empty result.  Columns
    other than the three named ones are not read.  Ids are integers.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), host_of(F.col(f"`{url_col}`")).alias("host"), text_of(f"`{html_col}`").alias("html"))
    joined = map_batches(rows, _framed, "page_id long, url string, host string, html string, frame long")
    for found, keys, name in zip(templates(rows.select("host", "html")), (["host"], ["host", "frame"]), ("of_host", "of_frame"), strict=True):
        found = materialise(found, name)
        joined = joined.join(F.broadcast(found) if _small(found, name) else found, keys, "left")
    return map_batches(joined.select("page_id", "url", "html", "of_host", "of_frame"), _apply, "page_id long, url string, text string, n_chars long")
