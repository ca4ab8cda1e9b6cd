"""Main text of web pages by nearest-URL page differencing.

A page becomes its lines: the text of its blocks in page order, scripts, styles and markup gone,
character references decoded. Within a host, pages are sorted by URL path, and each page is
aligned with the pages just before and after it by a longest common subsequence of lines. Lines
shared with such a neighbour are its template (menus, notices, footers) and are deleted. Pages of a
host with one longest line, among the lines that are not on nearly all its pages, are near copies:
of those with the same template lines the first stands for all, and its neighbours are the nearest pages of
other content.

Differencing alone can't give right results where a template's words change from page to page, or
where neighbours share a sentence of their articles, so markup corrects it. Every page is aligned
with its neighbours over all its lines, but lines inside the main element are not deleted for being
shared, and elements that are navigation, headers, footers, sidebars, notices, adverts, forms or comments by tag,
class, id or role go even if no neighbour has them. The main element is ``main``, else the
``article`` with most text. Other articles are cards (teasers), and so are all articles beside a text much longer than
they are; cards, and in that case the text beside them, are left to differencing. A class, an id
or a form tag never drops html, body, main or article, nor an element that holds the main text or
most of the page's text (``class="no-sidebar"``); inside the main element only a whole name does
(``ad-box``, not ``notice-period``), and tables, lists of terms and headings may be called a menu.

The neighbours are found over rows of a few hashes, one for each content of a host, so exact copies
count once; they are range-partitioned by (host, path), so a host with a third of all pages spans
many tasks, and the pages at a partition's edges meet in a second, small step. Only the numbers of deleted lines go back to the pages.

Defined cases: a null or empty html has the empty text; a null url is a page of the empty host;
repeated rows give equal rows; unclosed elements end with their container; an empty table gives an
empty result; only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import shuffle_partitions, staged

_SILENT = re.compile(
    r"<!--|<(script|style|noscript|template|iframe|svg|textarea|select|title)(?=[\s/>])[^>]*>|<[!?][^>]*>", re.I
)
# What ends a silent element: its closing tag (group 1) or, for some, a tag that shows it was never closed.
_ENDS = {
    name: re.compile(rf"<(/){name}(?=[\s/>])[^>]*>" + other.format(name), re.I)
    for name, other in [
        *((n, "") for n in ("script", "style", "noscript", "template", "svg", "textarea")),
        *((n, r"|<{}(?=[\s/>])") for n in ("select", "iframe")),
        ("title", r"|<{}(?=[\s/>])|</head(?=[\s>])|<body(?=[\s/>])"),
    ]
}
_CONTAINER = re.compile(r"</?(?:head|body|html)(?=[\s/>])", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_NAMES = re.compile(r"[A-Za-z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option optgroup p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_DROPPED = frozenset("nav footer aside button head menu dialog object audio video canvas fieldset".split())
_MAIN = frozenset("article main".split())
# Words in a class or id that name something other than the article.
_OTHER = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert "
    "modal popup overlay newsletter subscribe signup login search comment comments disqus respond reply replies share "
    "sharing social related recommended widget pagination pager copyright".split()
)
# Words beside those in a compound name ("related-posts"); other compounds inside the main element name its content.
_FILLING = frozenset(
    "area author bar block body bottom box button buttons card container content count form group icon icons inner item "
    "items label link links list meta outer panel post posts section slot text thread title top unit wrap wrapper".split()
)
# Inside the main element these hold its data, whatever they are called ("menu"), but for foreign matter.
_DATA = frozenset("table dl pre blockquote figure h1 h2 h3 h4 h5 h6".split())
_DATA_WORDS = frozenset("menu nav navigation notice notices alert search share login signup overlay widget copyright".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
# An opening tag that ends an open element of the second kind, up to the nearest of the third.
_CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
}


_KEPT, _DOUBTFUL, _GONE = 0, 1, 2
OUTSIDE, MAIN, CARD = 0, 1, 2  # where a line is; CARD: in an article element that is not the page's main one
TEASER = 3  # article elements with less than 1 / 3 of the text beside them are cards,
STORY = 100  # if that text has as many characters


def _names_other(tag: str, value: str, inside_main: bool) -> bool:
    """Whether a class or id names something other than the article; inside the main element only by whole names."""
    if not inside_main:
        words = set(_NAMES.findall(value))
        return bool(words & _OTHER) or "header" in words
    other = _OTHER - _DATA_WORDS if tag in _DATA else _OTHER
    for token in value.split():
        words = set(_NAMES.findall(token))
        if words & other and words <= _OTHER | _FILLING:
            return True
    return False


def _is_other(tag: str, attributes: str, inside_main: bool) -> int:
    """Whether an element is other than the article: not, by its names only, or by what it is."""
    if tag in ("html", "body"):
        return _KEPT
    if tag in _DROPPED or (tag == "header" and not inside_main):
        return _GONE
    found = _DOUBTFUL if tag == "form" else _KEPT
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return found
    main = tag in _MAIN
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if _names_other(tag, value, inside_main):
                found = _DOUBTFUL
        elif name == "role" and value == "main":
            main = True
        elif name == "role" and value in _ROLES or name == "aria-hidden" and value == "true":
            return _GONE
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _GONE
    if re.search(r"(?:^|\s)hidden(?:\s|/|$|=)", _ATTRIBUTE.sub(" ", attributes), re.I):
        return _GONE
    return _KEPT if main else found


def _settled(lines: list[tuple[str, bool, bool]], doubtful: list[list]) -> list[tuple[str, bool, bool]]:
    """Lines with the elements dropped that only their names speak against.

    ``doubtful``: first line, end, and whether inside the main element, outer before inner. An element stays if it has
    most of the text that is left, or the main element and no less of its text than there is outside.
    """
    if not doubtful:
        return lines
    sizes, mains = [0], [0]
    for text, main, dropped in lines:
        size = 0 if dropped else len(text)
        sizes.append(sizes[-1] + size)
        mains.append(mains[-1] + size * main)
    left, main_left, done = sizes[-1], mains[-1], 0
    gone = [dropped for _, _, dropped in lines]
    for s, e, inside_main in doubtful:
        if e <= max(s, done):
            continue
        size, main = sizes[e] - sizes[s], mains[e] - mains[s]
        holds = main and not inside_main
        if 2 * size > left or holds and 2 * main >= main_left:
            continue
        gone[s:e] = [True] * (e - s)
        left, main_left, done = left - size, main_left - main, e
    return [(text, main, g) for (text, main, _), g in zip(lines, gone)]


def _placed(lines: list[tuple[str, bool, bool]], elements: list[list], doubtful: list[list]) -> list[tuple[str, int, bool]]:
    """Lines with their place: OUTSIDE, MAIN or CARD.

    ``elements``: first line, end and tag of the outermost article and main elements. The article element with most text
    is the main one, the others are cards; all are cards where there is over ``TEASER`` times their text beside
    them, not counting the elements in ``doubtful`` that hold no article. A main element is never a card.
    """
    places = [MAIN if main else OUTSIDE for _, main, _ in lines]
    articles = [(s, e) for s, e, tag in elements if tag == "article"]
    if articles:
        sizes = [sum(len(text) for text, _, gone in lines[s:e] if not gone) for s, e in articles]
        largest = sizes.index(max(sizes))
        other_main = len(articles) < len(elements)
        counted = [not main and not gone for _, main, gone in lines]
        for s, e, _ in doubtful:
            if not any(main for _, main, _ in lines[s:e]):
                counted[s:e] = [False] * (e - s)
        beside = sum(len(text) for (text, _, _), c in zip(lines, counted) if c)
        teasers = not other_main and beside > max(STORY, TEASER * sum(sizes))
        for k, (s, e) in enumerate(articles):
            if teasers or (k != largest and not other_main):
                places[s:e] = [CARD] * (e - s)
    return [(text, place, gone) for (text, _, gone), place in zip(lines, places)]


def _without_silent(html: str) -> str:
    """The page without comments and elements that hold no text of it; of unclosed elements only the tag goes."""
    out, at = [], 0
    unclosed: set[str] = set()
    while m := _SILENT.search(html, at):
        out.append(html[at : m.start()])
        at = m.end()
        if m.group() == "<!--":
            end = html.find("-->", at)
            at = end + 3 if end >= 0 else len(html)
        if not m.group(1):
            continue
        name = m.group(1).lower()
        if name == "title":
            out.append(" ")
        if name == "svg" and m.group().endswith("/>"):
            continue
        end = None if name in unclosed else _ENDS[name].search(html, at)
        if end and end.group(1):
            at = end.end()
            continue
        if not end:
            unclosed.add(name)  # no closing tag from here on
        if name in ("script", "style"):  # code, up to the end of what holds it
            container = _CONTAINER.search(html, at)
            at = container.start() if container else len(html)
    out.append(html[at:])
    return "".join(out)


def page_lines(html: str) -> list[tuple[str, int, bool]]:
    """(text, OUTSIDE, MAIN or CARD, dropped by markup) of every block of a page."""
    html = _without_silent(html)
    lines: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []  # (tag, main so far, dropped so far, number in doubtful or -1)
    doubtful: list[list] = []
    elements: list[list] = []  # outermost article and main elements: first line, end, tag
    main = dropped = False

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                lines.append((text, main, dropped))
            parts.clear()

    def cut(depth: int) -> tuple[bool, bool]:
        if any(number >= 0 or gone != (stack[depth - 1][2] if depth else False) for _, _, gone, number in stack[depth:]):
            flush()
        for *_, number in stack[depth:]:
            if number >= 0:
                doubtful[number][1] = len(lines)
        if elements and elements[-1][1] < 0 and not (depth and stack[depth - 1][1]):
            flush()
            elements[-1][1] = len(lines)
        del stack[depth:]
        return stack[-1][1:3] if stack else (False, False)

    at = 0
    for m in _TAG.finditer(html):
        if m.start() > at:
            text = html[at : m.start()]
            parts.append(entities.unescape(text) if "&" in text else text)
        at = m.end()
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if tag in _BLOCK:
            flush()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if any(t in _BLOCK for t, *_ in stack[depth:]):
                        flush()
                    main, dropped = cut(depth)
                    break
            continue
        if tag in _VOID:
            continue
        ends, within = _CLOSES.get(tag, ("p", ("td", "th", "button", "object")) if tag in _BLOCK else ("", ()))
        if ends:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in within:
                    break
                if stack[depth][0] in ends.split():
                    flush()
                    main, dropped = cut(depth)
                    break
        other = _is_other(tag, attributes, main)
        dropped_now = dropped or other == _GONE
        if dropped_now != dropped or other == _DOUBTFUL:
            flush()
        if not attributes.rstrip().endswith("/") or tag in _BLOCK:
            number = -1
            if other == _DOUBTFUL and not dropped_now:
                number = len(doubtful)
                doubtful.append([len(lines), -1, main])
            opens = not main and (tag in _MAIN or 'role="main"' in attributes)
            if opens:
                flush()
                elements.append([len(lines), -1, tag])
            stack.append((tag, main or opens, dropped_now, number))
            main, dropped = stack[-1][1:3]
    rest = html[at:]
    if rest:
        parts.append(entities.unescape(rest) if "&" in rest else rest)
    flush()
    cut(0)
    return _placed(_settled(lines, doubtful), elements, doubtful)


def open_lines(lines: list[tuple[str, int, bool]]) -> list[int]:
    """Numbers of the lines that markup leaves to differencing: beside a main element only its cards, else all."""
    named = any(place == MAIN and not dropped for _, place, dropped in lines)
    return [k for k, (_, place, dropped) in enumerate(lines) if not dropped and (place == CARD if named else True)]


def main_text(lines: list[tuple[str, int, bool]], deleted: set[int]) -> str:
    kept = set(open_lines(lines)) - deleted
    return " ".join(text for k, (text, place, dropped) in enumerate(lines) if k in kept or place == MAIN and not dropped)


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions in ``a`` and ``b`` of a longest common subsequence (Hunt-Szymanski)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chain: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, j, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            else:
                ends[k], chain[k] = j, link
    middle = []
    link = chain[-1] if chain else None
    while link:
        middle.append(link[:2])
        link = link[2]
    middle.reverse()
    pairs = [(k, k) for k in range(head)] + middle + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]
    return [i for i, _ in pairs], [j for _, j in pairs]


_LIGHT = "host string, mark long, path string, hashes array<long>, open array<int>, by_size array<long>"
FREQUENT = 0.9  # share of a host's contents from which a line on them (and on five or more) names no content
USUAL = 0.5  # share from which a line tells kinds of near copies apart


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:(?:[a-zA-Z][\w+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def _hashes(lines: list[tuple[str, bool, bool]]) -> list[int]:
    return [xxhash.xxh64_intdigest(text) - (1 << 63) for text, _, _ in lines]


def _light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place, line hashes, lines open to deletion, and hashes of what is kept or open, longest line first, of every page."""
    for b in batches:
        out = []
        for host, mark, path, html in zip(*(c.to_pylist() for c in b.columns)):
            lines = page_lines(html) if html else []
            if lines:
                hashes, opened = _hashes(lines), open_lines(lines)
                kept = [k for k, (_, place, dropped) in enumerate(lines) if place == MAIN and not dropped] if opened else []
                by_size = sorted({*opened, *kept}, key=lambda k: (-len(lines[k][0]), k))
                out.append((host, mark, path, hashes, opened, [hashes[k] for k in by_size]))
        cols = list(zip(*out)) or [()] * 6
        kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds)],
            names=["host", "mark", "path", "hashes", "open", "by_size"],
        )


def _keyed(light: DataFrame) -> DataFrame:
    """``light`` with the key of each content: its longest line that is not frequent in the host.

    Contents of a host with one key are near copies. Pages that differencing deletes nothing from are
    their own key. ``kind`` tells near copies apart by the usual lines they have: a page cut off before its
    footer doesn't speak for the whole ones.
    """
    opened = light.where(F.size("open") > 0)
    lines = opened.select("host", F.explode(F.array_distinct("by_size")).alias("line")).groupBy("host", "line").count()
    totals = opened.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("contents"))
    frequent = lines.where("count >= 5").join(totals, F.col("host") == F.col("h")).where(
        F.col("count") > USUAL * F.col("contents")
    ).groupBy("h").agg(
        F.collect_set(F.when(F.col("count") > FREQUENT * F.col("contents"), F.col("line"))).alias("frequent"),
        F.sort_array(F.collect_set("line")).alias("usual"),
    )
    none = F.array().cast("array<long>")
    rest = F.filter("by_size", lambda x: ~F.array_contains(F.coalesce("frequent", none), x))
    keys = opened.join(frequent, F.col("host") == F.col("h"), "left").withColumn(
        "key", F.coalesce(F.get(rest, F.lit(0)), F.get("by_size", F.lit(0)))
    ).withColumn("kind", F.xxhash64(F.array_intersect(F.coalesce("usual", none), "by_size")))
    columns = ["host", "mark", "path", "hashes", "open", "key", "kind"]
    own = light.where(F.size("open") == 0).withColumn("key", F.col("mark")).withColumn("kind", F.lit(0).cast("long"))
    return keys.select(*columns).unionByName(own.select(*columns))


def _shared_by(a: dict, b: dict) -> list[tuple]:
    """What the neighbours a and b delete of each other, in page order; nothing of a page within the other."""
    if a["host"] != b["host"]:
        return []
    out = []
    for page, places in zip((a, b), common_lines(a["hashes"], b["hashes"])):
        deleted = [page["hashes"][k] for k in sorted(set(page["open"]).intersection(places))]
        if deleted and page["key"] not in deleted:
            out.append((page["host"], page["key"], deleted))
    return out


_DELETED = "host string, key long, deleted array<long>, edge struct<part:int,last:boolean,host:string,key:long,path:string,hashes:array<long>,open:array<int>>"


def _found(rows: list[tuple]) -> pd.DataFrame:
    columns = dict(zip(("host", "key", "deleted", "edge"), map(list, zip(*rows)))) if rows else {}
    of = {c: pd.Series(columns.get(c, []), dtype="Int64" if c == "key" else object) for c in ("host", "key", "deleted", "edge")}
    return pd.DataFrame(of)  # by column: keys beside a null would turn to floats and lose digits


def _neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Deleted lines within a sorted partition, and its first and last page."""
    part = TaskContext.get().partitionId()
    before = None
    for frame in frames:
        out = []
        for row in frame.to_dict("records"):
            row["hashes"] = list(row["hashes"])
            if before is None:
                out.append((None, None, None, {"part": part, "last": False, **row}))
            else:
                out.extend((*x, None) for x in _shared_by(before, row))
            before = row
        yield _found(out)
    if before is not None:
        out = [(None, None, None, {"part": part, "last": True, **before})]
        yield _found(out)


def _edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last page of a partition against the first page of the next; two rows a partition."""
    rows = [dict(e) for frame in frames for e in frame["edge"]]
    rows.sort(key=lambda e: (e["part"], e["last"]))
    out = [x for a, b in zip(rows, rows[1:]) if a["last"] and not b["last"] for x in _shared_by(a, b)]
    yield pd.DataFrame(out, columns=["host", "key", "deleted"])


def template_lines(pages: DataFrame) -> DataFrame:
    """(host, mark, deleted): hashes of the lines each content shares with its neighbours, a list for each.

    ``pages(host, mark, path, html)``; equal contents of a host are one, at their first path, and of
    near copies the first one of each kind stands for all, so that its neighbours are of other contents.
    """
    light = pages.mapInArrow(_light, _LIGHT).groupBy("host", "mark").agg(
        F.min("path").alias("path"), *(F.first(c).alias(c) for c in ("hashes", "open", "by_size"))
    )
    keyed = staged(_keyed(staged(light, "page-lines")), "page-keys")
    first = keyed.groupBy("host", "key", "kind").agg(F.min(F.struct("path", "mark", "hashes", "open")).alias("x")).select(
        "host", "key", "x.path", "x.hashes", "x.open"
    )
    order = ["host", "path", "key", "open"]
    found = staged(
        first.repartitionByRange(shuffle_partitions(pages.sparkSession), *order).sortWithinPartitions(*order)
        .mapInPandas(_neighbours, _DELETED),
        "page-neighbours",
    )
    edges = found.where("edge IS NOT NULL").select("edge").coalesce(1).mapInPandas(
        _edges, "host string, key long, deleted array<long>"
    )
    inner = found.where("deleted IS NOT NULL").select("host", "key", "deleted")
    deleted = inner.unionByName(edges).groupBy("host", "key").agg(F.collect_set("deleted").alias("deleted"))
    return keyed.where(F.size("open") > 0).select("host", "mark", "key").join(deleted, ["host", "key"]).select(
        "host", "mark", "deleted"
    )


_TEXT = "page_id long, url string, text string"


def page_text(html: str | None, deleted: list[list[int]] | None) -> str:
    lines = page_lines(html) if html else []
    gone: set[int] = set()
    if deleted:
        hashes = _hashes(lines)
        for template in deleted:
            gone.update(common_lines(hashes, template)[0])
    return main_text(lines, gone)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [page_text(html, deleted) for html, deleted in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    marked = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", _host(F.col("url")).alias("host"),
        _path(F.col("url")).alias("path"), F.xxhash64("html").alias("mark"),
    )
    deleted = staged(template_lines(marked.select("host", "mark", "path", "html")), "page-template").select(
        F.col("host").alias("h"), F.col("mark").alias("m"), "deleted"
    )
    both = marked.join(deleted, (F.col("host") == F.col("h")) & (F.col("mark") == F.col("m")), "left")
    out = both.select("page_id", "url", "html", "deleted").mapInArrow(_extract, _TEXT)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
