"""Main text of web pages by differencing each page against the page of its host with the nearest URL.

Pages of a host are paired by URL path, with the nearest that is neither a copy nor a near copy: copies say nothing
about the site. The text lines of a pair are aligned by their longest common subsequence, and shared lines go: they
belong to the site, not to the page. Markup says the rest: what stands in an element that by its
name, class or role is a menu, header, footer, sidebar, notice, advert, form or comment goes in any case, and lines of
an article element are never taken for the site's, since pages may quote each other. A page without an article element
keeps what neither markup nor its neighbour gives away.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import batched, bytes_of, partitions, stored

#: A page is a near copy of another one if the lines to remove and add are at most this share of the other's lines; at
#: equal length that is one line replaced in five.
NEAR = (2, 5)
#: Bits of alignment table held at once; longer pairs are halved first.
TABLE_BITS = 1 << 26

_ATTRS = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?:svg|math)\b[^>]*/>
    |<(?P<raw>script|style|noscript|template|textarea|select|svg|math|iframe|object|canvas|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<[!?][^>]*>
    |<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>{_ATTRS})>
    |<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:-]*)(?P<attrs2>[^>]*)>""",
    re.S | re.I | re.X,
)
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HELD = frozenset("article main nav header footer aside form div section ul ol dl table figure dialog menu button fieldset span p details body address".split())
_OUT = frozenset("nav footer aside form dialog menu button fieldset".split())
_SITE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies "
    "consent notice notices banner popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments "
    "disqus replies widget pagination pager toolbar login search skip gdpr".split()
)
#: Names that a section of an article may well have.
_TOPICS = frozenset("login search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
_NAMED = re.compile(r"""\b(class|id|role|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)""", re.I)
_SPACE = re.compile(r"\s+")


def _is_site(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _OUT or tag == "header" and not in_article:
        return True
    if not attrs.strip():
        return False
    for name, a, b, c in _NAMED.findall(attrs):
        value = (a or b or c).lower()
        name = name.lower()
        if name == "role":
            if value.strip() in _ROLES:
                return True
        elif name == "aria-hidden":
            if value.strip() == "true":
                return True
        elif tag not in ("body", "article", "main") and (_SITE - _TOPICS if in_article else _SITE).intersection(re.split(r"[^a-z0-9]+", value)):
            return True
        elif tag == "article" and {"comment", "comments", "replies"}.intersection(re.split(r"[^a-z0-9]+", value)):
            return True
    return bool(_HIDDEN.search(re.sub(r"""("[^"]*"|'[^']*')""", "", attrs)))


def lines_of(page: str) -> tuple[list[tuple[str, bool]], bool]:
    """Text lines that markup does not give away, each with whether it stands in an article; whether there is one."""
    lines: list[tuple[str, bool]] = []
    held: list[str] = []
    # Open elements: tag, whether it gives its text away, whether it is an article.
    stack: list[tuple[str, bool, bool]] = []
    out = articles = 0
    found = False

    def flush() -> None:
        if held and not out:  # text before an inline advert waits for what follows it
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                lines.append((text, articles > 0))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not out:
            held.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "wbr":
            if tag == "br" and not out:
                held.append(" ")
            continue
        if tag not in _INLINE:
            flush()
        if tag not in _HELD or tag in _VOID:
            continue
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        if m["end"] or m["end2"]:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            # A stray end of a small element does not close what surrounds it.
            if place >= 0 and not (tag in ("span", "p") and any(t not in ("span", "p") for t, _, _ in stack[place + 1 :])):
                for _, o, a in stack[place:]:
                    out -= o
                    articles -= a
                del stack[place:]
        elif not attrs.rstrip().endswith("/"):
            if tag == "p":  # a paragraph ends where the next one begins
                while stack and stack[-1][0] == "p":
                    out -= stack.pop()[1]
            if tag == "body":
                continue
            site = _is_site(tag, attrs, articles > 0)
            article = tag in ("article", "main") and not site
            if article and not out:
                found = True
            stack.append((tag, site, article))
            out += site
            articles += article
    if not out:
        held.append(page[at:])
    flush()
    return lines, found


def shared(a: list, b: list) -> list[int]:
    """Places in a of a longest common subsequence of a and b."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    middle = _lcs(a[lo : len(a) - hi], b[lo : len(b) - hi])
    return [*range(lo), *[lo + i for i in middle], *range(len(a) - hi, len(a))]


def _rows(a: list, b: list) -> Iterator[int]:
    """For each prefix of a, a number whose j-th bit is 0 where b's j-th line makes the subsequence longer."""
    masks: dict = defaultdict(int)
    for j, x in enumerate(b):
        masks[x] |= 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lcs(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    if len(a) * len(b) <= TABLE_BITS:
        table = list(_rows(a, b))
        out, i, j = [], len(a), len(b)
        while i and j:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                out.append(i)
            elif table[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
        return out[::-1]
    half = len(a) // 2
    size = len(b)

    def lengths(x: list, y: list) -> np.ndarray:
        for v in _rows(x, y):
            pass
        bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-size // 8), "little"), np.uint8), bitorder="little")[:size]
        return np.concatenate([[0], np.cumsum(bits == 0)])

    cut = int(np.argmax(lengths(a[:half], b) + lengths(a[half:][::-1], b[::-1])[::-1]))
    return _lcs(a[:half], b[:cut]) + [half + i for i in _lcs(a[half:], b[cut:])]


def address(url: str) -> tuple[str, str]:
    """Host and the rest of an address; two empty strings if it can't be read."""
    try:
        parts = urlsplit(url)
        return (parts.hostname or "").lower(), parts.path + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", ""


def _hashes(lines: list[tuple[str, bool]]) -> bytes:
    return np.array([xxhash.xxh3_64_intdigest(t.encode()) for t, _ in lines], "<u8").tobytes()


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for key, url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2))):
            rows.append((key, *address(url or ""), _hashes(lines_of(page.decode())[0])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.binary()))], ["key", "host", "path", "lines"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for page, places in zip(bytes_of(b.column(2)), b.column(3).to_pylist()):
            lines, has_article = lines_of(page.decode())
            site = set(np.frombuffer(places or b"", "<i4").tolist())
            keep = [t for i, (t, inside) in enumerate(lines) if (inside if has_article else i not in site)]
            texts.append("\n".join(keep))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


class _Page:
    """A page in the order of its host."""

    __slots__ = ("key", "path", "raw", "lines", "distinct", "limit")

    def __init__(self, key: int, path: str, raw: bytes):
        self.key, self.path, self.raw = key, path, raw
        self.lines = np.frombuffer(raw, "<u8").tolist()
        self.distinct = frozenset(self.lines)
        self.limit = NEAR[0] * len(self.lines) // NEAR[1]

    def apart(self, other: _Page, most: int) -> int:
        """Lines to remove and add; if there are more than `most`, some number above it that is not too large."""
        if self.raw == other.raw:
            return 0
        size = len(self.lines) + len(other.lines)
        least = size - 2 * min(sum(map(other.distinct.__contains__, self.lines)), sum(map(self.distinct.__contains__, other.lines)))
        return least if least > most else size - 2 * len(shared(self.lines, other.lines))

    def copied_by(self, other: _Page) -> bool:
        return self.apart(other, self.limit) <= self.limit


def unlike(pages: list[_Page]) -> list[int]:
    """For each page, the place of the last page before it that is neither its copy nor its near copy; -1 without one.

    Pages that follow each other and are close to the first of them make a group. Distances obey the triangle
    inequality, so a page steps over a whole group, or stops at it, by its distance from the group's first page.
    """
    out = []
    groups: list[list[int]] = []  # first and last place, greatest distance from the first
    for i, p in enumerate(pages):
        found = -1
        for first, last, radius in reversed(groups):
            d = p.apart(pages[first], p.limit + radius)
            if d + radius > p.limit:
                found = next((j for j in range(last, first - 1, -1) if d - radius > p.limit or not p.copied_by(pages[j])), -1)
            if found >= 0:
                break
        out.append(found)
        if groups:
            first, _, radius = groups[-1]
            close = pages[first].limit // 4
            d = p.apart(pages[first], close)
            if d <= close:
                groups[-1] = [first, i, max(radius, d)]
                continue
        groups.append([i, i, 0])
    return out


def _border(pages: list[_Page]) -> tuple[list[_Page], bool]:
    """The pages among which a page beyond the first of them finds its partner; whether it always finds one.

    Of copies the first is enough. No page is a near copy of two pages that are further apart than its own limits for
    both, so nothing behind the first such pair is looked at.
    """
    out, seen = [], set()
    for p in pages:
        if p.raw not in seen:
            seen.add(p.raw)
            out.append(p)
            # A near copy of the first page has at most n / (1 - NEAR) lines, and twice NEAR of them is its reach.
            most = 2 * NEAR[0] * len(pages[0].lines) // (NEAR[1] - NEAR[0])
            if pages[0].apart(p, most) > most:
                return out, True
    return out, False


def _same(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _site(p: _Page, before: _Page | None, after: _Page | None) -> bytes | None:
    """Places of the lines that p shares with the nearer one; ties go to the one before."""
    if before and after:
        near = after if _same(p.path, after.path) > _same(p.path, before.path) else before
    else:
        near = before or after
    return np.array(shared(p.lines, near.lines), "<i4").tobytes() if near else None


_PAIR = "kind int, range int, side int, place int, host string, closed boolean, key long, path string, lines binary, site binary, a_path string, a_lines binary, b_path string, b_lines binary"
_PAIR_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("range", pa.int32()), ("side", pa.int32()), ("place", pa.int32()), ("host", pa.string()), ("closed", pa.bool_()), ("key", pa.int64()), ("path", pa.string())]
    + [("lines", pa.binary()), ("site", pa.binary()), ("a_path", pa.string()), ("a_lines", pa.binary()), ("b_path", pa.string()), ("b_lines", pa.binary())]
)
#: Rows of the pairing: a page with its site lines, a page at a border, a page whose partner may lie beyond one.
DONE, BORDER, OPEN = 0, 1, 2


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs the pages of one range, and writes down what lies at its borders."""

    def ordered() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(b.column(i).to_pylist() for i in range(5)))

    def hosts() -> Iterator[tuple[int, str, list[_Page]]]:
        for (number, host), rows in groupby(ordered(), key=lambda r: r[:2]):
            yield number, host, [_Page(key, path, raw) for _, _, path, key, raw in rows]

    def rows() -> Iterator[tuple]:
        all_hosts = hosts()
        at = next(all_hosts, None)
        is_first = True
        while at:
            (number, host, pages), at = at, next(all_hosts, None)
            is_last = at is None
            for side, edge, order in ((0, is_last, pages[::-1]), (1, is_first, pages)):
                if edge:  # seen by pages after the range (side 0) or before it (side 1)
                    border, closed = _border(order)
                    for i, p in enumerate(border):
                        yield (BORDER, number, side, i, host, closed or not (is_first and is_last), p.key, p.path, p.raw, *[None] * 5)
            before = unlike(pages)
            after = [len(pages) - 1 - j if j >= 0 else -1 for j in unlike(pages[::-1])[::-1]]
            for p, i, j in zip(pages, before, after):
                a, b = (pages[x] if x >= 0 else None for x in (i, j))
                if not a and is_first or not b and is_last:
                    yield (OPEN, number, None, None, host, None, p.key, p.path, p.raw, None, *((a.path, a.raw) if a else (None, None)), *((b.path, b.raw) if b else (None, None)))
                else:
                    yield (DONE, number, None, None, None, None, p.key, None, None, _site(p, a, b), *[None] * 4)
            is_first = False

    return batched(rows(), _PAIR_SCHEMA)


_REST_SCHEMA = pa.schema([("key", pa.int64()), ("site", pa.binary())])


def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs open pages with those at the borders of other ranges; a range's border pages come before its open pages."""

    def ordered() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)))

    def rows() -> Iterator[tuple]:
        for _, of_range in groupby(ordered(), key=lambda r: r[0]):
            borders: dict[tuple, list[_Page]] = defaultdict(list)
            seen: set[tuple] = set()
            known: dict[tuple, _Page | None] = {}
            for _, kind, side, _, _, host, key, path, raw, a_path, a_raw, b_path, b_raw in of_range:
                if kind == BORDER:
                    if (side, host, raw) not in seen:
                        seen.add((side, host, raw))
                        borders[side, host].append(_Page(key, path, raw))
                    continue
                p = _Page(key, path, raw)
                sides = []
                for n, at, lines in ((0, a_path, a_raw), (1, b_path, b_raw)):
                    if lines is not None:
                        sides.append(_Page(0, at, lines))
                        continue
                    if (n, host, raw) not in known:
                        known[n, host, raw] = next((q for q in borders[n, host] if not p.copied_by(q)), None)
                    sides.append(known[n, host, raw])
                yield key, _site(p, *sides)

    return batched(rows(), _REST_SCHEMA)


def _looked_at(edges: list) -> list[tuple[int, int, int, int]]:
    """(to, range, side, step): whose borders the open pages of a range look at, the nearest range first."""
    out = []
    for side, step in ((0, -1), (1, 1)):
        host = {r.range: r.host for r in edges if r.side != side}  # of a range's own pages on that side
        border = {r.range: (r.host, r.closed) for r in edges if r.side == side}
        numbers = sorted(border)
        for i, to in enumerate(numbers):
            j = i + step
            while 0 <= j < len(numbers) and border[numbers[j]][0] == host[to]:
                out.append((to, numbers[j], side, abs(i - j)))
                if border[numbers[j]][1]:
                    break
                j += step
    return out


def site_lines(outlines: DataFrame) -> DataFrame:
    """(key, site): for each page, the places of the lines it shares with the page of its host whose path shares the
    longest prefix and that is neither a copy nor a near copy of it; null where the host has no such page.

    The pages lie in ranges of their order, of whatever host, so the size of a host changes nothing. Pages near an end
    of a range are paired in a second step with what lies at the borders of the ranges around. One row for each border
    (its host, and whether it ends the search) reaches the driver: as many as there are tasks.
    """
    spark = outlines.sparkSession
    n = partitions(spark)
    ranges = outlines.repartitionByRange(n, "host", "path", "key").sortWithinPartitions("host", "path", "key")
    found = stored(ranges.select(F.spark_partition_id().alias("range"), "host", "path", "key", "lines").mapInArrow(_pair, _PAIR))
    edges = found.where((F.col("kind") == BORDER) & (F.col("place") == 0)).select("range", "side", "host", "closed").collect()
    pairs = spark.createDataFrame(_looked_at(edges), "to int, range int, side int, step int")
    page = ["host", "key", "path", "lines", "a_path", "a_lines", "b_path", "b_lines"]
    border = found.where(F.col("kind") == BORDER).join(pairs, ["range", "side"]).select("to", "kind", "side", "step", "place", *page)
    still = found.where(F.col("kind") == OPEN).select(F.col("range").alias("to"), "kind", "side", F.lit(None).cast("int").alias("step"), "place", *page)
    rest = border.union(still).repartition(n, "to").sortWithinPartitions("to", "kind", "side", "step", "place").mapInArrow(_beyond, "key long, site binary")
    return found.where(F.col("kind") == DONE).select("key", "site").union(rest)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row.

    A null or empty page has an empty text. Where a page has an article or main element, the text is what that element
    holds, and lines beside it are left out. Long pages are read whole. Pages whose address is null or can't be read share a host without a name.
    Repeated rows give repeated rows and are one page for the pairing; an empty table gives no rows. On a host whose
    pages are all copies or near copies, nothing tells site from text, and lines that markup does not name stay. Other
    columns are not looked at, whatever their names.
    """
    url, page = F.col(url_col).alias("url"), F.col(html_col).alias("html")
    key = F.xxhash64(F.col(id_col), F.col(url_col), F.col(html_col)).alias("key")
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), key, url, page)
    outlines = stored(given.select("key", "url", "html").mapInArrow(_outline, "key long, host string, path string, lines binary").dropDuplicates(["key"]))
    joined = given.join(site_lines(outlines), "key", "left").select("page_id", "url", "html", "site")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
