"""Main text of web pages: markup rules first, then a suffix array per host for what they leave.

Markup decides what is surely furniture (navigation, scripts, adverts, forms, comments ...) and which
blocks a page marks as its article; all others are *open*.  For both the host decides: token
streams of its pages, all blocks one after another, are put together; long substrings that stand in several
distinct pages, and in a share of all of them, are found by suffix sorting; blocks covered by them go.
Copies of a page count as one page, and a marked article never goes as a whole: copies of an article
are no furniture, however many there are.  Streams are grouped by anchors (see ``repeats``), so a host with
a third of all pages is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import small
from .common import limit_batches, same_row, stored
from .repeats import BROADCAST, LEAST_PAGES, Windows, merged, repeated_spans, run_lengths
from .suffix_dedup import _dense
from .windows import word_bounds, word_codes

# Fixed values of HTML: elements whose content is never text, elements that begin a new block, elements
# without an end, and names (of elements, classes, ids, roles) of what surrounds an article.
RAW = frozenset("script style noscript template iframe object svg canvas head title textarea select".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
                    "td tfoot th thead tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav aside footer form menu dialog button".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NAMES = frozenset(("ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation menu breadcrumb breadcrumbs "
                   "sidebar aside widget widgets footer header masthead topbar cookie cookies consent gdpr notice notices notification alert "
                   "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
                   "comment comments commentlist disqus discussion respond reply replies pagination pager skip search").split())
# A tag without angle brackets in its quotes, which is nearly all of them; others are looked at one quote at a time.
_TAG = re.compile(r"""</?[a-zA-Z][^<>'"]*+(?:"[^"<>]*+"[^<>'"]*+|'[^'<>]*+'[^<>'"]*+)*+>""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""")
_HIDDEN = re.compile(r"(?<!\S)hidden(?=[\s/>])", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?![^\s/>])[^>]*>?", re.I) for tag in RAW}
_SPACES = re.compile(r"\s+")
MAIN, OPEN, OUT = "M", "O", "X"


class _Ends:
    """Where tags of a page end, quotes minded.  What is found, or found missing, once is not searched again, so all
    searches together take time in proportion to the page."""

    def __init__(self, page: str):
        self.at = [m.start() for m in re.finditer("['\">]", page)]
        self.mark = [page[i] for i in self.at]
        later: dict[str, int | None] = {"'": None, '"': None}
        self.twin: list[int | None] = [None] * len(self.at)
        for i in range(len(self.at) - 1, -1, -1):
            if self.mark[i] != ">":
                self.twin[i], later[self.mark[i]] = later[self.mark[i]], i
        self.known: dict[int, int | None] = {}

    def of(self, start: int) -> int | None:
        """Behind the first ``>`` from ``start`` on that is not in quotes."""
        i, seen, end = bisect_left(self.at, start), [], None
        while i < len(self.at):
            if i in self.known:
                end = self.known[i]
                break
            seen.append(i)
            if self.mark[i] == ">":
                end = self.at[i] + 1
                break
            if self.twin[i] is None:
                break
            i = self.twin[i] + 1
        self.known.update(dict.fromkeys(seen, end))
        return end


def _tokens(page: str):
    """Texts and tags of a page in order, as they stand.  A ``<`` that begins no tag is text.  The caller may say where to go on."""
    at, ends = 0, None
    while at < len(page):
        less = page.find("<", at)
        if less != at:
            stop = less if less >= 0 else len(page)
            yield page[at:stop], stop
            at = stop
            continue
        second = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = stop + 3 if stop >= 0 else len(page)
            continue
        if second in ("!", "?"):
            stop = page.find(">", at)
            at = stop + 1 if stop >= 0 else len(page)
            continue
        stop = None
        letter = page[at + 2:at + 3] if second == "/" else second
        if letter.isascii() and letter.isalpha():
            quick = _TAG.match(page, at)
            if quick:
                stop = quick.end()
            else:
                ends = ends or _Ends(page)
                stop = ends.of(at)
        stop = at + 1 if stop is None else stop
        moved = yield page[at:stop], stop
        at = stop if moved is None else moved
        if moved is not None:
            yield "", at


def _is_furniture(tag: str, attributes: dict[str, str], hidden: bool, in_main: bool) -> bool:
    """Whether the element itself, its role or its style says so."""
    if tag in FURNITURE or tag == "header" and not in_main:
        return True
    if hidden or attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden") == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")))


def _is_named(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a class or the id is a listed name, or put together of listed names only (cookie-notice, but not no-sidebar)."""
    if tag in ("html", "body", "article", "main") or attributes.get("role") == "main":
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    parts = ([p for p in re.split(r"[^a-z0-9]+", n) if p] for n in names)
    return any(p and all(x in NAMES for x in p) for p in parts)


@dataclass
class _Suspect:
    """An element that its name, role or style (``sure``), or else its class or id, takes for furniture."""
    parent: int
    sure: bool
    nested: bool  # inside an article: articles in it are comments and the like
    holds: bool = False  # an article or main outside of sure furniture
    holds_any: bool = False


def _decided(suspects: list[_Suspect], any_main: bool, names: bool) -> list[bool]:
    """For each suspect whether it, or one around it, is furniture.  No name decides for what holds an article or main outside of
    sure furniture; with ``any_main`` no element, role or style does for what holds one; without ``names`` classes and ids say
    nothing."""
    for s in reversed(suspects):
        if s.parent >= 0:
            up = suspects[s.parent]
            up.holds, up.holds_any = up.holds or s.holds and not s.sure, up.holds_any or s.holds_any
    out: list[bool] = []
    for s in suspects:
        kept = (any_main and s.holds_any if s.sure else s.holds) and not s.nested
        out.append(s.parent >= 0 and out[s.parent] or not kept and (s.sure or names))
    return out


def page_blocks(page: str) -> list[tuple[str, str, float]]:
    """Blocks of a page in order: what they are (main, open, out), text, share of it in links.

    Elements, roles, styles and names tell what is furniture, but no name decides for what holds an article or main.
    If a page has no article outside of furniture, elements do not either: an article in a form, a dialog or a menu that
    was never closed counts.  If a page without any article has nothing left, names say nothing.  What is nested in an
    article (HTML: comments and the like) clears nothing inside that article.  Broken markup is read as far as it goes: a tag that never ends is
    text, end tags of what is not open mean nothing; the time is in proportion to the page.
    """
    out: list[tuple[int, bool, str, float]] = []
    # Open elements: name, innermost suspect around, inside a marked element, inside an article, inside a link.
    stack: list[tuple[str, int, bool, bool, bool]] = [("", -1, False, False, False)]
    suspects: list[_Suspect] = []
    # Places on the stack of each name, of blocks, and of what only its own end tag ends.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    walls: list[int] = []
    text: list[str] = []
    linked = 0

    def close_block():
        nonlocal linked
        told = _SPACES.sub(" ", "".join(text)).strip()
        if told:
            out.append((stack[-1][1], stack[-1][2], told, linked / max(1, len(told))))
        text.clear()
        linked = 0

    def close_from(i: int):
        while len(stack) > i:
            tag = stack.pop()[0]
            places[tag].pop()
            if tag in BLOCKS:
                blocks.pop()
            if tag in ("article", "main", "body"):
                walls.pop()

    tokens = _tokens(page)
    moved = None
    while True:
        try:
            token, at = tokens.send(moved)
        except StopIteration:
            break
        moved = None
        if not token:
            continue
        if token[0] != "<" or token == "<":
            told = html.unescape(token)
            text.append(told)
            if stack[-1][4]:
                linked += len(told)
            continue
        name = _NAME.match(token)
        tag = name.group(1).lower()
        if token[1] == "/":
            if tag in BLOCKS:
                close_block()
            found = places.get(tag)
            if found and (tag in ("article", "main", "body", "html") or not walls or found[-1] > walls[-1]):
                close_from(found[-1])
            continue
        if tag in RAW:
            if not token.endswith("/>") and tag != "head":
                # Only its own end tag ends it: a '<' inside is no tag.
                end = _RAW_END[tag].search(page, at)
                moved = end.end() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            close_block()
            if blocks and stack[blocks[-1]][0] == "p":  # a new block ends an open paragraph and what was left open in it
                close_from(blocks[-1])
        if tag in VOID or token.endswith("/>"):
            continue
        rest = token[len(name.group()):]
        attributes = {a.lower(): x or y or z for a, x, y, z in _ATTRIBUTE.findall(rest)}
        _, suspect, main, article, link = stack[-1]
        hidden = "hidden" in attributes or bool(_HIDDEN.search(rest) and _HIDDEN.search(_ATTRIBUTE.sub(" ", rest)))
        if _is_furniture(tag, attributes, hidden, main):
            suspects.append(_Suspect(suspect, True, article))
            suspect = len(suspects) - 1
        if tag in ("article", "main") or attributes.get("role") == "main":
            main = True
            if suspect >= 0:
                suspects[suspect].holds_any = True
                suspects[suspect].holds = not suspects[suspect].sure
        if _is_named(tag, attributes):
            suspects.append(_Suspect(suspect, False, article))
            suspect = len(suspects) - 1
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            blocks.append(len(stack))
        if tag in ("article", "main", "body"):
            walls.append(len(stack))
        stack.append((tag, suspect, main, article or tag == "article", link or tag == "a"))
    close_block()
    kind = lambda gone, s, main: OUT if s >= 0 and gone[s] else MAIN if main else OPEN
    kinds: list[str] = []
    for any_main, names in ((False, True), (True, True), (True, False)):
        gone = _decided(suspects, any_main, names)
        kinds = [kind(gone, s, main) for s, main, _, _ in out]
        marked = any(s.holds_any for s in suspects)
        if MAIN in kinds or OPEN in kinds and (any_main or not marked) or any_main and marked:
            break
    return [(k, told, share) for k, (_, _, told, share) in zip(kinds, out)]


@dataclass(frozen=True)
class HostWindows(Windows):
    """Windows over the tokens of a stream; its first line is the host, which belongs to every token."""

    def units(self, text: bytes) -> np.ndarray:
        host, _, stream = text.partition(b"\n")
        own = word_codes(host or b"-")
        return word_codes(stream) * own[0]

    def bounds(self, text: bytes):
        host, _, stream = text.partition(b"\n")
        begin, end = word_bounds(stream)
        return begin + len(host) + 1, end + len(host) + 1

    def cut(self, text: bytes, bounds, start: int, windows: int) -> bytes:
        return text.partition(b"\n")[0] + b"\n" + super().cut(text, bounds, start, windows)


def host_windows(length: int) -> HostWindows:
    """Shared windows of ``length`` tokens.  Shorter anchors make fewer segments to count (2 in 7 windows begin one at 3 of 8
    tokens, 1 in 3 at 4 of 8); what an anchor takes in by chance is told apart by content."""
    return HostWindows(length, max(1, length * 3 // 8), words=True, rule="shared")


def host_suffix_index(length: int):
    """Index for ``repeats``: suffixes of all streams in a shard, sorted by their first ``length`` tokens
    (ranks by doubling).  Windows with equal neighbours are told with the set of segments that hold them."""
    def look(data, n, first, last, windows, at):
        parts = []
        for d in data:
            host, _, stream = d.partition(b"\n")
            parts.append(word_codes(stream) * word_codes(host or b"-")[0])
        sizes = np.array([len(p) for p in parts])
        tokens = np.concatenate(parts)
        _, rank = _dense([tokens])
        width = 1
        while width * 2 <= length:
            _, short = _dense([rank[:-width], rank[width:]]) if len(rank) > width else (None, rank[:0])
            rank, width = short, width * 2
        starts = np.cumsum(sizes) - sizes
        begin = np.concatenate([np.arange(s, s + w) for s, w in zip(starts.tolist(), windows.tolist())])
        owner = np.repeat(np.arange(len(data)), windows)
        order, place = _dense([rank[begin], rank[begin + length - width]])
        groups = int(place.max(initial=-1)) + 1
        # The code of a set is the sum of its members' codes.
        member = np.array([int.from_bytes(hashlib.blake2b(d, digest_size=8).digest(), "big") for d in data], dtype=np.uint64)
        pairs = np.unique(place * len(data) + owner)
        held = np.zeros(groups, dtype=np.uint64)
        np.add.at(held, pairs // len(data), member[pairs % len(data)])
        hit = np.bincount(place, weights=n[owner], minlength=groups)[place] >= LEAST_PAGES
        cuts = np.cumsum(windows)[:-1]
        return [run_lengths(f, h) for f, h in zip(np.split(held.view(np.int64)[place], cuts), np.split(hit, cuts))]
    return look


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.regexp_replace(host, r"\s+", ""))


def _page(host: str, blocks: list[tuple[str, str, float]]) -> int:
    """Number of a page: pages of a host whose blocks outside of furniture are equal are copies of one page."""
    body = "\n".join([host, *(f"{kind} {t}" for kind, t, _ in blocks if kind != OUT)])
    return int.from_bytes(hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _kept(blocks: list[tuple[str, float, str, int, int]], length: int, covered: float, links: float) -> list[str]:
    """Texts of the blocks that stay; blocks are kind, share of links, text, words, words in shared substrings.

    Neighbours that are mostly links are one list: it goes if it is covered, or too short to be covered.  Beside a
    marked article other open neighbours go as well if what is left of them is too short.
    If all blocks of a marked article are covered, all stay."""
    out = []
    whole = lambda b: b[4] >= covered * max(1, b[3])
    main = [b for b in blocks if b[0] == MAIN]
    copied = all(map(whole, main))
    for (kind, linked), run in groupby(blocks, lambda b: (b[0], b[0] == OPEN and b[1] > links)):
        run = list(run)
        size, hit = sum(b[3] for b in run), sum(b[4] for b in run)
        if kind == OUT or linked and (size < length or hit >= covered * size):
            continue
        left = [b for b in run if linked or kind == MAIN and copied or not whole(b)]
        if kind == MAIN or linked or not main or sum(b[3] for b in left) >= length:
            out += [b[2] for b in left]
    return out


def _result(batch, count: int, kept: list[list[str]], names: list[str]) -> pa.RecordBatch:
    told = ["\n\n".join(k) for k in kept]
    return pa.RecordBatch.from_arrays([*batch.columns[:count], pa.array(told, pa.string()), pa.array([len(t) for t in told], pa.int64())],
                                      names=names)


def extract_text(pages: DataFrame, length: int = 8, covered: float = 0.8, links: float = 0.5, markup: str = "html", key: str = "page_id",
                 url: str = "url", share: float = 0.5) -> DataFrame:
    """``key, url, text, n_chars`` per input row: the main text, blocks joined by blank lines.

    White space inside a block becomes one space, character references are decoded.  Null and empty
    pages give empty text.  Blocks outside of furniture stay unless at least ``covered`` of their tokens lie in
    substrings of ``length`` or more tokens that stand in at least three pages and a ``share`` of all pages of the host;
    an article that the page marks stays as it is if all of its blocks would go.  Beside it, open neighbours of together fewer
    than ``length`` words, on which no substring can decide, go.
    A list of blocks with more than ``links`` of their characters in links goes by the same rule as a whole, or if it
    has fewer than ``length`` words, which no substring can cover.  Pages without a host form one host.  Rows of the
    same id are one page, and so are pages whose blocks outside of furniture are equal: copies of a page cover
    nothing.  Other columns are ignored.
    """
    limit_batches(pages.sparkSession)
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), F.xxhash64(F.col(markup)).alias("_h"), host_of(F.col(url)).alias("_host"), F.xxhash64(host_of(F.col(url))).alias("_site"),
                        F.coalesce(F.col(markup), F.lit("")).alias("_html"))
    id_type = pages.schema[key].dataType
    schema = T.StructType([T.StructField(key, id_type), T.StructField(url, T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = [key, url, "text", "n_chars"]

    def streams(batches):
        """Host line, then a line per block, led by its kind and share of links."""
        for b in batches:
            out, page = [], []
            for host, h in zip(b.column("_host").to_pylist(), b.column("_html").to_pylist()):
                blocks = page_blocks(h)
                page.append(_page(host, blocks))
                out.append("\n".join([host or "-", *(f"{kind}{round(share * 100)} {t}" for kind, t, share in blocks)]))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_url"), b.column("_h"), b.column("_site"), pa.array(page, pa.int64()), pa.array(out, pa.string())],
                                             names=["_id", "_url", "_h", "_site", "_page", "_text"])

    def decided(batches):
        for b in batches:
            kept = []
            for stream, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                blocks = stream.split("\n")[1:]
                hit = np.zeros(sum(len(t.encode().split()) for t in blocks) + 1, dtype=np.int64)
                for a, z in merged(spans):
                    hit[a:z] = 1
                at, told = 0, []
                for block in blocks:
                    size = len(block.encode().split())
                    kind, text = block.split(" ", 1)
                    told.append((kind[0], int(kind[1:]) / 100, text, size - 1, int(hit[at + 1:at + size].sum())))
                    at += size
                kept.append(_kept(told, length, covered, links))
            yield _result(b, 2, kept, names)

    # The streams are needed several times.
    stream = stored(rows.mapInArrow(streams, T.StructType([
        T.StructField("_id", id_type), T.StructField("_url", T.StringType()), T.StructField("_h", T.LongType()), T.StructField("_site", T.LongType()),
        T.StructField("_page", T.LongType()), T.StructField("_text", T.StringType())])), "streams", level=9)
    spec = host_windows(length)
    sites = stream.groupBy("_site").agg(F.countDistinct("_page").alias("_p"), F.countDistinct(F.coalesce("_id", "_page")).alias("_i"))
    enough = stored(sites.select("_site", F.greatest(F.ceil(F.round(F.least("_p", "_i") * share, 6)), F.lit(LEAST_PAGES)).alias("_least")), "sites")
    spans = repeated_spans(stream.select("_id", "_h", "_text", "_page", "_site"), spec, host_suffix_index(length), enough)
    spans = small(stored(spans, "spans"), BROADCAST)
    rest = stream.join(spans, same_row(stream, spans), "left").select(stream["_id"], "_url", "_text", "spans")
    return rest.mapInArrow(decided, schema)
