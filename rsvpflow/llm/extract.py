"""Main text of web pages with a host suffix array (operator 2).

1. A page is read once into blocks of text in page order.  Markup, scripts, styles and elements that announce menus, headers,
   footers, sidebars, notices, adverts, forms or comments (by tag, role, or a whole token of class or id) leave no block,
   but an element that holds the page's article, or its first heading and most of its text, is a wrapper and stays; a block
   knows whether it stands inside an article element.
2. The distinct pages of a host are dealt by hash into chunks of ``chunk_pages`` in the mean.  A chunk concatenates the token streams
   of its pages, every page closed by a mark of its own, and sorts the suffixes by prefix doubling until equal neighbours
   share ``DEPTH`` tokens; tokens are compared, not hashes.  Places whose substring stands on the share of the chunk's pages
   that the host demands are joined into maximal runs, which the chunk emits.  What reaches a share of the host's pages
   reaches it in some chunk, so no repeat is missed.
3. The runs of all chunks are counted on all pages of the host, window by window (``DEPTH`` tokens, 64-bit hashes of token
   hashes), and decided on the host's distinct pages: inside an article a repeat must stand on half of them, at least eight,
   elsewhere on a fifth (from 35 pages on ``enough``, from 70 on a tenth), at least ``least``.
4. A block whose tokens are covered by boilerplate is removed; blocks with unique runs stay.  If a page has article blocks,
   only those remain.

A host's repeats stand on a tenth of its pages at least, so they hold no more than ten mean pages of it.  They are sent to the
tasks whole within the bounds of a broadcast; beyond, they travel in front of each slot of the host's pages.

Defined cases: null html counts as empty and gives an empty text; pages with null url or no host are compared with no other
page; repeated pages count once towards boilerplate and give a row each; extra columns are ignored; an empty table gives
an empty result; unclosed elements end with their parent, end tags without a start are ignored.  Pages are read whole,
however long; a task holds one chunk.
"""

from __future__ import annotations

import hashlib
import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import arrow_schema, map_slices, share, slices
from rsvpflow.operators.joins import fits_broadcast, key_join, materialized
from rsvpflow.session import work_dir

DEPTH = 8
#: Pages of a chunk, in the mean, that its length does not lower.
MIN_PAGES = 32
#: Pages that share one copy of their host's boilerplate where it is too large to send to the tasks.
SLOT_PAGES = 512
SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_boilerplate long"

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_ATTRS = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
#: Announced elements that are no wrapper, whatever they hold.
_HARD = frozenset("nav footer script style noscript template iframe svg math canvas object button select textarea head title menu audio "
                  "video map".split())
_RAW = frozenset(("script", "style", "textarea", "title", "xmp", "noembed", "noframes"))
_CLOSE = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
_DROP = frozenset("nav footer aside form script style noscript template iframe svg math canvas object button select textarea "
                  "head title menu dialog audio video map".split())
_HEADS = frozenset(("header",))
_KEEP = frozenset(("article", "main"))
#: Words of class and id names that announce something beside the article.
_CHROME = frozenset("nav navbar navigation menu sidebar footer banner cookie cookies consent gdpr notice notices alert advert "
                    "adverts advertisement ad ads adsense promo promotion sponsor sponsored comment comments disqus reply replies "
                    "respond share sharing social related recommended breadcrumb breadcrumbs pagination pager popup modal overlay "
                    "subscribe subscription newsletter signup login widget toolbar masthead topbar skip sitemap".split())
#: Words that may stand beside them in one name.
_BESIDE = frozenset("site main top bottom left right side bar box list item items area section wrapper container block global primary "
                    "secondary header head body inner outer panel form links buttons button icons media post posts articles page "
                    "thread message text title bg fixed sticky mobile desktop wp js c l u".split())
#: Names of the element that holds the article.
_CONTENT = frozenset("content main article post entry story page-content main-content post-content entry-content article-content "
                     "article-body post-body entry-body hentry".split())
_ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu menubar toolbar form".split())
#: An opening tag of the first kind ends an open element of the second.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",)}


def _names_chrome(name: str) -> bool:
    """True for a name such as ``menu``, ``site-footer`` or ``comment_list``, not for ``has-sidebar`` or ``no-comments``."""
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    return not _CHROME.isdisjoint(parts) and all(x in _CHROME or x in _BESIDE for x in parts)


def _announces(tag: str, attrs: str, in_article: bool) -> bool:
    """True for an element that holds no main text."""
    if tag in _DROP or (tag in _HEADS and not in_article):
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    names: list[str] = []
    for name, a, b, c in _ATTRS.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            names += value.split()
        elif name == "role" and value in _ROLES:
            return True
        elif (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return True
    if names and tag not in ("body", "html", "main") and _CONTENT.isdisjoint(names):
        if any(_names_chrome(x) or (x == "header" and not in_article and tag not in _KEEP) for x in names):
            return True
    return re.search(r"(?:^|\s)hidden(?:\s|$|=)", attrs) is not None


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside an article) of the blocks outside of announced elements, in page order."""
    page = page or ""
    found: list[tuple[str, bool, tuple]] = []  # text, inside an article, numbers of the announced elements around it
    open_: list[tuple[str, bool, bool]] = []  # tag, announced, article
    solid: list[int] = []  # places of the open elements that are not inline
    places: dict[str, list[int]] = {}  # places of the open elements of a tag
    within: tuple = ()
    hard = articles = count = 0
    holds: set[int] = set()  # announced elements that hold an article
    free = False  # an article stands outside of all of them, so what they hold is not the page's
    heading: tuple | None = None
    buf: list[str] = []

    def flush() -> None:
        if buf:
            text = " ".join(_html.unescape("".join(buf)).split())
            if text:
                found.append((text, articles > 0, within))
            buf.clear()

    def pop(to: int) -> None:
        nonlocal hard, articles, within
        while len(open_) > to:
            tag, d, a = open_.pop()
            places[tag].pop()
            if solid and solid[-1] == len(open_):
                solid.pop()
            if d:
                within = within[0]
                hard -= tag in _HARD
            articles -= a

    pos, n = 0, len(page)
    while pos < n:
        m = _TAG.search(page, pos)
        if not m:
            if not hard:
                buf.append(page[pos:])
            break
        if m.start() > pos and not hard:
            buf.append(page[pos:m.start()])
        if m.group(1):
            end = page.find("-->", m.end())
            pos = n if end < 0 else end + 3
            continue
        rest = _REST.match(page, m.end())
        end = rest.end() if rest else page.find(">", m.end()) + 1
        pos = end or n
        if m.group(2) or not end:
            continue
        tag, attrs = m.group(4).lower(), page[m.end():end - 1]
        if m.group(3):
            at = places[tag][-1] if places.get(tag) else -1
            if tag not in _INLINE:
                flush()
            if at >= 0 and not (tag in _INLINE and solid and solid[-1] > at):
                if open_[at][1]:
                    flush()
                pop(at)
            continue
        if tag not in _INLINE:
            flush()
            if tag not in _VOID and solid:  # a block ends an open paragraph, an item the item before it
                t = open_[solid[-1]][0]
                if t == "p" or t in _ENDS.get(tag, ()):
                    pop(solid[-1])
        if tag in _VOID or attrs.endswith("/"):
            continue
        drop = _announces(tag, attrs, articles > 0)
        if tag in _RAW:
            close = _CLOSE[tag].search(page, pos)
            if not drop and close and not hard:
                buf.append(page[pos:close.start()])
            pos = close.end() if close else n
            continue
        article = tag in _KEEP or "articlebody" in attrs.lower()
        if drop:
            flush()
            count += 1
            within = (within, count)
            hard += tag in _HARD
        elif article and not hard:
            free = free or not within
            around = within
            while around and around[1] not in holds:
                holds.add(around[1])
                around = around[0]
        if tag == "h1" and heading is None and not hard:
            heading = within
        places.setdefault(tag, []).append(len(open_))
        if tag not in _INLINE:
            solid.append(len(open_))
        open_.append((tag, drop, article))
        articles += article
    flush()
    if not any(w for _, _, w in found):
        return [(t, a) for t, a, _ in found]
    if free:
        holds.clear()
    elif heading and not holds:  # no article: a wrapper holds the first heading and most of the text
        around, inside = heading, {}
        while around:
            inside[around[1]] = 0
            around = around[0]
        whole, inmost = 0, {k: k for k in inside}  # the inmost wrapper around an announced element
        for t, _, w in found:
            whole += len(t)
            path = []
            while w and w[1] not in inmost:
                path.append(w[1])
                w = w[0]
            at = inmost[w[1]] if w else 0
            inmost.update(dict.fromkeys(path, at))
            if at:
                inside[at] += len(t)
        around, more = heading, 0
        while around:  # from the inmost wrapper outwards, text adds up
            more += inside[around[1]]
            if 2 * more > whole:
                holds.add(around[1])
            around = around[0]
    stays: dict[int, bool] = {}

    def kept(w: tuple) -> bool:
        path = []
        while w and w[1] not in stays:
            path.append(w[1])
            w = w[0]
        ok = stays[w[1]] if w else True
        for x in reversed(path):
            ok = stays[x] = ok and x in holds
        return ok

    return [(t, a) for t, a, w in found if kept(w)]


class _Words(dict):
    """64-bit hashes of words, remembered; 0 and 1 are marks."""

    def __missing__(self, w: str) -> int:
        h = self[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little") | 2
        return h


class Suffixes:
    """Token hashes of a page and hashes of its windows of ``DEPTH`` tokens; 1 ends a block and 0 the page."""

    def __init__(self, most: int = 500_000):
        self.known, self.most = _Words(), most

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token hashes, block numbers) of a page; the end of the page has block -1."""
        if len(self.known) > self.most:
            self.known.clear()
        known, toks, sizes = self.known.__getitem__, [], []
        for text in texts:
            ws = text.split()
            toks += map(known, ws)
            toks.append(1)
            sizes.append(len(ws) + 1)
        toks.append(0)
        return np.array(toks, dtype=np.uint64), np.append(np.repeat(np.arange(len(sizes)), sizes), -1)

    def __call__(self, toks: np.ndarray) -> np.ndarray:
        n = len(toks) - DEPTH + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        out = np.zeros(n, dtype=np.uint64)
        for j in range(DEPTH):
            out = out * np.uint64(0x9E3779B97F4A7C15) + toks[j:j + n]
            out ^= out >> np.uint64(29)
        return out.view(np.int64)


def suffix_ranks(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(ranks, page numbers) of the suffixes of the concatenated streams, in the order of their first ``DEPTH`` tokens.

    Prefix doubling: ranks of 1, 2, 4, ... tokens, a pair of ranks sorted each time.  Streams end with a 0, which counts as a
    mark of its page alone, so equal ranks lie whole inside of pages.
    """
    page = np.repeat(np.arange(len(streams)), [len(x) for x in streams])
    toks = np.concatenate(streams)
    rank = np.unique(toks, return_inverse=True)[1].astype(np.int64) + len(streams)
    rank[toks == 0] = page[toks == 0]
    h = 1
    while h < DEPTH:
        after = np.zeros(len(rank), dtype=np.int64)
        after[:-h] = rank[h:] + 1
        rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1].astype(np.int64)
        h *= 2
    return rank, page


def maximal_runs(streams: list[np.ndarray], need: int) -> set[bytes]:
    """Token runs, as long as they go, of which every ``DEPTH`` tokens stand on ``need`` of the pages or more."""
    if sum(len(x) for x in streams) < DEPTH:
        return set()
    rank, page = suffix_ranks(streams)
    both = np.unique(rank * len(streams) + page)  # a page counts once
    good = np.bincount(both // len(streams), minlength=int(rank.max()) + 1)[rank] >= need
    toks = np.concatenate(streams)
    ends = np.flatnonzero(toks == 0)
    for back in range(DEPTH):  # a window that would cross the end of its page
        good[np.maximum(ends - back, 0)] = False
    edge = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
    return {toks[i:j + DEPTH - 1].tobytes() for i, j in zip(edge[::2].tolist(), edge[1::2].tolist())}


def covered(toks: np.ndarray, block: np.ndarray, flags: bytes, start: np.ndarray, strict: np.ndarray) -> list[bool]:
    """Blocks of a page that boilerplate covers, given the places where it starts; article blocks need a strict one."""
    out = np.zeros(len(flags), dtype=bool)
    if not len(flags) or not len(start):
        return out.tolist()
    word = toks > 1
    total = np.bincount(block[:-1], weights=word[:-1], minlength=len(flags))
    for kind in (False, True):
        at = start[strict] if kind else start
        cover = np.zeros(len(toks) + DEPTH + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + DEPTH, -1)
        hit = np.bincount(block[:-1], weights=(word & (np.cumsum(cover)[:len(toks)] > 0))[:-1], minlength=len(flags))
        out |= (total > 0) & (hit >= 0.8 * total) & (np.frombuffer(flags, np.uint8) == kind)
    return out.tolist()


def _unpack(blob: bytes, size: int) -> list[str]:
    text = pa.Codec("zstd").decompress(blob, size, asbytes=True).decode("utf-8") if size else ""
    return text.split("\n") if text else []


def _read(pages: DataFrame) -> DataFrame:
    """The blocks of every page, read once and stored."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
        F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)).alias("host"))

    def read(cols, codec):
        out = {"page_id": cols["page_id"], "url": cols["url"], "host": cols["host"], "flags": [], "blob": [], "size": [], "c": []}
        for body in cols["html"]:
            got = blocks(body)
            raw = "\n".join(t for t, _ in got).encode("utf-8", "replace")
            out["flags"].append(bytes(a for _, a in got))
            out["blob"].append(codec.compress(raw, asbytes=True) if raw else b"")
            out["size"].append(len(raw))
            out["c"].append(hashlib.blake2b(raw, digest_size=16).digest())
        return out

    parsed = map_slices(rows, read, "page_id long, url string, host string, flags binary, blob binary, size long, c binary",
                        setup=lambda: pa.Codec("zstd"))
    path = work_dir(pages.sparkSession, "pages")
    (parsed.withColumn("hk", F.when(F.col("host") != "", F.xxhash64("host"))).drop("host").withColumn("rid", F.monotonically_increasing_id())
     .write.parquet(path))
    return pages.sparkSession.read.parquet(path)


def _candidates(once: DataFrame) -> DataFrame:
    """(hk, item): maximal runs of the chunks (hk, slot) of distinct pages."""
    ddl = "hk long, item binary"

    def run(batches):
        out, suffixes = arrow_schema(ddl), Suffixes()
        chunk, host = [], None

        def done():
            hk, _, pages, need = host
            runs = list(maximal_runs(chunk, max(1, int(np.ceil(need / pages * len(chunk) - 1e-9)))))
            return pa.RecordBatch.from_arrays([pa.array([hk] * len(runs), pa.int64()), pa.array(runs, pa.binary())], schema=out)

        for batch in batches:
            for part in slices(batch, 1 << 20, 256):
                for hk, slot, pages, need, blob, size in zip(*(part.column(c).to_pylist() for c in ("hk", "slot", "pages", "need", "blob", "size"))):
                    if chunk and host[:2] != (hk, slot):
                        yield done()
                        chunk = []
                    host = (hk, slot, pages, need)
                    chunk.append(suffixes.tokens(_unpack(blob, size))[0])
        if chunk:
            yield done()

    dealt = once.select("hk", F.pmod(F.xxhash64("c"), F.col("chunks")).alias("slot"), "pages", "need", "blob", "size")
    return dealt.repartition("hk", "slot").sortWithinPartitions("hk", "slot").mapInArrow(run, ddl).distinct()


def _beside(pages: DataFrame, sets: DataFrame, slots: DataFrame, load, row, ddl: str, max_rows: int | None) -> DataFrame:
    """``row(columns, n, host's set or None, suffixes, out)`` for every page, beside ``load(items)`` of its host.

    ``sets`` has rows (hk, item) and is sent to the tasks within the bounds of a broadcast.  Beyond, pages are dealt into slots
    of their host (``slots``: hk, slots) and the items are sorted in front of the pages of each slot.
    """
    names = [f.split()[0] for f in ddl.split(", ")]
    sets, small = fits_broadcast(sets, max_rows)
    if small:
        got: dict[int, list] = {}
        for r in sets.collect():  # within the bounds of a broadcast
            got.setdefault(r["hk"], []).append(bytes(r["item"]))
        shared = share(pages.sparkSession, {hk: load(items) for hk, items in got.items()})

        def run(cols, state):
            found, suffixes = state
            out = {k: [] for k in names}
            for n, hk in enumerate(cols["hk"]):
                row(cols, n, found.get(hk), suffixes, out)
            return out

        return map_slices(pages, run, ddl, setup=lambda: (shared(), Suffixes()))

    known = slots.join(sets.select("hk").distinct(), "hk", "left_semi")
    dealt = key_join(pages, known, ["hk"], "left", max_rows).withColumn(
        "slot", F.when(F.col("slots").isNotNull(), F.pmod(F.xxhash64("rid"), F.col("slots"))).otherwise(F.xxhash64("rid"))).drop("slots")
    ahead = sets.join(known, "hk").select("hk", "item", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"))
    mixed = (dealt.unionByName(ahead, allowMissingColumns=True).repartition("hk", "slot")
             .sortWithinPartitions("hk", "slot", F.col("item").isNull()))

    def stream(cols, state):
        out = {k: [] for k in names}
        for n, key in enumerate(zip(cols["hk"], cols["slot"])):
            if key != state["key"]:
                state.update(key=key, items=[], found=None)
            if cols["item"][n] is not None:
                state["items"].append(cols["item"][n])
                continue
            if state["items"]:
                state.update(found=load(state["items"]), items=[])
            row(cols, n, state["found"], state["suffixes"], out)
        return out

    return map_slices(mixed, stream, ddl, setup=lambda: {"key": None, "items": [], "found": None, "suffixes": Suffixes()})


def _windows(items: list[bytes]) -> np.ndarray:
    """The window hashes of token runs, sorted."""
    suffixes = Suffixes()
    return np.unique(np.concatenate([suffixes(np.frombuffer(x, np.uint64)) for x in items]))


def _decided(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(window hashes in order, strict)."""
    got = np.frombuffer(b"".join(items), np.dtype([("w", ">i8"), ("strict", "u1")]))
    got = got[np.argsort(got["w"], kind="stable")]
    return got["w"].astype(np.int64), got["strict"] > 0


def _count(cols, n, found, suffixes, out):
    if found is not None:
        hashes = np.unique(suffixes(suffixes.tokens(_unpack(cols["blob"][n], cols["size"][n]))[0]))
        hit = hashes[np.isin(hashes, found, assume_unique=True)].tolist()
        out["hk"] += [cols["hk"][n]] * len(hit)
        out["w"] += hit


def _write(cols, n, found, suffixes, out):
    texts, flags = _unpack(cols["blob"][n], cols["size"][n]), cols["flags"][n]
    drop = [False] * len(texts)
    if found is not None and texts:
        toks, block = suffixes.tokens(texts)
        hashes = suffixes(toks)
        at = np.flatnonzero(np.isin(hashes, found[0]))
        drop = covered(toks, block, flags, at, found[1][np.searchsorted(found[0], hashes[at])])
    left = [(t, a) for t, a, d in zip(texts, flags, drop) if not d]
    only = any(a for _, a in left)
    text = "\n".join(t for t, a in left if a or not only)
    for k, v in zip(out, (cols["page_id"][n], cols["url"][n], text, len(text), len(flags), sum(drop))):
        out[k].append(v)


def main_text(pages: DataFrame, chunk_pages: int = 96, chunk_chars: int = 1 << 22, least: int = 3, share_: float = 0.2, enough: int = 7,
              floor: float = 0.1, max_rows: int | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_boilerplate.

    Outside of articles a repeat must stand on ``share_`` of a host's pages, on no more than ``enough`` unless ``floor`` of the
    pages are more.  Chunks of a host with long pages hold fewer than ``chunk_pages``, about ``chunk_chars`` bytes of text but a mean
    of ``MIN_PAGES`` pages at least.  ``max_rows`` bounds the sets that are sent to the tasks whole; larger ones travel with the pages.
    """
    stored = _read(pages)
    weak = F.length(F.regexp_replace(F.hex("flags"), "01", "")) > 0
    groups = (stored.filter("hk is not null").groupBy("hk", "c")
              .agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("copies"), F.max(weak).alias("weak"), F.max("size").alias("size")))
    n = F.col("pages")
    need = F.when(F.col("weak"), F.greatest(F.lit(float(least)), F.least(share_ * n, F.lit(float(enough))), floor * n)).otherwise(F.greatest(F.lit(8.0), n / 2))
    hosts = materialized(groups.groupBy("hk").agg(F.count(F.lit(1)).alias("pages"), F.sum("copies").alias("rows"), F.max("weak").alias("weak"), F.sum("size").alias("size"))
                         .withColumn("need", need).filter("pages >= need")
                         .withColumn("chunks", F.greatest(F.lit(1), F.floor(n / chunk_pages), F.least(F.floor(F.col("size") / chunk_chars), F.floor(n / MIN_PAGES))).cast("long"))
                         .withColumn("slots", F.ceil(F.col("rows") / SLOT_PAGES).cast("long")))
    again = (stored.select("rid", "hk", "c").join(groups.filter("copies > 1").select("hk", "c", "first"), ["hk", "c"])
             .filter("rid != first").select("rid"))
    once = key_join(stored, again, ["rid"], "left_anti", max_rows)
    known = key_join(once, hosts.select("hk", "pages", "need", "chunks"), ["hk"], "inner", max_rows, materialize=False)
    runs = materialized(_candidates(known))
    slots = hosts.select("hk", "slots")
    some = key_join(once.select("rid", "hk", "blob", "size"), runs.select("hk").distinct(), ["hk"], "left_semi", max_rows)
    sums = _beside(some, runs, slots, _windows, _count, "hk long, w long", max_rows).groupBy("hk", "w").agg(F.count(F.lit(1)).alias("n"))
    strict = F.col("n") >= F.greatest(F.lit(8.0), n / 2)
    gone = sums.join(hosts.select("hk", "pages", "weak", "need"), "hk").filter(strict | (F.col("weak") & (F.col("n") >= F.col("need")))).select(
        "hk", F.concat(F.unhex(F.lpad(F.hex("w"), 16, "0")), F.when(strict, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))).alias("item"))
    return _beside(stored.select("rid", "hk", "page_id", "url", "flags", "blob", "size"), gone, slots, _decided, _write, SCHEMA, max_rows)
