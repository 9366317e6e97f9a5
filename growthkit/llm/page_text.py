"""Main text of web pages: page structure, and what a host repeats over its pages.

A page whose article is marked (article, main, their roles, or a container named as content) gives the text inside, whatever else repeats it:
copies of an article are still articles. Inside it, blocks named as notices, adverts and the like go. A block that
only resembles one, by a part of its name or by its links, goes if the host repeats it.

On every host the token streams of its pages (of those with a marked article, what stands outside it, and such blocks) are
concatenated, a suffix array finds long substrings on several pages, and what they cover is boilerplate: it is
counted, and the unique runs of a page without a marked article, or of such blocks, are text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.components import stored
from growthkit.llm.hashing import BASE, mix
from growthkit.llm.suffix_array import suffix_array

#: Tokens of the shortest boilerplate run, pages it stands on at least, and pages of one shard of a host.
RUN, PAGES, SHARD = 8, 3, 512

# Elements and class, id or role words of what is not article text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
DROPPED = set(
    "aside button datalist dialog footer form head iframe menu nav noscript object option script select style svg"
    " template textarea title".split()
)
CONTAINER_WORDS = set("article articlebody content entry main post story".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs complementary"
    " consent contentinfo cookie cookies footer form login menu modal nav navbar navigation newsletter notice"
    " popup promo promotion recommended related search share sidebar signup social sponsor sponsored subscribe toolbar"
    " widget".split()
)


#: Words of a class, id or role that mark reader comments, and the share of a block's characters in links from which
#: it resembles a menu.
COMMENT_WORDS = {"comment", "comments", "comment-list", "commentlist", "disqus"}
LINKS = 0.5
_NAME = re.compile(r"[^a-z0-9]+")
# a declaration that is neither a comment, a doctype nor character data ends at the next >, as browsers read it
_BOGUS = re.compile(r"<!(?!--|doctype|\[CDATA\[)[^>]*>?", re.IGNORECASE)
_TAG = re.compile(r"<[^>]*>")
#: How a piece of text stands to its page: outside the text, part of it, or in a block that may be either.
OUT, IN, PERHAPS = range(3)


class _Open:
    """An open element: what its text is, the level of its article, and the block that may go with it."""

    def __init__(self, tag: str, hard: bool, soft: bool, level: int, block: int) -> None:
        self.tag, self.hard, self.soft, self.level, self.block = tag, hard, soft, level, block


class _Reader(HTMLParser):
    """Collects (level, block, kept, text) pieces.

    Levels are 2 inside an article, 1 inside main or a container named as content, 0 elsewhere. A piece is not kept in an element
    that is never text (`hard`), or in one named as boilerplate (`soft`), unless an article or main begins inside the latter. `block`
    is the number of the innermost block, or of the outermost whose name has a word of boilerplate in it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = [_Open("", False, False, 0, 0)]
        self.pieces: list[tuple[int, int, bool, str]] = []
        self.marked, self.blocks, self.links = 0, 0, 0
        self.resembles: set[int] = set()
        self.size: dict[int, list[int]] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE:
            self._break()
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs}
        labels = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".lower()
        whole, parts = set(labels.split()), set(_NAME.split(labels))
        at = self.open[-1]
        hard, soft, level, block = at.hard, at.soft, at.level, at.block
        article = tag == "article" or given.get("itemprop") == "articleBody" or given.get("role") == "article"
        main = tag == "main" or given.get("role") == "main"
        if (article or main) and not (self.marked == 2 and (whole & COMMENT_WORDS or soft)):
            soft, block, level = False, 0, 2 if article else max(level, 1)
        elif tag not in ("html", "body"):
            if tag in ("div", "section", "td") and parts & CONTAINER_WORDS and not parts & DROPPED_WORDS:
                level = max(level, 1)
            soft = soft or bool(whole & (DROPPED_WORDS | COMMENT_WORDS))
            if tag not in INLINE and block not in self.resembles and not soft:
                self.blocks += 1
                block = self.blocks
                if parts & DROPPED_WORDS:
                    self.resembles.add(block)
        hard = hard or tag in DROPPED or (tag == "header" and not level) or "hidden" in given
        hard = hard or "display:none" in given.get("style", "").replace(" ", "").lower()
        self.links += tag == "a"
        self.open.append(_Open(tag, hard, soft, level, block))
        if not hard and not soft:
            self.marked = max(self.marked, level)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._break()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.links -= sum(x.tag == "a" for x in self.open[i:])
                del self.open[i:]
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE:
            self._break()

    def handle_data(self, data: str) -> None:
        at = self.open[-1]
        if at.tag in ("script", "style"):
            return
        self.pieces.append((at.level, at.block, not (at.hard or at.soft), data))
        if at.block and data.strip():
            size = self.size.setdefault(at.block, [0, 0])
            size[bool(self.links)] += len(data)

    def _break(self) -> None:
        at = self.open[-1]
        self.pieces.append((at.level, at.block, not (at.hard or at.soft), " "))

    def like_boilerplate(self, block: int) -> bool:
        plain, linked = self.size.get(block, (0, 0))
        return block in self.resembles or linked > LINKS * (plain + linked)


def read_page(html: str) -> tuple[bool, list[str], list[int], list[str]]:
    """(whether an article is marked, words that may be text, OUT, IN or PERHAPS of each, other words) of one page.

    White space and borders of blocks part words; other markup does not. On a page without a marked article all
    words may be text and are PERHAPS. Markup that cannot be read leaves what stands between its tags, unmarked.
    """
    reader = _Reader()
    try:
        reader.feed(_BOGUS.sub(" ", html))
        reader.close()
    except (AssertionError, ValueError, IndexError):
        words = _TAG.sub(" ", html).split()
        return False, words, [PERHAPS] * len(words), []
    marked = reader.marked > 0
    inside: list[tuple[int, list[str]]] = []
    rest: list[str] = []
    for level, block, kept, text in reader.pieces:
        if not kept or level < reader.marked:
            rest.append(text)
            continue
        rest.append(" ")
        what = PERHAPS if not marked or block and reader.like_boilerplate(block) else IN
        if inside and inside[-1][0] == what:
            inside[-1][1].append(text)
        else:
            inside.append((what, [text]))
    words, kinds = [], []
    for what, texts in inside:
        found = "".join(texts).split()
        words += found
        kinds += [what] * len(found)
    return marked, words, kinds, "".join(rest).split()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, url, host, key, alone, html) to (id, url, host, key, alone, packed, kinds, stream).

    The stream is what boilerplate is sought in: the words that may go (PERHAPS), then the rest of a marked page. `kinds` has a
    byte for each word of the text, or is null if all of them stay.
    """
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts, kinds, streams = [], [], []
        for html in batch.column(5):
            _, words, kind, rest = read_page(html.as_py() or "")
            texts.append(press.compress(" ".join(words).encode("utf-8", "replace")))
            sought = [w for w, k in zip(words, kind, strict=True) if k == PERHAPS] if PERHAPS in kind else []
            kinds.append(bytes(kind) if sought else None)
            streams.append([xxhash.xxh3_64_intdigest(w) >> 1 for w in (*sought, *rest)])
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:5],
                pa.array(texts, pa.binary()),
                pa.array(kinds, pa.binary()),
                pa.array(streams, pa.list_(pa.int64())),
            ],
            ["id", "url", "host", "key", "alone", "packed", "kinds", "stream"],
        )


def _grouped(streams: list[np.ndarray], run: int) -> tuple[np.ndarray, ...]:
    """(place, owner, group) of the suffixes in order: the place in its stream, the number of the stream and
    the number of the substring of `run` tokens that starts there. Needs `run` tokens in all."""
    # every stream ends in a symbol of its own, so that no substring crosses streams
    flat = np.concatenate([np.append(s, -1 - i) for i, s in enumerate(streams)])
    owner = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    start = np.concatenate(([0], np.cumsum([len(s) + 1 for s in streams])))[:-1]
    _, symbols = np.unique(flat, return_inverse=True)
    order, _ = suffix_array(symbols.astype(np.int64))
    common = np.zeros(len(flat), bool)  # shares `run` tokens with the suffix before it
    at, before = order[1:], order[:-1]
    live = np.flatnonzero(np.maximum(at, before) + run <= len(flat))
    for i in range(run):
        live = live[symbols[at[live] + i] == symbols[before[live] + i]]
    common[live + 1] = True
    return order - start[owner[order]], owner[order], np.cumsum(~common)


def _pages_of(streams: list[np.ndarray], run: int, host: int = 0) -> tuple[np.ndarray, ...]:
    """(place, owner, group, number of streams by group, hash by group) of the suffixes in order; the hash is of
    host and tokens, and 0 where a stream ends before `run` tokens."""
    place, owner, group = _grouped(streams, run)
    seen = np.unique(np.stack((group, owner)), axis=1)[0]
    pages = np.bincount(seen, minlength=group[-1] + 1)
    first = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1))
    size = np.fromiter(map(len, streams), np.int64, len(streams))
    first = first[place[first] + run <= size[owner[first]]]
    flat = np.concatenate(streams).astype(np.uint64)
    at = (np.cumsum(size) - size)[owner[first]] + place[first]
    hashes = np.full(len(first), host, np.int64).astype(np.uint64)
    for i in range(run):
        hashes = mix(hashes * BASE + flat[at + i])
    of = np.zeros(group[-1] + 1, np.int64)
    of[group[first]] = hashes.astype(np.int64) | 1
    return place, owner, group, pages, of


def boilerplate(
    streams: list[np.ndarray], run: int = RUN, pages: int = PAGES, known: np.ndarray | None = None, host: int = 0
) -> list[np.ndarray]:
    """Per stream the tokens covered by a substring of `run` tokens that stands in `pages` or more streams, or
    whose hash is `known` to stand on as many with the pages of other shards."""
    covered = [np.zeros(len(s), bool) for s in streams]
    if sum(map(len, streams)) < run:
        return covered
    place, owner, group, seen, hashes = _pages_of(streams, run, host)
    often = seen >= pages
    if known is not None:
        often |= np.isin(hashes, known)
    hits = often[group]
    for p, own in zip(place[hits].tolist(), owner[hits].tolist(), strict=True):
        covered[own][p : p + run] = True
    return covered


def _streams(table: pa.Table) -> list[np.ndarray]:
    return [np.array(s, np.int64) for s in table.column("stream").to_pylist()]


def _shard_runs(run: int):
    """Pages of a shard in; (key, run, pages) of each of its distinct runs out, the run by its hash. Nothing for the only shard
    of a host."""

    def of_shard(table: pa.Table) -> pa.Table:
        pages = hashes = np.zeros(0, np.int64)
        key, host, alone = (table.column(c)[0].as_py() for c in ("key", "host", "alone"))
        streams = [] if alone else _streams(table)
        if sum(map(len, streams)) >= run:
            *_, pages, hashes = _pages_of(streams, run, host)
            pages, hashes = pages[hashes != 0], hashes[hashes != 0]
        columns = [np.full(len(pages), key, np.int64), hashes, pages.astype(np.int32)]
        return pa.table([pa.array(c) for c in columns], ["key", "run", "pages"])

    return of_shard


def _unique_runs(run: int, pages: int):
    """Pages of a shard, and the row of runs known on other shards; (id, url, text, n_boilerplate) of the pages out."""

    def of_shard(table: pa.Table, known: pa.Table) -> pa.Table:
        press = zstandard.ZstdDecompressor()
        host = table.column("host")[0].as_py() if table.num_rows else 0
        runs = _streams(known)[0] if known.num_rows else None
        covered = boilerplate(_streams(table), run, pages, runs, host)
        texts = []
        for packed, kinds, gone in zip(*(table.column(c).to_pylist() for c in ("packed", "kinds")), covered, strict=True):
            text = press.decompress(packed).decode()
            if kinds is not None:
                # the stream begins with the words that may go
                goes = np.frombuffer(kinds, np.uint8) == PERHAPS
                goes[goes] = gone[: int(goes.sum())]
                text = " ".join(w for w, g in zip(text.split(), goes.tolist(), strict=True) if not g)
            texts.append(text)
        return pa.table(
            [
                *(table.column(c) for c in ("id", "url")),
                pa.array(texts, pa.string()),
                pa.array([int(c.sum()) for c in covered], pa.int64()),
            ],
            ["id", "url", "text", "n_boilerplate"],
        )

    return of_shard


def main_text(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    run: int = RUN,
    least_pages: int = PAGES,
    shard: int = SHARD,
) -> DataFrame:
    """Per row of `pages`: id, url, text, n_chars, n_boilerplate.

    The text is the article without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and reader comments; references are decoded, white space is one space. n_chars counts its code points. On a
    page without a marked article, and in blocks of an article that resemble boilerplate, runs of `run` tokens that
    stand on `least_pages` pages of its host are left out. No class or id drops an article, main, or what they stand in.
    n_boilerplate counts the tokens in such runs, on a page with a marked article those outside it and in such blocks. A page
    whose markup cannot be read counts as one without a marked article, its tags taken out. A host
    with more than `shard` pages is dealt to several shards by a hash of page and address; their runs are added up
    by 64-bit hashes, so that the result does not depend on the shards. Null and empty pages have an empty text;
    all null addresses are one host. Repeated rows are pages like others; other columns are not read. A Spark job
    runs when this is called.

    Every page is read once; its text crosses one shuffle, compressed, and its stream with it, as hashes.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    kind, of_url = (rows.schema[c].dataType.simpleString() for c in ("id", "url"))
    rows = rows.select("id", "url", F.xxhash64(host).alias("host"), "html")
    # few hosts are large; their stored table tells its size, so that Spark need not shuffle pages to join it
    hosts = rows.groupBy("host").agg(F.ceil(F.count("*") / shard).alias("shards")).where("shards > 1")
    hosts = stored(hosts, "hosts")
    part = F.pmod(F.xxhash64("id", "url"), F.coalesce("shards", F.lit(1)))
    rows = rows.join(hosts, "host", "left").select(
        "id", "url", "host", F.xxhash64("host", part).alias("key"), F.col("shards").isNull().alias("alone"), "html"
    )
    # pages are read once: both uses group the same rows by the same key, and Spark shares that exchange
    read = rows.mapInArrow(
        _read,
        f"id {kind}, url {of_url}, host long, key long, alone boolean, packed binary, kinds binary, stream array<long>",
    )
    runs = read.groupBy("key").applyInArrow(_shard_runs(run), "key long, run long, pages int")
    # a run on enough pages of one shard is known there without the others
    wanting = F.when(F.col("pages") < least_pages, F.col("key"))
    often = runs.groupBy("run").agg(F.sum("pages").alias("pages"), F.collect_list(wanting).alias("keys"))
    known = often.where(F.col("pages") >= least_pages).select(F.explode("keys").alias("key"), "run")
    known = known.groupBy("key").agg(F.collect_list("run").alias("stream"))

    out = read.groupBy("key").cogroup(known.groupBy("key")).applyInArrow(
        _unique_runs(run, least_pages), f"id {kind}, url {of_url}, text string, n_boilerplate long"
    )
    out = out.select("id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_boilerplate")
    return out.withColumnRenamed("id", id).withColumnRenamed("url", url)
