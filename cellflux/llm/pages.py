"""Main text of web pages by a suffix array over the pages of a host (operator 1).

A page is a list of text blocks. The words of a host's pages stand one after the other; sorting all their
suffixes brings equal runs together, and a run that stands on many pages of the host covers boilerplate. What the markup
says about a block decides how many pages it takes to remove it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.llm.common import materialise, released
from cellflux.llm.words import hashed, mixed

RUN = 8  # words in a repeated run; a shorter block is a run by itself
PAGES_PER_SHARD = 512  # of one host, or of several small ones
BROADCAST_ROWS = 200_000  # hosts, or pages of very many copies, in a table that goes to all tasks
# Pages of a host, each text once, on which a run is boilerplate: outside any article, and in one.
PLAIN_SHARE, PLAIN_LEAST = 0.05, 2
MAIN_SHARE, MAIN_LEAST = 0.5, 5
MAIN_WORDS = 4  # shorter blocks of an article, such as its headings, stay
_RUNS_AT_ONCE = 2_000_000

# HTML element names by what they mean for the text.
_SKIPPED = "script|style|noscript|template|textarea|select|iframe|object|canvas|audio|video|title|annotation"
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_NESTING = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form head header hgroup main "
    "menu nav ol search section table tbody td tfoot th thead tr ul".split()
)
_EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSE_THEMSELVES = frozenset("p li dt dd".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_CHROME_TAGS = frozenset("nav footer aside menu head button search".split())
_WRAPPER_TAGS = frozenset("form fieldset dialog".split())
_CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split()
)
_COMMENT_NAMES = frozenset("comment comments disqus replies reply respond".split())
_HOLDERS = frozenset("area author body box container content form item list section text thread wrapper".split())
_HEADER_NAMES = frozenset("banner header masthead".split())
_CHROME_NAMES = frozenset(
    "ad ads adv advert advertisement advertising breadcrumb breadcrumbs byline captcha consent "
    "cookie cookies copyright disclaimer footer gdpr login menu modal nav navbar navigation "
    "newsletter notice notification overlay pager pagination popup privacy promo promoted promotion recommended "
    "related share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
_NOT = frozenset("no not non has have with without hide hidden is in".split())

_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_SKIPPED})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<svg\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:/>|(?<!/)>.*?(?:</svg\s*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

MAIN, COMMENT, CHROME, WRAPPER, HEADER = 1, 2, 4, 8, 16


def _named(value: str) -> int:
    """What the names of a class or id say.

    A name counts by its first or last part, as in `site-footer` and `ad-slot`, unless it denies or only mentions
    it: `no-sidebar`, `has-menu`. Names of comments count by their last part (`comments-open` is none).
    """
    kind = 0
    for name in value.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        if not parts or not _NOT.isdisjoint(parts[:-1]):
            continue
        first, last = parts[0], parts[-1]
        if last in _COMMENT_NAMES or (first in _COMMENT_NAMES and last in _HOLDERS):
            kind |= COMMENT
        elif last in _HEADER_NAMES:
            kind |= HEADER
        elif first in _CHROME_NAMES or last in _CHROME_NAMES:
            kind |= WRAPPER
    return kind


def _kind(tag: str, attributes: str) -> int:
    """What an element says it is."""
    kind = MAIN if tag in ("article", "main") else 0
    kind |= CHROME if tag in _CHROME_TAGS else WRAPPER if tag in _WRAPPER_TAGS else HEADER if tag == "header" else 0
    if not attributes or attributes.isspace():
        return kind
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "role":
            role = value.strip().lower()
            kind |= MAIN if role in ("main", "article") else WRAPPER if role in _CHROME_ROLES else 0
        elif name == "class" or (name == "id" and tag != "section"):
            # The names of the whole page's elements and of headings say nothing about a part; those of sections are anchors.
            if tag not in ("body", "html") and tag not in _HEADINGS:
                kind |= _named(value)
        elif name == "aria-hidden" and value.lower() == "true":
            kind |= CHROME
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            kind |= CHROME
    return kind


class _Page:
    """The text blocks of a page, each with its element, and the elements that say what they are."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.element: list[int] = []
        self.parent, self.kind = [-1], [0]
        open_: list[tuple[str, int]] = []  # open elements: tag, number
        parts: list[str] = []
        at = here = 0

        def end_block() -> None:
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    self.texts.append(text)
                    self.element.append(here)
                parts.clear()

        for m in _MARKUP.finditer(page):
            if m.start() > at:
                parts.append(page[at : m.start()])
            at = m.end()
            if not m[3]:
                continue
            tag, attributes = m[3].lower(), m[4]
            if tag in _BLOCKS:
                end_block()
            if m[2]:
                place = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), None)
                if place is not None:
                    end_block()
                    here = self.parent[open_[place][1]]
                    del open_[place:]
                continue
            if tag in _CLOSE_THEMSELVES and open_ and open_[-1][0] == tag:
                here = self.parent[open_.pop()[1]]
            if tag in _EMPTY_TAGS or attributes.endswith("/"):
                continue
            kind = _kind(tag, attributes)
            if kind or tag in _NESTING:
                end_block()
                self.parent.append(here)
                self.kind.append(kind)
                here = len(self.kind) - 1
                open_.append((tag, here))
        if at < len(page):
            parts.append(page[at:])
        end_block()

    def judged(self) -> tuple[list[str], bool]:
        """The blocks of the article, if the page marks one, else those that are in no chrome; and whether it does.

        An article inside an element that calls itself chrome wins over it, unless there is another outside of
        any; forms and elements with chrome's names are none where they hold most of the page's words.
        Comments are left out wherever they stand, and headers only outside of articles.
        """
        count = len(self.kind)
        words, holds_main = [0] * count, [False] * count
        for text, e in zip(self.texts, self.element, strict=True):
            words[e] += text.count(" ") + 1
        for e in range(count - 1, 0, -1):
            words[self.parent[e]] += words[e]
            if holds_main[e] or (self.kind[e] & MAIN and not self.kind[e] & COMMENT):
                holds_main[self.parent[e]] = True
        marked = False
        for spare in (False, True):  # the second time, even a footer that holds the only article is none
            chrome, inside = [False] * count, [False] * count
            for e in range(1, count):
                kind, up = self.kind[e], self.parent[e]
                own = bool(kind & COMMENT)
                own |= bool(kind & CHROME) and not (spare and holds_main[e])
                own |= bool(kind & WRAPPER) and not kind & MAIN and not holds_main[e] and 2 * words[e] <= words[0]
                own |= bool(kind & HEADER) and not kind & MAIN and not inside[up] and not (spare and holds_main[e])
                chrome[e] = chrome[up] or own
                inside[e] = not chrome[e] and (inside[up] or bool(kind & MAIN))
                marked = marked or inside[e]
            if marked or not holds_main[0]:
                break
        places = inside if marked else [not c for c in chrome]
        return [t for t, e in zip(self.texts, self.element, strict=True) if places[e]], marked


def page_blocks(page: str | None) -> tuple[list[str], bool]:
    """The blocks of a page that may be its main text, without markup, scripts and styles; whether it marks an article."""
    return _Page(page or "").judged()


# ---- runs ----


def run_counts(
    tokens: np.ndarray, page: np.ndarray, left: np.ndarray, copies: np.ndarray, run: int
) -> np.ndarray:
    """Per token, on how many different pages the run that starts there stands; 0 where fewer than `run` are left.

    The suffixes are sorted by their first `run` tokens: by one token, then by two sorted halves of one, and so
    on. `copies` names the page that each page is a copy of.
    """
    if not len(tokens):
        return np.zeros(0, np.int64)
    _, rank = np.unique(tokens, return_inverse=True)
    width = 1
    while width < run:
        step = min(width, run - width)
        second = np.zeros(len(rank), np.int64)
        second[:-step] = rank[step:] + 1
        second[left <= step] = 0
        _, rank = np.unique(rank * np.int64(len(rank) + 2) + second, return_inverse=True)
        width += step
    whole = left >= run
    cells = np.unique(rank[whole] * np.int64(len(copies)) + copies[page[whole]])
    pages_of = np.bincount(cells // len(copies), minlength=int(rank.max()) + 1)
    return np.where(whole, pages_of[rank], 0)


def covered(count: np.ndarray, part: np.ndarray, run: int) -> np.ndarray:
    """Per token the largest count of a run over it; runs do not reach over the end of a part."""
    cover = count.copy()
    for k in range(1, run):
        shifted = np.zeros_like(count)
        shifted[k:] = count[:-k]
        shifted[k:][part[k:] != part[:-k]] = 0
        cover = np.maximum(cover, shifted)
    return cover


def repeated(streams: list[np.ndarray], run: int = RUN) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per page and token, on how many pages the most common run over it stands, and whether on another.

    Runs do not reach over the end of a page, and a shorter page has none. Pages of the same tokens throughout are
    copies and count as one.
    """
    lengths = np.array([len(s) for s in streams])
    tokens = np.concatenate(streams) if len(streams) else np.zeros(0, np.int64)
    page = np.repeat(np.arange(len(streams)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(tokens))
    first: dict[bytes, int] = {}
    copies = np.array([first.setdefault(s.tobytes(), i) for i, s in enumerate(streams)])
    cover = covered(run_counts(tokens, page, left, copies, run), page, run)
    cuts = np.cumsum(lengths)[:-1]
    return list(zip(np.split(cover, cuts), np.split(cover > 1, cuts), strict=True))


class _Words:
    """The words of some pages as numbers, block after block; a short block is filled up to the length of a run."""

    def __init__(self, pages: list[str], run: int = RUN):
        text = "\n".join(pages).encode() + b"\n"
        value, starts, _ = hashed(text)
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
        block = np.searchsorted(ends, starts)
        self.words = np.bincount(block, minlength=len(ends))
        full = np.where(self.words > 0, np.maximum(self.words, run), 0)
        begins = np.cumsum(full) - full
        self.tokens = np.zeros(int(full.sum()), np.int64)
        within = np.arange(len(value)) - (np.cumsum(self.words) - self.words)[block]
        self.tokens[begins[block] + within] = value.view(np.int64)
        self.block = np.repeat(np.arange(len(full)), full)
        self.left = np.repeat(begins + full, full) - np.arange(len(self.tokens))
        # A page without blocks is one empty line.
        lines = np.array([p.count("\n") + 1 for p in pages], np.int64)
        self.page_of_block = np.repeat(np.arange(len(pages)), lines)
        self.page = self.page_of_block[self.block]
        self.run = run

    def keys(self) -> np.ndarray:
        """A number for the run that starts at each token; of no meaning where fewer tokens are left."""
        key = np.zeros(len(self.tokens), np.uint64)
        for k in range(self.run):
            part = np.zeros(len(key), np.uint64)
            part[: len(key) - k] = self.tokens[k:].view(np.uint64)
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1))
        return key.view(np.int64)

    def shares(self, count: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Per block the share of its tokens that runs on at least `least` (per token) pages cover."""
        hit = covered((count >= least).astype(np.int8), self.block, self.run)
        sums = np.bincount(self.block, weights=hit, minlength=len(self.words))
        return sums / np.maximum(np.bincount(self.block, minlength=len(self.words)), 1)


def least_pages(distinct: int, marked: bool) -> int:
    """On how many of a host's pages a run is boilerplate."""
    if marked:
        return max(MAIN_LEAST, math.ceil(MAIN_SHARE * distinct))
    return max(PLAIN_LEAST, math.ceil(PLAIN_SHARE * distinct))


def without_boilerplate(words: _Words, pages: list[str], marked: list[bool], count: np.ndarray, distinct: np.ndarray) -> list[str]:
    """The pages' texts less the blocks that repeated runs cover; `count` is that of each run, `distinct` of its host."""
    least = np.array([least_pages(int(n), m) for n, m in zip(distinct, marked, strict=True)], np.int64)
    share = words.shares(count, least[words.page] if len(words.page) else least[:0])
    in_article = np.array(marked, bool)[words.page_of_block]
    template = np.where(in_article, (share >= 0.9) & (words.words >= MAIN_WORDS), share >= 0.5)
    out, at = [], 0
    for page, is_marked in zip(pages, marked, strict=True):
        blocks = page.split("\n")
        own = template[at : at + len(blocks)]
        size = words.words[at : at + len(blocks)]
        at += len(blocks)
        if own.any():
            rest = int(size[~own].sum())
            if rest and not (is_marked and 2 * rest < int(size.sum())):
                page = "\n".join(b for b, gone in zip(blocks, own.tolist(), strict=True) if not gone)
        out.append(page)
    return out


def main_texts(pages: list[str | None], run: int = RUN) -> list[str]:
    """The main text of each page of one host, its blocks joined by line ends.

    Blocks of navigation, advertising, forms, comments and the like, as their markup says, are left out. If a
    page marks its article, what stands outside it is left out too; inside, blocks are boilerplate of which runs on half of
    the host's pages (five or more) cover nine tenths, since articles share lines and passages and have copies. On a
    page without such marks, half a block and runs on a twentieth of the pages (two or more) are enough. A
    page that would lose more than half the words of its article, or all its text, keeps it. Copies of a
    page count as one.
    """
    first: dict[str | None, int] = {}
    copies = np.array([first.setdefault(p, i) for i, p in enumerate(pages)], np.int64)
    judged = [page_blocks(p) for p in pages]
    texts, marked = ["\n".join(t) for t, _ in judged], [m for _, m in judged]
    if not texts:
        return []
    words = _Words(texts, run)
    count = run_counts(words.tokens, words.page, words.left, copies, run)
    return without_boilerplate(words, texts, marked, count, np.full(len(texts), len(first)))


# ---- pages of many hosts ----


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their blocks, compressed for the way to their host."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            judged = [page_blocks(h) for h in part.column("html").to_pylist()]
            columns = [c for c, name in zip(part.columns, part.schema.names, strict=True) if name != "html"]
            names = [name for name in part.schema.names if name != "html"]
            text = [squeeze.compress("\n".join(t).encode()) for t, _ in judged]
            out = [pa.array(text, pa.binary()), pa.array([m for _, m in judged], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*columns, *out], names=[*names, "text", "marked"])


def _unpacked(texts) -> list[str]:
    return [zstandard.decompress(t, max_output_size=2**31 - 1).decode() for t in texts]


def _of_shards(rows: pa.Table) -> pa.Table:
    """The pages of one cell: final texts where the host is one shard, else pages as they are and runs to be counted.

    A run that stands on enough pages of a host does so on its share of them in one of the shards, so that
    runs which do so in none need no count. Of copies, one is counted.
    """
    rows = rows.combine_chunks()
    hosts = rows.column("host").to_pylist()
    members: dict[str, list[int]] = {}
    for i, name in enumerate(hosts):
        members.setdefault(name, []).append(i)
    squeeze = zstandard.ZstdCompressor(level=3)
    out = []
    for name, places in members.items():
        group = rows.take(pa.array(places))
        texts, marked = _unpacked(group.column("text").to_pylist()), group.column("marked").to_pylist()
        number: dict[int, int] = {}
        copies = np.array([number.setdefault(c, i) for i, c in enumerate(group.column("copy").to_pylist())], np.int64)
        # Of a page with very many copies only one shard counts one; see `extracted`.
        counted = (copies == np.arange(len(copies))) & group.column("counts").to_numpy(zero_copy_only=False)
        words = _Words(texts)
        at = counted[copies][words.page]
        count = np.zeros(len(words.tokens), np.int64)
        count[at] = run_counts(words.tokens[at], words.page[at], words.left[at], copies, RUN)
        distinct, shards = group.column("distinct")[0].as_py(), group.column("shards")[0].as_py()
        runs = np.zeros(0, np.int64)
        if shards == 1:
            texts = without_boilerplate(words, texts, marked, count, np.full(len(texts), distinct))
        else:
            share = -(-least_pages(distinct, False) // shards)
            runs = np.unique(words.keys()[count >= max(share, 1)])
        n, m = len(texts), len(runs)
        columns = {
            "page_id": pa.chunked_array([*group.column("page_id").chunks, pa.nulls(m, pa.int64())]),
            "url": pa.chunked_array([*group.column("url").cast(pa.string()).chunks, pa.nulls(m, pa.string())]),
            "host": pa.array([name] * (n + m), pa.string()),
            "distinct": pa.array([distinct] * (n + m), pa.int64()),
            "text": pa.array([squeeze.compress(t.encode()) for t in texts] + [None] * m, pa.binary()),
            "final": pa.array([shards == 1] * n + [None] * m, pa.bool_()),
            "marked": pa.array(marked + [None] * m, pa.bool_()),
            "counted": pa.array(counted.tolist() + [None] * m, pa.bool_()),
            "run": pa.array([None] * n + runs.tolist(), pa.int64()),
        }
        out.append(pa.table(columns))
    return pa.concat_tables(out)


_SHARDS = (
    "page_id bigint, url string, host string, distinct bigint, text binary, final boolean, marked boolean, "
    "counted boolean, run bigint"
)


def _found(words: _Words, hosts: list[str], known: dict[str, tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Per token the place of its run in the list of its host, from the start of all lists, or -1; and which lists."""
    keys, place = words.keys(), np.full(len(words.tokens), -1, np.int64)
    whole = words.left >= words.run
    of = np.array(hosts, object)[words.page] if len(words.page) else np.zeros(0, object)
    for host in set(hosts):
        first, own = known[host][0], known[host][1]
        at = np.flatnonzero(whole & (of == host))
        if len(own) and len(at):
            near = np.minimum(np.searchsorted(own, keys[at]), len(own) - 1)
            hit = own[near] == keys[at]
            place[at[hit]] = first + near[hit]
    return place, whole


def _counted(shared):
    """(host, run, pages): on how many of a task's counted pages each run of the lists stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hosts_of, runs_of = shared.value
        total = np.zeros(len(runs_of), np.int64)
        for batch in batches:
            hosts = batch.column("host").to_pylist()
            words = _Words(_unpacked(batch.column("text").to_pylist()))
            place, _ = _found(words, hosts, known)
            hit = place >= 0
            cells = np.unique(place[hit] * np.int64(len(hosts)) + words.page[hit])
            total += np.bincount(cells // len(hosts), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([hosts_of[i] for i in some.tolist()], pa.string()),
                pa.array(runs_of[some], pa.int64()),
                pa.array(total[some], pa.int64()),
            ],
            names=["host", "run", "pages"],
        )

    return lambda batches: released(run(batches))


def _decided(shared):
    """Final texts, by the counts of the whole host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _, _, counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                hosts, marked = part.column("host").to_pylist(), part.column("marked").to_pylist()
                texts = _unpacked(part.column("text").to_pylist())
                words = _Words(texts)
                place, _ = _found(words, hosts, known)
                count = np.where(place >= 0, counts[place] if len(counts) else 0, 0)
                distinct = part.column("distinct").to_numpy(zero_copy_only=False)
                out = without_boilerplate(words, texts, marked, count, distinct)
                columns = [part.column("page_id"), part.column("url"), pa.array(out, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    return lambda batches: released(run(batches))


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = pa.array(_unpacked(part.column("text").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], names=["page_id", "url", "text"])


def _lists(runs: DataFrame) -> Iterator[tuple]:
    """Hosts' lists of (run, pages), some hosts at a time: where each host's begins, its sorted runs; all hosts, runs, counts."""
    rows = runs.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("run", "pages"))).alias("runs"))
    known, hosts, keys, counts = {}, [], [], []
    for row in rows.toLocalIterator():
        own = np.array([r.run for r in row.runs], np.int64)
        known[row.host] = (len(hosts), own)
        hosts += [row.host] * len(own)
        keys.append(own)
        counts.append(np.array([r.pages for r in row.runs], np.int64))
        if len(hosts) >= _RUNS_AT_ONCE:
            yield known, hosts, np.concatenate(keys), np.concatenate(counts)
            known, hosts, keys, counts = {}, [], [], []
    if known:
        yield known, hosts, np.concatenate(keys), np.concatenate(counts)


def _of_hosts(pages: DataFrame, known: dict) -> DataFrame:
    hosts = pages.sparkSession.createDataFrame([(h,) for h in known], "host string")
    return pages.join(F.broadcast(hosts), "host", "left_semi")


def extracted(pages: DataFrame, pages_per_shard: int = PAGES_PER_SHARD) -> DataFrame:
    """page_id, url, `text` and `n_chars` (code points) of every page.

    `pages`: page_id, url, html; other columns are ignored. A missing or empty page has the empty text; pages
    without url are a host of their own; rows with equal page_id are extracted each, and missing page_ids are as good as others.

    The pages of a large host are dealt to shards of about `pages_per_shard`, each with a suffix array of its own;
    small hosts share a task, one after the other. What counts is on how many of the host's pages a run stands: runs that
    reach their share of that in any shard are counted on the pages of all shards, so that the size of a
    shard changes nothing. Copies of a page (equal html) go to one shard, which counts one; those of a
    page with very many copies are dealt to several, one of which does. Lists of runs go to all tasks, some hosts
    at a time where there are very many.
    """
    spark = pages.sparkSession
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    html_text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host.alias("host"),
        F.xxhash64(html_text).alias("copy"),
        html_text.alias("html"),
        F.monotonically_increasing_id().alias("row"),
    )
    per_copy = rows.groupBy("host", "copy").agg(F.count(F.lit(1)).alias("rows"))
    per_copy = materialise(per_copy, "pages-copies")
    per_host = per_copy.groupBy("host").agg(F.sum("rows").alias("pages"), F.count(F.lit(1)).alias("distinct"))
    per_host = per_host.withColumn("shards", F.ceil(F.col("pages") / pages_per_shard).cast("int"))
    per_host = materialise(per_host, "pages-hosts")
    total, hosts = per_host.agg(F.coalesce(F.sum("pages"), F.lit(0)), F.count(F.lit(1))).first()
    cells = max(1, math.ceil(total / pages_per_shard))
    often = per_copy.filter(F.col("rows") > pages_per_shard).select(
        F.col("host").alias("_host"), F.col("copy").alias("_copy"), F.ceil(F.col("rows") / pages_per_shard).alias("deals")
    )
    # A page with more copies than a shard has pages: there are at most as many as shards.
    often = F.broadcast(often) if cells <= BROADCAST_ROWS else often
    per_host = per_host.select(F.col("host").alias("_of"), "distinct", "shards")
    per_host = F.broadcast(per_host) if hosts <= BROADCAST_ROWS else per_host

    kept = "page_id bigint, url string, host string, copy bigint, row bigint, text binary, marked boolean"
    parsed = rows.mapInArrow(lambda batches: released(_parsed(batches)), kept)
    placed = parsed.join(per_host, F.col("host") == F.col("_of")).drop("_of")
    placed = placed.join(often, (F.col("host") == F.col("_host")) & (F.col("copy") == F.col("_copy")), "left")
    deal = F.coalesce(F.pmod(F.xxhash64("row"), F.col("deals")), F.lit(0))
    shard = F.when(F.col("shards") > 1, F.xxhash64("host", F.pmod("copy", F.col("shards")), deal))
    cell = F.pmod(F.coalesce(shard, F.xxhash64("host")), F.lit(cells))
    # Copies that are dealt out are no shard of their host's pages but for their first deal.
    placed = placed.withColumns({"cell": cell, "counts": deal == 0}).drop("_host", "_copy", "deals", "row")
    sharded = placed.groupBy("cell").applyInArrow(_of_shards, _SHARDS)
    sharded = materialise(sharded, "pages-shards", 1000)

    final = sharded.filter("final").select("page_id", "url", "text")
    out = final.mapInArrow(lambda batches: released(_plain(batches)), "page_id bigint, url string, text string")
    open_ = sharded.filter("NOT final")
    asked = sharded.filter("run IS NOT NULL").select("host", "run").distinct().withColumn("pages", F.lit(0).cast("long"))
    counted = None
    for known, hosts_of, runs_of, _ in _lists(asked):
        shared = spark.sparkContext.broadcast((known, hosts_of, runs_of))
        some = _of_hosts(open_.filter("counted").select("host", "text"), known)
        part = some.mapInArrow(_counted(shared), "host string, run bigint, pages bigint")
        counted = part if counted is None else counted.unionByName(part)
    lists: list[DataFrame] = []
    if counted is not None:
        totals = counted.groupBy("host", "run").agg(F.sum("pages").alias("pages"))
        totals = materialise(totals, "pages-runs")
        for known, hosts_of, runs_of, counts in _lists(totals):
            shared = spark.sparkContext.broadcast((known, hosts_of, runs_of, counts))
            some = _of_hosts(open_, known).select("page_id", "url", "host", "distinct", "text", "marked")
            lists.append(some.mapInArrow(_decided(shared), "page_id bigint, url string, text string"))
        rest = open_.join(totals.select("host").distinct(), "host", "left_anti")
    else:
        rest = open_
    lists.append(rest.select("page_id", "url", "text").mapInArrow(lambda batches: released(_plain(batches)), "page_id bigint, url string, text string"))
    for part in lists:
        out = out.unionByName(part)
    return out.withColumn("n_chars", F.length("text").cast("long"))
