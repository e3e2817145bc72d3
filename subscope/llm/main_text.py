"""Main text of web pages by tags and a host's suffix array.

A page is cut into blocks. Menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are known by their elements, roles
and class names; an article element, if there is one, holds the main text. Inside
it only whole class names that are certain drop an element. A block of an article
that lies in a container of unknown name, or under a name that merely contains
such a word, is doubtful, unless the element holds more than half of the article's
words: then it is the body. Doubtful blocks, and all text of pages that mark no
article, are decided by the host: the token streams of all its pages are joined
to one, its suffixes are sorted, and what neighbouring suffixes of distinct pages
share for at least LEAST tokens is boilerplate. A doubtful block that is covered
whole goes, any other stays whole; where no article is marked the covered tokens
go and the unique runs stay. The whole text of a host's pages is in its array, so a
box that quotes another article's plain paragraph goes. Plain paragraphs and headings
of an article are asked about themselves by none: nothing drops them for being
repeated elsewhere.

Pages are distinct by their article's least hashed word triple, so copies and most
near copies of an article are one page; without an article, by the stream.

The suffix array is a Spark sort: suffixes are cut to REACH tokens, equal ones of
a host are counted together before the shuffle (the boilerplate of a large host
is few suffixes however many pages repeat it), and ranges of the order are tasks.
A suffix of an article is sorted only if its first LEAST tokens may begin one that
is asked about: any other is no such suffix's neighbour. A bitmap of hashed
beginnings tells; it never misses one, and what it passes in excess is only sorted.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frame, shipped, sized_join, stage

#: Tokens that distinct pages must share.
LEAST = 6
#: Tokens by which suffixes are sorted.
REACH = 12
#: At most 2 ** MOST_BITS bits tell the beginnings that are asked about (64 MB).
MOST_BITS = 29

# Elements, roles and class words.
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead title tr ul".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math canvas object audio video".split())
_DROP = frozenset("nav footer aside form header menu dialog select button search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies "
    "consent gdpr notice newsletter subscribe subscription signup popup modal overlay comment comments disqus reply "
    "replies respond share sharing social related recommended pagination pager copyright".split())
_GENERIC = frozenset(
    "area bar block box button buttons card container content form icons inline item items link links list module "
    "panel row section slot text title top unit wrap wrapper posts articles story stories".split())
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 a b i em strong span code q cite time sub sup small mark abbr u s".split())
_NEVER = frozenset("html body article main".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PART = re.compile(r"[^a-z]+")


def _named(value: str, inside: bool) -> tuple[str, bool]:
    """The unwanted word in a class or id, and whether the name says nothing else."""
    for name in value.split():
        parts = [w for w in _PART.split(name) if w]
        for word in parts:
            if word in _CLASSES and not (inside and word in ("header", "masthead")):
                return word, all(w in _CLASSES or w in _GENERIC for w in parts)
    return "", False


def _unwanted(tag: str, attrs: str, inside: bool) -> tuple[str, bool]:
    """Why an element is dropped, or the empty string; whether its name leaves doubt.

    Inside an article its own header stays, a name that only contains an unwanted
    word is doubtful, and so is a container of any other name.
    """
    if tag in _DROP and not (tag == "header" and inside):
        return tag, False
    doubt = False
    if attrs and tag not in _NEVER:
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return name, False
            if name in ("class", "id"):
                word, certain = _named(value, inside)
                if word and (certain or not inside):
                    return "comments" if word in ("comment", "comments", "disqus", "replies") else word, False
                doubt = doubt or inside and bool(word or value.strip() and tag in _BLOCK and tag not in _PLAIN)
    return "", doubt


def blocks(page: str) -> list[tuple[str, str, tuple[int, ...]]]:
    """(role, text, doubts) of the blocks in page order; role: article, main, open or dropped.

    ``doubts``: the numbers of the doubtful elements around a block.
    """
    out: list[tuple[str, str, tuple[int, ...]]] = []
    doubts: list[list] = []  # [tag, depth, number] of the doubtful elements that are open
    seen = 0
    held: list[str] = []
    at, article, main = 0, 0, 0
    why, gone, depth = "", "", 0

    def role() -> str:
        return "dropped" if why else "article" if article else "main" if main else "open"

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((role(), text, tuple(d[2] for d in doubts)))
            held.clear()

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            held.append(entities.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        close, tag, attrs = (m[1] or m[4]) == "/", name.lower(), m[3] or m[6] or ""
        empty = tag in _VOID or attrs.endswith("/") and tag not in _BLOCK
        if tag in _RAW and not close and not empty:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size if tag in ("script", "style") else at
            if tag in _BLOCK:
                flush()
            continue
        starts, doubt = ("", False) if close or empty else _unwanted(tag, attrs, bool(article or main))
        if tag in _BLOCK or starts or doubt or why and tag == gone or doubts and tag == doubts[-1][0]:
            flush()
        if tag in ("article", "main"):
            if close:
                article, main = (max(0, article - 1), main) if tag == "article" else (article, max(0, main - 1))
            elif why != "comments":
                why = ""  # an unclosed menu does not swallow the article
                article, main = (article + 1, main) if tag == "article" else (article, main + 1)
            if not article and not main:
                doubts.clear()
        if why:
            if tag == gone:
                depth += -1 if close else 0 if empty else 1
                if depth == 0:
                    why = ""
        elif starts:
            why, gone, depth = starts, tag, 1
        else:
            if doubts and tag == doubts[-1][0] and not empty:
                doubts[-1][1] += -1 if close else 1
                if doubts[-1][1] == 0:
                    doubts.pop()
            if doubt:
                if doubts and tag == doubts[-1][0]:
                    doubts[-1][1] -= 1
                seen += 1
                doubts.append([tag, 1, seen])
    flush()
    return out


def _article_key(words: list[str]) -> int:
    """The least hash of three words in a row: equal for copies, and mostly for near copies."""
    return min(xxhash.xxh64_intdigest(" ".join(words[k:k + 3])) for k in range(max(1, len(words) - 2))) >> 1


def split_page(page: str | None) -> tuple[str, list[str], list[str], list[int], int]:
    """Settled text; pieces of the article; the token stream; what of it may be main text; the page's key.

    A stream's blocks are set apart by the token "\\n". An article without
    doubtful blocks is settled text. Else its certain text lies in pieces, with a
    doubtful block after each but the last; those blocks are the ranges (first
    token, token after the last, in turn) that may be main text. Without an
    article these are the main element's blocks, or else those that nothing marks.
    """
    parts = blocks(page or "")
    article = [(len(t.split(" ")), d) for r, t, d in parts if r == "article"]
    held: dict[int, int] = {}
    for n, d in article:
        for k in d:
            held[k] = held.get(k, 0) + n
    body = {k for k, n in held.items() if 2 * n > sum(n for n, _ in article)}
    wanted = "" if article else "main" if any(r == "main" for r, _, _ in parts) else "open"
    stream: list[str] = []
    loose: list[int] = []
    pieces: list[str] = []
    sure: list[str] = []
    for r, t, d in parts:
        doubtful = r == "article" and not body.issuperset(d)
        if r == "article" and not doubtful:
            sure.append(t)
            continue
        tokens = t.split(" ")
        if doubtful or r == wanted:
            loose += [len(stream), len(stream) + len(tokens)]
        if doubtful:
            pieces.append(" ".join(sure))
            sure = []
        stream += tokens
        stream.append("\n")
    words = [w for r, t, _ in parts if r == "article" for w in t.split(" ")]
    key = _article_key(words) if words else xxhash.xxh64_intdigest("\0".join(stream).encode("utf-8", "surrogatepass")) >> 1
    if pieces:
        return "", [*pieces, " ".join(sure)], stream, loose, key
    return " ".join(sure), [], stream, loose, key


def _codes(tokens: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(t) for t in tokens], dtype=">u4")


def _suffixes(tokens: list[str], at: np.ndarray | None = None) -> list[bytes]:
    """The suffixes of LEAST tokens or more, cut to REACH: all, or those at the places given."""
    data = _codes(tokens).tobytes()
    return [data[4 * k:4 * (k + REACH)] for k in (range(len(tokens) - LEAST + 1) if at is None else at)]


def _heads(host: str, tokens: list[str], bits: int) -> np.ndarray:
    """Two hashes of ``bits`` bits of the host and each suffix's first LEAST tokens."""
    codes = _codes(tokens).astype(np.uint64)
    n = max(0, len(tokens) - LEAST + 1)
    found = np.full(n, xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass")), dtype=np.uint64)
    for k in range(LEAST):
        found = (found ^ codes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return np.stack([found >> np.uint64(64 - bits), found & np.uint64(2 ** bits - 1)]).astype(np.int64)


def _key(host: str, suffix: bytes) -> int:
    return xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass") + b"\0" + suffix) - (1 << 63)


def _stream_suffixes(streams: DataFrame, asked: tuple[int, Broadcast] | None = None) -> DataFrame:
    """host, suffix, page of every suffix. Without a column ``page``, copies of a stream are one page.

    ``asked``: of :func:`_asked`; suffixes that begin otherwise are left out. A stream may be a text.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                hosts, found, page = [], [], []
                for host, stream, key in zip(*(batch[c].iloc[low:low + 500] for c in ("host", "stream", "page"))):
                    tokens = stream.split(" ") if isinstance(stream, str) else stream
                    at = None
                    if asked:
                        heads = _heads(host, tokens, asked[0])
                        at = np.flatnonzero((asked[1].value[heads >> 3] >> (heads & 7).astype(np.uint8) & 1).all(axis=0))
                    here = _suffixes(tokens, at) if at is None or len(at) else []
                    hosts += [host] * len(here)
                    found += here
                    page += [key] * len(here)
                yield frame(list(zip(hosts, found, page)), ("host", "suffix", "page"))

    page = F.col("page") if "page" in streams.columns else F.xxhash64("stream")
    return streams.select("host", "stream", page.alias("page")).mapInPandas(cut, "host string, suffix binary, page long")


def _asked(streams: DataFrame) -> tuple[int, Broadcast]:
    """A number of bits, and the bitmap of that many-bit hashes of the streams' beginnings (:func:`_heads`).

    Tasks send the places as 16-bit numbers in parts of 65,536; parts of the bitmap come to the driver.
    """
    tokens = streams.agg(F.sum(F.size("stream"))).first()[0] or 0
    bits = min(MOST_BITS, max(18, (4 * tokens).bit_length()))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads = [_heads(host, stream, bits).ravel() for host, stream in zip(batch["host"], batch["stream"])]
            at = np.unique(np.concatenate([np.empty(0, np.int64), *heads]))
            parts, first = np.unique(at >> 16, return_index=True)
            held = np.split((at & 0xFFFF).astype("<u2"), first[1:]) if len(at) else []
            yield pd.DataFrame({"part": parts, "held": [x.tobytes() for x in held]})

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(65536, dtype=np.uint8)
        for held in rows["held"]:
            on[np.frombuffer(held, dtype="<u2")] = 1
        return pd.DataFrame({"part": [key[0]], "held": [np.packbits(on, bitorder="little").tobytes()]})

    found = np.zeros(2 ** bits // 8, dtype=np.uint8)
    schema = "part long, held binary"
    for part, held in streams.select("host", "stream").mapInPandas(cut, schema).groupBy("part").applyInPandas(
            fill, schema).toLocalIterator():
        found[8192 * part:8192 * (part + 1)] = np.frombuffer(bytes(held), dtype=np.uint8)
    return bits, streams.sparkSession.sparkContext.broadcast(found)


def _places(streams: DataFrame) -> DataFrame:
    """key, row, at of every suffix: where it stands."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                keys, rows, at = [], [], []
                for row, host, stream in zip(*(batch[c].iloc[low:low + 500] for c in ("row", "host", "stream"))):
                    here = _suffixes(stream)
                    keys += [_key(host, x) for x in here]
                    rows += [row] * len(here)
                    at += range(len(here))
                yield pd.DataFrame({"key": keys, "row": rows, "at": at})

    return streams.select("row", "host", "stream").mapInPandas(cut, "key long, row long, at int")


def _certain(rows: DataFrame) -> DataFrame:
    """host, stream (a text), page: the certain text of articles."""
    runs = F.filter(F.when(F.size("pieces") > 0, F.col("pieces")).otherwise(F.array("text")), lambda x: x != "")
    return rows.select("host", F.array_join(runs, " \n ").alias("stream"), "page").where("stream <> ''")


def repeated(streams: DataFrame, certain: DataFrame | None = None) -> DataFrame:
    """key, shared: suffixes of the streams and the tokens they share with one of another page of the host.

    ``streams``: host, stream. Sorted suffixes lie beside their nearest
    relatives; what they share is at least what is given, and LEAST or more.
    ``certain``: the same of text that is in the array but not asked about.
    """
    suffixes = _stream_suffixes(streams).withColumn("asked", F.lit(True))
    if certain is not None:
        suffixes = suffixes.union(_stream_suffixes(certain, _asked(streams)).withColumn("asked", F.lit(False)))
    found = suffixes.groupBy("host", "suffix").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.max("asked").alias("asked"))

    def shared(a: bytes, b: bytes) -> int:
        n = 0
        while 4 * n < min(len(a), len(b)) and a[4 * n:4 * n + 4] == b[4 * n:4 * n + 4]:
            n += 1
        return n

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A run: neighbours that share LEAST tokens. While one page fills it, its suffixes wait for one of another.
        last, page, waiting = None, None, []
        for batch in batches:
            rows = []
            for host, suffix, low, high, asked in zip(*(batch[c] for c in ("host", "suffix", "low", "high", "asked"))):
                if last is None or last[0] != host or shared(last[1], suffix) < LEAST:
                    page, waiting = low, []
                several = low != high or page is None or page != low
                best = len(suffix) // 4 if low != high else 0
                if several:
                    rows += [(_key(host, x), shared(x, suffix)) for x in waiting]
                    if last and last[0] == host and last[2:] != (low, low):
                        best = max(best, min(shared(last[1], suffix), len(suffix) // 4))
                    if asked:
                        rows.append((_key(host, suffix), max(best, LEAST)))
                    page, waiting = None, []
                elif asked:
                    waiting.append(suffix)
                last = host, suffix, low, high
            yield pd.DataFrame(rows, columns=["key", "shared"])

    head = F.substring("suffix", 1, 4 * LEAST)
    ordered = found.withColumn("head", head).repartitionByRange("host", "head").sortWithinPartitions("host", "suffix")
    rows = ordered.drop("head").mapInPandas(scan, "key long, shared int")
    return rows.groupBy("key").agg(F.max("shared").alias("shared"))


def unique_runs(pieces: list[str], stream: list[str], loose: list[int], covered: list[tuple[int, int]]) -> tuple[str, int]:
    """The main text of a page and the number of boilerplate tokens.

    With ``pieces``, a loose range is a doubtful block: it goes if the intervals
    cover it whole, and else stays whole in its place. Without, the tokens in the
    loose ranges that no interval covers stay, in order.
    """
    gone = np.zeros(len(stream) + 1, dtype=np.int64)
    for a, n in covered:
        gone[a] += 1
        gone[min(a + n, len(stream))] -= 1
    hidden = np.cumsum(gone) > 0
    kept: list[str] = []
    for k, (a, b) in enumerate(zip(loose[::2], loose[1::2])):
        if pieces:
            kept.append(pieces[k])
            if not hidden[a:b].all():
                kept += stream[a:b]
                hidden[a:b] = False
            continue
        edges = np.flatnonzero(np.diff(hidden[a:b])) + a + 1
        for low, high in zip([a, *edges], [*edges, b]):
            # A repeat that only overhangs into a block takes none of it.
            if not hidden[low] or high - low < min(LEAST, b - a):
                kept += stream[low:high]
    text = " ".join(x for x in [*kept, *pieces[-1:]] if x)
    return text, sum(1 for t, h in zip(stream, hidden) if h and t != "\n")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, has_article, n_boilerplate of every page.

    ``n_boilerplate``: tokens outside articles, and of doubtful blocks that go,
    that the host's other pages repeat, in their articles or not. Null and empty pages have the empty text; a null url is a host of
    its own; each row is a page, ids may repeat or be null. Nothing is dropped
    for its length. Other columns of the input are not read.
    """

    @F.pandas_udf("text string, pieces array<string>, stream array<string>, loose array<int>, page long")
    def parse(html: pd.Series) -> pd.DataFrame:
        return frame([split_page(h) for h in html], ("text", "pieces", "stream", "loose", "page"))

    @F.pandas_udf("text string, n_boilerplate long")
    def runs(pieces: pd.Series, stream: pd.Series, loose: pd.Series, covered: pd.Series) -> pd.DataFrame:
        return frame(
            [unique_runs(list(p), list(x), list(a), [] if c is None else [(d["at"], d["shared"]) for d in c])
             for p, x, a, c in zip(pieces, stream, loose, covered)], ("text", "n_boilerplate"))

    host = F.lower(F.regexp_extract(
        F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = stage(shipped(pages).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        host.alias("host"), parse(F.col(html_col)).alias("p")).select("row", "page_id", "url", "host", "p.*"),
        compression="zstd")
    covered = _places(rows).join(repeated(rows, _certain(rows)), "key").groupBy("row").agg(
        F.collect_list(F.struct("at", "shared")).alias("covered"))
    told = stage(rows.select(
        "row", "page_id", "url", (F.col("text") != "").alias("settled"), "pieces", "stream", "loose").join(
        covered, "row", "left").select(
        "row", "page_id", "url", "settled", (F.size("pieces") > 0).alias("has_article"),
        runs("pieces", "stream", "loose", "covered").alias("runs")), compression="zstd")
    # Settled texts stay where they are: what joins them is a narrow row. Texts of other pages are in no join.
    count = told.where("settled").select("row", F.col("runs.n_boilerplate").alias("n_boilerplate"))
    marked = sized_join(rows.where("text <> ''"), count, "row").select(
        "page_id", "url", "text", F.lit(True).alias("has_article"), "n_boilerplate")
    found = marked.union(told.where("NOT settled").select(
        "page_id", "url", "runs.text", "has_article", "runs.n_boilerplate"))
    return found.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "has_article", "n_boilerplate")
