"""Main text of web pages, with a suffix array per host for what its pages repeat.

Each page is cut into blocks of text. What the markup itself names a menu, header, footer, sidebar,
notice, advert, form, script, style or comment is set aside. A class, an id or a form sets nothing aside
that holds an article or main; where its name is one of comments, adverts or hints at other pages, this
is so only if the page has no article or main elsewhere. Then the pages of a host are taken together: their blocks' words become
one stream of numbers with a mark of its own after each page, a suffix array of that stream brings
equal stretches next to each other, and a stretch of several words that many distinct pages share is
boilerplate. Blocks that are mostly covered by it go, unless they stand in the page's article; unique
runs stay, inside an article and beside it.

Pages are cut into blocks once and dealt into chunks of bounded size by a hash, so that a host with a third of all
pages is many tasks. All pages take the same way, whatever their markup and however large their host: each chunk's
suffix array counts on how many pages of its own each stretch stands. A stretch that reaches the host's limit reaches
its share of it in some chunk; those that do, and may reach the limit by what the other chunks can add, are counted
in all chunks, by 64-bit digests. The limit is applied to the sums, and the stretches that pass go to each chunk.

Defined results: a null or empty page, or one without main text, gives an empty text. A null URL counts
as a host of its own. Pages are read whole; repeated rows give repeated rows, and pages that are
copies of each other keep their articles. Null and repeated ids are rows like others. Extra columns are dropped.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import BASES, slices
from corpusprep.llm.suffix import common_prefixes, suffix_array
from corpusprep.llm.url_filter import host_and_path
from corpusprep.session import materialize

#: HTML of a host's pages in one chunk.
CHUNK_BYTES = 1 << 20
RUN_WORDS = 5
LEAST_PAGES = 3
LEAST_SHARE = 0.05
COVERED = 0.5

_BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_ASIDE = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input label menu nav noembed noframes noscript object "
    "option script select style svg template textarea title video xmp".split()
)
_ASIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising advertorial alert banner breadcrumb breadcrumbs captcha comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus dropdown feedback footer gdpr hidden login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification pager pagination paywall popup promo promotion recommended related reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toc toolbar topbar tracking widget widgets".split()
)
_LAYOUT_WORDS = frozenset("has have hide no not with without".split())
#: What these name may hold articles that are not the page's.
_LIST_WORDS = frozenset("ad ads adv advert advertising comment comments commentlist promo promotion recommended related reply respond sponsored".split())
_HEADER_WORDS = frozenset(("header", "masthead", "topbar"))
_ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_TAG = re.compile(
    r"<!--(?P<note>.*?)(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^<>]*)(?:>|(?=<)|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-zA-Z]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(rest: str) -> dict[str, str]:
    return {name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(rest)}


def _names(value: str) -> set[str]:
    """Words of class and id values: cut at dashes, underscores and inner capitals.

    What a name says to have or to lack, as ``has-sidebar`` or ``noComments``, is layout and no word of it.
    """
    names = set()
    for name in value.split():
        for word in _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name)):
            if word.lower() in _LAYOUT_WORDS:
                break
            names.add(word.lower())
    return names


# Where a block stands.
ASIDE, OTHER, MAIN, ARTICLE = -1, 0, 1, 2
# How an element is set aside: for good, or until an article or main turns up in it; in a list of
# articles, only if the page has no other one.
NOT, LIST, NAMED, FOR_GOOD = 0, 1, 2, 3


class _Element:
    __slots__ = ("aside", "main", "name")

    def __init__(self, name: str, aside: int, main: int):
        self.name, self.aside, self.main = name, aside, main


class _Page:
    """The open elements of a page, and its blocks so far, each with the elements that set it aside."""

    def __init__(self):
        self.out: list[tuple[str, int, tuple[_Element, ...]]] = []
        self.asides: tuple[_Element, ...] = ()
        self.texts: dict[tuple[_Element, ...], list[str]] = {(): []}
        self.mains: list[tuple[_Element, ...]] = []
        self.stack: list[_Element] = []
        self.names: Counter = Counter()
        self.inside = Counter()

    def text(self, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        self.texts.setdefault(self.asides, []).append(text)

    def end_block(self) -> None:
        place = ARTICLE if self.inside[ARTICLE] else MAIN if self.inside[MAIN] else OTHER
        for asides, texts in self.texts.items():
            text = " ".join("".join(texts).split())
            if text:
                self.out.append((text, place, asides))
        self.texts = {(): []}

    def blocks(self) -> list[tuple[str, int]]:
        """All blocks with their places, now that it is known which elements hold an article or main."""
        for kinds in ((NOT, NAMED), (NOT, NAMED, LIST)):
            if LIST in kinds and any(not any(e.aside for e in asides) for asides in self.mains):
                break
            for asides in self.mains:
                if all(e.aside in kinds for e in asides):
                    for e in asides:
                        e.aside = NOT
        return [(text, ASIDE if any(e.aside for e in asides) else place) for text, place, asides in self.out]

    def pop(self) -> str:
        gone = self.stack.pop()
        self.names[gone.name] -= 1
        if gone.aside:
            self.asides = self.asides[:-1]
        if gone.main:
            self.inside[gone.main] -= 1
        return gone.name

    def close(self, name: str) -> None:
        if not self.names[name]:
            return
        if name not in _BREAKS:
            # The end of an inline element never closes the block around it.
            for element in reversed(self.stack):
                if element.name == name:
                    break
                if element.name in _BREAKS:
                    return
        while self.pop() != name:
            pass

    def close_implied(self, name: str) -> None:
        """Ends that HTML leaves out: of a paragraph before a block, of a list item before the next one."""
        if name in _BREAKS and self.names["p"]:
            self.close("p")
        same, bounds = _SIBLINGS.get(name, ((), ()))
        if any(self.names[s] for s in same):
            for depth in range(len(self.stack) - 1, -1, -1):
                if self.stack[depth].name in bounds:
                    break
                if self.stack[depth].name in same:
                    while len(self.stack) > depth:
                        self.pop()
                    break

    def open(self, name: str, rest: str) -> None:
        self.close_implied(name)
        own = _attributes(rest) if rest.strip() else {}
        inside = self.inside[ARTICLE] or self.inside[MAIN]
        aside = _set_aside(name, own, bool(inside))
        if aside in (NAMED, LIST) and self.inside[ARTICLE]:
            aside = FOR_GOOD  # an article within the article is a comment or a hint at another page
        main = 0
        if not aside:
            if name == "article" or own.get("role") == "article" or own.get("itemprop") == "articleBody":
                main = ARTICLE
            elif name == "main" or own.get("role") == "main":
                main = MAIN
        self.stack.append(_Element(name, aside, main))
        self.names[name] += 1
        if aside:
            self.asides += (self.stack[-1],)
        if main:
            self.inside[main] += 1
            self.mains.append(self.asides)


_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}


def _set_aside(name: str, own: dict[str, str], inside: bool) -> int:
    """How an element is none of the main text; ``inside`` an article, headers and banners are."""
    if name in _ASIDE and name != "form" or name == "header" and not inside:
        return FOR_GOOD
    form = NAMED if name == "form" else NOT
    if not own:
        return form
    words = _names(f"{own.get('class', '')} {own.get('id', '')}")
    if name == "article":
        marked = words & {"comment", "comments", "reply"}
    elif name in ("html", "body", "main"):
        marked = set()
    else:
        marked = words & (_ASIDE_WORDS if inside else _ASIDE_WORDS | _HEADER_WORDS)
    role = own.get("role", "").lower()
    if (
        role in _ASIDE_ROLES
        and role != "form"
        and not (role == "banner" and inside)
        or "hidden" in own
        or own.get("aria-hidden") == "true"
        or _INVISIBLE.search(own.get("style", ""))
    ):
        return FOR_GOOD
    if marked:
        return LIST if marked & _LIST_WORDS else NAMED
    return NAMED if role == "form" else form


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, place) of all blocks in page order; scripts, styles and titles are no blocks."""
    out = _Page()
    at = 0
    while at < len(page):
        found = _TAG.search(page, at)
        out.text(page[at : found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if name in _BREAKS:
            out.end_block()
        elif name == "br":
            out.text(" ")
        rest = found["rest"] or found["rest2"] or ""
        if found["close"] or found["close2"]:
            out.close(name)
        elif name in _RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in _VOID and not (rest.rstrip().endswith("/") and name not in _BREAKS):
            out.open(name, rest)
    out.end_block()
    return out.blocks()


def words_of(pages: list[list[tuple[str, int]]]) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int]]], np.ndarray]:
    """One stream of word numbers over all pages, the page of each place, the spans of the blocks, and the words by number.

    After each page stands a number that occurs nowhere else, so that no repeat crosses pages.
    """
    import pandas as pd

    stream: list[str | None] = []
    ends: list[int] = []
    spans: list[list[tuple[int, int]]] = []
    for page in pages:
        own = []
        for text, _ in page:
            start = len(stream)
            stream.extend(text.split())
            own.append((start, len(stream)))
        spans.append(own)
        stream.append(None)
        ends.append(len(stream))
    codes, words = pd.factorize(np.array(stream, object))
    codes = codes.astype(np.int64)
    codes[codes < 0] = -1 - np.arange(len(pages))
    owner = np.repeat(np.arange(len(pages)), np.diff([0, *ends]))
    return codes, owner, spans, words


def _pages_each(group: np.ndarray, owner: np.ndarray, groups: int) -> np.ndarray:
    """Of how many distinct pages the places of each group are."""
    pages = int(owner.max(initial=0)) + 1
    return np.bincount(np.unique(group * pages + owner) // pages, minlength=groups)


def shared_stretches(codes: np.ndarray, owner: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, pages): of every different stretch of ``run`` words, a place where it begins and on how many distinct
    pages it stands. The suffix array of the stream brings equal stretches next to each other."""
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, _ = suffix_array(codes, len(codes) + 1)
    alike = common_prefixes(codes, order, run) >= run
    group = np.cumsum(~alike) - 1
    pages = _pages_each(group, owner[order], group[-1] + 1)
    place = order[~alike]
    # A stretch has no mark of a page's end inside.
    marks = np.concatenate([[0], np.cumsum(codes < 0)])
    inside = (place + run <= len(codes)) & (marks[np.minimum(place + run, len(codes))] == marks[place])
    return place[inside], pages[inside]


def digests(codes: np.ndarray, words: np.ndarray, run: int) -> np.ndarray:
    """A digest of the ``run`` words from each place of the stream on, the same in all streams; of no meaning where
    a page ends inside."""
    from pandas.util import hash_array

    plain = np.array([w.encode("utf-8", "surrogatepass") for w in words] or [b""], object)
    own = hash_array(plain, categorize=False)
    of_word = np.where(codes < 0, np.uint64(0), own[np.maximum(codes, 0)])
    size = max(0, len(codes) - run + 1)
    out = np.zeros(size, np.uint64)
    for i in range(run):
        out = out * np.uint64(BASES[0]) + of_word[i : i + size]
    return (out ^ (out >> np.uint64(31))).view(np.int64)


def beginnings(codes: np.ndarray, words: np.ndarray, run: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, digest) of the stretches of the stream that are among these digests."""
    own = digests(codes, words, run)
    starts = np.flatnonzero(np.isin(own, known))
    marks = np.concatenate([[0], np.cumsum(codes < 0)])
    starts = starts[marks[starts + run] == marks[starts]]
    return starts, own[starts]


def covered_by(codes: np.ndarray, words: np.ndarray, run: int, boilerplate: np.ndarray) -> np.ndarray:
    """Whether each place of the stream is covered by a stretch of these digests."""
    covered = np.zeros(len(codes) + 1, np.int64)
    starts, _ = beginnings(codes, words, run, boilerplate)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + run, -1)
    return np.cumsum(covered)[:-1] > 0


def best_place(page: list[tuple[str, int]]) -> int:
    return max((place for _, place in page), default=OTHER)


def least(pages: int, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> int:
    """How many of a host's ``pages`` share a stretch that is boilerplate."""
    return max(least_pages, int(least_share * pages))


def counted(read: list[list[tuple[str, int]]], run: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(digest, pages) of every different stretch of these pages."""
    codes, owner, _, words = words_of(read)
    place, pages = shared_stretches(codes, owner, run)
    return digests(codes, words, run)[place], pages


def counted_of(read: list[list[tuple[str, int]]], known: np.ndarray, run: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(digest, pages) of those stretches of these pages that are among the digests."""
    codes, owner, _, words = words_of(read)
    starts, digest = beginnings(codes, words, run, known)
    # Digests that are equal count as one stretch, as they do in the sums.
    found, group = np.unique(digest, return_inverse=True)
    return found, _pages_each(group, owner[starts], len(found))


def decided(read: list[list[tuple[str, int]]], boilerplate: np.ndarray, run: int = RUN_WORDS, most_covered: float = COVERED) -> list[str]:
    """The main text of each page, given the digests of its host's boilerplate."""
    codes, _, spans, words = words_of(read)
    boiler = np.concatenate([[0], np.cumsum(covered_by(codes, words, run, boilerplate))])
    out = []
    for page, own in zip(read, spans):
        best = best_place(page)
        kept = []
        for (text, place), (a, b) in zip(page, own):
            if place == ASIDE:
                continue
            if place == best >= MAIN or boiler[b] - boiler[a] < most_covered * (b - a):
                kept.append(text)
        out.append("\n\n".join(kept))
    return out


def main_texts(pages: list[str], run: int = RUN_WORDS, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> list[str]:
    """The main text of each of the pages of one host."""
    read = [blocks(page or "") for page in pages]
    digest, n = counted(read, run)
    return decided(read, digest[n >= least(len(pages), least_pages, least_share)], run)


def _packed(page: list[tuple[str, int]]) -> bytes:
    return zlib.compress(json.dumps(page, ensure_ascii=False).encode("utf-8", "surrogatepass"), 1)


def _unpacked(packed: bytes) -> list[tuple[str, int]]:
    return json.loads(zlib.decompress(packed).decode("utf-8", "surrogatepass"))


_READ = "id long, url string, host string, at long, page binary"


def _read(batches):
    """Each page cut into blocks, and packed; ``at`` is its place in the task."""
    import pyarrow as pa

    at = 0
    for batch in slices(batches, "html", 256):
        page = pa.array([_packed(blocks(text)) for text in batch.column("html").to_pylist()], pa.binary())
        place = pa.array(np.arange(at, at + batch.num_rows))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "url", "host")), place, page], names=["id", "url", "host", "at", "page"])
        at += batch.num_rows


def _texts(ids, urls, texts: list[str]) -> dict:
    import pyarrow as pa

    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    return {"id": ids, "url": urls, "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}


_TEXTS = "id long, url string, text string, n_chars long"


def _of_chunk(group, digest: np.ndarray, pages: np.ndarray, **more):
    """Counts of a chunk's stretches, with its host."""
    import pyarrow as pa

    rows = np.zeros(len(digest), np.int64)
    host = group.column("host").slice(0, 1).combine_chunks().take(pa.array(rows))
    own = {name: pa.array(rows + value) for name, value in more.items()}
    return pa.table({"host": host, "stretch": pa.array(digest), "pages": pa.array(pages.astype(np.int64)), **own})


def _pages_of(group) -> list[list[tuple[str, int]]]:
    return [_unpacked(page) for page in group.column("page").to_pylist()]


def candidates(dealt: DataFrame) -> DataFrame:
    """(host, stretch, chunks, least, exact): digests of what ``least`` distinct pages of a host may share, among them all
    that do; ``exact`` marks those that are known to.

    Every chunk's suffix array counts its own stretches, and those that reach the chunk's share of the limit are
    added up over the host's chunks. A chunk that is not among them has less than that share.
    """

    def run(group):
        digest, pages = counted(_pages_of(group))
        chunks, enough = group.column("chunks")[0].as_py(), group.column("least")[0].as_py()
        # The only chunk of a host has all its pages.
        enough = least(group.num_rows) if enough is None else enough
        share = -(-enough // chunks)
        chosen = pages >= share
        return _of_chunk(group, digest[chosen], pages[chosen], chunks=chunks, least=enough, share=share)

    counts = dealt.groupBy("host", "chunk").applyInArrow(run, "host string, stretch long, pages long, chunks long, least long, share long")
    sums = counts.groupBy("host", "stretch", "chunks", "least", "share").agg(F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("found"))
    most = F.col("pages") + F.greatest(F.col("chunks") - F.col("found"), F.lit(0)) * (F.col("share") - 1)
    return sums.filter(most >= F.col("least")).select("host", "stretch", "chunks", "least", (F.col("pages") >= F.col("least")).alias("exact"))


def _to_chunks(stretches: DataFrame) -> DataFrame:
    """The stretches of each host, for each of its chunks."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    return stretches.select("host", chunk, "stretch", "chunks", "least").groupBy("host", "chunk")


def boilerplate_of(dealt: DataFrame) -> DataFrame:
    """(host, stretch, chunks, least): the digests of what so many distinct pages of a host share.

    Candidates of which that is not known yet are counted in all chunks of their host.
    """
    found = candidates(dealt)

    def run(group, sought):
        if not group.num_rows or not sought.num_rows:
            return _of_chunk(sought, np.zeros(0, np.int64), np.zeros(0, np.int64), chunks=0, least=0)
        digest, pages = counted_of(_pages_of(group), sought.column("stretch").to_numpy())
        return _of_chunk(group, digest, pages, chunks=sought.column("chunks")[0].as_py(), least=sought.column("least")[0].as_py())

    counts = dealt.groupBy("host", "chunk").cogroup(_to_chunks(found.filter(~F.col("exact")))).applyInArrow(run, "host string, stretch long, pages long, chunks long, least long")
    sums = counts.groupBy("host", "stretch", "chunks", "least").agg(F.sum("pages").alias("pages"))
    return found.filter("exact").drop("exact").union(sums.filter(F.col("pages") >= F.col("least")).drop("pages"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, url, text, n_chars) for every row."""
    host, _ = host_and_path(F.col(url_col).cast("string"))
    html_text = F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html")
    named = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), html_text, host.alias("host"))
    # Hosts of several chunks; all others are one.
    chunks = F.ceil(F.sum(F.octet_length("html")) / chunk_bytes).cast("long").alias("chunks")
    least_of = F.greatest(F.lit(LEAST_PAGES).cast("long"), F.floor(F.lit(LEAST_SHARE) * F.count(F.lit(1)))).alias("least")
    large = materialize(named.groupBy(F.col("host").alias("large_host")).agg(chunks, least_of).filter(F.col("chunks") > 1), "large-hosts")
    read = named.mapInArrow(_read, _READ).join(large, F.col("host") == F.col("large_host"), "left")
    of_host = F.coalesce("chunks", F.lit(1).cast("long"))
    chunk = F.pmod(F.xxhash64("id", "url", "at"), of_host).alias("chunk")
    dealt = read.select("host", chunk, "id", "url", "page", of_host.alias("chunks"), "least")

    def run(group, boilerplate):
        import pyarrow as pa

        return pa.table(_texts(group.column("id"), group.column("url"), decided(_pages_of(group), boilerplate.column("stretch").to_numpy())))

    # All three looks at the chunks read the same shuffle.
    return dealt.groupBy("host", "chunk").cogroup(_to_chunks(boilerplate_of(dealt))).applyInArrow(run, _TEXTS)
