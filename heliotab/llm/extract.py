"""Main text of web pages: markup, and what a host's pages repeat.

A page is read into blocks of text.  Each block knows whether it lies in page furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments, by element, role and class) and
whether it lies in an element that the page itself marks as its article.  What may be kept are the
blocks outside furniture: of those the ones in the marked article, if the page has one.

The token streams of a host's pages are concatenated and their suffixes sorted by the first
``RUN`` tokens (a suffix array by prefix doubling, up to that depth).  Runs on ``LEAST_SHARE`` of the
host's pages, three at least, are its template; a block that they cover goes.  A marked article is
never cut for being repeated, since articles do quote passages of one another.

Large hosts are dealt to parts by the hash of id and html, each with a suffix array of its own.
What is on a share of all pages is on that share of some part's pages: such runs are proposed by the
parts, counted in all of them and summed, so the answer is that of one array over the whole host,
however it is dealt.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliotab.llm.shipping import ship
from heliotab.llm.words import prefix_hash, span_hash, word_spans

RUN = 8  # tokens that a repeat has at least: a power of two
LEAST_PAGES, LEAST_SHARE = 3, 0.1  # pages of a host that a repeat is on
COVERED = 0.8  # share of a block's tokens that repeats cover
# Parts of a host: of about PART_BYTES, but of PART_PAGES pages where these have no more than MOST_BYTES.
PART_BYTES, PART_PAGES, MOST_BYTES = 1 << 20, 32, 1 << 24
_CHUNK = 500  # pages to a batch
FEW_HOSTS = 100_000

# HTML element names by their role, and words of class and id names.
RAW = ["script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "object"]
CODE = ["script", "style"]  # left open, they reach to the end; other elements of RAW then hide nothing
FURNITURE = ["nav", "footer", "aside", "form", "menu", "dialog", "button", "head"]
FURNITURE_ROLES = ["navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"]
BLOCKS = [
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
]
EMPTY = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
FURNITURE_WORDS = [
    "ad", "ads", "adbanner", "adbox", "adslot", "adunit", "advert", "adverts", "advertisement", "advertising",
    "adsense", "alert", "banner", "bottombar",
    "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr",
    "header", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "share", "sharing", "sidebar", "sidenav",
    "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "topnav", "widget", "widgets",
]
# Inside an article a name counts only if all its parts are of these two lists, one of the first at least.
ARTICLE_WORDS = [
    "ad", "ads", "adbanner", "adbox", "adslot", "adunit", "advert", "adverts", "advertisement", "advertising", "adsense",
    "comment", "comments", "cookie", "cookies", "disqus", "newsletter", "promo", "promotion", "recommended", "related",
    "replies", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
]
CONTAINER_WORDS = [
    "area", "articles", "bar", "block", "bottom", "box", "buttons", "container", "form", "icons", "inline", "items",
    "links", "list", "media", "notice", "posts", "section", "slot", "stories", "top", "unit", "widget", "wrapper",
]

_QUOTED = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\s|/){_QUOTED})?>|<[!?][^>]*>", re.DOTALL
)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_block, _empty, _furniture = frozenset(BLOCKS), frozenset(EMPTY), frozenset(FURNITURE)
_words, _roles = frozenset(FURNITURE_WORDS), frozenset(FURNITURE_ROLES)
_article_words, _container_words, _code = frozenset(ARTICLE_WORDS), frozenset(CONTAINER_WORDS), frozenset(CODE)


def _marks(attributes: str, article: bool) -> tuple[bool, bool]:
    """Whether an element's attributes say furniture, and whether they say main content.

    Inside an article a name must say nothing else: ``ad-box`` does, ``ad-hoc`` doesn't.
    """
    furniture = main = False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if name.lower() == "role":
            furniture |= value.lower() in _roles
            main |= value.lower() == "main"
            continue
        for token in value.split():
            parts = {part.lower() for part in _NAME_PART.findall(token)}
            if article:
                furniture |= bool(parts & _article_words) and parts <= _article_words | _container_words
            else:
                furniture |= bool(parts & _words)
    return furniture, main


def blocks_of(page: str) -> list[tuple[str, bool, bool]]:
    """``(text, in furniture, in the marked article)`` of each block with text, in page order.

    White space inside a block becomes one space and character references are decoded; a line
    break is white space.  Elements of ``RAW`` hide what they hold up to their end; those that close
    themselves, or have no end and are not of ``CODE``, hide nothing.
    """
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, furniture, article
    furniture = article = 0
    parts: list[str] = []
    inline: int | None = None  # where furniture begins that stands inside a block's text

    def emit(pieces: list[str], in_furniture: bool) -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append((text, in_furniture, article > 0))

    def close_block() -> None:
        nonlocal inline
        if inline is not None:
            emit(parts[:inline], False)
            del parts[:inline]
            inline = None
        emit(parts, furniture > 0)
        parts.clear()

    at, last = 0, {}  # last: where an element of RAW ends for the last time
    while match := _MARKUP.search(page, at):
        if match.start() > at:
            parts.append(page[at : match.start()])
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        name = name.lower()
        attributes = match.group(3)
        if name in _CLOSE:
            if match.group(1) or attributes and attributes.endswith("/"):
                continue
            if name not in last:
                ends = [end.start() for end in _CLOSE[name].finditer(page, at)]
                last[name] = ends[-1] if ends else -1
            if at <= last[name]:
                at = _CLOSE[name].search(page, at).end()
            elif name in _code:
                at = len(page)
            continue
        if name == "br":
            parts.append(" ")
            continue
        block = name in _block
        if block:
            close_block()
        if match.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    for _, was_furniture, was_article in stack[i:]:
                        furniture -= was_furniture
                        article -= was_article
                    del stack[i:]
                    break
            if inline is not None and not furniture:
                del parts[inline:]
                parts.append(" ")
                inline = None
            continue
        if name in _empty:
            continue
        if name == "body":  # ends a head that was left open
            stack.clear()
            furniture = article = 0
        if name in ("p", "li") and stack and stack[-1][0] == name:
            _, was_furniture, was_article = stack.pop()
            furniture -= was_furniture
            article -= was_article
        marked, main = _marks(attributes, article > 0) if attributes and "=" in attributes else (False, False)
        is_article = name in ("article", "main") or main
        is_furniture = (
            name in _furniture
            or name == "header" and not article
            or marked and name not in ("html", "body", "main") and not main
        )
        if not block and is_furniture and not furniture:
            inline = len(parts)
        if block or is_furniture:
            stack.append((name, is_furniture, is_article))
            furniture += is_furniture
            article += is_article
    parts.append(page[at:])
    close_block()
    return out


def suffix_runs(tokens: np.ndarray, pages: np.ndarray, least_pages: int) -> np.ndarray:
    """Starts of the runs of ``RUN`` tokens that are on ``least_pages`` distinct pages or more.

    ``pages`` rises; a run does not go over a page's end.
    """
    n = len(tokens)
    if n < RUN:
        return np.zeros(0, np.int64)
    end = np.searchsorted(pages, pages, side="right")
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    # Suffixes that still may be repeated, by place; sorted by their first ``depth`` tokens.
    place, depth = np.arange(n), 1
    while depth < RUN:
        # By twice as many tokens: by their own rank and that of the suffix behind.
        place = place[place + 2 * depth <= end[place]]
        place = place[(rank[place] >= 0) & (rank[place + depth] >= 0)]
        key = rank[place] * (n + 1) + rank[place + depth]
        _, own, size = np.unique(key, return_inverse=True, return_counts=True)
        often = size[own] >= least_pages
        rank[:] = -1
        place = place[often]
        rank[place] = own[often]
        depth *= 2
    order = place[np.lexsort((pages[place], rank[place]))]
    by_rank, by_page = rank[order], pages[order]
    new_rank = np.concatenate(([True], by_rank[1:] != by_rank[:-1]))[: len(order)]
    new_page = new_rank | np.concatenate(([True], by_page[1:] != by_page[:-1]))[: len(order)]
    group = np.cumsum(new_rank) - 1
    return order[np.bincount(group, new_page)[group] >= least_pages]


def _cover(starts: np.ndarray, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + RUN, -1)
    return np.cumsum(change[:-1]) > 0


def repeated(tokens: np.ndarray, pages: np.ndarray, least_pages: int) -> np.ndarray:
    """Which tokens lie in a run of ``RUN`` or more that occurs on ``least_pages`` distinct pages."""
    return _cover(suffix_runs(tokens, pages, least_pages), len(tokens))


def _run_keys(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits of each run, the same in every part; two runs agree by chance once in 2^64."""
    key = np.zeros(len(starts), np.uint64)
    for i in range(RUN):
        key = key * np.uint64(0x9E3779B97F4A7C15) + tokens[starts + i]
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


class _Part:
    """Token streams of the pages of one part, in one array; equal rows are one page."""

    def __init__(self, part: pa.Table):
        self.blocks = part.column("blocks").to_pylist()
        ids = list(zip(part.column("page_id").to_pylist(), part.column("mark").to_pylist(), strict=True))
        texts = [text for blocks in self.blocks for text in blocks]
        encoded = [text.encode() for text in texts]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in encoded]))).astype(np.int64)
        data = np.frombuffer(b"".join(encoded), np.uint8)
        starts, ends, self.at = word_spans(data, offsets)
        self.tokens = span_hash(prefix_hash(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)
        self.of_block = np.repeat(np.arange(len(texts)), np.diff(self.at))
        row_of_block = np.repeat(np.arange(len(self.blocks)), [len(blocks) for blocks in self.blocks])
        self.row = row_of_block[self.of_block] if len(texts) else np.zeros(0, np.int64)
        seen: dict[tuple, int] = {}
        first = np.array([seen.setdefault(key, i) for i, key in enumerate(ids)], np.int64)
        self.own = first[self.row] == self.row  # tokens of pages that count
        self.rows = len(self.blocks)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        return self.tokens[self.own], self.row[self.own]

    def starts(self, tokens: np.ndarray, row: np.ndarray) -> np.ndarray:
        place = np.arange(max(len(tokens) - RUN + 1, 0))
        return place[row[place] == row[place + RUN - 1]]


def _least(pages: int, at_least: int = LEAST_PAGES) -> int:
    return max(at_least, int(np.ceil(LEAST_SHARE * pages)))


def _propose(key: tuple, part: pa.Table) -> pa.Table:
    """Runs that a part proposes for its host."""
    own = _Part(part)
    tokens, row = own.counted()
    whole = part.column("parts")[0].as_py() == 1
    least = _least(own.rows, LEAST_PAGES if whole else 1)
    runs = np.unique(_run_keys(tokens, suffix_runs(tokens, row, least)))
    n = len(runs)
    return pa.table(
        {
            "host": pa.array([key[0].as_py()] * n, pa.string()),
            "parts": pa.array([part.column("parts")[0].as_py()] * n, pa.int32()),
            "run": pa.array(runs, pa.int64()),
        }
    )


def _count(key: tuple, part: pa.Table, proposed: pa.Table) -> pa.Table:
    """On how many of a part's pages each proposed run is."""
    asked = np.unique(proposed.column("run").to_numpy())
    found, on = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(asked) and part.num_rows:
        own = _Part(part)
        tokens, row = own.counted()
        starts = own.starts(tokens, row)
        runs = _run_keys(tokens, starts)
        hit = np.isin(runs, asked)
        pairs = np.unique(np.stack([runs[hit], row[starts[hit]]]), axis=1)
        found, on = np.unique(pairs[0], return_counts=True)
    return pa.table(
        {
            "host": pa.array([key[0].as_py()] * len(found), pa.string()),
            "parts": pa.array(proposed.column("parts").to_numpy()[: len(found)], pa.int32()),
            "run": pa.array(found, pa.int64()),
            "pages": pa.array(on, pa.int64()),
        }
    )


def _keep(key: tuple, part: pa.Table, repeats: pa.Table) -> pa.Table:
    """The pages of a part without the blocks that the host's repeats cover."""
    if not part.num_rows:
        return _RESULT.empty_table()
    own = _Part(part)
    least = _least(part.column("host_pages")[0].as_py() or own.rows)
    covered = np.zeros(len(own.tokens), bool)
    if repeats.num_rows:
        runs = repeats.column("run").to_numpy()[repeats.column("pages").to_numpy() >= least]
        starts = own.starts(own.tokens, own.row)
        covered = _cover(starts[np.isin(_run_keys(own.tokens, starts), runs)], len(own.tokens))
    lengths = np.diff(own.at)
    template = np.bincount(own.of_block, covered, len(lengths)) >= COVERED * np.maximum(lengths, 1)
    out, counts, begin = [], [], 0
    for blocks, marked in zip(own.blocks, part.column("marked").to_pylist(), strict=True):
        kept = [text for i, text in enumerate(blocks, begin) if marked or not template[i]]
        out.append("\n\n".join(kept))
        counts.append((int(template[begin : begin + len(blocks)].sum()), len(kept)))
        begin += len(blocks)
    found, kept = np.array(counts, np.int64).T
    return pa.table(
        {
            "page_id": part.column("page_id"),
            "url": part.column("url"),
            "text": pa.array(out, pa.string()),
            "n_chars": pa.array([len(x) for x in out], pa.int64()),
            "n_blocks": part.column("n_blocks"),
            "template_blocks": pa.array(found, pa.int64()),
            "kept_blocks": pa.array(kept, pa.int64()),
        },
        schema=_RESULT,
    )


_RESULT = pa.schema(
    [pa.field("page_id", pa.int64()), pa.field("url", pa.string()), pa.field("text", pa.string())]
    + [pa.field(n, pa.int64()) for n in ("n_chars", "n_blocks", "template_blocks", "kept_blocks")]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as blocks that may be kept: those of the marked article, else all outside furniture."""
    for whole in batches:
        for begin in range(0, whole.num_rows, _CHUNK):
            batch = whole.slice(begin, _CHUNK)
            rows = []
            for page in batch.column("html").to_pylist():
                blocks = blocks_of(page) if page else []
                marked = any(article and not furniture for _, furniture, article in blocks)
                kept = [text for text, furniture, article in blocks if not furniture and (article or not marked)]
                rows.append((kept, marked, len(blocks)))
            kept, marked, sizes = zip(*rows, strict=True)
            names = [n for n in batch.schema.names if n != "html"]
            columns = [batch.column(n) for n in names]
            columns += [pa.array(kept, pa.list_(pa.string())), pa.array(marked, pa.bool_()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "blocks", "marked", "n_blocks"])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, template_blocks, kept_blocks`` of every page.

    ``text`` joins the kept blocks by two line feeds, empty if there are none; a null html has no
    blocks.  ``template_blocks`` of those outside furniture are the host's template.  Pages whose url is null or has
    no host are taken as pages of one host.  Rows that repeat an id and its html are one page when
    repeats are counted, and each has its result.
    """
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        host.alias("host"),
    )
    size = F.sum(F.coalesce(F.octet_length("html"), F.lit(0)))
    by_size = F.least(F.ceil(size / PART_BYTES), F.ceil(F.count("*") / PART_PAGES))
    large = (
        rows.groupBy("host")
        .agg(F.greatest(F.ceil(size / MOST_BYTES), by_size).cast("int").alias("parts"), F.count("*").alias("host_pages"))
        .where("parts > 1")
    )
    if large.limit(FEW_HOSTS + 1).count() <= FEW_HOSTS:
        large = F.broadcast(large)
    dealt = rows.join(large, "host", "left").select(
        "page_id", "url", "html", "host", "host_pages",
        F.coalesce("parts", F.lit(1)).alias("parts"),
        F.xxhash64("page_id", "html").alias("mark"),
    ).withColumn("part", F.pmod("mark", "parts").cast("int"))
    read = dealt.mapInArrow(
        _read,
        "page_id long, url string, host string, host_pages long, parts int, mark long, part int,"
        " blocks array<string>, marked boolean, n_blocks long",
    )
    # One exchange, which the three passes below share.
    parts = read.repartition("host", "part").groupBy("host", "part")

    def to_parts(runs: DataFrame):
        each = runs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return each.groupBy("host", "part")

    proposed = parts.applyInArrow(_propose, "host string, parts int, run long").distinct()
    counts = parts.cogroup(to_parts(proposed)).applyInArrow(_count, "host string, parts int, run long, pages long")
    # Whether the pages are the least share of the host's is left to the parts, which know these.
    summed = counts.groupBy("host", "parts", "run").agg(F.sum("pages").alias("pages"))
    repeats = summed.where(F.col("pages") >= LEAST_PAGES)
    return parts.cogroup(to_parts(repeats)).applyInArrow(
        _keep,
        "page_id long, url string, text string, n_chars long, n_blocks long, template_blocks long, kept_blocks long",
    )
