"""Main text of web pages by nearest-URL page differencing.

A page is read as text lines: one per block element, with the markup that holds it. Pages are ordered by
host, URL path and id and cut into blocks; each is paired with the page of its block whose path is nearest (the
most segments, then characters, that both begin with). The lines of a pair are aligned by longest common
subsequence, and shared lines go: they belong to the site and not to the page. Three things limit that.
A neighbour that shares nearly all lines is a copy of the page, and the next nearest that is none
is taken instead; without one nothing is shared. A line inside an article or main element is likelier the
page's own, as texts quote and repeat, so it goes only if a second page, no copy of the page or its neighbour, shares
it as well and if it stands on three quarters of the block's pages.
And lines of menus, headers, footers, sidebars, cookie notices, adverts, forms and comments go by their
markup, shared or not, as a host with a single page has no neighbour to tell. Class tokens, ids and roles
tell by the whole name; inside article and main only nav, aside, form, adverts and comments go.

The order comes from a narrow table of URLs, sorted by range; its cuts fall between blocks, so that pages
move once, to the task that holds their block, and a host of any size is dealt over many tasks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, bounded_batches, partitions, read, release, written

#: About so many pages, at most, are compared by one task.
CHUNK_PAGES = 4096
#: Pages of a host, next to each other in the order, among which neighbours are sought. A chunk holds whole blocks.
BLOCK = 16
#: Pages that share this part of their lines, without what goes by markup, are copies, which tell nothing of the site.
COPY = 0.9
#: Part of a block's pages on which a line inside an article must stand to be the site's.
SPREAD = 0.75
#: Bits of the alignment's table; longer pairs are halved until their parts fit (Hirschberg).
TABLE_BITS = 1 << 28

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "option", "button", "object", "canvas"}
_DROPPED = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_BLOCK = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "blockquote", "pre", "section", "article", "main", "body", "html", "address", "figure", "figcaption", "hr", "details", "summary", "center", "hgroup"} | _DROPPED
_OWN = {"article", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Of _DROPPED, what is no part of a text inside an article or main element either.
_DROPPED_INSIDE = {"nav", "aside", "form"}
#: Whole class tokens, ids and roles of adverts and comments, which are dropped everywhere.
_SITE_INSIDE = re.compile(r"(?:ads?|adsense|adsbygoogle|advert(?:s|isement|isements|ising)?|sponsored|(?:ads?|advert)[-_](?:block|box|container|slot|unit|wrapper)|comments?|comments?[-_](?:area|form|list|section|thread)|commentlist|disqus_thread|respond)", re.IGNORECASE)
#: Whole class tokens, ids and roles of a site's parts outside article and main elements.
_SITE = re.compile(_SITE_INSIDE.pattern + r"|(?:(?:site|page|top|main|left|right|bottom|global|primary|secondary|footer|header|nav|social)[-_]?)?(?:nav|navbar|navigation|menu|sidebar|header|footer|masthead)|menubar|breadcrumbs?|contentinfo|complementary|(?:cookies?|consent)[-_](?:banner|bar|consent|notice|popup)|newsletter(?:[-_](?:form|signup))?|(?:share|sharing|social)[-_](?:bar|buttons|icons|links)|(?:related|recommended)[-_](?:articles|links|posts|stories)|(?:login|search)[-_]?(?:box|form)|skip[-_]?(?:link|links|nav)|toolbar|pagination|pager|copyright", re.IGNORECASE)

#: A line: its text, whether it stands in the page's own element, whether its markup is a site's part.
Line = tuple[str, bool, bool]


#: How an element is dropped: a form may hold the whole page, other site parts don't.
_FORM, _PART = 1, 2


def _site_part(name: str, attributes: str, own: bool) -> int:
    """_PART or _FORM for a site's part by its element or names, else 0; own: inside article or main. Headings and layout wrappers are none."""
    if name in ("form", "fieldset") and not (own and name == "fieldset"):
        return _FORM
    if name in (_DROPPED_INSIDE if own else _DROPPED):
        return _PART
    if name in _HEADINGS or name in _OWN | {"body", "html"} or name not in _BLOCK and name != "span":
        return 0
    site = _SITE_INSIDE if own else _SITE
    return _PART if any(site.fullmatch(t) for x in _NAMES.findall(attributes) for t in x.strip("\"'").split()) else 0


def page_lines(source: str | None) -> list[Line]:
    """The page's block texts in order, with character references decoded and white space made single spaces."""
    source = source or ""
    out: list[Line] = []
    parts: list[str] = []
    open_tags: list[tuple[str, bool, int]] = []  # name, own, dropped: as they hold for what is inside
    at = 0
    endless: set[str] = set()  # raw elements without an end tag in what follows

    def close_line() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            own, dropped = (open_tags[-1][1], open_tags[-1][2]) if open_tags else (False, 0)
            out.append((text, own, bool(dropped)))
        parts.clear()

    while m := _TOKEN.search(source, at):  # from where the last element ended, as the content of raw ones is no markup
        parts.append(source[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in _RAW:
            if not m[1] and not (m[3] or "").endswith("/") and name not in endless:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                if end is None and name in ("script", "style", "textarea", "title"):
                    at = len(source)  # never closed: all the rest is its content
                    break
                if end is None:
                    endless.add(name)
                else:
                    at = end.end()
            continue
        if name in _BLOCK:
            close_line()
        elif name == "br":
            parts.append(" ")
        if name in _VOID:
            continue
        if m[1]:
            found = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), None)
            if found is not None:
                del open_tags[found:]
            continue
        if name == "p" or name in ("li", "dt", "dd", "tr", "td", "th"):  # these end where the next begins
            while open_tags and open_tags[-1][0] not in _BLOCK - {"p"}:
                open_tags.pop()
            if open_tags and open_tags[-1][0] == name:
                open_tags.pop()
        own, dropped = (open_tags[-1][1], open_tags[-1][2]) if open_tags else (False, 0)
        if name == "main" or name == "article" and dropped == _FORM:
            dropped = 0  # what holds the page's own text is no site part, as where a form wraps the whole page
        part = _site_part(name, m[3] or "", own)
        if name in _BLOCK or part:
            open_tags.append((name, own or name in _OWN, max(dropped, part)))
    parts.append(source[at:] if not re.match(r"<[a-zA-Z/!][^>]*$", source[at:]) else "")
    close_line()
    return out


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """The bit-parallel rows of the alignment's table, from no line of a on: a zero bit is where the row's length steps up."""
    full = (1 << len(b)) - 1
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)

    def mask(line: str) -> int:
        bits = bytearray(len(b) // 8 + 1)
        for j in places.get(line, ()):
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    often = {line: mask(line) for line, at in places.items() if len(at) ** 2 > len(b)}  # others are made anew, as all masks would fill a table
    row = full
    yield row
    for line in a:
        met = row & (often[line] if line in often else mask(line))
        row = (row + met | row - met) & full
        yield row


def _lengths(a: list[str], b: list[str]) -> list[int]:
    """Length of a longest common subsequence of a with each beginning of b."""
    row = 0
    for row in _rows(a, b):  # only the last
        pass
    return [0, *accumulate(1 - int(bit) for bit in reversed(f"{row:0{len(b)}b}"[-len(b) :]))] if b else [0]


def _aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of one longest common subsequence of a and b, in a table of at most TABLE_BITS bits at a time."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        left, right = a[i0:i1], b[j0:j1]
        if not left or not right:
            continue
        if len(left) * len(right) > TABLE_BITS and len(left) > 1:
            half = len(left) // 2
            before, after = _lengths(left[:half], right), _lengths(left[half:][::-1], right[::-1])
            cut = max(range(len(right) + 1), key=lambda j: before[j] + after[len(right) - j])
            todo += [(i0, i0 + half, j0, j0 + cut), (i0 + half, i1, j0 + cut, j1)]
            continue
        rows = list(_rows(left, right))
        i, j = len(left), len(right)
        while i and j:
            if rows[i] >> j - 1 & 1:
                j -= 1
            elif not rows[i - 1] >> j - 1 & 1:
                i -= 1
            else:
                out.append((i0 + i - 1, j0 + j - 1))
                i, j = i - 1, j - 1
    return out


def shared_lines(a: list[str], b: list[str]) -> tuple[set[int], set[int]]:
    """Positions in a and in b of one longest common subsequence, by bit-parallel rows and a walk back; exact at any length."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    left, right = set(range(first)) | set(range(len(a) - last, len(a))), set(range(first)) | set(range(len(b) - last, len(b)))
    common = set(a[first : len(a) - last]) & set(b[first : len(b) - last])
    ia = [i for i in range(first, len(a) - last) if a[i] in common]
    ib = [i for i in range(first, len(b) - last) if b[i] in common]
    for i, j in _aligned([a[i] for i in ia], [b[j] for j in ib]):
        left.add(ia[i])
        right.add(ib[j])
    return left, right


def main_text(lines: list[Line], shared: set[int], again: set[int] = frozenset()) -> str:
    """The lines that remain, joined by an empty line. shared: positions that a neighbour shares, again: those that a second one shares."""
    return "\n\n".join(text for i, (text, own, dropped) in enumerate(lines) if not dropped and (i not in shared or own and i not in again))


def nearest(paths: list[str]) -> list[list[int]]:
    """For each path the others, nearest first: by the segments that both begin with, then the characters, then their distance in the order, those before first."""

    def likeness(a: str, b: str) -> tuple[int, int]:
        chars = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[:chars].count("/"), chars

    n = range(len(paths))
    return [sorted((y for y in n if y != x), key=lambda y: (*(-k for k in likeness(paths[x], paths[y])), abs(x - y), y > x)) for x in n]


def block_texts(pages: list[list[Line]], paths: list[str] | None = None) -> list[str]:
    """Texts of one block's pages, in order. paths: of their URLs, in that order."""
    plain = [[x[0] for x in lines] for lines in pages]
    counts = [Counter(text for text, _, dropped in lines if not dropped) for lines in pages]
    spread = Counter(text for count in counts for text in count)
    aligned: dict[tuple[int, int], tuple[set[int], set[int]]] = {}

    @cache
    def copies(x: int, y: int) -> bool:
        return sum((counts[x] & counts[y]).values()) >= COPY * max(counts[x].total(), counts[y].total())

    def shared(x: int, y: int) -> set[int]:
        pair = min(x, y), max(x, y)
        if pair not in aligned:
            aligned[pair] = shared_lines(plain[pair[0]], plain[pair[1]])
        return aligned[pair][x > y]

    def texts() -> Iterator[str]:
        for lines, x, others in zip(pages, range(len(pages)), nearest(paths or [""] * len(pages)), strict=True):
            first = next((y for y in others if not copies(min(x, y), max(x, y))), None)
            if first is None:
                yield main_text(lines, set())
                continue
            met, again = shared(x, first), set()
            if any(lines[i][1] and not lines[i][2] for i in met):
                second = next((y for y in others if y != first and not copies(min(x, y), max(x, y)) and not copies(min(first, y), max(first, y))), None)
                again = {i for i in met & shared(x, second) if spread[plain[x][i]] >= SPREAD * len(pages)} if second is not None else again
            yield main_text(lines, met, again)

    return list(texts())


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host in lower case without www., and path without scheme, query, fragment and closing slash."""
    rest = (url or "").strip().split("#")[0].split("?")[0]
    rest = rest.split("://", 1)[-1]
    host, _, path = rest.partition("/")
    host = host.lower().rsplit("@", 1)[-1]
    return host.removeprefix("www."), path.rstrip("/")


def _keys(urls: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([host_and_path(u) for u in urls], columns=["host", "path"])


def _cuts(pages: DataFrame) -> list[tuple]:
    """Ordered keys (host, path, page_id as text) at which chunks begin: each at the first page of a block."""
    spark = pages.sparkSession
    split = F.pandas_udf(_keys, "host string, path string")
    n = partitions(spark)
    keys = pages.select(split("url").alias("k"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id")).select("k.host", "k.path", "id")

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(range(at, at + batch.num_rows), pa.int64())], names=[*batch.schema.names, "part", "at"])
            at += batch.num_rows

    placed = written(arrow_map(keys.repartitionByRange(n, "host", "path", "id").sortWithinPartitions("host", "path", "id"), numbered, "host string, path string, id string, part int, at long"), "pages-order")
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per partition
    total = sum(sizes.values())
    if not total:
        return []
    starts, start = [], 0
    for part in sorted(sizes):
        starts.append((part, start))
        start += sizes[part]
    placed = placed.join(F.broadcast(spark.createDataFrame(starts, "part int, start long")), "part").withColumn("pos", F.col("start") + F.col("at"))
    hosts = written(placed.groupBy("host").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")), "pages-hosts")  # a table of its own, so that the join may split a hot host
    step = max(2, min(CHUNK_PAGES, -(-total // (16 * n))))  # many chunks a task, as they are dealt out by hash
    # Of each stretch of step positions the first that begins a block; a last page alone never begins one.
    inside = F.col("pos") - F.col("first")
    begins = placed.join(hosts, "host").where((F.pmod(inside, F.lit(BLOCK)) == 0) & ~((inside == F.col("n") - 1) & (F.col("n") > 1)))
    found = begins.groupBy(F.floor(F.col("pos") / step).alias("s")).agg(F.min(F.struct("pos", "host", "path", "id")).alias("k")).orderBy("s").collect()  # a row per chunk
    return [(r["k"]["host"], r["k"]["path"], r["k"]["id"]) for r in found]


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    A null html has no text; a null url belongs to the host without a name. Pages that repeat url and id
    are neighbours in some order, which matters only if their html differs. Pages of any length are
    read whole, and pairs of any length are aligned exactly. No rows give no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select("page_id", "url", "html")
    cuts = _cuts(rows)

    @F.pandas_udf("int")
    def chunk(urls: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, (*host_and_path(u), i)) for u, i in zip(urls, ids, strict=True)], dtype="int32")

    def differences(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [(*host_and_path(u), i) for u, i in zip(pdf["url"], pdf["id"], strict=True)]
        order = sorted(range(len(pdf)), key=keys.__getitem__)
        sources = pdf["html"].tolist()
        texts: list[str] = [""] * len(pdf)
        at = 0
        while at < len(order):
            host, end = keys[order[at]][0], at
            while end < len(order) and end - at <= BLOCK + 1 and keys[order[end]][0] == host:
                end += 1
            if end - at > BLOCK and end - at != BLOCK + 1:  # a last page alone joins the block before it
                end = at + BLOCK
            group = order[at:end]
            for i, text in zip(group, block_texts([page_lines(sources[i]) for i in group], [keys[i][1] for i in group]), strict=True):
                texts[i] = text
            at = end
        release()
        return pd.DataFrame({"own_id": pdf["own_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    own_id = F.col("page_id").cast("string")  # a nullable number would pass pandas as a float
    keyed = rows.select(own_id.alias("own_id"), F.coalesce(own_id, F.lit("")).alias("id"), "url", "html").withColumn("chunk", chunk("url", "id"))
    out = keyed.groupBy("chunk").applyInPandas(differences, "own_id string, url string, text string, n_chars long")
    return out.select(F.col("own_id").cast(pages.schema["page_id"].dataType).alias("page_id"), "url", "text", "n_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
