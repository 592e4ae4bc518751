"""Main text of web pages by differencing with the page of the nearest URL.

Pages are sorted by URL path within their host and each is compared with its
neighbours: the text lines (blocks) of both are aligned by their longest common
subsequence, and lines that they share are the site's own and are deleted.
Copies of an article and quoted passages are text, so a line inside a page's article element
is deleted only if all of the four nearest pages have it and none of them is a copy that
shares most of the article. Lines in menus, adverts, forms and the like go even if no neighbour shares them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.functions.lookup import BROADCAST_BYTES, size_at_most
from clinlake.llm.common import map_rows, map_stream, saved

#: Pages of a range of the sorted pages, which one task compares, while there are fewer ranges than shuffle partitions.
GROUP_PAGES = 1000
#: Nearest pages that all have to have a line of an article before it is the site's.
NEAREST = 4
#: Cells of an alignment that is done at once; larger ones are halved first.
CELLS = 200_000_000

# Elements by their role in a page, and names that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
SKIP = frozenset(
    "head script style textarea title noscript template iframe svg math xmp nav header footer aside form button "
    "select option datalist menu dialog object audio video canvas map".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_BLOCK = frozenset("p li dt dd h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
MARKED = (
    r"ads?|adverts?|advert[a-z]*|adsense|adslot|sponsor[a-z]*|promo[a-z]*|banner|nav|navbar|navigation|menu|"
    r"breadcrumbs?|side-?bar|footer|site-?header|page-?header|masthead|comments?|reply|replies|disqus|cookies?|consent|"
    r"gdpr|notices?|alert|pop-?up|modal|overlay|share|sharing|social|related|recommend[a-z]*|newsletter|subscribe|"
    r"signup|sign-?up|login|search|widget|toolbar|pagination|pager|hidden|skip-?link|copyright|paywall"
)
LAYOUT = (
    r"left|right|top|bottom|upper|lower|main|site|page|inner|outer|list|box|container|wrapper|wrap|area|section|block|form|"
    r"bar|slot|unit|panel|links?|items?|buttons?|icons?|inline|js|\d+"
)
CONTAINERS = frozenset("center dd details dir div dl dt fieldset li ol section span table tbody td th tr ul".split())
_marked = re.compile(rf"(?:^|[\s_-])(?:{MARKED})(?:$|[\s_-]|\d)", re.I)
_named = re.compile(rf"(?:(?:{LAYOUT})[_-])*(?:{MARKED})\d*(?:[_-](?:{MARKED}|{LAYOUT})\d*)*", re.I)
# A quotation mark opens a value only right after the equals sign.
_token = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|$)", re.S
)
_attribute = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*))?")
_invisible = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_marked(element: str, attributes: str, inside: bool) -> bool:
    """Whether an element's attributes say that it is not the article's.

    Part of a class name counts on containers outside the article only (``ad-x7`` is an advert there). Elsewhere
    the whole name has to be one of those words, with nothing but words of layout around it: a
    paragraph's ``widget-description`` and a section's ``social-history`` are text. A heading's names say nothing.
    """
    if not attributes or attributes == "/":
        return False
    for name, value in _attribute.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "class" and element in CONTAINERS and not inside and _marked.search(value):
            return True
        if name in ("class", "id") and element not in HEADINGS and any(map(_named.fullmatch, value.split())):
            return True
        if name == "style" and _invisible.search(value):
            return True
    return False


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, inside the article) of every text block of a page outside what is never main text."""
    out: list[tuple[str, bool]] = []
    held: list[str] = []
    articles = 0
    skip, depth, headed = "", 0, False  # element being skipped, its nesting, a heading inside an article's header

    def flush():
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            out.append((text, articles > 0))

    at, size = 0, len(page)
    while at < size:
        m = _token.search(page, at)
        end = m.start() if m else size
        if end > at and (not skip or headed):
            held.append(page[at:end])
        if not m:
            break
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        closing = m[1] == "/"
        if not closing and name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if skip:
            inside = skip == "header" and articles > 0
            if not closing and name in ("article", "main"):
                skip, headed = "", False  # the skipped element was never closed
            elif skip in CLOSED_BY_BLOCK and name in BLOCK and not (closing and name == skip):
                skip = ""
            else:
                if name == skip:
                    depth += -1 if closing else 1
                    if depth == 0:
                        skip = ""
                        if headed:
                            flush()
                        headed = False
                elif inside and name in HEADINGS:
                    flush()
                    headed = not closing
                if skip or closing:
                    continue
        if name in BLOCK:
            flush()
        elif name == "br":
            held.append(" ")
        if closing:
            if name in ("article", "main"):
                articles = max(0, articles - 1)
            continue
        if name in VOID:
            continue
        if name in SKIP or (name not in ("html", "body", "main") and _is_marked(name, m[3], articles > 0)):
            skip, depth, headed = name, 1, False
        elif name in ("article", "main"):
            articles += 1
    flush()
    return out


def shared_lines(a: list, b: list) -> list[int]:
    """Positions in a of a longest common subsequence of a and b."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    middle = _align(a[lo : len(a) - hi], b[lo : len(b) - hi])
    return [*range(lo), *(lo + i for i in middle), *range(len(a) - hi, len(a))]


def _rows(a: list, b: list) -> Iterator[int]:
    """Bit vectors of the dynamic programme: bit j of row i is 0 where the subsequence of a[:i+1] and b[:j+1] is longer than of b[:j]."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _align(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > CELLS and len(a) > 1:
        half, m = len(a) // 2, len(b)
        *_, top = _rows(a[:half], b)
        *_, bottom = _rows(a[half:][::-1], b[::-1])
        left, right = [0], [0]
        for j in range(m):
            left.append(left[-1] + (not top >> j & 1))
            right.append(right[-1] + (not bottom >> j & 1))
        cut = max(range(m + 1), key=lambda j: left[j] + right[m - j])
        return _align(a[:half], b[:cut]) + [half + i for i in _align(a[half:], b[cut:])]
    rows, found = list(_rows(a, b)), []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            found.append(i)
            j -= 1
    return found[::-1]


def kept_text(own: list[tuple[str, bool]], gone: set[int]) -> str:
    """The text of a page with these blocks, of which the lines ``gone`` are deleted."""
    article = any(inside for _, inside in own)
    return "\n".join(text for i, (text, inside) in enumerate(own) if i not in gone and inside == article)


def neighbours(rows: DataFrame, group_pages: int) -> DataFrame:
    """The rows in ranges ``pid`` of their order, each with copies (``own`` false) of the NEAREST rows before and after it.

    So every row meets the same neighbours however many ranges there are. The order ends
    with ``nth``, which differs for every row, so equal urls and equal rows can be cut too.
    """
    spark = rows.sparkSession
    order = ["host", "path", "url", "mark", "nth"]
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(most, -(-rows.count() // group_pages)))
    dealt = saved(spark, rows.repartitionByRange(ranges, *order).withColumn("pid", F.spark_partition_id()), "ranges")
    sizes = sorted((r["pid"], r["count"]) for r in dealt.groupBy("pid").count().collect())

    def edge(way, columns):
        # From each range to those that need its rows: until the ones in between have NEAREST rows.
        links = []
        for i in range(len(sizes)):
            met, j = 0, i + way
            while met < NEAREST and 0 <= j < len(sizes):
                links.append((sizes[j][0], sizes[i][0]))
                met, j = met + sizes[j][1], j + way
        links = spark.createDataFrame(links, "pid int, goal int")
        nearest = Window.partitionBy("pid").orderBy(*columns)
        rows = dealt.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= NEAREST).drop("n")
        return rows.join(F.broadcast(links), "pid").drop("pid").withColumnRenamed("goal", "pid").withColumn("own", F.lit(False))

    before = edge(-1, [F.col(c).desc() for c in order])
    after = edge(1, [F.col(c).asc() for c in order])
    both = dealt.withColumn("own", F.lit(True)).unionByName(before).unionByName(after)
    return both.repartition(ranges, "pid").sortWithinPartitions("pid", *order)


def site_lines(run: list[dict], i: int) -> list[int]:
    """Places of the lines of page i of a run of neighbours that are the site's own."""
    lines, inside = run[i]["lines"], run[i]["inside"]
    left, right = i, len(run) - 1 - i
    lo, hi = i - min(left, max(NEAREST // 2, NEAREST - right)), i + min(right, max(NEAREST // 2, NEAREST - left))
    gone = set()
    article = {k for k, x in enumerate(inside) if x}
    common, most = set(article), len(article) / 2
    for j in sorted(range(lo, hi + 1), key=lambda j: abs(j - i))[1:]:
        if abs(j - i) > 1 and not common:
            break
        shared = set(shared_lines(lines, run[j]["lines"]))
        if abs(j - i) == 1:
            gone |= shared - article
        # One neighbour's line may be a quotation, and a copy tells nothing about an article.
        common = common & shared if len(shared & article) <= most else set()
    return sorted(gone | common if hi - lo > 1 else gone)


def deletions(rows: DataFrame, group_pages: int) -> DataFrame:
    """(mark, gone): the places of the lines that a page shares with its neighbours and that are not its article's.

    Only hashes of lines are shuffled and compared; pages that lose no line are left out.
    """

    def lines():
        def work(parts):
            found = []
            for r in parts:
                own = blocks(r["html"])
                hashes = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - 2**63 for t, _ in own]
                found.append((r["mark"], r["host"], r["path"], r["url"], hashes, [inside for _, inside in own]))
            return found

        return work

    layout = "mark long, host string, path string, url string, lines array<long>, inside array<boolean>"
    found = map_rows(rows.select("mark", "host", "path", "url", "html"), layout, lines, text="html")
    numbered = saved(rows.sparkSession, found.withColumn("nth", F.monotonically_increasing_id()), "lines")

    def stream(parts):
        run, host, at = [], None, 0  # pages of one host in a range, the first of them that is not compared yet
        for rows in parts:
            out = []
            for r in rows:
                if (r["pid"], r["host"]) != host:
                    for i in range(at, len(run)):
                        out += compared(run, i)
                    run, host, at = [], (r["pid"], r["host"]), 0
                run.append(r)
                if len(run) - at > NEAREST:
                    out += compared(run, at)
                    at += 1
                if at > NEAREST:
                    del run[0]
                    at -= 1
            yield out
        yield [row for i in range(at, len(run)) for row in compared(run, i)]

    def compared(run, i):
        gone = site_lines(run, i) if run[i]["own"] else []
        return [(run[i]["mark"], gone)] if gone else []

    return map_stream(neighbours(numbered, group_pages), "mark long, gone array<int>", stream)


def extract(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, lines_deleted) for every page.

    NULL and empty html give an empty text. NULL urls, and urls without a host,
    count as one host. A page that has no neighbour in its host is compared with
    none. ``group_pages`` changes the work of a task, not the result. Repeated rows are neighbours that share all lines, of which those inside an article
    stay; equal rows get equal texts. Other columns are ignored; an empty table gives an empty one.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"), path.alias("path")
    ).withColumn("mark", F.xxhash64("page_id", "url", "html"))
    found = saved(pages.sparkSession, deletions(rows, group_pages), "deletions")
    gone = found.distinct().groupBy("mark").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    # Few pages lose lines where sites mark their articles: then the lists go to the pages instead of both being shuffled.
    gone = F.broadcast(gone) if size_at_most(found, BROADCAST_BYTES) else gone
    joined = rows.select("page_id", "url", "html", "mark").join(gone, "mark", "left")

    def start():
        def work(parts):
            out = []
            for r in parts:
                lost = set(r["gone"] or ())
                text = kept_text(blocks(r["html"]), lost)
                out.append((r["page_id"], r["url"], text, len(text), len(lost)))
            return out

        return work

    kind = pages.schema["page_id"].dataType.simpleString()
    layout = f"page_id {kind}, url string, text string, n_chars long, lines_deleted int"
    return map_rows(joined.drop("mark"), layout, start, text="html")
