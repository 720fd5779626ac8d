"""Main text of pages by differencing each page with its nearest neighbours on the host.

A page is cut into text lines at block tags. Lines inside elements that never
hold the article (menus, footers, forms, scripts, adverts and the like, told by
tag, role, class or id) are dropped. What role, class or id tell is not believed
of an element with more than half of the page's text, or with its only articles.
All other lines, those of article elements
too, are compared with the two pages before and the two after by URL path on
the same host: lines of a longest common subsequence with two of them are
template. A neighbour counts only if both pages have lines that the other one
lacks. If just one counts, it decides alone about lines outside of article
elements. A line inside an article needs proof that it is text of the site and
no passage that pages share: it stands at the head or the tail of the article
on both pages, at least half of the host's different pages, three or more,
have it, and no page of another host has. A neighbour that holds more than
half of the article, by characters, or is held by it as much, is a copy and does
not count for it. Near copies without an article element, three or more in a
row, still lose what they share.

Pages of a host with the same lines are one page to the comparison, placed at
the first of their paths. Neighbours come from a range partitioning by host,
path and page, and within each range from a window, so a host with a third of
all pages spreads over many tasks; pages at the ends of ranges meet through a
table of range borders. Hashes of 64 bits stand for the lines that travel to
neighbours; the texts travel once, to the list of lines their page loses. Lines
asked about are counted over all pages; they are broadcast only while few.

Null html is empty text. Null urls share the empty host. A page without
neighbours keeps all its lines. Every row gives one row.
"""

import hashlib
import html as entities
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from orderloom.llm.common import written
from orderloom.llm.urls import host_of, path_of
from orderloom.operators.joins import lookup_join, measured_bytes

# HTML elements by their role.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp"}
_NEVER = {"nav", "footer", "aside", "form", "menu", "button", "select", "option", "svg", "object", "canvas", "dialog", "head"} | _RAW
_NEVER_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
# Words of class names and ids of elements that are no content, and of the boxes such words are put before.
_NEVER_WORD = set("ad ads advert adverts advertisement advertisements sponsored promo promos promotion promotions banner banners cookie cookies consent notice notices alert alerts popup popups modal modals newsletter newsletters subscribe sidebar sidebars side menu menus nav navs navbar navbars navigation breadcrumb breadcrumbs footer footers comment comments reply replies disqus share sharing social related recommended widget widgets toolbar toolbars login signup".split())
_BOX_WORD = set("area bar block body bottom box buttons container count form header holder icons inner item items left link links list outer panel right row section slot space thread top unit wrap wrapper".split())
# "has-sidebar" or "no-comments" is the name of what is beside, or not there.
_BESIDE_WORD = set("has with no non not without hide hidden show under in is two three multi above below before after".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?=/?[A-Za-z!?])[^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
_END_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}

ARTICLE, OUTSIDE = 1, 0


NO, DOUBTFUL, SURE = 0, 1, 2


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-cased name, the first of each; names inside values are none."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        if name:
            found.setdefault(name.lower(), "".join(values))
    return found


def _names_chrome(names: str) -> bool:
    """Whether a class or id says that an element is no content: all its words do, its last one, or the first before a box."""
    for name in names.lower().split():
        words = [w for w in re.split("[_-]+", name) if w]
        if not words or len(words) > 1 and _BESIDE_WORD.intersection(words[:-1]):
            continue
        if words[-1] in _NEVER_WORD or words[0] in _NEVER_WORD and words[-1] in _BOX_WORD:
            return True
    return False


def _is_chrome(name: str, attributes: dict[str, str], in_article: bool) -> int:
    """Whether an element is no content; what its name or role says is doubtful, as a wrapper may have it."""
    if name in _NEVER or name == "header" and not in_article or "hidden" in attributes:
        return SURE
    if attributes.get("role", "").lower() in _NEVER_ROLE:
        return DOUBTFUL
    named = name not in ("body", "html") and any(_names_chrome(attributes.get(key, "")) for key in ("class", "id"))
    return DOUBTFUL if named else NO


def _hidden_elements(sizes: dict[int, int], blocks: Counter, total: int, articles: list[tuple[int, ...]]) -> set[int]:
    """The doubtful elements that are hidden, from their characters and lines and the doubtful elements around each article.

    Not hidden is one with more than half of the page (beside a visible article,
    if it has several lines; a single one is an advert longer than the article),
    or the largest one that holds an article as long as no article is visible.
    """
    beside = any(not around for around in articles)
    hidden = {k for k, n in sizes.items() if 2 * n <= total or beside and blocks[k] < 2}
    for k in sorted(hidden, key=lambda k: (-sizes[k], k)):
        if any(k in around for around in articles) and all(hidden.intersection(around) for around in articles):
            hidden.remove(k)
    return hidden


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(line, ARTICLE or OUTSIDE) in page order, without what is never content."""
    if not page:
        return []
    out: list[tuple[list[tuple[str, tuple[int, ...]]], int]] = []
    text: list[tuple[str, tuple[int, ...]]] = []  # pieces, and the doubtful elements around each
    open_tags: list[tuple[str, int, bool]] = []  # name, whether content, article
    around: tuple[int, ...] = ()
    articles: list[tuple[int, ...]] = []
    sizes: dict[int, int] = {}
    hidden = article = total = 0

    def end_line() -> None:
        if text:
            out.append((text.copy(), ARTICLE if article else OUTSIDE))
            text.clear()

    def add(piece: str) -> None:
        nonlocal total
        text.append((piece, around))
        n = len("".join(piece.split()))
        total += n
        for k in around:
            sizes[k] += n

    at = 0
    while found := _TAG.search(page, at):
        if not hidden and found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        closing, name, attributes = found[1], (found[2] or "").lower(), found[3] or ""
        if not name:
            continue
        if name in _BLOCK:
            if not hidden:
                end_line()
        elif name == "br" and not hidden:
            add(" ")
        if closing:
            if any(n == name for n, _, _ in open_tags):
                while open_tags:
                    n, chrome, main = open_tags.pop()
                    hidden -= chrome == SURE
                    if chrome == DOUBTFUL:
                        around = around[:-1]
                    article -= main
                    if n == name:
                        break
        elif name in _RAW:
            end = _END_RAW[name].search(page, at)
            at = end.end() if end else len(page)
        elif name not in _VOID and not attributes.rstrip().endswith("/"):
            named = _attributes(attributes)
            main = name in ("article", "main") or named.get("role", "").lower() == "main"
            chrome = _is_chrome(name, named, article > 0 or main)
            if main and not chrome and not hidden:
                articles.append(around)
            # An inline element left open must not hide or hold what follows its block.
            if name in _BLOCK or chrome:
                open_tags.append((name, chrome, main))
                hidden += chrome == SURE
                if chrome == DOUBTFUL:
                    around += (len(sizes),)
                    sizes[len(sizes)] = 0
                article += main
                if name in ("p", "li", "dt", "dd", "tr", "td", "th") and not chrome:
                    open_tags.pop()
    if not hidden and at < len(page):
        add(page[at:])
    end_line()
    blocks = Counter(k for pieces, _ in out if sizes for k in {k for t, inside in pieces if t.strip() for k in inside})
    never = _hidden_elements(sizes, blocks, total, articles)
    lines = []
    for pieces, kind in out:
        line = " ".join(entities.unescape("".join(t for t, inside in pieces if never.isdisjoint(inside))).split())
        if line:
            lines.append((line, kind))
    return lines


def common_lines(a: list, b: list) -> list[bool]:
    """For each item of `a`, whether a longest common subsequence with `b` holds it.

    Bit-parallel by rows of `b`'s positions; long inputs are halved first
    (by Hirschberg's rule), so memory stays bounded.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    middle = _lcs(a[low : len(a) - high], b[low : len(b) - high])
    return [True] * low + middle + [True] * high


def _rows(a: list, b: list) -> Iterator[int]:
    """After each item of `a`, a bit per position of `b` that is 0 where the length of the LCS grows."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lcs(a: list, b: list, limit: int = 1 << 28) -> list[bool]:
    if not a or not b:
        return [False] * len(a)
    if len(a) > 1 and len(a) * len(b) > limit:
        half = len(a) // 2
        ahead, back = _last(a[:half], b), _last(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: ahead[j] + back[len(b) - j])
        return _lcs(a[:half], b[:cut], limit) + _lcs(a[half:], b[cut:], limit)
    full = (1 << len(b)) - 1
    grown = [0, *[~r & full for r in _rows(a, b)]]
    length = lambda i, j: (grown[i] & ((1 << j) - 1)).bit_count()
    out, i, j = [False] * len(a), len(a), len(b)
    left = length(i, j)
    while left:
        while length(i - 1, j) == left:
            i -= 1
        j = _last_growth(grown[i], j)
        out[i - 1] = True
        i, j, left = i - 1, j - 1, left - 1
    return out


def _last_growth(row: int, j: int) -> int:
    return (row & ((1 << j) - 1)).bit_length()


def _last(a: list, b: list) -> list[int]:
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    out = [0]
    for j in range(len(b)):
        out.append(out[-1] + (not row >> j & 1))
    return out


_PRINT = T.StructType(
    [
        T.StructField("row", T.BinaryType()),
        T.StructField("lines", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
    ]
)
_PARSED = T.StructType([T.StructField("row", T.BinaryType()), T.StructField("lines", T.ArrayType(T.StringType()))])


def _known_by(host: str, lines: list[tuple[str, int]]) -> bytes:
    """The same for pages of a host with the same lines, and only for them."""
    return hashlib.blake2b("\n".join([host, *[f"{k}{t}" for t, k in lines]]).encode(errors="surrogatepass"), digest_size=16).digest()


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


@F.pandas_udf(_PRINT)
def _prints(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Hashes of the lines, and their lengths, negative outside of article elements."""
    for pages, hosts in batches:
        rows = []
        for page, host in zip(pages.tolist(), hosts.tolist()):
            lines = lines_of(page)
            rows.append((_known_by(host, lines), [_hash(t) for t, _ in lines], [len(t) if k == ARTICLE else -len(t) for t, k in lines]))
        yield pd.DataFrame(rows, columns=_PRINT.names)


@F.pandas_udf(_PARSED)
def _parse(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for pages, hosts in batches:
        rows = []
        for page, host in zip(pages.tolist(), hosts.tolist()):
            lines = lines_of(page)
            rows.append((_known_by(host, lines), [t for t, _ in lines]))
        yield pd.DataFrame(rows, columns=_PARSED.names)


def _copied(sizes: list[int], shared: list[bool]) -> bool:
    """Whether more than half of the article is among the shared lines."""
    return 2 * sum(n for n, x in zip(sizes, shared) if x and n > 0) > sum(n for n in sizes if n > 0)


def _article(sizes: list[int]) -> list[int]:
    return [k for k, n in enumerate(sizes) if n > 0]


def _at_ends(article: list[int], shared: list[bool]) -> set[int]:
    """The shared lines at the head and the tail of an article, up to the first that is its own."""
    ends = set(itertools.takewhile(lambda k: shared[k], article))
    return ends | set(itertools.takewhile(lambda k: shared[k], reversed(article)))


def template_lines(page: tuple[list, list[int]], others: list[tuple[list, list[int]]]) -> tuple[list[int], list[int]]:
    """Positions of the lines of `page` that its neighbours show to be template; each is (lines, sizes).

    First those outside of article elements, which go, then those of an article,
    which go only if the whole host bears it out.
    """
    lines, sizes = page
    article = _article(sizes)
    votes, different = [0] * len(lines), 0
    for other, other_sizes in others:
        shared, back = common_lines(lines, other), common_lines(other, lines)
        if all(shared) or all(back):
            # One page holds the other, so neither shows what is its own.
            continue
        different += 1
        copied = _copied(sizes, shared) or _copied(other_sizes, back)
        theirs = {other[k] for k in _at_ends(_article(other_sizes), back)}
        ends = {k for k in _at_ends(article, shared) if lines[k] in theirs}
        for k, x in enumerate(shared):
            votes[k] += x and (sizes[k] <= 0 or not copied and k in ends)
    # With a single other page there is no second one to ask.
    outside = [k for k, n in enumerate(votes) if sizes[k] <= 0 and n >= max(1, min(2, different))]
    return outside, [k for k, n in enumerate(votes) if sizes[k] > 0 and n >= 2]


_LOST = T.StructType([T.StructField("outside", T.ArrayType(T.IntegerType())), T.StructField("inside", T.ArrayType(T.IntegerType()))])


@F.pandas_udf(_LOST)
def _lost(lines: pd.Series, sizes: pd.Series, neighbours: pd.Series) -> pd.DataFrame:
    """Positions of the lines that a page loses, and of those of its article that it may lose."""
    out = []
    for own, n, others in zip(lines, sizes, neighbours):
        out.append(template_lines((own.tolist(), n.tolist()), [(o["lines"].tolist(), o["sizes"].tolist()) for o in others]))
    return pd.DataFrame(out, columns=_LOST.names)


# An article's line is site text if so many of the host's different pages have it, and no page of another host.
SITE_PAGES, SITE_SHARE = 3, 0.5


def site_lines(prints: DataFrame, asked: DataFrame) -> DataFrame:
    """Of the lines `asked` about (row, host, at, line), those that are text of the site: (row, at).

    Passages that pages share occur on other hosts too, or on few pages of one.
    """
    wanted = written(asked.groupBy("line").agg(F.lit(True).alias("asked")), "asked_lines")
    every = prints.select("row", "host", F.explode(F.array_distinct("lines")).alias("line"))
    # Broadcast as long as the lines asked about are few, else the lines of all pages shuffle.
    held = lookup_join(every, wanted, ["line"], "inner", size=measured_bytes(wanted))
    by_host = held.groupBy("line", "host").agg(F.count(F.lit(1)).alias("pages"))
    alone = by_host.groupBy("line").agg(F.count(F.lit(1)).alias("hosts"), F.max("pages").alias("pages"))
    sizes = prints.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    proven = asked.join(alone.filter((F.col("hosts") == 1) & (F.col("pages") >= SITE_PAGES)), "line").join(sizes, "host")
    return proven.filter(F.col("pages") >= SITE_SHARE * F.col("all")).select("row", "at")


NEAR = 2


def neighbours(rows: DataFrame) -> DataFrame:
    """(row, other): the NEAR pages before and after each one in order of host, path and row, on its host.

    `rows` (row, host, path) should be narrow. A range holds about as many rows
    as any other, whatever its hosts.
    """
    order = ["host", "path", "row"]
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = rows.repartitionByRange(int(parts), *order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "ranged_pages")
    near = Window.partitionBy("range").orderBy(*order)
    side = lambda f, k, over: F.struct(f("host", k).over(over).alias("host"), f("row", k).over(over).alias("row"), f("range", k).over(over).alias("range"))
    sides = lambda over: F.array(*[side(f, k, over) for f in (F.lag, F.lead) for k in range(1, NEAR + 1)])
    pairs = lambda df, fits: df.select("row", F.explode(F.filter("sides", lambda s: (s["host"] == F.col("host")) & fits(s))).alias("_s")).select("row", F.col("_s.row").alias("other"))
    placed = ranged.select(*order, "range", sides(near).alias("sides"))
    inner = pairs(placed, lambda s: F.lit(True))
    # 2 * NEAR rows per range. Ranges are numbered without gaps and met in blocks that overlap by half,
    # so rows of ranges near to each other share a block, and no task gets the ends of all.
    ends = ranged.select(*order, "range", F.lag("range", NEAR).over(near).isNull().alias("first"), F.lead("range", NEAR).over(near).isNull().alias("last"))
    ends = ends.filter("first or last").drop("first", "last")
    filled = sorted(r[0] for r in ranged.select("range").distinct().collect())  # no more than ranges
    numbers = F.broadcast(rows.sparkSession.createDataFrame(list(zip(filled, range(len(filled)))), "range int, number int"))
    half = F.expr(f"array(2 * (number div {4 * NEAR}), 2 * ((number + {2 * NEAR}) div {4 * NEAR}) + 1)")
    blocks = ends.join(numbers, "range").select(*order, "range", F.explode(half).alias("block"))
    met = blocks.select(*order, "range", sides(Window.partitionBy("block").orderBy(*order)).alias("sides"))
    return inner.unionByName(pairs(met, lambda s: s["range"] != F.col("range")).distinct())


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length for every page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    prints = pages.select(host.alias("host"), path.alias("path"), F.explode(F.array(_prints(F.col("html"), host))).alias("_p"))
    prints = prints.select("host", "path", "_p.*").filter(F.size("lines") > 0)
    # Rows known by the same bytes have the same host, lines and sizes.
    prints = prints.groupBy("row").agg(*[F.min(c).alias(c) for c in ("host", "path", "lines", "sizes")])
    prints = written(prints, "page_prints", compression="zstd")
    given = prints.select(F.col("row").alias("other"), F.struct("lines", "sizes").alias("given"))
    # At most 2 * NEAR neighbours each.
    others = neighbours(prints.select("row", "host", "path")).join(given, "other").groupBy("row").agg(F.collect_list("given").alias("others"))
    found = prints.join(others, "row").select("row", "host", "lines", F.explode(F.array(_lost("lines", "sizes", "others"))).alias("_l"))
    found = found.select("row", "host", "_l.outside", "_l.inside", F.transform("_l.inside", lambda k: F.get("lines", k)).alias("asked"))
    found = written(found.filter((F.size("outside") > 0) | (F.size("inside") > 0)), "lost_lines", compression="zstd")
    asked = found.select("row", "host", F.explode(F.arrays_zip(F.col("inside").alias("at"), F.col("asked").alias("line"))).alias("_a")).select("row", "host", "_a.at", "_a.line")
    outside = found.select("row", F.explode("outside").alias("at"))
    lost = outside.unionByName(site_lines(prints, asked)).groupBy("row").agg(F.collect_list("at").alias("lost"))
    # Parsing again is cheaper than a written copy of all texts. The join is shuffled at any size; the lists are its small side.
    parsed = pages.select("page_id", "url", F.explode(F.array(_parse(F.col("html"), host))).alias("_p")).select("page_id", "url", "_p.*")
    parsed = parsed.join(lost.hint("shuffle_hash"), "row", "left")
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line, k: ~F.array_contains("lost", k)))
    text = parsed.select("page_id", "url", F.array_join(kept, "\n\n").alias("text"))
    return text.select("*", F.char_length("text").cast("long").alias("n_chars"))
