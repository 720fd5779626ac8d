"""URL verdicts: longest rule first, else trust and distrust spread over the host graph.

Links between pages of different hosts are counted by host pair. Two
personalised PageRanks run over these edges: trust flows along links from hosts
with pages that a rule allows, distrust against them from hosts with pages that
a rule blocks, so it reaches those who link to bad hosts. Seeds are the shares
of a host's pages that rules allow or block, and restart with probability
1 - damping. A host is blocked if its distrust exceeds its trust and is at least
what a host gets whose pages are half blocked.

Hosts without links to others pass nothing on: their rank leaves the walk, which
lowers all ranks alike and so no comparison between trust and distrust of a host
that both reach.

Null urls and urls without `://` have an empty host and path; the empty host has
no edges and no seeds. Pages without html have no links. Every row is judged,
repeated ones alike. DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import ascii_lower, unwrapped, written

# (verdict, host, path); the longest that fits wins, and at equal length the first.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
DAMPING = 0.85
TOLERANCE = 1e-6
BLOCKED_SHARE = 0.5

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)<a\s[^<>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (verdict, name) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<verdict:string,name:string>")
    # The last one tried wins, so of equal ones the first comes last.
    for verdict, domain, start in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(domain + start).alias("name"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) over links between different hosts, counted before they shuffle."""
    linked = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("dst"))
    linked = linked.select("src", ascii_lower(F.col("dst")).alias("dst")).filter("src != dst AND src != ''")
    return linked.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _shares(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(source, target, share): the part of the source's weight that goes to each target."""
    totals = edges.groupBy(source).agg(F.sum("n").alias("total"))
    return edges.join(totals, source).select(F.col(source).alias("source"), F.col(target).alias("target"), (F.col("n") / F.col("total")).alias("share"))


def _flow(shares: DataFrame, ranks: DataFrame, value: str) -> DataFrame:
    moved = shares.join(ranks.select(F.col("host").alias("source"), value), "source").filter(F.col(value) > 0)
    return moved.groupBy(F.col("target").alias("host")).agg(F.sum(F.col("share") * F.col(value)).alias(f"{value}_in"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from seeds (host, allowed, blocked) with values in 0..1.

    Each round shrinks the error by `damping`, so the rounds needed follow from
    the tolerance alone. Each round ends in a written table.
    """
    nodes = seeds.unionByName(edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked")))
    seeds = written(nodes.groupBy("host").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")), "host_seeds")
    restart = seeds.select("host", ((1 - damping) * F.col("allowed")).alias("trust"), ((1 - damping) * F.col("blocked")).alias("distrust"))
    if edges.isEmpty():
        return restart
    onward, back = written(_shares(edges, "src", "dst"), "shares_out"), written(_shares(edges, "dst", "src"), "shares_in")
    ranks = written(restart, "ranks")
    while True:
        spread = restart.withColumnsRenamed({"trust": "t0", "distrust": "d0"}).join(_flow(onward, ranks, "trust"), "host", "left").join(_flow(back, ranks, "distrust"), "host", "left")
        new = spread.select(
            "host",
            (F.col("t0") + damping * F.coalesce("trust_in", F.lit(0.0))).alias("trust"),
            (F.col("d0") + damping * F.coalesce("distrust_in", F.lit(0.0))).alias("distrust"),
        )
        new = written(new, "ranks")
        old = ranks.withColumnsRenamed({"trust": "t0", "distrust": "d0"})
        step = F.greatest(F.abs(F.col("trust") - F.col("t0")), F.abs(F.col("distrust") - F.col("d0")))
        moved = new.join(old, "host").agg(F.max(step)).first()[0]
        ranks = new
        if moved is None or moved < tolerance:
            return ranks


def blocked_hosts(pages: DataFrame, damping: float = DAMPING, share: float = BLOCKED_SHARE) -> DataFrame:
    """Hosts whose spread distrust condemns them; `pages` has host, html and fit."""

    def part(verdict: str) -> Column:
        # One neutral page more, so that a single page does not speak for its host.
        return F.count_if(F.col("fit.verdict") == verdict) / (F.count(F.lit(1)) + 1)

    seeds = pages.filter("host != ''").groupBy("host").agg(part("allow").alias("allowed"), part("block").alias("blocked"))
    ranks = propagate(seeds, written(host_edges(pages), "host_edges"), damping)
    return ranks.filter((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= share * (1 - damping))).select("host")


def _parsed(pages: DataFrame, rules) -> DataFrame:
    whole = F.struct(*[pages[f"`{c}`"] for c in pages.columns])
    parsed = pages.select(whole.alias("_doc"), F.explode(F.array(F.struct(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))).alias("_u"))
    return parsed.select("_doc", "_u.host", "_u.path", rule_of(F.col("_u.host"), F.col("_u.path"), rules).alias("fit"))


def _judged(parsed: DataFrame, narrow: DataFrame) -> DataFrame:
    """`narrow`, the columns of `parsed` to go on with, plus the rule and verdict of each page."""
    bad = written(blocked_hosts(parsed.select("host", F.col("_doc.html").alias("html"), "fit")), "blocked_hosts")
    found = narrow.join(bad.select("host", F.lit(True).alias("bad")), "host", "left")
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("bad"), "block").otherwise("allow"))
    return found.select("*", F.col("fit.name").alias("rule"), verdict.alias("verdict"))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    parsed = _parsed(pages.select("page_id", "url", "html"), rules)
    found = _judged(parsed, parsed.select(F.col("_doc.page_id").alias("page_id"), "host", "path", "fit"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def allowed_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    """`pages` without those judged block."""
    parsed = _parsed(pages, rules)
    return unwrapped(_judged(parsed, parsed.select("_doc", "host", "fit")).filter("verdict = 'allow'"))
