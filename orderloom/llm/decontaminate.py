"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training words.

Benchmark items become rows (window, item). They are broadcast in blocks of at
most `block_rows` rows, a bound on memory whatever the size of the benchmark; a
larger benchmark is scanned block by block and the hits of a document are
merged. Only windows made of benchmark words throughout are hashed, and each
hash found is verified word by word.

Null text has no words. A document or item without words has no hits. An item
without id still marks words, but is not listed. Equal windows of several items
count for each of them; repeated documents are judged one by one. Any further
columns pass through untouched.
"""

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from orderloom.llm.common import FOLD, ascii_lower, groups, words_of, written

WINDOW = 13
BLOCK_ROWS = 250_000
GROUP = 1 << 22

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct rows (window, item): all runs of `window` words of an item, or the whole of a shorter one."""
    words = F.filter(F.split(ascii_lower(F.col("text")), _BREAKS), lambda w: w != "")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    return (
        items.select("item", "words", F.explode(starts).alias("at"))
        .select(F.array_join(F.slice("words", F.col("at"), window), " ").alias("window"), "item")
        .distinct()
    )


class WindowSet:
    """Windows of one block with their hashes; `scan` finds them in documents."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        for window, item in rows:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window.encode().split(b" ")]
            self.items[len(ids)][np.array(ids, np.int32).tobytes()].add(item)
        self.hashes = {n: np.unique(_hashes(np.array([np.frombuffer(k, np.int32) for k in known]))) for n, known in self.items.items()}

    def scan(self, texts: list[str | None]) -> list[tuple]:
        """Per text: words, words hit, starts and ends of the windows that occur, items they belong to."""
        docs = [words_of(t) for t in texts]
        counts = np.array([len(d) for d in docs], np.int64)
        first = np.cumsum(counts + 1) - counts - 1
        find = self.vocabulary.get
        ids = np.zeros(int(counts.sum()) + len(docs) + 1, np.int32)
        for at, d in zip(first, docs):
            ids[at : at + len(d)] = [find(w, 0) for w in d]
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        spans = []
        for n, hashes in self.hashes.items():
            if len(ids) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            rows = ids[at[:, None] + np.arange(n)]
            near = np.flatnonzero(hashes[np.minimum(np.searchsorted(hashes, h := _hashes(rows)), len(hashes) - 1)] == h)
            spans += [(int(at[i]), n, items) for i in near if (items := self.items[n].get(rows[i].tobytes()))]
        steps = np.zeros(len(ids) + 1, np.int32)
        found = defaultdict(list)
        for at, n, items in sorted(spans, key=lambda s: s[:2]):
            steps[at] += 1
            steps[at + n] -= 1
            found[int(np.searchsorted(first, at, "right")) - 1].append((at, n, items))
        hit = np.concatenate([[0], np.cumsum(np.cumsum(steps) > 0)])
        out = []
        for k, (at, n) in enumerate(zip(first.tolist(), counts.tolist())):
            own = found.get(k, [])
            items = sorted({i for _, _, items in own for i in items if i is not None})
            out.append((n, int(hit[at + n] - hit[at]), [s - at for s, _, _ in own], [s - at + m for s, m, _ in own], items))
        return out


def _hashes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = (out ^ column.astype(np.uint64)) * _BASE
        out ^= out >> np.uint64(29)
    return out


def _scanner(rows: list[tuple[str, str | None]]):
    @F.pandas_udf(HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = WindowSet(rows)
        for texts in batches:
            found = [r for group in groups(texts.tolist(), 256, GROUP) for r in windows.scan(group)]
            yield pd.DataFrame(found, columns=HITS.names)

    return scan


@F.pandas_udf(HITS)
def _merged(several: pd.Series) -> pd.DataFrame:
    out = []
    for scans in several:
        spans = sorted({(int(a), int(b)) for s in scans for a, b in zip(s["starts"], s["ends"])})
        hit, end = 0, 0
        for a, b in spans:
            hit += max(0, b - max(a, end))
            end = max(end, b)
        items = sorted({i for s in scans for i in s["items"]})
        out.append((scans[0]["n_words"], hit, [a for a, _ in spans], [b for _, b in spans], items))
    return pd.DataFrame(out, columns=HITS.names)


def with_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row of `docs` as `_doc` with its `_hits`: word counts, word spans and items found."""
    rows = written(benchmark_windows(benchmark, window), "benchmark_windows")
    blocks = max(1, -(-rows.count() // block_rows))
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"))
    if blocks == 1:
        return _scanned(whole, rows)
    whole = written(whole.withColumn("_row", F.monotonically_increasing_id()), "numbered_documents")
    block = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    scans = [written(_scanned(whole, rows.filter(block == k)).select("_row", "_hits"), "block_hits") for k in range(blocks)]
    union = scans[0]
    for scan in scans[1:]:
        union = union.unionByName(scan.filter(F.size("_hits.starts") > 0))
    merged = union.groupBy("_row").agg(F.collect_list("_hits").alias("several")).select("_row", _merged("several").alias("_hits"))
    return whole.join(merged, "_row").select("_doc", "_hits")


def _scanned(docs: DataFrame, rows: DataFrame) -> DataFrame:
    scan = _scanner([tuple(r) for r in rows.select("window", "item").collect()])
    # The generator keeps the scan from being copied into every use of its result.
    return docs.select("*", F.explode(F.array(scan(F.col("_doc.text")))).alias("_hits"))


def is_contaminated():
    return (F.col("_hits.n_hit") > 0) & (20 * F.col("_hits.n_hit") >= F.col("_hits.n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without those of which benchmark passages make up a twentieth of the words or more."""
    return with_hits(docs, benchmark, **options).filter(~is_contaminated()).select("_doc.*")


@F.pandas_udf(T.StringType())
def _without_spans(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([cut_words(t, a, b) for t, a, b in zip(texts, starts, ends)], dtype=object)


def cut_words(text: str | None, starts, ends) -> str | None:
    """`text` without the words start..end-1 of each span and what stands between them."""
    if not text or len(starts) == 0:
        return text
    raw, folded = text.encode(), text.encode().translate(FOLD)
    edges, at = [], 0
    for word in folded.split():
        at = folded.index(word, at)
        edges.append((at, at + len(word)))
        at += len(word)
    out, end = [], 0
    for a, b in sorted(zip(starts, ends)):
        out.append(raw[end : max(end, edges[a][0])])
        end = max(end, edges[b - 1][1])
    return b"".join([*out, raw[end:]]).decode()


def without_passages(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` with every benchmark passage cut out of its text instead of dropping documents."""
    text = _without_spans(F.col("_doc.text"), F.col("_hits.starts"), F.col("_hits.ends"))
    return with_hits(docs, benchmark, **options).select(F.col("_doc").withField("text", text).alias("_doc")).select("_doc.*")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document with the digest of its hits."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, **options)
    return found.select(
        F.col("_doc.doc_id").alias("doc_id"),
        F.col("_hits.n_words").alias("n_words"),
        F.col("_hits.n_hit").alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_hits.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(13, len(w)) AS n,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)
), o AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
), h AS (
  SELECT o.r, o.i, o.n, g.item FROM o JOIN g USING (g, n)
), c AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r
), t AS (
  SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM h GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
