"""SimHash near-duplicates with Golay-code keys.

A fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to
a word of the perfect binary (23, 12, 7) Golay code. Every 23-bit word lies
within three bits of exactly one codeword; the codewords near a segment are
those that it, or a word one bit away, decodes to: one to six of them. Two
segments at most two bits apart have a word between them that is within one bit
of both, so they share a nearby codeword. Of two errors over three segments at
least one segment has none, so fingerprints at most two bits apart share a key
(segment k as it is, a codeword near segment k+1) for some k. Pairs that share a
key are verified by their bits.

Only distinct fingerprints are joined, so exact copies cost nothing. Keys of
more than `crowd` fingerprints make no pairs: their fingerprints are listed
under all words within one bit instead, and those listed under the same word,
at most two bits apart by construction, are linked to the smallest. This finds
the same links with rows in proportion to the fingerprints.

Components grow by alternating star steps over written tables. Null and empty
texts have fingerprint zero. Null ids take part, but name a component only if
it has no other id (then the component id is null). Repeated rows are copies of
each other. An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from orderloom.llm.common import unwrapped, written

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 16

_GOLAY = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, generator of the code
_WIDTH = 23
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
_SPACE = bytes(0x20 if b in (0x20, *range(0x09, 0x0E)) else b for b in bytes(range(256)).lower())


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the lower-cased words' shingles, repeats included."""
    words = text.encode().translate(_SPACE).split() if text else []
    if not words:
        return 0
    runs = zip(*[words[k:] for k in range(shingle)]) if len(words) >= shingle else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(shingle: int):
    @F.pandas_udf(T.LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts.tolist()], dtype="int64")

    return of


def _syndromes(words: np.ndarray) -> np.ndarray:
    out = words.copy()
    for bit in range(_WIDTH - 1, 10, -1):
        out ^= np.where(out >> bit & 1, _GOLAY << bit - 11, 0)
    return out


def _leaders() -> np.ndarray:
    """The error pattern of at most three bits behind each of the 2048 syndromes."""
    ones = 1 << np.arange(_WIDTH)
    two = (ones[:, None] | ones).ravel()
    patterns = np.unique(np.concatenate([[0], (two[:, None] | ones).ravel()]))
    table = np.zeros(1 << 11, np.int64)
    table[_syndromes(patterns)] = patterns
    return table


def near_codewords(segments: np.ndarray, leaders: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords near each segment, one row each; -1 pads a row."""
    words = segments[:, None] ^ np.concatenate([[0], 1 << np.arange(_WIDTH)])
    found = np.sort((words ^ leaders[_syndromes(words)]) >> 11, axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def golay_keys(prints: np.ndarray, leaders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) for all keys."""
    bits = prints.astype(np.int64).view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in _SEGMENTS]
    owners, keys = [], []
    for k in range(3):
        near = near_codewords(parts[(k + 1) % 3], leaders)
        row, column = np.nonzero(near >= 0)
        owners.append(row)
        keys.append((k << 40) | (parts[k][row] << 12) | near[row, column])
    return np.concatenate(owners), np.concatenate(keys)


def _keyed(prints: DataFrame) -> DataFrame:
    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaders = _leaders()
        for batch in batches:
            own = batch["fp"].to_numpy(np.int64)
            owners, keys = golay_keys(own, leaders)
            yield pd.DataFrame({"key": keys, "fp": own[owners]})

    return prints.select("fp").mapInPandas(key, "key long, fp long")


def links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b), a > b, of distinct fingerprints whose graph has the components of all pairs within `distance`.

    `distance` is at most 2. Up to `crowd` fingerprints under a key give all
    their pairs; larger crowds give stars, which join the same fingerprints.
    """
    if not 0 < distance <= 2:
        raise ValueError("Golay keys find one or two differing bits")
    keys = _keyed(prints)
    shared = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared_keys")
    met = written(keys.join(shared, "key"), "met")
    pairs = F.flatten(
        F.transform("fps", lambda a: F.transform(F.filter("fps", lambda b: (b < a) & (F.bit_count(a.bitwiseXOR(b)) <= distance)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    )
    few = met.filter(F.col("n") <= crowd).groupBy("key").agg(F.collect_list("fp").alias("fps")).select(F.explode(pairs).alias("p")).select("p.*")
    many = met.filter(F.col("n") > crowd).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(64)])
    if distance == 1:
        # One bit apart: the word between two is one of them.
        near = many.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("word"))
        stars = near.join(many.select(F.col("fp").alias("word")), "word").select(F.greatest("fp", "word").alias("a"), F.least("fp", "word").alias("b"))
    else:
        near = many.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("word"))
        # A word has 65 neighbours at most, so its group is bounded.
        stars = near.groupBy("word").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
        stars = stars.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a")).select("a", "b")
    return few.unionByName(stars).filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), a > b; root is the smallest node of its component.

    Each round hangs larger neighbours under the smallest one (large star) and
    then smaller neighbours (small star) until nothing changes, a number of
    rounds that grows with the logarithm of the longest path.
    """
    edges = written(edges, "edges")
    state = _state(edges)
    while True:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = edges.join(least, edges["b"] == least["u"]).select(edges["a"], F.col("m").alias("b")).distinct()
        large = written(large, "large_star")
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small_star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    hashes = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashes)).first())


def _grouped(printed: DataFrame, distance: int, crowd: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of the written rows (doc_id, fp)."""
    prints = written(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = written(components(links(prints, distance, crowd)), "roots")
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return written(rooted.join(names, "root").select("fp", "root", "component_id"), "grouped")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Every row's doc_id, fingerprint (hexadecimal) and component_id, the smallest doc_id reachable over links."""
    printed = written(docs.select("doc_id", _fingerprints(shingle)("text").alias("fp")), "printed")
    found = printed.join(_grouped(printed, distance, crowd), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """`docs` with one row per group of near-duplicates, that of the smallest doc_id (null ids last)."""
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"), F.monotonically_increasing_id().alias("_row"))
    whole = written(whole, "numbered_documents")
    printed = whole.select(F.col("_doc.doc_id").alias("doc_id"), "_row", _fingerprints(shingle)("_doc.text").alias("fp"))
    printed = written(printed, "printed")
    rows = printed.join(_grouped(printed, distance, crowd), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("_row").alias("row"))
    kept = rows.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.row").alias("_row"))
    return unwrapped(whole.join(kept, "_row", "left_semi"))
