"""Packing by minimum bin slack over the histogram of lengths.

A document is cut at every `capacity` tokens; what remains of it, shorter than
a window, is packed. Only the histogram of these lengths, at most `capacity`
rows, reaches the driver. For the longest length left, a bitset subset-sum over
the lengths and their counts finds the multiset that fills its window closest
to the capacity, and backtracking gives the counts; the pattern is repeated as
often as the counts allow, so that the number of searches follows the number of
lengths and not of documents. A length whose window cannot be filled to the
brim is set aside: documents set aside are cut at the powers of two in their
length, and those parts, longest first, fill windows without gap. The last
windows are powers of two. Thus nothing is padded.

Executors place pieces by arithmetic: the rank of a document among those of its
length is a prefix count over input partitions plus its position in its own, so
no length gathers in one task.

Null or empty text is the end mark alone. Every row is packed, repeated rows and
null ids included. An empty table gives no piece.
"""

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer

from orderloom.llm.common import written

CAPACITY = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
LONG_WORD = 4096

_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
_GAP = re.compile(rf"\s{{{LONG_WORD}}}")
_SEQUENCE_BITS = 36


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, as the tokenizers library gives them.

    tiktoken reads the same vocabulary as ranks and the same word pattern at four
    times the speed, so it encodes plain text: Latin letters and common signs
    without strings of added tokens or overlong words. All else, where the two
    libraries' character classes or handling of special strings could differ,
    goes to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = _byte_letters()
        words = {w: i for w, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        ranks = {bytes(letters[c] for c in w): i for w, i in words.items() if all(c in letters for c in w)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self._is_plain(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _is_plain(self, text: str) -> bool:
        if any(a in text for a in self.added) or not text.isascii() and _UNUSUAL.search(text):
            return False
        return len(text) <= LONG_WORD or max(map(len, text.split()), default=0) <= LONG_WORD and not _GAP.search(text)


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if printable, else the next free one."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def binary_parts(length: int) -> list[int]:
    """The powers of two in `length`, the largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def _encoded_schema(doc_id: T.DataType) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    return T.StructType(
        [
            T.StructField("doc_id", doc_id),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("window_crcs", longs),
            T.StructField("rest", T.IntegerType()),
            T.StructField("rest_crc", T.LongType()),
            T.StructField("part_crcs", longs),
            T.StructField("part", T.LongType()),
            T.StructField("nth_window", T.LongType()),
            T.StructField("nth", T.LongType()),
        ]
    )


def encoded(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Lengths and checksums of every document; `part`, `nth` and `nth_window` number them by input partition."""
    schema = _encoded_schema(docs.schema["doc_id"].dataType)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, nth_window = Encoder(vocabulary), TaskContext.get().partitionId(), 0
        seen: dict[int, int] = {}
        end, arrow = np.array([END_ID], "<u4").tobytes(), None
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text or "") + end if text else end
                n = len(ids) // 4
                whole, rest = n // capacity, n % capacity
                crcs = [zlib.crc32(ids[4 * capacity * k : 4 * capacity * (k + 1)]) for k in range(whole)]
                tail, parts, at = ids[4 * capacity * whole :], [], 0
                for p in binary_parts(rest):
                    parts.append(zlib.crc32(tail[4 * at : 4 * (at + p)]))
                    at += p
                rows.append((n, crcs, rest, zlib.crc32(tail), parts, part, nth_window, seen.get(rest, 0)))
                seen[rest] = seen.get(rest, 0) + 1
                nth_window += whole
            arrow = arrow or [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, arrow)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema.names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def fill_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length: copies) that fill a window exactly, with how often each is used."""
    left = {n: c for n, c in histogram.items() if 0 < n < capacity and c > 0}
    plan = []
    for seed in sorted(left, reverse=True):
        while left.get(seed, 0):
            pattern = _closest({**left, seed: left[seed] - 1}, capacity - seed)
            pattern[seed] = pattern.get(seed, 0) + 1
            if sum(n * k for n, k in pattern.items()) < capacity:
                break
            times = min(left[n] // k for n, k in pattern.items())
            plan.append((pattern, times))
            for n, k in pattern.items():
                left[n] -= k * times
        left.pop(seed, None)
    return plan


def _closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum up to `room`."""
    full, reach, steps = (1 << room + 1) - 1, 1, []
    for n in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        copies, k = min(counts[n], room // n), 1
        while copies and not reach >> room & 1:
            take = min(k, copies)
            steps.append((n, take, reach))
            reach |= reach << n * take & full
            copies, k = copies - take, 2 * k
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> at & 1:
            out[n] = out.get(n, 0) + take
            at -= n * take
    return out


class Places:
    """Where the document of a given length and rank goes."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        used: dict[int, int] = {}
        entries, sequence = [], 0
        for pattern, times in fill_windows(histogram, capacity):
            offset = 0
            for n in sorted(pattern, reverse=True):
                entries.append((n, used.get(n, 0), pattern[n], sequence, offset))
                used[n] = used.get(n, 0) + pattern[n] * times
                offset += n * pattern[n]
            sequence += times
        entries.sort()
        self.length, self.first, self.copies, self.sequence, self.offset = np.array(entries, np.int64).reshape(-1, 5).T
        self.keys = (self.length << 48) | self.first
        self.used = used
        aside = {n: c - used.get(n, 0) for n, c in histogram.items() if 0 < n < capacity and c > used.get(n, 0)}
        self.aside_first, at = {}, 0
        for k in range(capacity.bit_length(), -1, -1):
            for n in sorted(aside):
                if n >> k & 1:
                    self.aside_first[n, 1 << k] = at
                    at += aside[n] << k
        self.aside_base, self.aside_total = sequence, at

    def of(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces (start, length, sequence, offset) of one document's rest."""
        used = self.used.get(length, 0)
        if rank < used:
            e = int(np.searchsorted(self.keys, (length << 48) | rank, "right")) - 1
            turn, slot = divmod(rank - int(self.first[e]), int(self.copies[e]))
            return [(0, length, int(self.sequence[e]) + turn, int(self.offset[e]) + slot * length)]
        out, start = [], 0
        for part in binary_parts(length):
            at = self.aside_first[length, part] + (rank - used) * part
            out.append((start, part, *self._aside(at)))
            start += part
        return out

    def _aside(self, at: int) -> tuple[int, int]:
        window, offset = divmod(at, self.capacity)
        tail = self.aside_total % self.capacity
        if window < self.aside_total // self.capacity:
            return self.aside_base + window, offset
        for k, part in enumerate(binary_parts(tail)):
            if offset < part:
                return self.aside_base + window + k, offset
            offset -= part
        raise ValueError("a piece lies outside the windows")


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: where it starts in its document, its checksum, its sequence and offset there."""
    lengths = written(encoded(docs, vocabulary or public_tokenizers.path(VOCABULARY), capacity), "encoded")
    counts = written(lengths.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n")), "length_counts")
    places = Places({r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("rest", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = lengths.join(ranks, ["rest", "part"]).select("*", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_piece_maker(places, capacity), _piece_schema(docs.schema["doc_id"].dataType))


def _piece_schema(doc_id: T.DataType) -> T.StructType:
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return T.StructType([T.StructField("doc_id", doc_id), *[T.StructField(n, T.LongType()) for n in names]])


def _piece_maker(places: Places, capacity: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, rows = [], []
            columns = ["doc_tokens", "window_crcs", "rest", "rest_crc", "part_crcs", "part", "nth_window", "rank"]
            for i, (tokens, crcs, rest, rest_crc, part_crcs, part, nth, rank) in enumerate(zip(*[batch.column(c).to_pylist() for c in columns])):
                pieces = [(k * capacity, capacity, crc, tokens, (part + 1 << _SEQUENCE_BITS) + nth + k, 0) for k, crc in enumerate(crcs)]
                if rest:
                    own = places.of(rest, rank)
                    for (start, n, sequence, offset), crc in zip(own, [rest_crc] if len(own) == 1 else part_crcs):
                        pieces.append((len(crcs) * capacity + start, n, crc, tokens, sequence, offset))
                which += [i] * len(pieces)
                rows += pieces
            values = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)]
            ids = batch.column("doc_id").take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *values], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return make
