"""Token counts of whole texts, huge ones by overlapping chunks that resynchronise.

A text of up to `CHUNK` characters is a sum over its words, as the vocabulary
drops white space and never joins what it separates; words of up to `MEMO_LENGTH`
characters met before are remembered. A longer text is encoded in chunks with
offsets. Each chunk starts inside the one before. An offset is stable where both
have a token and the vocabulary's pattern must end a match: after white space, at a
digit, and where letters meet other signs (`_breaks_at`), so text without blanks has
stable offsets too. The streams are spliced at the last stable offset of the
overlap, provided that they hold the same ids between the first and the last one.
Otherwise the overlap is doubled, and at last both chunks are encoded as one and
the next one is as long as all since the last splice: a text that is one endless
word is still counted exactly, and encoded at most about twice.

Null text counts as empty: no bytes, no tokens. Every row is counted, whatever
its id, and repeated rows are counted each.
"""

import os
import unicodedata
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 32_768
OVERLAP = 512
MEMO_WORDS, MEMO_LENGTH = 200_000, 64


class TokenCounter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.chunk, self.overlap = chunk, overlap
        self.memo: dict[str, int] = {}
        self.widened = 0

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return self.by_chunks(text) if len(text) > self.chunk else self.by_words(text)

    def by_words(self, text: str) -> int:
        words = text.replace("\n", " ").split(" ")
        try:
            return sum(map(self.memo.__getitem__, words))
        except KeyError:
            pass
        new = [w for w in dict.fromkeys(words) if w not in self.memo]
        found = dict(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        total = sum(found[w] if w in found else self.memo[w] for w in words)
        if len(self.memo) + len(found) > MEMO_WORDS:
            self.memo.clear()
        self.memo.update((w, n) for w, n in found.items() if len(w) <= MEMO_LENGTH)
        return total

    def _stream(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        return np.array([a for a, _ in found.offsets], np.int64) + start, np.array(found.ids, np.int64)

    def by_chunks(self, text: str) -> int:
        total, begin, end = 0, 0, min(self.chunk, len(text))
        starts, ids = self._stream(text, 0, end)
        while end < len(text):
            stop, overlap, splice = min(end + max(self.chunk, end - begin), len(text)), self.overlap, None
            while splice is None and overlap < end - begin:
                # Without two breaks no offset can be stable, so nothing is encoded.
                if len(list(islice(filter(partial(_breaks_at, text), range(end - 1, end - overlap, -1)), 2))) == 2:
                    later = self._stream(text, end - overlap, stop)
                    splice = _splice(text, (starts, ids), later, end - overlap, end)
                if splice is None:
                    overlap *= 2
                    self.widened += 1
            if splice is None:
                starts, ids = self._stream(text, begin, stop)
            else:
                total += int(np.count_nonzero((starts >= begin) & (starts < splice)))
                begin, (starts, ids) = splice, later
            end = stop
        return total + int(np.count_nonzero(starts >= begin))


def _kind(sign: str) -> str:
    kind = unicodedata.category(sign)[0]
    return kind if kind in "LN" else "blank" if sign.isspace() else "other"


def _breaks_at(text: str, at: int) -> bool:
    """Whether a match of the vocabulary's pattern must end before `at`, whatever else the text holds.

    The sign at `at` must not be one that normalisation joins to the one before it, and
    an apostrophe before a letter may begin a short form. The vocabulary writes letters
    small, which can end a letter in a mark.
    """
    left, right = text[at - 1].lower()[-1], text[at]
    if left in " \n\t\r":
        return True
    if not (right.isascii() or unicodedata.category(right)[0] in "NPSZ") or left == "'" and right.isalpha():
        return False
    return "N" in (kinds := {_kind(left), _kind(right)}) or len(kinds) == 2


def _splice(text: str, earlier, later, low: int, high: int) -> int | None:
    """The last stable offset of the overlap low..high, if both streams agree on it."""
    both = np.intersect1d(earlier[0], later[0])
    stable = [int(p) for p in both[(both > low) & (both < high)] if _breaks_at(text, p)]
    if len(stable) < 2:
        return None
    first, last = stable[0], stable[-1]
    same = [ids[(starts >= first) & (starts < last)] for starts, ids in (earlier, later)]
    return last if np.array_equal(*same) else None


COUNTS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def _counter(path: str, chunk: int, overlap: int):
    @F.pandas_udf(COUNTS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(path, chunk, overlap)
        for texts in batches:
            texts = [t or "" for t in texts.tolist()]
            yield pd.DataFrame({"n_bytes": [len(t.encode()) for t in texts], "n_tokens": [counter.count(t) for t in texts]})

    return count


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds `limit` tokens."""
    count = _counter(vocabulary or public_tokenizers.path(VOCABULARY), chunk, overlap)
    counted = docs.select("doc_id", F.explode(F.array(count("text"))).alias("_c"))
    return counted.select("doc_id", "_c.n_bytes", "_c.n_tokens", (F.col("_c.n_tokens") > limit).alias("over_limit"))
