"""Toxicity by a convolutional network over hashed word embeddings.

The embedding of a word is the sum of hashed rows for the word and for its first
four and five bytes, so unseen forms of a known stem are not strange. Filters over
one, two and three words take their maximum over the whole text; a logistic layer weighs the maxima.

All labelled texts of the learning folds are learned from. Tasks train parts of about `PART`
texts in numpy from common weights; their changes are averaged after each of `EPOCHS`
rounds, those of a word over the parts that met it. The first coordinate of an embedding starts at
the word's log-odds in all texts, rows of unseen words are zero. A second table guesses the language
of a text from its words; each language has its own threshold, set on a fold
the network did not see, and scores are shifted so that 0.5 is the threshold.

Null and empty texts have maxima of zero and get the score that follows. The
score depends on the text alone. Null ids and null labels are not learned from;
a document with several labels counts as toxic if one of them says so. Without
labelled texts of both classes every score is 0.
"""

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from orderloom.llm.common import crc_fold, groups, words_of, written

BUCKETS = 1 << 16
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PART = 8192
CHUNK = 1 << 20
# Labels up to this many rows are sent to the texts, at 32 bytes each; beyond it both are shuffled.
BROADCAST_ROWS = 1 << 23
EPOCHS = 8
# Arrays of tasks are added up in pieces of this many numbers.
BLOCK = 1 << 15
# Thresholds are chosen between cells of logits this wide.
CELL = 1 / 1024
GROUP = 1 << 20
FOLDS, HELD_OUT = 5, 0
CALIBRATION_FOLD = 1
MIN_TOXIC = 5


class Words:
    """Numbers for the words met, and the embedding rows of each; number 0 is a blank."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.rows: list[tuple[int, int, int]] = [(BUCKETS,) * 3]

    def read(self, text: str | None) -> np.ndarray:
        words, numbers = words_of(text), self.numbers
        for w in words:
            if w not in numbers:
                numbers[w] = len(self.rows)
                self.rows.append(tuple(zlib.crc32(x) % BUCKETS for x in (w, b"4 " + w[:4], b"5 " + w[:5])))
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))

    def table(self) -> np.ndarray:
        return np.array(self.rows, np.int64)


def _laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all documents in a row, each followed by blanks, and where each begins."""
    blank = np.zeros(WIDTHS[-1] - 1, np.int64)
    sizes = np.array([len(d) + len(blank) for d in docs], np.int64)
    return np.concatenate([x for d in docs for x in (d, blank)]), np.cumsum(sizes) - sizes


class TextNetwork:
    def __init__(self, languages: list[str], seed: int = 5):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.words = np.zeros((BUCKETS + 1, SIZE), np.float32)
        self.filters = {w: random.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS}
        for w in WIDTHS:
            self.filters[w][:, 0, :] = np.abs(self.filters[w][:, 0, :])
        self.out, self.bias = np.full(FILTERS * len(WIDTHS), 0.1, np.float32), np.zeros(1, np.float32)
        self.language = np.zeros((BUCKETS + 1, max(1, len(languages))), np.float32)
        self.thresholds = np.zeros(max(1, len(languages)))

    def maxima(self, docs: list[np.ndarray], table: np.ndarray, places: bool = False):
        """Filter maxima per document, at least zero, and with `places` where they are."""
        ids, first = _laid_out(docs)
        # In training the table holds the words of a whole chunk, else those of these documents.
        x = self.words[table[ids]].sum(axis=1) if places else self.words[table].sum(axis=1)[ids]
        tops, at = [], []
        for w, f in self.filters.items():
            score = x @ f[0]
            for o in range(1, w):
                score[:-o] += x[o:] @ f[o]
            # What begins at a blank would reach into the next document.
            score[ids == 0] = -np.inf
            if places:
                ends = [*first[1:], len(ids)]
                found = np.array([a + score[a:b].argmax(axis=0) for a, b in zip(first, ends)])
                at.append(found)
                tops.append(score[found, np.arange(FILTERS)])
            else:
                tops.append(np.maximum.reduceat(score, first, axis=0))
        top = np.maximum(np.concatenate(tops, axis=1), 0)
        return (top, at, ids) if places else top

    def logits(self, docs: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        return self.maxima(docs, table) @ self.out + self.bias

    def guessed(self, docs: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        ids, first = _laid_out(docs)
        return np.add.reduceat(self.language[table].sum(axis=1)[ids], first, axis=0).argmax(axis=1)

    def found(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logit and guessed language of each text."""
        words = Words()
        docs = [words.read(t) for t in texts]
        table = words.table()
        return self.logits(docs, table), self.guessed(docs, table)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logits, languages = self.found(texts)
        shifted = logits - self.thresholds[languages]
        return 1 / (1 + np.exp(-np.clip(shifted, -60, 60).astype(np.float64)))

    def begin(self, counts: "Counts") -> "TextNetwork":
        """Starting weights from the counts of all texts."""
        seen = counts.seen
        share = (seen + 0.5) / (counts.texts[:, None] + 1)
        random = np.random.default_rng(3)
        self.words[:] = random.normal(0, 0.05, self.words.shape)
        self.words[:, 0] = np.log(share[1] / share[0]) / 8
        self.words[seen.sum(axis=0) == 0] = 0
        for k in range(len(self.languages)):
            own = counts.spoken[k]
            self.language[:, k] = np.log((own + 0.01) / (own.sum() + 0.01 * BUCKETS))
        self.language[seen.sum(axis=0) == 0] = 0
        self.squares = {n: np.full_like(v, 1e-3) for n, v in self.weights().items()}
        self.weight = counts.texts.sum() / (2 * counts.texts)
        return self

    def weights(self) -> dict:
        return {"words": self.words, "out": self.out, "bias": self.bias, **self.filters}

    def train(self, docs: list[np.ndarray], table: np.ndarray, toxic: np.ndarray, random: np.random.Generator, batch: int = 32) -> None:
        """One pass over `docs`."""
        order = random.permutation(len(docs))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            top, places, ids = self.maxima([docs[i] for i in own], table, places=True)
            p = 1 / (1 + np.exp(-np.clip(top @ self.out + self.bias[0], -60, 60)))
            error = ((p - toxic[own]) * self.weight[toxic[own]] / len(own)).astype(np.float32)
            down = error[:, None] * self.out * (top > 0)
            self._step("out", self.out, top.T @ error)
            self._step("bias", self.bias, error.sum(keepdims=True))
            met, changes = [], []
            for k, w in enumerate(WIDTHS):
                g, f = down[:, k * FILTERS : (k + 1) * FILTERS], self.filters[w]
                d_f = np.zeros_like(f)
                for o in range(w):
                    hit = table[ids[np.minimum(places[k] + o, len(ids) - 1)]]
                    d_f[o] = np.einsum("dfs,df->sf", self.words[hit].sum(axis=2), g)
                    met.append(hit.reshape(-1, hit.shape[2]))
                    changes.append((g[:, :, None] * f[o].T[None]).reshape(-1, SIZE))
                self._step(w, f, d_f)
            # All rows of a word change alike.
            rows, at = np.unique(np.concatenate(met), return_inverse=True)
            change = np.zeros((len(rows), SIZE), np.float32)
            np.add.at(change, at.reshape(-1, len(WIDTHS)), np.concatenate(changes)[:, None])
            rows, change = rows[rows < BUCKETS], change[rows < BUCKETS]
            squares = self.squares["words"]
            squares[rows] += change**2
            self.words[rows] -= 0.05 * change / np.sqrt(squares[rows])

    def _step(self, name, weights: np.ndarray, gradient: np.ndarray) -> None:
        self.squares[name] += gradient**2
        weights -= 0.05 * gradient / np.sqrt(self.squares[name])

    def state(self) -> np.ndarray:
        """Weights and squares in a row, those of words first."""
        parts = [d[n] for n in self.weights() for d in (self.weights(), self.squares)]
        return np.concatenate([x.ravel() for x in parts])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for name, weights in self.weights().items():
            for x in (weights, self.squares[name]):
                x.ravel()[:] = state[at : at + x.size]
                at += x.size

    def calibrate(self, cells: pd.DataFrame) -> "TextNetwork":
        """Per language the logit halfway between the neighbours of the split of `cells` with the best F1."""
        merged = {"n": "sum", "hits": "sum", "lowest": "min", "highest": "max"}
        self.thresholds[:] = _best_split(cells.groupby("cell", as_index=False).agg(merged))
        for k, own in cells.groupby("language"):
            if own["hits"].sum() >= MIN_TOXIC:
                self.thresholds[k] = _best_split(own)
        return self


def _best_split(cells: pd.DataFrame) -> float:
    cells = cells.sort_values("cell", ascending=False)
    hits = cells["hits"].cumsum()
    best = int((2 * hits / (cells["n"].cumsum() + max(1, hits.iloc[-1]))).to_numpy().argmax())
    above = cells["lowest"].iloc[best]
    below = cells["highest"].iloc[best + 1] if best + 1 < len(cells) else above - 1
    return float(above + below) / 2


class Counts:
    """Texts by class, texts of either class with a word row, and places of a row by language."""

    def __init__(self, languages: int, total: np.ndarray | None = None):
        total = np.zeros(2 + (2 + languages) * (BUCKETS + 1)) if total is None else total
        self.total, self.texts, rows = total, total[:2], total[2:].reshape(2 + languages, -1)
        self.seen, self.spoken = rows[:2], rows[2:]

    def add(self, docs: list[np.ndarray], table: np.ndarray, toxic: np.ndarray, language: np.ndarray) -> None:
        self.texts += np.bincount(toxic, minlength=2)
        for d, y, k in zip(docs, toxic, language):
            rows = table[d].ravel()
            self.seen[y, np.unique(rows)] += 1
            if k >= 0:
                np.add.at(self.spoken[k], rows, 1)


@F.pandas_udf(T.BinaryType())
def _word_rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The embedding rows of each word of a text, two bytes each."""
    for texts in batches:
        found = []
        for group in groups(texts.tolist(), 64, GROUP):
            words = Words()
            docs = [words.read(t) for t in group]
            table = words.table()
            found += [table[d].astype("<u2").tobytes() for d in docs]
        yield pd.Series(found, dtype=object)


def _chunks(rows: Iterator) -> Iterator[tuple]:
    """Texts of a part in pieces of about `CHUNK` words, as places in a table, the table, classes and languages."""
    rows = iter(rows)
    while True:
        tables, docs, labels, size = [np.full((1, 3), BUCKETS)], [], [], 1
        for r in rows:
            tables.append(np.frombuffer(r["words"], "<u2").reshape(-1, 3))
            docs.append(np.arange(size, size + len(tables[-1])))
            labels.append((r["toxic"], r["language"]))
            size += len(tables[-1])
            if size > CHUNK:
                break
        if not docs:
            return
        yield docs, np.concatenate(tables).astype(np.int64), *np.array(labels, np.int64).T


def _added(rows: DataFrame, of_part: Callable[[int, Iterator], np.ndarray]) -> np.ndarray:
    """Sum over all parts of what `of_part` makes of the rows of one, added up piece by piece in tasks."""

    def of_task(rows):
        total = None
        for part, own in itertools.groupby(rows, lambda r: r["part"]):
            found = of_part(part, own)
            total = found if total is None else total + found
        if total is not None:
            yield from ((at, total[at : at + BLOCK]) for at in range(0, len(total), BLOCK))

    pieces = rows.rdd.mapPartitions(of_task).reduceByKey(np.add, numPartitions=8).collect()
    return np.concatenate([piece for _, piece in sorted(pieces, key=lambda p: p[0])])


def _round(rows: DataFrame, network: TextNetwork, number: int) -> None:
    """Train all parts from the same weights and take the average of their changes."""
    size, state = network.words.size, network.state()

    def trained(part: int, own: Iterator) -> np.ndarray:
        network.restore(state)
        random = np.random.default_rng((3, number, part))
        for docs, table, toxic, _ in _chunks(own):
            network.train(docs, table, toxic, random)
        change = network.state() - state
        met = change[size : 2 * size].reshape(-1, SIZE).any(axis=1)
        return np.concatenate([change, met, [1]]).astype(np.float32)

    total = _added(rows, trained)
    change, met, parts = np.split(total, [len(state), len(total) - 1])
    divisor = np.repeat(np.maximum(met, 1), SIZE)
    change[: 2 * size] /= np.tile(divisor, 2)
    change[2 * size :] /= parts
    network.restore(state + change)


def learned(docs: DataFrame, labels: DataFrame, part: int = PART) -> TextNetwork | None:
    """A calibrated network from all labelled texts of the learning folds; None without both classes."""
    fold = crc_fold(F.col("doc_id"), FOLDS)
    known = labels.filter(F.col("toxic").isin(0, 1) & (fold != HELD_OUT)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    few = known.count() <= BROADCAST_ROWS
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(known) if few else known, "doc_id").withColumn("held", fold == CALIBRATION_FOLD)
    rows = written(rows, "toxicity_labelled")
    totals = rows.groupBy("held", "toxic").count().collect()
    classes = lambda held: {r["toxic"] for r in totals if r["held"] == held}
    if len(classes(True) | classes(False)) < 2:
        return None
    calibrated = len(classes(True)) == 2 and len(classes(False)) == 2
    n = sum(r["count"] for r in totals if not (calibrated and r["held"]))
    languages = sorted(r["lang"] for r in rows.filter("lang is not null").select("lang").distinct().collect())
    number = F.lit(-1)
    for k, v in enumerate(languages):
        number = F.when(F.col("lang") == v, k).otherwise(number)

    # A part lies in one file, in an order that has nothing to do with that of the input.
    parts, place = -(-n // part), F.xxhash64("doc_id", "text")
    dealt = rows.filter(~F.col("held") if calibrated else F.lit(True)).select(_word_rows("text").alias("words"), "toxic", number.alias("language"), F.pmod(place, F.lit(parts)).cast("int").alias("part"), place.alias("place"))
    training = written(dealt.repartition(parts, "part").sortWithinPartitions("part", "place", "words", "toxic", "language"), "toxicity_parts")
    training = training.select("part", "words", "toxic", "language")

    def counted(_: int, own: Iterator) -> np.ndarray:
        counts = Counts(len(languages))
        for chunk in _chunks(own):
            counts.add(*chunk)
        return counts.total

    network = TextNetwork(languages).begin(Counts(len(languages), _added(training, counted)))
    for k in range(EPOCHS):
        _round(training, network, k)

    seen = rows.filter("held") if calibrated else rows
    found = seen.select("toxic", F.explode(F.array(_logits(network)("text"))).alias("found")).select("toxic", "found.*")
    cells = found.groupBy("language", F.floor(F.least(F.greatest("logit", F.lit(-60.0)), F.lit(60.0)) / CELL).alias("cell"))
    cells = cells.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"), F.min("logit").alias("lowest"), F.max("logit").alias("highest"))
    return network.calibrate(pd.DataFrame([r.asDict() for r in cells.collect()]))


def _logits(network: TextNetwork):
    @F.pandas_udf("logit double, language int")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [network.found(g) for g in groups(texts.tolist(), 64, GROUP)]
            logits, languages = zip(*parts) if parts else ([np.zeros(0)], [np.zeros(0, int)])
            yield pd.DataFrame({"logit": np.concatenate(logits).astype(np.float64), "language": np.concatenate(languages)})

    return found


def _scorer(network: TextNetwork | None):
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [network.scores(g) if network else np.zeros(len(g)) for g in groups(texts.tolist(), 64, GROUP)]
            yield pd.Series(np.concatenate([np.zeros(0), *parts]))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, network: TextNetwork | None = None) -> DataFrame:
    """Score and prediction of every document."""
    network = network or learned(docs, labels)
    found = docs.select("doc_id", F.explode(F.array(_scorer(network)("text"))).alias("score"))
    held_out = F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def harmless(docs: DataFrame, labels: DataFrame, network: TextNetwork | None = None) -> DataFrame:
    """`docs` without those predicted toxic."""
    score = _scorer(network or learned(docs, labels))
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    return docs.select(whole.alias("_doc"), F.explode(F.array(score("text"))).alias("_s")).filter("_s < 0.5").select("_doc.*")
