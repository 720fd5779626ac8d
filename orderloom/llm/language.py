"""Language identification by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a text are cut into windows of 128. In each, one GRU reads
forward and one backward, and both states label every byte with a probability
per language. A document's probabilities are the mean over all of its bytes, so
every byte of a text of any length counts and memory is bounded by a batch of
windows. The network is trained here in numpy by backpropagation through time,
on passages of at most about `SAMPLE` documents of each language.

Null text, and text without a letter, is `und` with score 0, and so is all text
where nothing could be learned from. The prediction depends on the text alone:
equal texts get equal results, null ids are neither learned from nor held out.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from orderloom.llm.common import crc_fold, hashed_sample

HIDDEN = 10
STEPS = 128
BATCH = 1024
SAMPLE = 1000
PASSAGE = 400
EPOCHS = 4
FOLDS, HELD_OUT = 4, 2
MIN_SCORE = 0.3
UNKNOWN = "und"
_PAD = 256


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x steps) byte numbers padded with 256, owner of each window, real bytes of each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // STEPS)
    flat = np.full(int(counts.sum()) * STEPS, _PAD, np.int16)
    for start, t in zip((np.cumsum(counts) - counts) * STEPS, texts):
        flat[start : start + len(t)] = np.frombuffer(t, np.uint8)
    x = flat.reshape(-1, STEPS)
    return x, np.repeat(np.arange(len(texts)), counts), (x != _PAD).sum(axis=1)


def batches(texts: Iterable[bytes], size: int = BATCH) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts cut at window ends into groups of at most `size` windows, with the number of each piece's text."""
    owners, pieces, room = [], [], size
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            pieces.append(text[at : at + room * STEPS])
            owners.append(k)
            at += len(pieces[-1])
            room -= -(-len(pieces[-1]) // STEPS)
            if not room:
                yield owners, pieces
                owners, pieces, room = [], [], size
    if pieces:
        yield owners, pieces


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Two GRUs and a softmax per byte; `tables` are the input weights of each byte value."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        random, k = np.random.default_rng(seed), len(languages)
        self.languages, self.hidden = languages, hidden
        self.weights = {"out": random.normal(0, 0.3, (2 * hidden, k)), "bias": np.zeros(k)}
        for side in "fb":
            self.weights[f"table_{side}"] = random.normal(0, 0.3, (257, 3 * hidden))
            self.weights[f"loop_{side}"] = random.normal(0, 0.3, (hidden, 3 * hidden))
        self.weights = {n: w.astype(np.float32) for n, w in self.weights.items()}

    def _run(self, x: np.ndarray, side: str, tape: list | None = None) -> np.ndarray:
        """States (steps, windows, hidden) of one direction; x is (steps, windows)."""
        table, loop, n = self.weights[f"table_{side}"], self.weights[f"loop_{side}"], self.hidden
        h, out = np.zeros((x.shape[1], n), np.float32), np.empty((*x.shape, n), np.float32)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            given, back = table[x[t]], h @ loop
            gates = _sigmoid(given[:, : 2 * n] + back[:, : 2 * n])
            keep, reset = gates[:, :n], gates[:, n:]
            new = np.tanh(given[:, 2 * n :] + reset * back[:, 2 * n :])
            if tape is not None:
                tape.append((t, h, keep, reset, new, back[:, 2 * n :]))
            h = new + keep * (h - new)
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray, tapes: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (steps, windows, languages) and the states behind them."""
        states = np.concatenate([self._run(x, s, None if tapes is None else tapes.setdefault(s, [])) for s in "fb"], axis=2)
        logits = states @ self.weights["out"] + self.weights["bias"]
        shares = np.exp(logits - logits.max(axis=2, keepdims=True))
        return shares / shares.sum(axis=2, keepdims=True), states

    def gradients(self, x: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over real bytes; x is (steps, windows)."""
        tapes: dict = {}
        shares, states = self.probabilities(x, tapes)
        real = x != _PAD
        error = shares
        error[:, np.arange(x.shape[1]), labels] -= 1
        error *= real[..., None] / max(1, real.sum())
        flat = error.reshape(-1, error.shape[2])
        found = {"out": states.reshape(len(flat), -1).T @ flat, "bias": flat.sum(axis=0)}
        down, n = error @ self.weights["out"].T, self.hidden
        for side, own in (("f", down[..., :n]), ("b", down[..., n:])):
            loop = self.weights[f"loop_{side}"]
            d_loop, d_table, dh = np.zeros_like(loop), np.zeros((257, 3 * n)), 0
            d_given = np.empty((*x.shape, 3 * n), np.float32)
            for t, h, keep, reset, new, back in reversed(tapes[side]):
                dh = dh + own[t]
                d_new = dh * (1 - keep) * (1 - new * new)
                d_keep = dh * (h - new) * keep * (1 - keep)
                d_reset = d_new * back * reset * (1 - reset)
                d_given[t] = np.concatenate([d_keep, d_reset, d_new], axis=1)
                d_back = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
                d_loop += h.T @ d_back
                dh = dh * keep + d_back @ loop.T
            for column in range(3 * n):
                d_table[:, column] = np.bincount(x.ravel(), d_given[..., column].ravel(), 257)
            found[f"loop_{side}"], found[f"table_{side}"] = d_loop, d_table.astype(np.float32)
        return found

    def train(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 96) -> "Network":
        x, owner, _ = windows(texts)
        y, random = np.array(labels)[owner], np.random.default_rng(11)
        moments = {n: (np.zeros_like(w), np.zeros_like(w)) for n, w in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(x))
            for at in range(0, len(order), batch):
                own, step = order[at : at + batch], step + 1
                found = self.gradients(np.ascontiguousarray(x[own].T), y[own])
                norm = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
                for name, g in found.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    first, second = moments[name]
                    first += 0.1 * (g - first)
                    second += 0.01 * (g * g - second)
                    slow = rate * 0.5**epoch
                    self.weights[name] -= slow * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        return self

    def pooled(self, texts: Iterable[bytes], count: int) -> np.ndarray:
        """Mean probabilities over the bytes of each of `count` texts (zeros for an empty one)."""
        sums, total = np.zeros((count, len(self.languages))), np.zeros(count)
        for owners, pieces in batches(texts):
            x, piece, sizes = windows(pieces)
            part, owner = np.ascontiguousarray(x.T), np.array(owners)[piece]
            shares, _ = self.probabilities(part)
            shares *= (part != _PAD)[..., None]
            np.add.at(sums, owner, shares.sum(axis=0))
            np.add.at(total, owner, sizes)
        return sums / np.maximum(total, 1)[:, None]


def learned(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network from the learning folds; None without a labelled text."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    start = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(1)), F.greatest(F.lit(1), F.char_length("text") - PASSAGE)) + 1
    rows = hashed_sample(known.select("doc_id", "lang", F.substring("text", start.cast("int"), F.lit(PASSAGE)).alias("text")), "lang", sample)
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    return Network(languages).train([r["text"].encode() for r in rows], [languages.index(r["lang"]) for r in rows])


FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(network: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    out = [(UNKNOWN, 0.0)] * len(texts)
    if network is None:
        return out
    spoken = [k for k, text in enumerate(texts) if text and any(map(str.isalpha, text))]
    for k, shares in zip(spoken, network.pooled((texts[k].encode() for k in spoken), len(spoken))):
        out[k] = (network.languages[int(shares.argmax())], min(1.0, float(shares.max())))
    return out


def _predictor(network: Network | None):
    @F.pandas_udf(FOUND)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predict(network, texts.tolist()), columns=FOUND.names)

    return label


def languages(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """Predicted language and pooled probability of every document."""
    network = network or learned(docs)
    found = docs.select("doc_id", F.explode(F.array(_predictor(network)("text"))).alias("_l"))
    held_out = F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "_l.lang_pred", "_l.score")


def in_a_language(docs: DataFrame, network: Network | None = None, score: float = MIN_SCORE) -> DataFrame:
    """`docs` without texts of no language or with a score below `score`."""
    network = network or learned(docs)
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    found = docs.select(whole.alias("_doc"), F.explode(F.array(_predictor(network)("text"))).alias("_l"))
    return found.filter((F.col("_l.lang_pred") != UNKNOWN) & (F.col("_l.score") >= score)).select("_doc.*")
