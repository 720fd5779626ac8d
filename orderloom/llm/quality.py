"""Quality rules as weak supervision, with DataFrame functions only.

Every rule votes good or bad or abstains. The votes of all documents are counted
by pattern: at most 3 ** rules rows, whatever the input, so the driver may hold
them. Expectation-maximisation over these counts estimates how often each rule
is right about good and about bad documents where it votes, and the share of good
ones; an abstention is no evidence. The posterior probability that a document is
good replaces "all rules must pass".

Null text has no words. Texts without words and tables without rows are valid;
every row is judged, whatever its id, repeated rows alike. Repeated five-word
windows are found by the 64-bit hash of their words.
"""

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import WORD_BREAK, let, written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ACCEPT = 0.5
TOLERANCE = 1e-9

_SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words, as a sign of running text.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "for", "with", "de", "la", "le", "les", "et", "des", "un", "que", "der", "die", "das", "und", "ist", "von", "el", "los", "en", "para", "con"]


def _chars_without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _repeated_words(words: Column) -> Column:
    """Words covered by windows that occur twice or more; n log n in the words of a text."""

    def covered(windows: Column) -> Column:
        def positions(ordered: Column) -> Column:
            twice = F.filter(ordered, lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda s, n: s + n)

        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        several = let(let(ordered, positions), total)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(several)

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
        )

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered)


def measures(docs: DataFrame) -> DataFrame:
    """Counts per document, computed once: the base of the contract and what the rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACES, "") != "")
    stops = F.array(*map(F.lit, STOP_WORDS))
    # Generators keep the word and line lists from being computed again for each use.
    split = docs.select("doc_id", text.alias("_text"), F.explode(F.array(F.struct(words.alias("w"), lines.alias("l")))).alias("_s"))
    letters = F.char_length(F.regexp_replace("_text", r"\P{L}+", ""))
    capitals = F.char_length(F.regexp_replace("_text", r"\P{Lu}+", ""))
    return split.select(
        "doc_id",
        F.size("_s.w").cast("long").alias("n_words"),
        _chars_without(F.col("_text"), _SPACES).cast("long").alias("word_chars"),
        (F.char_length("_text") - _chars_without(F.col("_text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_s.l") - F.size(F.array_distinct("_s.l"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("_s.w")).alias("n_repeat_words"),
        F.size("_s.l").cast("long").alias("_lines"),
        letters.cast("long").alias("_letters"),
        capitals.cast("long").alias("_capitals"),
        F.size(F.filter("_s.l", lambda x: x.rlike(r"[.!?:;][\"')\]]*\s*$"))).cast("long").alias("_ended"),
        F.size(F.array_intersect("_s.w", stops)).cast("long").alias("_stops"),
        F.size(F.filter("_s.w", lambda w: w.rlike(r"[!?#*$%&|<>]{2}|^[^\p{L}\p{N}]+$"))).cast("long").alias("_marked"),
    )


def votes() -> dict[str, Column]:
    """1 for good, 0 for bad, 2 for no opinion, by rule."""
    c = F.col

    def rule(good: Column, bad: Column, applies: Column | None = None) -> Column:
        vote = F.when(bad, 0).when(good, 1).otherwise(2)
        return vote if applies is None else F.when(applies, vote).otherwise(2)

    some, many = c("n_words") > 0, c("n_words") >= 20
    return {
        "length": rule(c("n_words") >= 50, c("n_words") < MIN_WORDS),
        "symbols": rule(50 * c("n_symbols") <= c("word_chars"), 20 * c("n_symbols") > c("word_chars"), some),
        "repeats": rule(20 * c("n_repeat_words") <= c("n_words"), 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"), some),
        "lines": rule(c("n_dup_lines") == 0, 10 * c("n_dup_lines") > 3 * c("_lines"), c("_lines") > 1),
        "capitals": rule(5 * c("_capitals") <= c("_letters"), 5 * c("_capitals") > 2 * c("_letters"), c("_letters") > 0),
        "words": rule(c("word_chars").between(3 * c("n_words"), 9 * c("n_words")), ~c("word_chars").between(2 * c("n_words"), 12 * c("n_words")), some),
        "function_words": rule(c("_stops") >= 3, c("_stops") < 1, many),
        "marks": rule(50 * c("_marked") <= c("n_words"), 5 * c("_marked") > c("n_words"), many),
        "endings": rule(2 * c("_ended") >= c("_lines"), 10 * c("_ended") < c("_lines"), many),
    }


def fit(patterns: Iterable[tuple[str, int]], rules: int) -> tuple[float, list[list[list[float]]]]:
    """Share of good documents and P(vote | class, a vote is given) by rule, class and vote.

    Works on counted patterns. Starts from the majority of the votes, which also
    fixes which class is good. Runs until the log-likelihood per document stands still.
    """
    patterns = [([int(v) for v in p], n) for p, n in patterns]
    total = sum(n for _, n in patterns)
    if not total:
        return 0.5, [[[0.5] * 2, [0.5] * 2] for _ in range(rules)]
    good = [(1 + v.count(1)) / (2 + v.count(1) + 3 * v.count(0)) for v, _ in patterns]
    before = -math.inf
    while True:
        share = (1 + sum(g * n for g, (_, n) in zip(good, patterns))) / (2 + total)
        table = [[[1.0] * 2, [1.0] * 2] for _ in range(rules)]
        for g, (v, n) in zip(good, patterns):
            for r, vote in enumerate(v):
                if vote < 2:
                    table[r][1][vote] += g * n
                    table[r][0][vote] += (1 - g) * n
        table = [[[x / sum(side) for x in side] for side in rule] for rule in table]
        good, likelihood = [], 0.0
        for v, n in patterns:
            a = math.log(share) + sum(math.log(table[r][1][x]) for r, x in enumerate(v) if x < 2)
            b = math.log(1 - share) + sum(math.log(table[r][0][x]) for r, x in enumerate(v) if x < 2)
            top = max(a, b)
            both = top + math.log(math.exp(a - top) + math.exp(b - top))
            good.append(math.exp(a - both))
            likelihood += n * both
        if likelihood - before <= TOLERANCE * total:
            return share, table
        before = likelihood


def posterior(share: float, table: list[list[list[float]]], rules: dict[str, Column]) -> Column:
    """Probability that a document is good."""
    logit = F.lit(math.log(share / (1 - share)))
    for (bad, good), vote in zip(table, rules.values()):
        against, pro = (math.log(g / b) for g, b in zip(good, bad))
        logit = logit + F.when(vote == 0, against).when(vote == 1, pro).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def judged(docs: DataFrame) -> DataFrame:
    """Counts, base verdict, posterior quality and the verdict of every document."""
    measured, rules = written(measures(docs), "measures"), votes()
    pattern = F.concat(*[v.cast("string") for v in rules.values()])
    counted = measured.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    share, table = fit([(r["pattern"], r["n"]) for r in counted.orderBy("pattern").collect()], len(rules))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = measured.select("*", failed.alias("base_failed"), posterior(share, table, rules).alias("quality"))
    kept = ~F.col("base_failed") & (F.col("quality") >= ACCEPT)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality"]
    return scored.select(*names, kept.alias("kept"))
