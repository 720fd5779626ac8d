"""Personal data by weak supervision, with DataFrame functions only.

Base spans are those of fixed patterns with their checks. Further candidates
(local phone numbers, social security numbers, bank accounts, credentials) and
the base spans are judged by labelers: the strict format, gazetteers, cue words
before a span, signs against it, the shape of its digits, and its borders. Each
votes for, against, or abstains. Counts of vote and feature patterns over all
documents, a few thousand at most, reach the driver. Expectation-maximisation
over them estimates how reliable each labeler is; its posteriors train a
logistic classifier over the features, which decides about the candidates. Base
spans always stay, and a candidate that overlaps one is not added.

Null text counts as empty, without spans. Offsets are code points, ends are
exclusive. Every row is scanned, whatever its id, repeated rows alike. Patterns
are possessive where nothing could be given back, so a long run of letters or
digits costs one pass and no recursion.
"""

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import let, written

BASE = ["email", "ip", "card", "phone"]
ADDED = ["local_phone", "ssn", "iban", "secret"]
KINDS = BASE + ADDED
CONTEXT = 40
ACCEPT = 0.5
TOLERANCE = 1e-9

# Names of credentials in any case, and the forms of key blocks, signed tokens and issued tokens.
_SECRET_NAME = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)"
_KEY_BLOCK = r"-----BEGIN[A-Z\x20]{0,30}PRIVATE\x20KEY-----[A-Za-z0-9+/=\s]*+(?:-----END[A-Z\x20]{0,30}PRIVATE\x20KEY-----)?"
_SIGNED = r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+"
_ISSUED = r"(?:gh[opsur]_|xox[abprs]-)[A-Za-z0-9-]{16,}+"

_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9+.)-])(?<!\+[0-9]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": rf"(?<![A-Za-z0-9])(?:{_SECRET_NAME}[\"']?[\x20]?[=:][\x20]?[\"']?[^\s\"',;]{{6,}}+|AKIA[0-9A-Z]{{16}}(?![A-Za-z0-9])|[0-9a-f]{{32,}}+(?![A-Za-z0-9])|{_KEY_BLOCK}|{_SIGNED}|{_ISSUED})",
}
_STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9][A-Za-z0-9-]*\.)+[A-Za-z]{2,24}$",
    "ip": r"^[1-9][0-9]{0,2}(\.[0-9]{1,3}){3}$",
    "card": r"^[0-9]{14,19}$|^[0-9]{4}([\x20-][0-9]{2,6}){2,4}$",
    "phone": r"^\+[1-9][0-9]{0,2}[\x20.(-]",
    "local_phone": r"^(\([2-9][0-9]{2}\)\x20|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9\x20]{11,38}$",
    "secret": r"^AKIA|^[0-9a-f]{40}$|^-----BEGIN|^eyJ|^gh[opsur]_|^xox[abprs]-|[=:]\x20?(?=.*[0-9])(?=.*[A-Za-z])",
}
# Gazetteers of endings and prefixes that real items of a kind have.
_LISTED = {
    "email": r"\.(com|org|net|edu|gov|io|info|de|fr|es|it|nl|uk|eu|ch|at|be|us|ca|co)$",
    "ip": r"^(?!0\.|127\.|255\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[4678]|6)",
    "phone": r"^\+(1|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "local_phone": r"^\(?[2-9][0-8][0-9]",
    "ssn": r"^[0-8]",
    "iban": r"^(AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|IE|IT|LU|NL|NO|PL|PT|SE)",
    "secret": rf"^({_SECRET_NAME}|AKIA|-----BEGIN|eyJ|gh[opsur]_|xox)|^[0-9a-f]{{32}}$|^[0-9a-f]{{40}}$|^[0-9a-f]{{64}}$",
}
_CUES = {
    "email": r"mail|contact|write to|courriel|correo|kontakt",
    "ip": r"\bip\b|address|server|host|adresse",
    "card": r"card|visa|master|karte|carte|tarjeta|payment",
    "phone": r"phone|tel|call|mobile|fax|handy|móvil",
    "local_phone": r"phone|tel|call|mobile|fax",
    "ssn": r"ssn|social|security",
    "iban": r"iban|account|konto|compte|cuenta|bank",
    "secret": r"key|token|secret|pass|credential|hash|[\"'=:]\s*$",
}
_AGAINST = r"(version|isbn|issn|doi|page|pp|§|\bv|\bno|\bnr)[\s.:]*$"


def _running_sums(values: Column, block: int = 256) -> Column:
    """Inclusive sums, in blocks so that a text with many spans stays near linear."""

    def plain(v: Column) -> Column:
        none = F.array().cast("array<bigint>")
        start = F.struct(F.lit(0).cast("bigint").alias("sum"), none.alias("all"))
        step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all"))
        return F.aggregate(v, start, step, lambda s: s["all"])

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int"))
        return F.transform(starts, lambda b: plain(F.slice(v, b * block + 1, block)))

    def joined(sums: Column) -> Column:
        ends = plain(F.transform(sums, lambda s: F.element_at(s, -1)))
        return let(ends, lambda e: F.flatten(F.transform(sums, lambda s, b: F.transform(s, lambda x: x + F.coalesce(F.get(e, b - 1), F.lit(0))))))

    empty = F.array().cast("array<bigint>")
    return let(values, lambda v: F.when(F.size(v) == 0, empty).otherwise(let(blocks(v), joined)))


def _matches(text: Column, kind: str) -> Column:
    """Structs (kind, at, end, value) of all matches, leftmost and without overlap."""
    pattern = _PATTERNS[kind]
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))

    def spans(f: Column) -> Column:
        widths = F.transform(f["m"], lambda m, k: (F.char_length(m) + F.char_length(F.get(f["p"], k))).cast("bigint"))
        return let(
            _running_sums(widths),
            lambda ends: F.transform(
                f["m"],
                lambda m, k: F.struct(F.lit(KINDS.index(kind)).alias("kind"), (F.get(ends, k) - F.char_length(m)).alias("at"), F.get(ends, k).alias("end"), m.alias("value")),
            ),
        )

    return let(found, spans)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.char_length(part(p)) < 4) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(10, 15)
    return F.lit(True)


def _judged(text: Column, kind: str, span: Column) -> Column:
    """`span` with one character per labeler: 1 for, 0 against, 2 no opinion."""
    value = span["value"]
    left = F.lower(F.substring(text, F.greatest(F.lit(1), span["at"] - CONTEXT + 1).cast("int"), F.least(F.lit(CONTEXT), span["at"]).cast("int")))
    right = F.substring(text, (span["end"] + 1).cast("int"), F.lit(1))
    digits = F.regexp_replace(value, "[^0-9]", "")
    kinds = F.size(F.array_distinct(F.split(digits, "")))
    either = lambda c: F.when(c, "1").otherwise("0")
    votes = F.concat(
        either(value.rlike(_STRICT[kind])),
        either(value.rlike(_LISTED[kind])),
        F.when(left.rlike(_CUES[kind]), "1").otherwise("2"),
        F.when(left.rlike(_AGAINST), "0").otherwise("2"),
        F.when(digits == "", "2").otherwise(F.when(kinds < 4, "0").otherwise("1")),
        either(~left.rlike(r"[\p{L}\p{N}]$") & ~right.rlike(r"^[\p{L}\p{N}]")),
    )
    return F.struct(span["kind"].alias("kind"), span["at"].alias("at"), span["end"].alias("end"), F.concat(F.lit(str(KINDS.index(kind))), votes).alias("pattern"))


LABELERS = 6


def _spans_of(text: Column, kind: str) -> Column:
    def spans(t: Column) -> Column:
        return F.transform(F.filter(_matches(t, kind), lambda s: _valid(kind, s["value"])), lambda s: _judged(t, kind, s))

    return let(text, spans)


def found_spans(text: Column) -> Column:
    """Array of (kind, at, end, pattern) of base spans and candidates; the pattern starts with the kind."""
    empty = F.array().cast("array<struct<kind:int,at:bigint,end:bigint,pattern:string>>")
    digits = text.rlike("[0-9]")
    # A secret needs no digit: a cue word with its sign, the start of a key or token, or a run of hex digits.
    secret = text.rlike(rf"{_SECRET_NAME}[\"']?[\x20]?[=:]|AKIA|[0-9a-f]{{32}}|PRIVATE\x20KEY-----|eyJ|gh[opsur]_|xox[abprs]-")
    may = {"email": F.contains(text, F.lit("@")), "phone": digits & F.contains(text, F.lit("+")), "secret": secret}
    return F.concat(*[F.when(may.get(kind, digits), _spans_of(text, kind)).otherwise(empty) for kind in KINDS])


def fit_labelers(counts: dict[str, int]) -> dict[str, float]:
    """Posterior of each pattern by expectation-maximisation over the labelers' votes.

    A labeler has one reliability for spans that are personal data and one for
    others, given that it votes. The majority of the votes starts the search.
    """
    rows = [(p, [int(v) for v in p[1:]], n) for p, n in sorted(counts.items())]
    total = sum(n for *_, n in rows)
    good = {p: (1 + v.count(1)) / (2 + v.count(1) + v.count(0)) for p, v, _ in rows}
    before = -math.inf
    while rows:
        share = (1 + sum(good[p] * n for p, _, n in rows)) / (2 + total)
        # Pseudo-votes keep a labeler better than chance where data are scarce.
        rates = [[[2.0, 1.0], [1.0, 2.0]] for _ in range(LABELERS)]
        for p, votes, n in rows:
            for labeler, v in zip(rates, votes):
                if v < 2:
                    labeler[1][v] += good[p] * n
                    labeler[0][v] += (1 - good[p]) * n
        rates = [[[x / sum(side) for x in side] for side in labeler] for labeler in rates]
        likelihood = 0.0
        for p, votes, n in rows:
            a, b = math.log(share), math.log(1 - share)
            for labeler, v in zip(rates, votes):
                if v < 2:
                    a, b = a + math.log(labeler[1][v]), b + math.log(labeler[0][v])
            top = max(a, b)
            both = top + math.log(math.exp(a - top) + math.exp(b - top))
            good[p] = math.exp(a - both)
            likelihood += n * both
        if likelihood - before <= TOLERANCE * total:
            break
        before = likelihood
    return good


def _features(pattern: str) -> list[int]:
    """Positions of the features that are on: kind, and each labeler's vote."""
    return [int(pattern[0]), *[len(KINDS) + 3 * k + int(v) for k, v in enumerate(pattern[1:])]]


def fit_classifier(counts: dict[str, int], posterior: dict[str, float], steps: int = 400, penalty: float = 1e-3) -> list[float]:
    """Weights of a logistic classifier trained on the posteriors; the last one is the bias."""
    weights = [0.0] * (len(KINDS) + 3 * LABELERS + 1)
    total, rows = sum(counts.values()), [(_features(p), posterior[p], n) for p, n in sorted(counts.items())]
    for _ in range(steps if rows else 0):
        slope = [penalty * w for w in weights]
        for on, wanted, n in rows:
            error = (_probability(weights, on) - wanted) * n / total
            for f in (*on, -1):
                slope[f] += error
        weights = [w - g for w, g in zip(weights, slope)]
    return weights


def _probability(weights: list[float], on: list[int]) -> float:
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, weights[-1] + sum(weights[f] for f in on)))))


def accepted_patterns(found: DataFrame) -> list[str]:
    """Patterns of candidates that the classifier takes for personal data; `found` has `spans`."""
    each = found.select(F.explode("spans.pattern").alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["pattern"]: r["n"] for r in each.collect()}
    weights = fit_classifier(counts, fit_labelers(counts))
    added = {str(KINDS.index(k)) for k in ADDED}
    return sorted(p for p in counts if p[0] in added and _probability(weights, _features(p)) >= ACCEPT)


def _chosen(spans: Column, accepted: list[str]) -> Column:
    """Base spans and accepted candidates that overlap none of them, by start and kind."""
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    fits = lambda s: s["pattern"].isin(accepted) if accepted else F.lit(False)
    free = lambda s, b: ~F.exists(b, lambda x: (x["at"] < s["end"]) & (s["at"] < x["end"]))
    added = let(base, lambda b: F.filter(F.filter(spans, lambda s: (s["kind"] >= len(BASE)) & fits(s)), lambda s: free(s, b)))
    order = lambda s: F.struct(s["at"].alias("at"), s["kind"].alias("kind"), s["end"].alias("end"))
    return F.array_sort(F.transform(F.concat(base, added), order))


def chosen_spans(text: Column, accepted: list[str]) -> Column:
    return let(found_spans(text), lambda spans: _chosen(spans, accepted))


def _is_kind(number: int):
    return lambda s: s["kind"] == number


def _told(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = written(docs.select("doc_id", found_spans(text).alias("spans")), "found_spans")
    chosen = found.select("doc_id", F.explode(F.array(_chosen(F.col("spans"), accepted_patterns(found)))).alias("_all"))
    base = F.filter("_all", lambda s: s["kind"] < len(BASE))
    counts = [F.size(F.filter("_all", _is_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    added = (F.size("_all") - F.size(base)).cast("long").alias("n_added")
    return chosen.select("doc_id", *counts, F.sha2(_told(base), 256).alias("base_sha256"), _told(F.col("_all")).alias("spans"), added)


def masked(text: Column, spans: Column) -> Column:
    """`text` with every run of overlapping spans replaced by the name of its first kind in angle brackets."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, (s["end"] + 1).cast("int"), (x["at"] - s["end"]).cast("int"))
        out = F.when(x["at"] >= s["end"], F.concat(s["out"], F.array(gap, F.get(names, x["kind"])))).otherwise(s["out"])
        return F.struct(F.greatest(s["end"], x["end"]).alias("end"), out.alias("out"))

    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, (s["end"] + 1).cast("int"), F.lit(2147483647)))
    return F.aggregate(spans, start, step, rest)


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with all personal data in `text` masked; a text without any stays as it is."""
    own = F.coalesce(F.col("text"), F.lit(""))
    accepted = accepted_patterns(written(docs.select(found_spans(own).alias("spans")), "found_spans"))
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    spans = docs.select(whole.alias("_doc"), F.explode(F.array(chosen_spans(own, accepted))).alias("_all"))
    text = F.when(F.size("_all") > 0, masked(F.col("_doc.text"), F.col("_all"))).otherwise(F.col("_doc.text"))
    return spans.select(F.col("_doc").withField("text", text).alias("_doc")).select("_doc.*")
