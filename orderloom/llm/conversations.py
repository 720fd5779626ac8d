"""Conversation structure repair by weighted CYK interval parsing.

A repaired conversation is empty, or an optional system turn and then one or
more pairs of a user and an assistant turn. The grammar's nonterminals <p,q>
are edits that lead from one place of that pattern to another, its binary rules
<p,q> -> <p,r> <r,q>. A turn derives <p,q> by being kept, given another role or
deleted; a turn may be inserted anywhere, which the closure of all cells under
insertion covers. A cell holds the cheapest (cost, audit) of its nonterminal
over its interval, audit being the initials of the edits (Keep, Rerole, Delete,
Insert); equal costs go to the least audit. Neither of two audits of equal cost
over the same turns begins with the other, so least parts make least wholes.

Runs of up to `LEAF` turns get a whole chart, bottom-up by span length over all
splits. Any split gives the same cells, so longer intervals are joined from two
halves, still by length. Turns are dealt to tasks by ranges of (conversation,
turn, role, text digest), so one long conversation is parsed by many tasks, each
of which gives one interval; the intervals of a conversation, at most one a
task, are joined last. Equal turns are counted before they are dealt. Writing out
the repaired turns is a stream in order, with one turn in memory at a time.

Turns come by `turn`, nulls first, ties by role and digest of the text; null roles
and texts count as one space, a null conv_id is a conversation of its own.
Repeated rows are duplicate turns. An empty table gives an empty result.
"""

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import written

BLANKS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# Costs of edits, and of leaving a truncated turn as it is.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# Turns of one whole chart, and charts remembered by a task.
LEAF = 8
REMEMBERED = 1 << 13

# Places of the pattern: nothing yet, after system, after user, after assistant (a full pair).
START, SYSTEM, USER, PAIR = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# Cheapest (cost, audit) by the places an interval leads from and to.
Cells = dict[int, dict[int, tuple[int, str]]]
PLACES = (START, SYSTEM, USER, PAIR)


def join(left: Cells, right: Cells, into: Cells) -> Cells:
    """Add to `into` the cells of two adjacent intervals by all binary rules."""
    for p, row in left.items():
        best = into.setdefault(p, {})
        for r, (c1, a1) in row.items():
            for q, (c2, a2) in right[r].items():
                cost = c1 + c2
                if q not in best or cost < best[q][0] or cost == best[q][0] and a1 + a2 < best[q][1]:
                    best[q] = cost, a1 + a2
    return into


def _insertions() -> Cells:
    """Cells of an empty interval: nothing, or any number of inserted turns."""
    once: Cells = {p: {p: (0, "")} | {STEP[p, i]: (INSERT, "I") for i in ROLES if (p, i) in STEP} for p in PLACES}
    cells = once
    while (more := join(cells, once, {})) != cells:
        cells = more
    return cells


EMPTY = _insertions()


def turn_cells(token: str) -> Cells:
    """Cells of one turn: `D` must go, else its role's initial (`o` for others), in upper case if truncated."""
    cells: Cells = {p: {p: (DELETE, "D")} for p in PLACES}
    extra = TRUNCATED if token.isupper() else 0
    edits = [(i, REROLE + extra, "R") for i in ROLES] + [(token.lower(), extra, "K")]
    for p in PLACES if token != "D" else ():
        for initial, cost, edit in edits:
            if (p, initial) in STEP:
                row, q = cells[p], STEP[p, initial]
                row[q] = min(row.get(q, (cost, edit)), (cost, edit))
    return join(join(EMPTY, cells, {}), EMPTY, {})


def chart(tokens: str) -> Cells:
    """Cells of a run of turns by the whole chart, bottom-up by span length."""
    n = len(tokens)
    if not n:
        return EMPTY
    spans = {(i, i + 1): turn_cells(t) for i, t in enumerate(tokens)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cells: Cells = {}
            for k in range(i + 1, i + length):
                join(spans[i, k], spans[k, i + length], cells)
            spans[i, i + length] = cells
    return spans[0, n]


class Intervals:
    """Adjacent intervals joined in order, always two of the same number of parts, so that few long ones are copied."""

    def __init__(self):
        self.stack: list[tuple[int, Cells]] = []

    def add(self, cells: Cells) -> None:
        parts = 1
        while self.stack and self.stack[-1][0] == parts:
            cells, parts = join(self.stack.pop()[1], cells, {}), 2 * parts
        self.stack.append((parts, cells))

    def whole(self) -> Cells:
        cells = EMPTY
        for _, left in reversed(self.stack):
            cells = join(left, cells, {})
        return cells


class Run:
    """Adjacent turns of one conversation: counts of faults, both ends, and cells."""

    def __init__(self):
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.low = self.high = self.first = self.last = self.last_turn = self.first_turn = None
        self.intervals, self.tokens = Intervals(), ""

    def _after(self, initial: str) -> None:
        if self.last is not None and self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        if self.first is None:
            self.first = initial
        self.last = initial

    def _at(self, turn: int | None) -> None:
        if turn is not None and turn != self.last_turn:
            self.counts["turns"] += 1
            if self.first_turn is None:
                self.first_turn = turn
        if turn is not None:
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
            self.last_turn = turn

    def add_turn(self, turn: int | None, initial: str, blank: bool, new: bool, truncated: bool, copies: int, remembered: dict) -> None:
        self._at(turn)
        self._after(initial)
        kind = initial if initial in ("s", "u", "a") else "o"
        fault = "blank" if blank else "duplicate" if not new else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        self.counts["blank" if blank else "duplicate"] += copies - 1
        self.counts["illegal"] += copies - 1
        tokens = self.tokens + ("D" if blank or not new else kind.upper() if truncated else kind) + "D" * (copies - 1)
        whole = len(tokens) - len(tokens) % LEAF
        for at in range(0, whole, LEAF):
            self._leaf(tokens[at : at + LEAF], remembered)
        self.tokens = tokens[whole:]

    def _leaf(self, tokens: str, remembered: dict) -> None:
        if tokens not in remembered:
            if len(remembered) >= REMEMBERED:
                remembered.clear()
            remembered[tokens] = chart(tokens)
        self.intervals.add(remembered[tokens])

    def packed(self, remembered: dict) -> str:
        if self.tokens:
            self._leaf(self.tokens, remembered)
            self.tokens = ""
        ends = [self.first, self.last, self.first_turn, self.last_turn, self.low, self.high]
        return json.dumps([self.counts, ends, [[p, q, *found] for p, row in self.intervals.whole().items() for q, found in row.items()]])

    def add_packed(self, text: str) -> None:
        """Join the run that follows this one."""
        counts, (first, last, first_turn, last_turn, low, high), cells = json.loads(text)
        if first_turn is not None and first_turn == self.last_turn:
            counts["turns"] -= 1
        for name, n in counts.items():
            self.counts[name] += n
        if first is not None:
            self._after(first)
            self.last = last
        if first_turn is not None:
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn
            self.low = low if self.low is None else min(self.low, low)
            self.high = high if self.high is None else max(self.high, high)
        found: Cells = {p: {} for p in PLACES}
        for p, q, cost, audit in cells:
            found[p][q] = cost, audit
        self.intervals.add(found)

    def verdict(self) -> dict:
        ends = self.intervals.whole()[START]
        cost, audit = min(ends[START], ends[PAIR])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts["turns"]
        return {"gaps": gaps, **{k: self.counts[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


def _found(rows: list[tuple], names: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), names.values())], names=list(names))


# Results sent on at a time.
SENT = 2000
_PIECE = {"conv": pa.string(), "part": pa.int32(), "packed": pa.string()}
_VERDICT = {"conv": pa.string()} | dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), pa.int64()) | {"audit": pa.string()}
_LINE = {"conv": pa.string(), "position": pa.int64(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}
_DIGEST = {"conv": pa.string(), "digest": pa.string()}


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run for each conversation of a task's sorted turns."""
    part, remembered = TaskContext.get().partitionId(), {}
    run, of, rows = None, None, []
    for conv, *turn in _runs(batches, "conv", "turn", "initial", "blank", "new", "truncated", "copies"):
        if run is None or conv != of:
            if run is not None:
                rows.append((of, part, run.packed(remembered)))
            run, of = Run(), conv
            if len(rows) >= SENT:
                yield _found(rows, _PIECE)
                rows = []
        run.add_turn(*turn, remembered)
    if run is not None:
        rows.append((of, part, run.packed(remembered)))
        yield _found(rows, _PIECE)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The verdict of each conversation from its runs in order."""
    run, of, rows = None, None, []
    for conv, packed in _runs(batches, "conv", "packed"):
        if run is None or conv != of:
            if run is not None:
                rows.append((of, *run.verdict().values()))
            run, of = Run(), conv
            if len(rows) >= SENT:
                yield _found(rows, _VERDICT)
                rows = []
        run.add_packed(packed)
    if run is not None:
        rows.append((of, *run.verdict().values()))
        yield _found(rows, _VERDICT)


def _schema(names: dict[str, pa.DataType]) -> str:
    kinds = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long"}
    return ", ".join(f"{name} {kinds[kind]}" for name, kind in names.items())


def _keyed(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest): the conversation as text, null roles and texts as a space."""
    filled = turns.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    return filled.withColumn("digest", F.unhex(F.md5("text")))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(right[f"_{k}"])
    return match


def diagnosed(turns: DataFrame) -> DataFrame:
    """Per conversation of `turns` (conv_id, turn, role, text): counts of faults, and cost and audit of its repair.

    Columns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. No text is shuffled.
    """
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    marks = _keyed(turns).select("conv", "turn", "role", "digest", (~F.col("text").rlike(f"[^{BLANKS}]")).alias("blank"), (~last.isin(list(ENDS))).alias("truncated"))
    marks = marks.groupBy("conv", "turn", "role", "digest").agg(
        F.max("blank").alias("blank"), F.max("truncated").alias("truncated"), F.count(F.lit(1)).alias("copies")
    )
    seen = marks.groupBy("conv", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("at_null"), F.min("turn").alias("least"))
    first = seen.select(F.col("conv").alias("_conv"), F.when(~F.col("at_null"), F.col("least")).alias("_turn"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), F.lit(True).alias("new"))
    marked = marks.join(first, _same(marks, first, ["conv", "turn", "role", "digest"]), "left")
    lines = marked.select("conv", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", F.coalesce("new", F.lit(False)).alias("new"), "truncated", "copies")
    order = ["conv", "turn", "role", "digest"]
    runs = lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_parse, _schema(_PIECE))
    found = runs.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(_combine, _schema(_VERDICT))
    kind = turns.schema["conv_id"].dataType
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *[c for c in _VERDICT if c != "conv"])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted rows; the audit of a conversation comes before its turns."""
    conv = place = at = position = 0
    audit, rows = None, []

    def put(edit: str, role: str, text: str) -> None:
        nonlocal place, position
        place = STEP[place, role[0]]
        rows.append((conv, position, role, text, edit))
        position += 1

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put("I", ROLES["a" if place == USER else "u"], "")
            at += 1

    for batch in batches:
        for here, own, role, text in _runs([batch], "conv", "audit", "role", "text"):
            if own is not None:
                if audit is not None:
                    inserted()
                conv, audit, place, at, position = here, own, START, 0, 0
                continue
            inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                put(edit, role, text)
            elif edit == "R":
                put(edit, ROLES["a" if place == USER else "u"], text)
        if rows:
            yield _found(rows, _LINE)
            rows = []
    if audit is not None:
        inserted()
        if rows:
            yield _found(rows, _LINE)


def _repaired(turns: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Repaired turns (conv, position, role, text, edit); those of a conversation follow each other in order in one task."""
    none = F.lit(None).cast("string")
    audits = diagnoses.select(F.col("conv_id").cast("string").alias("conv"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"), F.lit(None).cast("binary").alias("digest"), none.alias("text"), "audit")
    lines = _keyed(turns).select("conv", F.lit(1).alias("_kind"), "turn", "role", "digest", "text", none.alias("audit"))
    ordered = audits.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "_kind", "turn", "role", "digest")
    return ordered.select("conv", "audit", "role", "text").mapInArrow(_rewrite, _schema(_LINE))


def repaired(turns: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, position, role, text, edit) of all conversations, by the audits of `diagnosed(turns)`."""
    kind = turns.schema["conv_id"].dataType
    return _repaired(turns, diagnoses).select(F.col("conv").cast(kind).alias("conv_id"), "position", "role", "text", "edit")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha, of, rows = None, None, []
    for conv, position, role, text in _runs(batches, "conv", "position", "role", "text"):
        if position == 0:
            if sha is not None:
                rows.append((of, sha.hexdigest()))
            sha, of = hashlib.sha256(), conv
            if len(rows) >= SENT:
                yield _found(rows, _DIGEST)
                rows = []
        sha.update(f"{'' if position == 0 else chr(10)}{role}:{text}".encode())
    if sha is not None:
        rows.append((of, sha.hexdigest()))
        yield _found(rows, _DIGEST)


def digests(turns: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired `role:text` lines; conversations repaired to nothing have no row.

    A conversation is hashed by one task, as the digest of a stream must be, but never held there.
    """
    found = _repaired(turns, diagnoses).mapInArrow(_digest, _schema(_DIGEST))
    return found.select(F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id"), "digest")


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns (conv_id, turn, role, text) with faults planted by the CRC of conversation and turn, nulls as one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    turns = conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1))).alias("_copy"),
        fate.alias("_fate"),
    )
    return turns.filter("_fate <> 0").drop("_copy", "_fate")


def structure_repair(conversations: DataFrame) -> DataFrame:
    """Every conv_id of `conversations` with the faults of its damaged turns and their repair."""
    turns = damaged(conversations)
    found = written(diagnosed(turns), "diagnoses")
    sums = digests(turns, found)
    every = conversations.select(F.col("conv_id").alias("_conv_id")).distinct()
    joined = every.join(found, F.col("_conv_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    joined = joined.join(sums, F.col("_conv_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("_conv_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
