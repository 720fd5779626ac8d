"""Conversation repair against a shortest path over (turn, place)."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import conversations
from orderloom.llm.common import table
from orderloom.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {"u": "user", "a": "assistant"}


def _cheapest(initials, faults):
    """Least (cost, audit) by Dijkstra's search."""
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, p = heapq.heappop(heap)
        if i == len(initials) and p in (0, 3):
            return cost, audit
        if (i, p) in done:
            continue
        done.add((i, p))
        for z in NEXT:
            if (p, z) in STEP:
                heapq.heappush(heap, (cost + 5, audit + "I", i, STEP[p, z]))
        if i < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, p))
            if faults[i] in ("", "truncated"):
                extra = 5 * (faults[i] == "truncated")
                for z in NEXT:
                    if (p, z) in STEP:
                        heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, STEP[p, z]))
                if (p, initials[i]) in STEP:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, STEP[p, initials[i]]))


def _faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _written_out(turns, audit):
    place, lines, rest = 0, [], iter(turns)
    for edit in audit:
        following = "assistant" if place == 2 else "user"
        role, text = (following, "") if edit == "I" else next(rest)[1:]
        if edit == "D":
            continue
        role = role if edit == "K" else following
        lines.append(f"{role}:{text}")
        place = STEP[place, role[0]]
    return lines


def _brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        turns = by_conv[conv]
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        turns += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = {}
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).digest()))
        numbers, faults, initials = [t for t, _, _ in turns if t is not None], _faults(turns), [r[:1] for _, r, _ in turns]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = _cheapest(initials, faults)
        digest = hashlib.sha256("\n".join(_written_out(turns, audit)).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def _found(frame):
    rows = frame.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("length", range(6))
def test_chart_gives_the_least_cost_and_audit(length):
    chance = random.Random(length)
    for _ in range(60):
        tokens = "".join(chance.choice("suaoSUAOD") for _ in range(length))
        faults = ["blank" if t == "D" else "truncated" if t.isupper() else "" for t in tokens]
        ends = conversations.chart(tokens)[conversations.START]
        assert min(ends[conversations.START], ends[conversations.PAIR]) == _cheapest(tokens.lower(), faults)


def test_any_split_gives_the_cells_of_the_whole_chart():
    chance = random.Random(3)
    for _ in range(20):
        tokens = "".join(chance.choice("suaoSUAOD") for _ in range(9))
        whole, intervals = conversations.chart(tokens), conversations.Intervals()
        cut = chance.randrange(10)
        assert conversations.join(conversations.chart(tokens[:cut]), conversations.chart(tokens[cut:]), {}) == whole
        for t in tokens:
            intervals.add(conversations.turn_cells(t))
        assert intervals.whole() == whole


def test_query_equals_brute_force(spark):
    rows = table(spark, SF, "conversations")
    assert _found(llm_queries()["op11_conversation_repair"](spark, SF)) == _brute([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def test_odd_and_long_conversations(spark):
    """Nulls, ties, repeated rows, unknown and empty roles, a conversation over many tasks and one of copies, clashing names."""
    chance = random.Random(5)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "a."), (1, None, "user", "a."), (2, 1, "", ""), (3, 1, "tool", "x."), (4, 5, "system", "only.")]
    for conv in range(100, 180):
        for _ in range(chance.randrange(1, 14)):
            rows.append((conv, chance.choice([None, 1, 2, 3, 5, 8]), chance.choice(["user", "assistant", "system", "tool", None]), chance.choice(["yes.", "no", "ok!", " ", "", "what? ", None])))
    rows += [(999, t, chance.choice(["user", "assistant"]), chance.choice(["a.", "c?", f"d {t}.", f"e {t}"])) for t in range(1500)]
    rows += [(1000, 7, "user", "the same."), *[(1000, 8, "assistant", "again " * 5000)] * 40]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = frame.select("*", *[F.lit(1).alias(c) for c in ("conv", "digest", "copies", "_conv_id", "position", "audit", "_copy")])
    assert _found(conversations.structure_repair(clashing)) == _brute(rows)


def test_empty_table(spark):
    empty = table(spark, SF, "conversations").limit(0)
    assert conversations.structure_repair(empty).count() == 0
    assert conversations.diagnosed(empty).count() == 0


def test_repaired_turns_alternate(spark):
    turns = table(spark, SF, "conversations")
    found = conversations.diagnosed(turns).cache()
    lines = defaultdict(dict)
    for r in conversations.repaired(turns, found).collect():
        lines[r.conv_id][r.position] = r.role
    for conv in lines.values():
        initials = "".join(conv[k][0] for k in range(len(conv)))
        assert re.fullmatch("(s?(ua)+)?", initials)
    assert {r.audit.replace("D", "") == "" for r in found.collect() if r.conv_id not in lines} <= {True}
