from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from heliovane.llm import conversations as conv
from heliovane.llm.conversations import Repair, damaged, repaired_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(turns) -> list:
    seen, found = set(), []
    for role, text in turns:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        if not visible:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def all_edits(turns) -> tuple:
    """Every way to edit a few turns: the cheapest cost, the ASCII-least edits, the lines left. No search, no states."""
    kinds = faults(turns)
    per_turn = []
    for (role, text), fault in zip(turns, kinds, strict=True):
        ways = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            ways.append((extra, "K", [(role, text)]))
            ways += [(3 + extra, "R", [(new, text)]) for new in ("user", "assistant")]
        per_turn.append(ways)
    inserts = [(3 * n, "I" * n, [(r, "") for r in roles]) for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    slots = [inserts]
    for ways in per_turn:
        slots += [ways, inserts]
    for choice in itertools.product(*slots):
        lines = [line for _, _, part in choice for line in part]
        if not re.fullmatch(r"(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in lines)):
            continue
        way = (sum(c for c, _, _ in choice), "".join(e for _, e, _ in choice), [f"{r}:{t}" for r, t in lines])
        best = way if best is None or way[:2] < best[:2] else best
    return best


def plain_search(turns) -> tuple:
    """The same for longer conversations: the states' best edits as whole strings, without a tree."""
    best = {"": (0, "", [])}

    def offered(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def with_inserts(states):
        for role, before in (("u", ("", "s", "a")), ("a", ("u",))):
            for state in before:
                if state in states:
                    c, e, lines = states[state]
                    offered(states, role, (c + 3, e + "I", lines + [{"u": "user:", "a": "assistant:"}[role]]))
        return states

    best = with_inserts(best)
    after = {"": "us", "s": "u", "u": "a", "a": "u"}
    for (role, text), fault in zip(turns, faults(turns), strict=True):
        new = {}
        for state, (c, e, lines) in best.items():
            offered(new, state, (c + 4, e + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            for to in after[state]:
                if role[:1] == to:
                    offered(new, to, (c + extra, e + "K", [*lines, f"{role}:{text}"]))
                elif to != "s":
                    name = {"u": "user", "a": "assistant"}[to]
                    offered(new, to, (c + extra + 3, e + "R", [*lines, f"{name}:{text}"]))
        best = with_inserts(new)
    return min((best[s] for s in ("", "a") if s in best), key=lambda way: way[:2])


def searched(turns) -> tuple:
    repair = Repair()
    for (role, text), fault in zip(turns, faults(turns), strict=True):
        repair.turn(role[:1], role, text, fault in ("blank", "duplicate"), fault == "truncated")
    return repair.ended()


def digest(lines) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_search_equals_all_edits_of_short_conversations():
    rng = random.Random(1)
    choices = list(itertools.product(("user", "assistant", "system", "tool", ""), ("", "Yes.", "no")))
    for n in range(150):
        turns = [(r, t and f"{t[:-1]}{k}{t[-1]}") for k, (r, t) in enumerate(rng.choices(choices, k=n % 4))]
        cost, audit, lines = all_edits(turns)
        assert searched(turns) == (cost, audit, digest(lines)), turns


def test_search_equals_plain_search():
    rng = random.Random(2)
    for n in range(300):
        roles = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["system"], ["user"], ["assistant", "tool"]])
        turns = [(rng.choice(roles), rng.choice(["", "same.", f"turn {k}.", f"turn {k}"])) for k in range(n % 40)]
        cost, audit, lines = plain_search(turns)
        assert searched(turns) == (cost, audit, digest(lines)), turns


@pytest.mark.parametrize("pattern", [["user", "assistant"], ["user"], ["assistant"], ["user", "user", "assistant"], ["system", "user"]])
def test_what_is_held_stays_small(pattern):
    repair, most = Repair(), 0
    for k in range(5_000):
        role = pattern[k % len(pattern)]
        repair.turn(role[:1], role, f"turn {k}.", False, k % 7 == 0)
        most = max(most, repair.held)
    assert most <= 20
    assert len(repair.ended()[1]) >= 5_000


def test_deleted_runs_are_only_kept_as_long_as_they_are_open():
    repair = Repair()
    repair.turn("s", "system", "Be kind.", False, False)
    for _ in range(1_000):
        repair.turn("u", "user", "", True, False)
    repair.turn("u", "user", "Hello.", False, False)
    repair.turn("a", "assistant", "Hello.", False, False)
    assert repair.held <= 4
    assert repair.ended()[:2] == (4_000, "K" + "D" * 1_000 + "KK")


def rows_of(table) -> dict:
    return {r.conv_id: r for r in table.collect()}


def plain_damage(rows) -> list:
    found = []
    for c, t, role, text in rows:
        shown = [" " if v is None else str(v) for v in (c, t)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return found


def check(spark, rows) -> None:
    table = spark.createDataFrame(rows, SCHEMA)
    result = rows_of(repaired_conversations(damaged(table), table))
    hurt = plain_damage(rows)
    assert set(result) == {r[0] for r in rows}
    for conv_id, r in result.items():
        mine = sorted((t for t in hurt if t[0] == conv_id), key=lambda t: (t[1] is not None, t[1] or 0, t[2].encode(), t[3].encode()))
        turns = [t[2:] for t in mine]
        cost, audit, lines = plain_search(turns)
        found = faults(turns)
        numbers = {t[1] for t in mine if t[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [role[:1] for role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
        assert tuple(r)[1:] == (gaps, *counts, illegal, cost, audit, digest(lines)), (conv_id, turns)


def test_damaged_conversations_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for conv_id in range(120):
        for turn in range(rng.randrange(1, 12)):
            text = rng.choice([f"Turn {turn}. ", f"open {turn}\t", "again!", "é?\n", "  "])
            rows.append((conv_id, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "system"]), text))
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "Null first."), (1, 0, "assistant", "b."),
        (1, None, None, "x."), (2, 5, "", "no role."), (2, 5, "", "no role."), (3, -7, "User", "y!"), (3, 9, "assistant", "z\x00?"),
        (4, 2**62, "user", "é" * 100_000 + "."), (4, 2**62 + 1, "assistant", " . "), (5, 1, "user", "\x0b\x0c\r\n\t "),
    ]
    check(spark, rows)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in ("fault", "place", "same", "present", "n", "a.b")})
    assert repaired_conversations(damaged(table), table).count() == 6


def test_a_conversation_that_loses_all_turns_is_reported(spark):
    gone = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert [tuple(r) for r in repaired_conversations(damaged(table), table).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert repaired_conversations(damaged(table)).collect() == []


def test_no_rows(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert repaired_conversations(damaged(table), table).collect() == []


def test_one_conversation_with_most_rows(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    rng = random.Random(4)
    rows = [(7, k, rng.choice(["user", "assistant"]), rng.choice([f"turn {k}.", f"turn {k}", "same."])) for k in range(3_000)]
    check(spark, rows + [(c, 0, "user", "Hi.") for c in range(8, 40)])


def test_many_result_batches(spark, monkeypatch):
    monkeypatch.setattr(conv, "BATCH", 3)
    check(spark, [(c, 0, "user", "Hi.") for c in range(50)])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not present")
def test_table_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(spark, [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
