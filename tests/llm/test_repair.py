"""Conversation repair against plain search and a plain recomputation of the whole query."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from tallyleaf.llm import repair
from tallyleaf.llm.registry import QUERIES
from tallyleaf.llm.tables import read

SCHEMA = "conv_id long, turn long, role string, text string, at string, copies int, audit string"
PATTERN = re.compile("(s?(ua)+)?")


def plain_edits(turns):
    """(cost, audit, repaired turns): the least by a search over (cost, audit), one turn after the other."""
    seen, faults = set(), []
    for role, text in turns:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        if not shown:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    # What has been written so far matters only by its last role, or that there is none.
    heap, done, counter = [(0, "", 0, "", ())], set(), itertools.count()
    while heap:
        cost, audit, at, written, out = heapq.heappop(heap)
        if (at, written) in done:
            continue
        done.add((at, written))
        if at == len(turns) and written in ("", "a"):
            return cost, audit, list(out), faults
        wanted = "assistant" if written == "u" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", at, wanted[0], (*out, (wanted, ""))))
        if at < len(turns):
            (role, text), fault = turns[at], faults[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, written, out))
            if fault in ("", "truncated"):
                extra = 3 if fault else 0
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, wanted[0], (*out, (wanted, text))))
                if role[:1] == wanted[0] or (role[:1] == "s" and not written):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[0], (*out, (role, text))))
    raise AssertionError


def plain_row(rows):
    """rows: (turn, role, text) of one conversation after damage."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit, out, faults = plain_edits([(r, x) for _, r, x in rows])
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        hit = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv_id, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def check(spark, rows, got):
    by_id = {r[0]: [] for r in rows}
    for conv_id, *turn in plain_damage(rows):
        by_id[conv_id].append(turn)
    found = {r.conv_id: tuple(r)[1:] for r in got.collect()}
    assert set(found) == set(by_id)
    names = got.columns[1:]
    assert names == ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    for conv_id, turns in by_id.items():
        assert found[conv_id] == plain_row(turns), (conv_id, turns)


def test_powers_are_products():
    for symbol in range(9):
        one, found = repair.power(symbol, 0), repair.power(symbol, 0)
        for count in range(2, 20):
            found = repair.times(one, found)
            assert repair.segment_matrix([(symbol, count)]) == found
    # Inserted turns take two steps to reach every state there is to reach.
    assert repair.times(repair.inserts(), repair.inserts()) == repair.inserts()


def test_runs_against_search():
    rng = random.Random(3)
    for _ in range(600):
        turns = []
        for _ in range(rng.randrange(9)):
            turns += [(rng.choice("suuaax"), rng.choice(["One.", "Two!", "three", " ", "Four?", "5"]) + rng.choice(["", "a.", "b."]))]
        cost, audit, out, faults = plain_edits([(r, x + "" if x.strip() else x) for r, x in turns])
        symbols = [
            (0 if f in ("blank", "duplicate") else 1 + ("sua".find(r) if r in "sua" else 3) + (4 if f else 0), 1)
            for (r, _), f in zip(turns, faults)
        ]
        runs = repair.runs_of(symbols)
        assert repair.before(repair.segment_matrix(runs), repair.final())[0] == cost
        edits, state = repair.unroll(runs, 0, repair.final(), True)
        assert "".join(letters * max(n, 1) for letters, n in edits) == audit
        assert state in repair.ENDS


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_random_conversations(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    rng, rows = random.Random(bits), []
    for conv_id in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 12, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(["Yes.", "No!", "open end", "", " \n", None, "Ünï. ", "twice said.", "x.\n", "a:b\nc?", "\x85"])
            rows.append((conv_id, rng.choice([turn, turn, turn, None, turn + 2]), role, text))
    rows += rows[:7] + [(99, None, "user", "same.")] * 50
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    check(spark, rows, repair.digests(frame, repair.repair(repair.damaged(frame))))


def test_long_run_of_copies(spark):
    rows = [(1, 5, "user", "Hi.")] * 3000 + [(1, 6, "assistant", "Ho.")]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = repair.repair(frame)
    (row,) = found.conversations.collect()
    assert (row.duplicate, row.cost, row.audit) == (2999, 4 * 2999, "K" + "D" * 2999 + "K")
    assert [(t.turn, t.role, t.text, t.edit) for t in found.turns.orderBy("at", "part").collect()] == [
        (5, "user", "Hi.", "K"), (6, "assistant", "Ho.", "K"),
    ]


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert repair.digests(frame, repair.repair(repair.damaged(frame))).count() == 0
    # Every turn of this conversation is dropped.
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.", "x", 1, "y")], SCHEMA)
    check(spark, [(gone, 0, "user", "Hi.")], repair.digests(frame, repair.repair(repair.damaged(frame))))


def test_whole_table(spark, folder):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in read(spark, folder, "conversations").collect()]
    check(spark, rows, QUERIES["op12_structure_repair"](spark, folder))
    roles = {}
    for t in repair.repair(read(spark, folder, "conversations")).turns.orderBy("at", "part").collect():
        roles[t.conv_id] = roles.get(t.conv_id, "") + t.role[0]
    assert all(PATTERN.fullmatch(r) for r in roles.values())
