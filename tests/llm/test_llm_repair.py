from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from millrace.llm import lightest_repair as lr
from millrace.llm.lightest_repair import START, ConversationRepair, damaged, lightest, repair, repaired, row_edits, span


def by_trying_all(shape):
    """The lightest audit of a few rows: every choice per row, up to two insertions before each and at the end."""
    best = None
    gaps = [("",), *[("", "I", "II")] * (len(shape) + 1)][1:]
    for inserted in product(*gaps):
        for letters in product("DKR", repeat=len(shape)):
            audit = "".join(i + e for i, e in zip(inserted, letters, strict=False)) + inserted[-1]
            written, cost, k, fine = "", 0, 0, True
            for letter in audit:
                due = "a" if written.endswith("u") else "u"
                if letter == "I":
                    written, cost = written + due, cost + 5
                    continue
                row, k = shape[k], k + 1
                if letter == "D":
                    cost += 2
                    continue
                fine = fine and row != "-"
                cost += (letter == "R") + 5 * row.isupper()
                written += due if letter == "R" else row.lower()
            if fine and re.fullmatch("(s?(ua)+)?", written):
                best = min(best or (cost, audit), (cost, audit))
    return best[1]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_agenda_equals_trying_all(n):
    for shape in map("".join, product("sua-xUAS", repeat=n)):
        assert repair(shape) == by_trying_all(shape), shape


def test_blocks_and_spans_equal_one_agenda(monkeypatch):
    rng = random.Random(3)
    shapes = ["".join(rng.choice("suauaua-xUAS") for _ in range(rng.randint(5, 40))) for _ in range(150)]
    whole = [repair(s) for s in shapes]
    ends = [{q: a for q, (_, a) in lightest(s, START, False).items()} for s in shapes]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(lr, "BLOCK", size)
        assert [repair(s) for s in shapes] == whole
        assert [{q: a for q, (_, a) in span(s, START).items()} for s in shapes] == ends


def test_row_edits():
    assert row_edits("") == [""] and row_edits("KIIDII") == ["K", "IID", "II"]


def brute(rows):
    """The contract in plain Python, repairs by one agenda over the whole conversation."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen, shape = [], set(), ""
        for _, role, text in mine:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] in "sua" and role else "x"
            faults.append(fault)
            shape += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        (cost, audit), = lightest(shape, START, True).values()
        lines, state, k = [], "", 0
        for letter in audit:
            due = "assistant" if state == "u" else "user"
            role, text = (due, "") if letter == "I" else (due if letter == "R" else mine[k][1], mine[k][2])
            k += letter != "I"
            if letter != "D":
                lines.append(f"{role}:{text}")
                state = role[0]
        turns = [t for t, _, _ in mine if t is not None]
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def edge_rows():
    rng = random.Random(5)
    texts = ["Yes.", "no", "", None, "  \n", "Why?!", "a b. ", "漢字。", "x" * 5000 + ".", "\x85"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(c, t, rng.choice(roles[:3] * 4 + roles), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, k, ("user", "assistant")[k % 2], f"word {k}.") for k in range(150)]
    rows += [(101, k % 7, "user", f"word {k % 3}") for k in range(90)] + [(102, 5, "assistant", "Same.")] * 70
    rows += [(None, None, "user", "One."), (None, 1, "assistant", "Two."), (None, None, None, None), (103, None, "user", "A."), (103, None, "assistant", "B."), (104, -5, "user", "A."), (104, 9, "assistant", "B!")]
    return rows


def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, kind int, live string, part int, place int"
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], schema)


def test_reports_equal_brute_force(spark):
    rows = edge_rows()
    assert sorted((tuple(r) for r in repaired(frame(spark, rows)).collect()), key=str) == brute(rows)
    assert repaired(frame(spark, [])).collect() == []


def test_conversations_cut_into_parts_give_the_same(spark):
    rows = edge_rows()
    cut = ConversationRepair(damaged(frame(spark, rows)), hot_rows=20, part_rows=15)
    assert cut.hot.count() == 3
    assert sorted((tuple(r) for r in cut.reports().collect()), key=str) == brute(rows)
    every = ConversationRepair(damaged(frame(spark, rows)), hot_rows=0, part_rows=50)
    assert sorted((tuple(r) for r in every.reports().collect()), key=str) == brute(rows)
