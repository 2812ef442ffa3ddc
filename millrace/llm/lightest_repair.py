"""Repair of conversations as a lightest derivation.

Items are (i, state): the first i rows are edited, and the roles written so far
leave the pattern `(s?(ua)+)?` in that state. Deductions combine an item and a row
(keep, rerole, delete) or extend an item alone (insert). A derivation weighs
(cost, audit), audit being its edits' initials; every deduction adds a cost and
appends a letter, so it is superior: its result is never lighter than its item,
and lighter items give lighter results (of two equally dear audits for the same
rows neither begins the other, since each has one letter that isn't an insertion
for every row). Hence Knuth's agenda: pop the lightest open item, which is then
final, deduce from it, and stop when the goal is popped.

Long conversations are cut into blocks. The agenda gives each block's lightest
derivation from every state to every state, insertions before a row only; blocks
are then chained by their costs, and their audits are compared only where costs
tie. Blocks of one shape share their result.

A conversation goes to one task, in order and streamed. Those with very many rows
or bytes are cut by range instead: parts are planned in parallel, a few numbers
per part are chained, and only the hash over the whole text, which has to be
taken in order, passes through one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

# Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# The state that a role's initial leads to, and what can only be inserted or reroled to in a state.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
# Insertions that end a conversation in each state.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
GOOD, BLANK, DUPLICATE, CUT = range(4)
BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 48
# A conversation beyond these, or beyond this share of the table, is cut into parts; so hot ones are at most 2 / HOT_SHARE.
HOT_ROWS = 20_000
HOT_BYTES = 32 << 20
HOT_SHARE = 1e-6
PART_ROWS = 20_000
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def fault_of(role: str, text: str, seen: bool) -> int:
    """A row's first fault."""
    kept = text.rstrip(BLANKS)
    return BLANK if not kept else DUPLICATE if seen else GOOD if kept[-1] in ".!?" else CUT


def sign(role: str, fault: int) -> str:
    """What the planner knows of a row: its initial (x: no usable one), in capitals if truncated, or - if it must go."""
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return "-" if fault in (BLANK, DUPLICATE) else initial.upper() if fault == CUT else initial


def edits(row: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, state after) of what can be done with a row."""
    yield DELETE, "D", state
    if row != "-":
        more = TRUNCATED if row.isupper() else 0
        if (after := STEPS.get((state, row.lower()))) is not None:
            yield KEEP + more, "K", after
        yield REROLE + more, "R", NEXT[state]


@lru_cache(200_000)
def lightest(shape: str, start: int, whole: bool) -> dict[int, tuple[int, str]]:
    """(cost, audit) by the state reached after the rows of `shape`, by Knuth's agenda.

    With `whole`, insertions may follow the last row, and only the first accepting state popped is given.
    """
    agenda, final, found = [(0, "", 0, start)], set(), {}
    while agenda:
        cost, audit, i, state = heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(shape):
            if not whole:
                found[state] = (cost, audit)
                continue
            if state in (START, ASSISTANT):
                return {state: (cost, audit)}
        else:
            for price, letter, after in edits(shape[i], state):
                if (i + 1, after) not in final:
                    heappush(agenda, (cost + price, audit + letter, i + 1, after))
        if (i, NEXT[state]) not in final:
            heappush(agenda, (cost + INSERT, audit + "I", i, NEXT[state]))
    return found


def chained(tables: list[dict[int, dict[int, tuple[int, object]]]], start: int = START) -> list[tuple[int, int]]:
    """(state before, state after) of each block on the lightest way; ties are decided by the blocks' audits, or their ranks."""
    ahead = [{q: INSERT * len(ENDING[q]) for q in STATES}]
    for table in reversed(tables):
        ahead.append({p: min(cost + ahead[-1][q] for q, (cost, _) in exits.items()) for p, exits in table.items()})
    ahead.reverse()
    way = []
    for table, rest in zip(tables, ahead[1:], strict=True):
        after = min(table[start], key=lambda q: (table[start][q][0] + rest[q], table[start][q][1]))
        way.append((start, after))
        start = after
    return way


def blocks(shape: str) -> list[dict[int, dict[int, tuple[int, str]]]]:
    return [{p: lightest(shape[k:k + BLOCK], p, False) for p in STATES} for k in range(0, len(shape), BLOCK)]


def repair(shape: str) -> str:
    """The lightest repair's audit."""
    if len(shape) <= BLOCK:
        return next(iter(lightest(shape, START, True).values()))[1]
    tables = blocks(shape)
    way = chained(tables)
    return "".join(table[p][q][1] for table, (p, q) in zip(tables, way, strict=True)) + ENDING[way[-1][1]]


def span(shape: str, start: int) -> dict[int, tuple[int, str]]:
    """(cost, audit) of many rows by the state reached, insertions before rows only: blocks joined one by one."""
    reached = {start: (0, "")}
    for table in blocks(shape):
        further: dict[int, tuple[int, str]] = {}
        for p, (cost, audit) in reached.items():
            for q, (price, letters) in table[p].items():
                if q not in further or (cost + price, audit + letters) < further[q]:
                    further[q] = (cost + price, audit + letters)
        reached = further
    return reached


def row_edits(audit: str) -> list[str]:
    """An audit by row: the insertions before it and its own letter; what is left at the end comes last."""
    out, begin = [], 0
    for k, letter in enumerate(audit):
        if letter != "I":
            out.append(audit[begin:k + 1])
            begin = k + 1
    return [*out, audit[begin:]]


class Report:
    """What is told of one conversation, fed with its rows in order."""

    def __init__(self):
        self.counts = [0, 0, 0, 0]
        self.illegal = self.cost = self.turns = 0
        self.initial = self.low = self.high = None
        self.state, self.audit, self.sha, self.begun = START, [], hashlib.sha256(), False

    def _write(self, state: int, role: str, text: str) -> None:
        if self.begun:
            self.sha.update(b"\n")
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.state, self.begun = state, True

    def row(self, turn: int | None, role: str, text: str, fault: int, letters: str, copies: int = 1) -> None:
        """A row and `copies` - 1 repetitions of it, which are deleted; `letters` are its own edits."""
        self.counts[fault] += 1
        self.counts[BLANK if fault == BLANK else DUPLICATE] += copies - 1
        self.illegal += copies - 1 + (self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"))
        self.initial = role[:1]
        if turn is not None and turn != self.high:
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        self.edit(letters, role, text, fault)
        self.cost += DELETE * (copies - 1)
        self.audit.append("D" * (copies - 1))

    def edit(self, letters: str, role: str = "", text: str = "", fault: int = GOOD) -> None:
        self.audit.append(letters)
        for letter in letters:
            if letter == "I":
                self._write(NEXT[self.state], ROLE[NEXT[self.state]], "")
                self.cost += INSERT
            elif letter == "D":
                self.cost += DELETE
            else:
                state = STEPS[self.state, role[:1]] if letter == "K" else NEXT[self.state]
                self._write(state, role if letter == "K" else ROLE[state], text)
                self.cost += (KEEP if letter == "K" else REROLE) + (TRUNCATED if fault == CUT else 0)

    def result(self, conv_id: int | None) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (conv_id, gaps, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [f.split()[0] for f in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: conv_id, live, turn, role, text by conversation and in order, to results."""
    current, rows, begun = None, [], False

    def close() -> tuple:
        report, seen, faults = Report(), set(), []
        for _, role, text in rows:
            faults.append(fault_of(role, text, (role, text) in seen))
            seen.add((role, text))
        *letters, end = row_edits(repair("".join(sign(role, f) for (_, role, _), f in zip(rows, faults, strict=True))))
        for (turn, role, text), fault, own in zip(rows, faults, letters, strict=True):
            report.row(turn, role, text, fault, own)
        report.edit(end)
        return report.result(current)

    for batch in batches:
        out = []
        for conv_id, live, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not begun or conv_id != current:
                if begun:
                    out.append(close())
                current, rows, begun = conv_id, [], True
            if live:
                rows.append((turn, role, text))
        if out:
            yield _batch(out)
    if begun:
        yield _batch([close()])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: conv_id, place, turn, role, text, fault, letters, copies by conversation and in order, to results.

    Rows without a place name a conversation and come first.
    """
    current, report = None, None
    for batch in batches:
        out = []
        for conv_id, place, turn, role, text, fault, letters, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if report is None or conv_id != current:
                if report is not None:
                    report.edit(ENDING[report.state])
                    out.append(report.result(current))
                current, report = conv_id, Report()
            if place is not None:
                report.row(turn, role, text, fault, letters, copies)
        if out:
            yield _batch(out)
    if report is not None:
        report.edit(ENDING[report.state])
        yield _batch([report.result(current)])


def damaged(df: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """conv_id, live, turn, role, text: the rows after damage; a dropped one stays as a row that is not live."""
    conv, turn = F.col(f"`{conv_column}`").cast("long"), F.col(f"`{turn_column}`").cast("long")
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    role, text = spaced(F.col(f"`{role_column}`")), spaced(F.col(f"`{text_column}`"))
    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn))) % 20
    rows = df.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    live = F.when(F.col("kind") == 0, F.array(F.lit(False))).when(F.col("kind") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.lit(True)))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", F.explode(live).alias("live"), "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


class ConversationRepair:
    """Faults and the cheapest repair of every conversation.

    `rows` has conv_id (long), live, turn (long), role and text, none of the last
    two null, as `damaged` gives them. Rows stand by turn, null turns first; rows
    of one turn by role and text, so that repeated rows are neighbours. A null
    conv_id is a conversation of its own. Empty and long texts need nothing
    special; conversations without live rows have zeros and an empty repair; an
    empty table gives an empty result. `rows` is read twice or more: store an
    expensive one first.
    """

    def __init__(self, rows: DataFrame, hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES, part_rows: int = PART_ROWS):
        self.rows, self.part_rows = rows, part_rows
        self.order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
        counts = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
        counts = written(counts, "conversations")
        n, size = counts.agg(F.sum("n"), F.sum("bytes")).first()
        many = (F.col("n") > max(hot_rows, HOT_SHARE * (n or 0))) | (F.col("bytes") > max(hot_bytes, HOT_SHARE * (size or 0)))
        self.hot = counts.where(many).select("conv_id", "n")

    def _side(self, how: str) -> DataFrame:
        hot = self.hot.select(F.col("conv_id").alias("_hot"))
        return self.rows.join(F.broadcast(hot), F.col("conv_id").eqNullSafe(F.col("_hot")), how)

    def reports(self) -> DataFrame:
        """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        rows = self.hot.agg(F.sum("n")).first()[0]
        plain = self._side("left_anti") if rows else self.rows
        found = plain.repartition("conv_id").sortWithinPartitions("conv_id", *self.order).mapInArrow(_whole, RESULT)
        return found.unionByName(self._cut(rows)) if rows else found

    def _cut(self, rows: int) -> DataFrame:
        """Reports of hot conversations, planned part by part."""
        live = self._side("left_semi").where("live")
        each = live.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
        each = written(each.withColumn("digest", F.sha2("text", 256)), "rows")
        # Where a role and text stand first; skewed keys of this join meet one row each.
        when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
        first = each.groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first")).toDF("c", "r", "d", "first")
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
        kept = F.rtrim(F.translate("text", BLANKS, " " * len(BLANKS)))
        fault = F.when(kept == "", BLANK).when(when != F.col("first"), DUPLICATE).when(kept.rlike(r"[.!?]\z"), GOOD).otherwise(CUT)
        told = each.join(first, same).select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))
        ranged = told.repartitionByRange(1 + rows // self.part_rows, F.col("conv_id"), *self.order).sortWithinPartitions("conv_id", *self.order)
        placed = written(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "placed")
        initial = F.substring("role", 1, 1)
        usable = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
        shown = F.when(F.col("fault").isin(BLANK, DUPLICATE), "-").when(F.col("fault") == CUT, F.upper(usable)).otherwise(usable)
        signs = placed.select("conv_id", "part", "place", shown.alias("sign"), F.lit(-1).alias("p"))

        def spans(part: pd.DataFrame) -> pd.DataFrame:
            shape = "".join(part.sort_values("place")["sign"])
            out = []
            for p in STATES:
                reached = span(shape, p)
                ranks = {audit: k for k, audit in enumerate(sorted({a for _, a in reached.values()}))}
                out += [(part["conv_id"].iloc[0], part["part"].iloc[0], p, q, cost, ranks[audit]) for q, (cost, audit) in reached.items()]
            return pd.DataFrame(out, columns=["conv_id", "part", "p", "q", "cost", "rank"])

        # Repetitions cost the same whatever is done before and after them, so the plan leaves them out.
        table = written(signs.groupBy("conv_id", "part").applyInPandas(spans, "conv_id long, part int, p int, q int, cost long, rank int"), "spans")

        def way(conversation: pd.DataFrame) -> pd.DataFrame:
            parts, tables = [], []
            for number, some in conversation.groupby("part", sort=True):
                parts.append(number)
                tables.append({int(p): {int(q): (int(c), int(r)) for q, c, r in zip(own["q"], own["cost"], own["rank"], strict=True)} for p, own in some.groupby("p")})
            out = [(conversation["conv_id"].iloc[0], number, p, q) for number, (p, q) in zip(parts, chained(tables), strict=True)]
            return pd.DataFrame(out, columns=["conv_id", "part", "p", "q"])

        # Sixteen rows of numbers for every part of a conversation.
        ways = table.groupBy("conv_id").applyInPandas(way, "conv_id long, part int, p int, q int")
        chosen = ways.select("conv_id", "part", F.lit(-1).cast("long").alias("place"), F.col("q").cast("string").alias("sign"), "p")

        def planned(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("place")
            p, q = int(part["p"].iloc[0]), int(part["sign"].iloc[0])
            audit = span("".join(part["sign"].iloc[1:]), p)[q][1]
            return pd.DataFrame({"at": part["place"].iloc[1:], "letters": row_edits(audit)[:-1]})

        letters = signs.unionByName(chosen).groupBy("conv_id", "part").applyInPandas(planned, "at long, letters string")
        full = placed.join(letters, placed["place"] == letters["at"]).select("conv_id", "place", "turn", "role", "text", "fault", "letters", "copies")
        named = self.hot.select("conv_id", *[F.lit(None).cast(full.schema[c].dataType).alias(c) for c in full.columns[1:]])
        ordered = full.unionByName(named).repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").asc_nulls_first())
        return ordered.mapInArrow(_streamed, RESULT)


def repaired(df: DataFrame) -> DataFrame:
    """Reports on the conversations of `df` after damage."""
    return ConversationRepair(damaged(df)).reports()
