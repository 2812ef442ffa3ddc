"""Window functions that stay distributed when one group holds most of the rows.

A plain `Window.partitionBy(key)` puts a whole group into one task. Here the rows
of groups that `hot_groups` reports are laid out once: range-partitioned by group
and order, each range being a slot, then dealt and sorted by (group, slot) and
stored. Windows over a slot, and aggregates of it, need no further shuffle. All
columns asked for together share one carry table, with a small row per slot that
says what its rows have to know of the slots before and after it (rows and totals
so far, edge rows, last known values). Other groups keep the plain window: one
shuffle, one sort; without hot groups that is the whole plan.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from copy import copy
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import HOT_ROWS, hot_groups, with_group_total
from millrace.session import laid_out, stored

# Rows that a slot should hold at most, and the usual least number of slots.
SLOT_ROWS = 10_000_000
LEAST_SLOTS = 200

FIRST, NOW = Window.unboundedPreceding, Window.currentRow
PLACE = ["_group", "_slot"]


def sort_names(order: Sequence[str]) -> list[str]:
    return [c.lstrip("-") for c in order]


def sort_columns(order: Sequence[str]) -> list[Column]:
    """Sort expressions for column names, `-name` meaning descending."""
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


@dataclass(frozen=True)
class Split:
    """From how many rows on a group is cut into slots.

    Where it is cut follows from its rows; `slot` and `descending`, by which
    callers once chose the cuts, are accepted and change nothing.
    """

    slot: Column | None = None
    descending: bool = False
    hot_rows: int | None = HOT_ROWS


@dataclass
class _Step:
    """A window column: what whole groups compute, and its parts for groups in slots.

    `local` are windows within the slot, `last` what a slot's last row tells the
    other slots, `carried` windows over a group's slots that gather it, `final`
    the answer from all of them.
    """

    name: str
    whole: Column
    final: Column
    local: dict[str, Column] = field(default_factory=dict)
    last: dict[str, Column] = field(default_factory=dict)
    carried: dict[str, Column] = field(default_factory=dict)


class SplitWindow:
    """Window columns over `keys` in `order`; all of them share one shuffle and sort.

    `order` names columns, `-name` for descending, and should tell a group's rows
    apart: rows equal in it stay in one slot. With no keys the order is global
    and every row belongs to a slot, of which there are `slots`. Construction
    counts rows per group (`hot_groups`) and lays out hot ones; the windows stay
    lazy.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split, slots: int | None = None):
        self._order, self._keys = list(order), list(keys)
        self._plain: DataFrame | None = df
        self._cut: DataFrame | None = None
        self._steps: list[_Step] = []
        if keys:
            hot = hot_groups(df, keys, split.hot_rows)
            if hot is None:
                return
            marked, groups = df.withColumn("_group", F.struct(*keys)), F.broadcast(hot.select("_group"))
            self._plain = marked.join(groups, "_group", "left_anti").drop("_group")
            rows = hot.agg(F.sum("_rows")).first()[0]
            cut = marked.join(groups, "_group", "left_semi")
        else:
            if slots is None:
                df = stored(df)
            self._plain, rows, cut = None, 0 if slots else df.count(), df.withColumn("_group", F.struct(F.lit(0)))
        count = slots or slot_count(rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        ranged = cut.repartitionByRange(count, "_group", *sort_columns(order)).withColumn("_slot", F.spark_partition_id())
        self._cut = laid_out(ranged.repartition(count, *PLACE).sortWithinPartitions(*PLACE, *sort_columns(order)))

    def _over(self, keys: Sequence[str]) -> Window:
        return Window.partitionBy(*keys).orderBy(*sort_columns(self._order))

    @property
    def _so_far(self) -> Window:
        return self._over(PLACE).rowsBetween(FIRST, NOW)

    def _add(self, step: _Step, *values: Column) -> SplitWindow:
        """With one more column; a value that uses a column asked for before has to wait for it."""
        ready = self._done() if any(re.search(rf"\b{re.escape(s.name)}\b", str(v)) for s in self._steps for v in values) else self
        new = copy(ready)
        new._steps = [*ready._steps, step]
        return new

    def _temp(self, what: str) -> str:
        return f"_{what}{len(self._steps)}"

    def number(self, name: str) -> SplitWindow:
        """Row numbers from 1."""
        before = self._temp("before")
        return self._add(_Step(
            name, F.row_number().over(self._over(self._keys)).cast("bigint"), F.col("_pos") + F.coalesce(F.col(before), F.lit(0)),
            last={before: F.col("_pos")}, carried={before: F.sum(before).over(_earlier())},
        ))

    def running(self, value: Column, name: str, inclusive: bool = True) -> SplitWindow:
        """Running sum up to this row, or over the rows before it (null on the first)."""
        frame = (FIRST, NOW if inclusive else -1)
        within, before = self._temp("within"), self._temp("before")
        return self._add(_Step(
            name, F.sum(value).over(self._over(self._keys).rowsBetween(*frame)),
            F.when(F.col(within).isNull(), F.col(before)).otherwise(F.col(within) + F.coalesce(F.col(before), F.lit(0))),
            local={within: F.sum(value).over(self._over(PLACE).rowsBetween(*frame))},
            last={before: F.sum(value).over(self._so_far)}, carried={before: F.sum(before).over(_earlier())},
        ), value)

    def neighbour(self, value: Column, name: str, offset: int, default: Column | None = None) -> SplitWindow:
        """The value `offset` rows after this one (before it, if negative)."""
        n, ahead = abs(offset), offset > 0
        boxed = F.struct(value.alias("v"))  # tells a missing row from a null value
        shift = F.lead if ahead else F.lag
        near, far, rows = self._temp("near"), self._temp("far"), self._over(PLACE)
        # A slot hands over its n rows next to the edge, nearest first.
        if ahead:
            edge = [F.nth_value(boxed, k).over(self._so_far) for k in range(1, n + 1)]
        else:
            edge = [boxed, *[F.lag(boxed, k).over(rows) for k in range(1, n)]]
        if n == 1:
            edges, carried, found = edge[0], shift(far, 1).over(_slots()), F.coalesce(near, far)
        else:
            # Every slot has a row, so the n slots beside it hold n rows or all there are.
            edges = F.filter(F.array(*edge), lambda b: b.isNotNull())
            lists = F.collect_list(far).over(_slots().rowsBetween(1, n) if ahead else _slots().rowsBetween(-n, -1))
            carried = F.flatten(lists if ahead else F.reverse(lists))
            left = F.col("_all") - F.col("_pos") + 1 if ahead else F.col("_pos")
            found = F.coalesce(F.col(near), F.when(left <= n, F.try_element_at(far, (n + 1 - left).cast("int"))))
        local = {near: shift(boxed, n).over(rows)}
        if ahead and n > 1:
            local["_all"] = F.count("*").over(Window.partitionBy(*PLACE))
        whole = shift(boxed, n).over(self._over(self._keys))
        return self._add(_Step(name, _unbox(whole, default), _unbox(found, default), local, {far: edges}, {far: carried}), value)

    def last_known(self, value: Column, name: str) -> SplitWindow:
        """The nearest earlier value that is not null."""
        near, far = self._temp("near"), self._temp("far")
        known = lambda keys: F.last(value, ignorenulls=True).over(self._over(keys).rowsBetween(FIRST, -1))
        return self._add(_Step(
            name, known(self._keys), F.coalesce(near, far), local={near: known(PLACE)},
            last={far: F.last(value, ignorenulls=True).over(self._so_far)},
            carried={far: F.last(far, ignorenulls=True).over(_earlier())},
        ), value)

    def _done(self) -> SplitWindow:
        """With the columns asked for so far in place."""
        if not self._steps:
            return self
        new = copy(self)
        new._steps = []
        if self._plain is not None:
            new._plain = self._plain.withColumns({s.name: s.whole for s in self._steps})
        if self._cut is not None:
            rows = self._over(PLACE)
            placed = self._cut.withColumn("_pos", F.row_number().over(rows).cast("bigint"))
            last = placed.withColumns({"_more": F.lead(F.lit(True)).over(rows)} | {n: c for s in self._steps for n, c in s.last.items()})
            carried = [c.alias(n) for s in self._steps for n, c in s.carried.items()]
            # A row for every slot of a hot group: at most one for each group, and one for each slot.
            carry = F.broadcast(last.where(F.col("_more").isNull()).select(*PLACE, *carried))
            local = {n: c for s in self._steps for n, c in s.local.items()}
            joined = placed.withColumns(local).join(carry, PLACE, "left").withColumns({s.name: s.final for s in self._steps})
            new._cut = joined.drop("_pos", *local, *[n for s in self._steps for n in s.carried])
        return new

    def _each(self, change) -> SplitWindow:
        new = copy(self._done())
        new._plain = None if new._plain is None else change(new._plain)
        new._cut = None if new._cut is None else change(new._cut)
        return new

    def derive(self, **columns: Column) -> SplitWindow:
        """Add columns computed from those there already."""
        return self._each(lambda df: df.withColumns(columns))

    def where(self, condition: Column) -> SplitWindow:
        """Drop rows; later window columns see only those that stay, without a new shuffle."""
        return self._each(lambda df: df.where(condition))

    def frame(self) -> DataFrame:
        done = self._done()
        if done._cut is None:
            return done._plain
        cut = done._cut.drop(*PLACE)
        return cut if done._plain is None else done._plain.unionByName(cut)


def _slots() -> Window:
    return Window.partitionBy("_group").orderBy("_slot")


def _earlier() -> Window:
    return _slots().rowsBetween(FIRST, -1)


def _unbox(box: Column, default: Column | None) -> Column:
    value = box["v"]
    return value if default is None else F.when(box.isNull(), default).otherwise(value)


def quantile_slot(
    df: DataFrame, value: str, slots: int, name: str = "slot", tie: Column | None = None
) -> DataFrame:
    """Add a slot column holding roughly 1 / `slots` of the rows each.

    The cut points are read once, so every use of the result sees the same ones;
    `slots` numbers reach the driver, no rows do. A value so common that it fills
    a slot gets one of its own, which `tie` (monotone in the tie-break order)
    cuts further.
    """
    probabilities = [i / slots for i in range(1, slots)]
    cuts = df.select(F.col(value).cast("double").alias(value)).approxQuantile(
        value, probabilities, 0.5 / slots
    )
    common = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    edges = sorted(set(cuts) | {math.nextafter(v, math.inf) for v in common})
    infinite = [-math.inf, *(edges or [0.0]), math.inf]  # no edges if there are no values
    number = df.withColumn("_value", F.col(value).cast("double"))
    slot = F.col("_bucket")
    cut = Bucketizer(splits=infinite, inputCol="_value", outputCol="_bucket", handleInvalid="keep").transform(number)
    if tie is not None:
        part = F.when(F.col("_value").isin(common), tie) if common else F.lit(None).cast("bigint")
        slot = F.struct(slot.alias("value"), part.cast("bigint").alias("tie"))
    return cut.withColumn(name, slot).drop("_value", "_bucket")


def _peer_columns(placed: SplitWindow, rank: str | None, dense_rank: str | None, total: str | None) -> SplitWindow:
    """Ranks and running total over one row per set of ties, with its size in
    `_same` and its sum in `_sum`."""
    if dense_rank:
        placed = placed.number(dense_rank)
    if rank:
        placed = placed.running(F.col("_same"), rank, inclusive=False)
        placed = placed.derive(**{rank: F.coalesce(F.col(rank), F.lit(0)) + 1})
    return placed.running(F.col("_sum"), total) if total else placed


def with_peers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: Split,
    rank: str | None = None,
    dense_rank: str | None = None,
    total: str | None = None,
    value: Column | None = None,
) -> DataFrame:
    """Rank, dense rank and the running total of `value` whose frame includes ties.

    Ties get equal answers, so with hot groups the work is done on one row per
    set of ties and joined back: neither a hot key nor a common value in it meets
    in one task. `split.slot` is an expression of the order columns.
    """
    if hot_groups(df, keys, split.hot_rows) is None:
        w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        wanted = {rank: F.rank, dense_rank: F.dense_rank}
        columns = {name: fn().over(w).cast("bigint") for name, fn in wanted.items() if name}
        return df.withColumns(columns | ({total: F.sum(value).over(w)} if total else {}))
    names = sort_names(order)
    summed = F.sum(F.lit(0) if value is None else value).alias("_sum")
    peers = df.groupBy(*keys, *names).agg(F.count("*").alias("_same"), summed)
    placed = _peer_columns(SplitWindow(peers, keys, order, split), rank, dense_rank, total).frame()
    added = [c for c in (rank, dense_rank, total) if c]
    by_peer = placed.select(F.struct(*keys, *names).alias("_peer"), *added)
    return df.withColumn("_peer", F.struct(*keys, *names)).join(by_peer, "_peer").drop("_peer")


def slot_count(rows: int, least: int = LEAST_SLOTS) -> int:
    """Slots for so many rows, so that none holds many more than `SLOT_ROWS`."""
    return max(least, -(-rows // SLOT_ROWS))


def global_ranks(df: DataFrame, value: str, slots: int | None = None) -> DataFrame:
    """Add `rank` and `dense_rank` over the whole table, largest value first.

    Ranks come from the distinct values, where a common value is one row, and are
    joined back.
    """
    values = df.groupBy(value).agg(F.count("*").alias("_same"))
    ranks = _peer_columns(SplitWindow(values, [], [f"-{value}"], Split(), slots), "rank", "dense_rank", None).frame()
    # Joined as a struct, in which a null value equals itself.
    by_value = ranks.select(F.struct(value).alias("_value"), "dense_rank", "rank")
    return df.withColumn("_value", F.struct(value)).join(by_value, "_value").drop("_value")


def global_running(
    df: DataFrame, value: str, tie: str, slots: int | None = None, tie_step: int | None = None
) -> DataFrame:
    """Running total and ranks over the whole table, largest value first.

    Adds `running`, `rank` and `dense_rank`; `tie` is a unique id that orders
    equal values, however many there are. No task sees more than one slot; all
    columns come from one laid out copy of the rows. `tie_step` is accepted from
    older callers and not used.
    """
    rows = SplitWindow(df, [], [f"-{value}", tie], Split(), slots)
    rows = rows.running(F.col(value), "running").number("_nth").neighbour(F.struct(value), "_prev", -1)
    fresh = F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.struct(value))
    rows = rows.derive(_fresh=F.when(fresh, 1).otherwise(0), _first=F.when(fresh, F.col("_nth")))
    rows = rows.running(F.col("_fresh"), "dense_rank").last_known(F.col("_first"), "_known")
    return rows.derive(rank=F.coalesce("_first", "_known")).frame().drop("_prev", "_nth", "_fresh", "_first", "_known")


def group_count(df: DataFrame, keys: Sequence[str], name: str = "group_rows") -> DataFrame:
    """Each row with the number of rows of its group."""
    return with_group_total(df, keys, **{name: F.count("*")})


def recent_total(df: DataFrame, keys: Sequence[str], day: str, value: Column, days: int, name: str) -> DataFrame:
    """Sum over each row's last `days` days, its own day included whole.

    A range frame treats all rows of a day alike, so the window runs over one
    row per key and day; a hot key contributes at most one row per calendar day.
    A null key is a key like others; a key's rows without a day form a day of
    their own.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-days, 0)
    # Joined as a struct, in which nulls equal each other.
    per_day = daily.select(F.struct(*keys, day).alias("_day"), F.sum("_sum").over(w).alias(name))
    return df.withColumn("_day", F.struct(*keys, day)).join(per_day, "_day").drop("_day")


def rolling_mean(series: DataFrame, period: str, value: str, n: int, name: str) -> DataFrame:
    """Mean of the last `n` rows of a series with one row per calendar period."""
    return series.withColumn(name, F.avg(value).over(_calendar(period).rowsBetween(1 - n, 0)))


def rolling_sum(series: DataFrame, period: str, value: str, n: int, name: str) -> DataFrame:
    return series.withColumn(name, F.sum(value).over(_calendar(period).rowsBetween(1 - n, 0)))


def period_change(series: DataFrame, period: str, value: str) -> DataFrame:
    """Previous value and relative change (percent) of a one-row-per-period series."""
    return series.withColumn("previous", F.lag(value).over(_calendar(period))).withColumn(
        "change_pct", F.try_divide((F.col(value) - F.col("previous")) * 100, F.col("previous"))
    )


def _calendar(period: str) -> Window:
    # Only for series already aggregated to one row per day or month: their
    # length is the calendar's, whatever the table's, so one task is enough.
    return Window.orderBy(period)


def sessionize(df: DataFrame, key: str, ts: str, gap: str, split: Split, tie: str) -> DataFrame:
    """Add `session_no`, which grows by one after every pause longer than `gap`."""
    pause = F.col(ts) - F.col("_prev") > F.expr(f"INTERVAL {gap}")
    return (
        SplitWindow(df, [key], [ts, tie], split)
        .neighbour(F.col(ts), "_prev", -1)
        .derive(_new=F.when(pause, 1).otherwise(0))
        .running(F.col("_new"), "session_no")
        .frame()
        .drop("_prev", "_new")
    )
