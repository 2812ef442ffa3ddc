"""Deduplication, change logs and history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import latest_row
from millrace.operators.windows import Split, SplitWindow


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_any(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, no matter which."""
    return df.dropDuplicates(list(key))


def dedup_latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` per key; remaining ties go by the rest of
    the row, so the answer never depends on partitioning."""
    return latest_row(df, key, order)


def last_write_wins(log: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Current row per key: greatest timestamp, then greatest sequence number."""
    return latest_row(log, key, [ts, seq])


def apply_batches(batches: Sequence[DataFrame], key: str, ts: str, seq: str) -> DataFrame:
    """State after several deliveries, however often a record was delivered."""
    everything = batches[0]
    for batch in batches[1:]:
        everything = everything.unionByName(batch)
    return last_write_wins(everything, key, ts, seq)


def batch_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: how many keys only `a` and only `b` have."""
    sides = a.select(key).distinct().withColumn("a", F.lit(True)).join(
        b.select(key).distinct().withColumn("b", F.lit(True)), key, "full_outer"
    )
    return sides.agg(
        F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b")
    )


def _once(incoming: DataFrame, key: str, new: Column) -> DataFrame:
    """The key and `new` of each row with a key, as `_new`; a repeated key is an error, since which row should win is unknown."""
    rows = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(F.first(new).alias("_new"), F.count("*").alias("_rows"))
    fault = F.raise_error(F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(" occurs more than once in the batch")))
    return rows.select(key, F.when(F.col("_rows") > 1, fault.cast(dict(rows.dtypes)["_new"])).otherwise(F.col("_new")).alias("_new"))


def scd1(dim: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Overwrite the dimension with the current change rows, one per key; no history."""
    shared = [c for c in current.columns if c != key and c in dim.columns]
    news = _once(current, key, F.struct(*shared))
    joined = dim.join(news, key, "left")
    return joined.withColumns(
        {c: F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)) for c in shared}
    ).drop("_new")


def scd2(log: DataFrame, key: str, ts: str, seq: str, tracked: Sequence[str], split: Split) -> DataFrame:
    """History rows `[valid_from, valid_to)` with `is_current`.

    Consecutive log rows that change none of `tracked` form one version. Of
    several rows at one instant the last by `seq` holds, so redelivered rows
    change nothing. Rows without a time come before all others: the last of them
    is a version from ever on, its `valid_from` null. Without hot keys all steps
    share one shuffle and sort of the log.
    """
    state = F.struct(*tracked)
    rows = log.select(key, ts, seq, *[c for c in tracked if c not in (key, ts, seq)])
    return (
        SplitWindow(rows, [key], [ts, seq, *tracked], split)
        .neighbour(F.struct(F.col(ts).alias("at")), "_next", 1)
        .where(F.col("_next").isNull() | ~F.col("_next.at").eqNullSafe(F.col(ts)))
        .neighbour(state, "_prev", -1)
        .where(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(state))
        .neighbour(F.col(ts), "valid_to", 1)
        .frame().drop("_next", "_prev")
        .withColumn("is_current", F.col("valid_to").isNull())
        .withColumnRenamed(ts, "valid_from")
    )


def splice(kept: DataFrame, batch: DataFrame, key: str, ts: str, seq: str, tracked: Sequence[str], split: Split) -> DataFrame:
    """Cut a batch of changes, late ones too, into a kept history.

    `kept` has one row per key and instant: key, `seq`, `tracked`, valid_from,
    valid_to and `opens`, which says whether a version starts there. Rows that
    change nothing stay, as a change that arrives late may come between them
    and the row they repeat. The opening rows equal `scd2` over all changes that
    ever came, in whatever order and however often. Only keys in the batch are
    worked on; the others' rows pass through.
    """
    keys = batch.select(F.col(key).alias("_key")).distinct()
    touched, rest = (kept.join(keys, F.col(key).eqNullSafe(F.col("_key")), how) for how in ("left_semi", "left_anti"))
    columns = [key, seq, *[c for c in tracked if c not in (key, ts, seq)]]
    rows = touched.select(*columns, F.col("valid_from").alias(ts)).unionByName(batch.select(*columns, ts))
    state = F.struct(*[F.col("valid_from" if c == ts else c) for c in tracked])
    walk = (
        SplitWindow(rows.withColumnRenamed(ts, "valid_from"), [key], ["valid_from", seq, *[c for c in tracked if c != ts]], split)
        .neighbour(F.struct(F.col("valid_from").alias("at")), "_next", 1)
        .where(F.col("_next").isNull() | ~F.col("_next.at").eqNullSafe(F.col("valid_from")))
        .neighbour(state, "_prev", -1)
        .derive(opens=F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(state))
    )
    opening = walk.where(F.col("opens")).neighbour(F.col("valid_from"), "valid_to", 1).frame()
    silent = walk.where(~F.col("opens")).frame().withColumn("valid_to", F.lit(None).cast(dict(opening.dtypes)["valid_to"]))
    return rest.unionByName(opening.drop("_next", "_prev")).unionByName(silent.drop("_next", "_prev"))


def as_of(history: DataFrame, facts: DataFrame, key: str, ts: str, split: Split, carry: Sequence[str]) -> DataFrame:
    """Facts with the history values valid at their time; null before the first version,
    after the end of the last one, and for facts without a time.

    Versions and facts of a key are merged in time order and each fact takes the
    last version before it. A range join would pair every fact with every version
    of its key before filtering.
    """
    versions = history.select(
        key, F.col("valid_from").alias("_ts"), F.lit(0).alias("_kind"), F.struct(*carry, F.col("valid_to").alias("_until")).alias("_state")
    )
    rows = facts.select(key, F.col(ts).alias("_ts"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact"))
    merged = versions.unionByName(rows, allowMissingColumns=True)
    seen = SplitWindow(merged, [key], ["_ts", "_kind"], split).last_known(F.col("_state"), "_known").frame()
    until = F.col("_known._until")
    valid = F.col("_ts").isNotNull() & (until.isNull() | (until > F.col("_ts")))
    return seen.where(F.col("_kind") == 1).select("_fact.*", *[F.when(valid, F.col("_known")[c]).alias(c) for c in carry])


def upsert(target: DataFrame, incoming: DataFrame, key: str, deleted: Column | None = None) -> DataFrame:
    """Target after inserting and updating by key, and deleting where `deleted` holds.

    Target columns the batch lacks keep their value on updates; on inserts they
    are null. A key that the batch repeats raises; reduce it by version first.
    Rows without a key equal no row: all of them are inserted, unless deleted.
    One full outer join; unchanged rows pass through it.
    """
    given = [c for c in incoming.columns if c != key and c in target.columns]
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    news = _once(incoming, key, F.struct(*given, gone.alias("_gone")))
    joined = target.join(news, key, "full_outer").where(F.col("_new").isNull() | ~F.col("_new._gone"))
    keyed = joined.withColumns(
        {c: F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)) for c in given}
    ).drop("_new").select(*target.columns)
    return keyed.unionByName(incoming.where(F.col(key).isNull() & ~gone).select(key, *given), allowMissingColumns=True)


def apply_cdc(target: DataFrame, log: DataFrame, key: str, ts: str, seq: str, op: str) -> DataFrame:
    """Bring the target up to date with a change log in which `op` may be DELETE."""
    current = last_write_wins(log, key, ts, seq)
    return upsert(target, current, key, F.col(op) == "DELETE")


def late_records(applied: DataFrame, batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Batch rows older than the state already applied for their key."""
    newest = applied.groupBy(key).agg(F.max(ts).alias("applied_ts"))
    return batch.join(newest, key).where(F.col(ts) < F.col("applied_ts"))


def backfill(target: DataFrame, snapshot: DataFrame, key: str, column: str) -> DataFrame:
    """Fill nulls of one column from a snapshot with unique keys."""
    source = snapshot.select(key, F.col(column).alias("_old"))
    return target.join(source, key, "left").withColumn(column, F.coalesce(column, "_old")).drop("_old")
