"""Jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import calendar_fill, to_zone
from millrace.operators.aggregates import merge_aggregate, money
from millrace.operators.changes import apply_batches, dedup_latest, scd2
from millrace.operators.quality import validate
from millrace.operators.sketches import (
    distinct_state,
    estimated_distinct,
    estimated_quantile,
    merged_distinct,
    merged_quantiles,
    quantile_state,
)
from millrace.operators.topk import top_n_per_key
from millrace.operators.windows import Split, SplitWindow, period_change, rolling_sum, sessionize
from millrace.session import shared_path, stored
from millrace.sources.files import overwrite_partitions, write_parquet
from millrace.sources.versions import VersionedTable


def active_users(events: DataFrame, user: str, ts: str, grain: str, rsd: float = 0.05) -> DataFrame:
    """Distinct users per period, exactly and by sketch.

    Both come from the distinct pairs: next to an exact distinct count in one
    aggregation, Spark would keep and shuffle a sketch per pair.
    """
    period = F.date_trunc(grain, ts).cast("date").alias("period")
    pairs = events.select(period, user).distinct()
    return pairs.groupBy("period").agg(
        F.count(user).alias("users"), F.approx_count_distinct(user, rsd).alias("users_approx")
    )


def daily_states(events: DataFrame, user: str, ts: str, value: str) -> DataFrame:
    """Per day: events, and mergeable states of its users and of `value`'s distribution."""
    return events.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("events"), distinct_state(user).alias("users"), quantile_state(value).alias("values")
    )


STATE_KINDS = {"events": "sum", "users": "distinct", "values": "quantiles"}


def monthly_from_states(states: DataFrame, p: float) -> DataFrame:
    """Events, users and the `p` quantile of each month, from the states of its days alone."""
    return states.groupBy(F.trunc("day", "month").alias("month")).agg(
        F.sum("events").alias("events"), estimated_distinct(merged_distinct("users")).alias("users"),
        estimated_quantile(merged_quantiles("values"), p).alias("quantile"),
    )


def top_events(events: DataFrame, ts: str, kind: str, n: int) -> DataFrame:
    """The `n` most frequent kinds of event in each hour."""
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")
    counts = events.groupBy(hour, kind).agg(F.count("*").alias("events"))
    return top_n_per_key(counts, ["hour"], ["-events", kind], n)


def funnel(
    events: DataFrame, user: str, ts: str, kind: str, event_id: str, steps: Sequence[str], gap: str, split: Split
) -> DataFrame:
    """How many sessions reached each step, a step counting only after the one before it.

    The numbered events are written aside, then all steps share one shuffle; no
    session is gathered into a list.
    """
    numbered = sessionize(events.select(user, ts, kind, event_id), user, ts, gap, split, event_id)
    aside = shared_path(events.sparkSession, "sessions")
    numbered.write.parquet(aside)
    walk = SplitWindow(events.sparkSession.read.parquet(aside), [user, "session_no"], [ts, event_id], split)
    for i, step in enumerate(steps):
        hit = F.col(kind) == step
        if i:
            hit &= F.coalesce(F.col(f"_seen{i - 1}"), F.lit(0)) > 0
        walk = walk.derive(**{f"_hit{i}": F.when(hit, 1).otherwise(0)})
        walk = walk.running(F.col(f"_hit{i}"), f"_seen{i}", inclusive=False)
    reached = walk.frame().groupBy(user, "session_no").agg(
        *[F.max(f"_hit{i}").alias(f"_hit{i}") for i in range(len(steps))]
    )
    totals = reached.agg(*[F.sum(f"_hit{i}").alias(step) for i, step in enumerate(steps)])
    return totals.unpivot([], list(steps), "step", "sessions")


def land(
    events: DataFrame, path: str, event_id: str, version: Sequence[str], ts: str, rules: dict[str, Column]
) -> DataFrame:
    """Write valid events, one row per id, partitioned by day; return the rejects."""
    good, bad = validate(events, rules)
    once = dedup_latest(good, event_id, version)
    write_parquet(once.withColumn("day", F.to_date(ts)), path, ["day"])
    return bad


def land_new(
    events: DataFrame, path: str, event_id: str, version: Sequence[str], ts: str, rules: dict[str, Column], batch: int, days_apart: int | None = 0
) -> DataFrame:
    """Add a delivery's valid events that were not landed before, with their `day` and `batch`; return its rejects.

    The landed table knows its earlier deliveries: only the ids of events are
    read from it, and only of the days within `days_apart` of the delivery's own
    (None: of all days, for sources that repeat an event under another time). The
    event that came first stays, missing ids count as one id, so a rule should
    refuse them. A delivery adds folders of its own and shows as a whole or not
    at all; a batch number not above the last one landed changes nothing. One job at a time
    may land into a table.
    """
    good, bad = validate(events, rules)
    dated = dedup_latest(good, event_id, version).withColumn("day", F.to_date(ts)).withColumn("batch", F.lit(batch).cast("long"))
    table = VersionedTable(events.sparkSession, path)
    if not table.numbers():
        VersionedTable.create(dated.where("false"), path, ["day", "batch"])
    base = table.manifest()
    if base.tokens.get("landing", batch - 1) >= batch:
        return bad
    fresh = stored(dated)
    labels = list(base.folders)
    if days_apart is not None:
        near = fresh.select(F.explode_outer(F.sequence(F.date_sub("day", days_apart), F.date_add("day", days_apart))).alias("day")).distinct()
        days = table.labels(near.withColumn("batch", F.lit(None).cast("long")), base)
        reached = {d.split("~")[0] for d in days}
        labels = [name for name in labels if name.split("~")[0] in reached]
    known = table.read(base, labels).select(F.col(event_id).alias("_known"))
    table.replace(fresh.join(known, F.col(event_id).eqNullSafe(F.col("_known")), "left_anti"), base=base, token=("landing", batch))
    return bad


def daily_totals(events: DataFrame, ts: str, kind: str, value: str) -> DataFrame:
    """Count and exact sum per day and kind of event."""
    return events.groupBy(F.to_date(ts).alias("day"), kind).agg(
        F.count("*").alias("events"), F.sum(money(value)).cast("decimal(38,2)").alias("total")
    )


def _folded(old: DataFrame, delta: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return merge_aggregate(old.select(*delta.columns), delta, keys, sums).select(
        *keys, *[F.col(c).cast(t) for c, t in delta.dtypes if c in sums]
    )


def fold_into_versions(table: VersionedTable, delta: DataFrame, keys: Sequence[str], sums: Sequence[str], token: tuple[str, int] | None = None) -> int:
    """As `add_to_summary` for a versioned table: the batch's days change at once or not at all,
    and a batch delivered again under its token is not counted again."""
    base = table.manifest()
    if token and base.tokens.get(token[0], -1) >= token[1]:
        return base.number
    days = table.labels(delta, base)
    return table.replace(_folded(table.read(base, days), delta, keys, sums), days, base, token)


def add_to_summary(path: str, delta: DataFrame, keys: Sequence[str], sums: Sequence[str], day: str) -> None:
    """Fold a batch's totals into a summary table partitioned by day, rewriting
    only the days the batch touches; rows without a day are a day of their own."""
    spark = delta.sparkSession
    days = delta.select(F.col(day).alias("_day")).distinct()
    touched = spark.read.parquet(path).join(days, F.col(day).eqNullSafe(F.col("_day")), "left_semi")
    merged = _folded(touched, delta, keys, sums)
    # Written aside first: a partition must not be replaced while it is read.
    staged = shared_path(spark, "staged")
    merged.write.parquet(staged)
    overwrite_partitions(spark.read.parquet(staged), path, [day])


def features(events: DataFrame, user: str, ts: str, value: Column) -> DataFrame:
    """Per user and day, what the day before and the week before it held.

    Days become one row per user first, so the range frame sees at most one row
    per calendar day; only finished days count.
    """
    daily = events.groupBy(user, F.to_date(ts).alias("day")).agg(
        F.count("*").alias("events"), F.sum(value).alias("value")
    )
    # Each active day is seen by the seven days after it.
    seen = daily.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(7))))
    return seen.groupBy(user, F.date_add("day", F.col("ahead")).alias("feature_day")).agg(
        F.coalesce(F.max(F.when(F.col("ahead") == 1, F.col("events"))), F.lit(0)).alias("events_1d"),
        F.coalesce(F.max(F.when(F.col("ahead") == 1, F.col("value"))), F.lit(0)).alias("value_1d"),
        F.sum("events").alias("events_7d"),
        F.sum("value").alias("value_7d"),
    )


def monthly_report(orders: DataFrame, day: str, value: Column) -> DataFrame:
    """Totals of every month on the calendar with change and 3-month rolling sum."""
    monthly = orders.groupBy(F.trunc(day, "month").alias("month")).agg(
        F.sum(value).alias("total"), F.count("*").alias("orders")
    )
    full = calendar_fill(monthly, "month", "1 MONTH", ["total", "orders"])
    return rolling_sum(period_change(full, "month", "total"), "month", "total", 3, "rolling_3m")


def change_history(
    deliveries: Sequence[DataFrame], key: str, ts: str, seq: str, op: str, tracked: Sequence[str], split: Split
) -> tuple[DataFrame, DataFrame]:
    """From redelivered change logs: history of all versions, and current rows.

    A DELETE ends a history and drops the key from the current rows.
    """
    log = deliveries[0]
    for more in deliveries[1:]:
        log = log.unionByName(more)
    history = scd2(log, key, ts, seq, [*tracked, op], split)
    current = apply_batches(deliveries, key, ts, seq).where(F.col(op) != "DELETE")
    return history.where(F.col(op) != "DELETE"), current


def reconcile_revenue(raw: DataFrame, row_id: str, ts: str, amount: str, zone: str) -> DataFrame:
    """Why two daily revenue reports over the same rows differ.

    Per day: the naive total (all deliveries, UTC days), the total with each row
    once, the same by the day in `zone`, and how many rows were repeated or had
    no amount.
    """
    # One row per id with the number of its deliveries.
    ids = raw.groupBy(row_id).agg(
        F.max(F.struct(ts, amount)).alias("_row"), F.count("*").alias("_copies")
    ).select(row_id, "_row.*", "_copies")
    local = to_zone(ids, ts, "UTC", zone, "_local")
    value = money(amount)
    sides = local.select(
        F.explode(F.array(
            F.struct(F.to_date(ts).alias("day"), F.lit(True).alias("utc")),
            F.struct(F.to_date("_local").alias("day"), F.lit(False).alias("utc")),
        )).alias("_d"), value.alias("v"), "_copies",
    ).select("_d.*", "v", "_copies")
    utc = F.col("utc")
    return sides.groupBy("day").agg(
        F.sum(F.when(utc, F.col("v") * F.col("_copies"))).alias("naive_total"),
        F.sum(F.when(utc, F.col("v"))).alias("deduped_total"),
        F.sum(F.when(~utc, F.col("v"))).alias("zone_total"),
        F.coalesce(F.sum(F.when(utc, F.col("_copies") - 1)), F.lit(0)).alias("repeated_rows"),
        F.count_if(utc & F.col("v").isNull()).alias("missing_amounts"),
    )
