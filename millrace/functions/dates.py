"""Dates and times. Nothing here reads the clock except `stamp`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Calendar fields; `dow` counts from Sunday = 1, `week` is the ISO week."""
    c = F.col(column)
    return df.withColumns({
        "year": F.year(c), "quarter": F.quarter(c), "month": F.month(c), "day": F.day(c),
        "dow": F.dayofweek(c), "doy": F.dayofyear(c), "week": F.weekofyear(c),
    })


def days_since(df: DataFrame, column: str, as_of: str, name: str = "days") -> DataFrame:
    return df.withColumn(name, F.datediff(F.lit(as_of).cast("date"), column))


def format_date(df: DataFrame, column: str, pattern: str, name: str = "text") -> DataFrame:
    return df.withColumn(name, F.date_format(column, pattern))


def parse_date(df: DataFrame, column: str, formats: Sequence[str], name: str = "date") -> DataFrame:
    """The first format that fits; text that fits none gives null."""
    tries = [F.try_to_date(column, f) for f in formats]
    return df.withColumn(name, F.coalesce(*tries))


def parse_ts(df: DataFrame, column: str, pattern: str, name: str = "ts") -> DataFrame:
    return df.withColumn(name, F.try_to_timestamp(column, F.lit(pattern)).cast("timestamp_ntz"))


def truncate(df: DataFrame, column: str, units: Sequence[str]) -> DataFrame:
    """Start of each unit as column `unit`: a date from day up, a time below."""
    def start(unit: str) -> Column:
        kind = "timestamp_ntz" if unit in ("hour", "minute", "second") else "date"
        return F.date_trunc(unit, column).cast(kind)

    return df.withColumns({unit: start(unit) for unit in units})


def add_time(df: DataFrame, column: str, months: int = 0, interval: str | None = None, name: str = "moved") -> DataFrame:
    """Add months to a date (clamped to the month's end) or an interval to a time."""
    moved = F.add_months(column, months) if interval is None else F.col(column) + F.expr(f"INTERVAL {interval}")
    return df.withColumn(name, moved)


def shift_days(df: DataFrame, column: str, n: int, name: str = "shifted") -> DataFrame:
    return df.withColumn(name, F.date_add(column, n))


def months_between_cols(df: DataFrame, later: str, earlier: str, name: str = "months") -> DataFrame:
    """Months apart, the remainder in 31sts; whole when both are month ends."""
    return df.withColumn(name, F.months_between(later, earlier))


def epoch(df: DataFrame, column: str, name: str = "epoch") -> DataFrame:
    """Seconds since 1970 of a zone-less time read as UTC, and back again."""
    seconds = F.unix_seconds(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column)).cast("timestamp"))
    return df.withColumns({
        name: seconds,
        "back": F.timestamp_add("SECOND", seconds, F.lit("1970-01-01").cast("timestamp_ntz")),
    })


def to_zone(df: DataFrame, column: str, source: str, target: str, name: str = "local") -> DataFrame:
    """The wall-clock time in `target` of a wall-clock time in `source`."""
    return df.withColumn(name, F.convert_timezone(F.lit(source), F.lit(target), F.col(column)))


def stamp(df: DataFrame, name: str = "run_at") -> DataFrame:
    """The query's start time, the same on every row."""
    return df.withColumn(name, F.current_timestamp())


def spine(df: DataFrame, date: str, step: str) -> DataFrame:
    """Every period between the first and the last date of `df`, in column `date`."""
    ends = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias(date))


def calendar_fill(df: DataFrame, date: str, step: str, zeros: Sequence[str]) -> DataFrame:
    """A one-row-per-period series with its missing periods added as zeros."""
    return spine(df, date, step).join(df, date, "left").fillna(0, list(zeros))


def calendar_fill_by(
    df: DataFrame, keys: Sequence[str], date: str, step: str, low: str, high: str, zeros: Mapping[str, object]
) -> DataFrame:
    """As `calendar_fill` for each key, over fixed dates; the grid has one row per
    key and period and is never built from a product of tables."""
    grid = df.select(*keys).distinct().withColumn(
        date, F.explode(F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"), F.expr(f"INTERVAL {step}")))
    )
    return grid.join(df, [*keys, date], "left").fillna(dict(zeros))


def compare_dates(df: DataFrame, a: str, b: str, pattern: str) -> DataFrame:
    """Order of two text dates by calendar next to their order as text."""
    x, y = F.try_to_date(a, pattern), F.try_to_date(b, pattern)
    return df.withColumns({"earlier": x < y, "earlier_as_text": F.col(a) < F.col(b)})
