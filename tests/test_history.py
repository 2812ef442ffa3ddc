from __future__ import annotations

import random
from datetime import datetime

import pytest

from conftest import same
from millrace.operators import changes
from millrace.operators.windows import Split
from millrace.sources.history import KeptHistory
from millrace.sources.versions import VersionedTable

SCHEMA = "k long, ts timestamp_ntz, n long, c string, other int"


def log_of(spark, rows):
    return spark.createDataFrame([(k, None if t is None else datetime(2024, 1, 1 + t), n, c, 0) for k, t, n, c in rows], SCHEMA)


def kept_in(path, hot_rows=None):
    return KeptHistory(path, "k", "ts", "n", ["c"], Split(hot_rows=hot_rows))


def show(df):
    return sorted((tuple(r) for r in df.select("k", "n", "c", "valid_from", "valid_to", "is_current").collect()), key=str)


@pytest.mark.parametrize("hot", [2, 10**9])
def test_any_order_of_delivery_gives_the_same_history(spark, new_path, hot):
    rng = random.Random(hot)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([*range(20), None]), n, rng.choice(["a", "b", None])) for n in range(160)]
    whole = show(changes.scd2(log_of(spark, rows), "k", "ts", "n", ["c"], Split(hot_rows=10**9)))
    rng.shuffle(rows)
    kept = kept_in(new_path(), hot)
    kept.create(log_of(spark, []), 4)
    for batch in (rows[:60], rows[60:61] + rows[:20], rows[61:]):
        kept.add(log_of(spark, batch))
    assert show(kept.read(spark)) == whole


def test_a_late_change_between_two_equal_ones(spark, new_path):
    kept = kept_in(new_path())
    kept.create(log_of(spark, []), 2)
    kept.add(log_of(spark, [(1, 1, 1, "a"), (1, 5, 2, "a")]))
    assert kept.read(spark).count() == 1
    kept.add(log_of(spark, [(1, 3, 3, "b")]))
    at = lambda day: datetime(2024, 1, 1 + day)
    assert show(kept.read(spark)) == [(1, 1, "a", at(1), at(3), False), (1, 2, "a", at(5), None, True), (1, 3, "b", at(3), at(5), False)]


def test_only_parts_with_changes_are_written(spark, new_path):
    kept = kept_in(new_path())
    kept.create(log_of(spark, []), 16)
    kept.add(log_of(spark, [(k, 1, k, "a") for k in range(200)]), ("feed", 0))
    table = VersionedTable(spark, kept.path)
    before, first = table.manifest(), kept.read(spark)
    old = show(first)
    assert kept.add(log_of(spark, [(7, 2, 900, "b")]), ("feed", 1)) == 3
    after = table.manifest()
    assert sum(before.folders[p] != after.folders[p] for p in before.folders) == 1
    assert kept.add(log_of(spark, [(7, 2, 900, "b")]), ("feed", 1)) == 3
    assert show(first) == old == show(kept.read(spark, 2))
    assert {r for r in show(kept.read(spark)) if r[0] != 7} == {r for r in old if r[0] != 7}
    # Without a token a repeated batch writes a version with the same rows.
    kept.add(log_of(spark, [(7, 2, 900, "b")]))
    assert same(kept.read(spark), kept.read(spark, 3))
