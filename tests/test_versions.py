from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, plan_of, same
from millrace.plans import jobs
from millrace.sources.keyed import read_keyed, upsert_keyed, write_keyed
from millrace.sources.versions import StaleVersion, VersionedTable


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v string")


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_stay_as_they_were(spark, new_path):
    table = VersionedTable.create(frame(spark, [(1, "a"), (2, "b"), (3, None), (4, "a b/ü"), (5, "n")]), new_path(), ["v"])
    first = table.read()
    base = table.manifest()
    assert sorted(base.folders) == ["n", "v.a", "v.b", "v.n", "x.6120622FC3BC"]
    assert table.replace(frame(spark, [(6, "b"), (7, None)])) == 2
    assert table.replace(table.read().where("v = 'b'").withColumn("id", F.col("id") * 10), ["v.a"]) == 3
    assert found(first) == found(table.read(1)) and first.count() == 5
    assert {r["id"] for r in table.read().collect()} == {60, 7, 4, 5}
    assert {r["id"] for r in table.read(labels=["v.b", "n", "v.missing"]).collect()} == {60, 7}
    assert table.numbers() == [1, 2, 3]
    table.forget(2)
    assert table.numbers() == [2, 3] and {r["id"] for r in table.read(2).collect()} == {1, 6, 7, 4, 5}
    with pytest.raises(ValueError):
        table.replace(spark.range(3))
    with pytest.raises(FileExistsError):
        VersionedTable.create(frame(spark, []), table.path, ["v"])
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, new_path()).read()


def test_an_emptied_table_keeps_its_columns(spark, new_path):
    table = VersionedTable.create(frame(spark, [(1, "a")]), new_path(), ["v"])
    table.replace(frame(spark, []), ["v.a"])
    assert table.read().columns == ["id", "v"] and table.read().isEmpty()


def test_changes_of_other_parts_are_kept_and_of_the_same_refused(spark, new_path):
    table = VersionedTable.create(frame(spark, [(1, "a"), (2, "b")]), new_path(), ["v"])
    base = table.manifest()
    table.replace(frame(spark, [(10, "a")]), base=base)
    table.replace(frame(spark, [(20, "b")]), base=base)
    assert found(table.read()) == [(10, "a"), (20, "b")]
    with pytest.raises(StaleVersion):
        table.replace(frame(spark, [(30, "b")]), base=base)
    assert found(table.read()) == [(10, "a"), (20, "b")]


def test_a_version_number_is_claimed_once(spark, new_path, monkeypatch):
    table = VersionedTable.create(frame(spark, [(1, "a"), (2, "b")]), new_path(), ["v"])
    store = table._stored

    def slow(df, layout):
        folders = store(df, layout)
        monkeypatch.setattr(table, "_stored", store)
        VersionedTable(spark, table.path).replace(frame(spark, [(9, "b")]))  # someone else is first
        return folders

    monkeypatch.setattr(table, "_stored", slow)
    assert table.replace(frame(spark, [(8, "a")])) == 3
    assert found(table.read()) == [(8, "a"), (9, "b")]
    assert not table._publish(table.manifest())


def test_a_token_is_applied_once(spark, new_path):
    schema = "day date, kind string, n long"
    table = VersionedTable.create(spark.createDataFrame([], schema), new_path(), ["day"])
    delta = spark.sql("SELECT DATE'2024-01-01' AS day, 'x' AS kind, 2L AS n UNION ALL SELECT NULL, 'x', 3L")
    for token in [("s", 0), ("s", 0), ("s", 1), ("other", 0), ("s", 0)]:
        jobs.fold_into_versions(table, delta, ["day", "kind"], ["n"], token)
    assert sorted(r["n"] for r in table.read().collect()) == [6, 9]


KILLED = """
    import glob, os, signal, sys, threading, time
    sys.path.insert(0, {root!r})
    from millrace.session import build_session
    from millrace.sources.keyed import upsert_keyed
    from pyspark.sql import functions as F

    spark = build_session("killed", "local[1]", {{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": {scratch!r}}})

    def watch():
        before = set(os.listdir({path!r} + "/data"))
        while True:
            for load in set(os.listdir({path!r} + "/data")) - before:
                if glob.glob({path!r} + "/data/" + load + "/_temporary/**/_label=*", recursive=True):
                    os.kill(spark.sparkContext._gateway.proc.pid, signal.SIGKILL)
                    os._exit(1)
            time.sleep(0.001)

    threading.Thread(target=watch, daemon=True).start()
    upsert_keyed({path!r}, spark.range(0, 100).select("id", F.lit("new").alias("v")), "id")
    print("finished")
"""


def test_a_killed_upsert_leaves_the_old_version_whole(spark, new_path, tmp_path):
    path = new_path().removeprefix("file:")
    old = spark.range(0, 80).select("id", F.lit("old").alias("v"))
    write_keyed(old, path, "id", 8)
    script = tmp_path / "killed.py"
    script.write_text(textwrap.dedent(KILLED).format(root=ROOT, scratch=str(tmp_path), path=path))
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode != 0 and "finished" not in done.stdout
    assert VersionedTable(spark, path).numbers() == [1] and same(read_keyed(spark, path), old)
    upsert_keyed(path, spark.range(0, 100).select("id", F.lit("new").alias("v")), "id")
    after = read_keyed(spark, path)
    assert after.count() == 100 and after.where("v = 'old'").isEmpty()
    # What the dead job had written is gone as well.
    loads = {f.split("/")[1] for f in VersionedTable(spark, path).manifest().folders.values()}
    assert set(os.listdir(f"{path}/data")) == loads


def test_landing_knows_earlier_deliveries(spark, new_path):
    def land(rows, batch, **kw):
        events = spark.createDataFrame(rows, "event_id long, at string, v int").withColumn("at", F.col("at").cast("timestamp_ntz"))
        return jobs.land_new(events, path, "event_id", ["v"], "at", {"at": F.col("at").isNotNull()}, batch, **kw)

    def landed():
        return sorted((r["event_id"], str(r["day"]), r["v"], r["batch"]) for r in VersionedTable(spark, path).read().collect())

    path = new_path()
    first = [(1, "2024-01-01 10:00", 1), (1, "2024-01-01 11:00", 2), (2, "2024-01-02 00:00", 1), (3, None, 1)]
    assert [r["event_id"] for r in land(first, 1).collect()] == [3]
    held = [(1, "2024-01-01", 2, 1), (2, "2024-01-02", 1, 1)]
    assert landed() == held
    land(first, 2)
    land([(9, "2024-01-01 10:00", 1)], 2)  # number two has been landed
    land([], 3)
    assert landed() == held
    land([(1, "2024-01-01 12:00", 7), (4, "2024-01-01 12:00", 7), (2, "2024-01-03 12:00", 7)], 4, days_apart=1)
    held = [*held, (4, "2024-01-01", 7, 4)]
    assert landed() == held
    land([(2, "2024-02-01 12:00", 8)], 5, days_apart=None)
    assert landed() == held
    land([(2, "2024-02-01 12:00", 8)], 6)  # another day, which the caller says can't be
    assert landed() == sorted([*held, (2, "2024-02-01", 8, 6)])


def test_landing_reads_ids_of_the_days_in_reach_only(spark, new_path, monkeypatch):
    path, rules, seen = new_path(), {}, []
    days = spark.range(0, 60).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 20 as int))").alias("at"))
    jobs.land_new(days, path, "event_id", ["at"], "at", rules, 1)
    replace = VersionedTable.replace
    monkeypatch.setattr(VersionedTable, "replace", lambda self, df, *a, **kw: seen.append(df) or replace(self, df, *a, **kw))
    jobs.land_new(days.where("event_id % 20 = 3"), path, "event_id", ["at"], "at", rules, 2)
    files = [f for f in seen[0].inputFiles() if "_label=" in f]
    assert files and all("2024-01-04" in f for f in files)
    assert "ReadSchema: struct<event_id:bigint>" in plan_of(seen[0])
    assert VersionedTable(spark, path).read().count() == 60
