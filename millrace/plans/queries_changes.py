"""Deduplication, change-data and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes, quality
from millrace.operators.skew import HOT_ROWS
from millrace.plans.registry import query
from millrace.operators.windows import Split
from millrace.plans.shapes import HOT
from millrace.session import shared_path
from millrace.sources import keyed
from millrace.sources.history import KeptHistory

_AGAIN = "(SELECT * FROM #upd UNION ALL SELECT * FROM #upd WHERE record_id % 10 = 0)"
_LWW = "QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1"
_SHOW = "cust_id, record_id, city, operation, updated_at::VARCHAR AS updated_at"


def _show(df):
    return df.select("cust_id", "record_id", "city", "operation", "updated_at")


@query("c01_dedup_rows", "SELECT DISTINCT record_id, cust_id, city, updated_at::VARCHAR AS updated_at FROM " + _AGAIN)
def _(t):
    return changes.dedup_rows(t.redelivered.select("record_id", "cust_id", "city", "updated_at"))


@query("c02_dedup_any", f"SELECT DISTINCT record_id FROM {_AGAIN}")
def _(t):
    return changes.dedup_any(t.redelivered, ["record_id"]).select("record_id")


@query("c03_dedup_latest", f"""SELECT city, cust_id, record_id FROM {_AGAIN}
    QUALIFY row_number() OVER (PARTITION BY city ORDER BY updated_at DESC, record_id DESC) = 1""")
def _(t):
    log = t.redelivered.select("city", "cust_id", "record_id", "updated_at")
    return changes.dedup_latest(log, "city", ["updated_at", "record_id"]).drop("updated_at")


@query("c04_last_write_wins", f"SELECT {_SHOW} FROM #upd {_LWW}")
def _(t):
    return _show(changes.last_write_wins(t.upd, "cust_id", "updated_at", "record_id"))


@query("c05_apply_batches", f"SELECT {_SHOW} FROM #upd {_LWW}")
def _(t):
    early = t.upd.where("updated_at < TIMESTAMP_NTZ '2024-01-20'")
    batches = [early, t.upd.where("updated_at >= TIMESTAMP_NTZ '2024-01-10'"), early]
    return _show(changes.apply_batches(batches, "cust_id", "updated_at", "record_id"))


@query("c06_batch_diff", """WITH a AS (SELECT DISTINCT cust_id FROM #ord WHERE order_date < DATE '1996-01-01'),
    b AS (SELECT DISTINCT cust_id FROM #ord WHERE order_date >= DATE '2001-01-01')
    SELECT count(*) FILTER (b.cust_id IS NULL) AS only_a, count(*) FILTER (a.cust_id IS NULL) AS only_b
    FROM a FULL JOIN b ON a.cust_id = b.cust_id""")
def _(t):
    day = F.col("order_date")
    return changes.batch_diff(t.ord.where(day < "1996-01-01"), t.ord.where(day >= "2001-01-01"), "cust_id")


@query("c07_scd1", f"""WITH u AS (SELECT * FROM #upd {_LWW})
    SELECT c.cust_id, coalesce(u.cust_name, c.cust_name) AS cust_name, coalesce(u.city, c.city) AS city,
    c.signup_date::VARCHAR AS signup_date FROM #cust c LEFT JOIN u ON u.cust_id = c.cust_id""")
def _(t):
    return changes.scd1(t.cust, changes.last_write_wins(t.upd, "cust_id", "updated_at", "record_id"), "cust_id")


_SCD2 = """starts AS (SELECT * FROM (SELECT *, lag(city) OVER (PARTITION BY cust_id ORDER BY updated_at, record_id) AS p
    FROM #upd) WHERE p IS NULL OR p <> city),
    versions AS (SELECT cust_id, city, record_id, updated_at AS valid_from,
    lead(updated_at) OVER (PARTITION BY cust_id ORDER BY updated_at, record_id) AS valid_to FROM starts)"""


def _history(t, hot_rows=HOT_ROWS):
    return changes.scd2(t.upd, "cust_id", "updated_at", "record_id", ["city"], Split(hot_rows=hot_rows))


_VERSIONS = f"""WITH {_SCD2} SELECT cust_id, city, record_id, valid_from::VARCHAR AS valid_from,
    valid_to::VARCHAR AS valid_to, valid_to IS NULL AS is_current FROM versions"""


@query("c08_scd2", _VERSIONS)
def _(t):
    return _history(t)


@query("c08_scd2_split", _VERSIONS)
def _(t):
    return _history(t, HOT)


@query("c08_scd2_spliced", _VERSIONS)
def _(t):
    # The second half of the month comes first, then the first days, and the days between last, with some changes again.
    kept = KeptHistory(shared_path(t.spark, "history"), "cust_id", "updated_at", "record_id", ["city"])
    kept.create(t.upd, 16)
    day = F.dayofmonth("updated_at")
    for number, part in enumerate([day > 15, day < 6, (day >= 6) & (day <= 20)]):
        kept.add(t.upd.where(part), ("changes", number))
    return kept.read(t.spark)


@query("c08_scd2_untimed", """WITH u AS (SELECT cust_id, record_id, city, CASE WHEN city <> 'error' THEN updated_at END AS since FROM #upd),
    held AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY cust_id, since ORDER BY record_id DESC) = 1),
    starts AS (SELECT * FROM held WINDOW w AS (PARTITION BY cust_id ORDER BY since NULLS FIRST)
        QUALIFY row_number() OVER w = 1 OR lag(city) OVER w <> city)
    SELECT cust_id, city, record_id, since::VARCHAR AS valid_from, (lead(since) OVER w)::VARCHAR AS valid_to, lead(since) OVER w IS NULL AS is_current
    FROM starts WINDOW w AS (PARTITION BY cust_id ORDER BY since NULLS FIRST)""")
def _(t):
    # Changes to one of the values come without a time.
    log = t.upd.withColumn("updated_at", F.when(F.col("city") != "error", F.col("updated_at")))
    return changes.scd2(log, "cust_id", "updated_at", "record_id", ["city"], Split())


@query("c09_as_of_deletes", f"""WITH {_SCD2} SELECT e.event_id, v.city FROM events e LEFT JOIN versions v ON v.cust_id = e.user_id
    AND v.city <> 'error' AND v.valid_from <= e.ts + INTERVAL 1 HOUR AND (v.valid_to IS NULL OR e.ts + INTERVAL 1 HOUR < v.valid_to)""")
def _(t):
    facts = t["events"].select("event_id", F.col("user_id").alias("cust_id"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at"))
    kept = shared_path(t.spark, "history")
    _history(t).where("city <> 'error'").write.parquet(kept)  # an error ends a version without a next one
    found = changes.as_of(t.spark.read.parquet(kept), facts, "cust_id", "at", Split(), ["city"])
    return found.select("event_id", "city")


@query("c09_as_of", f"""WITH {_SCD2} SELECT e.event_id, v.city FROM events e LEFT JOIN versions v ON v.cust_id = e.user_id
    AND v.valid_from <= e.ts + INTERVAL 1 HOUR AND (v.valid_to IS NULL OR e.ts + INTERVAL 1 HOUR < v.valid_to)""")
def _(t):
    facts = t["events"].select("event_id", F.col("user_id").alias("cust_id"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at"))
    kept = shared_path(t.spark, "history")  # a history is a table that facts look up
    _history(t).write.parquet(kept)
    found = changes.as_of(t.spark.read.parquet(kept), facts, "cust_id", "at", Split(), ["city"])
    return found.select("event_id", "city")


_UPSERT = f"""WITH u AS (SELECT * FROM #upd WHERE updated_at >= TIMESTAMP '2024-01-25' {_LWW}),
    target AS (SELECT * FROM #cust WHERE city <> 'NATION_3')
    SELECT coalesce(t.cust_id, u.cust_id) AS cust_id, coalesce(u.cust_name, t.cust_name) AS cust_name,
    coalesce(u.city, t.city) AS city, t.signup_date::VARCHAR AS signup_date FROM target t FULL JOIN u ON t.cust_id = u.cust_id"""


def _upsert_sides(t):
    recent = t.upd.where("updated_at >= TIMESTAMP_NTZ '2024-01-25'")
    incoming = changes.last_write_wins(recent, "cust_id", "updated_at", "record_id")
    return t.cust.where("city <> 'NATION_3'"), incoming


@query("c10_upsert", _UPSERT)
def _(t):
    return changes.upsert(*_upsert_sides(t), "cust_id")


@query("c10_upsert_table", _UPSERT)
def _(t):
    target, incoming = _upsert_sides(t)
    path = shared_path(t.spark, "customers")
    keyed.write_keyed(target, path, "cust_id", 16)
    keyed.upsert_keyed(path, incoming, "cust_id", 16)
    return keyed.read_keyed(t.spark, path)


@query("c10_upsert_versions", """SELECT 'before' AS version, cust_id, city FROM #cust
    UNION ALL SELECT 'after', coalesce(t.cust_id, u.cust_id), coalesce(u.city, t.city)
    FROM #cust t FULL JOIN (SELECT * FROM #upd QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1) u
    ON t.cust_id = u.cust_id WHERE u.operation IS NULL OR u.operation <> 'DELETE'""")
def _(t):
    # A reader that opened the table before the upsert goes on with what it opened.
    path = shared_path(t.spark, "customers")
    keyed.write_keyed(t.cust, path, "cust_id", 16)
    before = keyed.read_keyed(t.spark, path)
    latest = changes.last_write_wins(t.upd, "cust_id", "updated_at", "record_id")
    keyed.upsert_keyed(path, latest, "cust_id", deleted=F.col("operation") == "DELETE", keep=2)
    sides = {"before": before, "after": keyed.read_keyed(t.spark, path)}
    first, second = (df.select(F.lit(name).alias("version"), "cust_id", "city") for name, df in sides.items())
    return first.unionByName(second)


@query("c11_apply_cdc", f"""WITH u AS (SELECT * FROM #upd {_LWW})
    SELECT coalesce(t.cust_id, u.cust_id) AS cust_id, coalesce(u.cust_name, t.cust_name) AS cust_name,
    coalesce(u.city, t.city) AS city FROM #cust t FULL JOIN u ON t.cust_id = u.cust_id
    WHERE u.operation IS NULL OR u.operation <> 'DELETE'""")
def _(t):
    target = t.cust.select("cust_id", "cust_name", "city")
    return changes.apply_cdc(target, t.upd, "cust_id", "updated_at", "record_id", "operation")


@query("c12_late_records", """WITH applied AS (SELECT cust_id, max(updated_at) AS ts FROM #upd WHERE updated_at < TIMESTAMP '2024-01-15' GROUP BY cust_id)
    SELECT u.record_id, u.cust_id, applied.ts::VARCHAR AS applied_ts FROM #upd u JOIN applied USING (cust_id)
    WHERE u.updated_at < applied.ts""")
def _(t):
    applied = t.upd.where("updated_at < TIMESTAMP_NTZ '2024-01-15'")
    late = changes.late_records(applied, t.upd, "cust_id", "updated_at")
    return late.select("record_id", "cust_id", "applied_ts")


@query("c13_backfill", "SELECT c.cust_id, coalesce(n.city, c.city) AS city FROM #cust c JOIN #nulls n USING (cust_id)")
def _(t):
    return changes.backfill(t.nulls.select("cust_id", "city"), t.cust, "cust_id", "city")


def _rules():
    return {
        "user_known": F.col("user_id") != 0, "value_positive": F.col("value") >= 1,
        "kind_allowed": F.col("event_type") != "error",
    }


@query("c14_validate", """SELECT event_id, concat_ws(',', CASE WHEN user_id = 0 THEN 'user_known' END,
    CASE WHEN value < 1 THEN 'value_positive' END, CASE WHEN event_type = 'error' THEN 'kind_allowed' END) AS broken
    FROM events""")
def _(t):
    good, bad = quality.validate(t["events"], _rules())
    rejected = bad.select("event_id", F.array_join("broken", ",").alias("broken"))
    return good.select("event_id", F.lit("").alias("broken")).unionByName(rejected)


@query("c15_profile", """WITH v AS (SELECT CASE WHEN cust_id % 9 <> 0 THEN cust_id END AS k FROM #ord),
    g AS (SELECT k, count(*) AS n FROM v GROUP BY k)
    SELECT sum(n)::BIGINT AS rows, sum(CASE WHEN k IS NULL THEN n ELSE 0 END)::BIGINT AS null_rows, count(k) AS distinct_values,
    count(*) FILTER (k IS NOT NULL AND n > 1) AS repeated_values, max(CASE WHEN k IS NOT NULL THEN n END) AS most_rows FROM g""")
def _(t):
    holes = t.ord.select(F.when(F.col("cust_id") % 9 != 0, F.col("cust_id")).alias("k"))
    return quality.profile(holes, "k")

