"""Scalar function queries: text, dates, nested types, user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, nested, nulls, text, udfs
from millrace.operators.aggregates import money
from millrace.plans.registry import query


@query("f01_text_case", "SELECT id, trim(value) AS trimmed, upper(trim(value)) AS upper, lower(trim(value)) AS lower FROM #names")
def _(t):
    return text.text_case(t.names, "value").drop("value")


@query("f02_text_prefix", "SELECT p_partkey, substr(p_name, 1, 3) AS prefix FROM part")
def _(t):
    return text.text_prefix(t["part"].select("p_partkey", "p_name"), "p_name", 3).drop("p_name")


@query("f03_split_words", """SELECT id, len(w) AS words, w[1] AS head FROM
    (SELECT id, regexp_split_to_array(trim(value), '\\s+') AS w FROM #names)""")
def _(t):
    return text.split_words(t.names, "value").select("id", F.size("words").alias("words"), F.col("words")[0].alias("head"))


@query("f04_extract", "SELECT event_id, regexp_extract(value, 'user=(\\d+)', 1) AS match FROM #logs")
def _(t):
    return text.extract(t.logs, "value", r"user=(\d+)").drop("value")


@query("f05_mask", "SELECT event_id, regexp_replace(value, '\\d+', '#', 'g') AS value FROM #logs")
def _(t):
    return text.mask(t.logs, "value", r"\d+", "#")


# The layout of a log line, one pattern per field.
LOG_FIELDS = {
    "at": r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})",
    "level": r"(INFO|WARN|ERROR)",
    "user": r"user=(\d+)",
    "action": r"action=(\w+)",
}


@query("f06_parse_log", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
    CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level, user_id::VARCHAR AS user, event_type AS action
    FROM events""")
def _(t):
    return text.parse_log(t.logs, "value", LOG_FIELDS).drop("value")


@query("f07_concat", "SELECT cust_id, 'Customer_' || cust_id || '@' || city AS label FROM #cust")
def _(t):
    parts = [F.lit("Customer_"), F.col("cust_id").cast("string"), F.lit("@"), F.col("city")]
    return text.concat_cols(t.cust, "label", *parts).select("cust_id", "label")


@query("f08_arith", """SELECT event_id, event_id + k AS added, event_id * k AS multiplied,
    CASE WHEN k <> 0 THEN event_id / k END AS divided, CASE WHEN k <> 0 THEN event_id % k END AS remainder
    FROM (SELECT event_id, user_id % 5 AS k FROM events)""")
def _(t):
    pairs = t["events"].select("event_id", (F.col("user_id") % 5).alias("k"))
    return nulls.arith(pairs, "event_id", "k").drop("k")


@query("f10_greatest_least", """SELECT p_partkey, greatest(p_size * 30.0::DOUBLE, p_retailprice) AS greatest,
    least(p_size * 30.0::DOUBLE, p_retailprice) AS least FROM part""")
def _(t):
    part = t["part"].select("p_partkey", (F.col("p_size") * F.lit(30.0)).alias("s"), "p_retailprice")
    both = nulls.least_of(nulls.greatest_of(part, ["s", "p_retailprice"]), ["s", "p_retailprice"])
    return both.select("p_partkey", "greatest", "least")


@query("f11_fill_expr", "SELECT cust_id, coalesce(city, 'unknown') AS city FROM #nulls")
def _(t):
    return nulls.fill_expr(t.nulls, "city", F.lit("unknown")).select("cust_id", "city")


@query("f12_fill_nulls", """SELECT cust_id, coalesce(cust_name, 'nobody') AS cust_name,
    coalesce(city, 'nowhere') AS city FROM #nulls""")
def _(t):
    return nulls.fill_nulls(t.nulls, {"cust_name": "nobody", "city": "nowhere"})


@query("f13_drop_nulls", """SELECT 'any' AS how, cust_id FROM #nulls WHERE cust_name IS NOT NULL AND city IS NOT NULL
    UNION ALL SELECT 'all', cust_id FROM #nulls WHERE cust_name IS NOT NULL OR city IS NOT NULL""")
def _(t):
    kept = [
        nulls.drop_nulls(t.nulls, how, ["cust_name", "city"]).select(F.lit(how).alias("how"), "cust_id")
        for how in ("any", "all")
    ]
    return kept[0].unionByName(kept[1])


@query("f14_cast", """SELECT event_id, event_id::VARCHAR AS id_text, floor(value)::BIGINT AS whole,
    try_cast(event_type AS INTEGER) AS not_a_number FROM events""")
def _(t):
    df = t["events"].select(
        "event_id", F.col("event_id").alias("id_text"), F.floor("value").alias("whole"),
        F.col("event_type").alias("not_a_number"),
    )
    strict = nulls.cast_cols(df, {"id_text": "string", "whole": "bigint"})
    return nulls.cast_cols(strict, {"not_a_number": "int"}, strict=False)


@query("d01_date_parts", """SELECT order_id, year(order_date) AS year, quarter(order_date) AS quarter,
    month(order_date) AS month, day(order_date) AS day, dayofweek(order_date) + 1 AS dow,
    dayofyear(order_date) AS doy, week(order_date) AS week FROM #ord""")
def _(t):
    return dates.date_parts(t.ord.select("order_id", "order_date"), "order_date").drop("order_date")


@query("d02_days_since", "SELECT order_id, date_diff('day', order_date, DATE '2002-01-01') AS days FROM #ord")
def _(t):
    return dates.days_since(t.ord, "order_date", "2002-01-01").select("order_id", "days")


@query("d03_format_date", "SELECT event_id, strftime(ts, '%d.%m.%Y %H:%M') AS text FROM events")
def _(t):
    return dates.format_date(t["events"], "ts", "dd.MM.yyyy HH:mm").select("event_id", "text")


@query("d04_parse_date", "SELECT id, CASE WHEN id % 4 <> 3 THEN truth END::VARCHAR AS date FROM #raw_dates")
def _(t):
    # The date formats the text may have.
    formats = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd"]
    return dates.parse_date(t.raw_dates, "value", formats).select("id", "date")


@query("d05_parse_ts", """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END::VARCHAR AS ts
    FROM events""")
def _(t):
    written = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    raw = t["events"].select("event_id", written.alias("text"))
    return dates.parse_ts(raw, "text", "yyyy-MM-dd HH:mm:ss").select("event_id", "ts")


@query("d06_truncate", """SELECT event_id, CAST(date_trunc('week', ts) AS DATE)::VARCHAR AS week,
    CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, CAST(date_trunc('quarter', ts) AS DATE)::VARCHAR AS quarter,
    date_trunc('hour', ts)::VARCHAR AS hour FROM events""")
def _(t):
    return dates.truncate(t["events"].select("event_id", "ts"), "ts", ["week", "month", "quarter", "hour"]).drop("ts")


@query("d07_add_time", """SELECT order_id, CAST(order_date + INTERVAL 1 MONTH AS DATE)::VARCHAR AS moved,
    (order_date::TIMESTAMP + INTERVAL 90 MINUTE)::VARCHAR AS later FROM #ord""")
def _(t):
    moved = dates.add_time(t.ord, "order_date", months=1)
    at = moved.withColumn("at", F.col("order_date").cast("timestamp_ntz"))
    return dates.add_time(at, "at", interval="90 MINUTES", name="later").select("order_id", "moved", "later")


@query("d08_shift_days", """SELECT order_id, CAST(order_date + 10 AS DATE)::VARCHAR AS shifted,
    CAST(order_date - 10 AS DATE)::VARCHAR AS before FROM #ord""")
def _(t):
    moved = dates.shift_days(dates.shift_days(t.ord, "order_date", 10), "order_date", -10, "before")
    return moved.select("order_id", "shifted", "before")


@query("d09_months_between", """SELECT order_id, round(CASE WHEN day(b) = day(a) OR (b = last_day(b) AND a = last_day(a)) THEN m
    ELSE m + (day(b) - day(a)) / 31.0::DOUBLE END, 6) AS months FROM (SELECT order_id, a, b,
    ((year(b) - year(a)) * 12 + month(b) - month(a))::DOUBLE AS m FROM
    (SELECT order_id, order_date AS a, DATE '2001-12-31' AS b FROM #ord))""")
def _(t):
    df = t.ord.withColumn("until", F.lit("2001-12-31").cast("date"))
    return dates.months_between_cols(df, "until", "order_date").select("order_id", F.round("months", 6).alias("months"))


@query("d10_epoch", "SELECT event_id, floor(epoch(ts))::BIGINT AS epoch, date_trunc('second', ts)::VARCHAR AS back FROM events")
def _(t):
    return dates.epoch(t["events"].select("event_id", "ts"), "ts").drop("ts")


@query("d11_to_zone", """SELECT event_id, (ts + INTERVAL 330 MINUTE)::VARCHAR AS kolkata,
    (ts - INTERVAL 330 MINUTE)::VARCHAR AS utc FROM events""")
def _(t):
    there = dates.to_zone(t["events"], "ts", "UTC", "Asia/Kolkata", "kolkata")
    return dates.to_zone(there, "ts", "Asia/Kolkata", "UTC", "utc").select("event_id", "kolkata", "utc")


@query("d12_stamp", "SELECT 1 AS clock_values, count(*) AS rows FROM events")
def _(t):
    stamped = dates.stamp(t["events"].select("event_id"))
    return stamped.agg(F.count_distinct("run_at").alias("clock_values"), F.count("*").alias("rows"))


@query("d13_calendar_fill", """WITH grid AS (SELECT city, CAST(m AS DATE) AS month FROM (SELECT DISTINCT city FROM #cust)
    CROSS JOIN generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH) s(m)),
    totals AS (SELECT city, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(money) AS total
    FROM #ord JOIN #cust USING (cust_id) GROUP BY 1, 2)
    SELECT city, month::VARCHAR AS month, coalesce(total, 0)::DOUBLE AS total FROM grid LEFT JOIN totals USING (city, month)""")
def _(t):
    placed = t.ord.join(t.cust.select("cust_id", "city"), "cust_id")
    monthly = placed.groupBy("city", F.trunc("order_date", "month").alias("month")).agg(F.sum(money("amount")).alias("total"))
    return dates.calendar_fill_by(monthly, ["city"], "month", "1 MONTH", "1995-01-01", "2001-08-01", {"total": 0})


@query("d14_compare_dates", """SELECT earlier, earlier_as_text, count(*) AS rows FROM (SELECT a < b AS earlier,
    strftime(a, '%m/%d/%Y') < strftime(b, '%m/%d/%Y') AS earlier_as_text FROM
    (SELECT order_date AS a, order_date + CAST(order_id % 700 - 350 AS INTEGER) AS b FROM #ord)) GROUP BY ALL""")
def _(t):
    other = F.date_add("order_date", (F.col("order_id") % 700 - 350).cast("int"))
    pairs = t.ord.select(
        F.date_format("order_date", "MM/dd/yyyy").alias("a"), F.date_format(other, "MM/dd/yyyy").alias("b")
    )
    compared = dates.compare_dates(pairs, "a", "b", "MM/dd/yyyy")
    return compared.groupBy("earlier", "earlier_as_text").agg(F.count("*").alias("rows"))


@query("n01_struct_field", "SELECT emp_id, city FROM #emp")
def _(t):
    return nested.struct_field(t.emp, "address.city", "city").select("emp_id", "city")


@query("n02_nest", """SELECT cust_id, city || '/' || signup_date AS place FROM #cust""")
def _(t):
    packed = nested.nest(t.cust.select("cust_id", "city", "signup_date"), "home", ["city", "signup_date"])
    return packed.select("cust_id", F.concat_ws("/", "home.city", F.col("home.signup_date").cast("string")).alias("place"))


@query("n03_explode_array", "SELECT emp_id, unnest(skills) AS skill FROM #emp")
def _(t):
    return nested.explode_array(t.emp, "skills", "skill").select("emp_id", "skill")


@query("n04_map_get", "SELECT emp_id, size, CAST(NULL AS INTEGER) AS weight FROM #emp")
def _(t):
    found = nested.map_get(nested.map_get(t.emp, "scores", "size", "size"), "scores", "weight", "weight")
    return found.select("emp_id", "size", "weight")


@query("n05_nested_filter", "SELECT emp_id, name FROM #emp WHERE city = 'Brand#3' AND list_contains(skills, 'blue')")
def _(t):
    return nested.nested_filter(t.emp, "address.city", "Brand#3", "skills", "blue").select("emp_id", "name")


@query("n06_map_avg", """SELECT city, entry, sum(v)::DOUBLE / count(v) AS average FROM (SELECT city, 'size' AS entry, size AS v FROM #emp
    UNION ALL SELECT city, 'price', price FROM #emp) GROUP BY city, entry""")
def _(t):
    return nested.map_avg(t.emp.select(F.col("address.city").alias("city"), "scores"), ["city"], "scores")


def _text(name):
    return F.array_join(F.transform(name, lambda x: x.cast("bigint").cast("string")), ",").alias(name)


@query("n07_array_map", """SELECT id, part, array_to_string(list_transform(items, lambda x: CAST(x * 2 AS BIGINT)), ',') AS doubled
    FROM #items""")
def _(t):
    return nested.array_map(t.items, "items", lambda x: x * 2, "doubled").select("id", "part", _text("doubled"))


@query("n08_array_filter", """SELECT id, part, array_to_string(list_transform(list_filter(items, lambda x: x > 25),
    lambda x: CAST(x AS BIGINT)), ',') AS large FROM #items""")
def _(t):
    return nested.array_filter(t.items, "items", lambda x: x > 25, "large").select("id", "part", _text("large"))


@query("n09_array_any", "SELECT id, bool_or(len(list_filter(items, lambda x: x > 45)) > 0) AS has_large FROM #items GROUP BY id")
def _(t):
    # A long list lies in several parts; an id has one answer.
    parts = nested.array_any(t.items, "items", lambda x: x > 45, "has_large")
    return parts.groupBy("id").agg(F.bool_or("has_large").alias("has_large"))


@query("n10_array_sum", "SELECT id, sum(list_sum(items)) AS total FROM #items GROUP BY id")
def _(t):
    return nested.array_sum(t.items, "items", "total").groupBy("id").agg(F.sum("total").alias("total"))


@query("n11_json_fields", "SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?\\d+)', 1) AS INTEGER) AS k FROM events")
def _(t):
    return nested.json_fields(t["events"].select("event_id", "props"), "props", "k int", {"k": "k"}).drop("props")


_REVENUE = "SELECT region, round(sum(units * price), 2) AS revenue FROM #sales GROUP BY region"


def _by_region(df):
    return df.groupBy("region").agg(F.round(F.sum("revenue"), 2).alias("revenue"))


@query("x01_revenue_udf", _REVENUE)
def _(t):
    return _by_region(t.sales.withColumn("revenue", udfs.revenue_udf("units", "price")))


@query("x01_revenue_udf_sql", _REVENUE)
def _(t):
    udfs.register_revenue(t.spark)
    return t.spark.sql(
        "SELECT region, round(sum(revenue(units, price)), 2) AS revenue FROM {sales} GROUP BY region", sales=t.sales
    )


@query("x02_revenue_expr", _REVENUE)
def _(t):
    return _by_region(t.sales.withColumn("revenue", udfs.revenue_expr("units", "price")))


@query("x03_mean_or", """SELECT cust_id, coalesce(sum(m)::DOUBLE / count(m), -1) AS mean FROM
    (SELECT cust_id, CASE WHEN amount > 300000 THEN money END AS m FROM #ord) GROUP BY cust_id""")
def _(t):
    large = F.when(F.col("amount") > 300000, money("amount"))
    return udfs.mean_or(t.ord.select("cust_id", large.alias("m")), ["cust_id"], F.col("m"), -1)


@query("x04_table_function", """SELECT emp_id, unnest(skills) AS word, unnest(range(len(skills)))::INTEGER AS position FROM #emp""")
def _(t):
    return t.emp.select("emp_id", F.posexplode(F.split("name", r"\s+")).alias("position", "word"))
