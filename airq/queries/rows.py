"""Projections, filters and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq.functions.geo import REGION
from airq.operators.clean import complete, earliest, inside, negative_to_null, lenient_number, sentinel_to_null, since, without_type
from airq.operators.quality import counted_keys, distinct_per_group, draw_thresholds, hashed_sample, lifetime_summary, random_sample
from airq.operators.scale import keep_keys
from airq.queries.base import OBS, PLACED, observations, placed, query, sql_stamp, stamp, table
from airq.sources.tables import row_count


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, folder):
    return row_count(table(spark, folder, "lineitem"))


@query(
    "rename_drop",
    "SELECT event_id, user_id AS dwd_id, event_type AS variable, value FROM events",
)
def _(spark, folder):
    return table(spark, folder, "events").drop("ts", "props").withColumnsRenamed({"user_id": "dwd_id", "event_type": "variable"})


@query("equality_filter", "SELECT event_id, user_id AS sensor_id, CAST(value AS DOUBLE) AS value FROM events WHERE event_type = 'view'")
def _(spark, folder):
    rows = table(spark, folder, "events").where(F.col("event_type") == "view")
    return rows.select("event_id", F.col("user_id").alias("sensor_id"), "value")


@query(
    "complete_rows",
    "SELECT event_id, CASE WHEN value >= 10 THEN value END AS value FROM events WHERE value >= 10",
)
def _(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.when(F.col("value") >= 10, F.col("value")).alias("value"))
    return complete(rows, ["value"])


@query(
    "bbox_filter",
    f"WITH {PLACED} SELECT event_id, sensor_id, lat, lon FROM placed WHERE lat > CAST(48.3 AS DOUBLE) "
    "AND lat < CAST(49.1 AS DOUBLE) AND lon > CAST(8.9 AS DOUBLE) AND lon < CAST(9.5 AS DOUBLE)",
)
def _(spark, folder):
    return inside(placed(spark, folder), REGION).select("event_id", "sensor_id", "lat", "lon")


@query("in_filter", "SELECT event_id, user_id FROM events WHERE event_type IN ('view', 'click')")
def _(spark, folder):
    return table(spark, folder, "events").where(F.col("event_type").isin("view", "click")).select("event_id", "user_id")


@query(
    "not_equal_null_safe",
    "SELECT event_id, sensor_type FROM (SELECT event_id, nullif(event_type, 'error') AS sensor_type FROM events) "
    "WHERE sensor_type <> 'purchase'",
)
def _(spark, folder):
    typed = table(spark, folder, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("sensor_type"))
    return without_type(typed, "purchase")


_COLUMNS = "l_orderkey, l_linenumber"


@query(
    "sentinel_to_null",
    f"SELECT {_COLUMNS}, CASE WHEN l_quantity <> 50 THEN l_quantity END AS l_quantity, "
    "CASE WHEN l_tax <> 50 THEN l_tax END AS l_tax FROM lineitem",
)
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return sentinel_to_null(rows, ["l_quantity", "l_tax"], (50.0,))


@query("negative_to_null", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS value FROM customer")
def _(spark, folder):
    return negative_to_null(table(spark, folder, "customer").select("c_custkey", F.col("c_acctbal").alias("value")))


@query(
    "lenient_cast",
    "SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS value "
    "FROM events",
)
def _(spark, folder):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("event_id").cast("string"))
    return lenient_number(table(spark, folder, "events").select("event_id", text.alias("value")))


@query(
    "label_recode",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN 'sensor' ELSE 'station' END AS label, "
    "'sensor_' || user_id AS id, event_type || 'DWD' AS variable FROM events",
)
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", "sensor").otherwise("station").alias("label"),
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        F.concat("event_type", F.lit("DWD")).alias("variable"),
    )


@query(
    "struct_access",
    "SELECT event_id, year(ts) AS year, value AS v FROM events WHERE month(ts) = 1",
)
def _(spark, folder):
    packed = table(spark, folder, "events").select(
        "event_id", F.struct(F.year("ts").cast("long").alias("year"), F.month("ts").alias("month"), F.col("value").alias("v")).alias("d")
    )
    return packed.where(F.col("d.month") == 1).select("event_id", "d.year", "d.v")


@query(
    "column_arithmetic",
    "SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity AS diff, abs(l_discount - l_tax) AS gap, "
    "l_quantity * CAST(1.60934 AS DOUBLE) AS km, round(pow(sqrt(l_quantity), 3), 6) AS p, CAST(l_orderkey % 60 AS BIGINT) AS m "
    "FROM lineitem",
)
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") - F.col("l_quantity")).alias("diff"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        (F.col("l_quantity") * F.lit(1.60934)).alias("km"),
        F.round(F.pow(F.sqrt("l_quantity"), F.lit(3.0)), 6).alias("p"),
        (F.col("l_orderkey") % 60).alias("m"),
    )


@query("distinct_rows", "SELECT DISTINCT user_id AS sensor_id, event_type AS variable FROM events")
def _(spark, folder):
    return observations(spark, folder).select("sensor_id", "variable").distinct()


@query(
    "union_distinct",
    "SELECT c_nationkey AS id FROM customer UNION SELECT s_nationkey FROM supplier",
)
def _(spark, folder):
    one = table(spark, folder, "customer").select(F.col("c_nationkey").alias("id"))
    return one.unionByName(table(spark, folder, "supplier").select(F.col("s_nationkey").alias("id"))).distinct()


@query(
    "nonunique_keys",
    f"WITH {OBS} SELECT sensor_id, variable, count(*) AS n FROM obs GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, folder):
    return counted_keys(observations(spark, folder), ["sensor_id", "variable"], 1)


@query("distinct_pairs_per_group", "SELECT event_type AS variable, count(DISTINCT user_id) AS n FROM events GROUP BY 1")
def _(spark, folder):
    return distinct_per_group(observations(spark, folder), "variable", "sensor_id")


@query(
    "lifetime_summary",
    f"WITH {OBS} SELECT sensor_id, variable, {sql_stamp('min(timestamp)')} AS first, {sql_stamp('max(timestamp)')} AS last, "
    "count(*) AS n FROM obs GROUP BY 1, 2",
)
def _(spark, folder):
    found = lifetime_summary(observations(spark, folder), ["sensor_id", "variable"])
    return found.withColumns({"first": stamp("first"), "last": stamp("last")})


@query(
    "min_year_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) >= "
    "(SELECT min(year(l_shipdate)) + 2 FROM lineitem)",
)
def _(spark, folder):
    years = table(spark, folder, "lineitem").select((F.year("l_shipdate") + 2).alias("year"))
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return since(orders, earliest(years, "year"), "year").select("o_orderkey", "o_custkey")


@query(
    "semi_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
)
def _(spark, folder):
    wanted = table(spark, folder, "customer").where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("o_custkey"))
    return keep_keys(table(spark, folder, "orders"), wanted, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("sorted_head", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 20")
def _(spark, folder):
    rows = table(spark, folder, "events").orderBy(F.col("value").desc(), F.col("event_id")).limit(20)
    return rows.select("event_id", "user_id", "value")


@query("sample_by_hash", "SELECT event_id, user_id FROM events WHERE CAST('0x' || md5(CAST(user_id AS VARCHAR))[1:8] AS BIGINT) % 10 = 3")
def _(spark, folder):
    return hashed_sample(table(spark, folder, "events"), "user_id", 10, 3).select("event_id", "user_id")


def _uniform(seed: int) -> str:
    return f"CAST('0x' || md5('{seed}:' || event_id)[1:13] AS BIGINT) / CAST({2**52} AS DOUBLE)"


_DRAWN = f"len(list_filter({draw_thresholds(0.1)!r}, lambda t: t <= {_uniform(42)}))"


@query("random_sample", f"SELECT event_id, value FROM (SELECT event_id, value, unnest(range({_DRAWN})) AS copy FROM events)")
def _(spark, folder):
    return random_sample(table(spark, folder, "events"), ["event_id"], 0.1).select("event_id", "value")


@query("random_sample_once", f"SELECT event_id, value FROM events WHERE {_uniform(7)} < 0.25")
def _(spark, folder):
    rows = random_sample(table(spark, folder, "events"), ["event_id"], 0.25, with_replacement=False, seed=7)
    return rows.select("event_id", "value")


@query(
    "random_sample_facts",
    "SELECT true AS only_given_rows, true AS share_is_near, true AS repeats_occur",
)
def _(spark, folder):
    """What holds of a sample with replacement, whatever rows it draws: all are given rows, and about the share asked for."""
    rows = table(spark, folder, "events").select("event_id", "value")
    drawn = random_sample(rows, ["event_id"], 0.5).groupBy("event_id", "value").agg(F.count(F.lit(1)).alias("drawn"))
    both = rows.withColumn("given", F.lit(1)).join(drawn, ["event_id", "value"], "full")
    return both.agg(
        (F.count("given") == F.count(F.lit(1))).alias("only_given_rows"),
        (F.abs(F.sum("drawn") / F.sum("given") - 0.5) < 0.1).alias("share_is_near"),
        (F.max("drawn") > 1).alias("repeats_occur"),
    )
