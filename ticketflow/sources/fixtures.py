"""The five ticket tables derived from the driver's test tables.

The reference reads warehouse tables (tickets, ticket performance, task log,
recharge mapping, device audit) that do not exist here; FIXTURES.md defines
each as a deterministic projection of ``orders``, ``lineitem`` and ``events``.
They are written twice, independently: as DataFrames (what the metrics read)
and as a SQL ``WITH`` prefix that the DuckDB oracle strings start with.
Every column is a projection of one input row, so the views are narrow
(no shuffle) and grow with the input tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ASSIGN_EVENT, TICKET_TYPE
from ..functions.timeops import days, minutes


def _mins(ts: Column, n: Column) -> Column:
    return ts + minutes(n.cast("int"))


def _days(ts: Column, n: int | Column) -> Column:
    return ts + days(n.cast("int") if isinstance(n, Column) else n)


@dataclass
class Tables:
    tasks: DataFrame
    task_performance: DataFrame
    task_logs: DataFrame
    router_user_mapping: DataFrame
    device_audit: DataFrame
    ticket_assignments: DataFrame
    # Counts per day that are stored already (``plans.daily_state``), in place of the facts.
    closures: DataFrame | None = None
    assigned: DataFrame | None = None
    # Lazy sub-plans shared by several panels (built once per config).
    memo: dict = field(default_factory=dict, repr=False, compare=False)


# Declared schemas of the driver's tables (columns used here), so a read needs
# no footer sampling to infer them.
BASE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

def read_base(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def tasks(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    created = _mins(F.col("o_orderdate"), (k * 37) % 1440)
    extra = F.concat(F.lit('{"nas_id": '), (k % 400).cast("string"), F.lit("}"))
    latest = orders.select(
        k.alias("id"),
        F.col("o_custkey").alias("partner_id"),
        created.alias("created"),
        F.when(k % 10 == 9, F.lit("INSTALL")).otherwise(F.lit(TICKET_TYPE)).alias("type"),
        F.when(F.col("o_orderstatus") == "F", F.lit(2))
         .when(F.col("o_orderstatus") == "P", F.lit(3))
         .otherwise((k % 2).cast("int")).alias("status"),
        extra.alias("extra_data"),
    )
    older = orders.filter(k % 3 == 0).select(
        k.alias("id"),
        F.col("o_custkey").alias("partner_id"),
        _mins(created, F.lit(-1440)).alias("created"),
        F.lit(TICKET_TYPE).alias("type"),
        F.when(k % 2 == 0, F.lit(3)).otherwise(F.lit(0)).alias("status"),
        extra.alias("extra_data"),
    )
    return latest.unionByName(older)


def task_performance(lineitem: DataFrame) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("reporterid"),
        F.when(part % 25 == 0, F.lit("INSTALL")).otherwise(F.lit(TICKET_TYPE)).alias("task_type"),
        F.when(supp % 8 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_mins(F.col("l_shipdate"), (part * 53) % 1440)).alias("task_resolved_time"),
        F.when(flag == "A", F.lit("ROUTER_RECOVERED"))
         .when(flag == "R", F.lit("CUSTOMER_RECOVERED"))
         .when((flag == "N") & (F.col("l_linenumber") % 2 == 0), F.lit("GENERAL"))
         .alias("task_resolution_type"),
        F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("score"),
        F.when(part % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("D"), (part % 600).cast("string"))).alias("customer_device_id"),
        (part % 20 == 1).alias("_fivetran_deleted"),
    )


def task_logs(events: DataFrame) -> DataFrame:
    return events.select(
        F.when(F.col("event_type") == "click", F.lit(ASSIGN_EVENT))
         .otherwise(F.col("event_type")).alias("event_name"),
        _days(F.col("ts"), -8218).alias("added_time"),
    )


def router_user_mapping(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    issued = _days(F.col("ts"), -8249)
    return events.select(
        (F.col("user_id") * 3).alias("router_nas_id"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("mobile"),
        F.when(F.col("event_type") == "purchase", F.lit("DONE")).otherwise(F.lit("PENDING")).alias("otp"),
        F.when(e % 17 == 0, F.lit(1)).otherwise(F.lit(0)).alias("store_group_id"),
        (e % 5 + 1).cast("int").alias("device_limit"),
        issued.alias("otp_issued_time"),
        _days(issued, e % 14 + 1).alias("otp_expiry_time"),
    )


def device_audit(events: DataFrame) -> DataFrame:
    e, t = F.col("event_id"), F.col("event_type")
    return events.select(
        F.concat(F.lit("D"), (e % 600).cast("string")).alias("device_id"),
        (F.col("user_id") * 3).alias("nas_id"),
        _days(F.col("ts"), -8218).alias("modified_time"),
        F.when(e % 4 == 0, e).alias("lco_account_id"),
        F.when(t == "error", F.lit('{"returnedBy":"RA","router_state":"returned_in_office"}'))
         .when(t == "view", F.lit('{"returnedBy":"PARTNER","router_state":"returned_in_office"}'))
         .otherwise(F.lit("{}")).alias("extra_data"),
    )


def ticket_assignments(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    created = _mins(F.col("o_orderdate"), (k * 37) % 1440)
    return orders.select(
        k.alias("ticket_id"),
        _mins(created, (F.col("o_custkey") * 71) % 2880).alias("assigned_time"),
    )


def load(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables as they are now: the files are listed anew on every call."""
    orders = read_base(spark, sf_dir, "orders",
                       ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    lineitem = read_base(spark, sf_dir, "lineitem",
                         ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                          "l_returnflag", "l_linestatus", "l_shipdate"])
    events = read_base(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return Tables(
        tasks=tasks(orders),
        task_performance=task_performance(lineitem),
        task_logs=task_logs(events),
        router_user_mapping=router_user_mapping(events),
        device_audit=device_audit(events),
        ticket_assignments=ticket_assignments(orders),
    )


# The same views for DuckDB, over its pre-registered orders / lineitem / events.
SQL_VIEWS = """
WITH tasks AS (
    SELECT o_orderkey AS id, o_custkey AS partner_id,
           o_orderdate + to_minutes(CAST((o_orderkey * 37) % 1440 AS BIGINT)) AS created,
           CASE WHEN o_orderkey % 10 = 9 THEN 'INSTALL' ELSE 'ROUTER_PICKUP' END AS type,
           CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE CAST(o_orderkey % 2 AS INTEGER) END AS status,
           '{"nas_id": ' || CAST(o_orderkey % 400 AS VARCHAR) || '}' AS extra_data
    FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey,
           o_orderdate + to_minutes(CAST((o_orderkey * 37) % 1440 AS BIGINT)) - INTERVAL 1440 MINUTE,
           'ROUTER_PICKUP',
           CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 0 END,
           '{"nas_id": ' || CAST(o_orderkey % 400 AS VARCHAR) || '}'
    FROM orders WHERE o_orderkey % 3 = 0
),
task_performance AS (
    SELECT l_orderkey AS reporterid,
           CASE WHEN l_partkey % 25 = 0 THEN 'INSTALL' ELSE 'ROUTER_PICKUP' END AS task_type,
           CASE WHEN l_suppkey % 8 = 0 THEN NULL
                ELSE l_shipdate + to_minutes(CAST((l_partkey * 53) % 1440 AS BIGINT)) END AS task_resolved_time,
           CASE WHEN l_returnflag = 'A' THEN 'ROUTER_RECOVERED'
                WHEN l_returnflag = 'R' THEN 'CUSTOMER_RECOVERED'
                WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN 'GENERAL' END AS task_resolution_type,
           CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS score,
           CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'D' || CAST(l_partkey % 600 AS VARCHAR) END AS customer_device_id,
           (l_partkey % 20 = 1) AS _fivetran_deleted
    FROM lineitem
),
task_logs AS (
    SELECT CASE WHEN event_type = 'click' THEN 'ASSIGN_TICKET_ROUTER_PICKUP' ELSE event_type END AS event_name,
           ts - INTERVAL 8218 DAY AS added_time
    FROM events
),
router_user_mapping AS (
    SELECT user_id * 3 AS router_nas_id, 'M' || CAST(user_id AS VARCHAR) AS mobile,
           CASE WHEN event_type = 'purchase' THEN 'DONE' ELSE 'PENDING' END AS otp,
           CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS store_group_id,
           CAST(event_id % 5 + 1 AS INTEGER) AS device_limit,
           ts - INTERVAL 8249 DAY AS otp_issued_time,
           ts - INTERVAL 8249 DAY + to_days(CAST(1 + event_id % 14 AS INTEGER)) AS otp_expiry_time
    FROM events
),
device_audit AS (
    SELECT 'D' || CAST(event_id % 600 AS VARCHAR) AS device_id, user_id * 3 AS nas_id,
           ts - INTERVAL 8218 DAY AS modified_time,
           CASE WHEN event_id % 4 = 0 THEN event_id END AS lco_account_id,
           CASE WHEN event_type = 'error' THEN '{"returnedBy":"RA","router_state":"returned_in_office"}'
                WHEN event_type = 'view' THEN '{"returnedBy":"PARTNER","router_state":"returned_in_office"}'
                ELSE '{}' END AS extra_data
    FROM events
),
ticket_assignments AS (
    SELECT o_orderkey AS ticket_id,
           o_orderdate + to_minutes(CAST((o_orderkey * 37) % 1440 AS BIGINT))
                       + to_minutes(CAST((o_custkey * 71) % 2880 AS BIGINT)) AS assigned_time
    FROM orders
)"""
