"""Source schemas and readers.

Production tables are read by name (catalog) or path with an explicit schema;
only the columns a metric touches are projected, so parquet scans carry a
narrow ReadSchema.  Fact tables are best stored partitioned by the UTC date of
their main time column (``write_partitioned``): the raw-time ranges the
filters emit then prune whole partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from ..operators.filters import partition_column
from pyspark.sql.types import (BooleanType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

TASKS = StructType([
    StructField("id", LongType()),
    StructField("reporter_id", LongType()),
    StructField("created", TimestampNTZType()),
    StructField("rslvd_datetime", TimestampNTZType()),
    StructField("status", IntegerType()),
    StructField("partner_id", LongType()),
    StructField("type", StringType()),
    StructField("extra_data", StringType()),
])
TASK_PERFORMANCE = StructType([
    StructField("reporterid", LongType()),
    StructField("task_type", StringType()),
    StructField("task_resolved_time", TimestampNTZType()),
    StructField("task_resolution_type", StringType()),
    StructField("score", IntegerType()),
    StructField("customer_device_id", StringType()),
    StructField("_fivetran_deleted", BooleanType()),
])
TASK_LOGS = StructType([
    StructField("event_name", StringType()),
    StructField("added_time", TimestampNTZType()),
])
ROUTER_USER_MAPPING = StructType([
    StructField("router_nas_id", LongType()),
    StructField("mobile", StringType()),
    StructField("otp", StringType()),
    StructField("store_group_id", IntegerType()),
    StructField("device_limit", IntegerType()),
    StructField("otp_issued_time", TimestampNTZType()),
    StructField("otp_expiry_time", TimestampNTZType()),
])
DEVICE_AUDIT = StructType([
    StructField("device_id", StringType()),
    StructField("nas_id", LongType()),
    StructField("modified_time", TimestampNTZType()),
    StructField("lco_account_id", LongType()),
    StructField("extra_data", StringType()),
])
SCHEMAS = {
    "tasks": TASKS,
    "task_performance": TASK_PERFORMANCE,
    "task_logs": TASK_LOGS,
    "router_user_mapping": ROUTER_USER_MAPPING,
    "device_audit": DEVICE_AUDIT,
}

# The after-success sample: header names as published, minute timestamps.
AFTER_SUCCESS_COLUMNS = {
    "Task ID": ("task_id", LongType()),
    "Device ID": ("device_id", StringType()),
    "Partner ID": ("partner_id", LongType()),
    "Resolution Type": ("resolution_type", StringType()),
    "Score": ("score", IntegerType()),
    "Created (IST)": ("created_ist", TimestampNTZType()),
    "Resolved (IST)": ("resolved_ist", TimestampNTZType()),
    "RA Returned (IST)": ("ra_returned_ist", TimestampNTZType()),
    "Days After Success": ("days_after_success", IntegerType()),
}


def read(spark: SparkSession, name: str, location: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A source table by catalog name, or by path with the declared schema."""
    schema = SCHEMAS[name]
    if location is None:
        return by_name(spark, name)
    return spark.read.format(fmt).schema(schema).load(location)


def by_name(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """A catalog table with its declared columns and the date partition columns of
    its times (``<ts>__date``), so that time ranges skip partitions here too."""
    df, fields = spark.table(prefix + name), SCHEMAS[name].fieldNames()
    parts = [partition_column(c) for c in fields]
    return df.select(*fields, *[c for c in df.columns if c in parts])


def tasks(spark, location=None):
    return read(spark, "tasks", location)


def task_performance(spark, location=None):
    return read(spark, "task_performance", location)


def task_logs(spark, location=None):
    return read(spark, "task_logs", location)


def router_user_mapping(spark, location=None):
    return read(spark, "router_user_mapping", location)


def device_audit(spark, location=None):
    return read(spark, "device_audit", location)


def after_success_csv(spark: SparkSession, path: str) -> DataFrame:
    """The returned-after-success sample CSV with typed, snake_case columns."""
    schema = StructType([StructField(src, t) for src, (_, t) in AFTER_SUCCESS_COLUMNS.items()])
    df = (spark.read.schema(schema).option("header", True)
          .option("timestampNTZFormat", "yyyy-MM-dd HH:mm")
          .option("mode", "FAILFAST").csv(path))
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, (dst, _) in AFTER_SUCCESS_COLUMNS.items()])


def write_partitioned(df: DataFrame, path: str, ts: str, mode: str = "overwrite", partitions: int = 1024) -> None:
    """Store a fact table partitioned by the UTC date of ``ts`` (column
    ``<ts>__date``); range filters on ``ts`` then skip whole partitions
    (``operators.filters.in_window``).

    Rows are rebalanced by date before the write: small dates share tasks and get one file each, and
    a date beyond the session's advisory partition size is split over several tasks by the
    sizes that the shuffle measured, whatever share of the rows it holds.  So the files of a date
    follow its size and not the number of tasks that held some of its rows.

    ``partitions`` is how finely dates are told apart before small ones are put together: a
    date that falls into the same one as a busy date is split as often as that.  Above 2,000
    Spark keeps mean sizes only and would not see the busy date."""
    part = partition_column(ts)
    (df.withColumn(part, F.to_date(F.col(ts)))
       .hint("rebalance", partitions, F.col(part))
       .write.mode(mode).partitionBy(part).parquet(path))
