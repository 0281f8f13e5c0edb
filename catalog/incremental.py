"""Queries whose rows went through files: outputs of whole runs, and tables that came in batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import scrub
from scrub.sources import scratch_path
from scrub.streaming.ingest import drain
from scrub.streaming.whole import read_batches, stateful_session

from .queries import (
    LINEITEM_NUMBERS, METRICS, ORACLES, SCORES, SHAPED_SQL, STRICT_ORDERS, STRICT_SQL, per_column, shown,
)
from .registry import query

# A table that comes in batches: its least files, its batches whatever its size, and how long a file gets.
FILES, BATCHES, ROWS_PER_FILE = 6, 3, 500_000
QUARANTINED = [
    "order_id", "customer_id", "priority", "amount", "order_date", "is_active", "priority_vague_flag", "quarantine_reason",
    "original_row_hash",
]


def as_files(df: DataFrame, path: str) -> int:
    """Write a table as files, more for a larger one, so that no task writes much; return how many make a batch."""
    files = max(FILES, -(-df.count() // ROWS_PER_FILE))
    df.repartition(files).write.parquet(path)
    return -(-files // BATCHES)


def in_batches(df: DataFrame, apply: Callable[[DataFrame], DataFrame], stateful=None) -> DataFrame:
    """The rows that ``apply`` gives for each batch of a table that comes as files, with their ``batch``."""
    source, out, seen = (scratch_path(df.sparkSession, name) for name in ("files", "batches", "seen"))
    per_batch = as_files(df, source)
    spark = stateful_session(df.sparkSession, 8)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(source)

    def put(batch: DataFrame, batch_id: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    drain(stream if stateful is None else stateful(stream), seen, put, "update")
    return read_batches(df.sparkSession, out)


# --- duplicates of all batches -------------------------------------------------------------------


@query("ingest_dedup_all", "dirty_orders", ORACLES["dedup_all"])
def ingest_dedup_all(df):
    return in_batches(df, lambda batch: batch, scrub.dedup_stream).drop("batch")


@query("ingest_dedup_subset", "dirty_orders", ORACLES["dedup_subset"])
def ingest_dedup_subset(df):
    subset = ["customer_id", "no_such_column"]
    found = in_batches(df, lambda batch: batch, lambda stream: scrub.dedup_stream(stream, subset))
    return scrub.latest_rows(found, subset)


# --- types and statistics of all batches ---------------------------------------------------------


@query("ingest_infer_types", "orders_text", ORACLES["infer_types"])
def ingest_infer_types(df):
    return scrub.types_of_counts(scrub.add_type_counts(in_batches(df, scrub.type_counts)))


@query(
    "ingest_profile", "lineitem",
    per_column(
        zip(LINEITEM_NUMBERS, ("",) * 8),
        """SELECT '{c}' AS column_name, count(*) AS total_records, count(*) - count({c}) AS null_count,
        CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
        round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std_dev,
        round(var_samp({c}), 2) AS variance, count(*) FILTER (WHERE {c} = 0) AS zero_count,
        count(*) FILTER (WHERE {c} < 0) AS negative_count FROM lineitem""",
    ),
)
def ingest_profile(df):
    merged = scrub.merge_profiles(in_batches(df, scrub.profile_part), df.schema)
    return merged.where("mean IS NOT NULL").select(
        "column_name", "total_records", "null_count", F.col("min_value").cast("double").alias("min_value"),
        F.col("max_value").cast("double").alias("max_value"), "mean", "std_dev",
        F.round("variance", 2).alias("variance"), "zero_count", "negative_count",
    )


@query("ingest_outliers", "events", ORACLES["outlier_zscore"])
def ingest_outliers(df):
    limits = scrub.part_limits(in_batches(df, scrub.profile_part), df.schema, "zscore", 2.5)
    return shown(scrub.flag_outliers(df, "zscore", limits=limits).drop("ts"))


# --- outputs of runs -----------------------------------------------------------------------------

STRICT_CLEAN_SQL = STRICT_SQL + """SELECT order_id, customer_id, priority, CAST(amount AS VARCHAR) AS amount,
    CAST(order_date AS VARCHAR) AS order_date, is_active, priority_vague_flag, year(order_date) AS order_year FROM u"""
CLEANED = ["order_id", "customer_id", "priority", "amount", "order_date", "is_active", "priority_vague_flag", "order_year"]


def ran(df: DataFrame):
    """The orders as a Parquet source, cleaned by a run that writes its three outputs."""
    spark = df.sparkSession
    source, target = scratch_path(spark, "orders"), scratch_path(spark, "cleaned")
    df.write.parquet(source)
    config = replace(STRICT_ORDERS, source=source, target=target, input_format="parquet", profiling=True)
    scrub.run(spark, config)
    return config


@query("run_orders", "dirty_orders", STRICT_CLEAN_SQL)
def run_orders(df):
    config = ran(df)
    return shown(scrub.read_table(df.sparkSession, config.target, "parquet"), *CLEANED)


@query("run_published", "dirty_orders", STRICT_CLEAN_SQL)
def run_published(df):
    """The second of two versions, as readers of the target see it."""
    spark = df.sparkSession
    config = replace(STRICT_ORDERS, target=scratch_path(spark, "published"), versions=True)
    for part in (df.where("customer_id IS NULL"), df):
        with scrub.run(spark, config, part):
            pass
    return shown(scrub.read_published(spark, config.target), *CLEANED)


@query("sink_quarantine", "dirty_orders", ORACLES["clean_orders_quarantine"])
def sink_quarantine(df):
    config = ran(df)
    return shown(scrub.read_table(df.sparkSession, config.quarantine_target, "parquet"), *QUARANTINED)


def rounded(metrics: DataFrame) -> DataFrame:
    return metrics.select(*METRICS, *[F.round(c, 6).alias(c) for c in SCORES])


@query("sink_metrics", "dirty_orders", ORACLES["clean_orders_metrics"])
def sink_metrics(df):
    config = ran(df)
    return rounded(scrub.read_table(df.sparkSession, config.metrics_target, "json"))


def ingested(df: DataFrame):
    """The orders as files that come in batches, cleaned as if they were one table."""
    spark = df.sparkSession
    source, target, checkpoint = (scratch_path(spark, name) for name in ("orders", "cleaned", "seen"))
    per_batch = as_files(df, source)
    config = replace(STRICT_ORDERS, source=source, target=target, input_format="parquet", profiling=True)
    return scrub.clean_incrementally(spark, config, df.schema, checkpoint, per_batch, state_partitions=8)


@query("ingest_orders", "dirty_orders", STRICT_CLEAN_SQL)
def ingest_orders(df):
    return shown(ingested(df).clean, *CLEANED)


@query("ingest_orders_metrics", "dirty_orders", ORACLES["clean_orders_metrics"])
def ingest_orders_metrics(df):
    return rounded(ingested(df).metrics)


# --- what a run says of itself, from its metrics file --------------------------------------------


@query(
    "run_conversions", "dirty_orders",
    f"""WITH raw AS (SELECT * FROM <dirty_orders>), {SHAPED_SQL}, n AS (
      SELECT 'amount' AS column_name, 'decimal(12,2)' AS target_type, (SELECT count(amount) FROM raw) AS before_count,
        (SELECT count(amount) FROM c) AS after_count UNION ALL
      SELECT 'order_date', 'date', (SELECT count(order_date) FROM raw), (SELECT count(order_date) FROM c) UNION ALL
      SELECT 'is_active', 'boolean', (SELECT count(is_active) FROM raw), (SELECT count(is_active) FROM c))
    SELECT *, round(after_count * 1.0 / before_count, 6) AS success_rate, after_count < 0.8 * before_count AS low_success FROM n""",
)
def run_conversions(df):
    config = ran(df)
    record = scrub.read_table(df.sparkSession, config.metrics_target, "json")
    return record.select(F.inline("conversions")).select(
        "column_name", "target_type", "before_count", "after_count", F.round("success_rate", 6).alias("success_rate"), "low_success"
    )


@query(
    "run_rule_counts", "dirty_orders",
    STRICT_SQL + """SELECT 0 AS rule_order, 'no_amount' AS rule_name, (SELECT count(*) FROM q1) AS affected_records
    UNION ALL SELECT 1, 'large', (SELECT count(*) FROM f WHERE amount > 400000)
    UNION ALL SELECT 2, 'vague', (SELECT count(*) FROM g WHERE priority_vague_flag)
    UNION ALL SELECT 3, 'old', (SELECT count(*) FROM q2)
    UNION ALL SELECT 4, 'small', (SELECT count(*) FROM h) - (SELECT count(*) FROM r)""",
)
def run_rule_counts(df):
    config = ran(df)
    record = scrub.read_table(df.sparkSession, config.metrics_target, "json")
    return record.select(F.inline("rule_counts")).select("rule_order", "rule_name", "affected_records")
