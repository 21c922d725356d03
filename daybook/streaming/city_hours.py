"""Hourly city counts per passport over an event-time stream.

``withWatermark`` bounds the state: a (passport, hour) group is dropped
from state once the watermark passes the end of its hour.  Distinct
aggregation is not available on streams, so the city count is the size of
the per-group city set (bounded by the number of cities).  Update mode emits
each changed group per micro-batch; the ``foreachBatch`` sink upserts those
rows into a table partitioned by day, rewriting only the touched days
(dynamic partition overwrite), so the table always holds the latest count
per group and a replayed micro-batch gives the same table.

The watermark needs a zoned ``TIMESTAMP``: the wall-clock hour of the
``TIMESTAMP_NTZ`` transaction time is truncated in local time and used both
as the watermarked column and as the grouping key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.enrich import enrich_transactions
from daybook.sources.store import read_or_none

KEY = ["passport_num", "hour_start"]


def city_count_stream(enriched_stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    # The grouping key is the watermarked column itself: the wall-clock hour
    # (truncated in local time, so clock hours hold in any session zone) as a
    # zoned TIMESTAMP, which is what the watermark requires.
    hour = F.date_trunc("hour", F.col("transaction_date"))
    return (
        enriched_stream.filter(F.col("transaction_date").isNotNull())
        .withColumn("event_hour", hour)
        .withWatermark("event_hour", delay)
        .groupBy("event_hour", "passport_num")
        .agg(
            F.min("transaction_date").alias("hour_group"),
            F.size(F.collect_set("terminal_city")).cast("long").alias("count_cities"),
            # People of the group (bounded by the clients sharing a passport),
            # so the different-cities rule can be read from the table.
            F.collect_set(F.struct("fio", "phone")).alias("people"),
        )
        .select(
            "passport_num",
            F.col("event_hour").cast("timestamp_ntz").alias("hour_start"),
            "hour_group",
            "count_cities",
            "people",
        )
    )


def different_cities_from_counts(counts: DataFrame) -> DataFrame:
    """Report rows of the different-cities rule from the hourly counts table."""
    from daybook.constants import EVENT_DIFFERENT_CITIES

    day = F.to_date("hour_start")
    return (
        counts.filter(F.col("passport_num").isNotNull() & (F.col("count_cities") > 1))
        .select(day.alias("day"), "passport_num", F.explode("people").alias("p"))
        .select(
            F.col("day").alias("event_dt"),
            F.col("passport_num").alias("passport"),
            F.col("p.fio").alias("fio"),
            F.col("p.phone").alias("phone"),
            F.lit(EVENT_DIFFERENT_CITIES).alias("event_type"),
            F.col("day").alias("report_dt"),
        )
        .distinct()
    )


def upsert_into(table_root: str):
    """foreachBatch sink: replace the rows of the touched day partitions."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("day", F.to_date("hour_start"))
        stored = read_or_none(spark, table_root, fresh.schema)
        if stored is not None:
            # Update mode emits each changed group once per micro-batch with its
            # full current value: it replaces the stored row of the same group.
            touched = stored.join(fresh.select("day").distinct(), "day", "left_semi")
            # NULL-safe: the group of unknown passports is one group, too.
            changed = fresh.select(*(F.col(c).alias(f"_{c}") for c in KEY))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
            kept = touched.join(changed, same, "left_anti")
            # Materialise (reliable checkpoint in the shared folder) before
            # overwriting the partitions that were just read.
            fresh = kept.unionByName(fresh).checkpoint(eager=True)
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(
            table_root
        )

    return sink


def start_city_counts(
    spark: SparkSession,
    tx_stream: DataFrame,
    holders: DataFrame,
    terminals_current: DataFrame,
    table_root: str,
    checkpoint: str,
    delay: str = "1 hour",
) -> StreamingQuery:
    enriched = enrich_transactions(tx_stream, holders, terminals_current)
    return (
        city_count_stream(enriched, delay)
        .writeStream.outputMode("update")
        .foreachBatch(upsert_into(table_root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
