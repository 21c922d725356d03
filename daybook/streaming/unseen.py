"""Insert-only transaction history fed by a stream.

Exact form: every micro-batch is anti-joined with the stored history inside
``foreachBatch`` (``FactStore.append_unseen``); a replayed micro-batch
appends nothing new, so the sink is idempotent.

Bounded form: ``dropDuplicatesWithinWatermark`` removes repeats of a key
that arrive within the watermark delay of each other, keeping state bounded
without reading the history; repeats further apart are not caught.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.schemas import TRANSACTIONS, empty_frame
from daybook.sources.store import FactStore


def start_append_unseen(
    spark: SparkSession,
    tx_stream: DataFrame,
    facts_root: str,
    checkpoint: str,
    keys: list[str] = ("transaction_id",),
    buckets: int | None = None,
) -> StreamingQuery:
    store = FactStore(
        spark, facts_root, list(keys), "transaction_date", empty_frame(spark, TRANSACTIONS), buckets=buckets
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.append_unseen(batch.select(*[f.name for f in TRANSACTIONS.fields]))

    return (
        tx_stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_within_watermark(tx_stream: DataFrame, delay: str = "1 day", keys=("transaction_id",)) -> DataFrame:
    return (
        tx_stream.withColumn("event_time", F.col("transaction_date").cast("timestamp"))
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("event_time")
    )
