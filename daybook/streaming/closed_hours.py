"""Hourly city counts that are emitted once, and a ledger of the rows that came too late for that.

Append mode: the watermark closes an hour, and each (passport, hour) group is
then emitted once and for all, with the number of rows that it has counted.
State holds only hours within the delay.  Spark drops a row that is later than
the watermark without a word, so a second query keeps the rows themselves (what
the count needs of them), and ``reconcile`` compares: a closed group with fewer
rows than there are has late rows.  It is entered in the ledger with their
number and counted again from its rows; its closed row stays as it was emitted,
and the repair counts from then on.

::

    <root>/rows/batch=N/day=D/      rows of micro-batch N of the keeping query
    <root>/closed/batch=N/day=D/    groups emitted by micro-batch N of the closing query
    <root>/repairs/run=K/day=D/     groups counted again by reconciliation K
    <root>/ledger/run=K/            their late rows: counted before, counted now
    <root>/reconciled/run=K/        the last micro-batch of rows that K has looked at

Each folder is written by one micro-batch or run and replaced if that is
replayed (a run without its mark is done again under its number).  ``reconcile`` looks at the days that rows have come for since the
last one and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.enrich import enrich_transactions
from daybook.sources.files import read_or_none, write_folder

GROUP = ["event_hour", "passport_num"]
ROW = "event_hour timestamp, passport_num string, transaction_date timestamp_ntz, terminal_city string, fio string, phone string"
COUNT = (
    "event_hour timestamp, passport_num string, hour_group timestamp_ntz, count_cities long, "
    "people array<struct<fio:string,phone:string>>, n_rows long"
)


def _rows(enriched: DataFrame) -> DataFrame:
    """What the count needs of each transaction; those without a time are in no hour."""
    # The wall-clock hour, truncated in local time, as the watermark requires a zoned time.
    hour = F.date_trunc("hour", F.col("transaction_date")).cast("timestamp")
    return enriched.where("transaction_date IS NOT NULL").select(hour.alias("event_hour"), *[c.split()[0] for c in ROW.split(", ")[1:]])


def hour_counts(rows: DataFrame) -> DataFrame:
    """One row per (hour, passport); the same in a stream and over a table."""
    return rows.groupBy(*GROUP).agg(
        F.min("transaction_date").alias("hour_group"),
        F.size(F.collect_set("terminal_city")).cast("long").alias("count_cities"),
        F.collect_set(F.struct("fio", "phone")).alias("people"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _day() -> Column:
    return F.to_date(F.col("event_hour").cast("timestamp_ntz")).alias("day")


def _into(folder: str):
    def sink(batch: DataFrame, batch_id: int) -> None:
        path = f"{folder}/batch={batch_id}"
        batch.select("*", _day()).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(path)

    return sink


def start_closed_hours(
    tx_stream: DataFrame, holders: DataFrame, terminals_current: DataFrame, root: str, checkpoint: str, delay: str = "1 hour", trigger: dict | None = None
) -> list[StreamingQuery]:
    """Starts the keeping and the closing query over one stream of transactions."""
    rows = _rows(enrich_transactions(tx_stream, holders, terminals_current))
    queries = []
    for name, stream in (("rows", rows), ("closed", hour_counts(rows.withWatermark("event_hour", delay)))):
        writer = stream.writeStream.outputMode("append").foreachBatch(_into(f"{root}/{name}"))
        queries.append(writer.option("checkpointLocation", f"{checkpoint}/{name}").trigger(**(trigger or {"availableNow": True})).start())
    return queries


def _table(spark: SparkSession, root: str, name: str, columns: str, by: str = "batch") -> DataFrame:
    schema = f"{columns}, {by} long, day date"
    found = read_or_none(spark, f"{root}/{name}", schema)
    return spark.createDataFrame([], schema) if found is None else found


def _newest(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The closed groups with their last count (of reconciliations ``before`` one): rows only come, so it is that of the most rows."""
    repairs = _table(spark, root, "repairs", COUNT, "run")
    repairs = repairs if before is None else repairs.where(F.col("run") < before)
    counts = _table(spark, root, "closed", COUNT).drop("batch").unionByName(repairs.drop("run"))
    rest = [c for c in counts.columns if c not in (*GROUP, "n_rows")]
    newest = counts.groupBy(*GROUP).agg(F.max_by(F.struct(*rest), "n_rows").alias("v"), F.max("n_rows").alias("n_rows"))
    return newest.select(*GROUP, "v.*", "n_rows")


def closed_until(spark: SparkSession, root: str):
    """The last hour known to be closed (with all hours before it); None before the first."""
    return _table(spark, root, "closed", COUNT).agg(F.max("event_hour")).first()[0]


def reconcile(spark: SparkSession, root: str) -> int:
    """Finds the closed groups with late rows, enters them in the ledger and counts them again; returns their number."""
    marks = read_or_none(spark, f"{root}/reconciled", "batch long, run long")
    last = marks.agg(F.max("run"), F.max("batch")).first() if marks is not None else (None, None)
    run = 0 if last[0] is None else last[0] + 1
    rows = _table(spark, root, "rows", ROW)
    fresh = rows if last[1] is None else rows.where(F.col("batch") > last[1])
    until, reached = closed_until(spark, root), fresh.agg(F.max("batch")).first()[0]
    if until is None or reached is None:
        return 0
    closed = F.col("event_hour") <= F.lit(until)
    days = [r[0] for r in fresh.where(closed).select("day").distinct().collect()]  # of one delay, and of late rows
    there = rows.where(F.col("day").isin(days) & closed)
    known = _newest(spark, root, run).where(F.col("day").isin(days)).select(F.col("event_hour").alias("h"), F.col("passport_num").alias("p"), F.col("n_rows").alias("n_counted"))
    numbers = there.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_there"))
    # NULL-safe: the group of unknown passports is one, too.
    same = F.col("event_hour").eqNullSafe(F.col("h")) & F.col("passport_num").eqNullSafe(F.col("p"))
    short = numbers.join(known, same, "left").where("n_there > coalesce(n_counted, 0)")
    ledger = short.select(*GROUP, F.coalesce("n_counted", F.lit(0)).cast("long").alias("n_counted"), "n_there", (F.col("n_there") - F.coalesce("n_counted", F.lit(0))).alias("n_late"))
    write_folder(ledger, f"{root}/ledger/run={run}")
    entered = spark.read.parquet(f"{root}/ledger/run={run}")
    touched = entered.select(F.col("event_hour").alias("h"), F.col("passport_num").alias("p"))
    again = hour_counts(there.join(touched, same, "left_semi")).select("*", _day())
    again.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{root}/repairs/run={run}")
    write_folder(spark.range(1).select(F.lit(reached).cast("long").alias("batch")), f"{root}/reconciled/run={run}")
    return entered.count()


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Late rows by group and reconciliation: what was counted, what is there."""
    schema = "event_hour timestamp, passport_num string, n_counted long, n_there long, n_late long, run long"
    found = read_or_none(spark, f"{root}/ledger", schema)
    return spark.createDataFrame([], schema) if found is None else found


def hours_now(spark: SparkSession, root: str) -> DataFrame:
    """Every hour's counts as of now: closed ones with their repairs, and those still open from their rows."""
    until = closed_until(spark, root)
    rows = _table(spark, root, "rows", ROW)
    open_rows = rows if until is None else rows.where((F.col("event_hour") > F.lit(until)) & (F.col("day") >= F.to_date(F.lit(until).cast("timestamp_ntz"))))
    return _newest(spark, root).drop("day").unionByName(hour_counts(open_rows))
