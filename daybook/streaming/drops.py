"""The incoming folder as a stream: each new daily drop runs the daily step.

``readStream`` watches the files of all three feeds by name only (no content
is read).  Every micro-batch is handed to ``foreachBatch``, which reads each
batch date that it names, oldest first, by file name and runs the stored daily
step.  A day that lacks a feed, or has a header that doesn't fit, fails before
anything is written, and the restarted stream tries it again.  A replayed
micro-batch skips the days that are finished.  ``cleanSource=archive`` moves
the files of every feed once their batch has committed.  Drops should be put
into the folder whole (by a rename).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.constants import FEED_BLACKLIST, FEED_TERMINALS, FEED_TRANSACTIONS
from daybook.functions.coerce import coerce_by_name
from daybook.functions.filenames import batch_date_from_name
from daybook.plans.daily import Dimensions, StateRoots, run_day_stored
from daybook.schemas import TRANSACTIONS
from daybook.sources.delimited import conform, write_delimited
from daybook.sources.store import DayLog
from daybook.sources.workbook import write_workbooks

TEXT_TX = ", ".join(f"`{f.name}` STRING" for f in TRANSACTIONS.fields)


def _ddmmyyyy(d: _dt.date) -> str:
    return d.strftime("%d%m%Y")


def transaction_file_stream(
    spark: SparkSession, incoming: str, max_files: int | None = None, archive_dir: str | None = None
) -> DataFrame:
    reader = (
        spark.readStream.format("csv")
        .schema(TEXT_TX)
        .option("sep", ";")
        .option("header", True)
        .option("enforceSchema", False)  # a header of another order is refused
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        # Source options: consumed files move to the archive once their batch
        # has committed (Spark does it when the next batch starts).
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    raw = reader.load(f"{incoming}/*{FEED_TRANSACTIONS}*.{{txt,csv}}")
    # The drop name (``transactions_DDMMYYYY.txt``) may be the file or its folder.
    named = raw.withColumn("_source_file", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/?[^/]*)$", 1))
    typed = conform(coerce_by_name(named), TRANSACTIONS, keep=["_source_file"])
    return typed.withColumn("batch_date", batch_date_from_name(F.col("_source_file"))).drop("_source_file")


def drop_file_stream(spark: SparkSession, incoming: str, archive_dir: str | None = None) -> DataFrame:
    """Batch dates (stamp) and names (file; with the folder of a part) of the feeds' files as they arrive."""
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return _named(reader.load(_feed_files(incoming)))


FILES = "path string, modificationTime timestamp, length long, content binary"
WORDS = [FEED_TRANSACTIONS, FEED_TERMINALS, FEED_BLACKLIST]


def _feed_files(incoming: str) -> str:
    return f"{incoming}/*{{{','.join(WORDS)}}}*"


def _named(files: DataFrame) -> DataFrame:
    # The drop's name is the last segment with a feed's word: a file, or the folder of its parts.
    words = "|".join(WORDS)
    name = F.regexp_extract("path", rf"^.*/([^/]*(?:{words})[^/]*)", 1)
    inside = F.regexp_extract("path", rf"^.*/([^/]*(?:{words})[^/]*.*)$", 1)
    return files.select(F.regexp_extract(name, r"_(\d{8})", 1).alias("stamp"), inside.alias("file"))


def daily_drop_stream(
    spark: SparkSession,
    incoming: str,
    roots: StateRoots,
    dims: Dimensions,
    checkpoint: str,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Start the drop stream (``availableNow``: process what is there, then stop)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        from daybook.sources.feeds import read_feeds

        days = batch.groupBy("stamp").agg(F.sort_array(F.collect_set("file")).alias("files")).select("stamp", "files", batch_date_from_name(F.format_string("_%s.", "stamp")).alias("d")).collect()
        if any(r["d"] is None for r in days):
            raise ValueError("a feed's file without a batch date in its name")
        log = DayLog(spark, f"{roots.report}_days")
        done, read = log.days(), log.files()
        for r in days:
            late = sorted(set(r["files"]) - read.get(r["d"], set()))
            if done.get(r["d"]) == "done" and late:
                raise ValueError(f"batch {r['d']} is finished and has not read {late}: run it again with all its files, then record_files()")
        for r in sorted(days, key=lambda r: r["d"]):
            if done.get(r["d"]) != "done":
                # All of the day that is in the folder is read, also what a later micro-batch brings.
                there = _named(spark.read.format("binaryFile").schema(FILES).load(_feed_files(incoming)))
                files = [x["file"] for x in there.where(F.col("stamp") == r["stamp"]).select("file").collect()]
                feeds = read_feeds(spark, incoming, f"_{r['stamp']}")
                run_day_stored(spark, roots, feeds, dims, r["d"], replace_done=False, files=files)

    writer = (
        drop_file_stream(spark, incoming, archive_dir=archive_dir)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start()


def record_files(spark: SparkSession, roots: StateRoots, d: _dt.date, files: list[str]) -> None:
    """Enter late files (named as in the stream's error) that a finished day, run again by hand, has read."""
    log = DayLog(spark, f"{roots.report}_days")
    if log.days().get(d) != "done":
        raise ValueError(f"batch {d} is not finished")
    log.add(d, "done", files)


def write_drop(
    incoming: str,
    d: _dt.date,
    transactions: DataFrame,
    terminals: DataFrame,
    blacklist: DataFrame,
    terminals_as_workbook: bool = True,
) -> None:
    """Write one daily drop (fixture helper): tx and black list as text, terminals as workbooks."""
    stamp = _ddmmyyyy(d)
    write_delimited(transactions, f"{incoming}/transactions_{stamp}.txt")
    write_delimited(blacklist, f"{incoming}/passport_blacklist_{stamp}.txt")
    if terminals_as_workbook:
        write_workbooks(terminals, incoming, prefix=f"terminals_{stamp}")
    else:
        write_delimited(terminals, f"{incoming}/terminals_{stamp}.txt")
