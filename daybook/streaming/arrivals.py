"""The incoming folder as a stream over versioned tables, which no file can bring to a stand.

Arriving files only wake the stream.  What is to be done follows from the names
in the folder and from the versions of the warehouse, so a replayed or lost
trigger changes nothing:

* files that a version has read (its manifest names them) are moved to the
  archive: exactly these, also after a crash between commit and move;
* a day that isn't finished and has all three feeds is run, oldest first, on
  exactly the files listed, and is archived once its version is committed;
* a day that lacks a feed waits, and later days with it, since days apply in
  order; the file that completes it wakes the stream;
* a file that comes late, for a day that is finished or older than the newest,
  and a feed's file without a date in its name are set aside in the quarantine.
  All other days go on.

A day that fails (a header that doesn't fit, say) fails the stream with that
error, after the days before it have been run and late files were set aside.
Put drops into the folder whole, by a rename.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daybook.constants import FEED_BLACKLIST, FEED_TERMINALS, FEED_TRANSACTIONS
from daybook.plans.daily import Dimensions
from daybook.plans.versioned import run_day_versioned
from daybook.sources.feeds import feed_entries, read_feeds
from daybook.sources.files import hadoop, list_names, move_into
from daybook.sources.warehouse import Warehouse
from daybook.streaming.drops import FILES, _feed_files

WORDS = (FEED_TRANSACTIONS, FEED_TERMINALS, FEED_BLACKLIST)
#: Why a file is in the quarantine.
LATE, UNDATED = "late", "undated"


def _date(name: str) -> _dt.date | None:
    """The DDMMYYYY stamp of a drop's file or folder."""
    for part in name.split("_")[1:]:
        try:
            if len(part) >= 8 and part[:8].isdigit():
                return _dt.datetime.strptime(part[:8], "%d%m%Y").date()
        except ValueError:
            continue
    return None


def take_arrivals(warehouse: Warehouse, dims: Dimensions, incoming: str, archive: str, quarantine: str) -> list[_dt.date]:
    """One pass over the incoming folder (see the module); returns the days that it ran."""
    spark, by_day, ran = warehouse.spark, {}, []
    for name in feed_entries(spark, incoming):
        by_day.setdefault(_date(name), []).append(name)
    if undated := by_day.pop(None, None):
        _set_aside(spark, incoming, undated, quarantine, UNDATED)
    newest = warehouse.manifest()
    for day in sorted(by_day):
        if newest and day <= newest.batch_date:
            done = warehouse.finished(day)
            read = [n for n in by_day[day] if done and n in done.files]
            move_into(spark, incoming, read, archive)
            if late := sorted(set(by_day.pop(day)) - set(read)):
                _set_aside(spark, incoming, late, quarantine, LATE)
    for day, names in sorted(by_day.items()):
        if not all(any(w in n for n in names) for w in WORDS):
            break
        feeds = read_feeds(spark, incoming, f"_{day:%d%m%Y}", names)
        run_day_versioned(warehouse, feeds, dims, day, files=names)
        move_into(spark, incoming, names, archive)
        ran.append(day)
    return ran


def _set_aside(spark: SparkSession, incoming: str, names: list[str], quarantine: str, reason: str) -> None:
    move_into(spark, incoming, names, f"{quarantine}/{reason}/{uuid.uuid4().hex[:12]}")  # a name may come again


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """The files set aside: reason, batch_date, name and their folder."""
    fs, where = hadoop(spark, quarantine)
    found = []
    for reason in list_names(spark, quarantine) if fs.exists(where) else []:
        for batch in list_names(spark, f"{quarantine}/{reason}"):
            folder = f"{quarantine}/{reason}/{batch}"
            found += [(reason, _date(name), name, folder) for name in list_names(spark, folder)]
    return spark.createDataFrame(found, "reason string, batch_date date, name string, folder string")


def arrival_stream(
    warehouse: Warehouse,
    dims: Dimensions,
    incoming: str,
    checkpoint: str,
    archive: str,
    quarantine: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the stream (by default ``availableNow``: what is there, then it stops)."""
    spark = warehouse.spark
    files = spark.readStream.format("binaryFile").schema(FILES).load(_feed_files(incoming)).select("path")
    # The batch itself is never read: its files may have been moved already.
    writer = files.writeStream.foreachBatch(lambda batch, n: take_arrivals(warehouse, dims, incoming, archive, quarantine) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
