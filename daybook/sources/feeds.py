"""A daily drop folder: route files to feeds, read them, find the batch date.

Files belong to a feed when their name contains the feed word
(``transaction``, ``terminals``, ``passport_blacklist``); other files are
ignored.  The format follows the extension: ``.xlsx`` is a workbook,
anything else delimited text.  The batch date comes from each file's name;
a drop whose files disagree on the date, or lack one, is refused.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.constants import FEED_BLACKLIST, FEED_TERMINALS, FEED_TRANSACTIONS
from daybook.functions.filenames import batch_date_from_name
from daybook.plans.daily import DailyFeeds
from daybook.schemas import BLACKLIST, TERMINALS, TRANSACTIONS
from daybook.sources.delimited import read_feed
from daybook.sources.store import list_names, move_into
from daybook.sources.workbook import read_workbooks

FEEDS = {
    FEED_TRANSACTIONS: TRANSACTIONS,
    FEED_TERMINALS: TERMINALS,
    FEED_BLACKLIST: BLACKLIST,
}


def read_feed_files(spark: SparkSession, folder: str, word: str, schema, stamp: str = "", names: list[str] | None = None) -> DataFrame:
    """All entries of one feed right below ``folder``: names with ``word`` and ``stamp``.

    Workbooks (``*.xlsx`` files) and delimited text (``*.txt`` / ``*.csv``,
    a file or a folder of part files) are both read and unioned.  A feed
    without a file, or text whose header lacks a column, is refused: an empty
    snapshot would close everything.  ``names``: only these entries, whatever
    else has come into the folder.
    """
    names = [n for n in (list_names(spark, folder) if names is None else names) if word in n and stamp in n]
    parts = []
    if books := [n for n in names if n.endswith(".xlsx")]:
        parts.append(read_workbooks(spark, folder, schema, glob=f"{{{','.join(books)}}}"))
    for name in names:
        if name.endswith((".txt", ".csv")):
            parts.append(read_feed(spark, f"{folder}/{name}", schema, require_columns=True))
    if not parts:
        raise FileNotFoundError(f"drop {folder}: no file of the feed {word!r} {stamp}".rstrip())
    return reduce(DataFrame.unionByName, parts)


def feed_entries(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders right below ``folder`` that belong to a feed."""
    return [n for n in list_names(spark, folder) if any(w in n for w in FEEDS)]


def drop_batch_date(spark: SparkSession, folder: str) -> _dt.date:
    """The one batch date of a drop, from the names right below ``folder`` (no file content is read)."""
    names = spark.createDataFrame([(n,) for n in feed_entries(spark, folder)], "name string")
    ds = {r["d"] for r in names.select(batch_date_from_name(F.col("name")).alias("d")).distinct().collect()}
    if None in ds or len(ds) != 1:
        raise ValueError(f"drop {folder}: expected one batch date in the file names, got {sorted(map(str, ds))}")
    return ds.pop()


def read_feeds(spark: SparkSession, folder: str, stamp: str = "", names: list[str] | None = None) -> DailyFeeds:
    """The three feeds of a drop, all of them required (``names``: see ``read_feed_files``)."""
    return DailyFeeds(
        transactions=read_feed_files(spark, folder, FEED_TRANSACTIONS, TRANSACTIONS, stamp, names),
        terminals=read_feed_files(spark, folder, FEED_TERMINALS, TERMINALS, stamp, names),
        blacklist=read_feed_files(spark, folder, FEED_BLACKLIST, BLACKLIST, stamp, names),
    )


def read_drop(spark: SparkSession, folder: str) -> tuple[DailyFeeds, _dt.date]:
    d = drop_batch_date(spark, folder)
    return read_feeds(spark, folder), d


def archive_drop(spark: SparkSession, folder: str, archive: str) -> list[str]:
    """Move every feed's files of a drop to ``archive``; call it once the day is done.  Returns the names moved."""
    names = feed_entries(spark, folder)
    move_into(spark, folder, names, archive)
    return names
