"""Batch date from the file name (``<feed>_DDMMYYYY.<ext>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.constants import FILENAME_DATE_FORMAT, FILENAME_DATE_PATTERN


def batch_date_from_name(name: Column) -> Column:
    """DATE encoded in a file name; NULL when absent or impossible (e.g. 31022024)."""
    digits = F.regexp_extract(name, FILENAME_DATE_PATTERN, 1)
    return F.when(digits == "", F.lit(None).cast("date")).otherwise(
        F.try_to_date(digits, FILENAME_DATE_FORMAT)
    )


def file_name_of_row() -> Column:
    """Name (not path) of the file each row was read from."""
    return F.col("_metadata.file_name")
