"""Staging tables of one run: replaced as a whole, read by name, gone at the end.

A staged feed is written to a new folder below the scope's root, then the
view ``stg_<name>`` is pointed at it, so a reader sees the old rows or the new
ones, never a mixture, and a write that fails leaves the old rows in place.
Earlier folders stay until the scope ends, since plans may still read them.
The scope removes all of its views and folders, also after an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from daybook.session import scratch_path
from daybook.sources.files import delete_path, write_folder


class Staging:
    """``with Staging(spark) as stage: stage.replace("terminals", rows); stage.read("terminals")``"""

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark, self.names = spark, set()
        self.root = f"{root or scratch_path(spark, 'daybook/staging')}/{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error) -> None:
        for name in self.names:
            self.spark.catalog.dropTempView(f"stg_{name}")
        delete_path(self.spark, self.root)

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        """Stage ``rows`` (none are a table too) instead of what is staged under ``name``."""
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        write_folder(rows, path)
        self.spark.read.schema(rows.schema).parquet(path).createOrReplaceTempView(f"stg_{name}")
        self.names.add(name)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"stg_{name}")
