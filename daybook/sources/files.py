"""Folders of tables, on whatever file system they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The table at ``path``, or None if there is no such path; every other error is raised."""
    fs, where = hadoop(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(where) else None


def write_folder(rows: DataFrame, path: str) -> None:
    """Replace one folder by ``rows``, also if there are none."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a table's folder, on whatever file system it is."""
    fs, where = hadoop(spark, path)
    fs.delete(where, True)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the visible files and folders right below ``folder``."""
    fs, where = hadoop(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def move_into(spark: SparkSession, folder: str, names: list[str], target: str) -> None:
    """Move entries of ``folder`` to the folder ``target`` of the same file system."""
    fs, _ = hadoop(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(target))
    for name in names:
        if not fs.rename(path(folder, name), path(target, name)):
            raise OSError(f"could not move {folder}/{name} to {target}")
