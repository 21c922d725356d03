"""Insert-only fact history: append the batch rows whose key is not stored yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unseen(hist: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key has no row in ``hist``.

    A left anti join (NULL-key batch rows are kept, duplicates in the batch
    are all kept, as the outer-join + IS NULL form does).  Only the key
    columns of the history are read; partitioning or bucketing the stored
    history by the key lets the planner avoid shuffling the large side.
    """
    return batch.join(hist.select(*keys), list(keys), "left_anti")


def append_unseen(hist: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """History after the append (``hist`` plus ``unseen``)."""
    return hist.unionByName(unseen(hist, batch, keys).select(*hist.columns))
