"""Surrogate row ids for history tables.

A sequence needs a global order (one task).  A content hash is
deterministic, needs no coordination and survives task retries: the same
row always gets the same id.  Rows with identical content get identical ids,
which is harmless because they are indistinguishable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_id(cols: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in cols])
