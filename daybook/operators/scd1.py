"""Type-1 slowly changing dimension: overwrite in place, no history.

Rows of the batch replace stored rows with the same key; stored rows not in
the batch stay.  ``create_dt`` is kept from the stored row (or set to the
batch date for new keys when the batch has none) and ``update_dt`` becomes
the batch date when a stored row actually changed.  One full outer join on
the key; no row-level DML is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import DateLike, as_date
from daybook.operators.diff import attrs_differ, diff_join, NEW, DELETED


def scd1_upsert(
    dim: DataFrame,
    batch: DataFrame,
    keys: list[str],
    batch_date: DateLike,
    create_col: str = "create_dt",
    update_col: str = "update_dt",
) -> DataFrame:
    attrs = [c for c in dim.columns if c not in keys and c not in (create_col, update_col)]
    j = diff_join(dim, batch, keys, attrs, null_safe=True, current_extra=[create_col, update_col])
    change = F.col("change")
    from_dim = change == F.lit(DELETED)  # key only in the stored dimension
    out = []
    for c in [*keys, *attrs]:
        out.append(F.when(from_dim, F.col(f"c_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
    d = as_date(batch_date)
    out.append(F.when(change == F.lit(NEW), d).otherwise(F.col(f"c_{create_col}")).alias(create_col))
    changed = attrs_differ([F.col(f"c_{a}") for a in attrs], [F.col(f"s_{a}") for a in attrs], True)
    out.append(
        F.when((change != F.lit(NEW)) & (change != F.lit(DELETED)) & changed, d)
        .otherwise(F.col(f"c_{update_col}"))
        .alias(update_col)
    )
    return j.select(*out).select(*dim.columns)
