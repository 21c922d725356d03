"""Per (passport, clock hour) group values: first transaction time and city count.

The original computes ``min(ts) OVER (PARTITION BY passport, hour)``.  Here
the group value is aggregated (map-side combined) and joined back on the
group key with NULL-safe equality, so a hot (passport, hour) group is one
row on the small side and AQE's skew join can split the large side, where a
window would hold the whole hot group in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keyed(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("tx_day", F.to_date("transaction_date")).withColumn(
        "tx_hour", F.hour("transaction_date")
    )


def first_tx_in_hour(enriched: DataFrame) -> DataFrame:
    """Every row with ``hour_group``: the first transaction time of its (passport, clock hour)."""
    keyed = _keyed(enriched)
    firsts = keyed.groupBy("passport_num", "tx_day", "tx_hour").agg(
        F.min("transaction_date").alias("hour_group")
    )
    f = firsts.select(
        F.col("passport_num").alias("g_passport"),
        F.col("tx_day").alias("g_day"),
        F.col("tx_hour").alias("g_hour"),
        "hour_group",
    )
    on = (
        keyed["passport_num"].eqNullSafe(f["g_passport"])
        & keyed["tx_day"].eqNullSafe(f["g_day"])
        & keyed["tx_hour"].eqNullSafe(f["g_hour"])
    )
    return keyed.join(f, on, "left").drop("g_passport", "g_day", "g_hour", "tx_day", "tx_hour")


def city_count_by_hour(enriched: DataFrame) -> DataFrame:
    """Distinct non-NULL cities per (passport, clock hour); NULL times are left out."""
    return (
        _keyed(enriched)
        .filter(F.col("transaction_date").isNotNull())
        .groupBy("passport_num", "tx_day", "tx_hour")
        .agg(
            F.min("transaction_date").alias("hour_group"),
            # The city set is bounded by the number of cities; one exchange after
            # map-side combine, where count(DISTINCT) would plan two.
            F.size(F.collect_set("terminal_city")).cast("long").alias("count_cities"),
        )
        .select("passport_num", "hour_group", "count_cities")
    )
