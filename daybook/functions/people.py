"""Person-level column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fio(last: str = "last_name", first: str = "first_name", patronymic: str = "patronymic") -> Column:
    """Full name: space-joined, NULL parts skipped (all NULL gives '')."""
    return F.concat_ws(" ", F.col(last), F.col(first), F.col(patronymic))
