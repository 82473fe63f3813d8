"""Group-dependent column masks. User and groups are arguments, so results repeat."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
MASK_TEXT = "***MASKED***"
ENGINEER_GROUP = "engineers"
ANALYST_GROUP = "analysts"


def sees_all_rows(groups: Iterable[str]) -> bool:
    return bool({ENGINEER_GROUP, ANALYST_GROUP} & set(groups))


def masked(value: Column, groups: Iterable[str]) -> Column:
    """The raw value for engineers, the mask text for everybody else."""
    return F.when(F.lit(ENGINEER_GROUP in set(groups)), value).otherwise(F.lit(MASK_TEXT))
