"""Text helpers that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters that count as whitespace at the ends of a line
_SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def strip(value: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` removes spaces only)."""
    return F.regexp_replace(value, f"^{_SPACE}|{_SPACE}$", "")


def metric_name(value: Column) -> Column:
    """Lower-case metric name: letters, digits, ``_`` and ``:`` stay, the rest becomes ``_``."""
    return F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}_:]", "_"))


def is_blank(value: Column) -> Column:
    """True for NULL and for the empty string; never NULL."""
    return value.isNull() | (value == "")


def shown(value: Column) -> Column:
    """Value as it is printed in a reason text; NULL prints as ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))
