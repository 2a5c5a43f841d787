"""Column expressions for lenient casts: text that is no number becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or dashes."""
    return F.col(quoted(name))


def to_double(name: str) -> Column:
    return column(name).try_cast("double")


def to_int(name: str) -> Column:
    """Truncating cast; fractions in text count, values beyond int become null."""
    return column(name).try_cast("double").try_cast("int")


def to_date(name: str) -> Column:
    return column(name).try_cast("date")
