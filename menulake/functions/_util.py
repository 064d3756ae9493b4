from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def blank(c) -> Column:
    """True for null and for text that is empty after trimming whitespace."""
    from menulake.functions.text import strip_ws
    return col_of(c).isNull() | (strip_ws(col_of(c)) == "")
