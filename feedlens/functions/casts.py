"""Null-safe string parsing.

Every function returns a Column built from Spark built-ins, so it stays inside
whole-stage codegen and behaves the same with ANSI mode on or off: a cell that
does not parse becomes NULL instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Integer literal as accepted by a strict integer parser: optional sign, digits.
_INT_PATTERN = r"^[+-]?[0-9]+$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """String (or number) to DOUBLE; NULL when it does not parse."""
    return col_of(c).try_cast("double")


def to_bigint(c) -> Column:
    """String (or number) to BIGINT; NULL when it does not parse."""
    return col_of(c).try_cast("bigint")


def to_int(c) -> Column:
    """String to BIGINT; NULL unless the text is a plain signed integer in 64-bit range."""
    c = col_of(c)
    return F.when(c.rlike(_INT_PATTERN), c.try_cast("bigint"))


def int_parsable(c) -> Column:
    """True when the text is a plain integer that fits a BIGINT (never NULL)."""
    return F.coalesce(to_int(c).isNotNull(), F.lit(False))


def double_parsable(c) -> Column:
    """True when the text parses as a DOUBLE (never NULL)."""
    return F.coalesce(to_double(c).isNotNull(), F.lit(False))
