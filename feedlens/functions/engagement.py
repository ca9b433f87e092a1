"""Column expressions of the engagement classification.

Two families of semantics exist for the same analytic and are kept apart:

* ``string`` semantics: flags must equal ``'False'``; a dislikes cell equal to
  the text ``'0'`` is replaced by ``'1'`` before any parsing.
* ``numeric`` semantics: a flag equal to ``'True'`` drops the row (NULL and
  other text are kept); a dislikes value that parses to 0 counts as 1.

The ratio is NULL when either side does not parse, when the divisor is 0 and
when it is NaN; a NULL ratio belongs to no class.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BAD, FLAG_FALSE, FLAG_TRUE, GOOD, NEUTRAL, RATIO_HIGH, RATIO_LOW
from .casts import col_of, to_double


def flags_all_false(*cols) -> Column:
    """Every flag equals 'False' (NULL or any other text rejects the row)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.coalesce(col_of(c) == F.lit(FLAG_FALSE), F.lit(False))
    return cond


def flags_none_true(*cols) -> Column:
    """No flag equals 'True' (NULL and other text keep the row)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~col_of(c).eqNullSafe(F.lit(FLAG_TRUE))
    return cond


def zero_guard_string(c) -> Column:
    """Text '0' becomes '1'; every other value (also '0.0', '00') is kept."""
    c = col_of(c)
    return F.when(c == F.lit("0"), F.lit("1")).otherwise(c)


def zero_guard_numeric(c) -> Column:
    """Parsed value 0 becomes 1.0; unparsable text gives NULL."""
    v = to_double(c)
    return F.when(v == F.lit(0.0), F.lit(1.0)).otherwise(v)


def ratio(numerator, denominator) -> Column:
    """numerator / denominator as DOUBLE; NULL on parse failure, /0 or NaN."""
    q = F.try_divide(to_double(numerator), to_double(denominator))
    return F.when(~F.isnan(q), q)


def classify(r) -> Column:
    """Class of a ratio: > 6 good, < 4 bad, [4, 6] neutral, NULL for NULL."""
    r = col_of(r)
    return (
        F.when(r > F.lit(RATIO_HIGH), F.lit(GOOD))
        .when(r < F.lit(RATIO_LOW), F.lit(BAD))
        .when(r.between(RATIO_LOW, RATIO_HIGH), F.lit(NEUTRAL))
    )


def in_range(r, low=RATIO_LOW, high=RATIO_HIGH) -> Column:
    """Closed interval test ``low <= r <= high`` (False for NULL)."""
    return F.coalesce(col_of(r).between(low, high), F.lit(False))
