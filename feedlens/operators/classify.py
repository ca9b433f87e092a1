"""Engagement classification: per-row class and the per-class summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, ratio, to_double, to_int, zero_guard_numeric, zero_guard_string
from ..schema import AVERAGE_COMMENTS, CLASS_ORDER, CLASSIFICATION, VIDEOS_NUMBER


def with_class(df: DataFrame, *, semantics: str = "string", out: str = "cls") -> DataFrame:
    """Add the ratio class. ``string``: dislikes text '0' -> '1'; ``numeric``: value 0 -> 1."""
    if semantics == "string":
        dislikes = zero_guard_string("dislikes")
    elif semantics == "numeric":
        dislikes = zero_guard_numeric("dislikes")
    else:
        raise ValueError(f"unknown semantics {semantics!r}")
    # The ratio gets its own projection: it is referenced by every branch of
    # the class expression and must be computed once per row, not per branch.
    return df.withColumn("_ratio", ratio("likes", dislikes)).withColumn(out, classify("_ratio")).drop("_ratio")


def class_totals(df: DataFrame, cls: str, value: str) -> DataFrame:
    """One row: per class ``n_<class>`` (rows) and ``s_<class>`` (sum of value).

    A single global aggregate with conditional sums does all classes in one
    pass: a partial aggregate per task and one tiny final merge, no shuffle
    by class. The class column is computed once in the projection below the
    aggregate; nothing filters on it, so Catalyst never copies the class
    expression into a pushed-down predicate.
    """
    aggs = []
    for name in CLASS_ORDER:
        hit = F.col(cls) == F.lit(name)
        aggs.append(F.count_if(hit).alias(f"n_{name}"))
        aggs.append(F.sum(F.when(hit, F.col(value))).alias(f"s_{name}"))
    return df.agg(*aggs)


def rows_from_totals(totals: DataFrame, value_type: str = "double") -> DataFrame:
    """The one-row output of ``class_totals`` as one row per class (fixed order)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias(CLASSIFICATION),
                F.col(f"n_{name}").alias(VIDEOS_NUMBER),
                (F.col(f"s_{name}").cast(value_type) / F.nullif(F.col(f"n_{name}"), F.lit(0)))
                .cast("double")
                .alias(AVERAGE_COMMENTS),
            )
            for name in CLASS_ORDER
        ]
    )
    return totals.select(F.inline(rows))


def summarize_fixed_classes(df: DataFrame, *, cls: str = "cls", value: str = "comments") -> DataFrame:
    """Exactly one row per class, in the fixed order neutral, good, bad.

    ``VideosNumber`` counts the class rows, ``AverageComments`` is
    ``sum(value) / count(*)``: rows with a NULL value still count in the
    divisor; an empty class gives ``0, NULL``.
    """
    return rows_from_totals(class_totals(df, cls, value), "double")


def summarize_by_class(df: DataFrame, *, cls: str = "cls", value: str = "comments") -> DataFrame:
    """One row per non-empty class: count and ``sum(value) / count`` (NULL class dropped).

    ``value`` is integral; its sum is exact (BIGINT) before the division.
    Empty classes are removed after the aggregate, on the aggregated rows.
    """
    totals = df.select(cls, F.col(value).cast("bigint").alias(value))
    return rows_from_totals(class_totals(totals, cls, value), "double").filter(F.col(VIDEOS_NUMBER) > 0)


def class_rows_string(feed: DataFrame) -> DataFrame:
    """(cls, comments) per row under string semantics; comments parse as DOUBLE."""
    return with_class(feed, semantics="string").select("cls", to_double("comment_count").alias("comments"))


def class_rows_numeric(feed: DataFrame) -> DataFrame:
    """(cls, comments) per row under numeric semantics; comments parse as BIGINT."""
    return with_class(feed, semantics="numeric").select("cls", to_int("comment_count").alias("comments"))
