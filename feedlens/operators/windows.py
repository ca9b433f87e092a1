"""Running lists over a ranked group and the grouped maximum of arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tag_with_count
from ..schema import TOP_K
from .tags import top_k


def running_list(
    df: DataFrame, keys: Sequence[str], k: int = TOP_K, *, n: str = "n", tag: str = "tag", out: str = "running", peers: bool = False
) -> DataFrame:
    """Per top-k row: the list of ``tag#n`` of all rows ranked up to and including it.

    The group is cut to its top k first (count descending, tag ascending), so a
    list never holds more than k entries. Without ``peers`` the frame is that of
    rows: the order is total, and each row's list is one longer than the one before.
    With ``peers`` the frame is SQL's default for an order by count alone, a range that ends with the
    last row of the same count: rows of one count share one list. Entries are
    listed by count, and by tag within a count, so the list does not depend on
    the order in which equal rows arrive.
    """
    df = top_k(df, keys, k, n=n, tag=tag)
    if peers:
        entries = F.collect_list(F.struct((-F.col(n)).alias("k"), F.col(tag).alias("tag"))).over(Window.partitionBy(*keys).orderBy(F.col(n).desc()))
        return df.withColumn(out, F.transform(F.array_sort(entries), lambda e: tag_with_count(e["tag"], -e["k"])))
    w = (
        Window.partitionBy(*keys)
        .orderBy(F.col(n).desc(), F.col(tag).asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.collect_list(tag_with_count(tag, n)).over(w))


def longest_list(df: DataFrame, keys: Sequence[str], *, col: str = "running", out: str | None = None) -> DataFrame:
    """Grouped ``max`` of an array column (lexicographic; for running lists, the full one)."""
    return df.groupBy(*keys).agg(F.max(col).alias(out or col))
