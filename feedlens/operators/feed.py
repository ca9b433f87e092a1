"""Row-level operators over feeds: union, flag filters, parse filters, first per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import double_parsable, flags_all_false, flags_none_true, int_parsable

FLAG_COLUMNS = ("comments_disabled", "ratings_disabled")


def as_list(feeds) -> list[DataFrame]:
    if isinstance(feeds, DataFrame):
        return [feeds]
    out = list(feeds)
    if not out:
        raise ValueError("at least one feed is required")
    return out


def union_feeds(
    feeds: DataFrame | Iterable[DataFrame], *, by_name: bool = True, allow_missing_columns: bool = False
) -> DataFrame:
    """Bag union of several feeds (duplicates kept).

    ``by_name`` matches columns by name, so feeds whose files order the
    columns differently still line up; ``by_name=False`` is the positional
    union. ``allow_missing_columns`` fills a column absent from some feeds
    with NULL instead of failing. A union is a narrow operation: no shuffle,
    the scans run side by side.
    """
    dfs = as_list(feeds)
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=allow_missing_columns) if by_name else out.union(df)
    return out


def union_of_slices(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Bag union of the slices of ``df`` where ``column`` equals each value: the rows of all of them in one scan.

    The same rows as filtering once per value and uniting the results, which
    would read the input as often. A value listed twice gives its rows twice.
    """
    times = {v: list(values).count(v) for v in values}
    kept = df.filter(F.col(column).isin(*times))
    if all(n == 1 for n in times.values()):
        return kept
    copies = F.create_map(*[F.lit(x) for pair in times.items() for x in pair])[F.col(column)]
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def counted(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    """``df``, and the counts that whatever action runs it takes along (no job of its own).

    ``rows`` counts all rows; each further metric is an aggregate expression.
    The counts are there, in ``.get``, once an action over the returned frame has ended.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[expr.alias(name) for name, expr in metrics.items()]), seen


def keep_enabled(df: DataFrame, *, semantics: str = "string", flags: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """Keep rows whose comments and ratings are enabled.

    ``string``: every flag must be exactly 'False'. ``not_true``: drop a row
    only when a flag is exactly 'True' (NULL kept). Pushed down to the scan
    when the source supports it.
    """
    if semantics == "string":
        return df.filter(flags_all_false(*flags))
    if semantics == "not_true":
        return df.filter(flags_none_true(*flags))
    raise ValueError(f"unknown semantics {semantics!r}")


def parsable_rows(df: DataFrame, *, ints: Sequence[str] = (), doubles: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose given cells parse (strict integers / doubles)."""
    cond = F.lit(True)
    for c in ints:
        cond = cond & int_parsable(c)
    for c in doubles:
        cond = cond & double_parsable(c)
    return df.filter(cond)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest row by ``order`` (default: all other columns).

    Ordering on every remaining column makes the pick deterministic: two
    rows can only tie if they are identical. It is an aggregate
    (``min`` over a struct), not a window, so a key holding a large share of
    the rows is reduced map-side before the shuffle instead of landing whole
    in one task. NULLs order first, as in ascending SQL order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    payload = [c for c in rest if c not in order]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    fields += [F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    named = {c: F.col(f"_first.o{i}") for i, c in enumerate(order)}
    named.update({c: F.col(f"_first.p{i}") for i, c in enumerate(payload)})
    return best.select(*[F.col(c) if c in keys else named[c].alias(c) for c in df.columns])
