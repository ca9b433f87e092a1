"""Attaching category names from an ``(id, category)`` dictionary.

A broadcast join is used only behind a size check: one partial aggregate
counts the dictionary's rows and bytes, and it is broadcast only within both
bounds. Beyond that the join is a shuffle join by id. The rows of every id are
counted first; an id that holds more than ``HOT_ROWS`` rows, and more than
one in ``HOT_IDS`` of all, is dealt over as many join tasks as it has such
portions, and only its names are copied to them. All other ids, and
their names, are joined once and as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest dictionary broadcast to every task, in rows and in bytes of its cells.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 << 20

# Beyond that bound: the most rows of one id that go to one join task, and the
# most ids that are treated as hot (so the list of hot ids is bounded: no more
# than HOT_IDS ids can each hold more than 1 / HOT_IDS of the rows).
HOT_ROWS = 1_000_000
HOT_IDS = 10_000
STREAM_COPIES = 32


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` is within the broadcast bound in rows and in bytes of its cells.

    One aggregate with a partial result per task: nothing but counts is shuffled.
    """
    cell = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint") for c in df.columns]
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(cell[1:], cell[0])), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def dedupe_dictionary(dictionary: DataFrame, *, id_col: str = "id", name: str = "category") -> DataFrame:
    """One name per id (the greatest), so repeated ids cannot fan a join out.

    A partial ``max`` per task before the shuffle on the id.
    """
    return dictionary.groupBy(id_col).agg(F.max(name).alias(name))


def hot_ids(df: DataFrame, on: str, *, hot_rows: int = HOT_ROWS, max_ids: int = HOT_IDS) -> DataFrame | None:
    """``hot_id, copies`` of the ids of ``df`` with too many rows for one task; None without any.

    One count by id, partial per task; NULL counts as an id of its own. At
    most ``max_ids`` rows reach the driver and are broadcast later.
    """
    counts = df.groupBy(F.col(on).alias("hot_id")).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > hot_rows).orderBy(F.col("n").desc(), "hot_id").limit(max_ids)
    rows = [(r["hot_id"], -(-r["n"] // hot_rows)) for r in hot.collect()]
    id_type = df.schema[on].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"hot_id {id_type}, copies bigint") if rows else None


def attach_name(
    df: DataFrame,
    dictionary: DataFrame,
    *,
    on: str = "category_id",
    id_col: str = "id",
    name: str = "category",
    how: str = "inner",
    default: str | None = None,
    broadcast: bool | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Join ``dictionary.name`` onto ``df`` by ``df[on] == dictionary[id_col]``.

    ``how='inner'`` drops rows with an unknown id (and fans out on repeated
    ids); ``how='left'`` keeps them, with ``default`` as their name when given.

    ``broadcast`` is the caller's decision where it has already measured the
    dictionary; None measures it here. In the shuffle join the ids of more
    than ``hot_rows`` rows are counted out first (``hot_ids``): their
    rows get a salt below their number of copies, from a hash of their own
    values, and only their names are copied, with a generator. The salt
    is deterministic, so a retried task sends every row where it went before.
    ``hot_rows=None`` skips the count and joins by id alone.
    """
    if name in df.columns:
        raise ValueError(f"input already has a {name!r} column; rename it before attaching names")
    names = dictionary.select(F.col(id_col).alias(on), F.col(name))
    if fits_broadcast(dictionary, broadcast_max_rows) if broadcast is None else broadcast:
        out = df.join(F.broadcast(names), on=on, how=how)
    else:
        hot = None
        if hot_rows is not None:
            # The rows of a stream cannot be counted ahead: all its ids are dealt alike.
            hot = F.lit(STREAM_COPIES) if df.isStreaming else hot_ids(df, on, hot_rows=hot_rows)
        out = df.join(names, on=on, how=how) if hot is None else _join_dealt(df, names, hot, on=on, how=how)
    if default is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return out


def _join_dealt(df: DataFrame, names: DataFrame, hot: DataFrame | Column, *, on: str, how: str) -> DataFrame:
    """The shuffle join with rows dealt over copies of their names.

    ``hot``: the ids with their copies (at most ``HOT_IDS`` rows, broadcast), or one number of copies for every id.
    """

    def with_copies(side: DataFrame) -> DataFrame:
        if isinstance(hot, Column):
            return side.withColumn("_copies", hot.cast("bigint"))
        found = side.join(F.broadcast(hot), F.col(on).eqNullSafe(F.col("hot_id")), "left")
        return found.withColumn("_copies", F.coalesce("copies", F.lit(1).cast("bigint"))).drop("hot_id", "copies")

    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_copies"))
    dealt = with_copies(df).withColumn("_salt", salt).drop("_copies")
    copied = with_copies(names).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1))).drop("_copies")
    return dealt.join(copied, on=[on, "_salt"], how=how).drop("_salt")
