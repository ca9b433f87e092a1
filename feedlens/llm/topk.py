"""Operator 6, exact top-k by inner product: Fagin's threshold algorithm.

Rows are numbered and dealt into blocks of about ``BLOCK_ROWS`` candidates; a block holds
one sorted list per dimension. For a query the lists are read in parallel,
from the top where the query's component is positive and from the bottom
where it is negative, a doubling number of places at a time. Every row seen
for the first time is scored in full (random access). The sum of query
component times the value last read bounds the score of every row not yet
seen: the search of the block stops once that bound is below the kth score so far;
at a tie it goes on, as an unseen row of equal score may have the smaller id.

Queries are a table too, dealt into blocks of about ``QUERY_ROWS``. Every block of queries meets
every block of candidates as a group of its own, in two rounds: first each
query searches one block of candidates, and the kth score it finds there goes with the
query into the search of all others, which may stop, and leave rows out, below it.
Both blocks of a group are bounded, the number of jobs does not depend on the number of
queries, and no row passes the driver. The best k of all blocks of a query
meet by its row number, after each task has cut its own.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component, and rows without an id, take no part; shorter vectors count as
padded with zeros; rows that repeat an id are candidates each and queries each (a query leaves out its own
row only, so it finds the others of its id); a query with fewer than k others gets
all; ties go to the smaller id; an empty table gives an empty result; other
columns of the input are not looked at. Components are floor(scale * x) and
scores whole numbers; both must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

BLOCK_ROWS = 8192
QUERY_ROWS = 4096
FIRST_DEPTH = 32


def whole_vectors(embeddings: DataFrame, *, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``row, vec_id, v``: the rows that take part, with a number each (to be written) and components floor(scale * x)."""
    x = F.col(vector_column).cast("array<double>")
    rows = embeddings.select(F.col(id_column).cast("bigint").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
    )
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("bigint")).alias("v"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = lists.combine_chunks()
    off, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    size = np.diff(off)
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(lists)), size), np.arange(off[0], off[-1]) - np.repeat(off[:-1], size)] = values[off[0] : off[-1]]
    return out


class Block:
    """Candidates of one block with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        """``rows``: a number of each row, by which a query leaves out its own (the ids, if there are no others)."""
        rows = ids if rows is None else rows
        by = np.lexsort((rows, ids))  # rows in id order: a stable choice by score keeps the smaller id
        self.ids, self.vectors, self.rows = ids[by], vectors[by], rows[by]
        order = np.argsort(self.vectors, axis=0, kind="stable")
        self.up = np.ascontiguousarray(order.T.astype(np.int32))  # per dimension, smallest first
        self.sorted = np.ascontiguousarray(np.take_along_axis(self.vectors, order, 0).T)
        # Products in doubles are exact while every score stays below 2**53.
        most = float(np.abs(self.vectors).max(initial=0))
        self.most = most
        self.quick = self.vectors.astype(np.float64)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best rows but the one numbered ``own``, by score, then id; none below ``floor``."""
        n, used = len(self.ids), np.flatnonzero(query)
        exact = self.most * float(np.abs(query).sum()) < 2.0**53
        table, q = (self.quick, query.astype(np.float64)) if exact else (self.vectors, query)
        if not len(used):
            rows = np.arange(min(n, k + 1))  # every score is 0: the smallest ids
            rows = rows[self.rows[rows] != own][: 0 if floor is not None and floor > 0 else k]
            return rows, np.zeros(len(rows), np.int64)
        down = query[used] > 0
        seen = np.zeros(n, bool)
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, q.dtype)
        at, depth = 0, FIRST_DEPTH
        while at < n:
            to = min(n, at + depth)
            high, low = used[down], used[~down]
            fresh = np.zeros(n, bool)
            fresh[self.up[high, n - to : n - at].ravel()] = True
            fresh[self.up[low, at:to].ravel()] = True
            rows = np.flatnonzero(fresh & ~seen)
            seen[rows] = True
            rows = rows[self.rows[rows] != own]
            best_rows, best = np.concatenate([best_rows, rows]), np.concatenate([best, table[rows] @ q])
            if len(best) > k:
                keep = np.lexsort((best_rows, -best))[:k] if len(best) < 4 * k else self._top(best_rows, best, k)
                best_rows, best = best_rows[keep], best[keep]
            bound = (self.sorted[high, n - to] * query[high]).sum() + (self.sorted[low, to - 1] * query[low]).sum()
            if (floor is not None and bound < floor) or (len(best) >= k and bound < best.min()):
                break
            at, depth = to, depth * 2
        order = np.lexsort((best_rows, -best))[:k]
        order = order if floor is None else order[best[order] >= floor]
        return best_rows[order], best[order].astype(np.int64)

    @staticmethod
    def _top(rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        over, ties = np.flatnonzero(scores > kth), np.flatnonzero(scores == kth)
        ties = ties[np.argsort(rows[ties], kind="stable")][: k - len(over)]
        return np.concatenate([over, ties])


def top_k(embeddings: DataFrame, *, k: int, every: int, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding",
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every id divisible by ``every`` its k best other rows."""
    rows = common.written(whole_vectors(embeddings, id_column=id_column, vector_column=vector_column, scale=scale), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    shape = rows.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries")).first()
    width, blocks, query_blocks = shape["width"] or 0, max(1, -(-shape["n"] // block_rows)), max(1, -(-shape["queries"] // query_rows))
    candidates = rows.select(F.col("row").alias("of"), F.col("vec_id").alias("id"), F.col("v").alias("vector"), F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("c"))
    queries = rows.where(is_query).withColumn("q", F.pmod(F.xxhash64("row", F.lit("q")), F.lit(query_blocks)))

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if asked.num_rows and given.num_rows:
            block = Block(given.column("id").to_numpy(), _matrix(given.column("vector"), width), given.column("of").to_numpy())
            columns = asked.column("row").to_pylist(), asked.column("vec_id").to_pylist(), asked.column("least").to_pylist()
            for own, query_id, least, query in zip(*columns, _matrix(asked.column("v"), width), strict=True):
                at, scores = block.search(own, query, k, least)
                found.append((np.full(len(at), own), np.full(len(at), query_id), block.ids[at], scores))
        parts = [np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(x) for x in parts], names=["row", "query_id", "vec_id", "score"])

    def answers(asked: DataFrame, given: DataFrame) -> DataFrame:
        """The best rows of every query of ``asked`` (q, c, row, vec_id, v, least) in the block ``c`` of ``given`` (q, c, of, id, vector)."""
        return asked.groupBy("q", "c").cogroup(given.groupBy("q", "c")).applyInArrow(run, "row bigint, query_id bigint, vec_id bigint, score bigint")

    # Round one: the queries of a block search one block of candidates.
    chosen = F.pmod(F.col("q"), F.lit(blocks))
    one = queries.withColumn("c", chosen).withColumn("least", F.lit(None).cast("bigint"))
    needed = candidates.withColumn("q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))))
    first = common.written(answers(one, needed.where(F.col("c") == chosen)), "top-k-first")
    # Round two: all others, from the kth score of round one on.
    kth = first.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k).select("row", "least")
    others = queries.withColumn("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).where(F.col("c") != chosen)
    second = answers(others.join(kth, "row", "left"), needed.where(F.col("c") != chosen))
    best = first if blocks == 1 else first.unionByName(common.written(second, "top-k-others"))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
