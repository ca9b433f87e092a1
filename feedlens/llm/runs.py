"""Operator 11, periodic run detection: longest common extensions by suffix trees.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS,
2q)`` words long, that no neighbouring word extends. ``SuffixTree`` builds
Ukkonen's tree of a word sequence; a Euler tour of it, with constant-time
range minima, gives the lowest common ancestor of two leaves, whose string
depth is the longest common extension of two positions. One tree serves
the sequence, one its reversal. The leaf order gives the rank of every suffix,
and the next smaller suffix gives the longest Lyndon word at every position,
once under the order of the words and once under its opposite: every run holds such a word as
its root. Each root is extended to both sides by the two trees,
and kept where it repeats.

Trees are built only where a run can be. A run of q <= 6 has 12 words or more and
one of q > 6 has 2q or more, so all of its words lie in windows of six words that
occur again in the same document. Windows are compared by hashes first: equal
windows have equal hashes, so no run is lost, and a chance collision only
costs a tree. What is outside is in no run.

Texts are worked through one slice at a time; memory follows the longest
stretch of repeated words of one text. A document is judged by one task, and
nothing is shuffled.

Defined cases: null, empty or blank texts have no words and no runs; texts
under ``MIN_WORDS`` words have no runs; repeated rows are judged each; rows
without an id are judged, and their words are taken in order; an empty table gives an empty
result; input columns beside ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_WORDS = 12
BLOCK = 32

_STEP, _TEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class RangeMinimum:
    """Minima over ranges of an array in constant time each: a sparse table over blocks, prefix and suffix minima within."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(values)] = values
        square = padded.reshape(blocks, BLOCK)
        self.values = padded
        self.prefix = np.minimum.accumulate(square, axis=1).ravel()
        self.suffix = np.ascontiguousarray(np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [square.min(axis=1)]
        while 2 * (1 << (len(self.table) - 1)) <= blocks:
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of ``values[low : high + 1]``, element by element."""
        first, last = low // BLOCK, high // BLOCK
        out = np.minimum(self.suffix[low], self.prefix[high])
        between = last - first - 1
        for k, row in enumerate(self.table):
            at = np.flatnonzero((between >= (1 << k)) & (between < (2 << k)))
            if len(at):
                out[at] = np.minimum(out[at], np.minimum(row[first[at] + 1], row[last[at] - (1 << k)]))
        at = np.flatnonzero(first == last)
        step = max(1, (1 << 20) // BLOCK)
        for i in range(0, len(at), step):
            own = at[i : i + step]
            cell = self.values[(first[own] * BLOCK)[:, None] + np.arange(BLOCK)]
            place = np.arange(BLOCK)[None, :]
            inside = (place >= (low[own] % BLOCK)[:, None]) & (place <= (high[own] % BLOCK)[:, None])
            out[own] = np.where(inside, cell, np.iinfo(np.int32).max).min(axis=1)
        return out


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of numbers from 1 to ``symbols``, closed by the smallest symbol 0."""

    def __init__(self, sequence: list[int], symbols: int):
        s = [*sequence, 0]
        size, wide = len(s), symbols + 1
        self.size = size
        start, end, link = array("q", [0]), array("q", [0]), array("q", [0])
        edge: dict[int, int] = {}  # node * wide + first symbol of the edge, to the node below
        get = edge.get
        node = at = length = waiting = 0
        for place, symbol in enumerate(s):
            waiting += 1
            fresh = 0
            while waiting:
                if not length:
                    at = place
                key = node * wide + s[at]
                below = get(key)
                if below is None:
                    edge[key] = len(start)
                    start.append(place)
                    end.append(size)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    first = start[below]
                    span = end[below] - first
                    if length >= span:
                        at += span
                        length -= span
                        node = below
                        continue
                    if s[first + length] == symbol:
                        if fresh and node:
                            link[fresh] = node
                        length += 1
                        break
                    split = len(start)
                    start.extend((first, place))
                    end.extend((first + length, size))
                    link.extend((0, 0))
                    edge[key] = split
                    edge[split * wide + symbol] = split + 1
                    edge[split * wide + s[first + length]] = below
                    start[below] = first + length
                    if fresh:
                        link[fresh] = split
                    fresh = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = place - waiting + 1
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        self._below = np.fromiter(edge.values(), np.int64, len(edge))
        del edge
        self._parent, self._symbol = np.divmod(keys, wide)
        self._width = np.asarray(end, np.int64) - np.asarray(start, np.int64)
        self._wide = wide

    def _children(self, *, opposite: bool) -> tuple[list[int], list[int]]:
        """(nodes below, by parent and first symbol; where each parent's begin)."""
        symbol = (self._wide - self._symbol) % self._wide if opposite else self._symbol
        by = np.argsort(self._parent * self._wide + symbol)
        return self._below[by].tolist(), np.searchsorted(self._parent[by], np.arange(len(self._width) + 1)).tolist()

    def ranks(self, *, opposite: bool = False) -> np.ndarray:
        """Rank of every suffix; ``opposite``: larger symbols first (a prefix still comes before what it begins)."""
        below, begin = self._children(opposite=opposite)
        width, leaves, todo = self._width.tolist(), [], [(0, 0)]
        while todo:
            node, depth = todo.pop()
            low, high = begin[node], begin[node + 1]
            if low == high:
                leaves.append(self.size - depth)
            else:
                todo += [(v, depth + width[v]) for v in reversed(below[low:high])]
        out = np.empty(self.size, np.int64)
        out[leaves] = np.arange(self.size)
        return out

    def tour(self) -> tuple[RangeMinimum, np.ndarray, np.ndarray]:
        """(range minima of the string depths of a Euler tour, place of every suffix's leaf in it, rank of every suffix)."""
        below, begin = self._children(opposite=False)
        width, following, depth = self._width.tolist(), begin[:-1], [0] * len(self._width)
        depths, leaves, places, path = array("i"), [], [], []
        node = 0
        while True:
            k, last = following[node], begin[node + 1]
            if begin[node] == last:
                leaves.append(self.size - depth[node])
                places.append(len(depths))
            depths.append(depth[node])
            if k < last:
                following[node] = k + 1
                path.append(node)
                under = below[k]
                depth[under] = depth[node] + width[under]
                node = under
            elif path:
                node = path.pop()
            else:
                break
        place, rank = np.empty(self.size, np.int64), np.empty(self.size, np.int64)
        place[leaves] = places
        rank[leaves] = np.arange(self.size)
        return RangeMinimum(np.frombuffer(depths, np.int32)), place, rank


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every position, from the ranks of the suffixes: up to the next smaller one."""
    rank = rank.tolist()
    out, waiting = [0] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        r = rank[i]
        while waiting and rank[waiting[-1]] > r:
            waiting.pop()
        out[i] = (waiting[-1] if waiting else len(rank)) - i
        waiting.append(i)
    return np.array(out, np.int64)


def maximal_runs(numbers: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``max(min_words, 2 * period)`` in a sequence, in that order."""
    n = len(numbers)
    symbols, sequence = np.unique(numbers, return_inverse=True)
    sequence = (sequence + 1).tolist()
    tree = SuffixTree(sequence, len(symbols))
    minima, place, rank = tree.tour()
    roots = [lyndon_lengths(rank[:n]), lyndon_lengths(tree.ranks(opposite=True)[:n])]
    del tree

    def extension(minima: RangeMinimum, place: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of every pair of positions; the end of the sequence has none."""
        low, high = np.minimum(place[a], place[b]), np.maximum(place[a], place[b])
        return minima(low, high).astype(np.int64)

    i = np.concatenate([np.arange(n), np.arange(n)])
    period = np.concatenate(roots)
    fits = 2 * period <= n
    i, period = i[fits], period[fits]
    right = extension(minima, place, i, i + period)  # the empty suffix n is a leaf of its own
    minima, place, _ = SuffixTree(sequence[::-1], len(symbols)).tour()
    left = extension(minima, place, n - i, n - i - period)  # what ends before i and before i + period
    start, length = i - left, left + period + right
    found = length >= np.maximum(min_words, 2 * period)
    return np.unique(np.stack([start[found], length[found], period[found]], axis=1), axis=0)


def repeated_stretches(hashes: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Stretches of words in windows that occur twice in one text; ``first`` holds where each text begins, and the end.

    A run of period q and length L is ``L - q >= min_words / 2`` words that
    occur again q later, so all its windows of ``min_words / 2`` words do.
    """
    width = min_words // 2
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(hashes) - width + 1
    if n < 2:
        return []
    value = np.zeros(n, np.uint64)
    for k in range(width):
        value = (value ^ hashes[k : k + n]) * _STEP
        value ^= value >> np.uint64(29)
    value ^= text[:n].astype(np.uint64) * _TEXT
    whole = np.flatnonzero(text[:n] == text[width - 1 :])
    order = whole[np.argsort(value[whole], kind="stable")]
    same = value[order[1:]] == value[order[:-1]]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    edge = np.zeros(len(hashes) + 1, np.int32)
    at = order[again]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    inside = np.cumsum(edge[:-1]) > 0
    begins = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1] & (text[1:] == text[:-1]))))
    ends = np.flatnonzero(inside & ~np.concatenate((inside[1:] & (text[1:] == text[:-1]), [False]))) + 1
    return list(zip(begins.tolist(), ends.tolist(), strict=True))


def text_runs(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """The runs of every text, given as lists of words."""
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    hashes = np.fromiter((hash(w) for t in texts for w in t), np.int64, int(first[-1])).view(np.uint64)
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for a, b in repeated_stretches(hashes, first, min_words):
        if b - a < min_words:
            continue
        t = int(np.searchsorted(first, a, side="right")) - 1
        numbers: dict[bytes, int] = {}
        own = texts[t][a - first[t] : b - first[t]]
        runs = maximal_runs(np.array([numbers.setdefault(w, len(numbers)) for w in own]), min_words)
        runs[:, 0] += a - first[t]
        found[t].append(runs)
    return [np.concatenate(f) if f else np.zeros((0, 3), np.int64) for f in found]


def kept_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def find_runs(documents: DataFrame, *, min_words: int = MIN_WORDS, arranged: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``documents`` (doc_id, text).

    ``runs`` are ordered by start, then period; ``collapsed`` is the text of
    the words that stay when every run keeps its first period only, joined by
    one space. ``arranged(doc_id, n_words)`` may give the word numbers to look at in place of
    0 to n-1 (None: as they are).
    """
    if min_words < 4 or min_words % 2:
        raise ValueError("min_words must be even and at least 4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, off = common.utf8(batch.column(1))
            for i, j in common.slices(off):
                ids = batch.column(0).slice(i, j - i)
                texts = [t.split() for t in common.texts(batch.column(1).slice(i, j - i))]
                for r, doc_id in enumerate(ids.to_pylist() if arranged else []):
                    order = arranged(doc_id, len(texts[r])) if doc_id is not None else None
                    if order is not None:
                        own = texts[r]
                        texts[r] = [own[k] for k in order.tolist()]
                runs, collapsed = text_runs(texts, min_words), []
                for words, own in zip(texts, runs, strict=True):
                    if len(own):
                        keep = kept_words(own, len(words)).tolist()
                        words = [w for w, k in zip(words, keep, strict=True) if k]
                    collapsed.append(b" ".join(words))
                flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in runs]))).astype(np.int32)
                parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUNS.value_type))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), parts),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
