"""Operator 4, benchmark decontamination: distributed positional inverted index.

``build_index`` writes a table of postings of the test terms: one row per
document (its block of the index is the task that read it) with the term
numbers found, how often each occurs, and their positions in order. Only
terms of the test items are kept; positions are those in the whole text.
``phrase_matches`` and ``proximity_matches`` read the index, never the text:
global term counts rank the terms of every phrase, the list of its rarest
term gives the possible places, and the lists of the other terms, shifted by
their offsets, are intersected in order of rarity until none is left or all
agree. A proximity match is a smallest stretch of words, its first and last
at most ``span`` apart, that holds every term of a phrase in any order and
number; it too is entered from the rarest term, whose places are kept only
while each next term has a place within ``span``.

The index is divided by document, not by term: a frequent term or passage
meets no single task, and nothing is shuffled but one count per term and task.
Test items are worked through in blocks of at most ``BLOCK_TERMS`` words, so
what is broadcast (terms and phrases of one block, one block at a time) has a
fixed bound; each block makes one pass over the documents, which with several
blocks are numbered and written first, so that a row has one number in all.

Defined cases: null or empty texts have no words, hit nothing and are no
items; an item of fewer words than the window is one phrase; items without an
id mark words as hit, and are not counted; items repeated under one id count
once; documents repeated are judged each; an empty benchmark leaves every
document clean; other columns of the inputs are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 10
BLOCK_TERMS = 500_000
SPAN = 15  # words between the first and the last of a proximity match, at most
PAIRS = 1 << 20  # possible places of phrases looked at together in one document

INDEX_SCHEMA = "row bigint, doc_id bigint, mark bigint, n_words bigint, terms array<int>, counts array<int>, positions array<int>"


@dataclass
class Phrases:
    """Distinct phrases of one block of items: term numbers from 1, and the items that hold each phrase."""

    number: dict[bytes, int]
    terms: list[np.ndarray]
    items: list[list[str]]


def make_phrases(items: list[tuple[str | None, list[bytes]]], window: int) -> Phrases:
    """All windows of the items; equal windows are one phrase."""
    number: dict[bytes, int] = {}
    holders: dict[tuple[int, ...], set[str]] = {}
    for item, words in items:
        ids = [number.setdefault(w, len(number) + 1) for w in words]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            holders.setdefault(tuple(ids[i : i + window]), set()).update([] if item is None else [item])
    return Phrases(number, [np.array(p, np.int32) for p in holders], [sorted(x) for x in holders.values()])


def item_blocks(benchmark: DataFrame, block_terms: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of at most ``block_terms`` words (one item, if longer), read one partition at a time."""
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text is not null")
    block, held = [], 0
    for item, text in rows.toLocalIterator():
        words = common.words(text.encode())
        if block and held + len(words) > block_terms:
            yield block
            block, held = [], 0
        if words:
            block.append((item, words))
            held += len(words)
    if block:
        yield block


def numbered(documents: DataFrame) -> DataFrame:
    """``row, doc_id, mark, text`` of ``documents`` (doc_id, text): row numbers, and the hash of the text."""
    text = F.col("text").cast("string")
    return documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")
    )


def build_index(rows: DataFrame, phrases: Phrases) -> DataFrame:
    """The written index of the terms of ``phrases`` over every text of ``rows``, as ``numbered`` gives them."""
    number = rows.sparkSession.sparkContext.broadcast(phrases.number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.value.get
        for batch in batches:
            _, off = common.utf8(batch.column(3))
            for first, last in common.slices(off):
                n_words, terms, counts, positions = [], [], [], []
                for text in common.texts(batch.column(3).slice(first, last - first)):
                    words = common.words(text)
                    ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
                    at = np.flatnonzero(ids).astype(np.int32)
                    order = np.argsort(ids[at], kind="stable")
                    found, times = np.unique(ids[at], return_counts=True)
                    n_words.append(len(words))
                    terms.append(found)
                    counts.append(times)
                    positions.append(at[order])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k).slice(first, last - first) for k in range(3)), pa.array(n_words, pa.int64()),
                    _lists(terms), _lists(counts), _lists(positions),
                ], names=["row", "doc_id", "mark", "n_words", "terms", "counts", "positions"])

    return common.written(rows.mapInArrow(run, INDEX_SCHEMA), "postings")


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def term_counts(index: DataFrame, terms: int) -> np.ndarray:
    """Occurrences of every term over the whole index; one partial sum per term and task is shuffled."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n"))
    out = np.zeros(terms + 1, np.int64)
    for t, n in pairs.collect():  # at most one row per term of the block
        out[t] = n
    return out


class Searcher:
    """Phrases of one block, ordered by the rarity of their terms; searches one document's postings."""

    def __init__(self, phrases: list[np.ndarray], counts: np.ndarray):
        self.lengths = np.array([len(p) for p in phrases], np.int32)
        width = int(self.lengths.max())
        self.order = np.zeros((len(phrases), width), np.int32)  # offsets, rarest term first
        self.terms = np.zeros((len(phrases), width), np.int32)  # terms in that order; 0 past the end
        for i, p in enumerate(phrases):
            by = np.argsort(counts[p], kind="stable")
            self.order[i, : len(p)], self.terms[i, : len(p)] = by, p[by]
        self.distinct = np.zeros((len(phrases), width), np.int32)  # the same terms, each once
        for i, row in enumerate(self.terms.tolist()):
            once = [t for t in dict.fromkeys(row) if t]
            self.distinct[i, : len(once)] = once
        self.distinct = self.distinct[:, : max(1, int((self.distinct > 0).sum(1).max()))]
        self.here = np.zeros(len(counts), bool)
        self.here[0] = True
        self.by_rarest = np.argsort(self.terms[:, 0], kind="stable")
        self.rarest = self.terms[self.by_rarest, 0]

    def exact(self, n_words: int, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every occurrence in one document."""
        low, high = np.searchsorted(self.rarest, terms, "left"), np.searchsorted(self.rarest, terms, "right")
        has = high > low
        empty = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not has.any():
            return empty
        # The lists as one array by position: term_at[p] is the term whose list holds p.
        term_at = np.zeros(n_words + 1, np.int32)
        term_at[positions] = np.repeat(terms, counts)
        ends = np.cumsum(counts)
        parts = []
        for t in np.flatnonzero(has).tolist():
            at = positions[ends[t] - counts[t] : ends[t]].astype(np.int64)
            step = max(1, PAIRS // len(at))
            for i in range(low[t], high[t], step):
                phrase = self.by_rarest[i : min(i + step, high[t])]
                start = at[None, :] - self.order[phrase, 0][:, None]
                fits = (start >= 0) & (start + self.lengths[phrase][:, None] <= n_words)
                p, s = np.repeat(phrase, len(at))[fits.ravel()], start.ravel()[fits.ravel()]
                for k in range(1, self.terms.shape[1]):  # the next rarest list, shifted by its offset
                    if not len(p):
                        break
                    same = (self.terms[p, k] == 0) | (term_at[s + self.order[p, k]] == self.terms[p, k])
                    p, s = p[same], s[same]
                parts.append((p, s))
        return np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts])

    def near(self, n_words: int, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
        """(phrase, start, end) of every smallest stretch, ends at most ``span`` words apart, with all terms of a phrase."""
        low, high = np.searchsorted(self.rarest, terms, "left"), np.searchsorted(self.rarest, terms, "right")
        has = np.flatnonzero(high > low)
        empty = (np.zeros(0, np.int64),) * 3
        if not len(has):
            return empty
        phrase = self.by_rarest[np.concatenate([np.arange(low[t], high[t]) for t in has.tolist()])]
        self.here[terms] = True
        for k in range(1, self.distinct.shape[1]):  # phrases whose terms are all in the document
            phrase = phrase[self.here[self.distinct[phrase, k]]]
        self.here[terms] = False
        if not len(phrase):
            return empty
        # All lists as one sorted array: list number times (n_words + 1), plus position.
        size, ends = n_words + 1, np.cumsum(counts, dtype=np.int64)
        keys = np.repeat(np.arange(len(terms)), counts) * size + positions
        found = [empty]
        times = counts[np.searchsorted(terms, self.distinct[phrase, 0])].astype(np.int64)
        limit = max(1, PAIRS // (span + 2))
        group = np.cumsum(times) // limit  # phrases of at most ``limit`` places together, or one phrase
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        for i, j in zip(cuts.tolist(), [*cuts.tolist()[1:], len(phrase)], strict=True):
            some, many = phrase[i:j], times[i:j]
            first = np.searchsorted(terms, self.distinct[some, 0])
            p = np.repeat(some, many)
            x = positions[np.repeat(ends[first] - counts[first] - np.cumsum(many) + many, many) + np.arange(len(p))].astype(np.int64)
            for k in range(1, self.distinct.shape[1]):
                if not len(p):
                    break
                after, before = self._beside(terms, counts, ends, keys, size, self.distinct[p, k], x)
                close = (self.distinct[p, k] == 0) | (after - x <= span) | (x - before <= span)
                p, x = p[close], x[close]
            for a in range(0, len(p), limit):
                found.append(self._stretches(terms, counts, ends, keys, size, p[a : a + limit], x[a : a + limit], span))
        p, start, end = (np.concatenate(c) for c in zip(*found, strict=True))
        _, once = np.unique(p * size + start, return_index=True)  # a start has one end
        return p[once], start[once], end[once]

    @staticmethod
    def _beside(terms, counts, ends, keys, size, wanted, x) -> tuple[np.ndarray, np.ndarray]:
        """The first position of each wanted term from ``x`` on, and the last before ``x``; far off where there is none."""
        t = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
        j = np.clip(np.searchsorted(keys, t * size + x), ends[t] - counts[t], ends[t])
        after = np.where(j < ends[t], keys[np.minimum(j, len(keys) - 1)] - t * size, 4 * size)
        return after, np.where(j > ends[t] - counts[t], keys[np.maximum(j - 1, 0)] - t * size, -4 * size)

    def _stretches(self, terms, counts, ends, keys, size, p, x, span) -> tuple[np.ndarray, ...]:
        start = x[:, None] + np.arange(-span, 2)  # every start that reaches x, and one more
        last = start.copy()
        for k in range(self.distinct.shape[1]):
            wanted = np.broadcast_to(self.distinct[p, k][:, None], start.shape)
            after, _ = self._beside(terms, counts, ends, keys, size, wanted, np.maximum(start, 0))
            last = np.where(wanted == 0, last, np.maximum(last, after))
        least = (start[:, :-1] >= 0) & (last[:, :-1] - start[:, :-1] <= span) & (last[:, 1:] > last[:, :-1])
        at, k = np.nonzero(least)
        return p[at], start[at, k], last[at, k] + 1


MATCH_SCHEMA = "row bigint, doc_id bigint, mark bigint, n_words bigint,"\
    " hits array<struct<start:bigint,`end`:bigint>>, items array<string>, near array<struct<start:bigint,`end`:bigint>>, near_items array<string>"
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _postings(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    n_words = batch.column(3).to_numpy()
    lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns[4:7]]
    for r, n in enumerate(n_words.tolist()):
        yield n, *(values[off[r] : off[r + 1]] for off, values in lists)


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same words, by start."""
    out: list[list[int]] = []
    for s, e in sorted(zip(start.tolist(), end.tolist(), strict=True)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def phrase_matches(index: DataFrame, phrases: Phrases, counts: np.ndarray, *, span: int | None = None) -> DataFrame:
    """One row per document of the index: merged spans of words inside any phrase, and the items with a phrase there.

    ``near`` and ``near_items`` are the same of proximity matches within ``span``; empty without a ``span``.
    """
    sent = index.sparkSession.sparkContext.broadcast((phrases.terms, phrases.items, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, held = Searcher(sent.value[0], sent.value[2]), sent.value[1]

        def spans(start, end):
            return [{"start": a, "end": b} for a, b in merged(start, end)]

        def holders(p):
            return sorted({x for k in np.unique(p).tolist() for x in held[k]})

        for batch in batches:
            hits, items, near, near_items = [], [], [], []
            for n, terms, times, positions in _postings(batch):
                p, s = searcher.exact(n, terms, times, positions)
                hits.append(spans(s, s + searcher.lengths[p]))
                items.append(holders(p))
                p, s, e = ((), (), ()) if span is None else searcher.near(n, terms, times, positions, span)
                near.append(spans(s, e) if len(p) else [])
                near_items.append(holders(p) if len(p) else [])
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(hits, _HITS), pa.array(items, strings), pa.array(near, _HITS), pa.array(near_items, strings)],
                names=["row", "doc_id", "mark", "n_words", "hits", "items", "near", "near_items"],
            )

    return index.mapInArrow(run, MATCH_SCHEMA)


def proximity_matches(index: DataFrame, phrases: Phrases, counts: np.ndarray, *, span: int = SPAN) -> DataFrame:
    """``row, doc_id, phrase, start, end``: every smallest stretch of words, its ends at most ``span`` apart, with all terms of a phrase."""
    sent = index.sparkSession.sparkContext.broadcast((phrases.terms, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*sent.value)
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for r, (n, *lists) in enumerate(_postings(batch)):
                p, s, e = searcher.near(n, *lists, span)
                if len(p):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows[r]] * len(p), pa.int64()), pa.array([ids[r]] * len(p), pa.int64()), *(pa.array(c, pa.int64()) for c in (p, s, e))],
                        names=["row", "doc_id", "phrase", "start", "end"],
                    )

    return index.mapInArrow(run, "row bigint, doc_id bigint, phrase bigint, start bigint, `end` bigint")


NO_HITS = "cast(array() as array<struct<start:bigint,`end`:bigint>>)"
NO_ITEMS = "cast(array() as array<string>)"
FOUND = {"hits": NO_HITS, "items": NO_ITEMS, "near": NO_HITS, "near_items": NO_ITEMS}  # columns of matches, and their value where there is none


def find_contamination(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, span: int | None = SPAN, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per document: ``doc_id, mark, n_words, hits, items, near, near_items`` over all items of ``benchmark`` (item_id, text).

    ``hits`` are disjoint spans of words inside any occurrence of a window,
    ``items`` the sorted ids of the items with an occurring window, ``mark`` the
    xxhash64 of the text. ``near`` and ``near_items`` are the words and items of
    proximity matches of the windows within ``span`` (none is searched, and both
    are empty, where it is null). With one block of items no rows are shuffled; with
    more, each block's hits are written before the next block goes out, and
    join the documents' numbers by row.
    """
    blocks = item_blocks(benchmark, block_terms)
    block, following = next(blocks, []), next(blocks, None)
    # Scanned again after an executor is lost, a table may be split otherwise: with several blocks the numbers are written.
    rows = numbered(documents) if following is None else common.written(numbered(documents), "numbered")
    every, path = None, None
    while block is not None:
        phrases = make_phrases(block, window)
        index = build_index(rows, phrases)
        if not block:
            return index.select("doc_id", "mark", "n_words", *(F.expr(none).alias(c) for c, none in FOUND.items()))
        matches = phrase_matches(index, phrases, term_counts(index, len(phrases.number)), span=span)
        if every is None and following is None:
            return matches.drop("row")
        every = index.select("row", "doc_id", "mark", "n_words") if every is None else every
        # Written here, so that the terms and phrases of one block at a time are held.
        path = path or common.scratch_path(rows.sparkSession, "block-matches")
        hit = matches.where((F.size("hits") > 0) | (F.size("near") > 0)).select("row", *FOUND)
        hit.write.mode("append").parquet(path)
        block, following = following, next(blocks, None)
    found = rows.sparkSession.read.schema(hit.schema).parquet(path).groupBy("row").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in FOUND))
    whole = [merge_spans(c) if none == NO_HITS else F.array_sort(F.array_distinct(c)) for c, none in FOUND.items()]
    found = found.select("row", *(x.alias(c) for c, x in zip(FOUND, whole, strict=True)))
    return every.join(found, "row", "left").select("doc_id", "mark", "n_words", *(F.coalesce(c, F.expr(none)).alias(c) for c, none in FOUND.items()))


def merge_spans(column: str):
    """Disjoint spans that cover the same words as the spans of ``column``."""
    return F.expr(
        f"aggregate(array_sort({column}), cast(array() as array<struct<start:bigint,`end`:bigint>>), (acc, x) ->"
        " case when size(acc) > 0 and x.start <= element_at(acc, -1).`end` then"
        " concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end',"
        " greatest(element_at(acc, -1).`end`, x.`end`)))) else concat(acc, array(x)) end)"
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``documents`` without the rows that hold a word of any benchmark window; all columns kept.

    Rows that share an id are told apart by their text's hash.
    """
    hit = find_contamination(documents, benchmark, window=window, span=None).where(F.size("hits") > 0)
    hit_id, hit_mark = common.fresh(documents, "_hit_id", "_hit_mark")
    hit = hit.select(F.col("doc_id").alias(hit_id), F.col("mark").alias(hit_mark)).distinct().hint("shuffle_hash")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(hit_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(hit_mark))
    return documents.join(hit, same, "left_anti")
