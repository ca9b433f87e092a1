"""Sorted Arrow streams: the rows of one key after another, across batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def key_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of equal values in the first ``keys`` columns (numbers, not null), from batches sorted by them.

    Holds the rows of one key at a time; the caller sees to it that a key has
    a bounded number of rows.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def first_of_run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(value, first value of its key) per batch of sorted (key, value) rows, where they differ, without repeats in a batch.

    Keeps one pair between batches, however long a key's run is.
    """
    key, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        new[0] = key is None or k[0] != key
        at = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
        lead = np.where(at >= 0, v[at], first if first is not None else v[0])
        key, first = k[-1], lead[-1]
        differ = v != lead
        if differ.any():
            pairs = np.unique(np.stack([v[differ], lead[differ]], 1), axis=0)
            yield pairs[:, 0], pairs[:, 1]


def repeated(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, value, frequency) of sorted (key, value) rows whose key has two values or more; rows that repeat are one.

    ``frequency`` is that of the key, its number of values as a power of two, rounded down; above
    ``most`` values all have one. Keeps up to ``most`` rows between batches, however long a key's run is.
    """
    top = most.bit_length()
    key, value = np.zeros(0, np.int64), np.zeros(0, np.int64)
    last, frequent = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
        new[0] = (k[0], v[0]) != last
        last = k[-1], v[-1]
        key, value = np.concatenate((key, k[new])), np.concatenate((value, v[new]))
        if not len(key):
            continue
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(start, len(key)))
        frequency = np.where(count > most, top, np.log2(count).astype(np.int64))
        if key[0] == frequent:
            frequency[0] = top
        # The last key may go on: its rows wait, unless it is frequent already.
        frequent = key[-1] if frequency[-1] == top else None
        if frequent is None:
            frequency[-1] = 0
        each = np.repeat(frequency, count).astype(np.int32)
        yield key[each > 0], value[each > 0], each[each > 0]
        held = len(key) if frequent is not None else start[-1]
        key, value = key[held:], value[held:]
    if len(key) > 1:
        yield key, value, np.full(len(key), len(key).bit_length() - 1, np.int32)


def in_batches(rows: Iterator, make: Callable[[list], pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield make(held)
            held = []
    if held:
        yield make(held)
