"""Operator 10, secret scans: sliding-window Shannon entropy per character class.

Candidate strings are the runs of ``[A-Za-z0-9+/_=-]`` of at least ``window``
characters. A window of that many characters slides over each; counts per
character change by one entry and one exit a step, so its entropy costs a
constant per step. A window's class follows from the kinds of characters in
it, each class with its own threshold (bits per character):

- ``hex``: digits and a-f (or A-F) only;
- ``alnum``: digits and letters of one case;
- ``mixed``: digits and letters of both cases, or with symbols.

Windows without a digit, or without a letter, are words, rules or numbers and
never count, nor do windows that overlap an entry of the allow-list (any case);
the rest of their candidate string counts as ever. Windows over the threshold
are merged to spans of the kind ``entropy``. Three base kinds are found by their patterns and are never suppressed.

Each text is scanned whole in the task that reads it: no shuffle.

Defined cases: null counts as empty text and has no spans; spans are in code
points, end exclusive; repeated rows are scanned each; an empty table gives
an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

# The base patterns, on UTF-8 bytes (every class is ASCII).
ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "mixed": 3.8}
ALLOWED = ("example", "placeholder", "changeme", "xxxxxxxx", "abcdefgh", "0123456789abcdef", "sha256-", "utm_source")

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True


def _runs(member: np.ndarray, least: int) -> np.ndarray:
    """(start, end) of the runs of True of at least ``least``."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], member.view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    keep = end - start >= least
    return np.stack([start[keep], end[keep]], axis=1)


def allowed_bytes(low: bytes, allowed: tuple) -> bytearray | None:
    """1 for every byte of a lower-cased run inside an entry of the allow-list; None with no entry in it."""
    out = None
    for entry in filter(None, allowed):
        at = low.find(entry)
        while at >= 0:
            out = out or bytearray(len(low))
            out[at : at + len(entry)] = b"\1" * len(entry)
            at = low.find(entry, at + 1)
    return out


def entropy_spans(run: bytes, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS, barred: bytearray | None = None) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``run`` whose entropy exceeds their class's threshold.

    Windows that hold a byte set in ``barred`` do not count.

    Counts are kept per character, ``total = sum(c * log2(c))``; the entropy of
    a window of ``w`` characters is ``log2(w) - total / w``. Totals come from
    a table of ``c * log2(c)``, one exit and one entry a step.
    """
    plogp = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts = [0] * 256
    hexes = digits = lower = upper = 0  # per class; the rest are symbols
    total, spans, held = 0.0, [], 0
    for i, b in enumerate(run):
        if barred:
            held += barred[i] - (barred[i - window] if i >= window else 0)
        for x, step in ((b, 1), (run[i - window] if i >= window else None, -1)):
            if x is None:
                continue
            c = counts[x]
            total += plogp[c + step] - plogp[c] if 0 <= c + step <= window else 0.0
            counts[x] = c + step
            digits += step * (48 <= x <= 57)
            lower += step * (97 <= x <= 122)
            upper += step * (65 <= x <= 90)
            hexes += step * (48 <= x <= 57 or 97 <= x <= 102 or 65 <= x <= 70)
        if i < window - 1 or held or not digits or not (lower or upper):
            continue
        if hexes == window and not (lower and upper):
            kind = "hex"
        elif digits + lower == window or digits + upper == window:
            kind = "alnum"
        else:
            kind = "mixed"
        if math.log2(window) - total / window > thresholds[kind]:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def _over_window(run: bytes) -> bool:
    """Cheap test before the windows: a digit and a letter are somewhere in the run."""
    return any(48 <= b <= 57 for b in run) and not run.isdigit()


def find_spans(text: bytes, data: np.ndarray, *, window: int, thresholds: dict, allowed: tuple) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of all spans of one text, by start, then kind."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_MIN]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [(s, 2, e) for s, e in _runs(_HEX[data], HEX_MIN).tolist()]
    for s, e in _runs(_CANDIDATE[data], window).tolist():
        run = text[s:e]
        if _over_window(run):
            found += [(s + a, 3, s + b) for a, b in entropy_spans(run, window, thresholds, allowed_bytes(low[s:e], allowed))]
    return sorted(found)


def to_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points; one pass over the text."""
    if not spans or text.isascii():
        return spans
    starts = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(starts)))
    return [(int(before[s]), k, int(before[e])) for s, k, e in spans]


SCHEMA = "doc_id bigint, text string, spans array<struct<start:bigint,`end`:bigint,kind:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def _scan(batch: pa.RecordBatch, column: int, options: dict) -> Iterator[list[tuple[int, int, int]]]:
    raw, off = common.utf8(batch.column(column))
    view = memoryview(raw)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        text = bytes(view[a:b])
        yield to_code_points(text, find_spans(text, raw[a:b], **options))


def scan_secrets(documents: DataFrame, *, window: int = WINDOW, thresholds: dict = THRESHOLDS, allowed=ALLOWED) -> DataFrame:
    """``doc_id, spans`` of every text: (start, end, kind), by start, then kind as in KINDS."""
    options = {"window": window, "thresholds": dict(thresholds), "allowed": tuple(a.lower().encode() for a in allowed)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in found] for found in _scan(batch, 1, options)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    return documents.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id bigint, spans array<struct<start:bigint,`end`:bigint,kind:string>>"
    )


def redact_secrets(documents: DataFrame, *, column: str = "text", mask: str = "[secret]", window: int = WINDOW,
                   thresholds: dict = THRESHOLDS, allowed=ALLOWED) -> DataFrame:
    """``documents`` with every span of ``column`` replaced by ``mask`` (overlapping spans by one); nulls stay."""
    options = {"window": window, "thresholds": dict(thresholds), "allowed": tuple(a.lower().encode() for a in allowed)}
    at = documents.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, out = batch.column(at).is_valid().to_pylist(), []
            raw, off = common.utf8(batch.column(at))
            view = memoryview(raw)
            for ok, a, b in zip(valid, off[:-1].tolist(), off[1:].tolist(), strict=True):
                text = bytes(view[a:b])
                parts, upto = [], 0
                for s, _, e in find_spans(text, raw[a:b], **options):
                    if s >= upto:
                        parts += [text[upto:s], mask.encode()]
                    upto = max(upto, e)
                out.append(b"".join([*parts, text[upto:]]).decode() if ok else None)
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)
