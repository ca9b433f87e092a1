"""Operator 13, phrase collocations: an FM-index per shard, extended in both directions.

Texts are cut into pieces and words. Each task packs the pieces of a language into shards of at
most ``SHARD_WORDS`` words; a shard holds its words and two Burrows-Wheeler
transforms of its word numbers, of the sequence and of its reversal, ordered
to the depth of the longest phrase. A phrase is a pair of intervals, one in each transform. Extending
it by a word to the right is a backward step in the transform of the reversal,
extending to the left one in that of the sequence; the other interval
follows by counting the smaller words of the step. All phrases of a shard are
extended together, and each extension comes with its count.

Counts are summed across shards one length at a time: phrases of fewer than
``min_count`` places in all shards together are not extended, and an extension is only counted
where the phrase at its other end is frequent as well, as no other one can be. Phrases are dealt
into parts by their hash, as many as there are words for, and a shard sends each part the
phrases and counts it has there as one compressed block. A part sums them and sends
every shard one bit a phrase: whether it is frequent. A shard finds its phrases again, in the same order, by
the same steps, so neither intervals nor phrases travel back. The shards themselves and their frequent words
are stored in buckets and do not move. Lengths alternate between right and left extension.

A phrase is scored by its weakest cut, floor(``SCALE`` * a / (l + r)) in exact decimals.
It is dropped where an extension by one word keeps ``keep_percent`` per cent of its places;
a longer phrase that does so has such an extension inside.

Defined cases: null texts are empty; a null language is ``und``; empty
pieces have no words; repeated rows count each; an empty table gives an empty
result; a long text is divided between shards at its pieces (a piece alone
is never cut, so memory follows the longest one); input columns beside
``lang`` and ``text`` are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute in tasks)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from . import common
from .ngram_join import mix

SHARD_WORDS = 1 << 20
PART_WORDS = 1 << 21
LONGEST = 4
MIN_COUNT = 30
KEEP_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
NO_LANGUAGE = "und"

# Piece ends, as a word of their own that no other word can be.
_ENDS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", b"\n" * 10)
_END = b"."

SHARD_SCHEMA = "shard bigint, lang string, n_words bigint, words array<string>, counts array<bigint>, size bigint, forward binary, backward binary"
BLOCK_SCHEMA = "part bigint, shard bigint, size bigint, block binary"
SUM_SCHEMA = "shard bigint, part bigint, bits binary, ids array<bigint>, a bigint"


def words_and_ends(text: bytes) -> list[bytes]:
    """The words of a text with A-Z lower-cased, and ``.`` wherever a piece ends."""
    return text.lower().translate(_ENDS).replace(b"\n", b" . ").split()


def transform(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of a circular sequence whose rotations are ordered by ``depth`` symbols or more."""
    rank, known = numbers.astype(np.int64), 1
    while known < depth:
        rank = np.unique(rank * (int(rank.max()) + 1) + np.roll(rank, -known), return_inverse=True)[1]
        known *= 2
    return numbers[np.argsort(rank, kind="stable") - 1]


def _packed(values: np.ndarray, width: int = 4) -> bytes:
    """Numbers byte by byte (all low bytes first), compressed: half of what they take number by number."""
    return pa.compress(np.ascontiguousarray(values.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, size: int, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, size * width, codec="zstd", asbytes=True), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(f"<i{width}").ravel()


class Index:
    """One transform: symbols by row, and the row that a backward step leads to."""

    def __init__(self, blob: bytes, size: int):
        self.symbols = _unpacked(blob, size).astype(np.int32)
        self.step = np.empty(size, np.int64)
        self.step[np.argsort(self.symbols, kind="stable")] = np.arange(size)

    def extend(self, lo: np.ndarray, n: np.ndarray, other: np.ndarray, usable: np.ndarray, both_ends: bool):
        """(phrase, symbol, lo, n, other) of every extension by a usable symbol.

        ``both_ends``: only those whose phrase without its far end is among the given ones.
        """
        begin = np.cumsum(n) - n
        phrase = np.repeat(np.arange(len(lo)), n)
        rows = np.arange(int(n.sum())) - np.repeat(begin - lo, n)
        order = np.argsort(phrase * len(usable) + self.symbols[rows], kind="stable")
        rows = rows[order]  # still by phrase, then by symbol, then by row
        symbol = self.symbols[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (phrase[1:] != phrase[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(rows)))
        phrase, symbol, to = phrase[first], symbol[first], self.step[rows[first]]
        keep = usable[symbol]
        if both_ends:
            known = np.zeros(len(self.symbols), bool)
            known[rows] = True
            keep &= known[to]
        # In the other transform the rows of a phrase are ordered by the symbol that extends it.
        return phrase[keep], symbol[keep], to[keep], count[keep], (other[phrase] + first - begin[phrase])[keep]


class _Packer:
    """Words of one language that a task has read and not yet written."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {_END: 0}
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers
        self.parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.held += len(words) + 1

    def shard(self, number: int, lang: str, depth: int) -> tuple:
        sequence = np.concatenate(self.parts)
        counts = np.bincount(sequence, minlength=len(self.numbers))[1:]
        return (number, lang, int(counts.sum()), [w.decode() for w in self.numbers][1:], counts, len(sequence),
                _packed(transform(sequence, depth)), _packed(transform(sequence[::-1], depth)))


def cut(words: list[bytes], room: int) -> int:
    """Where to cut a text that has more than ``room`` words: after the last piece within, else after the first one."""
    for k in range(min(room, len(words)) - 1, -1, -1):
        if words[k] == _END:
            return k + 1
    return words.index(_END, max(0, room)) + 1 if _END in words[max(0, room):] else len(words)


def shards(documents: DataFrame, *, depth: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The shards of ``documents`` (lang, text): words with their counts, and both transforms."""
    partition = F.spark_partition_id().cast("bigint").alias("part")
    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("string").alias("text"), partition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, _Packer] = {}
        number = held = 0

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal number, held
            packer = open_shards.pop(lang)
            held -= packer.held
            row = packer.shard((part << 32) + number, lang, depth)
            number += 1
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        names = ["shard", "lang", "n_words", "words", "counts", "size", "forward", "backward"]
        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else 0
            for lang, text in zip(batch.column(0).to_pylist(), common.texts(batch.column(1)), strict=True):
                words = words_and_ends(text)
                while words:
                    packer = open_shards.setdefault(lang, _Packer())
                    room = shard_words - packer.held
                    end = len(words) if len(words) <= room else cut(words, room)
                    if end > room and packer.held:  # no piece fits in what is left
                        yield closed(lang)
                        continue
                    packer.add(words[:end])
                    held += end + 1
                    words = words[end:]
                    if packer.held >= shard_words:
                        yield closed(lang)
                while held > 2 * shard_words:  # many languages: the fullest goes
                    yield closed(max(open_shards, key=lambda x: open_shards[x].held))
        for lang in list(open_shards):
            yield closed(lang)

    return rows.mapInArrow(run, SHARD_SCHEMA)


def _parts_of(phrases: np.ndarray, parts: int) -> np.ndarray:
    """The part of every phrase (a row of word ids)."""
    number = np.zeros(len(phrases), np.uint64)
    for word in phrases.T:
        number = mix(number + word.astype(np.uint64))
    return (number % np.uint64(parts)).astype(np.int64)


def grown(shard: dict, lo: np.ndarray, ids: np.ndarray, marks: dict[tuple[int, int], np.ndarray], *, length: int, parts: int):
    """(phrases, counts, parts) of a shard's phrases of ``length`` words, in the order of their parts.

    ``lo`` and ``ids`` are the shard's frequent words, by their number there and in all.
    ``marks`` says by (length, part) which of the shorter phrases, in the same order, are frequent.
    """
    # A right extension reads the transform of the reversal, a left one that of the sequence.
    index = {right: Index(shard["backward" if right else "forward"], shard["size"]) for right in ((True, False) if length > 2 else (True,))}
    places = np.bincount(index[True].symbols)
    identity = np.full(len(places), -1, np.int64)
    identity[lo] = ids
    symbol = lo[np.argsort(ids)]
    phrases, n = identity[symbol][:, None], places[symbol]
    low = other = (np.cumsum(places) - places)[symbol]
    for k in range(2, length + 1):
        right = k % 2 == 0
        here, there = (other, low) if right else (low, other)
        phrase, symbol, here, n, there = index[right].extend(here, n, there, identity >= 0, both_ends=k > 2)
        low, other = (there, here) if right else (here, there)
        word = identity[symbol][:, None]
        phrases = np.hstack([phrases[phrase], word] if right else [word, phrases[phrase]])
        part = _parts_of(phrases, parts)
        order = np.argsort(part, kind="stable")
        if k < length:
            frequent = np.zeros(len(order), bool)
            for p, at, size in zip(*(x.tolist() for x in np.unique(part[order], return_index=True, return_counts=True)), strict=True):
                if (k, p) in marks:
                    frequent[order[at : at + size]] = np.unpackbits(marks[k, p], count=size)
            phrases, n, low, other = (x[frequent] for x in (phrases, n, low, other))
    return phrases[order], n[order], part[order]


def _words_of_shards(own: DataFrame) -> DataFrame:
    """``shard, n_own, own_lo, own_ids``: the frequent words of each shard (at least one), by their number there and in all, packed."""

    def run(shard: pa.Table) -> pa.Table:
        lo, ids = (shard.column(c).to_numpy() for c in ("lo", "id"))
        order = np.argsort(lo)
        packed = [_packed(np.diff(lo[order], prepend=0), 8), _packed(ids[order], 8)]
        return pa.table([shard.column("shard").slice(0, 1), pa.array([len(lo)], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)],
                        names=["shard", "n_own", "own_lo", "own_ids"])

    return own.select("shard", "lo", "id").groupBy("shard").applyInArrow(run, "shard bigint, n_own bigint, own_lo binary, own_ids binary")


def _blocks(index: DataFrame, words: DataFrame, marks: DataFrame | None, *, length: int, parts: int) -> DataFrame:
    """``part, shard, size, block``: each shard's phrases of ``length`` words with their counts there, one block a part.

    ``index`` and ``words`` are in buckets by shard: of what a shard is given only the marks move.
    """

    def run(shard: pa.Table, given: pa.Table | None = None) -> pa.Table:
        out: list[tuple] = []
        if shard.num_rows:
            bits = {(r["length"], r["part"]): np.frombuffer(r["bits"], np.uint8) for r in given.to_pylist()} if given is not None else {}
            own = shard.to_pylist()[0]
            lo, ids = np.cumsum(_unpacked(own["own_lo"], own["n_own"], 8)), _unpacked(own["own_ids"], own["n_own"], 8)
            phrases, n, part = grown(own, lo, ids, bits, length=length, parts=parts)
            rows = np.hstack([phrases, n[:, None]])
            for p, at, size in zip(*(x.tolist() for x in np.unique(part, return_index=True, return_counts=True)), strict=True):
                out.append((p, own["shard"], size, _packed(rows[at : at + size].T.ravel(), 8)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "shard", "size", "block"])

    read = index.select("shard", "size", "backward", *(["forward"] if length > 2 else [])).join(words.hint("merge"), "shard")
    if marks is None:
        return read.groupBy("shard").applyInArrow(lambda shard: run(shard), BLOCK_SCHEMA)
    given = marks.select("shard", "length", "part", "bits")
    return read.groupBy("shard").cogroup(given.groupBy("shard")).applyInArrow(lambda shard, given: run(shard, given), BLOCK_SCHEMA)


def same_rows(columns: list[np.ndarray]) -> np.ndarray:
    """Numbers from 0 upward that rows share if, and only if, they are equal."""
    number = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        found, value = np.unique(column, return_inverse=True)
        number = np.unique(number * len(found) + value, return_inverse=True)[1]
    return number


def _summed(blocks: DataFrame, *, length: int, min_count: int, marked: bool) -> DataFrame:
    """The frequent phrases (``ids, a``) and, where ``marked``, rows ``shard, part, bits``: one bit a phrase of that shard's block."""

    def run(part: pa.Table) -> pa.Table:
        sizes = part.column("size").to_numpy()
        rows = np.hstack([
            _unpacked(block, size * (length + 1), 8).reshape(length + 1, size)
            for block, size in zip(part.column("block").to_pylist(), sizes.tolist(), strict=True)
        ])
        number = same_rows(list(rows[:-1]))
        first = np.unique(number, return_index=True)[1]
        a = np.zeros(len(first), np.int64)
        np.add.at(a, number, rows[-1])
        frequent = a >= min_count
        shards_, parts_, bits = [], [], []
        if marked:
            ends = np.cumsum(sizes)
            for shard, lo, hi in zip(part.column("shard").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
                own = frequent[number[lo:hi]]
                if own.any():
                    shards_.append(shard)
                    parts_.append(part.column("part")[0].as_py())
                    bits.append(np.packbits(own).tobytes())
        ids, a = rows[:-1, first[frequent]].T, a[frequent]
        none, empty = [None] * len(a), [None] * len(bits)
        lists = pa.array([*ids.tolist(), *empty], pa.list_(pa.int64()))
        return pa.table([pa.array([*none, *shards_], pa.int64()), pa.array([*none, *parts_], pa.int64()), pa.array([*none, *bits], pa.binary()),
                         lists, pa.array([*a.tolist(), *empty], pa.int64())], names=["shard", "part", "bits", "ids", "a"])

    return blocks.groupBy("part").applyInArrow(run, SUM_SCHEMA)


def _frequent(rows: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    """``rows`` of frequent words, with their number of places ``a`` in all shards; a word has at most one row a shard."""
    return rows.withColumn("a", F.sum("n").over(Window.partitionBy(*keys))).where(F.col("a") >= min_count)


def frequent_phrases(documents: DataFrame, *, longest: int = LONGEST, min_count: int = MIN_COUNT,
                     shard_words: int = SHARD_WORDS, part_words: int = PART_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(``lang, n``: words of each language; ``id, lang, word``: frequent words; ``ids, a``: frequent phrases of 1 to ``longest`` words)."""
    if longest < 2 or min_count < 1 or part_words < 1:
        raise ValueError("need longest >= 2, min_count >= 1 and part_words >= 1")
    spark = documents.sparkSession
    # Buckets by shard: the transforms are written once and read where they are, at every length.
    name, buckets = f"fm_shards_{uuid.uuid4().hex}", 4 * spark.sparkContext.defaultParallelism
    of_words = f"fm_words_{uuid.uuid4().hex}"

    def in_buckets(rows: DataFrame, table: str, label: str) -> None:
        rows.write.format("parquet").option("path", scratch_path(spark, label)).bucketBy(buckets, "shard").saveAsTable(table)

    in_buckets(shards(documents, depth=longest, shard_words=shard_words), name, "fm-shards")
    try:
        index = spark.table(name)
        sizes = common.written(index.groupBy("lang").agg(F.sum("n_words").alias("n")), "language-words")
        own = index.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "w"))
        own = own.select("shard", "lang", F.col("w.words").alias("word"), (F.col("k") + 1).cast("bigint").alias("lo"), F.col("w.counts").alias("n"))
        # A word's id is the place of its first row in its partition, which the order within the word does not change.
        own = _frequent(own, ["lang", "word"], min_count).withColumn("row", F.monotonically_increasing_id())
        own = own.withColumn("id", F.min("row").over(Window.partitionBy("lang", "word")))
        # A word is spelled in its first row only.
        spelled = [F.when(F.col("row") == F.col("id"), F.col(c)).alias(c) for c in ("lang", "word", "a")]
        own = common.written(own.select("shard", "lo", "id", *spelled), "shard-words")
        totals = common.written(own.where("word is not null").select("id", "lang", "word", "a"), "frequent-words")
        in_buckets(_words_of_shards(own), of_words, "fm-words")
        words = spark.table(of_words)
        held = index.agg(F.sum("n_words")).first()[0] or 0
        parts = -(-held // part_words) or 1
        found, marks = [totals.select(F.array("id").alias("ids"), "a")], None
        for length in range(2, longest + 1):
            blocks = _blocks(index, words, marks, length=length, parts=parts)
            sums = common.written(_summed(blocks, length=length, min_count=min_count, marked=length < longest), f"phrases-{length}")
            found.append(sums.where("shard is null").select("ids", "a"))
            more = sums.where("shard is not null").select("shard", F.lit(length).alias("length"), "part", "bits")
            marks = more if marks is None else marks.unionByName(more)
    finally:
        for table in (name, of_words):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return sizes, totals.select("id", "lang", "word"), every


def collocations(documents: DataFrame, *, longest: int = LONGEST, min_count: int = MIN_COUNT, keep_percent: int = KEEP_PERCENT, top: int = TOP,
                 scale: int = SCALE, shard_words: int = SHARD_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, n_left, n_right``: the ``top`` phrases of every language.

    By score, then count, both descending, then the bytes of the phrase; ``l`` and
    ``r`` are the counts at the weakest cut, the first one at a tie. ``n_left`` and
    ``n_right`` are the numbers of frequent extensions by one word (0 for the longest phrases).
    """
    sizes, words, every = frequent_phrases(documents, longest=longest, min_count=min_count, shard_words=shard_words, part_words=part_words)
    size = F.size("ids")
    candidates = every.where(size > 1)
    # Each phrase as an extension of the two phrases of one word less inside it.
    grown = candidates.where(size > 2).select("a", F.inline(F.array(
        F.struct(F.expr("slice(ids, 1, size(ids) - 1)").alias("ids"), F.lit(0).alias("left")),
        F.struct(F.expr("slice(ids, 2, size(ids) - 1)").alias("ids"), F.lit(1).alias("left")),
    )))
    grown = grown.groupBy("ids").agg(F.max("a").alias("longer"), F.sum("left").alias("n_left"), F.sum(1 - F.col("left")).alias("n_right"))
    kept = candidates.join(grown, "ids", "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * keep_percent)
    )
    kept = kept.select("ids", "a", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_left", "n_right")))
    cuts = kept.select("ids", "a", "n_left", "n_right", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("slice(ids, 1, k)")).withColumn("rest", F.expr("slice(ids, k + 1, size(ids) - k)"))
    cuts = cuts.join(every.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first")
    cuts = cuts.join(every.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
    score = F.expr(f"(cast(a as decimal(20,0)) * {scale}BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    cuts = cuts.withColumn("score", score)
    weakest = cuts.groupBy("ids").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("w"), F.max("a").alias("a"), F.max("n_left").alias("n_left"), F.max("n_right").alias("n_right")
    )
    spelled = weakest.select("ids", F.posexplode("ids").alias("at", "id")).join(words, "id").groupBy("ids").agg(
        F.max("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    scored = weakest.join(spelled, "ids").select("lang", "phrase", "a", "w.l", "w.r", "w.score", "n_left", "n_right")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    # One row per language.
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "n_left", "n_right")
