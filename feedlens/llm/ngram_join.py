"""Operator 8, n-gram Jaccard join: rare-first prefixes, then size-banded tiles with bitmap signatures.

A document is the set of its distinct word shingles, as sorted 64-bit hashes.
Two documents link at Jaccard similarity ``num/den`` or more.

Candidates. Sets that link share most of their elements, so in any one order of all elements each holds
a shared one early (prefix filter). It is used twice. By hash: of ``n`` elements the smallest ``Threshold.reach(n)``
go out as keys, and sets that link share several. By rarity: keys in one set only
are dropped, and of a set's others those in the most sets, but for as many as it takes to
share one. A passage that is in many texts is thus not what makes them meet, unless a text is made of little
else. Sorted by key, each row points to the first of its run: rows of a key are
streamed, never gathered, and give one pair each. The components of these pairs hold every link.

Tiles. A component of up to ``TILE_ROWS`` sets is one tile. A larger one is
dealt into size bands (ratio den/num, so that links stay within a band or its neighbour) and
within a band by hash; every two tiles whose bands may link are compared by
one task. Within a task the bit counts of two
bitmaps bound the overlap from above (a bit set on one side only is an element
missing on the other), and pairs whose bound is too low are left out; all others are decided by
intersecting the sets. A task gives one link per set it merges and, per set,
the number of rows it links with there, not all pairs; each pair of sets is in
one pair of tiles, so these numbers add up. Where only the groups are wanted
(``one_of_each``), sets already joined are not compared again.

Equal sets are found by a digest of the whole set before, so a large group of
copies is one set, weighed by its rows. Exact: every link between different sets is decided and counted.

Defined cases: fewer than ``size`` words make one shingle of all; null, empty
and wordless texts have no shingles and are their own component; documents with
a null doc_id take part, but never name a component (null where no member has an id);
repeated rows are copies; an empty table gives an empty result; other columns
of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, graph, streams

SIZE = 3
NUM, DEN = 90, 100
TILE_ROWS = 512
TILE_BYTES = 16 << 20
DENSE_ROWS, DENSE_ELEMENTS = 16, 8192
# Keys are ordered by the sets they are in, up to so many; above that all count as equally frequent.
KEY_SETS = 64
# Bits of the map of members that texts are looked up in before they travel.
MEMBER_BITS = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_RNG = np.random.default_rng(8)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_STEP = [np.uint64(x) for x in (_RNG.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1))]
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(number: int, step: int) -> np.uint64:
    return np.uint64(number * int(_STEP[step]) % (1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a run of bytes; texts must be apart by white space."""
    inside = ~_SPACE[part]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    # Polynomial hashes of all words from one running sum (arithmetic modulo 2**64).
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[_FOLD[part]] * _powers(_BASE, len(part)))))
    return start, mix((total[end] - total[start]) * _powers(_BACK, len(part) + 1)[start] + (end - start).astype(np.uint64) * _STEP[60])


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int = SIZE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text of ``off`` (into ``raw``)."""
    # A space between texts keeps words apart.
    lengths = np.diff(off)
    n = len(lengths)
    spaced = np.full(int(lengths.sum()) + n, 32, np.uint8)
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    keep = np.ones(len(spaced), bool)
    keep[at[1:] - 1] = False
    spaced[keep] = raw[int(off[0]) : int(off[-1])]
    start, words = word_hashes(spaced)
    first = np.searchsorted(start, at)
    grams = np.zeros(len(words), np.uint64)
    if len(words) >= size:
        whole = sum(words[k : len(words) - size + 1 + k] * _STEP[k] for k in range(size))
        grams[: len(words) - size + 1] = mix(whole)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:  # all words as one shingle, apart from the full ones
            yield mix(sum(words[a + k : a + k + 1] * _STEP[k + 16] for k in range(b - a)) + _STEP[32 + b - a])
        else:
            yield grams[:0]


class Threshold:
    """Jaccard similarity ``num/den`` or more: which overlaps link, and where sets that link must share elements."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("need 0 < num <= den")
        self.num, self.den = num, den

    def least(self, n: int) -> int:
        """Elements that a set of ``n`` shares with each set it links with; also the size of the smallest such set."""
        return -(-self.num * n // self.den)

    def agree(self, n: int) -> int:
        """Elements that the ``reach`` smallest of two linked sets have in common at least, if ``n`` is the smaller size."""
        return min(self.least(n), 1 + n * (self.den - self.num) // self.den)

    def reach(self, n: int) -> int:
        """How many of the smallest of ``n`` elements are keys; none where only equal sets can link.

        At most ``n - least(n)`` of them are not shared, wherever they lie, and
        ``agree`` more make that many shared ones certain: the first shared elements of two
        linked sets are the same, and lie that early in both.
        """
        return n - self.least(n) + self.agree(n) if n * (self.den - self.num) >= self.num else 0

    def spare(self, n: str) -> Column:
        """Of the keys of a set of ``n`` (a column) so many may be left out at the end of an order that holds for all sets."""
        least = f"(({n} * {self.num} + {self.den - 1}) div {self.den})"
        smallest = f"(({least} * {self.num} + {self.den - 1}) div {self.den})"
        return F.expr(f"cast(least({smallest}, 1 + {least} * {self.den - self.num} div {self.den}) - 1 as int)")

    def links(self, overlap, x, y):
        """Whether sets of sizes ``x`` and ``y`` with that overlap link."""
        return self.den * overlap >= self.num * (x + y - overlap)


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Hashed bitmap of every set: at least four bits per element of the largest, 256 to 16,384."""
    most = max(map(len, sets))
    bits = 1 << min(14, max(8, (4 * most - 1).bit_length()))
    out = np.zeros((len(sets), bits // 8), np.uint8)
    for r, a in enumerate(sets):
        place = (a & np.uint64(bits - 1)).astype(np.int64)
        row = np.zeros(bits, bool)
        row[place] = True
        out[r] = np.packbits(row)
    return out.view(np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted arrays share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Overlaps:
    """Elements that one set of a tile shares with many, by numbers of the tile's elements made at first need.

    Where few elements are in two sets or more, as among near copies, all
    overlaps come from one product of 0/1 rows (whole numbers, exact).
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.numbers, self.own, self.all = sets, None, None, None
        if len(sets) >= DENSE_ROWS:
            elements = np.concatenate(sets)
            found, number, count = np.unique(elements, return_inverse=True, return_counts=True)
            shared = np.flatnonzero(count > 1)
            if len(shared) <= DENSE_ELEMENTS:
                column = np.full(len(found), len(shared), np.int64)
                column[shared] = np.arange(len(shared))
                rows = np.zeros((len(sets), len(shared) + 1), np.float32)
                rows[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), column[number]] = 1
                rows = rows[:, :-1]
                self.all = (rows @ rows.T).astype(np.int64)

    def of(self, i: int, others: np.ndarray) -> np.ndarray:
        if self.all is not None:
            return self.all[i, others]
        if len(others) < 8:
            return np.array([overlap(self.sets[i], self.sets[j]) for j in others.tolist()], np.int64)
        if self.numbers is None:
            elements, number = np.unique(np.concatenate(self.sets), return_inverse=True)
            self.numbers = np.split(number.astype(np.int32), np.cumsum([len(s) for s in self.sets])[:-1])
            self.own = np.zeros(len(elements), np.uint8)
        self.own[self.numbers[i]] = 1
        rows = [self.numbers[j] for j in others.tolist()]
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])[:-1]))
        out = np.add.reduceat(self.own[np.concatenate(rows)], starts, dtype=np.int64)
        self.own[self.numbers[i]] = 0
        return out


def tile_links(sets: list[np.ndarray], side: np.ndarray, rule: Threshold, *, across: bool, copies: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect what linked sets connect, and the rows that each set links with; ``across``: pairs of two sides only.

    ``copies`` is the number of rows of each set; without it sets already
    connected are not compared again, and the numbers stay 0.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[k]) for k in order])
    sides = side[order]
    label = np.arange(len(sets))
    many = Overlaps([sets[k] for k in order]) if copies is not None else None
    dense = many is not None and many.all is not None
    bits = bitmaps([sets[k] for k in order]) if len(sets) > 2 and not dense else None
    # Sets no larger than the size rule allows, as order is by size.
    upto = np.searchsorted(sizes * rule.num, sizes * rule.den, "right")
    out, counts = [], np.zeros(len(sets), np.int64)
    for i in range(len(sets)):
        others = np.arange(i + 1, upto[i])
        if copies is None:
            others = others[label[others] != label[i]]
        if across:
            others = others[sides[others] != sides[i]]
        if bits is not None and len(others):
            miss_i = np.bitwise_count(bits[i] & ~bits[others]).sum(1, dtype=np.int64)
            miss_o = np.bitwise_count(bits[others] & ~bits[i]).sum(1, dtype=np.int64)
            bound = np.minimum(sizes[i] - miss_i, sizes[others] - miss_o)
            others = others[rule.links(bound, sizes[i], sizes[others])]
        if copies is not None and len(others):
            others = others[rule.links(many.of(i, others), sizes[i], sizes[others])]
            counts[order[i]] += copies[order[others]].sum()
            counts[order[others]] += copies[order[i]]
        a = sets[order[i]]
        for j in others[label[others] != label[i]].tolist():
            if label[j] != label[i]:
                b = sets[order[j]]
                if copies is not None or rule.links(overlap(a, b), len(a), len(b)):
                    label[label == label[j]] = label[i]
                    out.append((int(order[i]), int(order[j])))
    return out, counts


def set_digest(a: np.ndarray) -> bytes:
    return hashlib.blake2b(a.tobytes(), digest_size=16).digest()


def _texts(documents: DataFrame, *more) -> DataFrame:
    """``doc_id, mark, text``: ``mark`` is the hash of the text, which tells rows without an id, or of one id, apart."""
    text = F.col("text").cast("string")
    return documents.select(*more, F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def features(documents: DataFrame, *, size: int) -> DataFrame:
    """``node, doc_id, mark, n, digest``, written: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = common.utf8(batch.column(3))
            for i, j in common.slices(off):
                sets = list(shingle_sets(raw, off[i : j + 1], size))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in range(3)), pa.array(map(len, sets), pa.int64()),
                     pa.array([set_digest(a) if len(a) else None for a in sets], pa.binary())], names=["node", "doc_id", "mark", "n", "digest"],
                )

    rows = _texts(documents, F.monotonically_increasing_id().alias("node"))
    return common.written(rows.mapInArrow(run, "node bigint, doc_id bigint, mark bigint, n bigint, digest binary"), "features")


def key_rows(documents: DataFrame, *, size: int, rule: Threshold) -> DataFrame:
    """``key, set``: the keys of every set, from each task that meets it; ``set`` is the start of its digest, alike in all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            raw, off = common.utf8(batch.column(0))
            for i, j in common.slices(off):
                keys, names = [], []
                for a in shingle_sets(raw, off[i : j + 1], size):
                    reach = rule.reach(len(a)) if len(a) else 0
                    d = set_digest(a) if reach else None
                    if d and d not in seen:
                        seen.add(d)
                        keys.append(a[:reach])
                        names.append(np.full(reach, int.from_bytes(d[:8], "big", signed=True), np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names))], names=["key", "set"])

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "key bigint, set bigint")


def shared_keys(keys: DataFrame) -> DataFrame:
    """``key, set, frequency`` of the ``keys`` (key, set) that are in two sets or more; ``frequency`` grows with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, name, frequency in streams.repeated(batches, KEY_SETS):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(name), pa.array(frequency)], names=["key", "set", "frequency"])

    return keys.repartition("key").sortWithinPartitions("key", "set").mapInArrow(run, "key bigint, set bigint, frequency int")


def candidate_pairs(documents: DataFrame, sets: DataFrame, *, size: int, rule: Threshold) -> DataFrame:
    """``a, b``: sets (by the start of the digest, ``set`` in ``sets``) that share a key with the first set of that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value, first in streams.first_of_run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(first)], names=["a", "b"])

    shared = shared_keys(key_rows(documents, size=size, rule=rule))
    of_set = shared.groupBy("set").agg(F.sort_array(F.collect_list(F.struct("frequency", "key"))).alias("keys"))
    of_set = of_set.join(sets.select("set", rule.spare("n").alias("spare")), "set").where(F.size("keys") > F.col("spare"))
    keys = of_set.select(F.explode(F.slice("keys", F.lit(1), F.size("keys") - F.col("spare"))).alias("k"), "set").select("k.key", "set")
    return keys.repartition("key").sortWithinPartitions("key", "set").mapInArrow(run, "a bigint, b bigint")


def _tiles(members: DataFrame, rule: Threshold, rows: int, size_bytes: int) -> DataFrame:
    """``members`` (component, node, n, doc_id, mark, digest, copies) with ``pairs``: the pairs of tiles each is compared in, and its side."""
    ratio = rule.den / rule.num
    # Bands of ratio den/num: sets that link are in one band or in neighbouring ones.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(ratio + 1e-9))).cast("int") if rule.num < rule.den else F.lit(0)
    whole = members.groupBy("component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    banded = members.join(whole, "component").withColumn(
        "band", F.when((F.col("c") <= rows) & (F.col("s") * 8 <= size_bytes), F.lit(-1)).otherwise(band)
    ).drop("c", "s")
    sub = banded.groupBy("component", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(rows)), F.ceil(F.sum("n") * 8 / F.lit(size_bytes))).cast("int").alias("subs")
    )
    # The tiles of a band and of the next: what each member is compared with.
    up = sub.select("component", (F.col("band") - 1).alias("band"), F.col("subs").alias("subs_up"))
    down = sub.select("component", (F.col("band") + 1).alias("band"), F.col("subs").alias("subs_down"))
    dealt = banded.join(sub, ["component", "band"]).join(up, ["component", "band"], "left").join(down, ["component", "band"], "left")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int")).withColumn(
        "subs_up", F.when(F.col("band") < 0, 0).otherwise(F.coalesce("subs_up", F.lit(0)))
    ).withColumn("subs_down", F.when(F.col("band") < 0, 0).otherwise(F.coalesce("subs_down", F.lit(0))))
    pairs = F.expr(
        "concat("
        " transform(sequence(0, subs - 1), t -> named_struct('low', band, 'x', least(t, tile), 'high', band, 'y', greatest(t, tile), 'side', if(t < tile, 1, 0))),"
        " transform(filter(sequence(0, subs_up), t -> t < subs_up), t -> named_struct('low', band, 'x', tile, 'high', band + 1, 'y', t, 'side', 0)),"
        " transform(filter(sequence(0, subs_down), t -> t < subs_down), t -> named_struct('low', band - 1, 'x', t, 'high', band, 'y', tile, 'side', 1)))"
    )
    return dealt.select("component", "node", "doc_id", "mark", "digest", "copies", pairs.alias("pairs"))


def _of_members(texts: DataFrame, members: DataFrame) -> DataFrame:
    """``texts`` (doc_id, mark, ...) without most rows that are no member's, by a map of fixed size; no member's row is lost."""
    bit = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(MEMBER_BITS))
    marked = members.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    looked_up = texts.withColumn("bit", bit).withColumn("word", F.expr("bit div 64")).join(F.broadcast(marked), "word")
    return looked_up.where("shiftright(bits, cast(bit % 64 as int)) & 1L = 1L").select(*texts.columns)


def verified_links(documents: DataFrame, members: DataFrame, *, size: int, rule: Threshold, tile_rows: int, tile_bytes: int, counted: bool) -> DataFrame:
    """``a, b, n``: links (as nodes) found by comparing the tiles of ``members`` (component, node, n, doc_id, mark, digest, copies).

    ``n`` is null. Where ``counted``, rows without ``b`` hold the number of
    rows ``n`` that ``a`` links with in one pair of tiles.
    """

    tiles = _tiles(members, rule, tile_rows, tile_bytes).hint("shuffle_hash")  # the hash side; texts are not sorted
    text = _of_members(_texts(documents), members).withColumnsRenamed({"doc_id": "id", "mark": "of_text"})
    keys = ["component", "low", "x", "high", "y"]
    own = text.join(tiles, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of_text") == F.col("mark"))).select("component", "node", "digest", "copies", "text", "pairs")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows that repeat a whole document one goes on: they meet in one task of the join, or few where it is split."""
        seen: set[int] = set()
        for batch in batches:
            at = [r for r, node in enumerate(batch.column(1).to_pylist()) if not (node in seen or seen.add(node))]
            yield batch if len(at) == batch.num_rows else batch.take(pa.array(at, pa.int64()))

    dealt = own.mapInArrow(once, own.schema).select("component", "node", "digest", "copies", "text", F.explode("pairs").alias("p"))
    # Texts travel, not their hashes: they compress, and take a third of the room.
    dealt = dealt.select("component", "p.low", "p.x", "p.high", "p.y", "p.side", "node", "digest", "copies", "text").repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int | None, int | None]]:
            for run in streams.key_runs(batches, len(keys)):
                if run.num_rows < 2:
                    continue
                nodes, sides, digests, copies = (run.column(c).to_pylist() for c in ("node", "side", "digest", "copies"))
                raw, off = common.utf8(run.column("text"))
                own: dict[int, tuple[int, int, np.ndarray]] = {}
                for i, j in common.slices(off):
                    for r, a in zip(range(i, j), shingle_sets(raw, off[i : j + 1], size), strict=True):
                        # A row of a member's id and mark that is another text has another digest.
                        if nodes[r] not in own and set_digest(a) == digests[r]:
                            own[nodes[r]] = sides[r], copies[r], a
                if len(own) < 2:
                    continue
                ids, of_tile, weights = list(own), np.array([s for s, _, _ in own.values()]), np.array([c for _, c, _ in own.values()])
                # A tile of two may be empty, so the key says whether it is one or two.
                across = any(run.column(x)[0] != run.column(y)[0] for x, y in (("low", "high"), ("x", "y")))
                links, counts = tile_links([a for *_, a in own.values()], of_tile, rule, across=across, copies=weights if counted else None)
                yield from ((ids[i], ids[j], None) for i, j in links)
                yield from ((ids[i], None, int(counts[i])) for i in np.flatnonzero(counts).tolist())

        def batch(rows: list[tuple[int, int | None, int | None]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "n"])

        yield from streams.in_batches(found(), batch, 4096)

    return common.written(dealt.mapInArrow(compare, "a bigint, b bigint, n bigint"), "links")


def _named_sets(documents: DataFrame, *, size: int, num: int, den: int, tile_rows: int, tile_bytes: int, counted: bool) -> tuple[DataFrame, DataFrame]:
    """The rows of ``features``, and ``digest, doc_id, first_mark, component, n_links`` of every set.

    ``doc_id`` and ``first_mark`` are those of the set's first row: by doc_id (null last), then mark.
    ``n_links``: the other rows that a row of the set links with, if ``counted``.
    """
    rule = Threshold(num, den)
    rows = features(documents, size=size)
    # One node per set: the smallest of its rows.
    sets = common.written(rows.where("digest is not null").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("first"),
        F.min(F.struct("node", "doc_id", "mark", "n")).alias("e"),
    ).select("digest", "copies", F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("first_mark"),
             F.col("e.node").alias("node"), F.col("e.doc_id").alias("node_doc_id"), F.col("e.mark").alias("mark"), F.col("e.n").alias("n"),
             F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint").alias("set")), "sets")
    candidates = common.written(graph.components(candidate_pairs(documents, sets, size=size, rule=rule)), "candidates")
    members = candidates.withColumnRenamed("node", "set").join(sets, "set").select(
        "component", "node", "n", F.col("node_doc_id").alias("doc_id"), "mark", "digest", "copies")
    members = common.written(members, "members")
    links = verified_links(documents, members, size=size, rule=rule, tile_rows=tile_rows, tile_bytes=tile_bytes, counted=counted)
    labels = graph.components(links.where("b is not null").select("a", "b"))
    linked = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    named = sets.join(labels, "node", "left").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    n_links = F.col("copies") - 1 + F.coalesce("linked", F.lit(0))
    return rows, named.select("digest", "doc_id", "first_mark", "component", (n_links if counted else F.lit(None).cast("bigint")).alias("n_links"))


def linked_documents(documents: DataFrame, *, size: int = SIZE, num: int = NUM, den: int = DEN, tile_rows: int = TILE_ROWS,
                     tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``documents`` (doc_id, text).

    ``n_links`` is the number of other rows whose set links with the row's own, copies among them.
    """
    rows, named = _named_sets(documents, size=size, num=num, den=den, tile_rows=tile_rows, tile_bytes=tile_bytes, counted=True)
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("digest", "component_id", "n_links")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    component_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def similar_components(documents: DataFrame, *, size: int = SIZE, num: int = NUM, den: int = DEN, tile_rows: int = TILE_ROWS,
                       tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``linked_documents``, by its earlier name."""
    return linked_documents(documents, size=size, num=num, den=den, tile_rows=tile_rows, tile_bytes=tile_bytes)


def one_of_each(documents: DataFrame, *, size: int = SIZE, num: int = NUM, den: int = DEN, tile_rows: int = TILE_ROWS,
                tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``documents`` with one row of each component, and every row without shingles; all columns kept.

    The row is the first by doc_id (null last), then by the hash of its text,
    then in the order of its columns. Components are those of the sets: one
    doc_id may stand for several, and rows without a doc_id are judged as well.
    """
    rows, named = _named_sets(documents, size=size, num=num, den=den, tile_rows=tile_rows, tile_bytes=tile_bytes, counted=False)
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "first_mark")).alias("first"))
    kept_id, kept_mark, of_id, of_text, whole = common.fresh(documents, "_kept", "_mark", "_id", "_of_text", "_row")
    first = first.select(F.col("first.doc_id").alias(kept_id), F.col("first.first_mark").alias(kept_mark))
    copies = rows.where("digest is not null").groupBy(F.col("doc_id").alias(of_id), F.col("mark").alias(of_text)).agg(F.count(F.lit(1)).alias("n"))
    found = first.join(copies, F.col(kept_id).eqNullSafe(F.col(of_id)) & (F.col(kept_mark) == F.col(of_text)))
    found = common.written(found.select(kept_id, kept_mark, "n"), "kept")
    text = F.col("text").cast("string")
    doc_id, mark = F.col("doc_id").cast("bigint"), F.xxhash64(text)
    same = doc_id.eqNullSafe(F.col(kept_id)) & (mark == F.col(kept_mark))
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))

    def kept(condition: str) -> DataFrame:
        return documents.where(worded).join(found.where(condition).select(kept_id, kept_mark).hint("shuffle_hash"), same, "left_semi")

    order = F.min(F.struct(*[F.col(f"`{c}`").alias(c) for c in ("text", *[c for c in documents.columns if c != "text"])]))
    repeated = kept("n > 1").groupBy(doc_id.alias(of_id), mark.alias(of_text)).agg(order.alias(whole)).select(f"{whole}.*").select(*documents.columns)
    return kept("n = 1").unionByName(repeated).unionByName(documents.where(~worded))
