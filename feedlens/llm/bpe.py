"""Operator 5, BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 16 bytes picks places by content, each moved on
to the next start of ASCII white space; the pieces between are the chunks
(about ``CHUNK_BYTES``). Equal passages of different documents are cut alike,
so their inner chunks are equal.

1. Chunk digests are counted over all documents; those of two documents or
   more are shared. They are kept as a Bloom filter of fixed size: a false hit
   sends a chunk the shared way for nothing, and changes no result.
2. Every document is cut again. Joins between chunks are checked where the
   text is at hand: the words on both sides are encoded together; if that
   differs from their own encodings, the two chunks become one and the next
   join is tried, until all joins agree exactly. Documents without a shared
   chunk are finished here.
3. Each shared chunk is encoded once, joined back by digest (a join that
   adaptive execution splits when one chunk is in very many documents), and
   the parts of a document are put together in order.

Encoding of a chunk goes word by word (runs between ASCII white space, which
no token of a checked tokenizer crosses) through a bounded memory per worker
of words already encoded by the tokenizers library. ``decode`` maps the ids
back through the vocabulary.

Tokenizers checked: those whose pre-tokenizer drops white space and whose
decoder joins tokens by one space; others are refused with ValueError.

Defined cases: null counts as empty text: no tokens, empty decoded text;
repeated rows are encoded each; an empty table gives an empty result; other
columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHUNK_BYTES = 1024
BLOOM_BITS = 1 << 24
MEMORY_WORDS = 300_000
LONGEST_KEPT = 64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACE_BYTES = b"\t\n\x0b\x0c\r "
# One 32-bit number per byte value for the rolling hash, from a fixed seed.
_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)
_REACH = 16


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes that end at each place: sum of gear[b[i - j]] << j."""
    h = _GEAR[raw]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step].copy() << np.uint32(step)
    return h


def cut_places(raw: np.ndarray, off: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> list[list[int]]:
    """Per text of ``off`` (into ``raw``) the inner cuts: starts of white-space runs chosen by content."""
    base, end = int(off[0]), int(off[-1])
    part = raw[base:end]
    if not len(part):
        return [[] for _ in off[1:]]
    space = _SPACE[part]
    starts = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    places = np.flatnonzero(rolling(part) < np.uint32((1 << 32) // chunk_bytes))
    texts = (off - base).astype(np.int64)
    # The hash of a place must not reach into the text before.
    places = places[places - texts[np.searchsorted(texts, places, "right") - 1] >= _REACH]
    after = np.searchsorted(starts, places)
    owner = np.searchsorted(texts, places, "right")
    ok = after < len(starts)
    cuts = starts[after[ok]]
    same = np.searchsorted(texts, cuts, "right") == owner[ok]
    cuts = np.unique(cuts[same])
    at = np.searchsorted(cuts, texts)
    return [(cuts[a:b] - t).tolist() for a, b, t in zip(at[:-1], at[1:], texts[:-1], strict=True)]


def chunks(text: bytes, cuts: list[int]) -> list[bytes]:
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


class WordMemory(dict):
    """Word to its ids (decimal, joined by a space): at most two generations of ``size`` words."""

    def __init__(self, encode, size: int):
        super().__init__()
        self.encode, self.size, self.old = encode, size, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = b" ".join(b"%d" % i for i in self.encode(word.decode(), add_special_tokens=False).ids)
        if len(word) <= LONGEST_KEPT:
            self.keep(word, ids)
        return ids

    def keep(self, word: bytes, ids: bytes) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = ids


class Codec:
    """A tokenizer inside a worker."""

    def __init__(self, json: str, memory_words: int = MEMORY_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token = {b"%d" % i: t.encode() for t, i in vocabulary.items()}
        self.kind = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        self.memory = WordMemory(self.tokenizer.encode, memory_words)
        size = max(vocabulary.values(), default=-1) + 1
        self.decimal = [b"%d" % i for i in range(size)]
        self.ends = np.zeros(size, bool)  # tokens that end a pre-token
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        probe = self.tokenizer.encode("a1 b", add_special_tokens=False)
        if [*probe.ids] != [i for w in ("a1", "b") for i in self.tokenizer.encode(w, add_special_tokens=False).ids] or (
            self.tokenizer.decode(probe.ids, skip_special_tokens=False) != " ".join(probe.tokens)
        ):
            raise ValueError("this tokenizer keeps white space, or decodes by more than joining its tokens by a space")

    def learn(self, words: list[bytes]) -> None:
        """Encode the plain words not yet in memory by one call.

        Letters make one pre-token, marks after them one more, and a pre-token
        has one ending token at least: if the endings of all words add up to
        these numbers, each word has just its own, and they part the ids.
        Else the words are left to be encoded singly.
        """
        fresh, endings = [], []
        for w in dict.fromkeys(words):
            if len(w) <= LONGEST_KEPT and w not in self.memory and w not in self.memory.old:
                text = w.decode()
                core = text.rstrip(".,;:!?%$#&*")
                if core.isalpha():
                    fresh.append(w)
                    endings.append(1 + (core != text))
        if len(fresh) < 2:
            return
        ids = self.tokenizer.encode_batch_fast([b" ".join(fresh).decode()], add_special_tokens=False)[0].ids
        at = np.flatnonzero(self.ends[ids])
        if len(at) == sum(endings):
            last = (at[np.cumsum(endings) - 1] + 1).tolist()
            numbers = [self.decimal[i] for i in ids]
            for w, a, b in zip(fresh, [0, *last[:-1]], last, strict=True):
                self.memory.keep(w, b" ".join(numbers[a:b]))

    def encode(self, text: bytes) -> bytes:
        """Ids of a text that begins and ends at checked joins: decimal, joined by one space."""
        memory, words = self.memory, text.split()
        for i in range(0, len(words), 10_000):  # no more at once than memory holds
            self.learn(words[i : i + 10_000])
        return b" ".join([x for w in words if (x := memory[w])])

    def decode(self, ids: bytes) -> bytes:
        return b" ".join(map(self.token.__getitem__, ids.split(b" "))) if ids else b""

    def agrees(self, left: bytes, right: bytes) -> bool:
        """Whether the words on both sides of a join have the ids of their own when encoded together."""
        a, b = left[-256:].split(), right[:256].split()
        if not a or not b:
            return True
        # The words at the join; a word longer than the view is taken whole.
        tail = a[-1] if len(a) > 1 else left.split()[-1]
        head = b[0] if len(b) > 1 else right.split()[0]
        together = self.tokenizer.encode((tail + right[: len(right) - len(right.lstrip(_SPACE_BYTES))] + head).decode(), add_special_tokens=False)
        return [b"%d" % i for i in together.ids] == (self.memory[tail] + b" " + self.memory[head]).split()

    def joined(self, pieces: list[bytes]) -> list[bytes]:
        """The chunks after repair: a join whose sides do not agree makes the two chunks one."""
        out = pieces[:1]
        for piece in pieces[1:]:
            if self.agrees(out[-1], piece):
                out.append(piece)
            else:
                out[-1] += piece
        return out


_CODEC: dict[tuple[str, int], Codec] = {}


def worker_codec(json: str, memory_words: int) -> Codec:
    """The codec of this worker process, with its memory, kept from task to task; one tokenizer at a time."""
    key = (json, memory_words)
    if key not in _CODEC:
        _CODEC.clear()
        _CODEC[key] = Codec(json, memory_words)
    return _CODEC[key]


def _bloom_places(digests: np.ndarray, bits: int) -> np.ndarray:
    """Three bit numbers per 16-byte digest."""
    halves = digests.reshape(-1, 16).view("<u8")
    return np.stack([halves[:, 0], halves[:, 1], halves[:, 0] ^ (halves[:, 1] >> np.uint64(7))], 1) % np.uint64(bits)


def shared_filter(rows: DataFrame, chunk_bytes: int, bits: int) -> np.ndarray:
    """Bloom filter (64-bit words) of the digests of chunks that two documents or more hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = common.utf8(batch.column(0))
            view = memoryview(raw)
            for i, j in common.slices(off):
                found = []
                for cuts, a, b in zip(cut_places(raw, off[i : j + 1], chunk_bytes), off[i:j].tolist(), off[i + 1 : j + 1].tolist(), strict=True):
                    if b > a:
                        found += {digest(c) for c in chunks(bytes(view[a:b]), cuts)}
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["digest"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _bloom_places(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8), bits).ravel()
            word, bit = (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], names=["word", "bits"])

    shared = rows.select("text").mapInArrow(run, "digest binary").groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # At most bits / 64 rows come to the driver, whatever the input.
    parts = shared.select("digest").mapInArrow(words, "word bigint, bits bigint").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[parts.column("word").to_numpy()] = parts.column("bits").to_numpy().view(np.uint64)
    return out


_PART = "row bigint, doc_id bigint, part int, done boolean, digest binary, chunk binary, n_tokens bigint, ids binary, ids_out binary, decoded_out binary"
_PART_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("done", pa.bool_()), ("digest", pa.binary()), ("chunk", pa.binary()),
    ("n_tokens", pa.int64()), ("ids", pa.binary()), ("ids_out", pa.binary()), ("decoded_out", pa.binary()),
])


def _finish(codec: Codec, ids: bytes, digests: bool) -> tuple[int, bytes, bytes]:
    """(count, ids, decoded text) of a whole document; as sha256 in hex if asked."""
    text = codec.decode(ids)
    n = ids.count(b" ") + 1 if ids else 0
    if digests:
        return n, hashlib.sha256(ids).hexdigest().encode(), hashlib.sha256(text).hexdigest().encode()
    return n, ids, text


def encode(documents: DataFrame, tokenizer: str, *, digests: bool = False, chunk_bytes: int = CHUNK_BYTES, bloom_bits: int = BLOOM_BITS,
           memory_words: int = MEMORY_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every text of ``documents`` (doc_id, text).

    ``tokenizer`` is the path of a tokenizers file. ``ids`` are decimal,
    joined by one space; with ``digests`` both outputs are their sha256 in hex.
    """
    spark = documents.sparkSession
    json = Path(tokenizer).read_text()
    Codec(json)  # a tokenizer of another kind fails here, not in a task
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = spark.sparkContext.broadcast((json, shared_filter(rows, chunk_bytes, bloom_bits)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, bloom, seen = worker_codec(sent.value[0], memory_words), sent.value[1], set()

        def is_shared(ds: list[bytes]) -> list[bool]:
            places = _bloom_places(np.frombuffer(b"".join(ds), np.uint8), bloom_bits)
            hit = (bloom[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
            return hit.all(1).tolist()

        for batch in batches:
            ids, numbers = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            raw, off = common.utf8(batch.column(2))
            view = memoryview(raw)
            for i, j in common.slices(off):
                out = []
                for r, cuts in zip(range(i, j), cut_places(raw, off[i : j + 1], chunk_bytes), strict=True):
                    text = bytes(view[off[r] : off[r + 1]])
                    pieces = codec.joined(chunks(text, cuts))
                    names = [digest(c) for c in pieces]
                    flags = is_shared(names)
                    if not any(flags):
                        out.append((numbers[r], ids[r], 0, True, None, None, *_done(codec, codec.encode(text), digests)))
                        continue
                    part, local = 0, []
                    for piece, name, flag in zip([*pieces, b""], [*names, b""], [*flags, True], strict=True):
                        if not flag:
                            local.append(piece)
                            continue
                        if local:  # neighbours that only this document holds are one part
                            own = np.array(codec.encode(b"".join(local)).split(), codec.kind).tobytes()
                            out.append((numbers[r], ids[r], part, False, None, None, None, own, None, None))
                            part, local = part + 1, []
                        if name:
                            first = name not in seen  # a task sends a chunk's bytes once
                            seen.add(name)
                            out.append((numbers[r], ids[r], part, False, name, piece if first else None, None, None, None, None))
                            part += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PART_ARROW, strict=True)], schema=_PART_ARROW)

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = common.written(numbered.mapInArrow(cut, _PART), "bpe-parts")

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(sent.value[0], memory_words)
        for batch in batches:
            own = [np.array(codec.encode(c).split(), codec.kind).tobytes() for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["digest", "ids"])

    once = parts.where("chunk is not null").groupBy("digest").agg(F.first("chunk").alias("chunk")).mapInArrow(encode_chunks, "digest binary, ids binary")
    shared = parts.where("digest is not null").select("row", "doc_id", "part", "digest").join(once, "digest").select("row", "doc_id", "part", "ids")
    local = parts.where("not done and digest is null").select("row", "doc_id", "part", "ids")
    names = "doc_id bigint, n_tokens bigint, ids_out binary, decoded_out binary"

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, held, of = worker_codec(sent.value[0], memory_words), [], None

        def close() -> tuple:
            numbers = np.frombuffer(b"".join(held), codec.kind).tolist()
            return (of[1], *_finish(codec, b" ".join(map(b"%d".__mod__, numbers)), digests))

        for batch in batches:
            out = []
            for row, doc_id, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if of is not None and of[0] != row:
                    out.append(close())
                    held.clear()
                of = (row, doc_id)
                held.append(ids)
            if out:
                yield _results(out)
        if of is not None:
            yield _results([close()])

    together = shared.unionByName(local).repartition("row").sortWithinPartitions("row", "part").select("row", "doc_id", "ids")
    result = parts.where("done").selectExpr("doc_id", "n_tokens", "ids_out", "decoded_out").unionByName(together.mapInArrow(assemble, names))
    return result.selectExpr("doc_id", "n_tokens", "cast(ids_out as string) ids", "cast(decoded_out as string) decoded")


def _done(codec: Codec, ids: bytes, digests: bool) -> tuple[int, None, bytes, bytes]:
    n, out, text = _finish(codec, ids, digests)
    return n, None, out, text


def _results(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_tokens", "ids_out", "decoded_out"])
