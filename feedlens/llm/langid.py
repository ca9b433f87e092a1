"""Operator 2, language ID: string kernel, Nyström landmarks, kernel ridge regression.

Features of a text are the blended spectrum of its n-grams (n = 1..3, over the
UTF-8 bytes of the text with A-Z lower-cased, and digits, punctuation and white
space as one separator byte), as presence: a set, not counts. The kernel of two
texts is the size of the intersection over the root of the product of the
sizes, on a vocabulary of n-grams: those that rank first, by the texts of a language that
hold them, in any language of the fit sample; ``vocabulary`` of them, or ``language_grams`` a
language if that is more. ``landmarks`` sample texts per language span the Nyström space;
one-versus-rest ridge regression in that space gives one score per language.
Scoring is two matrix products per block of rows: presence times landmark
presence (whole numbers, exact), then kernel values times weights.

Fit sample (documented bound): per language the ``per_language`` rows with the smallest hash
of id and text, of rows whose text has a letter (rows that repeat both count once); every language is learned.
Prediction covers every row and whole texts. What reaches the driver
follows the number of languages: ``per_language`` rows of one bit an n-gram each.

Defined cases: null text, or text without a letter: ``und`` with score 0; ties
between languages go to the alphabetically first; rows without a doc_id are
predicted, and never learned from; repeated rows are predicted each; with nothing to
learn from (empty table, no labels) every row is ``und``; other columns of the
input are not looked at. ``score`` is the best ridge output, cut to 0..1.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

PER_LANGUAGE = 200
LANDMARKS = 24
VOCABULARY = 8192
LANGUAGE_GRAMS = 128
FIT_ROWS = 2048
DEALS = 64
RIDGE = 1e-2
NONE = "und"

# Byte classes: letters and bytes above 127 stay, A-Z become a-z, the rest is one separator.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def gram_codes(raw: np.ndarray) -> np.ndarray:
    """Codes of the n-grams that start at each byte, as three rows (n = 1, 2, 3); 0 where a text ends."""
    b = _FOLD[raw].astype(np.int32)
    out = np.zeros((3, len(b)), np.int32)
    out[0] = b
    out[1, :-1] = (b[:-1] << 8) | b[1:]
    out[2, :-2] = (out[1, :-2] << 8) | b[2:]
    return out


def text_grams(raw: np.ndarray) -> np.ndarray:
    """Distinct n-gram codes of one text."""
    codes = gram_codes(raw)
    return np.unique(np.concatenate([codes[0], codes[1, : len(raw) - 1], codes[2, : max(0, len(raw) - 2)]]))


class Vocabulary:
    """n-gram codes to columns, by a table over all codes of up to three bytes (32 MB a worker, 64 MB for 65,536 columns or more)."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        kind = np.uint16 if self.size < 1 << 16 else np.uint32
        self.column = np.full(1 << 24, self.size, kind)
        self.column[codes] = np.arange(self.size, dtype=kind)

    def presence(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """0/1 matrix of the rows of ``off`` over the vocabulary."""
        rows = np.zeros((len(off) - 1, self.size + 1), np.float32)
        base = int(off[0])
        codes = gram_codes(raw[base : int(off[-1])])
        columns = self.column[codes]
        for r, (a, b) in enumerate(zip((off[:-1] - base).tolist(), (off[1:] - base).tolist(), strict=True)):
            for n in range(3):
                if b - n > a:
                    rows[r, columns[n, a : b - n]] = 1
        return rows[:, : self.size]


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of rows with landmarks; 0 for a row without n-grams."""
    norm = np.sqrt(rows.sum(1, dtype=np.float64))[:, None] * np.sqrt(landmarks.sum(1, dtype=np.float64))[None, :]
    return np.divide(rows @ landmarks.T, norm, out=np.zeros(norm.shape), where=norm > 0)


def fit_ridge(bits: np.ndarray, width: int, labels: np.ndarray, languages: list[str], landmarks: int, ridge: float):
    """(landmark rows, weights from landmark kernel values to one score per language); ``bits``: presence, packed by row."""

    def presence(rows) -> np.ndarray:
        return np.unpackbits(bits[rows], axis=1)[:, :width].astype(np.float32)

    marks = np.sort(np.concatenate([np.flatnonzero(labels == k)[:landmarks] for k in range(len(languages))]))
    chosen = presence(marks)
    values, vectors = np.linalg.eigh(kernel(chosen, chosen))
    keep = values > 1e-8 * values.max()
    to_space = vectors[:, keep] / np.sqrt(values[keep])
    # Each language weighs the same, however many of its rows were sampled.
    weight = 1.0 / np.maximum(1, np.bincount(labels, minlength=len(languages)))[labels]
    left, right = ridge / len(languages) * np.eye(to_space.shape[1] + 1), np.zeros((to_space.shape[1] + 1, len(languages)))
    for i in range(0, len(labels), FIT_ROWS):
        own = slice(i, i + FIT_ROWS)
        z = np.column_stack([kernel(presence(own), chosen) @ to_space, np.ones(len(labels[own]))])
        weighted = (z * weight[own, None]).T
        left += weighted @ z
        right += weighted @ (labels[own, None] == np.arange(len(languages))[None, :])
    solved = np.linalg.solve(left, right)
    return chosen, to_space @ solved[:-1], solved[-1]


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """The fit sample: ``lang, doc_id, mark, h`` of the ``per_language`` rows of every language with the smallest hashes.

    Rows that repeat an id and a text (``mark``) count once. The smallest of each of
    ``DEALS`` parts of a language are found first, so no task ranks more than
    ``DEALS * per_language`` rows of a language, whatever it holds.
    """
    rows = labelled.where("lang is not null and doc_id is not null").select("lang", "doc_id", "mark").distinct()
    rows = rows.withColumn("h", F.xxhash64("doc_id", "mark")).withColumn("deal", F.pmod("h", F.lit(DEALS)))
    for keys in (("lang", "deal"), ("lang",)):
        order = Window.partitionBy(*keys).orderBy("h", "doc_id", "mark")
        rows = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).drop("k")
    return rows.drop("deal")


def fit(labelled: DataFrame, *, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, vocabulary: int = VOCABULARY,
        language_grams: int = LANGUAGE_GRAMS, ridge: float = RIDGE) -> dict | None:
    """The model learned from ``labelled`` (doc_id, text, lang); None with nothing to learn from."""
    if vocabulary < 1 or language_grams < 1:
        raise ValueError("need a vocabulary")
    labelled = labelled.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text", "cast(lang as string) lang")
    # Other texts teach nothing, and would take the places of those that do.
    labelled = labelled.where(F.col("text").rlike(r"\p{L}")).withColumn("mark", F.xxhash64("text"))
    chosen = _sample(labelled, per_language)
    # At most per_language rows of four columns a language: a bounded broadcast.
    sample = labelled.join(F.broadcast(chosen), ["lang", "doc_id", "mark"]).groupBy("lang", "doc_id", "mark", "h").agg(F.min("text").alias("text"))
    sample = common.written(sample.select("doc_id", "lang", "h", "text"), "langid-sample")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(common.texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                grams = text_grams(np.frombuffer(text, np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int32())], names=["lang", "gram"])

    grams = sample.select("text", "lang").mapInArrow(distinct, "lang string, gram int").groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    grams = common.written(grams.withColumn("rank", rank).groupBy("gram").agg(F.min("rank").alias("rank"), F.sum("n").alias("n")), "langid-grams")
    n_languages = sample.select("lang").distinct().count()
    # Room for the first language_grams of every language, whatever the others hold.
    top = grams.orderBy("rank", F.col("n").desc(), "gram").limit(max(vocabulary, language_grams * n_languages)).toPandas()
    if not len(top):
        return None
    codes = np.sort(top["gram"].to_numpy())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Vocabulary(codes)
        for batch in batches:
            raw, off = common.utf8(batch.column(0))
            bits = [np.packbits(table.presence(raw, off[i : j + 1]) > 0, axis=1) for i, j in common.slices(off, 1 << 19)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for x in bits for r in x], pa.binary()), batch.column(1), batch.column(2), batch.column(3)],
                names=["bits", "lang", "h", "doc_id"],
            )

    rows = sample.select("text", "lang", "h", "doc_id").mapInArrow(packed, "bits binary, lang string, h bigint, doc_id bigint")
    rows = rows.toPandas().sort_values(["h", "doc_id", "lang", "bits"], kind="stable")
    languages = sorted(rows["lang"].unique())
    bits = np.stack([np.frombuffer(b, np.uint8) for b in rows["bits"]])
    labels = np.searchsorted(languages, rows["lang"].to_numpy().astype(str))
    chosen, weights, bias = fit_ridge(bits, len(codes), labels, languages, landmarks, ridge)
    return {"codes": codes, "languages": languages, "landmarks": np.packbits(chosen > 0, axis=1), "weights": weights, "bias": bias}


def has_letter(text: bytes) -> bool:
    return text.lower() != text.upper() or any(c.isalpha() for c in text.decode())


class Predictor:
    """A fitted model inside a worker."""

    def __init__(self, model: dict):
        self.table = Vocabulary(model["codes"])
        self.landmarks = np.unpackbits(model["landmarks"], axis=1)[:, : self.table.size].astype(np.float32)
        self.weights, self.bias, self.languages = model["weights"], model["bias"], model["languages"]

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        raw, off = common.utf8(column)
        names, scores, view = [], [], memoryview(raw)
        for first, last in ((a, min(a + 256, j)) for i, j in common.slices(off, 1 << 20) for a in range(i, j, 256)):
            out = kernel(self.table.presence(raw, off[first : last + 1]), self.landmarks) @ self.weights + self.bias
            out = np.round(out, 9)
            best = out.argmax(1)
            for r, k in enumerate(best.tolist()):
                known = has_letter(bytes(view[off[first + r] : off[first + r + 1]]))
                names.append(self.languages[k] if known else NONE)
                scores.append(float(min(1.0, max(0.0, out[r, k]))) if known else 0.0)
        return names, scores


def predict(documents: DataFrame, model: dict | None, *, column: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``documents`` with the predicted language and its score (in columns ``names``) for the whole text of every row.

    Columns of the input that have these names are replaced.
    """
    out = documents.drop(*names)
    if model is None:
        return out.withColumn(names[0], F.lit(NONE)).withColumn(names[1], F.lit(0.0))
    at = out.columns.index(column)
    blob = out.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = None
        for batch in batches:
            predictor = predictor or Predictor(pickle.loads(blob.value))
            found, scores = predictor.predict(batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, *names],
            )

    schema = out.withColumn(names[0], F.lit("")).withColumn(names[1], F.lit(0.0)).schema
    return out.mapInArrow(run, schema)
