"""Corpus pipeline: language ID, near duplicates, decontamination, secrets, encoding.

Each stage takes the documents its predecessor kept, as a written table, and
all but the last return the columns of ``documents``. ``run`` writes each
stage's result to the shared folder and reads it back.

1. language ID drops what it rejects: documents that are ``und`` (null, or no letter).
2. n-gram join (5 words, 0.8) keeps one row of each group of linked texts: the first by doc_id
   (null last), then by the hash of its text; rows without words stay.
3. decontamination drops every document with a word in a benchmark window.
4. secret scans replace each secret in the text and set ``n_chars`` anew.
5. BPE returns doc_id, the number of tokens, and the sha256 of ids and decoded text.

Rows without a doc_id, or of one doc_id, are judged by every stage like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import bpe, decontaminate, langid, ngram_join, secrets
from feedlens.llm.common import fresh, table, written
from feedlens.llm.queries import held_out, tokenizer_path

# The stages encode by a tokenizer and join by row groups: no SQL states them.
ORACLE_SQL = None

# Near duplicates: five words a shingle, a Jaccard similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    lang, score = fresh(docs, "lang_pred", "score")
    return langid.predict(docs, model, names=(lang, score)).where(F.col(lang) != langid.NONE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, size=SHINGLE_WORDS, num=SIMILAR, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = bpe.encode(docs, tokenizer_path(), digests=True)
    return rows.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
