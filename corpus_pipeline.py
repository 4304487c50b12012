"""The corpus pipeline: from raw documents to the token ids of a clean, deduplicated and mixed corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents
(doc_id, text, lang, source, n_chars). A stage works on all that its predecessor kept:

1. quality_rules: documents that the current quality policy rejects go.
2. near_duplicates: of documents that are tied by word 5-gram sets with a Jaccard similarity of 0.8 or more, the one
   with the smallest doc_id stays.
3. repeated_passages: bytes covered by 400-byte strings, or by strings of 51 words, that start elsewhere as well are cut
   out of the texts. Where a cut leaves part of a character, the rest of it goes too. Documents stay, even if nothing is
   left of their text.
4. mixture: the documents are mixed to the sources' target weights. A document is returned once for each repeat of its
   source's stream that takes words of it; where a source's share ends within a document, that repeat's text ends there
   too. Documents of which the mix takes no word go.
5. tokens: one row for each row of the mixture: n_tokens and digests of its ids and of the bytes they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import bpe, dedup_suffix, jaccard, mixing, quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The third stage's passages: over 50 words.
PASSAGE_WORDS = 51

#: No SQL says what the third and the last stage do.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.ledger(docs.select(*COLUMNS), "text", "ledger")
    return judged.where(quality.passes(F.col("ledger.fail_bits"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs.select(*COLUMNS)).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = dedup_suffix.remove(docs.select(*COLUMNS), words=PASSAGE_WORDS, cut_passages=True, column="r")
    text = F.when(F.col("r.n_removed") > 0, dedup_suffix.whole_characters(F.col("r.kept"))).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    turns = mixing.repeats(docs.select(*COLUMNS), column="turn")
    part = F.col("turn.taken") < F.col("turn.size")
    text = F.when(part, mixing.first_words(F.when(part, F.col("text")), F.col("turn.taken"))).otherwise(F.col("text"))
    cut = turns.withColumn("text", text)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.round_trip_digests(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "bpe.*")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
