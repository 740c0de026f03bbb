"""A training corpus from the documents table, in five stages.

Each stage takes what its predecessor kept and has read back from Parquet; all
but the last return rows of the documents table, the last one the token ids and
the texts that they stand for.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import bpe, exact, mixing, neardup, quality
from assay.llm.queries import BPE_RANKS
from assay.llm.staging import mark, release, stage


#: Pieces that a worker keeps in the last stage, beside what the stages before it have left in memory.
REMEMBER = 150_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the compression bands, fitted to the
    labels table, go; null texts fail.  An empty table stays empty, further columns stay."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep_quality(docs, bands=quality.fit_bands(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays, null ids last; of
    repeated rows one.  Null counts as the empty text.  Further columns stay."""
    return exact.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.
    Rows without an id, or without words, stay.  Further columns stay."""
    return neardup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.  A null source is a source of
    its own; rows of one source that share an id go together.  Further columns stay."""
    return mixing.mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, text`` of every document of the mix, the
    text decoded from the ids.  A text whose ids do not give it back fails the
    job.  Null counts as the empty text."""
    given = docs.select("doc_id", "lang", "source", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("was"))
    done = bpe.encode(given, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, decoded=True, remember=REMEMBER)
    text = F.col("decoded").cast("string")
    same = F.xxhash64(text) == F.col("was")
    return done.select("doc_id", "lang", "source", "ids", F.when(same, text).otherwise(
        F.raise_error(F.concat(F.lit("ids do not give the text back: "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))).alias("text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokenise", tokenise),
]

#: SQL has no zstandard; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table.  What a stage has written for
    itself is deleted once its result is."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    since = mark()
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
            release(spark, since, keep=1)
    return docs
