"""Training text from documents: recognised languages, no repeated line runs, one document of each near-duplicate
class, no benchmark passages, packed into token sequences.

Each stage writes Parquet and the next one reads it. All but the last keep the columns of ``documents``.

Defined results: documents with a NULL or empty text, or none with a letter, have no language and go in the first stage, and pass the others if these
are given them; a document without an id is never the one of a class that goes; repeated rows keep or lose the same lines, and of
near duplicates the smallest id stays; an empty table passes every stage empty; further columns are kept up to packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.llm import decontaminate, jaccard, langid, line_dedup, packing
from postpulse.llm.common import crc_mod, small_batches, stored

#: No SQL can express a trained classifier.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by a model of the four fifths that the held-out rows leave."""
    small_batches(spark)
    model = langid.fit(docs.where(crc_mod(F.col("doc_id"), 5) != 0))
    return langid.keep_recognised(docs, model)


def remove_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines of eight words or more, and whole shorter texts, that occur earlier are cut out; a document of which nothing stays is dropped."""
    small_batches(spark)
    return line_dedup.drop_repeated_runs(docs, least=line_dedup.LEAST)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each class of near duplicates: five-word shingles, Jaccard 0.8 or more."""
    small_batches(spark)
    return jaccard.keep_one_each(docs, width=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of ten words of a benchmark item."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_line_runs),
    ("jaccard_join", keep_one_of_each_class),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
