"""From raw documents to a training mix: five stages, each one operator of ``waybill.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of documents. ``run`` writes every stage's result as a table in the shared
folder and reads it again as the next one's input, so a lost executor costs tasks, not stages.

Texts that are null or have no letter have no language and go in the first stage. Rows without
doc_id are carried along, but line dedup and the Jaccard join cannot drop anything of them. Extra
columns pass through; where one is called ``copies``, the mix's own is ``copies_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontamination, jaccard_join, language_id, line_dedup, mixing
from waybill.llm.storage import kept, small_batches


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled rows that are not held out.

    Where no row is labelled nothing can be told, and all documents stay.
    """
    small_batches(spark)
    profiles = kept(language_id.learn(docs.where(~language_id.held_out(F.col("doc_id")))),
                    "profiles")
    if profiles.isEmpty():
        return docs
    found = language_id.identify(docs, profiles)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least three documents hold; n_chars follows the text."""
    small_batches(spark)
    out = line_dedup.dedup(line_dedup.store_of(docs), docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return jaccard_join.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with the benchmark."""
    small_batches(spark)
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each with its number of copies."""
    small_batches(spark)
    return mixing.copied(mixing.mix(docs))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
]

# The first stage learns a classifier, which SQL cannot express; tests hold the pipeline against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
