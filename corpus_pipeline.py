"""Documents to training records: five stages, and the whole run.

Each stage takes the rows its predecessor kept and returns rows with the
columns of ``documents``; the last writes the token records and returns their
index. Empty tables pass through all stages; rows with a null or empty text are
rejected by the first one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import shared_folder, stored
from factloom.llm.decontamination import decontaminated
from factloom.llm.language import UNKNOWN, identify, learn_with_floors, score_floor
from factloom.llm.mixing import mix
from factloom.llm.records import write_records
from factloom.llm.simhash import first_of_each


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; ``lang`` becomes the language told, and documents in none of those learned go.

    A document goes if it has no letter or if its score is below the floor of its
    language and length. Without a labelled document no language can be told:
    those with a letter stay, as they are.
    """
    model, floors = learn_with_floors(docs)
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = identify(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= score_floor(floors)))
    return told.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of three-word shingles, linked at 2 or fewer bits) stays, that with the smallest id."""
    return first_of_each(docs, words=3, errors=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes once for each time it is taken."""
    return mix(docs).select(docs.columns)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as a framed token record, in the mixed order; the index of the shards.

    The rows are not moved: what the mix has put into one file, and the order it
    has there, is how the records follow each other.
    """
    import public_tokenizers

    path = shared_folder(spark, "pipeline-records")
    index = write_records(docs, path, public_tokenizers.path("word_bpe_49k.json"), by_words=True, as_they_stand=True)
    return index.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "number", "offset", "length")


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed_sources),
    ("token_records", token_records),
]

#: The stages learn a model, draw with seeded generators and tokenize; SQL cannot express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on ``documents``; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
