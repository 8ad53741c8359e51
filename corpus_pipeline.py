"""A corpus pipeline over `documents`: five stages, each one operator of lodestone.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last keep the
columns of `documents`.

1. language_id: fits the model on the stage's labelled documents and drops
   those whose language it cannot tell.
2. simhash_dedup: of each group of near copies, one document stays; pairs come
   from the tally of shared SimHash bytes by position, and are near copies if
   they share 0.8 of their five-word shingles (exact Jaccard similarity).
3. benchmark_decontamination: drops documents that hold a benchmark item.
4. source_mixing: takes blocks of each source up to its quota, again up to
   three times where the quota asks for it.
5. token_store: writes token ids, reads them back and returns doc_id, start,
   n_tokens and the crc32 of the ids.

Cases: null, empty and letterless texts are rejected by stage 1; null or
repeated doc_ids are rows of their own, told apart by their texts; of equal
rows one stays in stage 2; ties there go to the smallest doc_id, nulls last,
then to the smallest text hash.  An empty table passes through all stages as
an empty one; other columns are kept, whatever their names, up to stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import benchmark_decontamination, language_id, mixing, near_copies, token_store
from lodestone.llm.queries import tokenizer_path
from lodestone.llm.scratch import materialise
from lodestone.session import spread


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs, language_id.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmark_decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.token_store(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("token_store", write_tokens),
]

#: the stages hold a fitted model and a tokenizer, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
