"""A training-corpus pipeline: quality, near-duplicates, benchmark leaks, source mixture, coded token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm import decontaminate, minmax_dedup, mixture, quality, token_files
from lathe.llm.common import materialize, table
from lathe.llm.queries import END_ID, TOKENIZER, held_out

#: The mixture holds this share of the tokens that reach it; it may take a document in as many epochs.
MIX_SHARE = 0.8
MIX_EPOCHS = 4


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled rows outside the held-out third."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~held_out())
    return quality.keep_good(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 or more on five-word shingles."""
    return minmax_dedup.keep_representatives(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents selected to the target weights of domains, languages and sources; a document taken in several epochs is as
    many rows, and the document in which a leaf's budget ends is cut there."""
    return mixture.select_mixture(docs, share=MIX_SHARE, max_epochs=MIX_EPOCHS).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: ``(doc_id, start, n_tokens, ids_crc32, epoch)``; the rows of one document
    are numbered as its epochs."""
    path = token_files.new_path(spark, "corpus-tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    # A row without doc_id is a document of its own.
    same = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("start"))).orderBy("start")
    return token_files.read_digests(spark, path).withColumn("epoch", F.row_number().over(same) - 1)


STAGES = [("quality", good_quality), ("near_dedup", without_near_duplicates), ("decontamination", without_benchmark),
          ("mixing", mixed), ("token_output", token_output)]

#: No SQL: the classifier is trained and the files are coded; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
