"""Training-corpus pipeline over ``documents``: quality rules, near duplicates,
benchmark decontamination, secrets, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that calls one of
the operators of :mod:`tessera.llm`; its result is written as Parquet and read
again as the next one's docs.  All but the last return the columns of
``documents``; every stage works on all that the one before it kept.

Nulls: a null text has no words, fails the quality rules and is packed as an
end id alone; rows without an id are judged like others.  Ties: of near
duplicates the smallest id stays, rows of one id stay together.  Repeated rows
are judged each; empty tables give empty results; further columns of any name
are carried unchanged to the last stage, whose columns are ``packing.pack``'s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, near_dup, packing, quality, secrets
from tessera.llm._common import read_table, stored
from tessera.llm.tokens import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near their language's reference."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8): that of the smallest id."""
    return near_dup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by ``benchmark``."""
    return decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live credentials replaced in their texts."""
    return secrets.remove_live_secrets(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 ids."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), max_pieces=200_000)  # workers are shared with the other stages


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("secret_scans", secret_scans), ("pack", pack)]

# Near duplicates, tokenizing and packing have no SQL; the tests hold run()
# against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
