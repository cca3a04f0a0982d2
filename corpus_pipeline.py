"""A training-data pipeline over ``documents``: language, near copies, contamination, mixture, token files.

Each stage takes what its predecessor kept, as a table of documents, and its decisions take effect:

1. language: documents that cross-parsing can't place go (``und``: null texts, texts without letters; and texts that need about a phrase a letter
   in every learned language).
2. near_copies: of each group of linked documents (80% of their five-word shingles in common) the one with the smallest id stays (of equal ids, one row with the least text).
   Empty texts link with nothing and stay.
3. decontaminate: documents that overlap with a benchmark item go.
4. mix: each document is repeated as often as the temperature mixture shows it, at least once; rows are laid out in the order of the mixture's turns.
5. token_files: the documents' ids are written as plane files in the order in which the mixture lies, so that the sources alternate and the copies of a
   document lie apart; what is returned is read from them.

Null and empty texts end at the first stage. Very long texts go through all stages whole. An empty table gives empty results. Each stage reads a stored
table; only the last one minds the order in which its files and their rows lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import language, mixing, planes, shingle_join, spaced_seeds
from ledgerline.llm.common import read, save, ship
from ledgerline.llm.queries import tokenizer_path

#: Near copies share so many percent of their shingles of so many words; op9 has the numbers of its own contract.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Share of the encoder's tables that the last stage keeps.
KEPT = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language.with_language(docs, language.learn(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return shingle_join.one_of_each(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return spaced_seeds.uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, in_turn=True)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # workers have the other stages' memory behind them: they keep a part of the encoder's tables
    return planes.token_files(docs, tokenizer_path(), planes="byte", kept=KEPT, as_stored=True)


STAGES = [("language", language_stage), ("near_copies", near_copies), ("decontaminate", decontaminate), ("mix", mix), ("token_files", token_files)]

#: Cross-parsing, the tokenizer and the file format have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
