"""The registered queries of the training-data operators: each applies one operator, with its production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import disclosure, filter_audit, fourier, language, licenses, line_crf, minhash, mixing, planes, repeats, shingle_join, spaced_seeds, spelling
from ledgerline.llm.common import held_out, read, save, ship


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return line_crf.judge(docs, line_crf.fit(docs, read(spark, sf_dir, "labels")))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.token_files(read(spark, sf_dir, "documents"), tokenizer_path(), planes="byte")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents"))


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(read(spark, sf_dir, "documents"))


def op6_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = save(fourier.measured(read(spark, sf_dir, "documents")), "statistics")
    return fourier.scored(stats, fourier.fit(stats, read(spark, sf_dir, "labels")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs), "doc_id")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits")


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.private(read(spark, sf_dir, "documents")).drop("all_spans")


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.grouped(read(spark, sf_dir, "documents")).drop("sig")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.template_table(spark))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(read(spark, sf_dir, "documents"))


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_ALL = (
    op1_line_crf, op2_bit_planes, op3_mixing, op4_spaced_seeds, op5_repeats, op6_fourier, op7_language, op8_disclosure,
    op9_shingle_join, op10_licenses, op11_spelling, op12_filter_audit, op13_minhash,
)
QUERIES = {f.__name__: _with_package(f) for f in _ALL}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {"op3_mixing": mixing.SQL, "op10_licenses": licenses.SQL, "op12_filter_audit": filter_audit.SQL}
