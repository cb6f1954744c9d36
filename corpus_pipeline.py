"""A corpus cleaned step by step: languages, repeated lines, near-duplicates, benchmark leaks, then encoding.

Each stage takes the documents that the stage before it kept, as a written table, and works on all of them. All but the
last return the columns of ``documents``. Null and empty texts and extra columns are dealt with as the operators' docstrings
say; in near-dedup and decontamination a row whose id is null or repeated is a document of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, language, line_dedup, near_dup, pieces
from millrace.llm.queries import tokenizer_file
from millrace.session import settle

#: A document stays if its language is known; texts without a letter have none.
REJECTED = language.UNKNOWN
#: Numbers of rows without an id of their own begin here.
BEYOND_IDS = 1 << 62


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: learns from the labelled documents, drops texts of unknown language and fills missing labels."""
    kept = docs.columns
    found = language.identify(docs, language.fit(docs)).where(F.col("lang_pred") != REJECTED)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*kept)


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: of each group of equal or similar lines one stays; a document that loses every line goes."""
    return _counted(line_dedup.without_repeated_lines(docs))


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with __row, a number for each row: its doc_id, or one beyond all ids where that is null or repeated.

    Only ids are grouped; the rows in question are written once, so their numbers hold.
    """
    shared = settle(docs.groupBy(F.col("doc_id").alias("__shared")).agg(F.count("*").alias("__n")).where("__n > 1 OR __shared IS NULL"), "shared")
    same = docs["doc_id"].eqNullSafe(shared["__shared"])
    own = docs.join(shared, same, "left_anti").withColumn("__row", F.col("doc_id").cast("bigint"))
    other = docs.join(shared, same, "left_semi").withColumn("__row", F.lit(BEYOND_IDS) + F.monotonically_increasing_id())
    return own.unionByName(settle(other, "unnamed"))


def _without(named: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose number is not among those of ``gone``, a written table."""
    return named.join(gone, named["__row"] == gone["__gone"], "left_anti").drop("__row")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group one row stays, that with the least id; rows whose id is null or repeated come last."""
    named = _named(docs)
    found = near_dup.near_duplicates(named.select(F.col("__row").alias("doc_id"), "text"))
    return _without(named, settle(found.where("NOT kept").select(F.col("doc_id").alias("__gone")), "gone"))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows that hold an item of ``benchmark`` go, each judged by its own text."""
    named = _named(docs)
    found = decontaminate.leaks(named.select(F.col("__row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(named, settle(found.select(F.col("doc_id").alias("__gone")).distinct(), "leaks"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding and decoding: ids of each whole text, and whether they decode to it."""
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("language", with_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_leaks),
    ("encoding", encoded),
]

#: Language models, MinHash and the encoder have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
