"""From raw documents to token ids: judge, deduplicate, redact, mix and encode.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and
returns a DataFrame; its result is written as Parquet and read again as the
documents of the next stage.  All but the last return the columns of documents.
Nulls, empty texts, repeated rows and empty tables are treated as the stages'
operators define.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import mixing, pii, quality_rules, sentencepiece_viterbi, simhash
from tabwright.llm.common import documents, staged


def judged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep."""
    return quality_rules.kept_rows(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.one_per_group(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def _stands_in_files(docs: DataFrame) -> bool:
    """Whether the rows come straight from files, so that Spark knows each one's file and place in it."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; sorted by ``mix_part`` and ``mix_place`` they stand in the order of the mix.

    The stage before wrote its rows in that order, but a table is read back in any
    order, so each row takes its place from the file it stands in.  Rows that do not
    come from files have nulls there.
    """
    if _stands_in_files(docs):
        name = F.col("_metadata.file_name")
        # A task's number, and that of its file if it wrote more than one.
        number = lambda pattern: F.regexp_extract(name, pattern, 1).try_cast("long")
        places = {"mix_part": number("part-([0-9]+)") * 1000 + F.coalesce(number("-c([0-9]+)"), F.lit(0)), "mix_place": F.col("_metadata.row_index")}
    else:
        places = {name: F.lit(None).cast("long") for name in ("mix_part", "mix_place")}
    return sentencepiece_viterbi.encode(docs.withColumns(places)).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", judged),
    ("near duplicates", distinct),
    ("personal data", redacted),
    ("mixing sources", mixed),
    ("token ids", encoded),
]

# Fingerprints, boosted trees and piece merging have no SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others return is staged in the shared folder."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
