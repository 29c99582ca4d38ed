"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

All stages give an empty table for an empty one, and all but the last keep the columns of documents, whatever more there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import decontaminate, linededup, packing, quality, similar
from quillmill.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored like any other; without labels all stay. Null and repeated keys are rows of their own.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go from the texts; every document stays, with its count of characters renewed.

    A null text stays null, an empty one empty; rows that repeat key and text are one document and are treated alike. Null keys come last.
    """
    return linededup.renewed(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with 5-word shingles similar to 0.8 or more that with the smallest id stays.

    Null, empty and blank texts are one group. Rows without a key all stay; of rows that repeat a key one stays.
    """
    return similar.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go.

    Null and empty texts hold none and stay; null and empty items are in none. Repeated rows are treated alike.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in full windows.

    A null or empty text is its end id alone. Rows that repeat a key, or have none, are documents of their own.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: None: the stages hold a fitted classifier and a tokenizer, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
