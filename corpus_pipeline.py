"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token files.

Each stage takes the rows that its predecessor kept, with the columns of ``documents``, and is written as
Parquet and read again for the next. The last returns what its token files hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recolith.llm import decontaminate, mixing, quality, simhash, tokenfiles
from recolith.llm.common import materialise, read

#: Pre-tokens that a worker keeps. Workers outlive their stage, and so does what they keep, beside the other stages.
TOKEN_CACHE = 50_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. The model learns from the labelled rows among ``docs``.

    A row is judged on its own text: null and empty texts have no words and go; very long texts are judged whole; repeated rows, and rows that share an id or have
    none, are each judged, and rows of equal texts stay or go together; there are no ties; an empty table stays empty, and without labels of both kinds the base rules decide alone. Other columns pass as they are, whatever their names.
    """
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id.

    Null and empty texts have the fingerprint zero and are a group like others; very long texts are fingerprinted whole; rows without an id come behind those with one; ties (rows of one id, or of
    none) go by a hash of the text and then by place; repeated rows are copies, of which one stays; an empty table stays empty. Other columns pass as they are, whatever their names.
    """
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go.

    A row is judged on its own words, whatever its id: null and empty texts have none and stay; very long texts are searched whole; repeated rows stay or go together; there are no ties; an empty
    table stays empty, and an empty benchmark takes nothing away. Other columns pass as they are, whatever their names.
    """
    return decontaminate.drop_documents(docs, read(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, twice at most.

    Null and empty texts have size 0, belong to the smallest size class and are taken at their source's rate; a null source is a source; very long texts are rows like others; repeated rows, and rows that share an
    id or have none, are each mixed; ties in the order go by a hash of all columns; an empty table stays empty. Other columns pass as they are, whatever their names.
    """
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, from the files; rows that repeat a document follow each other.

    Null and empty texts are the end id alone; null ids come first; ties in the id go by a hash of the text and then by the text; a very long text is a segment of its own; an empty table
    gives no files and no rows. Other columns are not written, whatever their names.
    """
    return tokenfiles.digest(docs, TOKEN_CACHE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
    ("token_ids", token_ids),
]

#: SQL can't express the model, the fingerprints or the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
