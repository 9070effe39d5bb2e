"""A corpus from raw documents: quality, near duplicates, benchmark leaks, personal data, token codes.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is
written as Parquet and read again as the next one's input. All but the last return the columns of
``documents``, and further columns of their input as they are, whatever their names.

A null text counts as the empty one: it has the score of an empty text, holds no benchmark item, is a near copy of other
texts without words, and has no tokens. Texts are read whole however long. Of equal rows one stays; rows of one id with
different texts are documents of their own, and so are rows with a null id. Ties are decided by the smallest id, null last,
then by the text's hash. An empty table passes through all stages empty.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from boxweave.llm import copies, decontam, lexicon, pii, quality
from boxweave.llm.queries import table, vocabulary
from boxweave.runtime import cut_lineage

CODES = "doc_id long, n_tokens long, ids array<int>, text string"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles with a resemblance of 0.8."""
    return copies.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontam.drop_matching(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def coded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""

    def finish(rows, ids, decode):
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0).cast(pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([x.astype("int32") for x in ids], pa.list_(pa.int32())),
                pa.array([decode(x) for x in ids], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids", "text"],
        )

    return lexicon.map_codes(docs.select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), finish, CODES)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_deduplicated),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("codes", coded),
]

# Trained models, components and merges are not expressible in SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
