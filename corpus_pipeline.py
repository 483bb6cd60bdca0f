"""A corpus from documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and its rows are written before the next reads them. All
but the last return the columns of documents; a text that a stage changes has its n_chars changed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.llm import decontam, packing, pii, quality, simhash
from linepulse.llm.common import materialize, table, with_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE, RADIUS, WINDOW = 3, 2, 10


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null texts are rejected."""
    return quality.judge(docs.select(COLUMNS)).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each group; one of its rows, if that id is repeated."""
    rows = with_rows(docs, *COLUMNS)
    found = simhash.near_duplicates(
        rows.select(F.col("row").alias("doc_id"), "text"), SHINGLE, RADIUS
    )
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("row"))
    return rows.join(kept, "row", "left_semi").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    rows = with_rows(docs, *COLUMNS)
    found = decontam.contamination(
        rows.select(F.col("row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), WINDOW
    )
    hit = found.where(F.size("hits") > 0).select(F.col("doc_id").alias("row"))
    return rows.join(hit, "row", "left_anti").select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with spans of personal data replaced by their kinds."""
    found = pii.spans(docs.select(COLUMNS))
    text = F.when(F.col("text").isNotNull(), pii.masked(F.col("text"), F.col("_spans")))
    n_chars = F.when(F.size("_spans") == 0, F.col("n_chars")).otherwise(F.length("text"))
    return found.withColumn("text", text).withColumn("n_chars", n_chars.cast("bigint")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and places, and the crc32 of their ids."""
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("packing", pack),
]

#: The fingerprints, the references of the quality rules and the span classifier are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
