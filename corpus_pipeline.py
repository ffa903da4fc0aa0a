"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all rows that the one before kept and returns the columns of documents, whatever else they
hold; the row travels as one struct, so column names cannot clash. An empty table passes through as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windgrid.llm import dedup, packing, quality, secrets
from windgrid.llm.common import stored, table
from windgrid.llm.toxicity import ToxicityModel


def as_row(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches 0.3; the lexicon is learned from the labels of these documents.

    A null or empty text is scored as one without a hit. Repeated rows are scored alike and stay repeated; a null id has no label.
    """
    model = ToxicityModel.fit(docs, table(spark, sf_dir, "labels"))
    return as_row(docs).filter(model.column(F.col("text"), 0.3)["predicted"] == 0).select("row.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or meet a rule learned from the labels of these documents.

    A null text has no words and is dropped. Repeated rows share their fate; a null id has no label.
    """
    # Statistics are counted once: stored beside the rows, they serve learning and verdicts.
    counted = stored(quality.described(as_row(docs)).drop("text"), "described")
    rules = quality.learn(stored(quality.labelled(counted, table(spark, sf_dir, "labels")), "labelled"))
    return counted.filter(quality.passes(rules)).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near duplicates (shingles of five words, similarity 0.8).

    Repeated rows, of equal id and text, stay once, that of the smallest hash over all columns if others differ. Documents without words are no one's duplicates.
    """
    gone = dedup.link(docs, size=5, percent=80).filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).distinct()
    rows = as_row(docs).select("row", F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    plain = [F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    rows = rows.groupBy("id", "h").agg(F.min_by("row", F.xxhash64(*plain)).alias("row"))
    return rows.join(gone, (rows["id"] == gone["_id"]) & (rows["h"] == gone["_h"]), "left_anti").select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts by [SECRET]; n_chars follows the new text where there is such a column.

    Null and empty texts stay as they are; repeated rows and null ids are treated like any other.
    """
    found = secrets.per_document(as_row(docs))
    masked = found.withColumn("row", F.col("row").withField("text", secrets.redacted(F.col("row.text"), F.col("spans"))))
    if "n_chars" in docs.columns:
        length = F.when(F.size("spans") > 0, F.length("row.text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("row", F.col("row").withField("n_chars", length))
    return masked.select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens; one row per piece.

    A null text is a document of its end token alone. Repeated rows and null ids are packed like any other; ties of length are
    ranked by a hash of id and text.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_dedup", drop_copies), ("secrets", mask_secrets), ("packing", pack)]
ORACLE_SQL = None  # no stage is SQL throughout; tests hold the pipeline against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
