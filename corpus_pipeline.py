"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, repeated passages go, secrets
are masked, and what is left is packed into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tariffloom.llm import jaccard, packing, secrets, substring, toxicity
from tariffloom.llm.common import drop_staged, fresh, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from labelled documents of the same table.

    Null and empty texts are scored as texts without a known word; rows with null or repeated ids are judged one by one.
    """
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learned_from))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, each of its texts once; rows without an id stay.

    An id that comes with several texts keeps them all, as they are one document; only equal rows of it go. Null and empty
    texts link with nothing and stay.
    """
    kept = jaccard.join(docs).where("doc_id = component_id").select("doc_id").distinct()
    row = fresh("row", docs)
    first = F.row_number().over(W.partitionBy("doc_id", F.xxhash64("text"), F.length("text")).orderBy(F.xxhash64(*docs.columns)))
    own = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").select(*docs.columns)
    return own.withColumn(row, first).where(F.col(row) == 1).drop(row).unionByName(docs.where("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words that a window of an earlier one covers; a null text becomes an empty one."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = substring.dedup(docs, carry=others)
    return out.withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked; a null text stays null."""
    return secrets.redact_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences; an empty text is the end id alone."""
    import public_tokenizers

    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_group),
    ("substring_dedup", drop_repeated_passages),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None  # a trained network and a tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder: a row for each piece with its place in the sequences.

    Each stage's rows are written to the shared folder and read again, and go when the next stage is written. Rows with a
    null id take part in the stages that need none and stay in the others; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        kept = stage(step(spark, docs, sf_dir), name)
        drop_staged(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
