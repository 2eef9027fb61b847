"""Corpus pipeline: rules, near-duplicates, secrets, mixing, packing.

Every stage works on all that the one before kept.  All stages but the last
return the columns of documents, whatever they are called; ``n_chars``, where it
is a column, follows the text.  Null texts and empty tables pass through with the
results that the operators define, and so do rows with a null or repeated doc_id.
The near-duplicate stage goes by rows: different texts under one doc_id all stay,
and of copies one stays, whatever their doc_ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import jaccard_join, mixing, packing, quality_rules, secret_scan
from feedloom.session import materialize

TOKENIZER = "word_bpe_49k.json"


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.select(*[F.length("text").cast(kind).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def _renamed(docs: DataFrame) -> tuple[DataFrame, list[str], list]:
    """``docs`` under column names that clash with none, these names, and the way back."""
    names = [f"c_{i}" for i in range(len(docs.columns))]
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    return own, names, [F.col(n).alias(c) for c, n in zip(docs.columns, names)]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = quality_rules.trusted_documents(docs, labels)
    own, names, back = _renamed(docs)
    text = names[docs.columns.index("text")]
    judged = quality_rules.quality_rules(own, trusted.withColumnRenamed("text", text), text_col=text, carry=names)
    return judged.where("kept").select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, the one with the least doc_id (null: after all others)."""
    own, names, back = _renamed(docs)
    key, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = materialize(own.withColumn("g_row", F.monotonically_increasing_id()), "numbered")  # fixes the numbers
    groups = jaccard_join.jaccard_components(rows.select("g_row", F.col(text).alias("text")), id_col="g_row")
    order = F.struct(F.col(key).isNull().alias("g_last"), F.col(key).alias("g_id"), "g_row")
    stays = (groups.select("g_row", "component_id").join(rows.select("g_row", key).hint("merge"), "g_row")
             .groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.g_row").alias("g_row")))
    return rows.join(stays.hint("merge"), "g_row", "left_semi").select(*back)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are marked over; every document stays."""
    owner, repository = F.col("source"), F.concat_ws("/", "source", "lang")
    return _counted(secret_scan.redact(docs, owner=owner, repository=repository))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row for each epoch in which blocks of a document are taken."""
    return _counted(mixing.mixed_texts(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places there."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_stage),
    ("jaccard_join", near_duplicate_stage),
    ("secret_scans", secret_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Tokens, hashed models and seeded choices have no SQL; tests/llm checks stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
