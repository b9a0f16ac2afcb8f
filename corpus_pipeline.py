"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir), works
on all that its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next stage's input. All stages but the last
return the columns of ``documents``.

1. toxicity: documents that the classifier rejects (score >= 0.5) go.
2. near_duplicates: one document of each group of near copies stays.
3. substring_dedup: words of repeated 50-word passages go from all but the
   first document that holds them; a text that loses none is left as it is.
4. decontamination: documents that hold a passage of a benchmark item go: 13
   of its words in a row, or an alignment of half a full match.
5. packing: the documents as pieces of sequences of 2048 tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import decontam, minhash, packing, substring, toxicity
from presswork.llm.common import fold, load
from presswork.session import checkpoint_dir, free_shuffles

#: Words on shingles of five and a similarity of 0.8 or more.
NEAR = minhash.Settings(shingle=5, percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents outside fold 0 of 5; keeps scores below
    0.5. Where their labels hold no two classes, or no n-gram tells the classes
    apart, nothing is known to be toxic and all documents stay."""
    model = toxicity.fit(docs.where(fold("doc_id", 5) != 0), load(spark, sf_dir, "labels"))
    if not len(model.slots):
        return docs
    scored = toxicity.score(docs, model, out="toxicity_score")
    return scored.where("toxicity_score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.
    Rows with a null id are in no group and stay; rows repeated under one id
    stay together."""
    got = minhash.near_duplicates(docs, NEAR).where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(got, docs["doc_id"] == got["gone"], "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    got = substring.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("n_chars"))
    return got.select(*((text if c == "text" else n_chars if c == "n_chars" else F.col(f"`{c}`")).cast(kind).alias(c) for c, kind in docs.dtypes))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    got = decontam.contaminated(docs, load(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(got, docs["doc_id"] == got["gone"], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Models, hashes and a tokenizer decide the rows: no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the checkpoint folder."""
    free_shuffles(spark)
    docs, top = load(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
    return docs
