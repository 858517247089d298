"""Corpus pipeline: from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, ngram_join, quality, token_store
from tidemark.llm.common import Workspace, rest, table, without
from tidemark.llm.entries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL can't express a trained classifier, nor the tokenizer.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    rest(spark)
    return _documents(quality.scores(_documents(docs), table(spark, sf_dir, "labels")).where("kept"))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose (doc_id, hash of the text) is not in ``keys``, rows without an id too; rows of one key are copies of each other."""
    return without(docs, lambda: [F.col("doc_id"), F.xxhash64("text")], keys, lambda: [F.col("doc_id"), F.col("text_hash")])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents whose 5-word shingles have a Jaccard similarity of 0.8 or more: the one of the smallest id (none
    counts as largest), then of the smallest text hash. Rows of one id and different texts are different documents; documents without words have no partner and stay."""
    rest(spark)
    docs = _documents(docs)
    ws = Workspace(spark, "near_duplicates")
    found = ngram_join.jaccard_components(docs, k=5, percent=80).where("component is not null")
    key = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")
    groups = found.groupBy("component").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    members = ws.put(found.join(groups, "component").select("doc_id", "text_hash", (key == F.col("first")).alias("stays")), "members")
    kept = _without(docs, members.where("not stays").select("doc_id", "text_hash").distinct())
    again = members.where("stays").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_hash")
    again = ws.put(again, "again")
    if again.isEmpty():
        return kept
    keyed = kept.withColumn("h", F.xxhash64("text"))
    twice = keyed.join(again.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("text_hash")), "left_semi")
    return _without(kept, again).unionByName(_documents(twice.dropDuplicates(["doc_id", "h"])))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rest(spark)
    docs = _documents(docs)
    return _without(docs, decontaminate.matches(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "text_hash").distinct())


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, as often as it takes them."""
    rest(spark)
    return _documents(mixing.repeated(_documents(docs)))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; returns each document's place and checksum as read back from them."""
    rest(spark)
    return token_store.encode_documents(docs, tokenizer_file())


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("token output", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = ws.put(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            ws.drop(f"stage{i - 1}")
    return docs
