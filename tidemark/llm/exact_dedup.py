"""Exact deduplication with stateful streaming.

Two streams run one after the other. The first reads documents and writes a thin row of each: doc_id, digest (SHA-256 of the normalised text) and content
locator (file and place of the row). The second keeps state by digest on disk (RocksDB, checkpointed in the shared folder), which
never expires, as there is no watermark: the smallest doc_id, its locator, and the number of rows. Copies are pre-aggregated before the
shuffle, so a digest with a third of all rows costs one row for each task. A micro-batch emits the digests that it changed; the last word on each digest is
its smallest id and largest count. With a folder for ``state``, both streams' checkpoints and tables stay there, and a later call reads only
the files that are new and goes on from the state; without one they go when the result is written.

Hits, digests of more than one row, are checked on full bytes: the largest and the smallest normalised text of a digest,
partial aggregates again, must be equal. A bitmap of fixed size clears texts that no hit has, so that no other text is sorted or shuffled. A digest that
fails (a collision) is grouped by its full text instead.

Rows meet their group by an equi-join on the digest. Digests that hold more than one in ``HOT`` of all rows, fewer than ``HOT``, are joined apart, by broadcast, so that none of the
others has many rows.

Normalised: every run of ``\\x20 \\x09-\\x0D`` becomes one space; null counts as empty. A null doc_id is kept only if no other
row has the text, and counts as largest. Repeated rows (same id, same text) are copies of each other: of rows with the smallest id, the first locator is kept. An
empty table gives an empty result. Other columns are ignored, whatever their names. Only built-in column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, marked

FILES_PER_TRIGGER = 1000
HOT = 1000
NO_ID = 2**63 - 1
THIN = "doc_id long, digest string, here struct<file:string,row:long>"
#: State on disk, without space reserved ahead: there is one small store for each partition.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[ \\x09-\\x0D]+", " ")


def _rows(docs: DataFrame) -> list[Column]:
    """doc_id, digest and locator of rows that are read from files."""
    return [
        F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normalised(F.col("text")), 256).alias("digest"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("here"),
    ]


def _read(spark: SparkSession, schema: str, path: str, pattern: str = "") -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path + pattern)
    except Exception as e:  # a source without rows has no batch
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def groups_of(spark: SparkSession, source: str, at: str, files_per_trigger: int = FILES_PER_TRIGGER) -> tuple[DataFrame, DataFrame]:
    """(thin rows, (digest, keep_id, group_size, locator)): what the keyed state in the folder ``at`` holds once every file of ``source`` has been streamed."""
    schema = spark.read.parquet(source).schema
    stream = lambda: spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    docs = stream().schema(schema).parquet(f"{source[:-1]}[{source[-1]}]")  # a pattern: a stream also takes a single file then
    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)

    def thin(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/thin/batch={number}")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/groups/batch={number}")

    def run(rows: DataFrame, mode: str, name: str, each) -> None:
        rows.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/{name}").trigger(availableNow=True).foreachBatch(each).start().awaitTermination()

    try:
        run(docs.select(*_rows(docs)), "append", "read", thin)
        rows = _read(spark, THIN, f"{at}/thin", "/batch=*")
        if rows.columns and not rows.isEmpty():
            who = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("here").alias("at"))
            seen = stream().schema(THIN).parquet(f"{at}/thin/batch=*").select("digest", who.alias("who"))
            run(seen.groupBy("digest").agg(F.min("who").alias("keep"), F.count("*").alias("group_size")), "update", "state", keep)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changes = _read(spark, "digest string, keep struct<id:long,at:struct<file:string,row:long>>, group_size long", f"{at}/groups", "/batch=*")
    last = changes.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("group_size").alias("group_size"))
    return rows.select("doc_id", "digest", "here"), last.select("digest", F.col("keep.id").alias("keep_id"), "group_size", F.col("keep.at").alias("locator"))


def dedup(spark: SparkSession, source: str, files_per_trigger: int = FILES_PER_TRIGGER, state: str | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, locator) for every row of the Parquet table at ``source``."""
    ws = Workspace(spark, "exact_dedup")
    thin, groups = groups_of(spark, source, state or ws.path("state"), files_per_trigger)
    groups = ws.put(groups, "state_out")
    rows = spark.read.parquet(source)
    rows = rows.select(*_rows(rows), normalised(F.col("text")).alias("t"))

    hits = groups.where("group_size > 1").select("digest")
    some = marked(rows, lambda: [F.col("digest")], hits, lambda: [F.col("digest")]).where("_maybe")
    ends = some.groupBy("digest").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    clash = ws.put(ends.where("lo <> hi").select("digest"), "clash")

    n = thin.count()
    hot = groups.where(F.col("group_size") * HOT > n)  # fewer than HOT
    met = thin.join(F.broadcast(hot), "digest").unionByName(thin.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(groups, "digest"))
    plain = met.select("doc_id", "keep_id", "group_size", (F.col("here") == F.col("locator")).alias("kept"), F.col("digest").alias("text_sha256"), "locator", "digest")
    if not clash.isEmpty():
        bad = rows.join(clash, "digest").select("doc_id", "digest", "t", "here")
        whole = bad.groupBy("digest", "t").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("here").alias("at"))).alias("k"), F.count("*").alias("group_size"))
        redo = bad.join(whole, ["digest", "t"]).select("doc_id", F.col("k.id").alias("keep_id"), "group_size", (F.col("here") == F.col("k.at")).alias("kept"), F.col("digest").alias("text_sha256"), F.col("k.at").alias("locator"), "digest")
        plain = plain.join(clash, "digest", "left_anti").unionByName(redo)
    out = plain.select("doc_id", F.when(F.col("keep_id") != NO_ID, F.col("keep_id")).alias("keep_id"), "group_size", "kept", "text_sha256", "locator")
    out = ws.put(out, "result")
    ws.drop("state")
    ws.keep("result")
    return out


#: The query in DuckDB's SQL.
ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM n"""
