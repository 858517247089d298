"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key ``-ln(u) / weight``: u in (0, 1) from a hash of its id, its text and a seed, weight its
quality weight. Within a source, documents ordered by key are a weighted sample without replacement. A source
whose target is above its size takes complete epochs first; what is left of the target is filled in key order, up to the
document whose end is nearest to it.

The order within a source is never sorted in one task: keys are dealt into ``BUCKETS`` ranges of nearly equal
probability, sums of ranges are prefix-summed (at most BUCKETS numbers for a source), and rows are
prefix-summed within their range only. Rows of one id and text have one key; they are counted before they are ordered and told out again by their count, so
that any number of them is one row there. Sources are water-filled in closed form over one row for each source: one task
orders the sources, which are as many as ``source`` has values, not as there are documents.

Null texts have size 0 and are never taken; null sources form one source, the last; rows without an id are told apart by their texts. Ties of keys go by id,
size and text hash, so that any order of the input gives the same rows. Repeated
rows are documents of their own. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.common import FILE_ROWS, Workspace, blocks, text_buffers, trimmed

BUCKETS = 1024
COPIES = 1 << 14
WEIGHTS = (5, 2, 1)
SEED = 7
_ALNUM = np.zeros(256, np.int64)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def measure(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, h, source, size, rank): text hash, words and sampling key of every row."""
    return measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")), seed)


def measured(rows: DataFrame, seed: int) -> DataFrame:
    """(..., doc_id, h, source, size, rank) of rows (..., doc_id, h, source, text).

    The weight is 1 less four times the share of bytes in words that are neither letters nor digits, 0.05 at least.
    """

    def run(batches):
        for batch in batches:
            raw, off = text_buffers(batch.column(front + 3))
            sizes, weights = [], []
            for a, b in blocks(off):
                part, own = raw[off[a] : off[b]], off[a : b + 1] - off[a]
                _, _, n = K.word_spans(part, own)
                letters = np.concatenate(([0], np.cumsum(_ALNUM[part])))
                ink = np.concatenate(([0], np.cumsum(~K.SPACE[part])))
                good, all_ = np.diff(letters[own]), np.diff(ink[own])
                sizes.append(n)
                weights.append(np.maximum(0.05, 1 - 4 * (all_ - good) / np.maximum(all_, 1)))
            if not sizes:
                continue
            ids = np.asarray(batch.column(front).fill_null(0)).astype(np.int64).view(np.uint64)
            own = K.mix(ids + K.U(1)) + np.asarray(batch.column(front + 1)).view(np.uint64) * K.MULT[55]
            u = ((K.mix(own ^ K.U(int(K.MULT[60]) * seed % 2**64)) >> K.U(11)).astype(np.float64) + 0.5) / 2.0**53
            w = np.concatenate(weights)
            columns = [*batch.columns[: front + 3], pa.array(np.concatenate(sizes), pa.int64()), pa.array(-np.log(u) / w)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    from pyspark.sql import types as T

    front = len(rows.columns) - 4
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("size", T.LongType()), T.StructField("rank", T.DoubleType())])
    return rows.mapInArrow(trimmed(run), schema)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size, ...) with target: ``share`` of all sizes by weight, ``most`` times a source's size at most.

    Sources by code point, null last, take the weights in turn. The excess of full sources is shared again by weight
    until none is above: with sources ordered by most * size / weight, the full ones are a prefix, and the level
    of the others is what remains over the weight that remains. The window holds one row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    x = sizes.withColumn("w", F.element_at(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1))
    x = x.withColumn("cap", F.col("source_size") * F.lit(most))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    every = Window.partitionBy(F.lit(0))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("total", F.sum("source_size").over(every) * F.lit(share))
    x = x.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    x = x.withColumn("open_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    x = x.withColumn("level", F.when(F.col("cap") * F.col("open_w") >= F.col("left") * F.col("w"), F.col("left") / F.col("open_w")))
    x = x.withColumn("at", F.row_number().over(fill))
    x = x.withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("at"))).over(every))
    return x.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap")))).drop("w", "cap", "total", "left", "open_w", "level", "at")


def _ordered(rows: DataFrame, ws: Workspace, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Groups of equal rows of ``measure`` in the order of their source: with n, the words before them, and the source's epochs and rest."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = ws.put(targets(sizes, weights, share, most), "plan")
    key = [F.col("source").isNull().alias("no"), F.coalesce("source", F.lit("")).alias("name")]
    plan = plan.select(*key, "source_size", "target")
    # The range of a key needs no source: weights are near 1, and any rule that grows with the key serves.
    dealt = rows.select("*", *key).withColumn("bucket", F.floor((1 - F.exp(-F.col("rank") * 0.9)) * BUCKETS).cast("int"))
    sums = dealt.groupBy("no", "name", "bucket").agg(F.sum("size").alias("in_bucket"))
    sums = sums.withColumn("before", F.sum("in_bucket").over(Window.partitionBy("no", "name").orderBy("bucket")) - F.col("in_bucket"))
    sums = ws.put(sums.join(plan, ["no", "name"]).drop("in_bucket"), "sums")
    equal = dealt.groupBy("no", "name", "bucket", "source", "rank", "doc_id", "size", "h").agg(F.count("*").alias("n"))
    own = F.col("size") * F.col("n")
    inside = Window.partitionBy("no", "name", "bucket").orderBy("rank", "doc_id", "size", "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = equal.withColumn("inside", F.sum(own).over(inside) - own).join(sums, ["no", "name", "bucket"])
    x = x.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    return x.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("ahead", F.col("before") + F.col("inside"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, text_hash) for every row of ``docs`` (doc_id, source, text)."""
    ws = Workspace(docs.sparkSession, "mix")
    rows = ws.put(measure(docs, seed), "rows")
    x = _ordered(rows, ws, weights, share, most)
    x = x.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    x = x.withColumn("copy", F.explode(F.sequence(F.col("lot") * COPIES, F.least(F.col("n"), (F.col("lot") + 1) * COPIES) - 1)))
    x = x.withColumn("more", F.when(F.col("rest") - (F.col("ahead") + F.col("copy") * F.col("size")) >= F.col("size") / 2, F.col("size")).otherwise(F.lit(0)))
    taken = (F.col("epochs") * F.col("size") + F.col("more")).cast("long")
    x = x.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.col("h").alias("text_hash"))
    # Without Hadoop's native library, each file in a folder of the machine starts processes (chmod), and a process that starts counts the
    # executor's memory a second time: as many files as there are cores, or as the rows need, and not one for each partition of the shuffle.
    files = max(docs.sparkSession.sparkContext.defaultParallelism, 1 + rows.count() // FILE_ROWS)
    out = ws.put(x.coalesce(files), "result")
    ws.keep("result")
    return out


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = SEED) -> DataFrame:
    """The rows of the mix: every row of ``docs`` with words, as often as ``mix`` takes it.

    Rows that are taken once more are those up to one key of each source, as no row behind one that does not fit is taken. So texts are not
    shuffled: each row is compared with its source's last key, one row for each source, where it lies. Only if that key's row stands
    several times, these are told out by their number.
    """
    ws = Workspace(docs.sparkSession, "mix")
    x = _ordered(ws.put(measure(docs, seed), "rows"), ws, weights, share, most).where("size > 0")
    # of the n equal rows of a group, so many fit
    fit = F.least(F.col("n"), F.greatest(F.lit(0), F.floor((F.col("rest") - F.col("ahead")) / F.col("size") + 0.5)))
    x = x.withColumn("fit", fit.cast("long"))
    order = F.struct("rank", F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id"), "size", "h")
    last = x.groupBy("source").agg(F.first("epochs").cast("int").alias("epochs"), F.max(F.when(F.col("fit") > 0, F.struct(order.alias("key"), "fit", "n"))).alias("last"))
    last = ws.put(last.select(F.col("source").alias("of"), "epochs", F.col("last.key").alias("last"), F.col("last.fit").alias("fit"), F.col("last.n").alias("n")), "last")
    names = docs.columns
    every = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    met = measured(every, seed).where("size > 0").withColumn("key", order)
    met = met.join(last, F.col("source").eqNullSafe(F.col("of")))
    split = F.coalesce((F.col("key") == F.col("last")) & (F.col("n") > 1), F.lit(False))
    times = F.col("epochs") + F.coalesce((F.col("key") <= F.col("last")).cast("int"), F.lit(0))
    out = met.where(~split).select("row.*", F.explode(F.array_repeat(F.lit(1), times)).alias("_copy")).drop("_copy")
    if not last.where("n > 1").isEmpty():
        many = met.where(split).dropDuplicates(["source", "key"]).withColumn("all", F.col("epochs") * F.col("n") + F.col("fit"))
        many = many.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / COPIES))))
        many = many.withColumn("_copy", F.explode(F.sequence(F.col("lot") * COPIES, F.least(F.col("all"), (F.col("lot") + 1) * COPIES) - 1)))
        out = out.unionByName(many.select("row.*"))
    return out
