"""Shared pieces of the training-data operators: shared-folder tables, Arrow text access, and merged arrays of fixed size."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
FAN_IN = 64
FILE_ROWS = 200_000
MAYBE_BITS = 24
CHUNK = 1 << 16


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or with a local master a local one where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give executors this package, once for each Spark context, so that they need no copy of it. Arrow batches hold ``BATCH_BYTES``, unless the session says
    otherwise, so that the memory of an executor and its workers does not depend on the length of texts in a row of thousands."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(path))
    sc._tidemark_shipped = True


class Workspace:
    """Tables of one query in the shared folder; a written table cuts lineage and survives lost executors. What a query does not drop itself, as
    its result reads it, goes when the session's JVM ends."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        self.puts = 0
        fs, hp = self._fs(self.root)
        fs.mkdirs(hp)
        fs.deleteOnExit(hp)

    def _fs(self, path: str):
        hp = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hp.getFileSystem(self.spark._jsc.hadoopConfiguration()), hp

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write ``df`` as Parquet and read it back; if it is known to have no more than ``rows`` rows, in no more files than these need."""
        path = self.path(name)
        if rows is not None:
            df = df.coalesce(1 + rows // FILE_ROWS)
        self.names.add(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.puts += 1
        if self.puts % 4 == 0:
            give_back_driver(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        self.names -= set(names)
        for n in names:
            fs, hp = self._fs(self.path(n))
            fs.delete(hp, True)

    def keep(self, *names: str) -> None:
        """Delete all other tables written here."""
        self.drop(*(self.names - set(names)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def blocks(off: np.ndarray, limit: int = 1 << 20):
    """Row ranges [a, b) whose texts hold about ``limit`` bytes; a longer text is a range of its own."""
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


#: What a worker keeps from task to task, by the kind of task that uses it.
CACHES: dict[str, dict] = {}


def trimmed(run: Callable, keeps: str = "") -> Callable:
    """``run`` over a task's batches; then the worker, which other tasks use again, gives free memory back to the machine. It ``keeps`` one kind of
    cache, those of others go."""

    def task(batches):
        forget(keeps)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def forget(keeps: str) -> None:
    for kind, cache in CACHES.items():
        if kind != keeps:
            cache.clear()


def rest(spark: SparkSession) -> None:
    """Between the stages of a long run: each executor collects its garbage once and gives free heap back, of which its Python workers need some."""
    give_back_driver(spark)
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()


def give_back_driver(spark: SparkSession) -> None:
    """Free memory of the driver, of its Python and of the native heap that its JVM's many short-lived threads leave, goes back to the machine."""
    give_back()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    try:
        of = jvm.java.lang.Class.forName
        kinds, args = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = of(name)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        of("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, args)
    except Py4JError:  # a JVM without this command
        pass


def give_back() -> None:
    """Free memory of this process goes back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def merged(rows: DataFrame, fill: Callable, size: int, dtype, combine: Callable) -> np.ndarray:
    """One array of ``size`` numbers over all rows: each task's ``fill(batches)`` gives its own, ``combine(a, b)`` puts two together.

    Parts of ``CHUNK`` numbers are merged in levels, ``FAN_IN`` at most in a group, whatever the number of tasks; parts of zeros are not sent.
    """

    def first(batches):
        own = np.ascontiguousarray(fill(batches), dtype).reshape(-1, min(CHUNK, size))
        live = [i for i in range(len(own)) if own[i].any()]
        part = TaskContext.get().partitionId()
        yield _parts(live, [part] * len(live), [own[i] for i in live])

    def level(key, table):
        out = None
        for x in table.column("blob"):
            y = np.frombuffer(zlib.decompress(x.as_buffer()), dtype)
            out = y.copy() if out is None else combine(out, y)
        return pa.Table.from_batches([_parts([key[0].as_py()], [key[1].as_py()], [out])])

    kind = "chunk int, part int, blob binary"
    tasks = max(1, rows.rdd.getNumPartitions())
    found = rows.mapInArrow(trimmed(first), kind)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        found = found.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("chunk", "part").applyInArrow(level, kind)
    out = np.zeros(size, dtype)
    each = out.reshape(-1, min(CHUNK, size))
    for r in found.select("chunk", "blob").collect():  # size numbers at most
        each[r["chunk"]] = combine(each[r["chunk"]], np.frombuffer(zlib.decompress(bytes(r["blob"])), dtype))
    return out


def _parts(chunks: list[int], parts: list[int], arrays: list[np.ndarray]) -> pa.RecordBatch:
    blobs = [zlib.compress(x.tobytes(), 1) for x in arrays]
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "part", "blob"])


def hash_bitmap(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Packed bits of a column's 64-bit hashes: 2**bits of them by their highest bits, whatever the number of rows."""

    def fill(batches):
        found = np.zeros(1 << bits, bool)
        for batch in batches:
            found[(np.asarray(batch.column(0)).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)] = True
        return np.packbits(found, bitorder="little")

    return merged(rows.select(column), fill, 1 << (bits - 3), np.uint8, np.bitwise_or)


def in_bitmap(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    spot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return ((bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1).astype(bool)


def marked(docs: DataFrame, docs_key: Callable, some: DataFrame, some_key: Callable) -> DataFrame:
    """``docs`` with ``_maybe``: false only if the row's key is not in ``some``. ``docs_key()`` and ``some_key()`` give the key's columns.

    What is broadcast is a bitmap of the keys, of 2**MAYBE_BITS bits whatever their number. Built-in column expressions only.
    """
    place = lambda cols: F.shiftrightunsigned(F.xxhash64(*cols), 64 - MAYBE_BITS)
    bit = some.select(place(some_key()).alias("p")).select(F.shiftright("p", 15).alias("_bucket"), F.col("p").bitwiseAND(32767).alias("bit"))
    bitmap = bit.groupBy("_bucket").agg(F.bitmap_construct_agg("bit").alias("_bits"))  # 2**(MAYBE_BITS - 15) rows of 4 KB at most
    at = docs.withColumn("_place", place(docs_key())).join(F.broadcast(bitmap), F.shiftright("_place", 15) == F.col("_bucket"), "left")
    low = F.col("_place").bitwiseAND(32767).cast("int")
    byte = F.ascii(F.decode(F.substring("_bits", F.shiftright(low, 3) + 1, F.lit(1)), "ISO-8859-1"))
    maybe = F.coalesce(F.col("_bits").isNotNull() & (F.getbit(byte.cast("long"), low.bitwiseAND(7)) == 1), F.lit(False))
    return at.withColumn("_maybe", maybe).select(*docs.columns, "_maybe")


def without(docs: DataFrame, docs_key: Callable, gone: DataFrame, gone_key: Callable) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``gone``, null-safe. Only rows that a bitmap does not clear are shuffled for the exact join, so that
    most texts stay where they are."""
    names = docs.columns
    all_ = marked(docs, docs_key, gone, gone_key)
    keys = gone.select(*[c.alias(f"_k{i}") for i, c in enumerate(gone_key())]).distinct()
    same = F.lit(True)
    for i, c in enumerate(docs_key()):
        same = same & c.eqNullSafe(F.col(f"_k{i}"))
    return all_.where("not _maybe").select(*names).unionByName(all_.where("_maybe").join(keys, same, "left_anti").select(*names))
