"""The record table as versioned Parquet files under a log.

Rows lie in ``buckets`` by a hash of legiscan_id. Every commit writes its rows to a folder of its own and then one log entry, which names the folders of each bucket;
readers take the entry of the highest version that is whole. An entry is created, never replaced, and ends with a mark: a writer that dies leaves at
most an entry without its mark, which no reader takes and whose number no writer uses again. A commit is refused (``Conflict``) if
another one came between its reading and its writing. Appends write only new folders; updates and deletes write only the buckets they touch.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.schema import RECORD

BUCKETS = 64
END = "\n#whole\n"
KEY = "legiscan_id"


class Conflict(RuntimeError):
    """Another commit came first."""


class Snapshots:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.own = uuid.uuid4().hex  # of what this writer stages

    def _fs(self, path: str):
        hp = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hp.getFileSystem(self.spark._jsc.hadoopConfiguration()), hp

    def _entries(self) -> list[int]:
        """Numbers of all log entries, whole or not."""
        fs, hp = self._fs(f"{self.root}/log")
        if not fs.exists(hp):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(hp)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def _entry(self, number: int) -> dict | None:
        fs, hp = self._fs(f"{self.root}/log/v{number}")
        stream = fs.open(hp)
        try:
            text = bytes(stream.readAllBytes()).decode(errors="replace")
        finally:
            stream.close()
        return json.loads(text.removesuffix(END)) if text.endswith(END) else None

    def _last(self) -> tuple[int, dict]:
        """(number, entry) of the highest whole version; 0 before the first commit."""
        for n in reversed(self._entries()):
            if (found := self._entry(n)) is not None:
                return n, found
        return 0, {"buckets": self.buckets, "parts": {}, "done": {}}

    def version(self) -> int:
        """0 before the first commit."""
        return self._last()[0]

    def versions(self) -> list[int]:
        return [n for n in self._entries() if self._entry(n) is not None]

    def _frame(self, parts: dict[str, list[str]]) -> DataFrame:
        paths = [f"{self.root}/data/{p}" for bucket in sorted(parts) for p in parts[bucket]]
        return self.spark.read.schema(RECORD).parquet(*paths) if paths else self.spark.createDataFrame([], RECORD)

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            return self._frame(self._last()[1]["parts"])
        found = self._entry(version) if version in self._entries() else None
        if found is None:
            raise ValueError(f"no version {version}")
        return self._frame(found["parts"])

    def bucket(self, entry: dict | None = None) -> Column:
        """The bucket of a row."""
        return F.pmod(F.xxhash64(F.col(KEY)), F.lit((entry or self._last()[1])["buckets"])).cast("int")

    def _write(self, df: DataFrame, entry: dict) -> dict[str, list[str]]:
        """The folders of each bucket of new rows."""
        name = uuid.uuid4().hex
        df.select(*RECORD.names, self.bucket(entry).alias("_bucket")).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/data/{name}")
        fs, hp = self._fs(f"{self.root}/data/{name}")
        found = [x.getPath().getName() for x in fs.listStatus(hp) if x.isDirectory()]
        return {x.partition("=")[2]: [f"{name}/{x}"] for x in found if x.startswith("_bucket=")}

    def _publish(self, read_at: int, entry: dict) -> int:
        """Create the next log entry; ``Conflict`` if the table is no longer at ``read_at``."""
        if self.version() != read_at:
            raise Conflict(f"version {self.version()} came after version {read_at}")
        number = max([0, *self._entries()]) + 1
        fs, hp = self._fs(f"{self.root}/log/v{number}")
        try:
            out = fs.create(hp, False)
        except Exception as e:
            raise Conflict(f"version {number} is being written") from e
        try:
            out.write(bytearray((json.dumps(entry) + END).encode()))
        finally:
            out.close()
        return number

    def noted(self, path: str) -> str:
        """A small text beside the table, empty if there is none."""
        fs, hp = self._fs(path)
        if not fs.exists(hp):
            return ""
        stream = fs.open(hp)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def note(self, path: str, text: str) -> None:
        fs, hp = self._fs(path)
        out = fs.create(hp, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def done(self, writer: str) -> int:
        """The last batch of ``writer`` that is in the table, -1 if none."""
        return self._last()[1]["done"].get(writer, -1)

    def _commit(self, read_at: int, entry: dict, parts: dict, batch: tuple[str, int] | None) -> int:
        done = entry["done"] | ({batch[0]: batch[1]} if batch else {})
        return self._publish(read_at, {"buckets": entry["buckets"], "parts": {b: p for b, p in parts.items() if p}, "done": done})

    def commit(self, df: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Replace the whole table."""
        number, entry = self._last()
        return self._commit(number, entry, self._write(df, entry), batch)

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Add rows; nothing that is there is read or written."""
        number, entry = self._last()
        new = self._write(df, entry)
        return self._commit(number, entry, {b: entry["parts"].get(b, []) + new.get(b, []) for b in {*entry["parts"], *new}}, batch)

    def _touched(self, df: DataFrame, entry: dict) -> list[str]:
        """Buckets of these rows, as many as there are buckets at most."""
        return [str(r["b"]) for r in df.select(self.bucket(entry).alias("b")).distinct().collect()]

    def rewrite(self, rows: DataFrame, change, new: DataFrame | None = None, batch: tuple[str, int] | None = None) -> int:
        """``change(frame)`` in place of the buckets that ``rows`` (legiscan_id) touch, and ``new`` rows appended, in one version."""
        number, entry = self._last()
        old = {b: entry["parts"][b] for b in self._touched(rows, entry) if b in entry["parts"]}
        parts = {b: p for b, p in entry["parts"].items() if b not in old}
        for more in (self._write(change(self._frame(old)), entry) if old else {}, self._write(new, entry) if new is not None else {}):
            for b, p in more.items():
                parts[b] = parts.get(b, []) + p
        return self._commit(number, entry, parts, batch)

    def delete(self, condition: Column) -> int:
        hit = F.coalesce(condition, F.lit(False))
        return self.rewrite(self.read().where(hit).select(KEY), lambda old: old.where(~hit))

    def compact(self, most: int = 16) -> int | None:
        """Write anew the buckets that lie in more than ``most`` folders."""
        number, entry = self._last()
        many = {b: p for b, p in entry["parts"].items() if len(p) > most}
        if not many:
            return None
        return self._commit(number, entry, {b: p for b, p in entry["parts"].items() if b not in many} | self._write(self._frame(many), entry), None)

    def vacuum(self, versions: int = 10, hours: float = 24.0) -> int:
        """Delete folders that none of the last ``versions`` names and that are older than ``hours``, so that no writer is at them; how many they were. Older versions
        can't be read any more."""
        kept = {p.partition("/")[0] for n in self.versions()[-versions:] for paths in self._entry(n)["parts"].values() for p in paths}
        fs, hp = self._fs(f"{self.root}/data")
        if not fs.exists(hp):
            return 0
        limit, gone = (time.time() - hours * 3600) * 1000, 0
        for x in fs.listStatus(hp):
            if x.getPath().getName() not in kept and x.getModificationTime() < limit:
                gone += bool(fs.delete(x.getPath(), True))
        return gone

    def stage(self, df: DataFrame) -> DataFrame:
        """``df`` written once beside the table, for plans that read it several times; ``unstage`` deletes all that this writer has staged."""
        path = f"{self.root}/staged/{self.own}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def unstage(self) -> None:
        fs, hp = self._fs(f"{self.root}/staged/{self.own}")
        fs.delete(hp, True)

    def quarantine(self, bad: DataFrame, run: str) -> None:
        """Keep rejected rows with their reason; a run that is repeated replaces its own."""
        bad.write.mode("overwrite").json(f"{self.root}/quarantine/run={run}")

    def rejected(self) -> DataFrame:
        """All quarantined rows (run, reject_reason, bill_id, ...)."""
        fs, hp = self._fs(f"{self.root}/quarantine")
        if not fs.exists(hp):
            return self.spark.createDataFrame([], "run string, bill_id bigint, reject_reason string")
        return self.spark.read.schema("bill_id bigint, external_id string, title string, reject_reason string, run string").json(f"{self.root}/quarantine")
