"""The record table: what a writer that dies, or comes second, leaves behind."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans.schema import RECORD
from tidemark.sources.state import END, Conflict, Snapshots


def rows(spark, *ids, title="t"):
    return spark.createDataFrame([tuple(i if n == "legiscan_id" else f"{title}{i}" if n == "title" else None for n in RECORD.names) for i in ids], RECORD)


def ids(table, version=None):
    return sorted((r["legiscan_id"] if r["legiscan_id"] is not None else -1) for r in table.read(version).collect())


@pytest.fixture
def table(spark, tmp_path):
    return Snapshots(spark, f"file://{tmp_path}/t", buckets=4)


def folders(table):
    return {b: set(p) for b, p in table._last()[1]["parts"].items()}


def test_versions(spark, table):
    assert table.version() == 0 and ids(table) == []
    assert table.commit(rows(spark, 1, 2, 3, None)) == 1
    before = folders(table)
    assert table.append(rows(spark, 4, 5)) == 2 and ids(table) == [-1, 1, 2, 3, 4, 5] and ids(table, 1) == [-1, 1, 2, 3]
    after = folders(table)
    assert all(before[b] <= after[b] for b in before)  # an append writes nothing anew
    assert table.delete(F.col("legiscan_id") == 2) == 3 and ids(table) == [-1, 1, 3, 4, 5]
    assert sum(folders(table).get(b) != after[b] for b in after) == 1  # a delete writes its bucket only
    assert table.delete(F.col("legiscan_id") == 99) == 4 and ids(table) == [-1, 1, 3, 4, 5]
    assert table.versions() == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        table.read(9)


def test_rewrite_touches_its_buckets(spark, table):
    table.commit(rows(spark, *range(40)))
    before = folders(table)
    patch = rows(spark, 7).select("legiscan_id")
    table.rewrite(patch, lambda old: old.withColumn("title", F.when(F.col("legiscan_id") == 7, "new").otherwise(F.col("title"))), rows(spark, 100))
    assert {r["title"] for r in table.read().where("legiscan_id = 7").collect()} == {"new"} and ids(table) == [*range(40), 100]
    assert sum(not before[b] <= folders(table)[b] for b in before) == 1


def test_writer_dies_before_its_entry(spark, table, monkeypatch):
    table.commit(rows(spark, 1))
    for step in ("_write", "_publish"):
        with monkeypatch.context() as m:
            m.setattr(table, step, lambda *a: (_ for _ in ()).throw(OSError("gone")))
            for act in (lambda: table.commit(rows(spark, 2)), lambda: table.append(rows(spark, 2)), lambda: table.delete(F.lit(True))):
                with pytest.raises(OSError):
                    act()
        assert table.version() == 1 and ids(table) == [1]
    assert table.append(rows(spark, 3)) == 2 and ids(table) == [1, 3]


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_writer_dies_within_its_entry(spark, table, tmp_path, share):
    table.commit(rows(spark, 1))
    whole = json.dumps({"buckets": 4, "parts": {}, "done": {}}) + END
    part = whole[: int(len(whole) * share)] if share < 1 else whole[:-1]
    (tmp_path / "t" / "log" / "v2").write_text(part)
    assert table.version() == 1 and ids(table) == [1]
    assert table.append(rows(spark, 2)) == 3 and ids(table) == [1, 2] and ids(table, 1) == [1]
    assert (tmp_path / "t" / "log" / "v2").read_text() == part and table.versions() == [1, 3]


def test_second_writer_is_refused(spark, table):
    table.commit(rows(spark, 1))
    other = Snapshots(spark, table.root)
    stale = table._last()
    other.append(rows(spark, 2))
    table._last = lambda real=table._last, first=[stale]: first.pop() if first else real()
    with pytest.raises(Conflict):
        table.append(rows(spark, 3))
    assert ids(other) == [1, 2] and other.buckets == 64 and other._last()[1]["buckets"] == 4


def test_compact(spark, table):
    for i in range(6):
        table.append(rows(spark, *range(i * 8, i * 8 + 8)))
    assert table.compact(10) is None
    table.compact(2)
    assert ids(table) == [*range(48)] and all(len(p) == 1 for p in folders(table).values())


def test_vacuum(spark, table, monkeypatch):
    for i in range(4):
        table.commit(rows(spark, i))
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.append(rows(spark, 9))
    assert table.vacuum(2) == 0  # all of it is young
    assert table.vacuum(2, hours=-1) == 3 and ids(table) == [3] and ids(table, 3) == [2]
    assert table.vacuum(2, hours=-1) == 0 and Snapshots(spark, table.root + "none").vacuum() == 0


def test_stream_repeats_nothing(spark, tmp_path):
    from tidemark.streaming.upsert_stream import _time_of, store_stream

    doc = lambda i, **kw: json.dumps({"bill_id": i, "state": "CA", "bill_number": f"AB{i}", "title": "T", "year": 2024} | kw)
    src = str(tmp_path / "in")
    spark.createDataFrame([(i, doc(i)) for i in range(5)] + [(9, doc(9, title=None))], "ord int, doc string").coalesce(1).write.parquet(src)
    table = Snapshots(spark, f"file://{tmp_path}/bills")
    stream = lambda cp: store_stream(spark.readStream.schema("ord int, doc string").parquet(src), table, str(tmp_path / cp)).awaitTermination()
    stream("cp")
    first = {(r["id"], r["created_at"]) for r in table.read().collect()}
    assert len(first) == 5 and [r["reject_reason"] for r in table.rejected().collect()] == ["null title"]
    version = table.version()
    stream("lost")  # the checkpoint is lost, so the batch comes again
    assert table.version() == version and {(r["id"], r["created_at"]) for r in table.read().collect()} == first
    assert _time_of(table, "stream", 0) == _time_of(table, "stream", 0) <= datetime.now().astimezone()
    assert not os.path.exists(tmp_path / "bills" / "staged" / table.own)
