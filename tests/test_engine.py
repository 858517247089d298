import json
import random
from datetime import datetime
from urllib.error import HTTPError

import pytest
from pyspark.sql import functions as F

from pyspark.sql.types import IntegerType, StructField, StructType

from tests.service import Service
from tidemark.operators import relops as R
from tidemark.operators import upsert as U
from tidemark.plans import pipelines as P
from tidemark.plans.schema import RECORD
from tidemark.sources import api
from tidemark.sources.state import Snapshots

TS = datetime(2024, 6, 1)
NAMES = RECORD.names


def record(**kw):
    return tuple(kw.get(n) for n in NAMES)


def simulate(target, batch):
    """A row-by-row store."""
    rows, inserted = [dict(x) for x in target], 0
    for b in batch:
        hit = next((r for r in rows if b["legiscan_id"] is not None and r["legiscan_id"] == b["legiscan_id"]), None)
        if hit is None and b["external_id"]:
            hit = next((r for r in rows if r["external_id"] == b["external_id"]), None)
        if hit is None:
            rows.append(dict(b))
            inserted += 1
            continue
        for c in ("bill_status", "change_hash", "legiscan_session_id"):
            if b[c] is not None:
                hit[c] = b[c]
        if b["external_id"]:
            hit["external_id"] = b["external_id"]
    return rows, inserted


@pytest.mark.parametrize("seed", range(4))
def test_store_equals_row_by_row(spark, seed):
    rnd = random.Random(seed)
    target = [{"id": f"t{i:02}", "external_id": f"CA AB{i} {i}", "legiscan_id": i if rnd.random() < 0.6 else None, "bill_status": "Old", "change_hash": f"h{i}", "legiscan_session_id": None} for i in range(20)]
    batch = []
    for _ in range(60):
        i = rnd.randrange(35)
        batch.append({"external_id": rnd.choice([f"CA AB{i} {i}", f"CA AB{i}x {i}", str(i)]), "legiscan_id": i, "bill_status": rnd.choice([None, "New", "Passed"]), "change_hash": rnd.choice([None, "a", "b"]), "legiscan_session_id": rnd.choice([None, 1, 2])})
    want, inserted = simulate(target, batch)
    tdf = spark.createDataFrame([record(**x) for x in target], RECORD)
    bdf = spark.createDataFrame([(*record(**x), i) for i, x in enumerate(batch)], StructType([*RECORD.fields, StructField("ord", IntegerType())]))
    plan = U.plan_store(bdf, tdf)
    assert plan.where("action = 'INSERT'").count() == inserted
    got = U.apply_store(tdf, plan, F.lit(TS)).collect()
    key = lambda r: tuple(str(r[c]) for c in ("legiscan_id", "external_id", "bill_status", "change_hash", "legiscan_session_id"))
    assert sorted(map(key, got)) == sorted(map(key, want))


def answers():
    def doc(i, **kw):
        return {"bill_id": i, "state": "CA", "bill_number": f"AB{i}", "title": f"Title {i}", "year": 2024, "status_date": "2024-03-01", "status": 1, "change_hash": f"h{i}", "session": {"session_id": 7}} | kw

    return {1: doc(1), 2: doc(2), 3: doc(3, status_date="2023-01-01"), 4: doc(4, state=None)}


def frames(spark, docs):
    search = {"status": "OK", "searchresult": {"summary": {"count": 5, "relevancy": "100%"}, "results": [{"bill_id": 1, "relevance": 90}, {"bill_id": "2", "relevance": 88}, {"bill_id": 3, "relevance": 75}, {"relevance": 99}, {"bill_id": "x"}, {"bill_id": 4, "relevance": 80}]}}
    raw = spark.createDataFrame([(json.dumps(search),)], "body string")
    return api.search_rows(raw), spark.createDataFrame([(i, json.dumps(d)) for i, d in docs.items()], "bill_id long, doc string"), raw


def test_search(spark):
    rows, _, raw = frames(spark, answers())
    assert [r["bill_id"] for r in R.min_relevance(rows, 85).orderBy("ord").collect()] == ["1", "2", None]
    assert api.search_summary(raw).first()["count"] == 5
    assert sorted(r["bill_id"] for r in R.valid_ids(rows).collect()) == [1, 2, 3, 4]


def test_ingest_sync_backfill(spark, tmp_path):
    state = Snapshots(spark, f"file://{tmp_path}/bills")
    search, docs, _ = frames(spark, answers())
    assert P.ingest(search, docs, state, TS, P.IngestOptions(dry_run=True)).count == 3 and state.version() == 0
    first = P.ingest(search, docs, state, TS, P.IngestOptions(limit=2))
    assert (first.count, state.version()) == (2, 1)
    second = P.ingest(search, docs, state, TS)
    assert (second.count, second.rejected) == (1, 1)
    assert P.ingest(search, docs, state, TS).count == 0
    assert {r["external_id"] for r in state.read().collect()} == {"CA AB1 2024-03-01 1", "CA AB2 2024-03-01 2", "CA AB3 2023-01-01 3"}
    new = answers()
    new[1] |= {"change_hash": "z", "title": "New"}
    _, docs2, _ = frames(spark, new)
    lists = spark.createDataFrame([(7, json.dumps({"masterlist": {"session": {"session_id": 7}, "0": {"bill_id": 1, "change_hash": "z"}, "1": {"bill_id": "2", "change_hash": "h2"}, "2": {"bill_id": 9, "change_hash": "q"}, "3": 5}}))], "session_id long, body string")
    assert P.sync(api.master_rows(lists), docs2, state, TS, dry_run=True).count == 1
    assert P.sync(api.master_rows(lists), docs2, state, TS).count == 1
    assert {r["title"] for r in state.read().where("legiscan_id = 1").collect()} == {"New"}
    state.commit(state.read().withColumn("legiscan_session_id", F.when(F.col("legiscan_id") != 2, F.col("legiscan_session_id"))))
    assert P.backfill(docs2, state, TS).count == 1
    assert state.read().where("legiscan_session_id is null").count() == 0
    state.delete(F.col("legiscan_id") == 3)
    assert state.read().count() == 2 and state.read(1).count() == 2
    assert P.store_one(docs2, 3, state, TS).count == 1
    with pytest.raises(RuntimeError):
        P.store_one(docs2, 99, state, TS)
    with pytest.raises(ValueError):
        P.store_one(docs2, 4, state, TS)


def test_resolve(spark):
    def found(*items):
        body = {"status": "OK", "searchresult": {"summary": {"count": 1}} | {str(i): x for i, x in enumerate(items)}}
        return api.resolve_key(spark.createDataFrame([(json.dumps(body),)], "body string"), "IL", "sb3890")

    a = {"state": "il", "bill_number": "SB3890", "bill_id": 424242}
    assert P.resolve_one(found(a, a | {"bill_number": "SB1"})) == 424242
    for bad in ((), (a, a), (a | {"bill_id": "x"},)):
        with pytest.raises(ValueError):
            P.resolve_one(found(*bad))


def test_client():
    slept, calls = [], []

    def fetch(url, timeout):
        calls.append(url)
        if len(calls) == 1:
            raise HTTPError(url, 429, "slow down", None, None)
        return json.dumps({"status": "OK", "bill": {"bill_id": 1}} if "id=1" in url else {"status": "ERROR", "alert": {"message": "no"}})

    c = api.Client("k", fetch=fetch, sleep=slept.append, clock=lambda: 0.0)
    assert c.document(1) == {"bill_id": 1} and slept == [60]
    with pytest.raises(api.ApiError, match="no"):
        c.document(2)
    assert c.requests == 2 and slept == [60, 0.1]
    with pytest.raises(ValueError):
        api.Client("")


def test_data_source(spark):
    with Service(lambda op, params: {"status": "OK", "bill": {"bill_id": int(params["id"])}}) as service:
        api.register(spark)
        df = spark.read.format("record_api").option("operation", "getBill").option("ids", "1,2").option("key", "k").option("base", service.base).load()
        assert sorted(r["id"] for r in df.collect()) == [1, 2]


def test_null_keys_and_ties(spark):
    df = spark.createDataFrame([(i, i if i % 3 else None, f"e{i}" if i % 2 else None) for i in range(60)], "ord int, legiscan_id long, external_id string")
    target = spark.createDataFrame([record(id=f"a{i}", legiscan_id=i if i % 4 else None, external_id=f"e{i}" if i % 5 else "") for i in range(60)] + [record(id="z", legiscan_id=1, external_id="e1")], RECORD)
    got = {r["ord"]: (r["id_l"], r["id_e"]) for r in R.two_key_match(df, target).collect()}
    assert got == {i: (f"a{i}" if i % 3 and i % 4 else None, f"a{i}" if i % 2 and i % 5 else None) for i in range(60)}


def test_places_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGES", 5)
    rows = [(None if i % 7 == 0 else i % 13, i) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(4)
    want = {i: n for n, (_, i) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1])))}
    assert {r["i"]: r["ord"] for r in R.with_ordinal(df, "k", "i").collect()} == want
    assert R.with_ordinal(df.limit(0), "k").count() == 0
    assert [R.first_rows(df, n, "k", "i").count() for n in (None, 0, 7, -7, -200)] == [100, 0, 7, 93, 0]


def test_stream(spark, tmp_path):
    from tidemark.streaming.upsert_stream import store_stream

    src = str(tmp_path / "in")
    spark.createDataFrame([(i, json.dumps(d)) for i, d in answers().items()], "ord int, doc string").write.parquet(src)
    state = Snapshots(spark, f"file://{tmp_path}/bills")
    store_stream(spark.readStream.schema("ord int, doc string").parquet(src), state, str(tmp_path / "cp"), TS).awaitTermination()
    assert state.read().count() == 3


def test_limits(spark):
    df = spark.range(10).withColumnRenamed("id", "ord")
    assert [R.prefix_limit(df, n).count() for n in (None, 3, 0, -4, 20, -20)] == [10, 3, 0, 6, 10, 0]
    x = R.with_ordinal(spark.createDataFrame([(3,), (1,)], "k int"), "k")
    assert sorted(map(tuple, x.collect())) == [(1, 0), (3, 1)]


def test_cli_arguments():
    from tidemark.cli import arguments

    a = arguments(["--limit", "5", "--since", "2024-01-01", "--full"])
    assert a.limit == 5 and a.full and a.use_raw
    with pytest.raises(SystemExit):
        arguments(["--legiscan-url", "u", "--legiscan-id", "1"])
