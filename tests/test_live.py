"""The command line over a local service and over recorded answers."""

import json

import pytest

from tests.service import Service
from tidemark import cli
from tidemark.sources import api
from tidemark.sources.session import Settings, session, settings
from tidemark.sources.state import Snapshots


def bill(i, **kw):
    return {"bill_id": i, "state": "CA", "bill_number": f"AB{i}", "title": f"Title {i} " * 10, "year": 2024, "status_date": "2024-03-01", "status": 1, "change_hash": f"h{i}", "session": {"session_id": 7}} | kw


BILLS = {1: bill(1), 2: bill(2), 3: bill(3, state=None), 5: bill(5, status_date="2023-01-01"), 424242: bill(424242, state="IL", bill_number="SB3890")}


def answer(op, params):
    ok = {"status": "OK"}
    if op == "getSearchRaw":
        rows = [{"bill_id": i, "relevance": 90 - i} for i in (1, 2, 3, 4, 5, 6)] + [{"bill_id": "x", "relevance": 99}]
        return ok | {"searchresult": {"summary": {"count": 7, "relevancy": "99%"}, "results": rows}}
    if op == "getSearch":
        entry = {"state": "IL", "bill_number": "SB3890", "bill_id": 424242}
        return ok | {"searchresult": {"summary": {"count": 1}, "0": entry, "1": entry | {"bill_number": "SB38901"}}}
    if op == "getMasterListRaw":
        return ok | {"masterlist": {"session": {"session_id": 7}, "0": {"bill_id": 1, "change_hash": "new"}, "1": {"bill_id": 2, "change_hash": "h2"}}}
    i = int(params["id"])
    if i == 4:
        return {"status": "ERROR", "alert": {"message": "no such bill"}}
    return 500 if i == 6 else ok | ({"bill": BILLS[i]} if i in BILLS else {})


@pytest.fixture
def live(spark, tmp_path, monkeypatch):
    """run(*arguments) -> exit code, over a service and a new table."""
    monkeypatch.setenv("LEGISCAN_API_KEY", "k")
    settings.cache_clear()
    root = f"file://{tmp_path}/bills"
    with Service(answer) as service:
        yield lambda *a: cli.main([*a, "--base", service.base, "--root", root]), service, Snapshots(spark, root)
    settings.cache_clear()


def test_ingest(live, capsys):
    run, service, table = live
    assert run("--dry-run", "--limit", "2") == 0 and table.version() == 0
    out, err = capsys.readouterr()
    assert out == "2\n" and "found: 7" in err and "requests: 3" in err
    titles = [x for x in err.splitlines() if x.startswith("CA AB")]
    assert len(titles) == 2 and all(len(x.partition(": ")[2]) == 60 for x in titles)
    assert service.asked[0]["key"] == "k" and service.asked[0]["state"] == "ALL" and "NEAR" in service.asked[0]["query"]

    assert run() == 0
    out, err = capsys.readouterr()
    assert out == "3\n" and "rejected: 3" in err and "requests: 6" in err  # one answer had an HTTP error
    assert sorted(r["legiscan_id"] for r in table.read().collect()) == [1, 2, 5]
    bad = {r["bill_id"]: r["reject_reason"] for r in table.rejected().collect()}
    assert bad[3] == "null state" and bad[4] == "not fetched: ApiError: no such bill" and bad[6].startswith("not fetched: HTTPError")

    assert run("--since", "2024-01-01") == 0  # all that can be stored is stored
    assert capsys.readouterr().out == "0\n"
    assert {int(x["id"]) for x in service.asked[-3:]} == {3, 4, 6}


def test_single_records(live, capsys):
    run, _, table = live
    assert run("--legiscan-url", "https://legiscan.com/il/bill/SB3890/2025") == 0
    assert run("--legiscan-url", "https://legiscan.com/CA/bill/2") == 0 and run("--legiscan-id", "1") == 0
    assert run("--legiscan-id", "1", "--dry-run") == 0  # known: nothing new; a dry run makes no difference here
    assert capsys.readouterr().out == "1\n1\n1\n0\n"
    assert sorted(r["legiscan_id"] for r in table.read().collect()) == [1, 2, 424242]
    for bad in (["--legiscan-id", "0"], ["--legiscan-id", "3"], ["--legiscan-id", "4"], ["--legiscan-url", "https://example.com/x"], ["--legiscan-url", ""]):
        assert run(*bad) == 1
    assert table.version() == 4


def test_sync_and_backfill(live, capsys, monkeypatch):
    run, service, table = live
    assert run("--limit", "2") == 0
    monkeypatch.setitem(BILLS, 1, bill(1, title="Changed", change_hash="new"))
    asked = len(service.asked)
    assert run("--sync", "--dry-run") == 0 and len(service.asked) == asked + 1
    assert run("--sync") == 0
    assert {r["legiscan_id"]: r["title"] for r in table.read().collect()}[1] == "Changed"
    assert run("--sync") == 0
    from pyspark.sql import functions as F

    table.commit(table.read().withColumn("legiscan_session_id", F.lit(None).cast("bigint")))
    assert run("--backfill", "--dry-run") == 0 and run("--backfill") == 0
    assert capsys.readouterr().out == "2\n1\n1\n0\n2\n2\n"
    assert {r["legiscan_session_id"] for r in table.read().collect()} == {7}


def test_recorded_answers(spark, tmp_path, capsys, monkeypatch):
    rows = [{"operation": "getSearchRaw", "body": json.dumps(answer("getSearchRaw", {}))}] + [{"operation": "getBill", "id": i, "body": json.dumps({"status": "OK", "bill": b})} for i, b in BILLS.items()]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    monkeypatch.setenv("STATE_ROOT", f"file://{tmp_path}/t")
    settings.cache_clear()
    assert cli.main(["--answers", f"file://{tmp_path}/a.jsonl", "--min-relevance", "88"]) == 0
    assert capsys.readouterr().out == "2\n"


def test_missing_arguments(monkeypatch, tmp_path, capsys):
    monkeypatch.chdir(tmp_path)
    for name in ("LEGISCAN_API_KEY", "STATE_ROOT", "legiscan_api_key", "state_root"):
        monkeypatch.delenv(name, raising=False)
    settings.cache_clear()
    assert cli.main([]) == 1 and cli.main(["--root", str(tmp_path)]) == 1
    assert "LEGISCAN_API_KEY" in capsys.readouterr().err
    settings.cache_clear()


def test_settings(spark, tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# note\nlegiscan_api_key = 'from file'\nLOG_LEVEL=debug\nOTHER=1\nbroken\n")
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("LEGISCAN_API_KEY", raising=False)
    monkeypatch.setenv("log_level", "WARNING")
    found = Settings.load()
    assert (found.legiscan_api_key, found.log_level, found.state_root) == ("from file", "WARNING", None)
    assert Settings.load({"Legiscan_Api_Key": "k"}).legiscan_api_key == "k"
    settings.cache_clear()
    assert settings() is settings() and session() is session()
    settings.cache_clear()


def test_reader_and_texts(spark):
    with Service(lambda op, p: {"status": "OK", "text": {"doc_id": 5, "mime": "m", "doc": "ZG9j"}, "state": p.get("state")}) as service:
        df = api.read(spark, "getBillText", "k", service.base, state="CA")
        assert json.loads(df.first()["body"])["state"] == "CA" and service.asked[0] == {"key": "k", "op": "getBillText", "state": "CA"}
        ids = spark.createDataFrame([(1,), (2,), (1,), (None,)], "id long")
        rows = api.text_rows(api.fetch(ids, "getBillText", "k", service.base)).collect()
        assert sorted((r["id"], r["text_id"], r["mime"]) for r in rows) == [(1, 5, "m"), (2, 5, "m")]
        client = api.Client("k", service.base)
        assert client.text(3)["doc"] == "ZG9j" and client.document(3) == {} and client.requests == 2
