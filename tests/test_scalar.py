import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import near as N
from tidemark.functions import scalar as X
from tidemark.plans.parse import parse_documents, split_rejected


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_urls(spark):
    rows = [
        ("https://legiscan.com/CA/bill/123456", 123456, None),
        ("https://legiscan.com/CA/bill/123456/2023", 123456, ("CA", "123456", 2023)),
        ("https://example.com/CA/bill/123456", None, None),
        ("https://legiscan.com/CA/bill/notanid", None, None),
        ("https://legiscan.com/il/bill/SB3890/2025", None, ("IL", "SB3890", 2025)),
        ("https://legiscan.com/IL/not-a-bill-url", None, None),
        ("https://legiscan.com/IL/bill/SB3890/notayear", None, None),
    ]
    got = values(spark, [(r[0],) for r in rows], "u string", X.url_id(F.col("u")), X.url_parts(F.col("u")))
    assert [(a, tuple(b) if b else None) for a, b in got] == [r[1:] for r in rows]


def test_body(spark):
    rows = [("House", "HB123", "house"), ("HOUSE", "", "house"), ("", "HB123", "house"), ("", "HR456", "house"), ("", "H123", "house"), ("Senate", "SB123", "senate"), ("SENATE", "", "senate"), ("", "S456", "senate"), ("Assembly", "AB123", "assembly"), ("", "A789", "assembly"), ("Unknown", "XYZ123", "house"), (None, None, "house")]
    assert [x[0] for x in values(spark, [r[:2] for r in rows], "c string, n string", X.body_of(F.col("c"), F.col("n")))] == [r[2] for r in rows]


def test_status(spark):
    rows = [("1", "Introduced"), ("6", "Failed"), ('"Passed"', "Passed"), ('"4"', "4"), ("null", None), ("99", None), ('""', None), ("true", "Introduced"), ("false", None), ("1.5", None), ("[1]", None)]
    got = values(spark, [('{"status": %s}' % r[0],) for r in rows], "j string", X.status_of(F.parse_json("j")))
    assert [x[0] for x in got] == [r[1] for r in rows]


def test_days_and_numbers(spark):
    rows = [("2024-01-15", date(2024, 1, 15)), ("2024-1-5", date(2024, 1, 5)), (" 2024-01-15", None), ("2024-01-15T00:00", None), ("24-01-15", None), ("2024-13-01", None), ("bad", None), (None, None)]
    assert [x[0] for x in values(spark, [(r[0],) for r in rows], "s string", X.parse_day(F.col("s")))] == [r[1] for r in rows]
    rows = [("12", 12), (" 7 ", 7), ("-3", -3), ("12.7", None), ("1e3", None), ("", None), (None, None), ("99999999999999999999", None)]
    assert [x[0] for x in values(spark, [(r[0],) for r in rows], "s string", X.whole_number(F.col("s")))] == [r[1] for r in rows]
    assert X.since_day(" 2024-01-02 ") == date(2024, 1, 2) and X.since_day("2024-01-02T03:00:00Z") == date(2024, 1, 2)
    with pytest.raises(ValueError):
        X.since_day("soon")


def parsed(spark, *docs):
    rows = spark.createDataFrame([(i, d if isinstance(d, (str, type(None))) else json.dumps(d)) for i, d in enumerate(docs)], "ord int, doc string")
    return parse_documents(rows, F.lit(datetime(2024, 6, 1)))


FULL = {"bill_id": 123456, "state": "ca", "bill_number": "AB123", "title": "T", "description": "D", "year": 2024, "chamber": "Assembly", "status_date": "2024-01-15", "status": 1, "url": "u", "session": {"session_id": 5, "session_title": "2023-2024 Regular Session"}, "history": [{"date": "2024-02-20"}], "change_hash": "h"}


def test_parse(spark):
    cases = [FULL, {"bill_id": 999999, "state": "NY", "bill_number": "SB100", "year": 2024}, FULL | {"year": None}, {"bill_id": 1}, FULL | {"status_date": None}, FULL | {"status_date": "invalid-date-format", "history": []}]
    r = parsed(spark, *cases).orderBy("ord").collect()
    assert (r[0]["external_id"], r[0]["body"], r[0]["version_date"], r[0]["bill_status"], r[0]["state"]) == ("CA AB123 2024-01-15 123456", "assembly", date(2024, 1, 15), "Introduced", "CA")
    assert (r[0]["legiscan_session_id"], r[0]["summary"], r[0]["url"], r[0]["change_hash"]) == (5, "D", "u", "h")
    assert (r[1]["external_id"], r[1]["version_date"], r[1]["summary"], r[1]["body"]) == ("999999", None, None, "senate")
    assert r[1]["url"] == "https://legiscan.com/NY/bill/999999"
    assert r[2]["year"] == 2023 and r[3]["year"] == 2024
    assert r[4]["version_date"] == date(2024, 2, 20) and r[5]["version_date"] is None
    assert all(x["reject_reason"] is None for x in r)


def test_rejects(spark):
    cases = [FULL | {"state": None}, FULL | {"session": None}, FULL | {"title": None}, FULL | {"bill_number": None}, FULL | {"year": 0, "session": {"session_title": None}}, "not json", "[1]", None]
    x = parsed(spark, *cases, FULL | {"session": {"session_title": None}})
    good, bad = split_rejected(x)
    assert bad.count() == len(cases) and [r["ord"] for r in good.collect()] == [len(cases)]


def test_near(spark):
    assert len(N.parse_query(N.STANDING_QUERY)) == 48
    assert [sum(len(c) == n for c in N.parse_query(N.STANDING_QUERY)) for n in (1, 2, 3)] == [7, 29, 12]
    rows = [("the Machine can be learning", True), ("learning by machines", True), ("machine " + "x " * 11 + "learning", False), ("ChatGPTs", True), ("an artificially made intelligence", True), ("nothing", False), (None, False)]
    got = values(spark, [(r[0],) for r in rows], "s string", N.near(F.col("s"), N.STANDING_QUERY))
    assert [x[0] for x in got] == [r[1] for r in rows]
