"""Queries of the operators over the supplied tables, and their SQL, by name.

The tables hold no records of the model, so look-alikes stand in: events for search results (relevance in props), labels for the
tracked subset of documents, customers for (state, number), sources for sessions, orders for dated records.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import near as N
from tidemark.functions import scalar as X
from tidemark.operators import relops as R
from tidemark.operators import upsert as U
from tidemark.plans import pipelines as P
from tidemark.plans.parse import parse_documents, validated
from tidemark.plans.schema import RECORD
from tidemark.sources import api
from tidemark.sources.state import Snapshots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DAY = date(1996, 1, 1)


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _search(spark, sf):
    relevance = X.whole_number(F.get_json_object("props", "$.k")).cast("int")
    return t(spark, sf, "events").select("event_id", "user_id", "event_type", relevance.alias("relevance"))


_K = "CASE WHEN regexp_full_match(json_extract_string(props, '$.k'), '[+-]?[0-9]+') THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END"


@query(f"""WITH s AS (SELECT event_id, user_id, event_type, {_K} AS relevance FROM events),
c AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ord FROM s WHERE coalesce(relevance, 0) >= 50)
SELECT event_id, user_id AS doc_id, relevance FROM c WHERE ord < 500 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.user_id)""")
def incremental_candidates(spark, sf):
    """Relevant search rows, in order up to the limit, that are not tracked yet."""
    x = R.first_rows(R.min_relevance(_search(spark, sf), 50), 500, "event_id").select("event_id", F.col("user_id").alias("doc_id"), "relevance")
    return R.new_of(x, t(spark, sf, "labels"), "doc_id").select("event_id", "doc_id", "relevance")


@query(f"SELECT event_id, {_K} AS relevance FROM events WHERE coalesce({_K}, 0) >= 85")
def relevance_filter(spark, sf):
    return R.min_relevance(_search(spark, sf), 85).select("event_id", "relevance")


@query("SELECT event_id, user_id FROM events WHERE event_type = (SELECT min(event_type) FROM events)")
def state_filter(spark, sf):
    x = t(spark, sf, "events")
    return R.state_is(x, x.agg(F.min("event_type")).first()[0] or "", "event_type").select("event_id", "user_id")


@query("SELECT c_custkey, upper(c_mktsegment) || ' ' || c_nationkey AS key, (upper(c_mktsegment) || ' ' || c_nationkey) IN (SELECT upper(c_mktsegment) || ' ' || c_nationkey FROM customer WHERE c_acctbal > 9000) AS is_known FROM customer WHERE c_mktsegment <> ''")
def candidate_filter_flags(spark, sf):
    """Formatted candidates with the membership flag of their key."""
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("state"), F.col("c_nationkey").cast("string").alias("bill_number"), "c_acctbal")
    known = c.where("c_acctbal > 9000").select(X.number_key(F.upper("state"), F.col("bill_number")).alias("key"))
    x = R.candidate_filter(c, known, raw=False)
    return x.select("c_custkey", X.number_key(F.upper("state"), F.col("bill_number")).alias("key"), "is_known")


@query("SELECT count(*) AS n FROM customer")
def candidate_filter_raw(spark, sf):
    return R.candidate_filter(t(spark, sf, "customer"), None).agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS bill_id FROM events WHERE regexp_full_match(json_extract_string(props, '$.k'), '[+-]?[0-9]+')")
def valid_id_filter(spark, sf):
    return R.valid_ids(t(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("bill_id")))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS version_date FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01'")
def since_filter(spark, sf):
    x = t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("version_date"))
    return R.since(x, DAY)


@query("""SELECT CASE WHEN d IS NULL THEN 'none' WHEN d > DATE '1996-01-01' THEN 'after' ELSE 'before' END AS part, count(*) AS n
FROM (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders) GROUP BY 1""")
def date_three_way_split(spark, sf):
    x = t(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.to_date("o_orderdate")).alias("d"))
    return R.day_split(x, DAY, "d")


@query("SELECT DISTINCT e.user_id AS doc_id FROM events e WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = e.user_id)")
def existing_ids_semi(spark, sf):
    return R.existing_of(t(spark, sf, "events").select(F.col("user_id").alias("doc_id")), t(spark, sf, "labels"), "doc_id")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def new_candidates_anti(spark, sf):
    return R.new_of(t(spark, sf, "documents").select("doc_id", "source"), t(spark, sf, "labels"), "doc_id")


@query("SELECT e.event_id, e.user_id AS doc_id, d.source, d.n_chars FROM events e JOIN documents d ON d.doc_id = e.user_id")
def lookup_detail(spark, sf):
    x = t(spark, sf, "events").select("event_id", F.col("user_id").alias("doc_id"))
    return R.lookup(x, t(spark, sf, "documents").select("doc_id", "source", "n_chars"), "doc_id").select("event_id", "doc_id", "source", "n_chars")


_HASHES = "SELECT doc_id, source, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE md5(text) END AS old, CASE WHEN doc_id % 7 = 0 THEN md5(text || 'x') WHEN doc_id % 77 = 1 THEN NULL ELSE md5(text) END AS new FROM documents"


def _hashes(spark, sf):
    d = t(spark, sf, "documents")
    stored = d.select("source", "doc_id", F.when(F.col("doc_id") % 11 != 0, F.md5("text")).alias("change_hash"))
    new = F.when(F.col("doc_id") % 7 == 0, F.md5(F.concat("text", F.lit("x")))).when(F.col("doc_id") % 77 != 1, F.md5("text"))
    return stored, d.select("source", "doc_id", new.alias("change_hash"))


@query(f"SELECT doc_id, source, coalesce(old, '') AS old_hash, new AS new_hash FROM ({_HASHES}) WHERE coalesce(old, '') IS DISTINCT FROM new")
def hash_diff(spark, sf):
    """Changed records of all sessions in one join."""
    return R.changed(*_hashes(spark, sf), ["source", "doc_id"]).select("doc_id", "source", "old_hash", "new_hash")


def _bills(d: DataFrame, condition: str, key) -> DataFrame:
    cols = {"id": F.concat(F.lit("u"), F.lpad(F.col("doc_id").cast("string"), 12, "0")), "external_id": F.concat_ws(" ", F.upper("lang"), F.col("doc_id").cast("string")), "legiscan_id": key, "title": F.md5("text"), "state": F.upper("lang"), "year": F.lit(2024), "bill_number": F.col("doc_id").cast("string"), "body": F.lit("house"), "change_hash": F.md5("text")}
    return d.where(condition).select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD])


@query("""WITH b AS (SELECT 'u' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS id, upper(lang) || ' ' || doc_id AS external_id, CASE WHEN doc_id % 6 <> 0 THEN doc_id END AS legiscan_id FROM documents WHERE doc_id % 2 = 0)
SELECT d.doc_id, coalesce(l.id, e.id) AS matched FROM documents d LEFT JOIN b l ON l.legiscan_id = d.doc_id LEFT JOIN b e ON e.external_id = upper(d.lang) || ' ' || d.doc_id""")
def two_key_match(spark, sf):
    d = t(spark, sf, "documents")
    target = _bills(d, "doc_id % 2 = 0", F.when(F.col("doc_id") % 6 != 0, F.col("doc_id")))
    x = d.select("doc_id", F.col("doc_id").alias("legiscan_id"), F.concat_ws(" ", F.upper("lang"), F.col("doc_id").cast("string")).alias("external_id"))
    return R.two_key_match(x, target).select("doc_id", F.coalesce("id_l", "id_e").alias("matched"))


_CLASSES = """SELECT o.o_orderkey, CASE WHEN s.k IS NULL THEN 'INSERT' WHEN s.d IS NOT DISTINCT FROM CAST(o.o_orderdate AS DATE) THEN 'SKIP' ELSE 'UPDATE' END AS action
FROM orders o LEFT JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN DATE '1990-01-01' ELSE CAST(o_orderdate AS DATE) END AS d FROM orders WHERE o_orderkey % 3 <> 0) s ON s.k = o.o_orderkey"""


def _classes(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    stored = o.where("o_orderkey % 3 <> 0").withColumn("day", F.when(F.col("o_orderkey") % 5 == 0, F.lit(date(1990, 1, 1))).otherwise(F.col("day")))
    return R.classify(o, stored, "o_orderkey", "day")


@query(_CLASSES)
def upsert_classify(spark, sf):
    return _classes(spark, sf).select("o_orderkey", "action")


@query(f"""SELECT count(*) FILTER (action = 'INSERT') AS inserted, count(*) FILTER (action = 'UPDATE') AS updated, count(*) FILTER (action = 'SKIP') AS skipped, count(*) AS total FROM ({_CLASSES})""")
def action_counts(spark, sf):
    return R.action_counts(_classes(spark, sf))


@query(_CLASSES.replace("SELECT o.o_orderkey, ", "SELECT o_orderkey FROM (SELECT o.o_orderkey, ") + ") WHERE action = 'INSERT'")
def insert_listing_anti(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey")
    return R.new_of(o, o.where("o_orderkey % 3 <> 0"), "o_orderkey")


_INDEX = "SELECT c_mktsegment || ' ' || c_nationkey AS key, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS members, count(*) AS n FROM customer GROUP BY 1"


def _index(spark, sf):
    c = t(spark, sf, "customer")
    return R.existing_index(c, X.number_key(F.col("c_mktsegment"), F.col("c_nationkey").cast("string")), ["c_custkey", "c_name"])


@query(_INDEX)
def existing_index(spark, sf):
    ids = F.transform("members", lambda m: m["c_custkey"].cast("string"))
    return _index(spark, sf).select("key", F.array_join(ids, ",").alias("members"), F.size("members").cast("long").alias("n"))


@query(f"SELECT count(*) AS keys, CAST(sum(n) AS BIGINT) AS members FROM ({_INDEX})")
def index_counts(spark, sf):
    return R.index_counts(_index(spark, sf))


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def distinct_sessions(spark, sf):
    return R.distinct_values(t(spark, sf, "documents"), "source")


@query("SELECT user_id, min(event_id) AS ord FROM events GROUP BY 1")
def ordered_dedupe(spark, sf):
    return R.ordered_dedupe(t(spark, sf, "events").withColumnRenamed("event_id", "ord"), "user_id", "ord")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def last_wins_map(spark, sf):
    return R.last_wins(t(spark, sf, "events"), "user_id", "event_type", "event_id")


@query("SELECT max(ts) AS last_run FROM events")
def last_run(spark, sf):
    return R.last_run(t(spark, sf, "events"), "ts")


@query("SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1 HAVING count(*) = 1")
def unique_resolution(spark, sf):
    return R.exactly_one(t(spark, sf, "supplier"), ["s_nationkey"], "s_suppkey")


@query("SELECT c_name, c_custkey FROM customer WHERE c_name > 'Customer#000000100' ORDER BY c_name LIMIT 1000")
def keyset_page(spark, sf):
    return R.keyset_page(t(spark, sf, "customer").select("c_name", "c_custkey"), "c_name", "Customer#000000100")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 0 ORDER BY o_orderkey LIMIT 1000")
def keyset_page_int(spark, sf):
    return R.keyset_page(t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0)


@query("SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1000 OFFSET 500")
def offset_page(spark, sf):
    return R.offset_page(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 500)


@query("SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ord FROM conversations) WHERE ord < 100")
def ordered_limit(spark, sf):
    return R.first_rows(t(spark, sf, "conversations").select("conv_id", "turn"), 100, "conv_id", "turn")


@query("SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS ord, count(*) OVER () AS n FROM conversations) WHERE ord <= n - 40")
def ordered_limit_negative(spark, sf):
    return R.first_rows(t(spark, sf, "conversations").select("conv_id", "turn"), -40, "conv_id", "turn")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ord FROM orders")
def ordinals(spark, sf):
    """Places in an order, without one task for all rows (O2)."""
    return R.with_ordinal(t(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey").select("o_orderkey", "ord")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY day DESC NULLS LAST, o_orderkey LIMIT 10")
def topk_recent(spark, sf):
    x = t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return R.most_recent(x, "day", "o_orderkey", 10)


@query("SELECT c_name AS external_id, substr(repeat(c_name || ' ', 5), 1, 60) AS title FROM customer ORDER BY c_custkey LIMIT 5")
def dry_run_preview(spark, sf):
    """What a dry run shows of its records."""
    x = t(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("external_id"), F.repeat(F.concat("c_name", F.lit(" ")), 5).alias("title"))
    return P.preview(x)


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Introduced' WHEN 2 THEN 'Engrossed' WHEN 3 THEN 'Enrolled' WHEN 4 THEN 'Passed' WHEN 5 THEN 'Vetoed' WHEN 6 THEN 'Failed' END AS status,
CASE l_returnflag WHEN 'A' THEN NULL ELSE l_returnflag END AS passed FROM lineitem""")
def status_decode(spark, sf):
    doc = lambda c: F.parse_json(F.to_json(F.struct(c.alias("status"))))
    x = t(spark, sf, "lineitem")
    said = F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(F.col("l_returnflag"))
    x = x.select("l_orderkey", "l_linenumber", doc(F.col("l_linenumber")).alias("d1"), doc(said).alias("d2"))  # parsed once
    return x.select("l_orderkey", "l_linenumber", X.status_of(F.col("d1")).alias("status"), X.status_of(F.col("d2")).alias("passed"))


@query("""SELECT p_partkey, CASE WHEN contains(c, 'HOUSE') THEN 'house' WHEN contains(c, 'ASSEMBLY') THEN 'assembly' WHEN contains(c, 'SENATE') THEN 'senate'
WHEN starts_with(n, 'H') THEN 'house' WHEN starts_with(n, 'S') THEN 'senate' WHEN starts_with(n, 'A') THEN 'assembly' ELSE 'house' END AS body
FROM (SELECT p_partkey, upper(CASE WHEN p_partkey % 5 = 0 THEN 'House of ' || p_brand WHEN p_partkey % 5 = 1 THEN 'senate' WHEN p_partkey % 5 = 2 THEN 'State Assembly' ELSE '' END) AS c, upper(p_type) AS n FROM part)""")
def body_map(spark, sf):
    k = F.col("p_partkey") % 5
    chamber = F.when(k == 0, F.concat(F.lit("House of "), "p_brand")).when(k == 1, "senate").when(k == 2, "State Assembly").otherwise("")
    return t(spark, sf, "part").select("p_partkey", X.body_of(chamber, F.col("p_type")).alias("body"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN CAST(1990 + o_orderkey % 30 AS INTEGER) WHEN o_orderkey % 4 = 1 THEN CAST(year(o_orderdate) AS INTEGER) ELSE 2024 END AS year FROM orders""")
def year_extract(spark, sf):
    k = F.col("o_orderkey") % 4
    year = F.when(k == 0, (F.lit(1990) + F.col("o_orderkey") % 30).cast("string")).when(k == 1, "0")
    title = F.when(k == 1, F.concat(F.lit("Session "), F.year("o_orderdate").cast("string"), F.lit("-2099"))).when(k == 2, "no digits")
    return t(spark, sf, "orders").select("o_orderkey", X.year_of(year, title, F.lit(2024)).alias("year"))


_DATES = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'invalid' WHEN 2 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 3 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') END AS s, '1999-02-20' AS h FROM orders"


@query(f"SELECT o_orderkey, coalesce(CASE WHEN regexp_full_match(s, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN CAST(s AS DATE) END, CAST(h AS DATE)) AS version_date FROM ({_DATES})")
def date_parse_fallback(spark, sf):
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    s = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, "invalid").when(k == 2, F.date_format(d, "yyyy-M-d")).when(k == 3, F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd")))
    return t(spark, sf, "orders").select("o_orderkey", X.version_day(s, F.lit("1999-02-20")).alias("version_date"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey = 0 THEN '' WHEN o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 THEN o_orderstatus || ' ' || o_custkey || ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' ' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS external_id FROM orders""")
def external_id(spark, sf):
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("")
    day = F.when(F.col("o_orderkey") % 7 != 0, F.to_date("o_orderdate"))
    return t(spark, sf, "orders").select("o_orderkey", X.external_id(state, F.col("o_custkey").cast("string"), day, F.col("o_orderkey")).alias("external_id"))


_SITE = """CASE page_id % 6 WHEN 0 THEN 'https://legiscan.com/ca/bill/' || page_id WHEN 1 THEN 'see http://legiscan.com/IL/bill/SB' || page_id || '/2025#x' WHEN 2 THEN 'https://legiscan.com/ny/bill/' || page_id || '/20231' WHEN 3 THEN url WHEN 4 THEN 'https://legiscan.com/TX/bill/' || page_id || 'abc' END"""


def _site():
    k, p = F.col("page_id") % 6, F.col("page_id").cast("string")
    return (
        F.when(k == 0, F.concat(F.lit("https://legiscan.com/ca/bill/"), p)).when(k == 1, F.concat(F.lit("see http://legiscan.com/IL/bill/SB"), p, F.lit("/2025#x")))
        .when(k == 2, F.concat(F.lit("https://legiscan.com/ny/bill/"), p, F.lit("/20231"))).when(k == 3, F.col("url")).when(k == 4, F.concat(F.lit("https://legiscan.com/TX/bill/"), p, F.lit("abc")))
    )


@query(rf"""SELECT page_id, CAST(nullif(regexp_extract(u, 'legiscan\.com/[^/]+/bill/([0-9]+)', 1), '') AS BIGINT) AS number FROM (SELECT page_id, {_SITE} AS u FROM pages)""")
def url_id(spark, sf):
    """Address to id (X11)."""
    return t(spark, sf, "pages").select("page_id", X.url_id(_site()).alias("number"))


@query(rf"""SELECT page_id, upper(state) AS state, label, CAST(year AS INTEGER) AS year FROM (SELECT page_id, regexp_extract(u, p, 1) AS state, regexp_extract(u, p, 2) AS label, regexp_extract(u, p, 3) AS year, regexp_matches(u, p) AS hit
FROM (SELECT page_id, {_SITE} AS u, 'legiscan\.com/([^/]+)/bill/([^/]+)/([0-9]{{4}})' AS p FROM pages)) WHERE hit""")
def url_parts(spark, sf):
    """Address to state, label and year."""
    x = t(spark, sf, "pages").select("page_id", X.url_parts(_site()).alias("p")).where("p is not null")
    return x.select("page_id", "p.state", "p.label", "p.year")


@query("""SELECT page_id, site, CASE WHEN page_id % 5 = 0 AND page_id % 2 = 0 THEN 'link' ELSE site END AS url FROM (SELECT page_id, CASE WHEN page_id = 0 THEN NULL WHEN page_id % 3 = 0 THEN 'https://legiscan.com/CA/bill/' || page_id ELSE url END AS site FROM pages)""")
def url_fallback(spark, sf):
    """Addresses of a record (X8, X9). An id of 0 counts as absent."""
    x = t(spark, sf, "pages")
    site = X.page_url(F.when(F.col("page_id") % 3 != 0, F.col("url")), F.lit("CA"), F.col("page_id"))
    return x.select("page_id", site.alias("site"), X.first_true(F.when(F.col("page_id") % 10 == 0, "link").when(F.col("page_id") % 10 == 5, ""), site).alias("url"))


@query("""SELECT c_custkey, upper(c_mktsegment) = upper('building') AS hit FROM customer""")
def case_insensitive_match(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", X.same_text(F.col("c_mktsegment"), F.lit("building")).alias("hit"))


def _doc_json():
    """A nested document of each row of documents."""
    k = F.col("doc_id")
    return F.to_json(
        F.struct(
            k.alias("bill_id"), F.col("lang").alias("state"), F.concat(F.lit("HB"), k.cast("string")).alias("bill_number"), F.md5("text").alias("title"), F.col("source").alias("description"),
            F.when(k % 5 == 1, "Senate").when(k % 5 == 3, "").alias("chamber"), F.when(k % 5 == 2, "Assembly").when(k % 5 == 3, "SENATE").when(k % 5 == 1, "House").alias("body"),
            F.when(k % 3 == 0, F.lit(2020)).alias("year"), F.when(k % 4 == 0, F.lit("2024-01-15")).alias("status_date"), (k % 8).alias("status"), F.md5("text").alias("change_hash"),
            F.struct((k % 20).alias("session_id"), F.lit("2023-2024 Regular Session").alias("session_title")).alias("session"),
            F.array(F.struct(F.lit("2024-2-20").alias("date"), F.lit("read").alias("action"))).alias("history"),
        )
    )


@query("""SELECT doc_id, CASE WHEN doc_id = 0 THEN '' ELSE upper(lang) || ' HB' || doc_id || ' ' || CASE WHEN doc_id % 4 = 0 THEN '2024-01-15' ELSE '2024-02-20' END || ' ' || doc_id END AS external_id, md5(text) AS title, upper(lang) AS state,
CASE WHEN doc_id % 3 = 0 THEN 2020 ELSE 2023 END AS year, CASE doc_id % 5 WHEN 1 THEN 'senate' WHEN 2 THEN 'assembly' WHEN 3 THEN 'senate' ELSE 'house' END AS body, source AS summary, CASE WHEN doc_id > 0 THEN 'https://legiscan.com/' || upper(lang) || '/bill/' || doc_id END AS url, doc_id AS legiscan_id,
CASE WHEN doc_id % 4 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-02-20' END AS version_date, CASE doc_id % 8 WHEN 1 THEN 'Introduced' WHEN 2 THEN 'Engrossed' WHEN 3 THEN 'Enrolled' WHEN 4 THEN 'Passed' WHEN 5 THEN 'Vetoed' WHEN 6 THEN 'Failed' END AS bill_status,
md5(text) AS change_hash, doc_id % 20 AS legiscan_session_id FROM documents""")
def parse_record(spark, sf):
    """Nested JSON to the flat record."""
    docs = t(spark, sf, "documents").select("doc_id", _doc_json().alias("doc"))
    cols = ("external_id", "title", "state", "year", "body", "summary", "url", "legiscan_id", "version_date", "bill_status", "change_hash", "legiscan_session_id")
    return parse_documents(docs, F.lit("2024-06-01").cast("timestamp")).select("doc_id", *cols)


@query("""WITH target AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 3 <> 0),
inc AS (SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN md5(text || 'x') END AS h FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0)
SELECT coalesce(t.doc_id, i.doc_id) AS doc_id, CASE WHEN t.doc_id IS NULL THEN 'INSERT' WHEN i.h IS NOT NULL THEN 'PATCH' ELSE 'NOOP' END AS action, coalesce(i.h, t.h) AS change_hash
FROM target t FULL JOIN inc i ON t.doc_id = i.doc_id""")
def upsert_apply(spark, sf):
    """A store of incoming rows over a target (U1, U3): the next snapshot."""
    ts = F.lit("2024-06-01").cast("timestamp")
    d = t(spark, sf, "documents")
    target = _bills(d, "doc_id % 3 <> 0", F.col("doc_id"))
    new = _bills(d, "doc_id % 2 = 0 or doc_id % 3 = 0", F.col("doc_id")).withColumn("change_hash", F.when(F.col("legiscan_id") % 9 != 0, "y"))
    texts = d.select(F.col("doc_id").alias("legiscan_id"), F.md5(F.concat("text", F.lit("x"))).alias("_h"))
    new = new.join(texts, "legiscan_id").withColumn("change_hash", F.when(F.col("change_hash").isNotNull(), F.col("_h"))).drop("_h").withColumn("ord", F.col("legiscan_id")).withColumn("external_id", F.lit(None).cast("string"))
    out = U.apply_store(target, U.plan_store(new.select(*RECORD.names, "ord"), target), ts)
    action = F.when(F.col("created_at").isNotNull(), "INSERT").when(F.col("updated_at").isNotNull(), "PATCH").otherwise("NOOP")
    return out.select(F.col("legiscan_id").alias("doc_id"), action.alias("action"), "change_hash")


@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN d.source ELSE md5(d.text) END AS title, d.doc_id % 2 = 0 AS hit FROM documents d""")
def coalesce_update(spark, sf):
    """A full update by key: nulls never overwrite."""
    ts = F.lit("2024-06-01").cast("timestamp")
    d = t(spark, sf, "documents")
    target = _bills(d, "true", F.col("doc_id"))
    patch = d.where("doc_id % 2 = 0").select(F.col("doc_id").alias("legiscan_id"), F.when(F.col("doc_id") % 4 == 0, F.col("source")).alias("title"))
    patch = patch.select(*[(F.col(f.name) if f.name in ("legiscan_id", "title") else F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD])
    return U.apply_update(target, patch, ts).select(F.col("legiscan_id").alias("doc_id"), "title", F.col("updated_at").isNotNull().alias("hit"))


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL AND d.doc_id > 0")
def backfill_targets(spark, sf):
    """Records without a session, ids above 0, with their documents."""
    d = t(spark, sf, "documents").select("doc_id", "source")
    bills = d.join(t(spark, sf, "labels").select("doc_id", F.lit(1).alias("legiscan_session_id")), "doc_id", "left").withColumnRenamed("doc_id", "legiscan_id")
    return R.lookup(P.backfill_targets(bills).withColumnRenamed("legiscan_id", "doc_id"), d, "doc_id")


_NEAR = "(ti NEAR ble) OR (thea NEAR nder) OR (trash)"


@query("SELECT doc_id FROM documents WHERE " + " OR ".join(f"regexp_matches(text, '{N.clause_pattern(c, 3)}')" for c in N.parse_query(_NEAR)))
def near_match(spark, sf):
    """Boolean NEAR over local text."""
    d = t(spark, sf, "documents")
    return d.where(N.near(F.col("text"), _NEAR, 3)).select("doc_id")


_ONE = ", ".join(str(i) for i, c in enumerate(N.parse_query(N.STANDING_QUERY)) if len(c) == 1)


@query(f"""SELECT doc_id FROM documents WHERE doc_id % 50 < 48 AND ((doc_id // 50) % 4 <> 2 OR doc_id % 50 IN ({_ONE}))""")
def near_standing(spark, sf):
    """The standing query's 48 clauses: each with its terms near, the other way round, too far apart, and as beginnings of words."""
    far = " ".join(f"w{i}" for i in range(12))
    ways = [lambda c: " the ".join(c), lambda c: ", so ".join(reversed(c)), lambda c: f" {far} ".join(c), lambda c: " ".join(x.upper() + "s" for x in c)]
    rows = [(k, v, way(c)) for k, c in enumerate(N.parse_query(N.STANDING_QUERY)) for v, way in enumerate(ways)]
    said = spark.createDataFrame(rows, "k int, v int, phrase string")
    d = t(spark, sf, "documents").select("doc_id", "source", (F.col("doc_id") % 50).cast("int").alias("k"), (F.floor(F.col("doc_id") / 50) % 4).cast("int").alias("v"))
    text = F.concat_ws(" ", F.coalesce("source", F.lit("")), "phrase", F.lit("end"))
    return d.join(F.broadcast(said), ["k", "v"], "left").where(N.near(text, N.STANDING_QUERY)).select("doc_id")


def _answer(d: DataFrame, group, entries, before: str, after: str) -> DataFrame:
    """(id, body): answers that hold the entries, JSON texts in the order of doc_id, of each group of rows."""
    rows = d.groupBy(group.alias("id")).agg(F.sort_array(F.collect_list(F.struct("doc_id", entries.alias("e")))).alias("es"))
    return rows.select("id", F.concat(F.lit(before), F.array_join(F.flatten(F.transform("es", lambda x: x["e"])), ","), F.lit(after)).alias("body"))


@query("""SELECT doc_id // 100 AS session_id, doc_id AS bill_id, CASE WHEN doc_id % 5 = 0 THEN 'again' WHEN doc_id % 7 = 0 THEN NULL ELSE md5(text) END AS change_hash FROM documents WHERE doc_id % 11 <> 0""")
def master_list(spark, sf):
    """Master lists to maps: entries with both keys, the last of each id."""
    k = F.col("doc_id")
    entry = lambda tag, value: F.concat(F.lit('"'), F.lit(tag), k.cast("string"), F.lit('":'), value)
    hash_ = F.when(k % 7 == 0, "null").otherwise(F.concat(F.lit('"'), F.md5("text"), F.lit('"')))
    whole = F.concat(F.lit('{"bill_id":'), k.cast("string"), F.lit(',"change_hash":'), hash_, F.lit("}"))
    first = F.when(k % 11 == 0, entry("", F.concat(F.lit('{"bill_id":'), k.cast("string"), F.lit("}")))).otherwise(entry("", whole))
    second = F.when((k % 5 == 0) & (k % 11 != 0), entry("b", F.concat(F.lit('{"bill_id":"'), k.cast("string"), F.lit('","change_hash":"again"}')))).otherwise(entry("n", F.lit("5")))
    lists = _answer(t(spark, sf, "documents"), F.floor(k / 100), F.array(first, second), '{"masterlist":{"session":{"session_id":1},', "}}")
    return api.master_rows(lists.withColumnRenamed("id", "session_id"))


@query("""SELECT doc_id AS bill_id FROM documents WHERE lang = (SELECT min(lang) FROM documents) AND doc_id % 4 <> 3""")
def keyed_search(spark, sf):
    """Entries of keyed searches that are one state's label, whatever the case."""
    d, k = t(spark, sf, "documents"), F.col("doc_id")
    label = F.when(k % 4 == 0, "HB1").when(k % 4 == 1, "hb1").when(k % 4 == 2, "Hb1").otherwise("HB2")
    entry = F.concat(F.lit('"'), k.cast("string"), F.lit('":{"state":"'), F.col("lang"), F.lit('","bill_number":"'), label, F.lit('","bill_id":"'), k.cast("string"), F.lit('"}'))
    found = _answer(d, F.floor(k / 100), F.array(entry, F.concat(F.lit('"n'), k.cast("string"), F.lit('":3'))), '{"searchresult":{"summary":{"state":"x","bill_number":"HB1"},', "}}")
    return api.resolve_key(found, (d.agg(F.min("lang")).first()[0] or "").upper(), "hB1")


@query("""SELECT doc_id // 100 AS page, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS ord, doc_id AS bill_id, doc_id % 101 AS relevance FROM documents QUALIFY relevance >= 60""")
def search_scan(spark, sf):
    """Raw search answers to rows in their order, above a relevance."""
    k = F.col("doc_id").cast("string")
    entry = F.concat(F.lit('{"bill_id":"'), k, F.lit('","relevance":'), (F.col("doc_id") % 101).cast("string"), F.lit("}"))
    found = _answer(t(spark, sf, "documents"), F.floor(F.col("doc_id") / 100), F.array(entry), '{"searchresult":{"summary":{"count":1},"results":[', "]}}")
    rows = api.search_rows(found.withColumnRenamed("id", "page"), keep=("page",))
    return R.valid_ids(R.min_relevance(rows, 60)).select("page", F.col("ord").cast("long").alias("ord"), "bill_id", "relevance")


@query("""SELECT doc_id AS bill_id, CASE WHEN doc_id % 6 <> 4 THEN '{"title":"' || md5(text) || '"}' END AS doc, CASE WHEN doc_id % 6 = 4 THEN 'ApiError: no' END AS error FROM documents WHERE doc_id % 6 NOT IN (0, 5)""")
def document_scan(spark, sf):
    """Answers to point lookups: empty and missing documents go, failed requests stay with their error."""
    k = F.col("doc_id") % 6
    doc = F.concat(F.lit('{"title":"'), F.md5("text"), F.lit('"}'))
    body = F.when(k == 0, '{"status":"OK"}').when(k == 5, '{"bill":{}}').when(k != 4, F.concat(F.lit('{"status":"OK","bill":'), doc, F.lit("}")))
    rows = t(spark, sf, "documents").select(F.lit("getBill").alias("operation"), F.col("doc_id").alias("id"), body.alias("body"), F.when(k == 4, "ApiError: no").alias("error"))
    return api.documents(rows)


@query("SELECT doc_id AS id, doc_id + 7 AS text_id, 'text/html' AS mime, md5(text) AS doc FROM documents")
def text_scan(spark, sf):
    """Answers with texts of records."""
    body = F.to_json(F.struct(F.struct((F.col("doc_id") + 7).alias("doc_id"), F.lit("text/html").alias("mime"), F.md5("text").alias("doc")).alias("text")))
    return api.text_rows(t(spark, sf, "documents").select(F.lit("getBillText").alias("operation"), F.col("doc_id").alias("id"), body.alias("body")))


@query("""SELECT count(*) AS rows, count(*) FILTER (doc_id % 5 <> 4) AS requests FROM documents""")
def request_count(spark, sf):
    """Answered requests."""
    k = F.col("doc_id") % 5
    x = t(spark, sf, "documents").select(F.when(k == 3, "ApiError: no").when(k == 4, "URLError: gone").alias("error"))
    return spark.createDataFrame([(x.count(), api.requests(x))], "rows long, requests long")


@query("""SELECT p_partkey, 'op=getSearch&query=' || replace(url_encode(p_name || ' & ' || p_partkey), '%20', '+') || CASE WHEN p_partkey % 2 = 0 THEN '&state=' || p_partkey ELSE '' END AS parameters FROM part""")
def request_parameters(spark, sf):
    """URL-encoded parameters, without those that are null."""
    k = F.col("p_partkey")
    text = X.query_text({"op": F.lit("getSearch"), "query": F.concat("p_name", F.lit(" & "), k.cast("string")), "state": F.when(k % 2 == 0, k)})
    return t(spark, sf, "part").select("p_partkey", text.alias("parameters"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS version_date FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-03-04'")
def since_argument(spark, sf):
    """The lower bound as it comes from the command line."""
    x = t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("version_date"))
    return R.since(x, X.since_day(" 1997-03-04T23:30:00Z "))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || ' 10:20:30' WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || ' 08:20:30' END AS at FROM orders""")
def timestamp_parse(spark, sf):
    """Instants with a Z, with an offset, and none."""
    k, day = F.col("o_orderkey") % 3, F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k == 0, F.concat(day, F.lit("T10:20:30Z"))).when(k == 1, F.concat(day, F.lit("T10:20:30+02:00"))).otherwise("soon")
    return t(spark, sf, "orders").select("o_orderkey", F.date_format(X.parse_instant(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("""SELECT doc_id, 'E' || doc_id AS external_id, 'PATCH' AS action, 1 AS rows, 'one' AS change_hash FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 'F' || doc_id, 'INSERT', 1, 'two' FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 'E' || doc_id, 'INSERT', 2, 'two' FROM documents WHERE doc_id % 3 = 1
UNION ALL SELECT doc_id, 'E' || doc_id, 'PATCH', 2, 'two' FROM documents WHERE doc_id % 3 = 2""")
def store_repeated_ids(spark, sf):
    """A store whose rows repeat each id: an id that was inserted no longer falls back to its external_id."""
    d, k = t(spark, sf, "documents"), F.col("doc_id")
    target = _bills(d, "true", F.when(k % 3 == 2, k)).withColumn("external_id", F.concat(F.lit("E"), F.col("bill_number")))
    e, f = F.concat(F.lit("E"), F.col("bill_number")), F.concat(F.lit("F"), F.col("bill_number"))
    first = _bills(d, "true", k).withColumn("external_id", F.when(F.col("legiscan_id") % 3 == 0, e).otherwise(f)).withColumn("change_hash", F.lit("one")).withColumn("ord", F.col("legiscan_id") * 2)
    second = _bills(d, "true", k).withColumn("external_id", F.when(F.col("legiscan_id") % 3 == 0, f).otherwise(e)).withColumn("change_hash", F.lit("two")).withColumn("ord", F.col("legiscan_id") * 2 + 1)
    plan = U.plan_store(first.unionByName(second), target)
    return plan.select(F.col("legiscan_id").alias("doc_id"), "external_id", "action", F.col("rows").cast("int").alias("rows"), "change_hash")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE md5(text) END AS title, doc_id % 3 = 0 AS hit, NULL::VARCHAR AS full_text FROM documents""")
def update_by_uuid(spark, sf):
    """A full update by the record's own id, without its full text (U4)."""
    return _by_uuid(spark, sf, False)


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE md5(text) END AS title, doc_id % 3 = 0 AS hit, CASE WHEN doc_id % 3 = 0 THEN md5(text) END AS full_text FROM documents""")
def update_with_full_text(spark, sf):
    """The alternate projection of an update, which writes the full text as well."""
    return _by_uuid(spark, sf, True)


def _by_uuid(spark, sf, full: bool) -> DataFrame:
    d = t(spark, sf, "documents")
    target = _bills(d, "true", F.col("doc_id"))
    new = {"id": F.concat(F.lit("u"), F.lpad(F.col("doc_id").cast("string"), 12, "0")), "title": F.col("source"), "full_text": F.md5("text")}
    patch = d.where("doc_id % 3 = 0").select(*[new.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD])
    out = U.apply_update(target, patch, F.lit("2024-06-01").cast("timestamp"), key="id", keep_full_text=full)
    return out.select(F.col("legiscan_id").alias("doc_id"), "title", F.col("updated_at").isNotNull().alias("hit"), "full_text")


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN 'no title' END AS reject_reason FROM documents""")
def required_values(spark, sf):
    """Records without a required value are set apart."""
    x = _bills(t(spark, sf, "documents"), "true", F.col("doc_id")).withColumn("title", F.when(F.col("legiscan_id") % 5 != 1, F.col("title")))
    return validated(x).select(F.col("legiscan_id").alias("doc_id"), "reject_reason")


def _table(spark: SparkSession) -> Snapshots:
    """A new record table in the folder that driver and executors share; it goes when the session ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    out = Snapshots(spark, f"{root.rstrip('/')}/records-{uuid.uuid4().hex}", buckets=8)
    fs, hp = out._fs(out.root)
    fs.mkdirs(hp)
    fs.deleteOnExit(hp)
    return out


@query("""SELECT doc_id, md5(text) AS title FROM documents WHERE doc_id % 10 <> 3 UNION ALL SELECT doc_id + 1000000000, 'new' FROM documents WHERE doc_id % 4 = 0""")
def table_append_delete(spark, sf):
    """A commit, an append and a delete of the record table."""
    table, d = _table(spark), t(spark, sf, "documents")
    table.commit(_bills(d, "true", F.col("doc_id")))
    table.append(_bills(d, "doc_id % 4 = 0", F.col("doc_id") + 1_000_000_000).withColumn("title", F.lit("new")))
    table.delete((F.col("legiscan_id") % 10 == 3) & (F.col("legiscan_id") < 1_000_000_000))
    return table.read().select(F.col("legiscan_id").alias("doc_id"), "title")


_CHANGED = "doc_id % 20 < 15 AND (doc_id % 4 = 0 OR doc_id % 9 = 0)"


@query(f"""SELECT doc_id, CASE WHEN {_CHANGED} THEN 'new ' ELSE '' END || md5(text) AS title, (SELECT count(*) FROM documents WHERE {_CHANGED}) AS tried FROM documents""")
def sync_run(spark, sf):
    """A sync of all sessions: changed records are updated in the table, and counted as tried."""
    table, d, k = _table(spark), t(spark, sf, "documents"), F.col("doc_id")
    of = F.col("legiscan_id")
    table.commit(_bills(d, "true", k).withColumn("legiscan_session_id", F.when(of % 20 < 15, of % 20)).withColumn("change_hash", F.when(of % 9 != 0, F.col("change_hash"))))
    master = d.select((k % 20).alias("session_id"), k.alias("bill_id"), F.when(k % 4 == 0, "changed").otherwise(F.md5("text")).alias("change_hash"))
    doc = F.to_json(F.struct(k.alias("bill_id"), F.lit("CA").alias("state"), F.lit("HB1").alias("bill_number"), F.concat(F.lit("new "), F.md5("text")).alias("title")))
    report = P.sync(master, d.select(k.alias("bill_id"), doc.alias("doc")), table, datetime(2024, 6, 1))
    return table.read().select(F.col("legiscan_id").alias("doc_id"), "title", F.lit(report.count).cast("long").alias("tried"))


@query("""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'not fetched: ApiError: no' WHEN doc_id % 6 = 3 THEN 'null state' END AS reject_reason, count(*) FILTER (doc_id % 3 <> 0 AND doc_id % 2 = 0) OVER () AS inserted FROM documents""")
def ingest_run(spark, sf):
    """An ingest: new documents are inserted, failed and malformed ones set apart with their reasons."""
    table, d, k = _table(spark), t(spark, sf, "documents"), F.col("doc_id")
    table.commit(_bills(d, "doc_id % 3 <> 0 and doc_id % 2 = 1", k))
    search = d.select(k.alias("ord"), k.cast("string").alias("bill_id"), F.lit(80).alias("relevance"))
    state = F.when(k % 6 == 3, F.lit(None).cast("string")).otherwise("ca")
    doc = F.concat(F.lit('{"bill_id":'), k.cast("string"), F.lit(',"bill_number":"HB'), k.cast("string"), F.lit('","title":"T","state":'), F.coalesce(F.concat(F.lit('"'), state, F.lit('"')), F.lit("null")), F.lit("}"))
    docs = d.select(k.alias("bill_id"), F.when(k % 6 != 0, doc).alias("doc"), F.when(k % 6 == 0, "ApiError: no").alias("error"))
    report = P.ingest(search, docs, table, datetime(2024, 6, 1))
    bad = table.rejected().select(F.col("bill_id").alias("doc_id"), "reject_reason")
    known = table.read().select(F.col("legiscan_id").alias("doc_id"), F.lit(None).cast("string").alias("reject_reason"))
    return known.unionByName(bad).withColumn("inserted", F.lit(report.count).cast("long"))
