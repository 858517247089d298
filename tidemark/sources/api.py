"""JSON search service as a Spark data source, and flattening of its answers.

``register(spark)`` makes format ``record_api`` readable: options ``operation`` and request parameters, ``ids``, ``key`` and ``base`` (address). ``fetch`` does
the same for the ids of a table, of any number, one by one, and keeps a request that fails as a row with its error. One partition holds the limiter and the retries, as requests
must be spaced and counted in one place. Each answer is a row (operation, id, body); ``requests`` counts answers. Recorded answers are tables of the same rows.
"""

from __future__ import annotations

import json
import time
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions import scalar as X

#: Address, spacing and timeout in seconds, pauses after a refusal, and number of retries.
BASE = "https://api.legiscan.com"
SPACING, TIMEOUT, PAUSE, RETRIES = 0.1, 30, 60, 3


class ApiError(RuntimeError):
    """The service answered with a status other than OK."""


class Client:
    """Spaced, retried and counted requests. ``fetch(url, timeout)`` gives the body; tests replace it and ``sleep``."""

    def __init__(self, key: str, base: str = BASE, fetch=None, sleep=time.sleep, clock=time.monotonic):
        if not key:
            raise ValueError("an API key is needed")
        self.key, self.base, self.sleep, self.clock = key, base.rstrip("/"), sleep, clock
        self.fetch = fetch or (lambda url, timeout: urlopen(Request(url), timeout=timeout).read().decode())
        self.last: float | None = None
        self.requests = 0

    def request(self, operation: str, **params) -> dict:
        url = f"{self.base}/?{X.query_string({'key': self.key, 'op': operation} | params)}"
        for attempt in range(RETRIES + 1):
            if self.last is not None and (wait := SPACING - (self.clock() - self.last)) > 0:
                self.sleep(wait)
            try:
                body = json.loads(self.fetch(url, TIMEOUT))
                break
            except HTTPError as e:
                if e.code != 429 or attempt == RETRIES:
                    raise
                self.sleep(PAUSE * 2**attempt)
        self.requests += 1
        self.last = self.clock()
        if body.get("status") != "OK":
            raise ApiError((body.get("alert") or {}).get("message", "unknown error"))
        return body

    def search(self, query: str, state: str = "ALL", raw: bool = True) -> dict:
        return self.request("getSearchRaw" if raw else "getSearch", state=state, query=query)

    def document(self, key: int) -> dict:
        return self.request("getBill", id=key).get("bill", {})

    def master_list(self, session: int) -> dict:
        return self.request("getMasterListRaw", id=session)

    def text(self, key: int) -> dict:
        return self.request("getBillText", id=key).get("text", {})


class _Part(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self):
        return [_Part(0)]

    def read(self, partition):
        o = self.options
        operation, ids = o["operation"], [x for x in o.get("ids", "").split(",") if x] or [None]
        client = Client(o["key"], o.get("base", BASE))
        more = {k: v for k, v in o.items() if k not in ("operation", "ids", "key", "base")}
        for i in ids:
            yield operation, None if i is None else int(i), json.dumps(client.request(operation, **({} if i is None else {"id": i}), **more))


class RecordApi(DataSource):
    @classmethod
    def name(cls):
        return "record_api"

    def schema(self):
        return "operation string, id bigint, body string"

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordApi)


def read(spark: SparkSession, operation: str, key: str, base: str = BASE, **params) -> DataFrame:
    """(operation, id, body) of one request without an id."""
    register(spark)
    reader = spark.read.format("record_api").option("operation", operation).option("key", key).option("base", base)
    for name, value in params.items():
        reader = reader.option(name, value)
    return reader.load()


def fetch(ids: DataFrame, operation: str, key: str, base: str = BASE) -> DataFrame:
    """(operation, id, body, error) of a request for each distinct ``id`` of a table; body is null where a request failed. Read it once: reading is requesting."""

    def run(batches):
        client = Client(key, base)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                body = error = None
                try:
                    body = json.dumps(client.request(operation, id=i))
                except (ApiError, OSError, ValueError) as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([operation]), pa.array([i], pa.int64()), pa.array([body], pa.string()), pa.array([error], pa.string())], ["operation", "id", "body", "error"])

    return ids.select(F.col("id").cast("long").alias("id")).where("id is not null").distinct().repartition(1).mapInArrow(run, "operation string, id bigint, body string, error string")


def requests(answers: DataFrame) -> int:
    """How many requests were answered, with success or with an error of the service itself."""
    failed = F.col("error").isNull() | F.col("error").startswith("ApiError") if "error" in answers.columns else F.lit(True)
    return answers.where(failed).count()


def documents(answers: DataFrame) -> DataFrame:
    """(bill_id, doc, error) of getBill answers; an answer without a document is left out."""
    error = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    out = answers.where(F.col("operation") == "getBill").select(F.col("id").alias("bill_id"), F.get_json_object("body", "$.bill").alias("doc"), error.alias("error"))
    return out.where("error is not null or (doc is not null and doc <> '{}')")


def text_rows(answers: DataFrame) -> DataFrame:
    """(id, text_id, mime, doc) of getBillText answers."""
    at = lambda p: F.get_json_object("body", f"$.text.{p}")
    return answers.where(F.col("operation") == "getBillText").select("id", X.whole_number(at("doc_id")).alias("text_id"), at("mime").alias("mime"), at("doc").alias("doc"))


def search_rows(answers: DataFrame, column: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """(ord, bill_id, relevance, state, bill_number, title) of raw search answers, in their order, after the columns to ``keep``."""
    item = "bill_id string, relevance bigint, state string, bill_number string, title string"
    parsed = F.from_json(F.get_json_object(column, "$.searchresult.results"), f"array<struct<{item.replace(' string', ':string').replace(' bigint', ':bigint')}>>")
    return answers.select(*keep, F.posexplode(parsed).alias("ord", "r")).select(*keep, "ord", "r.*")


def search_summary(answers: DataFrame, column: str = "body") -> DataFrame:
    at = lambda p: F.get_json_object(column, f"$.searchresult.summary.{p}")
    return answers.select(at("count").try_cast("bigint").alias("count"), at("relevancy").alias("relevancy"))


def keyed_rows(answers: DataFrame, path: str, column: str = "body", skip: tuple[str, ...] = ()) -> DataFrame:
    """(ord, key, value) of an object whose values are objects, in its order; other values and ``skip`` are left out."""
    entries = F.map_entries(F.from_json(F.get_json_object(column, path), "map<string,string>"))
    rows = answers.select("*", F.posexplode(entries).alias("ord", "e")).select(*[c for c in answers.columns if c != column], "ord", "e.key", "e.value")
    return rows.where(F.json_object_keys("value").isNotNull() & ~F.col("key").isin(*skip) if skip else F.json_object_keys("value").isNotNull())


def master_rows(answers: DataFrame, column: str = "body") -> DataFrame:
    """(..., bill_id, change_hash) of master lists: entries with both keys; of entries with one id the last stays."""
    rows = keyed_rows(answers, "$.masterlist", column)
    names = F.json_object_keys("value")
    rows = rows.where(F.array_contains(names, "bill_id") & F.array_contains(names, "change_hash"))
    rows = rows.select(*[c for c in rows.columns if c not in ("key", "value")], X.whole_number(F.get_json_object("value", "$.bill_id")).alias("bill_id"), F.get_json_object("value", "$.change_hash").alias("change_hash"))
    group = [c for c in rows.columns if c not in ("ord", "change_hash")]
    return rows.where("bill_id is not null").groupBy(*group).agg(F.max_by("change_hash", "ord").alias("change_hash"))


def resolve_key(answers: DataFrame, state: str, label: str) -> DataFrame:
    """(bill_id) of the entries of a keyed search that are this state's label; exactly one is right."""
    rows = keyed_rows(answers, "$.searchresult", skip=("summary",))
    at = lambda p: F.get_json_object("value", f"$.{p}")
    return rows.where(X.same_text(at("state"), F.lit(state)) & X.same_text(at("bill_number"), F.lit(label))).select(X.whole_number(at("bill_id")).alias("bill_id"))
