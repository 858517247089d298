"""Command line of the runs, over the service or over recorded answers."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as X
from tidemark.functions.near import STANDING_QUERY
from tidemark.operators.relops import distinct_values
from tidemark.plans import pipelines as P
from tidemark.sources import api
from tidemark.sources.session import session, settings
from tidemark.sources.state import Snapshots


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--min-relevance", type=int, default=0)
    p.add_argument("--state", default="ALL")
    p.add_argument("--use-raw", action="store_true", default=True)
    p.add_argument("--full", action="store_true", help="not incremental")
    p.add_argument("--check-existing", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--since", type=X.since_day, metavar="DATE")
    p.add_argument("--sync", action="store_true")
    p.add_argument("--backfill", action="store_true")
    one = p.add_mutually_exclusive_group()
    one.add_argument("--legiscan-url")
    one.add_argument("--legiscan-id", type=int)
    p.add_argument("--answers", help="table (operation, id, body) of recorded answers, as JSON lines or Parquet, in place of the service")
    p.add_argument("--base", default=api.BASE, help="address of the service")
    p.add_argument("--root", help="folder of the record table (else STATE_ROOT)")
    return p.parse_args(argv)


class Recorded:
    """Answers from a table."""

    def __init__(self, spark: SparkSession, path: str):
        reader = spark.read.schema("operation string, id bigint, body string")
        self.answers = reader.json(path) if path.endswith(".jsonl") else reader.parquet(path)
        self.requests = None

    def of(self, operation: str, **params) -> DataFrame:
        return self.answers.where(F.col("operation") == operation)

    def fetch(self, ids: DataFrame, operation: str, state: Snapshots) -> DataFrame:
        return self.of(operation).join(ids.select(F.col("id").cast("long").alias("id")).distinct(), "id", "left_semi")


class Live:
    """Answers of the service, each request made once and its answer staged."""

    def __init__(self, spark: SparkSession, key: str, base: str):
        self.spark, self.key, self.base, self.requests = spark, key, base, 0

    def of(self, operation: str, **params) -> DataFrame:
        rows = [tuple(r) for r in api.read(self.spark, operation, self.key, self.base, **params).collect()]  # one answer
        self.requests += len(rows)
        return self.spark.createDataFrame(rows, "operation string, id bigint, body string")

    def fetch(self, ids: DataFrame, operation: str, state: Snapshots) -> DataFrame:
        answers = state.stage(api.fetch(ids, operation, self.key, self.base))
        self.requests += api.requests(answers)
        return answers


def record_key(spark: SparkSession, a: argparse.Namespace, source) -> int:
    """The id that the arguments name; ValueError if they name none."""
    if a.legiscan_id is not None:
        return a.legiscan_id
    row = spark.createDataFrame([(a.legiscan_url,)], "u string").select(X.url_id(F.col("u")).alias("i"), X.url_parts(F.col("u")).alias("p")).first()
    if row["i"] is not None:
        return row["i"]
    if row["p"] is None:
        raise ValueError("not an address of a record")
    p = row["p"]
    return P.resolve_one(api.resolve_key(source.of("getSearch", state=p["state"], query=p["label"], year=str(p["year"])), p["state"], p["label"]))


def run(spark: SparkSession, a: argparse.Namespace, source, state: Snapshots, now: datetime) -> P.Report:
    """Single record before backfill before sync before ingest."""
    ids = lambda df, c: df.select(F.col(c).alias("id"))
    docs_of = lambda df, c: api.documents(source.fetch(ids(df, c), "getBill", state))
    try:
        if a.legiscan_url is not None or a.legiscan_id is not None:
            key = record_key(spark, a, source)
            report = P.store_one(docs_of(spark.createDataFrame([(key,)], "k bigint"), "k"), key, state, now)
        elif a.backfill:
            due = P.backfill_targets(state.read())
            report = P.backfill(docs_of(due if not a.dry_run else due.limit(0), "legiscan_id"), state, now, a.dry_run)
        elif a.sync:
            sessions = distinct_values(state.read(), "legiscan_session_id")
            lists = source.fetch(ids(sessions, "legiscan_session_id"), "getMasterListRaw", state)
            master = api.master_rows(lists.where("body is not null").select(F.col("id").alias("session_id"), "body"))
            due = P.sync_targets(state.read(), master)
            report = P.sync(master, docs_of(due if not a.dry_run else due.limit(0), "legiscan_id"), state, now, a.dry_run)
        else:
            options = P.IngestOptions(a.min_relevance, a.state, a.use_raw, not a.full, a.check_existing, a.since, a.dry_run, a.limit)
            found = source.of("getSearchRaw", query=STANDING_QUERY, state=a.state)
            rows = state.stage(P.candidates(api.search_rows(found), state.read(), options))
            report = replace(P.ingest_rows(rows, docs_of(rows, "bill_id"), state, now, options), found=api.search_summary(found).first()["count"])
        return replace(report, requests=source.requests)
    finally:
        state.unstage()


def main(argv: list[str] | None = None) -> int:
    """Prints the count, and to stderr what was found, requested and rejected; 0 or 1 as exit code."""
    a = arguments(argv)
    root = a.root or settings().state_root
    key = settings().legiscan_api_key
    if not root:
        print("--root or STATE_ROOT must name the folder of the record table", file=sys.stderr)
        return 1
    if not a.answers and not key:
        print("LEGISCAN_API_KEY must be set, or --answers given", file=sys.stderr)
        return 1
    spark = session()
    try:
        source = Recorded(spark, a.answers) if a.answers else Live(spark, key, a.base)
        report = run(spark, a, source, Snapshots(spark, root), datetime.now(timezone.utc))
    except (ValueError, RuntimeError, OSError) as e:
        print(e, file=sys.stderr)
        return 1
    for name in ("found", "requests", "rejected", "version"):
        if getattr(report, name) is not None:
            print(f"{name}: {getattr(report, name)}", file=sys.stderr)
    for row in report.preview or ():
        print(f"{row['external_id']}: {row['title']}", file=sys.stderr)
    print(report.count)
    return 0


if __name__ == "__main__":
    sys.exit(main())
