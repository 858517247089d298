"""Ingest, backfill, sync and single-record runs: lazy plans over given frames, and runs that commit a version.

A run parses its documents once, into a staged table. A record that can't be parsed, fetched or stored is set apart with its reason and does not stop
the others, of whatever session they are; it goes to the table's quarantine. A store appends new records and writes the buckets of patched ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import relops as R
from tidemark.operators import upsert as U
from tidemark.plans.parse import parse_documents, split_rejected
from tidemark.sources.state import Snapshots


@dataclass(frozen=True)
class IngestOptions:
    min_relevance: int = 0
    state: str = "ALL"
    use_raw: bool = True
    incremental: bool = True
    check_existing: bool = False
    since_date: date | None = None
    dry_run: bool = False
    limit: int | None = None


@dataclass(frozen=True)
class Report:
    count: int
    preview: list | None = None
    version: int | None = None
    rejected: int = 0
    requests: int | None = None
    found: int | None = None


def candidates(search: DataFrame, bills: DataFrame, options: IngestOptions) -> DataFrame:
    """Search rows (ord, bill_id, relevance, ...) to fetch: relevant, in order up to the limit, and not yet stored if incremental."""
    x = R.min_relevance(search, options.min_relevance)
    if "state" in x.columns:
        x = R.state_is(x, options.state)
    if options.limit is not None:
        x = R.prefix_limit(R.with_ordinal(x.withColumnRenamed("ord", "_o"), "_o").drop("_o"), options.limit)
    x = R.valid_ids(x)
    if options.incremental and not options.check_existing:
        known = bills.where("legiscan_id is not null").select(F.col("legiscan_id").alias("bill_id"))
        x = R.new_of(x, known, "bill_id")
    return x


def parsed_candidates(rows: DataFrame, docs: DataFrame, run_ts: Column) -> DataFrame:
    """Records with ``ord`` and ``reject_reason`` of the candidates' documents (bill_id, doc, and error where the fetch of one failed)."""
    found = docs if "error" in docs.columns else docs.withColumn("error", F.lit(None).cast("string"))
    met = R.lookup(rows.select("ord", "bill_id"), found.select("bill_id", "doc", "error"), "bill_id")
    out = parse_documents(met, run_ts)
    return out.withColumn("reject_reason", F.coalesce(F.concat(F.lit("not fetched: "), "error"), "reject_reason")).drop("error")


def fetched(rows: DataFrame, docs: DataFrame, run_ts: Column, options: IngestOptions) -> tuple[DataFrame, DataFrame]:
    """(records with ``ord``, quarantine) of the candidates' documents."""
    good, bad = split_rejected(parsed_candidates(rows, docs, run_ts))
    return R.since(good, options.since_date), bad


def preview(records: DataFrame, rows: int = 5) -> DataFrame:
    """What a dry run shows: the first records, with titles cut to 60 characters."""
    return records.orderBy("ord").select("external_id", F.substring("title", 1, 60).alias("title")).limit(rows)


def run_name(run_ts: datetime) -> str:
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


def _set_apart(state: Snapshots, bad: DataFrame, run: str) -> int:
    """Quarantine rejected rows; how many they are."""
    n = bad.count()
    if n:
        state.quarantine(bad.select("bill_id", "external_id", "title", "reject_reason"), run)
    return n


def _store(state: Snapshots, bills: DataFrame, records: DataFrame, ts: Column, batch: tuple[str, int] | None = None) -> tuple[int, int]:
    """(number of inserted records, version) after a store."""
    plan = state.stage(U.plan_store(records, bills))
    patches, new = U.store_parts(bills, plan, ts)
    patches = state.stage(patches)
    inserted = plan.where("action = 'INSERT'").count()
    return inserted, state.rewrite(patches.select("legiscan_id"), lambda old: U.patched(old, patches, ts), new, batch)


def ingest(search: DataFrame, docs: DataFrame, state: Snapshots, run_ts: datetime, options: IngestOptions = IngestOptions()) -> Report:
    """Store new documents; the count is of inserted records, or of records that reached the store in a dry run."""
    return ingest_rows(candidates(search, state.read(), options), docs, state, run_ts, options)


def ingest_rows(rows: DataFrame, docs: DataFrame, state: Snapshots, run_ts: datetime, options: IngestOptions = IngestOptions()) -> Report:
    """The same from candidates (ord, bill_id)."""
    ts, bills = F.lit(run_ts), state.read()
    try:
        good, bad = split_rejected(state.stage(parsed_candidates(rows, docs, ts)))
        records = R.since(good, options.since_date)
        if options.dry_run:
            return Report(records.count(), preview(records).collect())
        inserted, version = _store(state, bills, records, ts)
        return Report(inserted, version=version, rejected=_set_apart(state, bad, run_name(run_ts)))
    finally:
        state.unstage()


def backfill_targets(bills: DataFrame) -> DataFrame:
    """Ids above 0 of records without a session, ascending."""
    return bills.where("legiscan_session_id is null and legiscan_id > 0").select("legiscan_id").distinct().orderBy("legiscan_id")


def _update(due: DataFrame, docs: DataFrame, state: Snapshots, run_ts: datetime, dry_run: bool) -> Report:
    """Full update of the due records; of several documents of one id the one that is last by its text counts."""
    if dry_run:
        return Report(due.count())
    rows = due.select(F.col("legiscan_id").alias("bill_id"), F.lit(0).alias("ord"))
    one = docs.groupBy("bill_id").agg(F.max("doc").alias("doc"), *([F.max("error").alias("error")] if "error" in docs.columns else []))
    try:
        records, bad = split_rejected(state.stage(parsed_candidates(rows, one, F.lit(run_ts))))
        count = records.count()
        patch = records.drop("bill_id")
        version = state.rewrite(patch.select("legiscan_id"), lambda old: U.apply_update(old, patch, F.lit(run_ts)))
        return Report(count, version=version, rejected=_set_apart(state, bad, run_name(run_ts)))
    finally:
        state.unstage()


def backfill(docs: DataFrame, state: Snapshots, run_ts: datetime, dry_run: bool = False) -> Report:
    """Update records that lack their session from their documents; counts records tried."""
    return _update(backfill_targets(state.read()), docs, state, run_ts, dry_run)


def sync_targets(bills: DataFrame, master: DataFrame) -> DataFrame:
    """(legiscan_session_id, legiscan_id) of stored records whose hash differs from the master list's (session_id, bill_id, change_hash)."""
    stored = bills.where("legiscan_session_id is not null and legiscan_id is not null")
    current = master.select(F.col("session_id").alias("legiscan_session_id"), F.col("bill_id").alias("legiscan_id"), "change_hash")
    return R.changed(stored, current, ["legiscan_session_id", "legiscan_id"]).select("legiscan_session_id", "legiscan_id").distinct()


def sync(master: DataFrame, docs: DataFrame, state: Snapshots, run_ts: datetime, dry_run: bool = False) -> Report:
    """Update changed records of all sessions in one plan; counts records tried."""
    return _update(sync_targets(state.read(), master).select("legiscan_id").distinct(), docs, state, run_ts, dry_run)


def store_one(docs: DataFrame, key: int, state: Snapshots, run_ts: datetime) -> Report:
    """Fetch and store one document; RuntimeError if there is none, ValueError if it is rejected. Of several the last by its text counts."""
    found = docs.where((F.col("bill_id") == key) & F.col("doc").isNotNull()).groupBy("bill_id").agg(F.max("doc").alias("doc"))
    try:
        parsed = state.stage(parse_documents(found.withColumn("ord", F.lit(0)), F.lit(run_ts)))
        good, bad = split_rejected(parsed)
        if parsed.isEmpty():
            raise RuntimeError(f"no document for {key}")
        if not bad.isEmpty():
            raise ValueError(bad.first()["reject_reason"])
        inserted, version = _store(state, state.read(), good, F.lit(run_ts))
        return Report(inserted, version=version)
    finally:
        state.unstage()


def resolve_one(found: DataFrame) -> int:
    """The only id of a resolution; ValueError for none, for many, and for one that is no number."""
    rows = found.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("no match" if not rows else "more than one match")
    if rows[0]["bill_id"] is None:
        raise ValueError("the match has no valid id")
    return rows[0]["bill_id"]
