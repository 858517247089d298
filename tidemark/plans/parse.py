"""Nested document to flat record, with rejected rows set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as X
from tidemark.plans.schema import RECORD, REQUIRED


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _explicit_null(v: Column, path: str) -> Column:
    """The key is there, with a null."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(v, path, "variant")), F.lit(False))


def parse_documents(docs: DataFrame, run_ts: Column, column: str = "doc") -> DataFrame:
    """The record's columns plus ``reject_reason``, for JSON documents in ``column``; other columns of ``docs`` stay in front.

    A missing key takes its default; an explicit null of state, session, title or number rejects the row, as does a null session title
    where the year depends on it, and JSON that is no object.
    """
    keep = [c for c in docs.columns if c != column and c not in RECORD.names]
    x = docs.withColumn("_v", F.try_parse_json(column))
    v = F.col("_v")
    no_year = F.coalesce(_text(v, "$.year").isin("", "0", "false"), F.lit(True))
    reason = (
        F.when(v.isNull() | ~F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False)), "not an object")
        .when(_explicit_null(v, "$.state"), "null state")
        .when(_explicit_null(v, "$.session"), "null session")
        .when(no_year & _explicit_null(v, "$.session.session_title"), "null session title")
        .when(_explicit_null(v, "$.title"), "null title")
        .when(_explicit_null(v, "$.bill_number"), "null number")
    )
    key = F.try_variant_get(v, "$.bill_id", "bigint")
    number = F.coalesce(_text(v, "$.bill_number"), F.lit(""))
    chamber = X.first_true(_text(v, "$.chamber"), _text(v, "$.body"))
    day = X.version_day(_text(v, "$.status_date"), _text(v, "$.history[0].date"))
    state = F.upper(F.coalesce(_text(v, "$.state"), F.lit("")))
    site = X.page_url(_text(v, "$.url"), state, key)
    found = {
        "external_id": X.external_id(state, number, day, key),
        "title": F.coalesce(_text(v, "$.title"), F.lit("")),
        "state": state,
        "year": X.year_of(_text(v, "$.year"), _text(v, "$.session.session_title"), F.year(run_ts)),
        "bill_number": number,
        "body": X.body_of(chamber, number),
        "summary": _text(v, "$.description"),
        "url": X.first_true(_text(v, "$.state_link"), site),
        "legiscan_url": site,
        "legiscan_id": key,
        "version_date": day,
        "bill_status": X.status_of(v),
        "change_hash": _text(v, "$.change_hash"),
        "legiscan_session_id": F.try_variant_get(v, "$.session.session_id", "bigint"),
    }
    cols = [found.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD]
    return x.select(*keep, *cols, reason.alias("reject_reason"))


def validated(records: DataFrame) -> DataFrame:
    """``records`` with a ``reject_reason`` where a required column has no value."""
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in REQUIRED])
    return records.withColumn("reject_reason", F.coalesce("reject_reason", missing) if "reject_reason" in records.columns else missing)


def split_rejected(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine). A record without a required value is rejected, too."""
    parsed = validated(parsed)
    return parsed.where("reject_reason is null").drop("reject_reason"), parsed.where("reject_reason is not null")
