"""Record and document schemas."""

from __future__ import annotations

from pyspark.sql import types as T

#: Columns of the stored record.
RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("bill_number", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("legiscan_url", T.StringType()),
        T.StructField("legiscan_id", T.LongType()),
        T.StructField("openstates_id", T.StringType()),
        T.StructField("openstates_url", T.StringType()),
        T.StructField("version_date", T.DateType()),
        T.StructField("bill_status", T.StringType()),
        T.StructField("change_hash", T.StringType()),
        T.StructField("legiscan_session_id", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("full_text", T.StringType()),
    ]
)
#: Without these no record is stored.
REQUIRED = ("external_id", "title", "state", "year", "bill_number", "body")
#: Written by an update; ids, stamps and the full text are not.
WRITTEN = tuple(f.name for f in RECORD if f.name not in ("id", "created_at", "updated_at", "full_text"))
#: Patched when a record is met again.
PATCHED = ("bill_status", "change_hash", "legiscan_session_id")
