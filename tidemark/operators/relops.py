"""Relational operators of the ingestion model: DataFrame in, DataFrame out, lazy."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalar as X

SPREAD = 1024
RANGES = 256


def min_relevance(df: DataFrame, least: int, column: str = "relevance") -> DataFrame:
    """Rows of at least this relevance; missing counts as 0."""
    return df.where(F.coalesce(F.col(column), F.lit(0)) >= least)


def state_is(df: DataFrame, state: str = "ALL", column: str = "state") -> DataFrame:
    return df if state == "ALL" else df.where(F.col(column) == state)


def candidate_filter(df: DataFrame, existing: DataFrame, raw: bool = True) -> DataFrame:
    """Raw results pass as they are. Formatted ones need a state and a number; ``is_known`` flags those that ``existing`` (key) holds."""
    if raw:
        return df
    named = df.where((F.coalesce("state", F.lit("")) != "") & (F.coalesce("bill_number", F.lit("")) != ""))
    named = named.withColumn("_key", X.number_key(F.upper("state"), F.col("bill_number")))
    known = existing.select(F.col("key").alias("_key"), F.lit(True).alias("is_known")).distinct()
    return named.join(known, "_key", "left").drop("_key").withColumn("is_known", F.coalesce("is_known", F.lit(False)))


def valid_ids(df: DataFrame, column: str = "bill_id") -> DataFrame:
    """Rows whose id is a whole number, as a long."""
    return df.withColumn(column, X.whole_number(F.col(column))).where(F.col(column).isNotNull())


def since(df: DataFrame, day: date | None, column: str = "version_date") -> DataFrame:
    """Rows of this day or later; rows without a date go."""
    return df if day is None else df.where(F.col(column) >= F.lit(day))


def day_split(df: DataFrame, cutoff: date, column: str) -> DataFrame:
    """Counts of rows after the cutoff, up to it, and without a date."""
    part = F.when(F.col(column).isNull(), "none").when(F.col(column) > F.lit(cutoff), "after").otherwise("before")
    return df.groupBy(part.alias("part")).agg(F.count("*").alias("n"))


def existing_of(ids: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Distinct ids that the table holds."""
    return ids.select(key).where(F.col(key).isNotNull()).distinct().join(table.select(key), key, "left_semi")


def new_of(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose id the table does not hold; repeated rows stay."""
    return df.join(existing.select(key), key, "left_anti")


def lookup(df: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Inner lookup of each row's document; rows without one go."""
    return df.join(docs, key)


def changed(stored: DataFrame, current: DataFrame, keys: list[str], value: str = "change_hash") -> DataFrame:
    """Keys on both sides whose hashes differ; a null stored hash is empty, a null current one differs from all."""
    a = stored.select(*keys, X.hash_or_empty(F.col(value)).alias("old_hash"))
    b = current.select(*keys, F.col(value).alias("new_hash"))
    return a.join(b, keys).where(~F.col("old_hash").eqNullSafe(F.col("new_hash")))


def left_lookup(df: DataFrame, by: DataFrame, key: str) -> DataFrame:
    """Left equi-join on ``key``. Rows without a key meet nothing; they are dealt over ``SPREAD`` join keys and not to one task."""
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)).cast("int")).otherwise(F.lit(0))
    return df.withColumn("_spread", spread).join(by.withColumn("_spread", F.lit(0)), [key, "_spread"], "left").drop("_spread")


def two_key_match(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with ``id_l`` and ``id_e``: the target's lowest id by legiscan_id, and by non-empty external_id."""
    by_l = target.where("legiscan_id is not null").groupBy("legiscan_id").agg(F.min("id").alias("id_l"))
    by_e = target.where("coalesce(external_id, '') <> ''").groupBy("external_id").agg(F.min("id").alias("id_e"))
    return left_lookup(left_lookup(df, by_l, "legiscan_id"), by_e, "external_id")


def classify(incoming: DataFrame, stored: DataFrame, key: str, day: str) -> DataFrame:
    """Each incoming row with action INSERT, SKIP (same day) or UPDATE."""
    old = stored.select(F.col(key), F.col(day).alias("_old"), F.lit(True).alias("_there"))
    same = F.col(day).eqNullSafe(F.col("_old"))
    action = F.when(F.col("_there").isNull(), "INSERT").when(same, "SKIP").otherwise("UPDATE")
    return incoming.join(old, key, "left").withColumn("action", action).drop("_old", "_there")


def existing_index(df: DataFrame, key: Column, members: list[str]) -> DataFrame:
    """Each key with its members, ordered by the first of them."""
    return df.groupBy(key.alias("key")).agg(F.sort_array(F.collect_list(F.struct(*members))).alias("members"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def ordered_dedupe(df: DataFrame, key: str, ord_: str) -> DataFrame:
    """Distinct keys with the place of their first occurrence."""
    return df.groupBy(key).agg(F.min(ord_).alias(ord_))


def last_wins(df: DataFrame, key: str, value: str, ord_: str) -> DataFrame:
    """A map: of values with one key the last stays."""
    return df.groupBy(key).agg(F.max_by(value, ord_).alias(value))


def index_counts(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("keys"), F.sum(F.size("members")).cast("long").alias("members"))


def last_run(df: DataFrame, column: str = "updated_at") -> DataFrame:
    return df.agg(F.max(column).alias("last_run"))


def action_counts(df: DataFrame) -> DataFrame:
    """One row: inserted, patched, skipped and all."""
    of = lambda a: F.count_if(F.col("action") == a)
    return df.agg(of("INSERT").alias("inserted"), of("UPDATE").alias("updated"), of("SKIP").alias("skipped"), F.count("*").alias("total"))


def exactly_one(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with exactly one row, and its value."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")


def prefix_limit(df: DataFrame, limit: int | None, ord_: str = "ord") -> DataFrame:
    """The first rows by a dense 0-based place; none for 0, all but the last -n for a negative n."""
    if limit is None:
        return df
    if limit >= 0:
        return df.where(F.col(ord_) < limit)
    total = df.agg((F.count("*") + limit).alias("_most"))
    return df.join(F.broadcast(total), F.col(ord_) < F.col("_most")).drop("_most")


def first_rows(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """``prefix_limit`` of a table in an order of its own: the top rows of each task, or places by ranges for a negative limit."""
    if limit is None:
        return df
    if limit >= 0:
        return df.orderBy(*order).limit(limit)
    return prefix_limit(with_ordinal(df, *order), limit).drop("ord")


def keyset_page(df: DataFrame, key: str, cursor, size: int = 1000) -> DataFrame:
    """The page after the cursor; None starts at the beginning."""
    after = df if cursor is None else df.where(F.col(key) > F.lit(cursor))
    return after.orderBy(key).limit(size)


def offset_page(df: DataFrame, keys: list[str], offset: int, size: int = 1000) -> DataFrame:
    return df.orderBy(*keys).offset(offset).limit(size)


def most_recent(df: DataFrame, day: str, tie: str, k: int) -> DataFrame:
    """The k latest rows, rows without a date last."""
    return df.orderBy(F.desc_nulls_last(day), tie).limit(k)


def with_ordinal(df: DataFrame, *order: str) -> DataFrame:
    """A dense 0-based ``ord``. Rows are dealt into at most ``RANGES`` ranges of the order's first column, whose bounds come from a sample of
    ``RANGES`` of its values; places are counted within ranges and the ranges' sizes are summed before them."""
    first = F.col(order[0])
    bounds = [r[0] for r in df.select(first.alias("_f")).where("_f is not null").distinct().orderBy(F.xxhash64("_f")).limit(RANGES - 1).collect()]
    bounds.sort()
    at = F.lit(0)
    if bounds:
        kind = dict(df.dtypes)[order[0]]
        cuts = F.array(*[F.lit(b).cast(kind) for b in bounds])
        at = F.when(first.isNull(), F.lit(-1)).otherwise(F.aggregate(cuts, F.lit(0), lambda n, b: n + (b <= first).cast("int")))
    dealt = df.withColumn("_range", at)
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))  # RANGES rows at most
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(F.broadcast(before), "_range").withColumn("ord", F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")
