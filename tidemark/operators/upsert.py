"""Set-based upsert that keeps the meaning of a row-by-row store.

*Plan* decides for each incoming row which record it meets; *apply* gives the next snapshot. A row meets the record with its
legiscan_id, else (unless an earlier row of its id was itself inserted) the one with its external_id; rows that meet no record form new
ones by id. A record met again is patched: status, hash and session where not null, external_id where not empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relops import left_lookup, two_key_match
from tidemark.plans.schema import PATCHED, RECORD, WRITTEN


def plan_store(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """One row for each group of incoming rows (columns of the record, and ``ord``) that meet the same record: its columns,
    ``tid`` (the target's id, null for a new record), ``rows`` and ``action`` INSERT or PATCH.

    Of a group the first row gives the record, later rows patch it, the last of each value wins.
    """
    x = two_key_match(incoming.drop("id"), target)
    free = x.where("id_e is null and legiscan_id is not null").groupBy("legiscan_id").agg(F.min("ord").alias("_fi"))
    x = left_lookup(x, free, "legiscan_id")
    tid = F.coalesce("id_l", F.when(F.col("_fi").isNotNull() & (F.col("ord") >= F.col("_fi")), F.lit(None)).otherwise(F.col("id_e")))
    x = x.withColumn("tid", tid)
    group = F.coalesce(
        F.concat(F.lit("T:"), "tid"), F.concat(F.lit("L:"), F.col("legiscan_id").cast("string")),
        F.concat(F.lit("E:"), F.nullif("external_id", F.lit(""))), F.concat(F.lit("R:"), F.col("ord").cast("string")),
    )
    last = lambda c, ok: F.max_by(c, F.when(ok, F.col("ord")))
    cols = []
    for name in WRITTEN:
        if name in PATCHED:
            cols.append(last(name, F.col(name).isNotNull()).alias(name))
        elif name == "external_id":
            cols.append(F.coalesce(last(name, F.coalesce(name, F.lit("")) != ""), F.min_by(name, "ord")).alias(name))
        else:
            cols.append(F.min_by(name, "ord").alias(name))
    out = x.groupBy(group.alias("_group")).agg(F.first("tid").alias("tid"), F.min("ord").alias("ord"), F.count("*").alias("rows"), *cols)
    return out.withColumn("action", F.when(F.col("tid").isNull(), "INSERT").otherwise("PATCH")).drop("_group")


def _patched(target: DataFrame, patch: DataFrame, key: str, columns: tuple[str, ...], run_ts: Column, always: bool) -> DataFrame:
    """Target rows with the patch's non-null values, matched on ``key``; updated_at moves where anything was patched, or ``always`` on a match."""
    p = patch.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit"))
    x = target.join(p, target[key] == p["_k"], "left")
    any_ = F.coalesce(F.col("_hit"), F.lit(False))
    if not always:
        set_ = F.lit(False)
        for c in columns:
            set_ = set_ | F.col(f"_{c}").isNotNull()
        any_ = any_ & set_
    cols = []
    for f in RECORD:
        if f.name in columns:
            cols.append(F.coalesce(F.col(f"_{f.name}"), target[f.name]).alias(f.name))
        elif f.name == "updated_at":
            cols.append(F.when(any_, run_ts).otherwise(target["updated_at"]).alias("updated_at"))
        else:
            cols.append(target[f.name].alias(f.name))
    return x.select(*cols)


def store_parts(target: DataFrame, plan: DataFrame, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """(patches by ``id`` with the legiscan_id of the record they meet, new records) of a plan."""
    patches = plan.where("action = 'PATCH'").drop("legiscan_id")
    names = target.select("id", "legiscan_id", F.col("external_id").alias("_old"))
    patches = patches.withColumnRenamed("tid", "id").join(names, "id")
    patches = patches.withColumn("external_id", F.when((F.coalesce("external_id", F.lit("")) != "") & ~F.col("external_id").eqNullSafe(F.col("_old")), F.col("external_id")))
    new = plan.where("action = 'INSERT'")
    # an id that depends on the row alone: a retried task writes the same one
    made = F.sha2(F.concat_ws("|", F.col("legiscan_id").cast("string"), "external_id", F.col("ord").cast("string"), run_ts.cast("string")), 256)
    url = F.coalesce("url", "legiscan_url")
    cols = {"id": F.substring(made, 1, 32), "created_at": run_ts, "updated_at": run_ts, "full_text": F.lit(None), "url": url}
    return patches, new.select(*[cols.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RECORD])


def patched(target: DataFrame, patches: DataFrame, run_ts: Column) -> DataFrame:
    """Target rows with the patches of a store."""
    return _patched(target, patches, "id", (*PATCHED, "external_id"), run_ts, always=False)


def apply_store(target: DataFrame, plan: DataFrame, run_ts: Column) -> DataFrame:
    """The snapshot after a store: patched records and inserted ones."""
    patches, new = store_parts(target, plan, run_ts)
    return patched(target, patches, run_ts).unionByName(new)


def apply_update(target: DataFrame, patch: DataFrame, run_ts: Column, key: str = "legiscan_id", keep_full_text: bool = False) -> DataFrame:
    """The snapshot after a full update by key: values that are not null overwrite, nulls never do.

    Of several patches of one key the last by ``ord`` counts, where there is one.
    """
    if "ord" in patch.columns:
        names = [c for c in patch.columns if c != key]
        patch = patch.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), "ord").alias("_s")).select(key, "_s.*")
    columns = tuple(c for c in (*WRITTEN, *(("full_text",) if keep_full_text else ())) if c != key)
    return _patched(target, patch.withColumn("url", F.coalesce("url", "legiscan_url")), key, columns, run_ts, always=True)
