"""Column expressions that several native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def starts(items: Column, size: Callable[[Column], Column]) -> Column:
    """array<long>: for each of ``items`` the sum of ``size`` over those before it.

    Sums run within chunks of ``CHUNK`` items and then over the chunks, so the cost grows with the power 1.5 of the
    number of items and not with its square, as appending to one array does.
    """

    def run(part: Column, of: Callable[[Column], Column]) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("starts"))
        return F.aggregate(part, empty, lambda acc, x: F.struct((acc["at"] + of(x)).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")))

    def whole(all_: Column) -> Column:
        last = F.greatest(F.ceil(F.size(all_) / CHUNK).cast("int") - 1, F.lit(0))
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: run(F.slice(all_, i * CHUNK + 1, CHUNK), size))
        return bind(parts, lambda p: F.flatten(F.zip_with(run(p, lambda x: x["at"])["starts"], p, lambda base, x: F.transform(x["starts"], lambda s: s + base))))

    return bind(items, whole)
