"""Left join to a dimension too large to broadcast, whose keys are not equally frequent.

A sketch of the most frequent keys, taken in one pass with bounded state,
names the few that hold a large share of the rows.  Only their dimension rows
are broadcast; all other rows are shuffled by key, and no key among them is large.
Rows that the broadcast has served, and rows without a key, take no part in the
shuffled match and are spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that hold more than one part in so many of the rows are split off: at most so many.
FREQUENT_PARTS = 1000
#: Keys that the sketch tracks; its error is far below a part's share.
TRACKED = 100_000


def frequent_keys(rows: DataFrame, columns: list[str]) -> dict[str, list]:
    """Per column, the values that hold over 1/FREQUENT_PARTS of the rows, by one pass and a sketch a column."""
    sketches = [F.expr(f"approx_top_k(`{c}`, {FREQUENT_PARTS}, {TRACKED})").alias(c) for c in columns]
    found = rows.agg(F.count(F.lit(1)).alias("__rows"), *sketches).first()
    total = found["__rows"]
    return {c: [x["item"] for x in found[c] or [] if x["item"] is not None and x["count"] * FREQUENT_PARTS > total] for c in columns}


def spread_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, frequent: list, prefix: str) -> DataFrame:
    """left with the columns of ``right`` (unique in ``right_key``) as the struct ``prefix``; null where there is no match."""
    values = F.struct(*[F.col(c) for c in right.columns])
    hot_key, cold_key, hot, cold, salt, zero = (f"__{prefix}_{n}" for n in ("hot_key", "cold_key", "hot", "cold", "salt", "zero"))
    is_frequent: Column = F.col(right_key).isin(frequent) if frequent else F.lit(False)
    served = right.where(is_frequent).select(F.col(right_key).alias(hot_key), values.alias(hot))
    # the salt is 0 from a column, so that Spark keeps it among the join's keys
    rest = right.where(F.col(right_key).isNotNull() & ~is_frequent).select(
        F.col(right_key).alias(cold_key), F.pmod(F.xxhash64(right_key), F.lit(1)).alias(zero), values.alias(cold))
    out = left.join(F.broadcast(served), F.col(left_key) == F.col(hot_key), "left")
    own = 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    out = out.withColumn(salt, F.when(F.col(hot_key).isNull() & F.col(left_key).isNotNull(), F.lit(0)).otherwise(own).cast("long"))
    out = out.join(rest, (F.col(left_key) == F.col(cold_key)) & (F.col(salt) == F.col(zero)), "left")
    return out.withColumn(prefix, F.coalesce(hot, cold)).drop(hot_key, cold_key, hot, cold, salt, zero)
