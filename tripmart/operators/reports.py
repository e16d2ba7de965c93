"""Table reports: preview, column profile, row-count summary.

All of them are single aggregations or a top-k, never a collect of the
table: the profile is one ``agg`` whose one-row result is unpivoted (its parts may be
kept by day, see ``streaming.profiles``), and the preview is ``orderBy().limit()`` (a per-task top-k, then a merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a fixed total order (all columns by default)."""
    keys = order_by or df.columns
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in keys]).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, min and max (as text), from one scan."""
    return merged_profile(profile_parts(df), df.columns)


def profile_parts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A row a group (one in all by default) of what a profile needs: rows, and non-nulls, min and max of each column.

    Such rows can be merged again, over any groups.
    """
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        exprs += [F.count(col).alias(f"n{i}"), F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
    return df.groupBy(*(by or [])).agg(*exprs) if by else df.agg(*exprs)


def merged_profile(parts: DataFrame, columns: list[str]) -> DataFrame:
    """The profile from its parts."""
    exprs = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for i in range(len(columns)):
        exprs += [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}"), F.min(f"lo{i}").cast("string").alias(f"lo{i}"), F.max(f"hi{i}").cast("string").alias(f"hi{i}")]
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return parts.agg(*exprs).select(F.inline(F.array(*entries)))


def row_summary(input_rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per output table and as a percentage of the input rows.

    Every count is a one-row aggregate; the input count enters as a scalar
    subquery, so nothing is collected to the driver and nothing is joined.
    """
    base = input_rows.agg(F.count(F.lit(1))).scalar()
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    pct = F.try_divide(F.col("rows").cast("decimal(20,0)") * F.lit(100), base)
    return out.select("table", "rows", pct.try_cast("decimal(9,4)").alias("pct_of_input"))
