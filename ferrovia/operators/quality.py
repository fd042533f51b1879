"""Feed quality checks: emptiness, null profile, per-feed verdicts, batch gate.

Every check is one distributed aggregate per feed — a single pass computing
the row count and each column's null count together — followed by work on
one row per column.  Nothing is collected to the driver.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.functions.metrics import pct_from_counts

# FIXED VALUE — a column more than this percent NULL makes a feed WARN.
NULL_WARN_PCT = 50


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: ``column_name, null_count, row_count, null_pct``."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _null_{i}" for i, c in enumerate(cols))
    long = counts.selectExpr("_n", f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")
    return long.select("column_name", "null_count", F.col("_n").alias("row_count"),
                       pct_from_counts("null_count", "_n").alias("null_pct"))


def validate(df: DataFrame, name: str) -> DataFrame:
    """``name, row_count, max_null_pct, status``: FAIL when empty, WARN when
    any column is more than 50 % NULL, else PASS."""
    prof = null_profile(df)
    one = prof.agg(F.max("row_count").alias("row_count"), F.max("null_pct").alias("max_null_pct"))
    n = F.coalesce(F.col("row_count"), F.lit(0))
    status = (F.when(n == 0, "FAIL").when(F.col("max_null_pct") > NULL_WARN_PCT, "WARN")
              .otherwise("PASS"))
    return one.select(F.lit(name).alias("name"), n.alias("row_count"),
                      F.when(n > 0, F.col("max_null_pct")).alias("max_null_pct"),
                      status.alias("status"))


def verdict(name: str, row_count: int, null_counts: dict[str, int]) -> tuple:
    """The row of :func:`validate`, from counts already taken (e.g. observed while
    the feed was written)."""
    worst = max((Decimal(100 * n) / row_count for n in null_counts.values()), default=Decimal(0)) if row_count else None
    if worst is not None:
        worst = worst.quantize(Decimal("0.01"), ROUND_HALF_UP)
    status = "FAIL" if not row_count else "WARN" if worst > NULL_WARN_PCT else "PASS"
    return name, row_count, worst, status


def check_non_empty(df: DataFrame, name: str) -> DataFrame:
    return df.agg((F.count(F.lit(1)) > 0).alias("ok")).select(F.lit(name).alias("name"), "ok")


def validate_all(feeds: dict[str, DataFrame]) -> DataFrame:
    """Verdict rows for every feed (each feed is still judged on its own)."""
    return reduce(DataFrame.unionByName, [validate(df, name) for name, df in feeds.items()])


def batch_gate(verdicts: DataFrame) -> DataFrame:
    """One row: ``ok`` is false when any feed FAILed."""
    return verdicts.agg(F.coalesce(F.bool_and(F.col("status") != "FAIL"), F.lit(True)).alias("ok"),
                        F.count_if(F.col("status") == "FAIL").alias("failed_feeds"))


def feed_row_counts(feeds: dict[str, DataFrame]) -> DataFrame:
    """``feed, rows`` per feed plus a ``TOTAL`` row; each feed is counted once."""
    per = reduce(DataFrame.unionByName,
                 [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("feed"), "rows")
                  for name, df in feeds.items()])
    return (per.rollup("feed").agg(F.sum("rows").alias("rows"))
            .select(F.coalesce("feed", F.lit("TOTAL")).alias("feed"), "rows"))
