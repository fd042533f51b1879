"""Merge operators: insert-if-absent, column-subset upsert, build-if-empty.

Parquet tables have no MERGE statement, so merges are expressed as joins:

* insert-if-absent = ``left_anti`` join of the batch against the target's keys.
  SQL equality never matches NULL, so a row with a NULL key is always
  inserted; duplicates *inside* one batch are all inserted.
* upsert = ``full_outer`` join on the keys with presence markers; matched rows
  take the listed update columns from the source and keep every other column
  from the target, unmatched rows come from whichever side has them.

Both are plain DataFrame -> DataFrame functions; the ``*_table`` wrappers add
the IO (scan of the touched partition folders, write to a shared scratch table,
then a dynamic partition overwrite of the touched partitions only).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.session import path_exists
from ferrovia.sources import manifest
from ferrovia.sources.lake import read_partitions
from ferrovia.sources.lake import staged as staged_table

# Columns each Gold upsert refreshes on a key match (the rest keep the stored
# value).  FIXED VALUES — the update lists of the source system's merges.
UPDATE_COLUMNS = {
    "route_daily_performance": [
        "avg_arrival_delay_mins", "avg_departure_delay_mins", "pct_on_time",
        "pct_minor_delay", "pct_moderate_delay", "pct_severe_delay", "max_delay_mins",
        "active_vehicles", "avg_speed_kmh",
    ],
    "stop_delay_hotspot": ["avg_arrival_delay_mins", "pct_on_time", "worst_route"],
    "hourly_network_pattern": ["avg_delay_mins", "pct_on_time", "active_vehicles", "avg_speed_kmh"],
    "operator_weekly_scorecard": [
        "total_delay_obs", "avg_delay_mins", "pct_on_time", "pct_severe_delay",
        "reliability_score", "reliability_band",
    ],
    "delay_trend_daily": [
        "total_observations", "avg_delay_mins", "pct_on_time", "rolling_7d_avg_delay",
        "rolling_7d_pct_on_time",
    ],
}
GOLD_KEYS = {
    "route_daily_performance": ["date_key", "route_id"],
    "stop_delay_hotspot": ["stop_id", "date_key"],
    "hourly_network_pattern": ["date_key", "hour_of_day"],
    "operator_weekly_scorecard": ["week_start_date", "agency_name"],
    "delay_trend_daily": ["date_key"],
    "route_type_summary": ["date_key", "route_type_desc"],
}


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   prune_on: Sequence[str] = ()) -> DataFrame:
    """Source rows whose key has no equal in the target (NULL never equal).

    ``prune_on`` names columns functionally dependent on the keys (e.g. the
    date partition of a timestamp key): target rows with other values than the
    batch has don't take part in the anti join.  A table on disk is read pruned
    by :func:`insert_if_absent_table`.
    """
    tkeys = target.select(*keys, *[c for c in prune_on if c not in keys])
    if prune_on:
        tkeys = tkeys.join(source.select(*prune_on).distinct(), list(prune_on), "left_semi")
    return source.join(tkeys, list(keys) + [c for c in prune_on if c not in keys], "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     prune_on: Sequence[str] = ()) -> DataFrame:
    """Target plus the source rows that are absent from it."""
    return target.unionByName(rows_to_insert(target, source, keys, prune_on))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, stale: str = "refresh") -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    ``stale='keep'`` overwrites only ``update_cols`` on a match (other columns
    keep the stored value, even if the source has a different one);
    ``stale='refresh'`` overwrites every column.  An updated column follows the
    source also when the source value is NULL.  Unmatched source rows are
    inserted whole; unmatched target rows are kept whole.  A NULL key is one
    key like any other, so a repeated refresh doesn't pile up its rows.
    """
    if stale not in ("keep", "refresh"):
        raise ValueError(f"stale must be 'keep' or 'refresh', not {stale!r}")
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    update = set(cols if stale == "refresh" or update_cols is None else update_cols)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_s"))
    cond = None
    for k in keys:
        c = F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}"))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    has_s, has_t = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.when(has_t, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
        elif c in update:
            out.append(F.when(has_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        else:
            out.append(F.when(has_t, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
    return j.select(*out)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (empty when the keys are unique)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` is not unique in ``df`` (one distributed aggregate,
    at most one row brought back)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate merge key {dict(zip(keys, dup[0][:len(keys)]))}")


# ---------------------------------------------------------------------------
# table-level wrappers


def partition_values(source: DataFrame, column: str) -> list:
    """The partition values of a batch: one per touched day, hour or week."""
    return [r[0] for r in source.select(column).distinct().collect()]


def insert_if_absent_table(spark: SparkSession, source: DataFrame, path: str,
                           keys: Sequence[str], partition_by: str | None = None) -> None:
    """Append the batch rows that are absent from the table at ``path``.

    ``partition_by`` is functionally dependent on the keys: the batch's values of
    it (the days of a micro-batch) are collected first, and only those partition
    folders are listed and read.
    """
    if partition_by:
        values = partition_values(source, partition_by)
        if not values:
            return
        target = read_partitions(spark, path, partition_by, values)
    else:
        target = spark.read.parquet(path) if path_exists(spark, path) else None
    # the target file list is fixed when this plan is analysed, so the append
    # below never reads its own output
    new = source if target is None else rows_to_insert(target, source, keys)
    w = new.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def insert_batch(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], partition_by: str,
                 source: str, batch_id: int, schema) -> list:
    """Insert-if-absent for a table of batch folders: the rows whose key no *other*
    batch has, in folders of this batch's own.  Only the folders of the batch's
    partition values are listed and read, and a replay writes the same rows again.
    Gives those values."""
    values = partition_values(rows, partition_by)
    if values:
        target = manifest.read_live(spark, path, schema, [f"{partition_by}={v}" for v in values], (source, batch_id))
        new = rows if target is None else rows_to_insert(target, rows, keys)
        manifest.write_batch(new, path, source, batch_id, partition_by)
    return values


def upsert_table(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None, stale: str = "refresh",
                 partition_by: str | None = None, check_unique: bool = True) -> None:
    """Upsert ``source`` into the Parquet table at ``path``.

    The source is computed once and staged in the shared checkpoint folder;
    the key check and the merge both read the staged copy (no second
    evaluation of an expensive aggregate).  Only the folders of the source's
    partitions are listed, read and rewritten: with dynamic partition
    overwrite the new files go to a staging folder and replace the touched
    partitions only at job commit, after every reading task has finished, so
    a retried task still sees the old files.  An unpartitioned target is
    replaced whole, so its merged rows are staged first.
    """
    with staged_table(source, "upsert-source") as src:
        if check_unique:
            assert_unique(src, keys)
        if partition_by:
            values = partition_values(src, partition_by)
            if not values:
                return
            target = read_partitions(spark, path, partition_by, values)
            _write(src if target is None else upsert(target, src, keys, update_cols, stale), path, partition_by)
        elif not path_exists(spark, path):
            _write(src, path, None)
        else:
            target = spark.read.parquet(path)
            with staged_table(upsert(target, src, keys, update_cols, stale), "upsert-merged") as merged:
                _write(merged, path, None)


def _write(df: DataFrame, path: str, partition_by: str | None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def ensure_built(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Build and write the table only when it does not exist yet."""
    if not path_exists(spark, path):
        builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
