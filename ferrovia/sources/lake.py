"""Parquet lake IO: snapshot sink, Bronze scans and loads, table writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ferrovia.session import child_folders, delete_path, path_exists, scratch_dir
from ferrovia.sources import manifest

MAX_RECORDS_PER_FILE = 5_000_000


def materialize(df: DataFrame, name: str, partition_by: str | list[str] | None = None,
                path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return a scan of it — cuts lineage, and executor loss after the write
    costs a re-read, not a recomputation of the whole upstream plan.

    Partitioned tables are written without a pre-shuffle: each task writes
    the partitions its rows fall in, with files capped at
    ``MAX_RECORDS_PER_FILE`` rows, so a hot partition value is spread over
    as many files as tasks that saw it.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, name)
    parts = [partition_by] if isinstance(partition_by, str) else (partition_by or [])
    w = df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    return spark.read.parquet(path)


def staged(df: DataFrame, name: str, partition_by=None):
    """Context manager: ``materialize`` into a fresh scratch table and delete
    that table on exit (after the caller's writes that read it committed)."""
    from contextlib import contextmanager

    @contextmanager
    def _cm():
        spark = df.sparkSession
        path = scratch_dir(spark, name)
        try:
            yield materialize(df, name, partition_by, path=path)
        finally:
            delete_path(spark, path)
    return _cm()


def write_snapshot(df: DataFrame, root: str, feed: str, stamp: str) -> str:
    """One Parquet folder per feed and snapshot stamp (``snapshot=<stamp>``)."""
    path = f"{root.rstrip('/')}/{feed}/snapshot={stamp}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_latest_snapshot(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The newest snapshot of a feed.  It is found by listing the folder names, so
    older snapshots are neither listed in depth nor read."""
    base = f"{root.rstrip('/')}/{feed}"
    names = [n for n in child_folders(spark, base) if n.startswith("snapshot=")]
    if not names:
        raise FileNotFoundError(base)
    return spark.read.option("basePath", base).parquet(f"{base}/{max(names)}")


def load_bronze_full(df: DataFrame, path: str) -> None:
    """Full refresh: replace the table with the rows given (of one snapshot:
    :func:`read_latest_snapshot`)."""
    df.write.mode("overwrite").parquet(path)


def batch_folder(path: str, source: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/source={source}/batch_id={batch_id}"


def load_bronze_append(df: DataFrame, path: str, batch_id: int | None = None, source: str = "manual") -> None:
    """Append load.  With a ``batch_id`` the batch lands in a folder of its own,
    named by the source (one per checkpoint) and the batch, with overwrite: a
    replayed micro-batch replaces its own earlier attempt, and a new checkpoint,
    which counts from 0 again, never touches what another one has landed."""
    if batch_id is None:
        df.write.mode("append").parquet(path)
    else:
        df.write.mode("overwrite").parquet(batch_folder(path, source, batch_id))


def compact_bronze(spark: SparkSession, path: str, source: str, before: int) -> int:
    """Merge a source's batch folders below ``before`` (see :mod:`.manifest`); gives
    how many.  Run it while no batch below ``before`` can be replayed."""
    return manifest.compact(spark, path, f"source={source}", lambda s, n: n < before)


def compact_facts(spark: SparkSession, path: str, day: int, is_old=lambda source, batch_id: True) -> int:
    """Merge the batch folders of one day of a realtime fact (or of its cells)."""
    return manifest.compact(spark, path, f"fetched_date_key={day}", is_old)


def read_partitions(spark: SparkSession, path: str, column: str, values, schema=None) -> DataFrame | None:
    """The given partitions of a table partitioned by ``column``; None if it has
    none of them.  Only their folders are listed and opened."""
    base = path.rstrip("/")
    wanted = {f"{column}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for v in values}
    names = sorted(wanted.intersection(child_folders(spark, base)))
    if not names:
        return None
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*[f"{base}/{n}" for n in names])


def overwrite_table(df: DataFrame, path: str, partition_by=None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def table_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Scan a table, or an empty frame with ``schema`` when it doesn't exist yet or
    has no row yet."""
    if path_exists(spark, path):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    return spark.createDataFrame([], schema)


def write_sample(df: DataFrame, path: str, n: int = 500) -> None:
    """First ``n`` rows as one CSV file with header (a size-bounded sample)."""
    df.limit(n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
