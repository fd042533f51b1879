"""Session construction and shared-folder helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for stamps and date keys, ANSI
# arithmetic (overflow raises instead of wrapping), adaptive execution for
# runtime join re-planning / partition coalescing / skew splitting, and dynamic
# partition overwrite so Gold upserts only rewrite touched date partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ferrovia", extra: dict | None = None,
                initial_partitions: int | None = None,
                advisory_partition_bytes: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the engine's required settings.

    On a cluster, ``initial_partitions`` (AQE's starting shuffle width, e.g.
    input bytes / 128 MB) and ``advisory_partition_bytes`` (the size AQE
    coalesces towards) size shuffles to the data; AQE then merges small
    partitions and splits skewed ones at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    if advisory_partition_bytes:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(advisory_partition_bytes)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable required settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written, or started as a stream, inside deletes its shuffle files as soon
    as it (a stream: each of its batches' writes) ends.  Without it they lie on the disks
    until the driver's garbage is collected, those of many jobs beside each other."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to a shared (HDFS / object store)
    path, and an error says so if it isn't.  Only in local mode is a private
    folder made and registered, so lineage cuts and scratch tables still have a
    home.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = root.get() if root.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ferrovia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem API (works on any store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a folder this engine created (staging tables)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``, sorted."""
    hpath, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(hpath) if f.isFile()) if fs.exists(hpath) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    hpath, fs = _file_system(spark, path)
    return fs.getContentSummary(hpath).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    hpath, fs = _file_system(spark, path)
    fs.mkdirs(hpath)


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """A one-line text file, written whole."""
    hpath, fs = _file_system(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()


def rename_path(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a file; False if the new name is taken."""
    target, fs = _file_system(spark, new)
    return not fs.exists(target) and fs.rename(_file_system(spark, old)[0], target)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (one metadata listing)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(hpath) if f.isDirectory())


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, through the Hadoop FileSystem API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(hpath), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()
