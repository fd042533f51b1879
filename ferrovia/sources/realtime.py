"""Realtime feed landing: JSON snapshot documents, batch and streaming scans.

Two landing layouts are supported:

* ``file``  — one document per file named ``<feed>_<yyyyMMddTHHmmssZ>.json``;
  the snapshot stamp comes from the file name (``_metadata.file_name``).
* ``lines`` — JSON lines, each a document carrying its own ``fetched_at``
  field; many snapshots per file, so a landing folder does not explode into
  one tiny file per poll.  Files may be compressed (``.gz``).

Both yield ``(fetched_at, value)`` rows for ``operators.flatten``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferrovia.functions.timeparse import stamp_from_file_name
from ferrovia.session import shuffles_dropped

DOCUMENTS_PER_FILE = 20_000
TEXT_SCHEMA = StructType([StructField("value", StringType())])


def _docs(df: DataFrame, layout: str) -> DataFrame:
    if layout == "file":
        return df.select(stamp_from_file_name(F.col("_metadata.file_name")).alias("fetched_at"), "value")
    if layout == "lines":
        return df.select(F.get_json_object("value", "$.fetched_at").alias("fetched_at"), "value")
    raise ValueError(f"unknown layout {layout!r}")


def read_feed_json(spark: SparkSession, path: str, layout: str = "file") -> DataFrame:
    r = spark.read.format("text")
    if layout == "file":
        r = r.option("wholetext", True)
    return _docs(r.load(path), layout)


def stream_feed_json(spark: SparkSession, path: str, layout: str = "lines",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of ``read_feed_json``: the file source remembers which
    files it has processed (in the query checkpoint), so each lands once."""
    r = spark.readStream.format("text").schema(TEXT_SCHEMA)
    if layout == "file":
        r = r.option("wholetext", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _docs(r.load(path), layout)


def stamped_documents(docs: DataFrame) -> DataFrame:
    """Embed each row's ``fetched_at`` into its JSON document (first field)."""
    head = F.regexp_replace(F.to_json(F.struct("fetched_at")), r"\}$", ",")
    body = F.expr("substring(value, 2)")
    stamped = F.when(F.col("fetched_at").isNull(), F.col("value")).otherwise(F.concat(head, body))
    return docs.select(stamped.alias("value"))


def land_documents(docs: DataFrame, path: str) -> None:
    """Append ``(fetched_at, value)`` documents to a ``lines`` landing folder, in
    files of a bounded number of documents.  They are compressed, as the field names
    of a document are most of it; a file is small enough for a task to read whole."""
    with shuffles_dropped(docs.sparkSession):
        (stamped_documents(docs).write.mode("append").option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
         .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))
