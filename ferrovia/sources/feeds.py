"""Static feed (CSV) scans, feed lookup, audit columns and row-count summary."""

from __future__ import annotations

import csv
import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferrovia.schemas import FEED_COLUMNS, feed_schema
from ferrovia.session import first_line

# FIXED VALUES — pandas' default NA tokens (opt-in null tokens for CSV feeds).
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
EXTRA = "_extra_field"
LONG_ROW = "_long_row"
NULL_SENTINEL = "\u0001"


def clean_name(name: str) -> str:
    """Strip a BOM and surrounding blanks from a header name."""
    return name.lstrip("﻿").strip()


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def find_feed_files(spark: SparkSession, root: str, feed: str, first_only: bool = True) -> list[str]:
    """Files of the feed member(s) under ``root`` (any depth).

    A member is a file whose name ends with ``<feed>.txt`` or a directory of
    that name holding part files (a feed landed by a distributed writer, read
    back in parallel).  Listing is metadata only (Hadoop FileSystem API).
    ``first_only`` keeps the first member in path order, like an archive
    lookup.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    it = fs.listFiles(hpath, True)
    members: dict[str, list[str]] = {}
    suffix = f"{feed}.txt"
    while it.hasNext():
        path = it.next().getPath()
        p, name, parent = path.toString(), path.getName(), path.getParent().getName()
        if name.endswith(suffix):
            members.setdefault(p, []).append(p)
        elif parent.endswith(suffix) and not name.startswith(("_", ".")):
            members.setdefault(path.getParent().toString(), []).append(p)
    keys = sorted(members)[:1] if first_only else sorted(members)
    return sorted(f for k in keys for f in members[k])


def empty_feed(spark: SparkSession, feed: str) -> DataFrame:
    return spark.createDataFrame([], feed_schema(feed))


# Feeds whose rows are far too many for unsplittable files; all others may hold
# line breaks within quotes.
SINGLE_LINE_FEEDS = {"stop_times"}
CSV_QUOTING = {"quote": '"', "escape": '"'}   # a quote within quotes is doubled


def header_names(line: str) -> list[str]:
    """The names of a header line, without BOM and surrounding blanks."""
    return [clean_name(c) for c in next(csv.reader([line]), [])]


def read_feed_csv(spark: SparkSession, root: str, feed: str, null_tokens=None,
                  bad_rows: str = "skip_long", ingested_at: str | None = None,
                  first_only: bool = True, multi_line: bool | None = None) -> DataFrame:
    """Read one static feed by header names.

    * expected columns (``schemas.FEED_COLUMNS``) are cast by name with
      ``try_cast`` (dirty value -> NULL); unexpected columns stay strings;
      expected columns missing from the file are added as typed NULLs;
    * every file is read by its own header, so files may order their columns
      differently; names lose a BOM and surrounding blanks;
    * quoted fields may contain commas, doubled quotes and, with ``multi_line``
      (by default for all feeds but ``stop_times``, as such a file can't be
      split), line breaks;
    * rows with *more* fields than the header are dropped, and so are lines whose
      quotes don't close in a feed whose rows are lines (:func:`write_rejected`
      keeps both whole); shorter rows are padded with NULL.  ``bad_rows='keep'`` keeps long rows truncated, and
      ``bad_rows='flag'`` keeps all rows and marks them in ``_long_row``, so a
      caller can count what it drops;
    * ``null_tokens`` (e.g. ``PANDAS_NA_TOKENS``) become NULL; by default only
      empty fields are NULL;
    * ``ingested_at`` (UTC ISO string, default now) is stamped on every row.
    A feed with no file gives an empty frame with the expected schema.
    """
    files = find_feed_files(spark, root, feed, first_only)
    ingested_at = ingested_at or _dt.datetime.now(_dt.timezone.utc).isoformat()
    groups = _header_groups(spark, files)
    if not groups:
        out = empty_feed(spark, feed).withColumn("_ingested_at", F.lit(ingested_at))
        return out.withColumn(LONG_ROW, F.lit(False)) if bad_rows == "flag" else out
    multi_line = feed not in SINGLE_LINE_FEEDS if multi_line is None else multi_line
    parts = [_read_with_header(spark, members, list(names), feed, null_tokens, bad_rows, ingested_at, multi_line)
             for names, members in groups.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


# Why a row of a feed is not read.
TOO_MANY_FIELDS, UNBALANCED = "too many fields", "unbalanced quote"


def _field_names(names: list[str]) -> list[str]:
    # one spare positional column catches rows with more fields than the header
    return [*(f"_c{i}" for i in range(len(names))), EXTRA]


def _split_lines(spark, files: list[str], names: list[str]) -> DataFrame:
    """The lines of files with one header, each with its fields and ``_reason``: the
    reader of feeds whose rows are lines, so that files stay splittable.  A line
    whose quotes don't close would run into the next one: it is not read."""
    lines = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    headers = sorted({first_line(spark, f) for f in files})
    is_header = (F.col("_block") == 0) & F.col("value").isin(headers)
    ddl = ", ".join(f"{n} string" for n in _field_names(names))
    fields = F.from_csv("value", ddl, {**CSV_QUOTING, "nullValue": NULL_SENTINEL, "mode": "PERMISSIVE"})
    open_quote = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    split = lines.select("*", F.when(is_header | (F.trim("value") == ""), F.lit(None)).otherwise(fields).alias("_f"))
    return split.select("value", "_file", "_block", "_id", F.col("_f").isNull().alias("_skip"), "_f.*",
                        F.when(open_quote, UNBALANCED).when(F.col(f"_f.{EXTRA}").isNotNull(), TOO_MANY_FIELDS).alias("_reason"))


def _header_groups(spark, files: list[str]) -> dict[tuple, list[str]]:
    groups: dict[tuple, list[str]] = {}
    for f in files:
        groups.setdefault(tuple(header_names(first_line(spark, f))), []).append(f)
    groups.pop((), None)  # files without a header hold nothing
    return groups


REJECTED = "feed string, file string, line long, reason string, first_field string, raw string"


def write_rejected(spark: SparkSession, root: str, feed: str, path: str, first_only: bool = True,
                   multi_line: bool | None = None) -> DataFrame:
    """The rows of a feed that :func:`read_feed_csv` drops, whole, as a table at
    ``path``: file, line and reason, the first field and the raw text.  Of a
    multi-line feed ``line`` is the record's number in its file, header included."""
    multi_line = feed not in SINGLE_LINE_FEEDS if multi_line is None else multi_line
    out = spark.createDataFrame([], REJECTED)
    for names, files in _header_groups(spark, find_feed_files(spark, root, feed, first_only)).items():
        if multi_line:
            plain = ", ".join(f"_c{i} string" for i in range(len(names)))
            spare = ", ".join(f"{n} string" for n in _field_names(list(names)))
            rows = (spark.read.schema(f"{plain}, _raw string").options(**CSV_QUOTING).option("header", True)
                    .option("multiLine", True).option("mode", "PERMISSIVE").option("columnPruning", False)
                    .option("columnNameOfCorruptRecord", "_raw").csv(files)
                    .select("_c0", F.col("_raw").alias("value"), F.col("_metadata.file_path").alias("_file"),
                            F.lit(0).cast("long").alias("_block"), F.monotonically_increasing_id().alias("_id")))
            long_row = F.from_csv("value", spare, {**CSV_QUOTING, "multiLine": "true", "nullValue": NULL_SENTINEL})[EXTRA].isNotNull()
            rows = rows.withColumn("_reason", F.when(long_row, TOO_MANY_FIELDS))
            first = 2                                    # the header is not among them
        else:
            rows, first = _split_lines(spark, files, list(names)).withColumn(
                "_reason", F.when(~F.col("_skip"), F.col("_reason"))), 1
        # a block's lines are numbered in a row; earlier blocks of its file come before
        blocks = rows.groupBy("_file", "_block").agg(F.min("_id").alias("lo"), F.count("_id").alias("n"))
        earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        start = blocks.select("_file", "_block", "lo", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        bad = rows.where("_reason is not null").join(start, ["_file", "_block"])
        out = out.unionByName(bad.select(
            F.lit(feed).alias("feed"), F.col("_file").alias("file"),
            (F.col("_id") - F.col("lo") + F.col("before") + first).cast("long").alias("line"),
            F.col("_reason").alias("reason"), F.col("_c0").alias("first_field"), F.col("value").alias("raw")))
    out.write.mode("overwrite").parquet(path)
    return spark.read.schema(REJECTED).parquet(path)


def _read_with_header(spark, files, names, feed, null_tokens, bad_rows, ingested_at, multi_line) -> DataFrame:
    if multi_line:
        # the NULL sentinel keeps an empty spare field distinguishable from an
        # absent one (empty data fields become NULL below instead)
        schema = StructType([StructField(n, StringType()) for n in _field_names(names)])
        raw = (spark.read.schema(schema).options(**CSV_QUOTING).option("header", True).option("mode", "PERMISSIVE")
               .option("multiLine", True).option("nullValue", NULL_SENTINEL).csv(files))
        long_row = F.col(EXTRA).isNotNull()
    else:
        raw = _split_lines(spark, files, names).where(~F.col("_skip"))
        long_row = F.col("_reason").isNotNull()
    if bad_rows == "skip_long":
        raw = raw.where(~long_row)
    expected = FEED_COLUMNS.get(feed, {})
    present = {n: f"_c{i}" for i, n in enumerate(names)}
    tokens = sorted(set(null_tokens or []) | {""})

    def value(n):
        c = F.col(present[n])
        return F.when(~c.isin(tokens), c)

    cols = []
    for n, typ in expected.items():
        if n in present:
            c = value(n)
            cols.append((c if typ == "string" else c.try_cast(typ)).alias(n))
        else:
            cols.append(F.lit(None).cast(typ).alias(n))
    cols += [value(n).alias(n) for n in present if n not in expected]
    flag = [long_row.alias(LONG_ROW)] if bad_rows == "flag" else []
    return raw.select(*cols, F.lit(ingested_at).alias("_ingested_at"), *flag)


def land_feed_csv(df: DataFrame, root: str, feed: str) -> str:
    """Write a feed as ``<root>/<feed>.txt/`` part files with headers, keeping
    values verbatim (no blank trimming, quotes doubled)."""
    path = f"{root.rstrip('/')}/{feed}.txt"
    (df.write.mode("overwrite").options(**CSV_QUOTING).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def with_audit(df: DataFrame, name: str, now=None) -> DataFrame:
    """Load / update / refresh audit column (one driver-side clock reading)."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return df.withColumn(name, F.lit(now))


def read_static_feeds(spark: SparkSession, root: str, feeds=None, **kw) -> dict[str, DataFrame]:
    return {f: read_feed_csv(spark, root, f, **kw) for f in (feeds or list(FEED_COLUMNS))}
