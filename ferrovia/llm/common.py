"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.session import delete_path, scratch_dir, shuffles_dropped

# White space between words: blank, tab, line feed, vertical tab, form feed,
# carriage return.  ``bytes.split()`` cuts at exactly these.
JAVA_SPACE = r"[\x20\x09-\x0D]+"
JAVA_WORD = r"[^\x20\x09-\x0D]+"

# Bits of the bitmap that :func:`maybe_among` broadcasts, 64 in a row.
FILTER_BITS = 1 << 24

# A-Z to a-z on UTF-8 bytes; all other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: cuts the lineage with files that outlive a lost executor.  The shuffles
    it took go when it is written."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_paths = (path,)
    return out


def resting_on(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """``df``, which reads these stored tables whenever it is run: they go with it
    when :func:`drop_stored` is called on it."""
    df._stored_paths = tuple(p for t in tables for p in getattr(t, "_stored_paths", ()))
    return df


def maybe_among(rows: DataFrame, key: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose ``key`` may be one of ``ids`` (its column of that name): all
    that are and, of the others, about as many as the share of ``FILTER_BITS`` that
    the ids fill.  With ``left_anti`` the rest: rows that surely aren't.  A bitmap of
    hashes is broadcast, of at most FILTER_BITS / 64 rows however many the ids, so
    ``rows`` are not shuffled."""
    word, bits = fresh("word"), fresh("bits")
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bit = (place % 64).cast("int")
    bitmap = ids.select(F.shiftright(place, 6).alias(word), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias(bits))
    bitmap = bitmap.groupBy(word).agg(F.bit_or(bits).alias(bits))
    return rows.join(F.broadcast(bitmap), (F.shiftright(place, 6) == F.col(word)) & (F.getbit(bits, bit) == 1), how)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by :func:`stored`, or those that a frame rests on, once
    nothing reads them any more."""
    for path in getattr(df, "_stored_paths", ()):
        delete_path(df.sparkSession, path)


def text_values(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def folded_words(text: str) -> list[bytes]:
    """Words between white space, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "replace").translate(LOWER).split()


def whole_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the whole input row as the struct ``row``: an
    operator can hand it on, whatever the names of its columns."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **new) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    return df.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in columns])


def crc_mod(column, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null id: of '')."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def sampled(rows: DataFrame, key: str, by: str, size: int) -> DataFrame:
    """About ``size`` rows for each value of ``by`` (all rows, where there are
    fewer): those whose hash of ``key`` is smallest, up to the share that gives
    that number.  One pass counts, one filters; nothing is sorted."""
    many = [(r[by], r["n"]) for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect() if r["n"] > size]
    if not many:
        return rows
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    limit = F.lit(1 << 30)
    for value, n in many:
        limit = F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(int((1 << 30) * size / n))).otherwise(limit)
    return rows.where(place < limit)


def batches(func: Callable[[pa.RecordBatch], dict], schema: pa.Schema):
    """An Arrow batch function from a function that makes columns of a batch."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cols = func(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip((cols[f.name] for f in schema), schema, strict=True)], schema=schema)
    return run


def fresh(name: str) -> str:
    """A column name that no input column can clash with."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"
