"""Per-document sums of values that belong to distinct tokens.

The values are made once per distinct token and joined to the documents' own
token frequencies.  Token frequencies are steep: the tokens that hold at least
one in ``HOT_SHARE`` of all occurrences (at most ``HOT_SHARE`` of them, whatever
the data) are broadcast, and a document's occurrences of them are summed where
the document is read.  Only its rarer tokens are shuffled, one row for each with
its frequency in the document, and joined to the value table.  No token has more
occurrences there than that share of all.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import text_values

HOT_SHARE = 400_000
# A token of more bytes is broadcast as its digest, so that the broadcast's bytes
# are bounded.
HOT_LENGTH = 64
# Distinct tokens, or rows of them, that a task holds before it hands them on.
HELD_TOKENS = 100_000
# Documents that are split at a time.
SLICE = 256

# Tokens are strings or UTF-8.
Split = Callable[[str], list[str] | list[bytes]]


def utf8(token: str | bytes) -> bytes:
    return token.encode("utf-8", "replace") if isinstance(token, str) else token


def frequencies(docs: DataFrame, split: Split) -> DataFrame:
    """(token, occurrences, n) over all documents: all occurrences, and those in
    rows whose column ``counts`` is true.  Counted in each task, then summed."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            for part, counts in enumerate(seen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([utf8(t) for t in counts], pa.binary()), pa.array(counts.values(), pa.int64()),
                     pa.array([n * part for n in counts.values()], pa.int64())], ["token", "occurrences", "n"])
                counts.clear()

        for batch in it:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                for text, counts in zip(text_values(part.column("text")), part.column("counts").to_pylist(), strict=True):
                    seen[bool(counts)].update(split(text))
                if len(seen[0]) + len(seen[1]) > HELD_TOKENS:
                    yield from rows()
        yield from rows()

    made = docs.select("text", "counts").mapInArrow(run, "token binary, occurrences long, n long")
    return made.groupBy("token").agg(F.sum("occurrences").alias("occurrences"), F.sum("n").alias("n"))


def document_sums(docs: DataFrame, split: Split, values: DataFrame, columns: dict[str, str],
                  own: dict[str, Callable[[list[list[bytes]]], list[float]]] | None = None,
                  hot_share: int = HOT_SHARE, decoded: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and for
    each of ``columns`` (name: SQL type) the sum of that column of ``values``
    (token, occurrences, the columns) over the document's tokens, plus what
    ``own`` makes of the document itself (name: function of documents' tokens).
    ``values``, a stored table, holds every token.  ``decoded``: tokens are strings."""
    names = list(columns)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    total = values.agg(F.sum("occurrences").alias("n")).first()["n"] or 0
    is_hot, is_long = F.col("occurrences") * hot_share >= total, F.octet_length("token") > HOT_LENGTH
    key = F.when(is_long, F.unhex(F.sha2("token", 256))).otherwise(F.col("token"))
    hot: tuple[dict, dict] = {}, {}  # by token, by digest
    for r in values.where(is_hot).select(key.alias("key"), is_long.alias("is_long"), *names).collect():
        hot[r["is_long"]][bytes(r["key"])] = tuple(r[c] for c in names)
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    arrow = [pa.float64() if t == "double" else pa.int64() for t in columns.values()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        known, by_digest = shared.value
        if decoded:
            known = {str(t, "utf-8", "replace"): v for t, v in known.items()}
        row = TaskContext.get().partitionId() << 36
        for batch in it:
            whole = pa.struct([("doc_id", batch.column("doc_id").type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                               *zip(names, arrow, strict=True)])
            rare: tuple[list, list[int], list[int]] = [], [], []
            owns: list[tuple[int, dict]] = []

            def rows(whole=whole, rare=rare, owns=owns) -> Iterator[pa.RecordBatch]:
                # One row for each rare token of a document, and one row per document
                # with its own figures.
                yield pa.RecordBatch.from_arrays(
                    [pa.array([utf8(t) for t in rare[0]], pa.binary()), pa.array(rare[1], pa.int64()),
                     pa.array(rare[2], pa.int32()), pa.nulls(len(rare[0]), whole)], fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b"\x00%d" % r for r, _ in owns], pa.binary()), pa.array([r for r, _ in owns], pa.int64()),
                     pa.array([0] * len(owns), pa.int32()), pa.array([o for _, o in owns], whole)], fields)
                for held in (*rare, owns):
                    held.clear()

            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts, keys = text_values(part.column("text")), part.column("doc_id").to_pylist()
                documents = [split(t) for t in texts]
                more = [list(own[c](documents)) if own and c in own else [0] * len(documents) for c in names]
                for k, tokens in enumerate(documents):
                    met = []
                    for t, n in Counter(tokens).items():
                        value = known.get(t)
                        if value is None and by_digest and len(t) > HOT_LENGTH // 4:
                            value = by_digest.get(hashlib.sha256(utf8(t)).digest())
                        if value is None:
                            rare[0].append(t)
                            rare[1].append(row)
                            rare[2].append(n)
                        else:
                            met.append((n, value))
                    owns.append((row, {"doc_id": keys[k], "n_tokens": len(tokens),
                                       "n_bytes": len(texts[k].encode("utf-8", "replace"))}
                                 | {c: more[i][k] + sum(n * v[i] for n, v in met) for i, c in enumerate(names)}))
                    row += 1
                if len(rare[0]) > HELD_TOKENS:
                    yield from rows()
            yield from rows()

    fields = ["token", "row", "times", "own"]
    made = docs.select("doc_id", "text").mapInArrow(
        run, f"token binary, row long, times int, own struct<doc_id:{id_type},n_bytes:long,n_tokens:long,"
             + ",".join(f"{c}:{t}" for c, t in columns.items()) + ">")
    joined = made.join(values.where(~is_hot).select("token", *names), "token", "left")
    return joined.groupBy("row").agg(
        *[F.max(f"own.{c}").alias(c) for c in ("doc_id", "n_bytes", "n_tokens")],
        *[(F.max(f"own.{c}") + F.coalesce(F.sum(F.col("times") * F.col(c)), F.lit(0))).cast(t).alias(c)
          for c, t in columns.items()]).drop("row")
