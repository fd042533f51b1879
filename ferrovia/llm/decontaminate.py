"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the 13-word windows of the benchmark items (an item of fewer
words is one window).  All patterns of one length form one searcher: a shift
table over blocks of three words tells how far the search may jump, the last
block of a pattern selects the bucket of test strings, and each of them is
compared word by word.  An unrelated text is looked at only every eleventh
word.

Benchmark items are dealt to blocks of a bounded number of bytes; one block at
a time is broadcast and searched against all documents.  Beyond one block the
hits so far travel with the documents through a stored table.

Defined cases: a null or empty text has no words and no hits; an item without
words has no windows; repeated items count once per item_id, a null item_id
as ''; repeated document rows give one row each; an empty benchmark gives no
hits; other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import drop_stored, stored, text_values

WINDOW = 13
BLOCK_WORDS = 3
# Bytes of benchmark text that one broadcast may hold.
BLOCK_BYTES = 32 * 1024 * 1024

# Lower-cases A-Z and turns every other ASCII character that isn't a letter or
# a digit into a blank; bytes of longer characters are word characters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


class WuManber:
    """Search of many word sequences of one length."""

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.m = m = len(patterns[0])
        self.b = b = min(BLOCK_WORDS, m)
        self.jump = m - b + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[tuple]] = {}
        for p in patterns:
            for end in range(b, m + 1):
                block = p[end - b:end]
                self.shift[block] = min(self.shift.get(block, self.jump), m - end)
            self.bucket.setdefault(p[m - b:], []).append(p)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """(start, pattern) of every occurrence."""
        m, b, n, jump = self.m, self.b, len(words), self.jump
        shift, bucket = self.shift, self.bucket
        i = m
        while i <= n:
            block = tuple(words[i - b:i])
            s = shift.get(block, jump)
            if s:
                i += s
                continue
            window = None
            for p in bucket[block]:
                if p[0] == words[i - m]:
                    window = window or tuple(words[i - m:i])
                    if p == window:
                        yield i - m, p
                        break  # equal patterns are one
            i += 1


class Index:
    """The searchers of a block of items and the items of each pattern."""

    def __init__(self, items: list[tuple[str, str]]):
        self.items: dict[tuple, set[str]] = {}
        for item_id, text in items:
            words = item_words(text)
            width = min(WINDOW, len(words))
            for i in range(len(words) - width + 1) if words else ():
                self.items.setdefault(tuple(words[i:i + width]), set()).add(item_id)
        by_length: dict[int, list[tuple]] = {}
        for p in self.items:
            by_length.setdefault(len(p), []).append(p)
        self.searchers = [WuManber(ps) for _, ps in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        spans, ids = [], set()
        for s in self.searchers:
            for start, p in s.find(words):
                spans.append((start, start + s.m))
                ids |= self.items[p]
        return spans, ids


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, non-touching spans that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_SPANS = "array<struct<start:int,stop:int>>"
_INDEXES: dict[int, Index] = {}


def _index_of(shared) -> Index:
    """Built once per worker and broadcast."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared.value)
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(shared.value)
    return _INDEXES[key]


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES,
                  keep_row: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``spans`` (word
    positions of the hits, merged), ``item_ids`` (sorted) and, with ``keep_row``,
    the input's column ``row``."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"),
                             F.coalesce(F.col("text"), F.lit("")).alias("t"))
    size = items.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    n_blocks = int(size // block_bytes) + 1
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    row = ["row"] if keep_row else []
    names = ["doc_id", "text", "n_words", "spans", "item_ids", *row]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def search(shared, keep_text: bool):
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index_of(shared)
            for batch in it:
                before = batch.column("spans").to_pylist(), batch.column("item_ids").to_pylist()
                count, spans, ids = [], [], []
                for text, old, old_ids in zip(text_values(batch.column("text")), *before, strict=True):
                    words = item_words(text)
                    new, new_ids = index.hits(words)
                    count.append(len(words))
                    spans.append([{"start": a, "stop": b}
                                  for a, b in merged([(s["start"], s["stop"]) for s in old] + new)])
                    ids.append(sorted(new_ids.union(old_ids)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"),
                     batch.column("text") if keep_text else pa.nulls(len(count), pa.string()),
                     pa.array(count, pa.int64()), pa.array(spans, span_type),
                     pa.array(ids, pa.list_(pa.string())), *[batch.column(c) for c in row]], names)
        return run

    df = docs.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                     F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("item_ids"), *row)
    out = f"doc_id {id_type}, text string, n_words long, spans {_SPANS}, item_ids array<string>"
    out += "".join(f", row {docs.schema['row'].dataType.simpleString()}" for _ in row)
    for k in range(n_blocks):
        mine = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == k)
        shared = spark.sparkContext.broadcast([(r["i"], r["t"]) for r in mine.collect()])
        last = k == n_blocks - 1
        found = df.mapInArrow(search(shared, not last), out)
        if not last:
            found = stored(found, "decontaminate")
        df = found
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]))
    return df.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "item_ids", *row)


def is_contaminated(n_hit, n_words):
    """A twentieth of the words or more lie in benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


__all__ = ["Index", "WuManber", "contamination", "drop_stored", "is_contaminated", "item_words", "merged"]
