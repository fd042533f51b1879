"""Removal of repeated byte strings by suffix sorting.

Every byte covered by a string of ``size`` bytes that also starts anywhere else
is removed.  Suffixes are sorted in shards, and the work before that brings all
strings that can be equal into one shard and everything else out of it:

1.  Each text is cut into runs of starts whose strings share their minimizer
    (the smallest hash of a short substring, leftmost of equals).  Equal strings
    have equal minimizers at equal places.  A run is known by its minimizer and
    the digest of its bytes; runs that occur twice are repeats as a whole, and
    runs whose minimizer no other run has are unique.
2.  The remaining runs (edges of copied passages) are cut, at fixed distances
    from their minimizer, into blocks of a few starts.  All strings of a block
    share its core, and equal strings lie in blocks of equal cores.  So a block
    shrinks to a few bytes, one symbol for its core, and a few bytes.
3.  Blocks are dealt to shards by core, and each shard's symbols are sorted by
    external induced sorting (:mod:`ferrovia.llm.induced_sort`): a start is a
    repeat if the common prefix with a neighbour in suffix order spans its whole
    string.  A core with more than ``CROWD`` different blocks is not left to one
    task: its strings are counted one by one instead, over all tasks.

Defined cases: a null or empty text has no bytes and keeps none; texts shorter
than ``size`` keep all; a repeated row repeats all strings of its text, so texts
of ``size`` bytes or more that occur twice lose all bytes; strings never cross
texts; an empty table gives an empty result; other input columns are not read.
Bytes are cut, so what is kept need not be valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import drop_stored, stored
from ferrovia.llm.induced_sort import suffixes

SIZE = 400
GRAM = 32
BLOCK = 16
CROWD = 500
# Symbols of a shard.
SHARD = 400_000
# Bits of the filter that picks runs for the second step: 4 MB, whatever the data.
FILTER_BITS = 1 << 25

_RNG = np.random.default_rng(400)
_BYTE = _RNG.integers(0, 2**64, 256, np.uint64)
_STEP = [np.uint64(int(x) | 1) for x in _RNG.integers(0, 2**63, 6)]
_PLACE = np.uint64((1 << 24) - 1)
# A text is cut for hashing into parts of this many bytes that overlap, so that
# places fit their bits.
_PART = 1 << 23


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of each substring of ``GRAM`` bytes, by doubling."""
    h, step = _BYTE[b], 1
    while step < GRAM:
        m = _STEP[step.bit_length() - 1]
        h = h[:-step] * m + (h[step:] ^ (h[step:] >> np.uint64(29)))
        step *= 2
    h = h * _STEP[5]
    return h ^ (h >> np.uint64(32))


def runs(b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's strings of ``size`` bytes: (minimizer, its place, first start,
    last start) of each run."""
    if len(b) < size:
        return (np.empty(0, np.int64),) * 4
    if len(b) > _PART:
        parts = []
        for at in range(0, len(b) - size + 1, _PART - size + 1):
            g, p, a, z = runs(b[at:at + _PART], size)
            parts.append((g, p + at, a + at, z + at))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    w = size - GRAM + 1
    v = gram_hashes(b)
    v = (v & ~_PLACE) | np.arange(len(v), dtype=np.uint64)
    n = len(v) - w + 1
    x = np.concatenate([v, np.full(-len(v) % w, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[w - 1:w - 1 + n])
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [n]]) - 1
    return ((least[first] >> np.uint64(24)).astype(np.int64), (least[first] & _PLACE).astype(np.int64), first, last)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"))


def found_runs(docs: DataFrame, size: int) -> DataFrame:
    """One row per text and distinct run in it: ``gram``, ``digest``, ``key`` (of
    the text), ``starts`` (of each occurrence), ``width`` (last start less first)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "digest", "key", "starts", "width"]
        for batch in it:
            out: tuple[list, ...] = ([], [], [], [], [])

            def rows() -> pa.RecordBatch:
                types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int32()]
                made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                for c in out:
                    c.clear()
                return made

            for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist(), strict=True):
                data = _bytes(text)
                if len(data) < size:
                    continue
                gram, _, first, last = (x.tolist() for x in runs(np.frombuffer(data, np.uint8), size))
                seen: dict[tuple, int] = {}
                for g, a, z in zip(gram, first, last, strict=True):
                    d = xxhash.xxh3_128_digest(data[a:z + size])
                    if (g, d) in seen:
                        out[3][seen[g, d]].append(a)
                        continue
                    seen[g, d] = len(out[0])
                    for c, v in zip(out, (g, d, key, [a], z - a), strict=True):
                        c.append(v)
                if len(out[0]) > 50_000:
                    yield rows()
            yield rows()

    return docs.select("text", "key").mapInArrow(
        run, "gram long, digest binary, key binary, starts array<int>, width int")


def _bit(key: bytes, gram: int, digest: bytes) -> int:
    # From 1 on: Spark's bitmap buckets keep 0 apart.
    return 1 + xxhash.xxh3_64_intdigest(key + digest + gram.to_bytes(8, "little", signed=True)) % FILTER_BITS


def run_blocks(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The blocks of the runs in ``wanted`` (gram, digest, key): ``core`` (a digest
    of minimizer, distance and core), ``left`` and ``right`` of it, ``key`` and
    ``at`` (the start of the core).  The filter is a bitmap of a fixed size; runs
    it lets through by accident are taken out by a join."""
    def marks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            bits = [_bit(k, g, d) for k, g, d in zip(*(batch.column(c).to_pylist() for c in ("key", "gram", "digest")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int64())], ["bit"])

    maps = (wanted.mapInArrow(marks, "bit long")
            .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    chunk = 1 << 15
    bits = np.zeros(FILTER_BITS + 2 * chunk, bool)
    for r in maps:
        own = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
        # Buckets and bits count from 1.
        start = (r["bucket"] - 1) * chunk + 1
        bits[start + chunk - 1:start + chunk - 1 + len(own)] = own
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits[chunk - 1:]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value)
        names = ["gram", "digest", "core", "left", "right", "key", "at"]
        for batch in it:
            out: tuple[list, ...] = tuple([] for _ in names)

            def rows() -> pa.RecordBatch:
                types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
                made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                for c in out:
                    c.clear()
                return made

            for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist(), strict=True):
                data = _bytes(text)
                if len(data) < size:
                    continue
                seen = set()
                for g, p, a, z in zip(*(x.tolist() for x in runs(np.frombuffer(data, np.uint8), size)), strict=True):
                    d = xxhash.xxh3_128_digest(data[a:z + size])
                    if not known[_bit(key, g, d)] or (g, d) in seen:
                        continue
                    seen.add((g, d))
                    for j in range((p - z) // BLOCK, (p - a) // BLOCK + 1):
                        high = p - j * BLOCK          # the last start of the block
                        low = high - BLOCK + 1
                        end = low + size              # of the core
                        core = xxhash.xxh3_128_digest(b"%d,%d," % (g, j) + data[high:end])
                        for c, v in zip(out, (g, d, core, data[max(low, a):high], data[end:min(high, z) + size], key, high),
                                        strict=True):
                            c.append(v)
                if len(out[0]) > 50_000:
                    yield rows()
            yield rows()

    made = docs.select("text", "key").mapInArrow(
        run, "gram long, digest binary, core binary, left binary, right binary, key binary, at int")
    return made.join(wanted.select("gram", "digest", "key"), ["gram", "digest", "key"], "left_semi").drop("gram", "digest")


def _sorted_shards(blocks: DataFrame) -> DataFrame:
    """(key, low, high): starts that repeat, of blocks (core, left, right, key, at)
    that are together with all others of their core."""
    def starts_of(shard: list[tuple]) -> Iterator[tuple]:
        # Equal blocks repeat as a whole; one of them stands for all, and a core
        # without a second block needs no sorting.
        places: dict[tuple, list[tuple]] = {}
        kinds: dict[bytes, int] = {}
        for core, left, right, key, at in shard:
            mine = places.setdefault((core, left, right), [])
            kinds[core] = kinds.get(core, 0) + (not mine)
            mine.append((key, at))
        for (_, left, right), mine in places.items():
            if len(mine) > 1:
                shortest = max(0, BLOCK - 1 - len(right))  # the string of a start must end within
                if shortest <= len(left):
                    for key, at in mine:
                        yield key, at - len(left), at - shortest
        yield from sorted_starts([(*block, *mine[0]) for block, mine in places.items() if kinds[block[0]] > 1])

    def sorted_starts(shard: list[tuple]) -> Iterator[tuple]:
        # Symbols: the end, a separator of each block's own, bytes, cores.
        t, first, cores = [], [], {}
        n = len(shard)
        if not n:
            return
        for k, (core, left, right, _, _) in enumerate(shard):
            first.append(len(t))
            t += [n + 1 + x for x in left]
            t.append(n + 257 + cores.setdefault(core, len(cores)))
            t += [n + 1 + x for x in right]
            t.append(k + 1)
        t.append(0)
        repeat = bytearray(len(t))
        before = 0
        last = None
        for i, common in suffixes(t, BLOCK):
            if before >= BLOCK:
                repeat[last] = repeat[i] = 1
            last, before = i, common
        for (_, left, right, key, at), i in zip(shard, first, strict=True):
            m = len(left)
            # A start at a byte before the core has its string's end in the right.
            hits = [at - m + k for k in range(m + 1) if repeat[i + k] and BLOCK - 1 - (m - k) <= len(right)]
            # Start at - d has d bytes left of the core and BLOCK - 1 - d right of it.
            for lo, hi in _ranges(hits):
                yield key, lo, hi

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, last = [], 0, None

        def rows() -> pa.RecordBatch:
            found = list(starts_of(shard)) if shard else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], ty) for i, ty in enumerate((pa.binary(), pa.int32(), pa.int32()))],
                ["key", "low", "high"])

        for batch in it:
            for x in zip(*(batch.column(c).to_pylist() for c in ("core", "left", "right", "key", "at")), strict=True):
                if held >= SHARD and x[0] != last:
                    yield rows()
                    shard, held = [], 0
                shard.append(x)
                held += len(x[1]) + len(x[2]) + 2
                last = x[0]
        yield rows()

    # Few bytes, but much work for each: the configured number of tasks is kept.
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.select("core", "left", "right", "key", "at").repartition(tasks, "core").sortWithinPartitions("core")
    return dealt.mapInArrow(run, "key binary, low int, high int")


def _ranges(sorted_numbers: list[int]) -> Iterator[tuple[int, int]]:
    lo = hi = None
    for x in sorted_numbers:
        if hi is not None and x == hi + 1:
            hi = x
            continue
        if hi is not None:
            yield lo, hi
        lo = hi = x
    if hi is not None:
        yield lo, hi


def _counted_strings(blocks: DataFrame) -> DataFrame:
    """(key, low, high) of repeated starts, string by string: each is known by its
    core, its distance and its own bytes around the core."""
    distance = F.posexplode(F.sequence(F.lit(0), F.octet_length("left")))
    one = (blocks.select("core", "left", "right", "key", "at", distance.alias("i", "d"))
           .where(F.lit(BLOCK - 1) - F.col("d") <= F.octet_length("right"))
           .select("core", "d", "key", (F.col("at") - F.col("d")).alias("low"),
                   F.expr(f"right(hex(left), 2 * d) || '|' || left(hex(right), 2 * ({BLOCK - 1} - d))").alias("around")))
    one = stored(one.withColumn("string", F.unhex(F.md5(F.concat_ws(",", F.hex("core"), F.col("d").cast("string"), "around"))))
                 .select("string", "key", "low"), "suffix-strings")
    twice = stored(one.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string"), "suffix-twice")
    return one.join(twice, "string").select("key", "low", F.col("low").alias("high"))


def repeated_starts(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(key, spans): for each text (by its md5) the ranges of starts whose string
    of ``size`` bytes starts elsewhere too."""
    docs = _keyed(docs)
    found = stored(found_runs(docs, size), "suffix-runs")
    # Each run with its number of occurrences and one text that has it.
    known = stored(found.groupBy("gram", "digest").agg(F.sum(F.size("starts")).alias("n"), F.min("key").alias("key")),
                   "suffix-known")
    twice = stored(known.where("n > 1").select("gram", "digest"), "suffix-twice")
    whole = (found.join(twice, ["gram", "digest"]).select("key", F.explode("starts").alias("low"), "width")
             .select("key", "low", (F.col("low") + F.col("width")).alias("high")).distinct())
    edges = known.groupBy("gram").agg(F.count("*").alias("d")).where("d > 1").select("gram")
    wanted = stored(known.join(stored(edges, "suffix-edges"), "gram").select("gram", "digest", "key"), "suffix-wanted")
    # Copies of a text give the same blocks; one of each is enough.
    blocks = stored(run_blocks(docs, wanted, size).distinct(), "suffix-blocks")
    crowd = stored(blocks.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core", "n"), "suffix-cores")
    shared = stored(blocks.join(crowd, "core"), "suffix-shared")
    few = _sorted_shards(shared.where(F.col("n") <= CROWD))
    many = _counted_strings(shared.where(F.col("n") > CROWD))
    spans = whole.unionByName(few).unionByName(many).distinct()
    out = stored(spans.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "suffix-spans")
    for x in (found, known, twice, wanted, blocks, crowd, shared):
        drop_stored(x)
    return out


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``removed`` (ranges of bytes,
    maximal, end exclusive) and ``kept`` (the remaining bytes)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    joined = _keyed(docs).join(repeated_starts(docs, size), "key", "left").select("doc_id", "text", "spans")
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = _bytes(text)
                gone: list[list[int]] = []
                for lo, hi in sorted((s["low"], s["high"] + size) for s in spans or ()):
                    if gone and lo <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], hi)
                    else:
                        gone.append([lo, hi])
                at, rest = 0, []
                for lo, hi in gone:
                    rest.append(data[at:lo])
                    at = hi
                rest.append(data[at:])
                sizes.append(len(data))
                removed.append([{"start": lo, "stop": hi} for lo, hi in gone])
                kept.append(b"".join(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"])

    return joined.mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, removed array<struct<start:int,stop:int>>, kept binary")
