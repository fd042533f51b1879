"""Near-duplicates by MinHash bands, odd sketches and exact confirmation.

A document's set is its distinct five-word shingles.  Documents of equal sets
form a class; only one member of a class goes on.  225 MinHash samples give 45
bands of five (a pair of similarity 0.75 shares no band with a probability of
five in a million) and are folded into an odd sketch: a bitmap of 512 parities
in which each sample flips one bit.  The XOR of two sketches has as many bits
as the samples differ in, so its population count estimates a high similarity
within a few hundredths.

Candidates are checked against one center of their bands first (one pair per
document, never all pairs).  Members of a band that are still in different
components then are compared with each other in two steps.  A parity bitmap of
the whole shingle set gives a sure bound: its XOR has at most as many bits as the
sets differ in, so a pair with too many can't be similar.  Members for which the
bands hold no partner within estimate and bound go (a semi-join: no pairs leave
it); only those that stay bring their full sets into a join that confirms.
Components are built from confirmed links.

Defined cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; a text of fewer than five words is one shingle;
repeated rows fall into one class; rows whose doc_id is null are linked with
nothing and kept; an empty table gives an empty result; other input columns
are not read.  A doc_id of any type that has an order is taken, and to name one
text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import drop_stored, folded_words, maybe_among, resting_on, stored, text_values
from ferrovia.llm.graph import components, roots_of

SHINGLE = 5
BANDS, ROWS = 45, 5
SAMPLES = BANDS * ROWS
BITS = 512
# 75 of 100; links are confirmed on integers.
SIMILARITY = 75
# Pairs estimated below this are no candidates.  The samples and the collisions of
# their bits both spread the estimate, so the gate stands well under 0.75.
LEAST_ESTIMATE = 0.5
# Bits of the parity bitmap of a whole set; its bound is sharp up to some 3,000 shingles.
FOLD_BITS = 2048
# Words whose hashes a worker keeps.
KEPT_WORDS = 400_000

_RNG = np.random.default_rng(20240607)
_XOR = _RNG.integers(0, 2**64, SAMPLES, np.uint64)
_MUL = _RNG.integers(0, 2**64, SAMPLES, np.uint64) | np.uint64(1)
_STEP = [np.uint64(x | 1) for x in _RNG.integers(0, 2**64, SHINGLE, np.uint64)]
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D) ^ (x >> np.uint64(33))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = folded_words(text)
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    width = min(SHINGLE, n)
    x = np.full(n - width + 1, width, np.uint64) * _GOLD
    for k in range(width):
        x += h[k:n - width + 1 + k] * _STEP[k]
        x ^= x >> np.uint64(29)
    return np.unique(mixed(x))


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, samples) minima; all sets hold something."""
    out = np.empty((len(sets), SAMPLES), np.uint64)
    at = 0
    while at < len(sets):
        # Blocks that fit a processor's cache.
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 32768):
            size += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at:end - 1])])
        for i in range(SAMPLES):
            out[at:end, i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], starts)
        at = end
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """(documents, bands) keys; a key belongs to its band."""
    m = minima.reshape(len(minima), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD
    for r in range(ROWS):
        key = mixed(key + m[:, :, r])
    return key.view(np.int64)


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """(documents, BITS / 64) parities of the samples."""
    n = len(minima)
    bit = (mixed(minima + np.arange(SAMPLES, dtype=np.uint64) * _GOLD) >> np.uint64(64 - 9)).astype(np.int64)
    flat = (np.arange(n)[:, None] * BITS + bit).ravel()
    odd = (np.bincount(flat, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.packbits(odd, axis=1).view(np.int64).reshape(n, BITS // 64)


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``digest`` of the set,
    ``bands`` and ``sketch`` (empty for an empty set)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_shingles", "digest", "bands", "sketch"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = text_values(batch.column("text"))
            for at in range(0, len(texts), 512):
                sets = [shingle_set(t) for t in texts[at:at + 512]]
                full = [s for s in sets if len(s)]
                bands, sketch = [None] * len(sets), [None] * len(sets)
                if full:
                    minima = min_hashes(full)
                    keys, parities = iter(band_keys(minima)), iter(odd_sketches(minima))
                    bands = [next(keys) if len(s) else None for s in sets]
                    sketch = [next(parities) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))], names)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_shingles long, digest binary, bands array<long>, sketch array<long>")


def parities(shingles: np.ndarray) -> np.ndarray:
    """(FOLD_BITS / 64) words: the parities of the shingles whose hashes fall on each bit."""
    places = (shingles >> np.uint64(64 - FOLD_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=FOLD_BITS) & 1).astype(np.uint8)).view(np.int64)


def full_sets(docs: DataFrame) -> DataFrame:
    """(rep, shingles, fold) of each document: its set and the set's parities."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = text_values(batch.column("text"))
            for at in range(0, len(texts), 512):
                sets = [shingle_set(t) for t in texts[at:at + 512]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(sets)),
                     pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                     pa.array([parities(x) for x in sets], pa.list_(pa.int64()))],
                    ["rep", "shingles", "fold"])

    return docs.select("doc_id", "text").mapInArrow(run, f"rep {id_type}, shingles array<long>, fold array<long>")


def _bits_apart(a, b, bits: int):
    """In how many bits two bitmaps (columns) differ."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, bits // 64)),
               F.bit_count(a[0].bitwiseXOR(b[0])))


def estimate(a, b):
    """Estimated similarity of two sketches (columns)."""
    differ = _bits_apart(a, b, BITS)
    # The number of samples that differ, from the number of odd parities.
    inside = F.greatest(F.lit(1.0) - 2.0 * differ / BITS, F.lit(1e-9))
    return F.lit(1.0) + F.lit(BITS / (4.0 * SAMPLES)) * F.log(inside)


def _similar(a: str, b: str):
    """Whether two columns of full sets are similar enough."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= SIMILARITY * (F.size(a) + F.size(b) - both)


def possible(n_a, n_b, fold_a, fold_b):
    """Whether sets of these sizes and parities can be similar enough.  Sets that
    differ in d shingles have a similarity of (n - d) / (n + d), n being both sizes
    together, and d is at least the number of parities that differ.  True for every
    similar pair."""
    n, least = n_a + n_b, _bits_apart(fold_a, fold_b, FOLD_BITS)
    return 100 * (n - least) >= SIMILARITY * (n + least)


def _sets_of(ids: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """(rep, shingles, fold) of the documents with these ids (column ``rep``).  Texts
    that can't be among them are left out before the join shuffles any."""
    ids = ids.select(F.col("rep").alias("doc_id")).distinct()
    members = maybe_among(docs, "doc_id", ids).join(ids, "doc_id", "left_semi")
    return stored(full_sets(members).dropDuplicates(["rep"]), name)


def _having_partner(rows: DataFrame, partners: DataFrame, may) -> DataFrame:
    """The rows for which their band holds a partner that ``may`` holds for."""
    band = F.col("of_band")
    return rows.join(partners.withColumnRenamed("band", "of_band"), (F.col("band") == band) & may, "left_semi")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest
    doc_id that links lead to, itself included)."""
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs), "near-signed")
    # One representative for each set; equal sets have equal bands and sketches.
    banded = stored(signed.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "near-banded")
    found = stored(signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")),
                   "near-found")
    drop_stored(signed)
    rows = banded.select("rep", F.explode("bands").alias("band"))
    shared = stored(rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "near-bands")
    crowd = stored(rows.join(shared, "band"), "near-crowd")
    # A band's center is its member with the most company in all its bands: of a
    # family of near copies, one that was changed little.  (weight, id) orders them.
    weights = crowd.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighted = stored(crowd.join(weights, "rep").select("band", "rep", "weight"), "near-weighted")
    reps = stored(banded.select("digest", "rep", "sketch"), "near-reps")
    for x in (shared, crowd, banded):
        drop_stored(x)
    centers = stored(weighted.groupBy("band").agg(F.min(F.struct((-F.col("weight")).alias("w"), "rep")).alias("m"))
                     .select("band", F.col("m.rep").alias("center"), (-F.col("m.w")).alias("center_weight")), "near-centers")
    starred = stored(weighted.join(centers, "band").select("band", "rep", "center", "center_weight"), "near-starred")
    drop_stored(weighted)
    drop_stored(centers)
    ka = reps.select(F.col("rep").alias("u"), F.col("sketch").alias("a"))
    kb = reps.select(F.col("rep").alias("v"), F.col("sketch").alias("b"))
    likely = estimate(F.col("a"), F.col("b")) >= LEAST_ESTIMATE

    # First each document against the center that most of its bands have: one
    # pair.  Centers come later in the order, so the links form a forest.
    star = (starred.where("rep != center").groupBy("rep", "center", "center_weight").agg(F.count("*").alias("n"))
            .groupBy("rep").agg(F.min(F.struct(-F.col("n"), -F.col("center_weight"), "center")).alias("m"))
            .select(F.col("rep").alias("v"), F.col("m.center").alias("u")))
    near = stored(star.join(ka, "u").join(kb, "v").where(likely).select("u", "v"), "near-pairs")
    sets = _sets_of(near.select(F.explode(F.array("u", "v")).alias("rep")), docs, "near-sets")
    links = stored(near.join(sets.select(F.col("rep").alias("u"), F.col("shingles").alias("x")), "u")
                   .join(sets.select(F.col("rep").alias("v"), F.col("shingles").alias("y")), "v")
                   .where(_similar("x", "y")).select("u", "v"), "near-links")
    first = roots_of(links.select(F.col("v").alias("node"), F.col("u").alias("root")))

    # Then, in bands whose members are not in one component yet, each member
    # outside the center's component against all the others: first whether any of
    # them can be similar, then confirmed at once; only links leave the join.
    root = lambda name: first.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    placed = stored(starred.join(root("rep"), "rep", "left").join(root("center"), "center", "left").select(
        "band", "rep", F.coalesce("rep_root", "rep").alias("comp"),
        F.coalesce("center_root", "center").alias("center_comp")), "near-placed")
    apart = stored(placed.where("comp != center_comp").select("band", "rep", "comp"), "near-apart")
    tables = [starred, near, sets, links, placed, apart]
    roots = first
    if not apart.isEmpty():
        others = stored(placed.join(apart.select("band").distinct(), "band", "left_semi").select("band", "rep", "comp"),
                        "near-others")
        known = _sets_of(others, docs, "near-known")
        light = known.select("rep", F.size("shingles").alias("n"), "fold")
        side = lambda rows, name, k, x: (
            rows.select("band", F.col("rep").alias(name), F.col("comp").alias(f"{name}_comp")).join(k, name)
            .join(light.select(F.col("rep").alias(name), F.col("n").alias(f"n{x}"), F.col("fold").alias(f"fold{x}")), name))
        left = stored(side(others, "u", ka, "a"), "near-left")
        right = stored(side(apart, "v", kb, "b"), "near-right")
        may = ((F.col("u_comp") != F.col("v_comp")) & likely
               & possible(F.col("na"), F.col("nb"), F.col("folda"), F.col("foldb")))
        near_right = stored(_having_partner(right, left, may), "near-right")
        near_left = stored(_having_partner(left, near_right, may), "near-left")
        sets_for = lambda name, x: known.select(F.col("rep").alias(name), F.col("shingles").alias(x))
        more = stored(near_left.join(sets_for("u", "x"), "u").join(near_right.join(sets_for("v", "y"), "v"), "band")
                      .where(may & _similar("x", "y"))
                      .select(F.least("u_comp", "v_comp").alias("u"), F.greatest("u_comp", "v_comp").alias("v")).distinct(),
                      "near-more")
        tables += [others, known, left, right, near_left, near_right, more]
        if not more.isEmpty():
            merged = components(more)
            tables.append(merged)
            joined = merged.withColumnRenamed("root", "top")
            roots = (first.join(joined.withColumnRenamed("node", "root"), "root", "left")
                     .select("node", F.coalesce("top", "root").alias("root"))
                     .unionByName(joined.select("node", F.col("top").alias("root"))))

    tops = stored(reps.select("digest", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                  .select("digest", "rep", F.coalesce("root", "rep").alias("top")), "near-tops")
    lowest = stored(tops.groupBy("top").agg(F.min("rep").alias("class_root")), "near-lowest")
    classes = stored(tops.join(lowest, "top").select("digest", "class_root"), "near-classes")
    for x in (*tables, first, reps, tops, lowest):
        drop_stored(x)
    return resting_on(found.join(classes, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("class_root", "doc_id").alias("component_id")), found, classes)
