"""Quality scores by Bradley-Terry pairwise ranking.

Labelled texts give preference pairs: a good text is preferred to a bad one.
The score of a text is linear in its features, and the model is fitted to the
pairs by logistic loss on feature differences; nothing but differences is seen,
so the model ranks.  The share of bad texts among the training labels then
picks the quantile of the training scores that becomes the threshold, and a
logistic curve through it makes the score lie between 0 and 1.

The fit uses a bounded sample: about ``SAMPLE`` labelled texts of each class,
those with the smallest hashes of their ids, and ``PAIRS`` pairs drawn from them.
The threshold and the spread of the scores are taken from the scores of all
labelled training rows, by histograms that are summed over the tasks.

Defined cases: a null or empty text has the features of no words and is scored
by them; rows without a label, or with a label other than 0 and 1, don't train;
with labels of one class only, every score is 0.5; repeated rows are scored
alike; an empty table gives an empty result; texts of any length are read whole;
other input columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import crc_mod, drop_stored, sampled, stored, text_values

SAMPLE = 4000
PAIRS = 60_000
PENALTY = 1e-3
STEPS = 300
THRESHOLD = 0.3
SEED = 5
# Bins of the histograms that find the threshold.
BINS = 10_000

# Classes of bytes whose shares are features.
_KIND = np.zeros(256, np.int64)
for _kind, _bytes in enumerate((b"#*$%&|<>", b"!?", b".,;:", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                b"abcdefghijklmnopqrstuvwxyz", b" \t", b"\n\r", b"@/\\=_+~^{}[]()\"'-"), start=1):
    _KIND[list(_bytes)] = _kind
_KINDS = 10
FEATURES = _KINDS + 9


def features(text: str) -> np.ndarray:
    """Shares and logarithms that describe how a text is made."""
    data = text.encode("utf-8", "replace")
    out = np.zeros(FEATURES)
    shares = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=_KINDS) / max(1, len(data))
    out[:_KINDS] = np.sqrt(shares)
    words = data.split()
    n = len(words)
    if n:
        counts = Counter(words)
        same = sum(map(bytes.__eq__, words, words[1:]))
        pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
        lines = [x for x in data.split(b"\n") if x.strip()]
        out[_KINDS:] = (np.log1p(n) / 10, min(1.0, n / 20), sum(map(len, words)) / n / 20, same / n, len(counts) / n,
                        pairs / max(1, n - 1), max(counts.values()) / n, 1 - len(set(lines)) / max(1, len(lines)),
                        sum(x.rstrip()[-1:] in (b".", b"!", b"?", b'"') for x in lines) / max(1, len(lines)))
    return out


def fitted(good: np.ndarray, bad: np.ndarray, rng) -> np.ndarray:
    """Weights that minimise the mean logistic loss of the pairs, by gradient
    descent with momentum."""
    d = good[rng.integers(0, len(good), PAIRS)] - bad[rng.integers(0, len(bad), PAIRS)]
    w, v = np.zeros(d.shape[1]), np.zeros(d.shape[1])
    step = 4 / (np.square(d).sum(axis=1).mean() + 1e-9)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        v = 0.9 * v + (d * p[:, None]).mean(axis=0) - PENALTY * w
        w = w + step * v
    return w


def with_features(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``x``, the features of ``text``."""
    kinds = dict(docs.dtypes)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = [features(t) for t in text_values(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(x, pa.list_(pa.float64()))],
                                             [*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", x array<double>")


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """The model from training texts (doc_id, text) and labels (doc_id, label).
    The labels are drawn first, so only texts of the sample are brought to them; of
    equal rows one is brought, and of ids with many texts a share of them."""
    sample = sampled(labels, "doc_id", "label", SAMPLE)
    texts = (docs.join(F.broadcast(sample), "doc_id").withColumn("text_key", F.xxhash64("doc_id", "text"))
             .dropDuplicates(["label", "text_key"]))
    rows = with_features(sampled(texts, "text_key", "label", 2 * SAMPLE), "label", "doc_id").collect()
    rows.sort(key=lambda r: (r["label"], str(r["doc_id"]), r["x"]))
    good = np.array([r["x"] for r in rows if r["label"] == 1])
    bad = np.array([r["x"] for r in rows if r["label"] == 0])
    if not len(good) or not len(bad):
        return {}
    both = np.concatenate([good, bad])
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    rng = np.random.default_rng(SEED)
    w = fitted((good - centre) / scale, (bad - centre) / scale, rng)
    return {"w": w / scale, "shift": float(centre @ (w / scale))}


def ranked(scores: DataFrame, k: int) -> float:
    """The value of ``z`` that has ``k`` smaller or equal ones before it in sorted
    order: histograms are summed until the one bin that holds it is small."""
    low, high = scores.agg(F.min("z"), F.max("z")).first()
    while low < high:
        place = F.least(F.floor((F.col("z") - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        bins = scores.groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["b"]):
            if k < r["n"]:
                break
            k -= r["n"]
        scores, low, high = scores.where(place == r["b"]), r["low"], r["high"]
        if r["n"] <= BINS:
            return sorted(x["z"] for x in scores.collect())[k]
    return low


def threshold(scores: DataFrame, known: DataFrame) -> tuple[float, float]:
    """The cut below which as many of all labelled training rows fall as are bad,
    and half the deviation of their scores."""
    mine = stored(scores.join(known, "doc_id").select("z", "label"), "preference-labelled")
    n, bad, spread = mine.agg(F.count("*"), F.count_if(F.col("label") == 0), F.stddev_pop("z")).first()
    cut = (ranked(mine, bad - 1) + ranked(mine, min(bad, n - 1))) / 2
    drop_stored(mine)
    return cut, spread / 2 + 1e-9


def score(docs: DataFrame, labels: DataFrame, held_out=None) -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from
    ``THRESHOLD`` on).  ``labels`` has (doc_id, quality); ids for which
    ``held_out`` (a function of the id column, by default one in five by crc32)
    is true don't train."""
    held_out = held_out or (lambda doc_id: crc_mod(doc_id, 5) == 0)
    # A text with two labels counts once for each.
    known = (labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .select("doc_id", F.col("quality").cast("int").alias("label")).distinct())
    model = learn(docs.select("doc_id", "text"), known)
    if not model:
        return docs.select("doc_id", F.lit(0.5).alias("score"), F.lit(int(THRESHOLD <= 0.5)).alias("predicted"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in it:
            x = np.array([features(t) for t in text_values(batch.column("text"))]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x @ m["w"] - m["shift"])], ["doc_id", "z"])

    scores = stored(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, z double"), "preference")
    cut, spread = threshold(scores, known)
    z = (F.col("z") - F.lit(cut)) / F.lit(spread) + F.lit(float(np.log(THRESHOLD / (1 - THRESHOLD))))
    scored = scores.select("doc_id", (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
