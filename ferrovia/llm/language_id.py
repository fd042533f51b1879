"""Language identification by the nearest of several centroids per language.

A text is the vector of its byte 1- to 3-grams (letters in lower case, hashed to
a fixed number of buckets), weighted by sublinear frequency times inverse
document frequency and scaled to length one.  Every language has several
centroids from spherical k-means; a text gets the language of the centroid with
the largest cosine.  A text that is farther from its centroid than nearly all
training texts of that centroid are is marked as rejected.

Document frequencies are counted over all training texts.  The clustering uses
a bounded sample: at most about ``SAMPLE`` different labelled texts per language,
those with the smallest hashes of id and text (a null id is an id like others).

Defined cases: a text that is null or has no letter is ``und`` with score 0;
rows without a label don't train; without any labelled row every text is
``und``; repeated rows are predicted alike; an empty table gives an empty
result; texts of any length are read whole; other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import crc_mod, sampled, text_values

BUCKETS = 1 << 13
CENTROIDS = 4
SAMPLE = 1500
ITERATIONS = 12
# Training texts that rejection would hit, per hundred thousand.
REJECTED = 500
SEED = 11

_LETTER = regex.compile(r"\p{L}")
# Upper-case ASCII to lower case; digits and ASCII marks say nothing about a
# language and become blanks.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def counts(text: str) -> np.ndarray:
    """Occurrences of the text's n-grams per bucket."""
    raw = _FOLD[np.frombuffer((" " + text + " ").encode("utf-8", "replace"), np.uint8)]
    # One blank for each run of them.
    b = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])]
    two = b[:-1] << 8 | b[1:]
    three = two[:-1] << 8 | b[2:]
    out = np.zeros(BUCKETS, np.int64)
    for salt, grams in ((1, b), (2, two), (3, three)):
        h = (grams + np.uint32(salt << 24)) * np.uint32(2654435761)
        out += np.bincount(h >> np.uint32(32 - 13), minlength=BUCKETS)
    return out


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors, one row per text."""
    out = np.empty((len(texts), len(idf)), np.float32)
    for i, t in enumerate(texts):
        out[i] = np.log1p(counts(t)) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts each bucket occurs, and the number of texts.
    Every task hands on one row per bucket at most."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in it:
            for t in text_values(batch.column("text")):
                total[:-1] += counts(t) > 0
                total[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1)), pa.array(total)], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["n"]
    return out[:-1], int(out[-1])


def clustered(x: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids, and the smallest cosine that all but
    ``REJECTED`` in 100,000 members of each have to it."""
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ITERATIONS):
        near = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    cos = x @ c.T
    near = np.argmax(cos, axis=1)
    least = [np.quantile(cos[near == j, j], REJECTED / 1e5) if (near == j).any() else 1.0 for j in range(k)]
    return c, np.array(least)


def sample(docs: DataFrame) -> DataFrame:
    """The rows (doc_id, text, lang) that the clustering reads; of equal rows one."""
    keyed = docs.withColumn("text_key", F.xxhash64("doc_id", "text"))
    return sampled(keyed, "text_key", "lang", SAMPLE).dropDuplicates(["lang", "text_key"]).drop("text_key")


def learn(docs: DataFrame) -> DataFrame:
    """(lang, centroid, least) from rows (doc_id, text, lang): a few rows per
    language.  Returned with the weights as ``(model, idf)``."""
    seen, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + seen)) + 1

    def fit(frame):
        import pandas as pd
        rng = np.random.default_rng(SEED)
        frame = frame.sort_values(["doc_id", "text"])
        c, least = clustered(vectors(frame["text"].tolist(), idf), CENTROIDS, rng)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": list(c.astype(np.float64)), "least": least})

    return sample(docs).groupBy("lang").applyInPandas(fit, "lang string, centroid array<double>, least double"), idf


def predict(docs: DataFrame, model: list, idf: np.ndarray) -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score`` (cosine, 0 to 1)
    and ``rejected``.  ``model`` are the collected rows of :func:`learn`."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    model = sorted(model, key=lambda r: (r["lang"], list(r["centroid"])))
    shared = docs.sparkSession.sparkContext.broadcast(
        ([r["lang"] for r in model], np.array([r["centroid"] for r in model], np.float32).reshape(len(model), len(idf)),
         np.array([r["least"] for r in model]), idf))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, centroids, least, weights = shared.value
        for batch in it:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                part = texts[at:at + 256]
                pred, score, far = ["und"] * len(part), [0.0] * len(part), [True] * len(part)
                asked = [i for i, t in enumerate(part) if langs and has_letter(t)]
                if asked:
                    cos = vectors([part[i] for i in asked], weights) @ centroids.T
                    best = np.argmax(cos, axis=1)
                    for i, j, c in zip(asked, best.tolist(), cos.max(axis=1).tolist(), strict=True):
                        pred[i], score[i], far[i] = langs[j], min(1.0, max(0.0, c)), c < least[j]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), pa.array(pred, pa.string()),
                     pa.array(score, pa.float64()), pa.array([bool(x) for x in far], pa.bool_())],
                    ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, held_out=None) -> DataFrame:
    """Learn from the labelled rows that aren't held out (by default one id in
    four by crc32), predict all."""
    held_out = crc_mod(docs["doc_id"], 4) == 2 if held_out is None else held_out
    train = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    model, idf = learn(train)
    return predict(docs.select("doc_id", "text"), model.collect(), idf)
