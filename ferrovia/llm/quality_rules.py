"""Line-first cleaning, in DataFrame functions only.

Every line with a word is judged by itself: too many symbols or shouted words
(punctuation rule), separators of a menu (navigation rule), stock phrases of
web pages (boilerplate rule).  Failing lines are removed; a document that
loses too much text is rejected.

Defined cases: a null or empty text has no words and is rejected; lines
without words are kept as they are and count for nothing; repeated rows are
judged alike, one row out per row in; an empty table gives an empty result;
other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import JAVA_SPACE, JAVA_WORD

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A document is rejected when more of its line characters than this are lost.
MAX_LOST_PERCENT = 30
# Stock phrases: a line that holds one of them is not text of the document.
BOILERPLATE = (r"(?i)(lorem ipsum|enable javascript|javascript is (?:disabled|required)|uses cookies|"
               r"cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|"
               r"click here to|subscribe to our newsletter|sign up for our|share on (?:facebook|twitter))")
NAVIGATION = r" [|»›·] |^[|»›·] | [|»›·]$"


def _repeat_words(words: Column, hashes: Column, ordered: Column, places: Column):
    """Steps that count the words in windows found twice or more: the hashes of
    the windows; (hash, place) sorted, only where a hash repeats; the places of
    repeated windows in text order; the length of their union."""
    n = F.size(words)
    window = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    step1 = F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))
    step2 = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                   F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    at = lambda j: F.get(ordered, j)["h"]
    twice = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                     lambda j: (at(j) == at(j - 1)) | (at(j) == at(j + 1)))
    step3 = F.when(ordered.isNotNull(),
                   F.sort_array(F.transform(twice, lambda j: F.get(ordered, j)["i"])))
    gaps = F.transform(F.sequence(F.lit(0), F.size(places) - 1),
                       lambda k: F.least(F.lit(WINDOW),
                                         F.coalesce(F.get(places, k + 1) - F.get(places, k), F.lit(WINDOW))))
    step4 = F.when(places.isNotNull(), F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)).otherwise(
        F.lit(0).cast("long"))
    return step1, step2, step3, step4


def line_fails(line: Column) -> Column:
    """The three line rules; false for a line without words."""
    n = F.regexp_count(line, F.lit(JAVA_WORD))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    shouts = F.regexp_count(line, F.lit(r"[!?]{2,}"))
    punctuation = (n >= 2) & ((3 * symbols >= 2 * n) | (2 * shouts >= n))
    navigation = F.regexp_count(line, F.lit(NAVIGATION)) >= 2
    return (n > 0) & (punctuation | navigation | line.rlike(BOILERPLATE))


def clean_lines(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (as it came), the base counts,
    ``clean_text`` (failing lines removed), ``lost_chars``, ``base_failed`` and
    ``kept``; with ``keep_row`` the input's column ``row`` too.  No shuffle:
    everything is computed within the row."""
    body = F.coalesce(F.col("text"), F.lit(""))
    row = ["row"] if keep_row else []
    df = docs.select("doc_id", "text", body.alias("body"), *row)
    df = df.withColumn("words", F.filter(F.split("body", JAVA_SPACE), lambda w: w != ""))
    df = df.withColumn("lines", F.split("body", "\n"))
    step1, step2, step3, step4 = _repeat_words(*map(F.col, ("words", "hashes", "ordered", "places")))
    df = df.withColumn("hashes", step1).withColumn("ordered", step2).drop("hashes")
    df = df.withColumn("places", step3).drop("ordered")
    worded = F.filter("lines", lambda x: x.rlike(JAVA_WORD))
    df = df.select(
        "doc_id", "text", "lines", *row,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        worded.alias("worded"), step4.alias("n_repeat_words"),
        F.transform("lines", line_fails).alias("fails"))
    # Equal lines are found as equal strings.
    df = df.withColumn("n_dup_lines", (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long"))
    left = F.transform(F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("x"), F.get("fails", i).alias("f"))),
                                lambda s: ~s["f"]), lambda s: s["x"])
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    df = df.withColumn("clean_text", F.when(F.exists("fails", lambda f: f), F.array_join(left, "\n")).otherwise(F.col("text")))
    df = df.withColumn("line_chars", total)
    lost = F.aggregate(F.filter("lines", lambda x, i: F.get("fails", i)), F.lit(0).cast("long"),
                       lambda a, x: a + F.length(x))
    df = df.withColumn("lost_chars", lost)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    out = df.select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "clean_text", "line_chars", "lost_chars", "base_failed", *row,
        (~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("line_chars"))).alias("kept"))
    # A generator in between: a later filter on a result column is not pushed
    # down, which would repeat the array expressions inside of it many times over.
    return out.select(F.inline(F.array(F.struct(*out.columns))))
