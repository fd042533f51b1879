"""URL filtering by stated rules and by mined association rules.

Stated rules (a host with its subdomains and a path prefix) decide the urls they
fit, the longest one first.  Those verdicts are the labels: the combinations of up
to ``RULE_TOKENS`` URL tokens that go with a verdict are mined from them, and the
association rules that pass a support and a confidence, and that are surer than
each of their own parts, judge all other urls.  The surest rule that fits decides
(ties: more support, fewer tokens, then the tokens in order); a url that none fits
is allowed.

Mining goes level by level over all tokens of all labelled urls: each url makes the
sets of one more token from those of its sets that go on, and the sets are counted.
A set goes on if it has the least support, urls of both verdicts, and fewer urls
than each of its parts.  No other set is part of a rule: what contains a set of one
verdict, or one with as many urls as its part, is not surer than that (part).

Bounds: support is counted over distinct labelled urls.  Tokens under the least
support take no part, so at most 1 / ``MIN_SUPPORT`` times the mean number of
tokens do.  The sets of every level stay distributed.  Up to ``INDEXED`` rules are
sent to the tasks in an index, which lists every rule under its rarest token; more
are joined with the urls by that token, with the same results.

Defined cases: a null url, and one without ``://``, has an empty host and path, no
rule and no tokens, and is allowed; without labelled urls, or labels of one kind
only, no rule is mined; repeated rows are judged alike, and copies of a url are
one labelled url; an empty table gives an empty result; other input columns are
not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrovia.llm.common import drop_stored, resting_on, stored

# Stated rules (fixed values): verdict, host, path prefix.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT = 0.002     # of the distinct labelled urls,
MIN_COUNT = 5           # and at least so many
MIN_CONFIDENCE = 0.8
RULE_TOKENS = 4
# Rules that one index holds.
INDEXED = 400_000
# A longer token stands as its hash.
TOKEN_CHARS = 64


def folded(c: Column) -> Column:
    """A-Z in lower case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and what follows the path."""
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return (folded(part(r"(?s)^.*?://([^/?#]*)")), part(r"(?s)^.*?://[^/?#]*([^?#]*)"),
            part(r"(?s)^.*?://[^/?#]*[^?#]*(.*)$"))


def stated_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest stated rule that fits (``host`` + path prefix) and its verdict."""
    name = verdict = None
    for said, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    return name, verdict


def url_tokens(host: Column, path: Column, rest: Column) -> Column:
    """The distinct tokens of a url: labels of the host, words of the path and of
    what follows it; a number counts by its length too."""
    def words(text: Column, cut: str, kind: str) -> Column:
        found = F.filter(F.split(folded(text), cut), lambda w: w != "")
        short = lambda w: F.when(F.length(w) > TOKEN_CHARS, F.sha2(w, 256)).otherwise(w)
        numbers = F.transform(F.filter(found, lambda w: w.rlike("^[0-9]+$")),
                              lambda w: F.concat(F.lit(kind + "#"), F.least(F.length(w), F.lit(20)).cast("string")))
        return F.concat(F.transform(found, lambda w: F.concat(F.lit(kind), short(w))), numbers)

    other = r"[^\p{L}\p{N}]+"
    return F.array_distinct(F.concat(words(host, r"\.", "h:"), words(path, other, "p:"), words(rest, other, "q:")))


def larger(sets: dict[tuple[int, ...], int]) -> Iterator[tuple[tuple[int, ...], int]]:
    """The sets of one more token whose parts of one token less are all among
    ``sets`` (ascending numbers, with their counts), each with its parts' least count."""
    alike = defaultdict(list)
    for s in sorted(sets):
        alike[s[:-1]].append(s)
    for group in alike.values():
        for a, b in combinations(group, 2):
            new = (*a, b[-1])
            counts = [sets.get(new[:i] + new[i + 1:], 0) for i in range(len(new))]
            if all(counts):
                yield new, min(counts)


def _grown(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`larger` for rows (id, blocked, sets)."""
    for batch in it:
        for i, blocked, sets in zip(*(batch.column(c) for c in ("id", "blocked", "sets")), strict=True):
            new = larger({tuple(s["tokens"]): s["n"] for s in sets.as_py()})
            while some := list(islice(new, 10_000)):
                tokens, least = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()] * len(some), pa.int64()), pa.array([blocked.as_py()] * len(some), pa.bool_()),
                     pa.array(tokens, pa.list_(pa.int32())), pa.array(least, pa.int64())],
                    ["id", "blocked", "tokens", "least"])


def token_sets(labelled: DataFrame, numbered: DataFrame, min_count: int) -> list[DataFrame]:
    """Stored tables (tokens, n, k), one per size up to ``RULE_TOKENS``: sets of
    numbered tokens, the urls that have them and those of these that are blocked.
    All sets that a rule or a part of one can have are there."""
    numbers = F.array("number").alias("tokens")
    singles = stored(numbered.select(numbers, "n", "k"), "url-sets")
    goes_on = "k > 0 and k < n"
    # The join is with a bounded table, see above.
    has = stored(labelled.select(F.monotonically_increasing_id().alias("id"), "blocked", "tokens"), "url-has")
    having = (has.select("id", "blocked", F.explode("tokens").alias("token"))
              .join(F.broadcast(numbered.where(goes_on)), "token").select("id", "blocked", numbers, "n"))
    tables, found, grown = [has], [singles], None
    for _ in range(2, RULE_TOKENS + 1):
        sets = having.groupBy("id", "blocked").agg(F.collect_list(F.struct("tokens", "n")).alias("sets"))
        grown = stored(sets.mapInArrow(_grown, "id long, blocked boolean, tokens array<int>, least long"), "url-grown")
        counted = stored(grown.groupBy("tokens").agg(
            F.count("*").alias("n"), F.count_if("blocked").alias("k"), F.first("least").alias("least"))
            .where(F.greatest("k", F.col("n") - F.col("k")) >= min_count), "url-sets")
        tables.append(grown)
        found.append(counted)
        having = grown.drop("least").join(counted.where(f"{goes_on} and n < least").select("tokens", "n"), "tokens")
    for x in tables:
        drop_stored(x)
    return found


def association_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, least: int = MIN_COUNT,
                      min_confidence: float = MIN_CONFIDENCE) -> DataFrame | None:
    """(tokens, blocked, support, confidence, rarest) mined from ``labelled`` (url,
    tokens, blocked; distinct urls).  ``support`` counts the urls with the tokens and
    the verdict, ``rarest`` is the token that fewest labelled urls have.  None if
    there is nothing to learn from."""
    seen = labelled.agg(F.count("*").alias("n"), F.count_if("blocked").alias("k")).first()
    if not 0 < seen["k"] < seen["n"]:
        return None
    min_count = max(least, math.ceil(min_support * seen["n"]))
    by_token = (labelled.select(F.explode("tokens").alias("token"), "blocked").groupBy("token")
                .agg(F.count("*").alias("n"), F.count_if("blocked").alias("k"))
                .where(F.greatest("k", F.col("n") - F.col("k")) >= min_count))
    # The rarest token has the lowest number.  One window over a bounded table, see above.
    numbered = stored(by_token.withColumn("number", F.row_number().over(Window.orderBy("n", "token"))), "url-tokens")
    found = token_sets(labelled, numbered, min_count)
    sets = reduce(DataFrame.unionByName, [x.select("tokens", "n", "k") for x in found])
    verdicts = F.array(F.struct(F.lit(False).alias("blocked"), (F.col("n") - F.col("k")).alias("support")),
                       F.struct(F.lit(True).alias("blocked"), F.col("k").alias("support")))
    sure = stored(sets.select("tokens", "n", F.inline(verdicts)).where(F.col("support") >= min_count)
                  .select("tokens", "blocked", "support", (F.col("support") / F.col("n")).alias("confidence"))
                  .where(F.col("confidence") >= min_confidence), "url-sure")
    # A rule goes if some of its tokens alone are as sure of the verdict.
    parts = F.expr("transform(sequence(1, shiftleft(1, size(tokens)) - 2), "
                   "m -> filter(tokens, (t, i) -> (shiftright(m, i) & 1) = 1))")
    inner = (sure.where(F.size("tokens") > 1)
             .select("tokens", "blocked", "confidence", F.explode(parts).alias("part")))
    simpler = sure.select(F.col("tokens").alias("part"), "blocked", F.col("confidence").alias("simpler"))
    needless = inner.join(simpler, ["part", "blocked"]).where("simpler >= confidence").select("tokens", "blocked").distinct()
    kept = sure.join(needless, ["tokens", "blocked"], "left_anti")
    named = (kept.select(F.col("tokens").alias("numbers"), "blocked", "support", "confidence", F.explode("tokens").alias("number"))
             .join(F.broadcast(numbered.select("number", "token")), "number")
             .groupBy("numbers", "blocked", "support", "confidence")
             .agg(F.sort_array(F.collect_list("token")).alias("tokens"), F.min(F.struct("number", "token")).alias("least")))
    rules = stored(named.select("tokens", "blocked", "support", "confidence", F.col("least.token").alias("rarest")),
                   "url-rules")
    for x in (numbered, *found, sure):
        drop_stored(x)
    return rules


class RuleIndex:
    """Rules in the order they decide, listed under their rarest token."""

    def __init__(self, rules: list[tuple[list[str], bool, int, float, str]]):
        ordered = sorted(rules, key=lambda r: (-r[3], -r[2], len(r[0]), r[0], r[1]))
        self.rules = [(tokens, blocked, confidence) for tokens, blocked, _, confidence, _ in ordered]
        self._under: dict[str, list[tuple[int, frozenset]]] = {}
        for place, (tokens, _, _, _, rarest) in enumerate(ordered):
            self._under.setdefault(rarest, []).append((place, frozenset(tokens)))

    def first(self, tokens: list[str]) -> int | None:
        """The place of the first rule whose tokens are all there."""
        have, best = set(tokens), None
        for t in have:
            for place, wanted in self._under.get(t, ()):
                if best is not None and place > best:
                    break
                if wanted <= have:
                    best = place
                    break
        return best


def judged_by_join(read: DataFrame, rules: DataFrame) -> DataFrame:
    """``read`` (url, tokens, rule, verdict and more) with its verdicts, and the
    ``mined`` rules and their ``confidence``, by a join on the rules' rarest tokens."""
    order = F.struct((-F.col("confidence")).alias("sureness"), (-F.col("support")).alias("support"),
                     F.size("wanted").alias("size"), "wanted", "blocked")
    first = (read.where("rule is null").select("url", "tokens").dropDuplicates(["url"])
             .select("url", "tokens", F.explode("tokens").alias("rarest"))
             .join(rules.withColumnRenamed("tokens", "wanted"), "rarest")
             .where(F.size(F.array_except("wanted", "tokens")) == 0)
             .groupBy("url").agg(F.min(order).alias("first")))
    # Urls of stated rules have none here.
    return read.join(first, "url", "left").select(
        "id", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("first.blocked"), BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.col("first.wanted").alias("mined"), (-F.col("first.sureness")).alias("confidence"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_column: str = "page_id") -> DataFrame:
    """One row per page: the id, ``host``, ``path``, ``rule`` (the stated rule, else
    null), ``verdict``, and for urls without a stated rule the ``mined`` rule's tokens
    and its ``confidence``."""
    host, path, rest = url_parts(F.col("url"))
    cut = pages.select(F.col(id_column).alias("id"), "url", host.alias("host"), path.alias("path"), rest.alias("rest"))
    name, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    tokens = url_tokens(F.col("host"), F.col("path"), F.col("rest"))
    read = cut.select("id", "url", "host", "path", name.alias("rule"), verdict.alias("verdict"), tokens.alias("tokens"))
    # The tokens follow from the url: copies of a url are one.
    distinct = (read.where("rule is not null").groupBy("url")
                .agg(F.first("tokens").alias("tokens"), F.first(F.col("verdict") == BLOCK).alias("blocked")))
    labelled = stored(distinct, "url-labelled")
    mined = association_rules(labelled)
    drop_stored(labelled)
    if mined is not None and mined.count() > INDEXED:
        return resting_on(judged_by_join(read, mined).withColumnRenamed("id", id_column), mined)
    found = [] if mined is None else [tuple(r) for r in mined.collect()]     # at most INDEXED
    if mined is not None:
        drop_stored(mined)
    shared = pages.sparkSession.sparkContext.broadcast(RuleIndex(found))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in it:
            first = [None if rule is not None else index.first(tokens)
                     for rule, tokens in zip(batch.column("rule").to_pylist(), batch.column("tokens").to_pylist(), strict=True)]
            told = [None if place is None else index.rules[place] for place in first]
            verdicts = [v or (BLOCK if t is not None and t[1] else ALLOW)
                        for v, t in zip(batch.column("verdict").to_pylist(), told, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "host", "path", "rule")), pa.array(verdicts, pa.string()),
                 pa.array([t and t[0] for t in told], pa.list_(pa.string())),
                 pa.array([t and t[2] for t in told], pa.float64())],
                [id_column, "host", "path", "rule", "verdict", "mined", "confidence"])

    id_type = pages.schema[id_column].dataType.simpleString()
    return read.drop("url").mapInArrow(
        run, f"{id_column} {id_type}, host string, path string, rule string, verdict string, "
             "mined array<string>, confidence double")
