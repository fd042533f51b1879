"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers, a byte-level BPE (A) and a sentence-piece BPE (B), cut the same
bytes (a space and the text).  Every token points to the token of the other side
that covers its last byte, the farthest to the right that overlaps it; a B token
that ends where an A token ends points to itself.  Doubling the pointers
(``to = to[to]``) over whole arrays brings every token to the last one of its
component after about log2 of the longest chain: tokens with the same terminal
are a group, and groups end exactly where tokens of both sides end.

Neither side has a token across the border between a visible character and a
space, so a text is cut there into pieces, and a task tokenizes and aligns each
distinct piece once.  How many documents hold an id pair linked is counted over
all documents; the counts of the frequent pairs (bounded in number) are
broadcast, the rest are joined.

Defined cases: a null or empty text, and one that either side's tokens don't
give back byte by byte, has no tokens; special strings are plain text; repeated
rows are documents of their own; an empty table gives an empty result; other
input columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrovia.llm.common import drop_stored, stored, text_values

# Pairs that hold at least one in HOT_SHARE of all (document, pair) entries are
# broadcast: at most HOT_SHARE of them, 17 bytes each.
HOT_SHARE = 400_000
# Ids of B are below this: a pair is a * B_IDS + b, in so many bits.
B_IDS, PAIR_BITS = 1 << 20, 44
# What a task keeps of the pieces it has aligned.
HELD_PIECES, HELD_CHARS = 200_000, 8_000_000
# Documents that are aligned at a time, and pieces that are tokenized as one text.
SLICE, RUN_PIECES = 256, 256

_BORDER = re.compile(r"(?<=\S)(?= )")


def pieces(text: str) -> list[str]:
    """The text after a space, cut between each visible character and the space
    that follows it; white space at the end stays with the last piece."""
    spaced = " " + text
    body = spaced.rstrip()
    if not body:
        return [spaced]
    out = _BORDER.split(body)
    out[-1] += spaced[len(body):]
    return out


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For the tokens of A, then those of B, by their end offsets over the same
    bytes: the last token of each one's component (a B token; its number among
    both sides).  Pointer jumping: each round doubles how far a pointer reaches."""
    over_a = np.searchsorted(b_end, a_end)          # the B token with A's last byte
    over_b = np.searchsorted(a_end, b_end)          # the A token with B's last byte
    own = np.arange(len(b_end)) + len(a_end)
    to = np.concatenate([over_a + len(a_end), np.where(a_end[over_b] == b_end, own, over_b)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token whose byte ranges overlap, as two arrays."""
    a_start = np.concatenate([[0], a_end[:-1]])
    first, last = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_end, a_end)
    n = last - first + 1
    return np.repeat(np.arange(len(a_end)), n), expanded(first, n)


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write a byte that is printable in Latin-1 as its own
    character and the others, in order, as the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def expanded(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n[i]`` numbers from ``first[i]`` on, for every i, in a row."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Aligned(NamedTuple):
    """What some texts give: per text, and the distinct linked pairs of each (from
    ``offsets[i]`` to ``offsets[i + 1]``) with how often they are linked."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str | None]
    offsets: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


class Aligner:
    """Tokenizes and aligns pieces of text, each distinct one once while it is held."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbol = byte_of_symbol()
        special = {t.content for t in self._a.get_added_tokens_decoder().values()}
        self._a_bytes = [b""] * self._a.get_vocab_size()
        for token, i in self._a.get_vocab().items():
            self._a_bytes[i] = token.encode() if token in special else bytes(symbol[c] for c in token)
        self._b_bytes = []
        for i in range(self._b.get_piece_size()):
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece := self._b.id_to_piece(i))
            self._b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        # Ids in writing, with what follows them: a token of the same side, the
        # other side, or the next group.
        self._a_comma, self._a_bar = (np.array([f"{i}{c}" for i in range(len(self._a_bytes))], object) for c in ",|")
        self._b_comma, self._b_next = (np.array([f"{i}{c}" for i in range(len(self._b_bytes))], object) for c in ",;")
        self._a_size, self._b_size = (np.array([len(x) for x in y], np.int64) for y in (self._a_bytes, self._b_bytes))
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}            # number of each piece held; -1: not given back
        self._written: list[str] = []               # its groups in writing
        self._sizes = np.zeros((4, 0), np.int64)    # its A tokens, B tokens, groups, links
        self._pairs = np.zeros(0, np.int64)         # linked pairs of one piece after another
        self._chars = 0

    def _align(self, new: list[str], run: int = RUN_PIECES) -> None:
        """Hold each new piece.  Pieces that end visibly are tokenized as one text,
        ``run`` at a time; where the tokens don't give it back, each for itself."""
        visible = [p for p in new if not p[-1].isspace()]
        runs = [visible[i:i + run] for i in range(0, len(visible), run)] + [[p] for p in new if p[-1].isspace()]
        joined = ["".join(r) for r in runs]
        a_all = [np.array(e.ids, np.int64) for e in self._a.encode_batch_fast(joined, add_special_tokens=False)]
        b_all = [np.array(ids, np.int64) for ids in self._b.encode([t[1:] for t in joined], num_threads=1)]
        exact, again = [], []
        for pieces_, text, a, b in zip(runs, joined, a_all, b_all, strict=True):
            if (b"".join(map(self._a_bytes.__getitem__, a.tolist())) == text.encode("utf-8", "replace")
                    == b"".join(map(self._b_bytes.__getitem__, b.tolist()))):
                exact.append((pieces_, a, b))
            elif len(pieces_) > 1:
                again += pieces_
            else:
                self._place[text] = -1
                self._chars += len(text)
        if exact:
            again += self._hold([p for r, _, _ in exact for p in r], *(np.concatenate([r[k] for r in exact]) for k in (1, 2)))
        if again:
            self._align(again, 1)

    def _hold(self, new: list[str], a_ids: np.ndarray, b_ids: np.ndarray) -> list[str]:
        """Align pieces that lie in a row: both sides end where a piece ends, so no
        group and no overlap crosses a border.  Gives the pieces back if they don't."""
        a_end, b_end = np.cumsum(self._a_size[a_ids]), np.cumsum(self._b_size[b_ids])
        ends = np.cumsum([len(p.encode("utf-8", "replace")) for p in new])
        a_stop, b_stop = np.searchsorted(a_end, ends) + 1, np.searchsorted(b_end, ends) + 1
        if not (np.array_equal(a_end[a_stop - 1], ends) and np.array_equal(b_end[b_stop - 1], ends)):
            return new
        to = terminals(a_end, b_end)
        a_last, b_last = (np.append(g[1:] != g[:-1], True) for g in (to[:len(a_ids)], to[len(a_ids):]))
        signs = np.concatenate([np.where(a_last, self._a_bar[a_ids], self._a_comma[a_ids]),
                                np.where(b_last, self._b_next[b_ids], self._b_comma[b_ids])])
        # By group, A first; within a side the order stays.
        side = np.arange(len(to)) >= len(a_ids)
        signs = signs[np.argsort(to * 2 + side, kind="stable")].tolist()
        link_a, link_b = overlaps(a_end, b_end)
        pairs = a_ids[link_a] * B_IDS + b_ids[link_b]
        stops = np.stack([a_stop, b_stop, np.cumsum(b_last)[b_stop - 1], np.searchsorted(link_a, a_stop)])
        self._place.update(zip(new, range(len(self._written), len(self._written) + len(new)), strict=True))
        self._sizes = np.concatenate([self._sizes, np.diff(stops, axis=1, prepend=0)], axis=1)
        self._pairs = np.concatenate([self._pairs, pairs])
        at = 0
        for to_ in (a_stop + b_stop).tolist():
            self._written.append("".join(signs[at:to_])[:-1])
            at = to_
        self._chars += sum(map(len, new))
        return []

    def texts(self, texts: list[str]) -> Aligned:
        """The tokens, groups and links of each text."""
        if len(self._place) > HELD_PIECES or self._chars > HELD_CHARS:
            self._forget()
        cut = [pieces(t) if t else [] for t in texts]
        flat = [p for ps in cut for p in ps]
        if new := [p for p in dict.fromkeys(flat) if p not in self._place]:
            self._align(new)
        place = np.fromiter(map(self._place.__getitem__, flat), np.int64, len(flat))
        lengths = np.array([len(ps) for ps in cut], np.int64)
        text_of = np.repeat(np.arange(len(texts)), lengths)
        if (place < 0).any():
            # A text with a piece that isn't given back is judged as a whole.
            odd = np.unique(text_of[place < 0])
            if new := [w for w in dict.fromkeys(" " + texts[i] for i in odd) if w not in self._place]:
                self._align(new)
            whole = np.array([self._place[" " + texts[i]] for i in odd], np.int64)
            stay = ~np.isin(text_of, odd)
            place, text_of = np.append(place[stay], whole[whole >= 0]), np.append(text_of[stay], odd[whole >= 0])
            order = np.argsort(text_of, kind="stable")
            place, text_of = place[order], text_of[order]
        sizes = self._sizes[:, place]
        n_a, n_b, n_groups, n_links = (np.bincount(text_of, weights=x, minlength=len(texts)).astype(np.int64) for x in sizes)
        starts = np.cumsum(self._sizes[3]) - self._sizes[3]
        linked = self._pairs[expanded(starts[place], sizes[3])]
        # One sort for all texts of the slice: the text's number above the pair.
        key, times = np.unique(np.repeat(text_of, sizes[3]) << PAIR_BITS | linked, return_counts=True)
        bounds = np.searchsorted(text_of, np.arange(len(texts) + 1)).tolist()
        written = list(map(self._written.__getitem__, place.tolist()))
        groups = [";".join(written[i:j]) if j > i else None for i, j in zip(bounds, bounds[1:], strict=False)]
        return Aligned(n_a, n_b, n_groups, n_links, groups, np.searchsorted(key >> PAIR_BITS, np.arange(len(texts) + 1)),
                       key & (1 << PAIR_BITS) - 1, times)


_ALIGNERS: dict = {}


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: ``row`` (a number of its own), ``doc_id``, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``groups`` (written as ids of A | ids of B;
    null without tokens), and the distinct linked ``pairs`` with their ``times``."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 36
        if (a_path, b_path) not in _ALIGNERS:
            _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
        aligner = _ALIGNERS[a_path, b_path]
        for batch in it:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                found = aligner.texts(text_values(part.column("text")))
                offsets = pa.array(found.offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(part))), part.column("doc_id"), *map(pa.array, found[:4]),
                     pa.array(found.groups, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(found.pairs)),
                     pa.ListArray.from_arrays(offsets, pa.array(found.times, pa.int32()))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
                row += len(part)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, "
             "pairs array<long>, times array<int>")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): the documents that hold the pair linked, and whether no pair
    of the same A id is held by more.  An A id has at most as many pairs as B has ids."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {B_IDS}"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(docs: DataFrame, a_path: str, b_path: str, hot_share: int = HOT_SHARE) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is among its A id's most frequent), ``count_sum``
    (documents holding the pair, summed over the links) and ``groups_sha256``."""
    made = aligned(docs, a_path, b_path)
    # Only the digest of the groups is wanted here: they are as long as the text.
    digest = F.coalesce(F.sha2("groups", 256), F.lit(""))
    links = stored(made.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"), "alignments")
    counts = stored(pair_counts(links), "pair-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    is_hot = F.col("n") * hot_share >= total
    hot = counts.where(is_hot).toArrow().sort_by("pair")
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(hot.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")))
    own_fields = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in it:
            rows, lists = batch.column("row").to_numpy(), batch.column("pairs")
            offsets = lists.offsets.to_numpy()
            sizes, (start, stop) = np.diff(offsets), (offsets[0], offsets[-1])
            pair = lists.values.to_numpy()[start:stop]
            times = batch.column("times").values.to_numpy()[start:stop].astype(np.int64)
            at = np.searchsorted(known, pair)
            at[at == len(known)] = 0
            is_known = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            gain = np.where(is_known, times * (n[at] if len(n) else 0), 0)
            top = np.where(is_known & (best[at] if len(best) else False), times, 0)
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[offsets - start]) for x in (gain, top)]
            own = pa.StructArray.from_arrays(
                [*(batch.column(f) for f in own_fields), pa.array(sums[1]), pa.array(sums[0])],
                [*own_fields, "n_best", "count_sum"])
            # A row per document with what is known, and one per link that isn't.
            yield pa.RecordBatch.from_arrays(
                [pa.array(-1 - rows), pa.array(rows), pa.array(np.zeros(len(rows), np.int64)), own],
                ["pair", "row", "times", "own"])
            rest = ~is_known
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[rest]), pa.array(np.repeat(rows, sizes)[rest]), pa.array(times[rest]),
                 pa.nulls(int(rest.sum()), own.type)], ["pair", "row", "times", "own"])

    kinds = dict(links.dtypes)
    own_type = ",".join([*(f"{f}:{kinds[f]}" for f in own_fields), "n_best:bigint", "count_sum:bigint"])
    parts = links.mapInArrow(run, f"pair long, row long, times long, own struct<{own_type}>")
    joined = parts.join(counts.where(~is_hot), "pair", "left")
    zero = F.lit(0).cast("long")
    summed = joined.groupBy("row").agg(
        *[F.max(f"own.{f}").alias(f) for f in own_fields],
        (F.max("own.n_best") + F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), zero)).alias("n_best"),
        (F.max("own.count_sum") + F.coalesce(F.sum(F.col("times") * F.col("n")), zero)).alias("count_sum"))
    out = stored(summed.drop("row"), "aligned")
    drop_stored(links)
    drop_stored(counts)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
