"""Sum-of-squares online packing of token sequences.

A document is its token ids and one end id.  Full windows are cut off its
front; the rest is placed into the fill level that makes the sum of squared
counts of partially filled windows smallest.  The counts per level are an
array; a level's windows are a stack.  When a task ends, its partly filled
windows are closed: the emptiest ones are cut to fill up the fullest, and the
last remainder is laid out in windows of a power of two tokens, which need no
padding.  So a task pads nothing and most documents are never cut.

Each task packs its own partition; nothing is shuffled.  A sequence id is the
partition's number and a counter.  A lost task is packed again to the same
sequences, as its input order is that of its file split.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each for itself; an empty table packs to nothing; a text longer than a
window fills whole windows first; other input columns are not read.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ferrovia.llm.common import text_values

WINDOW = 2048
END_ID = 1
# Bytes of keys and ids that a worker keeps for words it has met.
CACHE_BYTES = 96 * 1024 * 1024

_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in for each byte in byte-level vocabularies: visible
    Latin-1 characters stand for themselves, the other bytes for code points
    from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def packed_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class WordIds:
    """Token ids of texts.  The tokenizer drops white space, so the ids of a
    text are those of its blank-separated chunks in turn; each distinct chunk is
    tokenized once while it is kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.kept: dict[str, bytes] = {"": b""}
        self.held = 0

    def _plain(self, word: str) -> bytes:
        """Ids of a run of Latin letters, one piece for the model."""
        mapped = word.lower()
        if not mapped.isascii():
            mapped = "".join(map(self.symbols.__getitem__, mapped.encode()))
        return packed_ids([t.id for t in self.model.tokenize(mapped)])

    def _learn(self, chunks: set[str]) -> None:
        kept, other, tails = self.kept, [], []
        for c in chunks:
            core = c.rstrip(".,")
            if _LATIN.fullmatch(core):
                if core not in kept:
                    kept[core] = self._plain(core)
                if len(core) < len(c):
                    tails.append((c, core))
            else:
                other.append(c)
        other.extend({c[len(core):] for c, core in tails if c[len(core):] not in kept})
        for i in range(0, len(other), 4096):
            part = other[i:i + 4096]
            for c, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                kept[c] = packed_ids(e.ids)
        for c, core in tails:
            kept[c] = kept[core] + kept[c[len(core):]]
        self.held += sum(160 + 8 * len(c) for c in chunks)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            chunks = text.replace("\n", " ").split(" ")
            new = set(chunks).difference(self.kept)
            if new:
                if self.held > CACHE_BYTES:
                    self.kept, self.held = {"": b""}, 0
                    new = set(chunks)
                    new.discard("")
                self._learn(new)
            yield b"".join(map(self.kept.__getitem__, chunks))


class SumOfSquares:
    """Windows under way.  ``add`` yields windows that are full, ``close`` the
    rest.  A window is a list of (key, start, ids, doc_tokens)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def level_for(self, size: int) -> int:
        """The fill level whose use leaves the smallest sum of squared counts;
        the fullest of equal ones.  Level 0 is a new window."""
        w, n = self.window, self.count
        after = 2 * n[size:] + 1
        after[w - size] = 0  # a full window is none of the partly filled
        change = after - 2 * n[:w - size + 1] + 1
        change[0] = after[0]
        change[1:][n[1:w - size + 1] == 0] = np.iinfo(np.int64).max
        return int(w - size - np.argmin(change[::-1]))

    def add(self, key, ids: bytes) -> Iterator[list]:
        total = len(ids) // 4
        start = 0
        while total - start >= self.window:
            yield [(key, start, ids[4 * start:4 * (start + self.window)], total)]
            start += self.window
        size = total - start
        if not size:
            return
        h = self.level_for(size)
        if h:
            pieces = self.open[h].pop()
            self.count[h] -= 1
        else:
            pieces = []
        pieces.append((key, start, ids[4 * start:], total))
        if h + size == self.window:
            yield pieces
        else:
            self.open[h + size].append(pieces)
            self.count[h + size] += 1

    def close(self) -> Iterator[list]:
        left = deque((h, p) for h in range(self.window - 1, 0, -1) for p in self.open[h])
        spare: list = []
        while left:
            h, pieces = left.popleft()  # the fullest, filled up by the emptiest
            while h < self.window and (spare or left):
                if not spare:
                    spare = left.pop()[1]
                taken, spare = _cut(spare, self.window - h)
                pieces = pieces + taken
                h += _tokens(taken)
            if h == self.window:
                yield pieces
            else:
                spare = pieces
        size = _tokens(spare)
        while size:
            take = 1 << (size.bit_length() - 1)
            taken, spare = _cut(spare, take)
            yield taken
            size -= take
        self.__init__(self.window)


def _tokens(pieces: list) -> int:
    return sum(len(p[2]) // 4 for p in pieces)


def _cut(pieces: list, size: int) -> tuple[list, list]:
    """The first ``size`` tokens of pieces, and the rest."""
    taken = []
    for k, (key, start, ids, total) in enumerate(pieces):
        n = len(ids) // 4
        if n > size:
            if size:
                taken.append((key, start, ids[:4 * size], total))
            return taken, [(key, start + size, ids[4 * size:], total), *pieces[k + 1:]]
        taken.append((key, start, ids, total))
        size -= n
    return taken, []


OUT = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ENCODERS: dict[str, WordIds] = {}


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset``, ``ids`` (binary, little-endian unsigned
    32-bit)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = packed_ids([end_id])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = WordIds(tokenizer_path)
        encoder, packer = _ENCODERS[tokenizer_path], SumOfSquares(window)
        base = TaskContext.get().partitionId() << 36
        made, id_arrow = 0, pa.int64()

        def rows(windows: list[list]) -> pa.RecordBatch:
            nonlocal made
            out = []
            for pieces in windows:
                at = 0
                for key, start, ids, total in pieces:
                    n = len(ids) // 4
                    out.append((key, start, n, total, base + made, at, ids))
                    at += n
                made += 1
            cols = list(zip(*out, strict=True)) or [()] * 7
            types = [id_arrow, *[pa.int64()] * 5, pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for batch in it:
            id_arrow = batch.column("doc_id").type
            full: list[list] = []
            for key, ids in zip(batch.column("doc_id").to_pylist(),
                                encoder.encode(text_values(batch.column("text"))), strict=True):
                full.extend(packer.add(key, ids + end))
                if len(full) >= 2000:
                    yield rows(full)
                    full = []
            if full:
                yield rows(full)
        yield rows(list(packer.close()))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {OUT}")
