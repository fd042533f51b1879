"""Fill-in-the-middle transformation over a wavelet matrix of character classes.

The characters of a slice of texts become classes (line feed, other white
space, end of a sentence, all others), and one wavelet matrix over the classes
answers for all texts of the slice at once: rank queries, summed over the
classes that end a unit, count the units before any place; select (a single
class) or bisection on the summed ranks (several classes) finds the place after
the k-th unit.  The two cuts are drawn from a hash of the id, so a run that is
repeated, or a task that is run again, makes the same cuts.

Units: ``line`` ends at a line feed, ``word`` at any white space, ``sentence``
at a line feed or the end of a sentence; what follows the last end is a unit too.

Defined cases: a null text is empty; an empty text, and one that holds a marker
itself, stays plain; a null id is hashed as ''; repeated rows are cut alike; an
empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import text_values

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OTHER, LINE_FEED, BLANK, STOP = range(4)
CLASS_BITS = 2
UNITS = {"line": (LINE_FEED,), "word": (LINE_FEED, BLANK), "sentence": (LINE_FEED, STOP)}
# Code points of a slice; a longer text is a slice of its own.
SLICE_CHARS = 1 << 21

_CLASS_OF = np.full(0x110000, OTHER, np.uint8)
_CLASS_OF[[9, 11, 12, 13, 32]] = BLANK
_CLASS_OF[10] = LINE_FEED
_CLASS_OF[[ord(c) for c in ".!?…。！？"]] = STOP


def first_place(count: Callable[[np.ndarray], np.ndarray], wanted: np.ndarray, size: int) -> np.ndarray:
    """The smallest places up to ``size`` before which ``count`` reaches ``wanted``:
    one bisection for all of them."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), size, np.int64)
    while (low < high).any():
        mid = (low + high) >> 1
        enough = count(mid) >= wanted
        low, high = np.where(enough, low, np.minimum(mid + 1, high)), np.where(enough, mid, high)
    return low


class WaveletMatrix:
    """Rank and select over a sequence of small codes, a bit vector per bit of a code."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.size = len(codes)
        self._levels = []
        for place in reversed(range(bits)):
            bit = (codes >> place & 1).astype(bool)
            packed = np.zeros(self.size // 64 * 8 + 8, np.uint8)
            bytes_ = np.packbits(bit, bitorder="little")
            packed[:len(bytes_)] = bytes_
            words = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self._levels.append((place, words, before, self.size - int(before[-1])))
            codes = np.concatenate([codes[~bit], codes[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & below)

    def _down(self, code: int, i: np.ndarray) -> np.ndarray:
        """Where place ``i`` is in the last level's order, on the way of ``code``."""
        for place, words, before, zeros in self._levels:
            ones = self._ones(words, before, i)
            i = zeros + ones if code >> place & 1 else i - ones
        return i

    def rank(self, code: int, i: np.ndarray) -> np.ndarray:
        """How often ``code`` occurs before each place."""
        i = np.asarray(i, np.int64)
        return self._down(code, i) - self._down(code, np.zeros(1, np.int64))

    def select(self, code: int, k: np.ndarray) -> np.ndarray:
        """The places of the occurrences numbered ``k``, from 0; they must exist."""
        at = self._down(code, np.zeros(1, np.int64)) + np.asarray(k, np.int64)
        for place, words, before, zeros in reversed(self._levels):
            if code >> place & 1:
                at = first_place(lambda i, w=words, b=before: self._ones(w, b, i), at - zeros + 1, self.size) - 1
            else:
                at = first_place(lambda i, w=words, b=before: i - self._ones(w, b, i), at + 1, self.size) - 1
        return at


class Units:
    """The units of some texts, over one wavelet matrix for all of them."""

    def __init__(self, texts: list[str], unit: str):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4")
        classes = _CLASS_OF[points]
        self._matrix, self._ends = WaveletMatrix(classes, CLASS_BITS), UNITS[unit]
        self.stop = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.start = np.concatenate([[0], self.stop[:-1]]).astype(np.int64)
        self._before = self._boundaries(self.start)
        self.ended = self._boundaries(self.stop) - self._before
        full = self.stop > self.start
        last_ends = np.zeros(len(texts), bool)
        last_ends[full] = np.isin(classes[self.stop[full] - 1], self._ends)
        self.count = self.ended + (full & ~last_ends)

    def _boundaries(self, i: np.ndarray) -> np.ndarray:
        return sum(self._matrix.rank(c, i) for c in self._ends)

    def after(self, k: np.ndarray) -> np.ndarray:
        """The code points of each text's first ``k`` units."""
        place = np.where(k > self.ended, self.stop, self.start)
        inside = (k > 0) & (k <= self.ended)
        wanted = self._before[inside] + k[inside]
        if len(self._ends) == 1:
            place[inside] = self._matrix.select(self._ends[0], wanted - 1) + 1
        else:
            place[inside] = first_place(self._boundaries, wanted, self._matrix.size)
        return place - self.start


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``SLICE_CHARS`` code points."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def _hash_words(doc_id: Column, seed: int) -> list[Column]:
    """The first four 32-bit numbers of the sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = 7, fim_percent: int = 100,
                   spm_percent: int = 50) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` (its units), ``form`` (``plain``,
    ``psm`` or ``spm``), ``prefix_chars``, ``middle_chars`` (null if plain) and
    ``output``.  Nothing is shuffled."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            whole = text_values(batch.column("text"))
            for a, b in slices(whole):
                texts, part = whole[a:b], batch.slice(a, b - a)
                h1, h2, h3, h4 = (part.column(f"h{i}").to_numpy() for i in range(1, 5))
                units = Units(texts, unit)
                first, second = h1 % (units.count + 1), h2 % (units.count + 1)
                head, tail = units.after(np.minimum(first, second)), units.after(np.maximum(first, second))
                cut, spm = (h3 % 100 < fim_percent).tolist(), (h4 % 100 < spm_percent).tolist()
                forms, outputs = [], []
                for t, p, m, is_cut, is_spm in zip(texts, head.tolist(), tail.tolist(), cut, spm, strict=True):
                    if not t or not is_cut or PREFIX in t or SUFFIX in t or MIDDLE in t:
                        forms.append("plain")
                        outputs.append(t)
                    elif is_spm:
                        forms.append("spm")
                        outputs.append(f"{SUFFIX}{t[m:]}{PREFIX}{t[:p]}{MIDDLE}{t[p:m]}")
                    else:
                        forms.append("psm")
                        outputs.append(f"{PREFIX}{t[:p]}{SUFFIX}{t[m:]}{MIDDLE}{t[p:m]}")
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(units.count, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(head, pa.int64(), mask=plain), pa.array(tail - head, pa.int64(), mask=plain),
                     pa.array(outputs, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", *_hash_words(F.col("doc_id"), seed))
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text again, from what was made of it: a text with a marker of its own is
    plain, so the three markers of the other forms are the only ones."""
    part = F.split(output, "<[PSM]>", -1)
    at = lambda i: F.get(part, F.lit(i))
    return (F.when(form == "psm", F.concat(at(1), at(3), at(2)))
            .when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(output))
