"""Secret scan: fixed patterns, and a battery of randomness tests.

Three patterns give the base spans: assigned values, access keys and runs of
hexadecimal digits.  Beside them, every unbroken run of key characters is a
candidate, and so is every part of it between slashes, if it is long enough (a
key inside of a path).  The encoding is inferred (decimal, hexadecimal, letters,
base32, base36, base62, base64), and the battery asks how well it agrees with a
random string over that alphabet: a chi-squared test of the alphabet's uniformity
(over classes of the alphabet, so that short strings have enough expected counts),
a runs test about the alphabet's middle, a serial-correlation test, the shares of
digits and of vowels, and a runs test over kinds of characters (upper and lower
case, digits and marks; vowels and other letters, where the alphabet has letters
of one case only).  The sum of the squared deviates is the combined statistic, so
that several weak signs of plain text add up.

Random strings pass each test; so do some short strings of plain text.  The
control of false discoveries is therefore aware of the length: all plain words
and numbers of the same texts, written the way names, paths and slugs of the
encoding are and cut to candidate lengths, are decoys.  For each encoding and
length band of the candidates, a combined level is accepted only where the decoys
at that level or above, per decoy, times the candidates, are at most ``fdr`` of
the candidates there (Storey's estimate).  The texts are read three times and
nothing is stored: a pass counts the candidates' levels, one those of the decoys
(both are histograms, summed over all documents), and one gives the spans.

Defined cases: a null or empty text has no spans; repeated rows are scanned
alike; an empty table gives an empty result; in very long texts all matches are
found; a run over no one alphabet is judged by the characters that its encoding
holds, and is not random with fewer than ``SHORTEST`` of them; spans of different
kinds may overlap; other input columns are not read.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import text_values

# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_VALUE, MIN_ACCESS = 12, 18
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Candidates of the battery.
# An equals sign may stand before one (as in name=value); after one it is padding
# where the string ends there.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
LEVELS = 20
FDR = 0.01
SHORTEST = 20
# A sum of squared deviates that is at level 0 whatever the other tests say.
_SURE = 90.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base26": _LOWER,
    "BASE26": _UPPER,
    "base32": _UPPER + "234567",
    "base36": "0123456789" + _LOWER,
    "BASE36": "0123456789" + _UPPER,
    "base52": _UPPER + _LOWER,
    "base62": "0123456789" + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + "0123456789+/",
    "base64url": _UPPER + _LOWER + "0123456789-_",
}
# Bytes of plain words: letters and digits stay, all else parts words.
_WORDS = bytes(b if chr(b) in _UPPER + _LOWER + "0123456789" else 32 for b in range(256))
# One plain word in so many gets a number, as names and slugs often have.
NUMBERED = 3
_CODE = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
_SETS = {name: frozenset(a) for name, a in ALPHABETS.items()}


def _kinds(alphabet: str) -> list[int]:
    """The kind of each character: vowel or not, in alphabets of one case's letters
    only; otherwise lower case, upper case, digit, mark."""
    if alphabet in (_LOWER, _UPPER):
        return [int(c in "aeiouAEIOU") for c in alphabet]
    return [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in alphabet]


_KIND = {name: _kinds(a) for name, a in ALPHABETS.items()}


# Characters whose number is tested, where the alphabet is larger than that of
# hexadecimal digits and has such.
_COUNTED = {name: {kind: held for kind, chars in (("digits", "0123456789"), ("vowels", "aeiouAEIOU"))
                   if any(held := [int(c in chars) for c in a])}
            for name, a in ALPHABETS.items() if len(a) > 16}


def _kind_shares(encoding: str) -> tuple[float, float]:
    """Chance that two, and three, random characters are of one kind."""
    shares = [n / len(_KIND[encoding]) for n in Counter(_KIND[encoding]).values()]
    return sum(x ** 2 for x in shares), sum(x ** 3 for x in shares)


def _kind_moments(encoding: str, n: int) -> tuple[float, float]:
    """Mean and deviation of the changes of kind among ``n`` random characters."""
    two, three = _kind_shares(encoding)
    var = (n - 1) * two * (1 - two) + 2 * max(0, n - 2) * (three - two * two)
    return (n - 1) * (1 - two), math.sqrt(max(var, 0.0))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns, in code points."""
    spans = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def encoding_of(s: str) -> str:
    """The smallest alphabet that holds all characters."""
    chars = set(s)
    return next((n for n, a in _SETS.items() if chars <= a), "base64url" if "+" not in chars else "base64")


def _chi_deviate(x, df: int):
    """Normal deviate of a chi-squared value, by the cube root."""
    return ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))


def _runs(bits: list[bool]) -> float:
    """Wald-Wolfowitz runs test."""
    n, a = len(bits), sum(bits)
    b = n - a
    if not a or not b:
        return math.sqrt(n)  # all alike: as unlikely as so many equal coin throws
    runs = 1 + sum(x != y for x, y in zip(bits, bits[1:]))
    mean = 2 * a * b / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    return (runs - mean) / math.sqrt(var) if var > 0 else 0.0


def battery(s: str, encoding: str) -> dict[str, float]:
    """Normal deviates of the tests of randomness over the encoding's alphabet;
    those of the first two tests are 0 at least, as only excess counts."""
    code, size = _CODE[encoding], len(ALPHABETS[encoding])
    v = [code[c] for c in s.rstrip("=") if c in code]
    n = len(v)
    if n < SHORTEST:
        return {"length": math.sqrt(_SURE)}
    # Contiguous classes of the alphabet, with four expected in each.
    classes = max(2, min(size, n // 4))
    seen = Counter(x * classes // size for x in v)
    chi = 0.0
    for k in range(classes):
        share = sum(1 for x in range(size) if x * classes // size == k) / size
        chi += (seen[k] - n * share) ** 2 / (n * share)
    # Repeats of single letters: the index of coincidence against 1 / size.
    pairs = n * (n - 1) / 2
    same = sum(c * (c - 1) / 2 for c in Counter(v).values())
    coincidence = (same - pairs / size) / math.sqrt(pairs / size * (1 - 1 / size))
    mean = (size - 1) / 2
    var = (size * size - 1) / 12
    serial = sum((x - mean) * (y - mean) for x, y in zip(v, v[1:])) / (var * math.sqrt(n - 1))
    out = {"uniform": max(0.0, _chi_deviate(chi, classes - 1)), "coincidence": max(0.0, coincidence),
           "runs": _runs([2 * x >= size for x in v]), "serial": serial}
    for name, held in _COUNTED.get(encoding, {}).items():
        share = sum(held) / size
        out[name] = (sum(held[x] for x in v) - n * share) / math.sqrt(n * share * (1 - share))
    mean, deviation = _kind_moments(encoding, n)
    if deviation:
        kinds = [_KIND[encoding][x] for x in v]
        out["kinds"] = (sum(x != y for x, y in zip(kinds, kinds[1:])) - mean) / deviation
    return out


def combined(z: dict[str, float]) -> float:
    """The upper tail of the sum of squares, in 0 to 1: near 0 for a string that
    the tests together call not random."""
    return _tail(sum(x * x for x in z.values()), len(z))


def _tail(squares: float, tests: int) -> float:
    return 0.5 * math.erfc(_chi_deviate(squares, tests) / math.sqrt(2))


def level_of(p: float) -> int:
    """0 (not random) to LEVELS: twentieths on a log scale down to 1e-10."""
    return max(0, min(LEVELS, round(LEVELS + 2 * math.log10(max(p, 1e-12)))))


@functools.cache
def _level_ends(tests: int) -> np.ndarray:
    """The largest sum of squares at each level from ``LEVELS`` down to 1."""
    ends = []
    for level in range(LEVELS, 0, -1):
        low, high = 0.0, 10 * _SURE
        while low < (mid := (low + high) / 2) < high:
            low, high = (mid, high) if level_of(_tail(mid, tests)) >= level else (low, mid)
        ends.append(low)
    return np.array(ends)


def band_of(n: int) -> int:
    """Length band: powers of the square root of two."""
    return int(2 * math.log2(n))


def _judged(s: str, start: int) -> tuple[int, int, str, int, int]:
    e = encoding_of(s)
    return start, start + len(s), e, band_of(len(s)), level_of(combined(battery(s, e)))


def candidates(text: str) -> Iterator[list[tuple[int, int, str, int, int]]]:
    """For each run of key characters: (start, end, encoding, band, level) of the
    run, then of its parts between slashes."""
    for m in CANDIDATE.finditer(text):
        s, at = m[0], m.start()
        found = [_judged(s, at)]
        if "/" in s:
            for part in s.split("/"):
                if len(part) >= SHORTEST:
                    found.append(_judged(part, at))
                at += len(part) + 1
        yield found


def lengths_of(band: int) -> int:
    """The shortest candidate length of a band."""
    return next(n for n in range(max(SHORTEST, int(2 ** (band / 2)) - 1), 2 ** (band // 2 + 2)) if band_of(n) == band)


def plain(text: str) -> list[bytes]:
    """All plain words of a text (what is no candidate): letters and digits."""
    return CANDIDATE.sub(" ", text).encode("ascii", "ignore").translate(_WORDS).split()


def numbered(words: list[bytes]) -> list[bytes]:
    """Some of the words with a number of one to three digits after them."""
    out = list(words)
    for i in range(0, len(out), NUMBERED):
        out[i] += b"%d" % (zlib.crc32(out[i]) % 1000)
    return out


def written(words: list[bytes], encoding: str, with_numbers: list[bytes] | None = None) -> bytes:
    """Plain words as one string over the encoding's alphabet: joined by its marks,
    in camel case where it has both cases, without what it does not hold; with
    numbers among them (``numbered(words)``), if it holds whole words and digits."""
    if "digits" in _COUNTED.get(encoding, ()):
        words = numbered(words) if with_numbers is None else with_numbers
    if encoding == "base64":
        return b"/".join(words)
    if encoding == "base64url":
        half = len(words) // 2
        return b"-".join(words[:half]) + b"_".join(words[half:])
    if encoding in ("base52", "base62"):
        data = b" ".join(words).title()
    else:
        data = b" ".join(words)
        data = data.lower() if encoding in ("hex", "base26", "base36") else data.upper()
    held = ALPHABETS[encoding].encode()
    return data.translate(None, bytes(set(range(256)) - set(held)))


def levels(strings: np.ndarray, encoding: str) -> np.ndarray:
    """:func:`level_of` the combined tail for strings of one length, given as
    rows of bytes; the same numbers as :func:`battery`, made for all at once."""
    m, n = strings.shape
    size = len(ALPHABETS[encoding])
    changes, deviation = _kind_moments(encoding, n)
    counted = _COUNTED.get(encoding, {})
    tests = 4 + len(counted) + (deviation > 0)
    held = list(ALPHABETS[encoding].encode())

    def of_bytes(values) -> np.ndarray:
        table = np.zeros(256, np.uint8)
        table[held] = values
        return table

    # One byte a character until only what may be random is left.
    total = np.zeros(m)
    for chosen in counted.values():
        share = sum(chosen) / size
        total += (of_bytes(chosen)[strings].sum(axis=1, dtype=np.int32) - n * share) ** 2 / (n * share * (1 - share))
    if deviation:
        at = np.flatnonzero(total < _SURE)
        kinds = of_bytes(_KIND[encoding])[strings[at]]
        total[at] += ((np.count_nonzero(kinds[:, 1:] != kinds[:, :-1], axis=1) - changes) / deviation) ** 2
    # Where these are sure, the others change nothing.
    out, at = np.zeros(m, np.int64), np.flatnonzero(total < _SURE)
    v, total, m = of_bytes(np.arange(size))[strings[at]].astype(np.int32), total[at], len(at)
    if not m:
        return out
    row = np.arange(m)[:, None]
    counts = np.bincount((row * size + v).ravel(), minlength=m * size).reshape(m, size)
    pairs = n * (n - 1) / 2
    same = (counts * (counts - 1)).sum(axis=1) / 2
    total += np.maximum(0, (same - pairs / size) / math.sqrt(pairs / size * (1 - 1 / size))) ** 2
    mean, var = (size - 1) / 2, (size * size - 1) / 12
    x = v - mean
    total += ((x[:, :-1] * x[:, 1:]).sum(axis=1) / (var * math.sqrt(n - 1))) ** 2
    bits = 2 * v >= size
    a = bits.sum(axis=1)
    b = n - a
    mean = 2 * a * b / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + (bits[:, 1:] != bits[:, :-1]).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        about = np.where(var > 0, (runs - mean) ** 2 / var, 0)
    total += np.where((a == 0) | (b == 0), n, about)
    classes = max(2, min(size, n // 4))
    of = np.arange(size) * classes // size
    expected = n * np.bincount(of, minlength=classes) / size
    seen = np.add.reduceat(counts, np.searchsorted(of, np.arange(classes)), axis=1)
    chi = ((seen - expected) ** 2 / expected).sum(axis=1)
    total += np.maximum(0, _chi_deviate(chi, classes - 1)) ** 2
    out[at] = LEVELS - np.searchsorted(_level_ends(tests), total, side="left")
    return out


def decoys(docs: DataFrame, wanted: list[tuple[str, int]]) -> DataFrame:
    """(encoding, band, level, n): levels of the plain words of all texts, cut to
    the shortest length of each (encoding, band) ``wanted``.  Words are joined over
    the texts of a task, so only its last characters give no decoy."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        rest = dict.fromkeys(wanted, b"")
        held: list[bytes] = []
        size = 0

        def cut() -> None:
            names = numbered(held)
            whole = {e: written(held, e, names) for e in {e for e, _ in wanted}}
            held.clear()
            for e, band in wanted:
                n = lengths_of(band)
                data = rest[e, band] + whole[e]
                m = len(data) // n
                rest[e, band] = data[m * n:]
                rows = np.frombuffer(data, np.uint8, m * n).reshape(m, n)
                step = max(1, 200_000 // n)
                for i in range(0, m, step):
                    for level, k in enumerate(np.bincount(levels(rows[i:i + step], e)).tolist()):
                        seen[e, band, level] += k

        for batch in it:
            for t in text_values(batch.column("text")):
                held += plain(t)
                size += len(t)
                if size > 2_000_000:
                    cut()
                    size = 0
        cut()
        yield _counted(seen)

    return _summed(docs, run)


def histogram(docs: DataFrame) -> DataFrame:
    """(encoding, band, level, n): levels of the candidates of all texts."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in it:
            for t in text_values(batch.column("text")):
                seen.update(c[2:] for found in candidates(t) for c in found)
        yield _counted(seen)

    return _summed(docs, run)


def _counted(seen: Counter) -> pa.RecordBatch:
    rows = [(*k, n) for k, n in seen.items() if n]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int64()))],
        ["encoding", "band", "level", "n"])


def _summed(docs: DataFrame, run) -> DataFrame:
    return (docs.select("text").mapInArrow(run, "encoding string, band int, level int, n long")
            .groupBy("encoding", "band", "level").agg(F.sum("n").alias("n")))


def accepted_spans(text: str, least: dict[tuple[str, int], int]) -> list[tuple[int, int, str]]:
    """Base spans, and as ``random`` the candidates at an accepted level (the parts
    of an accepted run are not listed again), by start, then kind."""
    spans = base_spans(text)
    for found in candidates(text):
        taken = [(a, b, "random") for a, b, e, band, level in found if level >= least.get((e, band), LEVELS + 1)]
        # The run itself comes first.
        spans += taken[:1] if taken and taken[0][:2] == found[0][:2] else taken
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def accepted_levels(docs: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], int]:
    """(encoding, band) to the lowest level at which the expected share of
    plain strings of ``docs`` among the candidates at or above it is at most
    ``fdr``.  A band with too few decoys of its own to show such a share takes in
    those of shorter bands, which look random more often."""
    # Both are histograms: encodings x length bands x levels, some hundred rows.
    real, null = Counter(), Counter()
    for r in histogram(docs).collect():
        real[r["encoding"], r["band"], r["level"]] += r["n"]
    wanted = sorted({k[:2] for k in real} | {(k[0], band_of(SHORTEST)) for k in real})
    for r in decoys(docs, wanted).collect() if real else ():
        null[r["encoding"], r["band"], r["level"]] += r["n"]
    least = {}
    for e, band in sorted({k[:2] for k in real}):
        near, all_null = [], 0
        for shorter in range(band, -1, -1):
            if all_null < 2 / fdr:
                near += [k for k in null if k[:2] == (e, shorter)]
                all_null = sum(null[k] for k in near)
        total = sum(n for k, n in real.items() if k[:2] == (e, band))
        for level in range(1, LEVELS + 1):
            share = (sum(null[k] for k in near if k[2] >= level) + 1) / (all_null + 1)
            above = sum(n for k, n in real.items() if k[:2] == (e, band) and k[2] >= level)
            if above and share * total <= fdr * above:
                least[e, band] = level
                break
    return least


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))


def find_secrets(docs: DataFrame, fdr: float = FDR, keep_row: bool = False) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` (start, stop, kind; code
    points; by start, then kind): the base spans, and as ``random`` the accepted
    candidates.  With ``keep_row``, also the input's column ``row`` and
    ``clean_text``, the text with every span replaced."""
    least = accepted_levels(docs, fdr)
    row = ["row"] if keep_row else []

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = batch.column("text").to_pylist()
            spans = [accepted_spans(t or "", least) for t in texts]
            columns = [batch.column("doc_id"),
                       pa.array([[dict(zip(("start", "stop", "kind"), x, strict=True)) for x in s] for s in spans], _SPAN)]
            if keep_row:
                clean = [redact(t, [x[:2] for x in s]) if s else t for t, s in zip(texts, spans, strict=True)]
                columns += [batch.column("row"), pa.array(clean, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans", *row, *(["clean_text"] if keep_row else [])])

    kinds = dict(docs.dtypes)
    kept = f", row {kinds['row']}, clean_text string" if keep_row else ""
    return docs.select("doc_id", "text", *row).mapInArrow(
        run, f"doc_id {kinds['doc_id']}, spans array<struct<start:int,stop:int,kind:string>>{kept}")


def redact(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with every covered run replaced by a mark."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = b
    return "".join([*out, text[at:]])
