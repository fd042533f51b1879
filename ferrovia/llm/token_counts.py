"""Token counts from pre-token frequencies.

A byte-level tokenizer first cuts a text into pre-tokens, and the number of
pieces of a pre-token doesn't depend on its surroundings.  So each distinct
pre-token is given to the model once, its number of pieces is joined to the
per-document frequencies, and the products are summed; the ids themselves are
never made for a document.

Defined cases: a null or empty text has no tokens; a special token's string in
a text is one token, as the library does by default; repeated rows are counted
alike; an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm import token_sums
from ferrovia.llm.common import stored

# The pre-token pattern of byte-level vocabularies (a fixed value).
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|"
          r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_PATTERN = regex.compile(PIECES)
_BMP = "".join(map(chr, range(1 << 16)))


def _ranges(kind: str) -> str:
    """The code points below U+10000 of a property, as the inside of a class."""
    return "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in regex.findall(kind + "+", _BMP))


def _plain_pattern() -> re.Pattern:
    """``PIECES`` with its properties written out for ``re``, which finds the same
    pieces in less than half of the time, if no code point is beyond U+FFFF."""
    letter, number, space = map(_ranges, (r"\p{L}", r"\p{N}", r"\p{White_Space}"))
    return re.compile(PIECES.replace(r"\P{White_Space}", f"[^{space}]").replace(
        r"[^\p{White_Space}\p{L}\p{N}]", f"[^{space}{letter}{number}]").replace(
        r"\p{White_Space}", f"[{space}]").replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]"))


_PLAIN = _plain_pattern()


def pieces_of(text: str) -> list[str]:
    """Pre-tokens of a text without special strings."""
    plain = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return (_PLAIN if plain else _PATTERN).findall(text)


def splitter(specials: list[str]):
    """Text to pre-tokens; special strings are cut out first and stand for
    themselves."""
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None

    def split(text: str) -> list[str]:
        if cut is None or not any(s in text for s in specials):
            return pieces_of(text)
        out = []
        for i, part in enumerate(cut.split(text)):
            out += [part] if i % 2 else pieces_of(part)
        return out

    return split


def special_strings(path: str) -> list[str]:
    from tokenizers import Tokenizer
    return [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]


_TOKENIZERS: dict = {}


def piece_counts(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with ``pieces``: how many tokens the library makes of each."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = Tokenizer.from_file(path)
        tokenizer = _TOKENIZERS[path]
        for batch in it:
            words = [str(t, "utf-8") for t in batch.column("token").to_pylist()]
            pieces = []
            for i in range(0, len(words), 4096):
                pieces += [len(e) for e in tokenizer.encode_batch_fast(words[i:i + 4096], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())],
                                             [*batch.schema.names, "pieces"])

    kinds = ", ".join(f"{c} {t}" for c, t in tokens.dtypes)
    return tokens.mapInArrow(run, f"{kinds}, pieces long")


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_pretokens``, ``n_tokens``."""
    docs = docs.select("doc_id", "text")
    split = splitter(special_strings(tokenizer_path))
    distinct = token_sums.frequencies(docs.withColumn("counts", F.lit(True)), split)
    values = stored(piece_counts(distinct.select("token", "occurrences"), tokenizer_path), "pieces")
    found = token_sums.document_sums(docs, split, values, {"pieces": "long"}, decoded=True)
    return found.select("doc_id", "n_bytes", F.col("n_tokens").alias("n_pretokens"), F.col("pieces").alias("n_tokens"))
