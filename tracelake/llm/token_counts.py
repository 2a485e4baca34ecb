"""Token counts by the whole-token shortcut.

Offline, on the driver, every string of the vocabulary that ends a word is
encoded alone; those that come out as one token, themselves, are proven. A text
is normalised and cut into pre-tokens; a proven pre-token counts one without
being merged, any other is merged by the tokenizer's model. Results are those of
the library without begin, end or added tokens; the special strings of the
tokenizer inside a text are one token each, as is its default.

Pre-tokens of texts in Latin scripts are cut by a compiled pattern that agrees
with the tokenizer's on these characters; other texts are cut by the library.
Null and empty texts have no tokens. Texts are counted whole, one by one; the
memory of merged pre-tokens is bounded and changes no result. Repeated rows are
counted alike. An input column named like an output column is replaced.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import ship, text_of, with_result

WORD_END = "</w>"
LIMIT = 2048
# Merged pre-tokens that a worker remembers.
REMEMBERED = 500_000

# Characters of Latin scripts on which the steps below and the tokenizer's are the
# same: categories and lower case have not changed for many versions of Unicode,
# lower case stays among them, nothing composes. (The dotted capital I is left
# out, since its lower case has a combining dot.)
LATIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x180)) if c != 0x130]
BLANKS = " \t\n\v\f\r"


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in LATIN if unicodedata.category(c).startswith(kind))


LETTERS, NUMBERS = _class("L"), _class("N")
IS_LATIN = re.compile(f"[{BLANKS}{re.escape(''.join(LATIN))}]*").fullmatch
PRETOKENS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+"
).findall


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others are numbered on
    from 256.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTES = byte_alphabet()
BYTE_OF = {c: b for b, c in BYTES.items()}


def proven(tokenizer_json: str) -> list[str]:
    """Vocabulary strings, without the word end, that encode alone as one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    found = []
    for string in tokenizer.get_vocab(with_added_tokens=False):
        if string.endswith(WORD_END) and len(string) > len(WORD_END):
            tokens = tokenizer.model.tokenize(string[: -len(WORD_END)])
            if len(tokens) == 1 and tokens[0].value == string:
                found.append(string[: -len(WORD_END)])
    return sorted(found)


class _Counts(dict):
    """Tokens per pre-token: proven ones from the start, others when they are met."""

    def __init__(self, ones, merge):
        super().__init__(dict.fromkeys(ones, 1))
        self._ones, self._merge = len(self), merge

    def __missing__(self, piece: str) -> int:
        count = self._merge(piece)
        if len(piece) <= 100:
            if len(self) >= self._ones + REMEMBERED:
                for key in list(self)[self._ones :]:
                    del self[key]
            self[piece] = count
        return count


class Counter:
    """Counts the tokens of texts in one process."""

    def __init__(self, tokenizer_json: str, ones: list[str]):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        model = tokenizer.model
        self._normalize = tokenizer.normalizer.normalize_str
        self._cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self._encoded = _Counts(ones, lambda piece: len(model.tokenize(piece)))
        plain = (bytes(BYTE_OF[c] for c in s).decode("utf-8", "replace") for s in ones)
        self._plain = _Counts(
            (s for s in plain if IS_LATIN(s)),
            lambda piece: len(model.tokenize("".join(BYTES[b] for b in piece.encode()))),
        )
        special = [
            re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values() if t.special
        ]
        self._special = re.compile("|".join(special)) if special else None

    def __call__(self, text: str) -> int:
        if self._special is None or not (marks := len(self._special.findall(text))):
            return self._ordinary(text)
        return marks + sum(map(self._ordinary, self._special.split(text)))

    def _ordinary(self, text: str) -> int:
        if not text:
            return 0
        if IS_LATIN(text):
            return sum(map(self._plain.__getitem__, PRETOKENS(text.lower())))
        return sum(self._encoded[piece] for piece, _ in self._cut(self._normalize(text)))


_counters: dict[int, Counter] = {}


def count_of(spark: SparkSession, tokenizer_json: str):
    """A column function from text to its number of tokens."""
    ship(spark)
    ones = proven(tokenizer_json)
    shared = spark.sparkContext.broadcast((tokenizer_json, ones))
    number = hash(tokenizer_json) % sys.maxsize

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if number not in _counters:
            _counters[number] = Counter(*shared.value)
        counter = _counters[number]
        for texts in batches:
            yield pa.array([counter(t.as_py() or "") for t in texts], pa.int64())

    return F.arrow_udf(count, "bigint").asNondeterministic()


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        count = count_of(docs.sparkSession, file.read())
    # the count is a field so that it is not run again for over_limit
    result = F.struct(
        F.octet_length(text_of(text)).cast("bigint").alias("b"), count(text_of(text)).alias("n")
    )
    counted = with_result(docs, result, {"b": "n_bytes", "n": "n_tokens"})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
