"""Fill-in-middle transformation; units are found by SWAR on words of eight bytes.

A text is cut into units, each a run of other characters with the ASCII white
space before it (white space at the end is a unit). The UTF-8 bytes of a batch
are viewed as little-endian uint64; white space is recognised in eight bytes at
once by carry-free arithmetic, and a byte ends a unit if it is none and the next
one is, or if it is a text's last. ``bitwise_count`` counts the marks of a word,
a search in their running sum finds the word of the k-th mark, and the byte in
the word is selected by a multiplication that sums marks and a comparison of all
eight sums at once. Characters are counted in the same way, by marks on bytes
that begin one.

The split points and the form come from a hash of the id, so a document is always
treated alike. Null and empty texts are plain; a null id counts as empty text.
Texts that hold one of the marks are plain, since the output could not be read
back. Texts are cut whole, of any length: a step holds about ``STEP_BYTES`` of
them, or one text that is longer, and a few arrays of that size. Repeated rows
are treated alike; no row meets another. An input column named like an output
column is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import ship, struct_array, text_of, with_result

PLAIN, PSM, SPM = "plain", "psm", "spm"
# What stands before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
# Bytes of text that one step holds in its arrays.
STEP_BYTES = 4 << 20

RESULT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"
KIND = pa.struct([
    ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])


def _every(byte: int) -> np.uint64:
    """The byte in all eight places of a word."""
    return np.uint64(int.from_bytes(bytes([byte]) * 8, "little"))


HIGH, LOW, ONES = _every(0x80), _every(0x7F), _every(0x01)


def space_marks(words: np.ndarray) -> np.ndarray:
    """0x80 in each byte that is 0x20 or 0x09 to 0x0D, 0 in the others."""
    low = words & LOW
    # sums of seven bits each stay inside their bytes
    from_tab = low + _every(0x80 - 0x09)
    after_return = low + _every(0x80 - 0x0E)
    not_blank = (low ^ _every(0x20)) + LOW
    return ((from_tab & ~after_return) | ~not_blank) & ~words & HIGH


def start_marks(words: np.ndarray) -> np.ndarray:
    """0x80 in each byte that begins a character: all but 10xxxxxx."""
    return ~(words & (~words << np.uint64(1))) & HIGH


def unit_end_marks(words: np.ndarray, last_bytes: np.ndarray) -> np.ndarray:
    """0x80 in each byte that ends a unit; ``last_bytes``: where the texts end."""
    space = space_marks(words)
    following = space >> np.uint64(8)
    following[:-1] |= space[1:] << np.uint64(56)
    ends = following & ~space & HIGH
    bits = np.uint64(0x80) << (np.uint64(8) * (last_bytes & 7).astype(np.uint64))
    np.bitwise_or.at(ends, last_bytes >> 3, bits)
    return ends


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, words: np.ndarray):
        self._words = words
        # one more word, so that the place after the last byte has a rank
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self._padded = np.append(words, np.uint64(0))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before each byte."""
        word = at >> 3
        below = (np.uint64(1) << (np.uint64(8) * (at & 7).astype(np.uint64))) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._padded[word] & below)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The byte of the mark of each number, counted from 1."""
        word = np.searchsorted(self._before, number, "left") - 1
        inside = (number - self._before[word]).astype(np.uint64)
        sums = (self._words[word] >> np.uint64(7)) * ONES  # byte k: marks in bytes 0 to k
        reached = ((sums | HIGH) - inside * ONES) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


@dataclass(frozen=True)
class Settings:
    marks: tuple[str, str, str] = MARKS
    fim_percent: int = FIM_PERCENT
    spm_percent: int = SPM_PERCENT


def transform(data: np.ndarray, ends: np.ndarray, hashes: np.ndarray, settings: Settings) -> pa.StructArray:
    """The result of texts whose bytes lie one after the other in ``data``.

    ``ends``: where each text ends; ``hashes``: four numbers of each text.
    """
    starts = np.concatenate([[0], ends[:-1]])
    padded = np.zeros(max(len(data) + 7 >> 3, 1) << 3, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    units = Marks(unit_end_marks(words, ends[ends > starts] - 1))
    chars = Marks(start_marks(words))
    before = units.rank(starts)
    n = units.rank(ends) - before
    cuts = np.sort(hashes[:, :2] % (n + 1)[:, None], axis=1)

    def place(k: np.ndarray) -> np.ndarray:
        at = starts.copy()
        some = k > 0
        at[some] = units.select(before[some] + k[some]) + 1
        return at

    middle, suffix = place(cuts[:, 0]), place(cuts[:, 1])
    prefix_chars = chars.rank(middle) - chars.rank(starts)
    middle_chars = chars.rank(suffix) - chars.rank(middle)
    chosen = (hashes[:, 2] % 100 < settings.fim_percent) & (ends > starts)
    spm = hashes[:, 3] % 100 < settings.spm_percent
    p, s, m = (mark.encode() for mark in settings.marks)
    whole = data.tobytes()
    forms, outputs = [], []
    for k, (a, b, c, d) in enumerate(zip(starts.tolist(), middle.tolist(), suffix.tolist(), ends.tolist())):
        if not chosen[k] or any(whole.find(mark, a, d) >= 0 for mark in (p, s, m)):
            forms.append(PLAIN)
            outputs.append(whole[a:d])
        elif spm[k]:
            forms.append(SPM)
            outputs.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
        else:
            forms.append(PSM)
            outputs.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
    plain = np.array([form == PLAIN for form in forms], dtype=bool)
    return struct_array([
        ("n", pa.array(n, pa.int64())),
        ("form", pa.array(forms, pa.string())),
        ("prefix_chars", pa.array(prefix_chars, pa.int64(), mask=plain)),
        ("middle_chars", pa.array(middle_chars, pa.int64(), mask=plain)),
        ("output", pa.array(outputs, pa.binary()).view(pa.string())),
    ])


def byte_steps(texts: pa.Array, bound: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, rows to, their bytes and where each text ends in them.

    The bytes are a view of the batch; a text is never cut.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(ends, ends[low] + bound, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield low, high, held[ends[low] : ends[high]], ends[low + 1 : high + 1] - ends[low]
        low = high


def id_hashes(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers from the first 32 hex digits of the SHA-256 of seed and id."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), text), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """``docs`` with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``fim_percent`` of the documents are transformed, ``spm_percent`` of these
    with the suffix first. The marks have to begin with a character that they
    do not hold otherwise, so that none can arise where parts meet.
    """
    p, s, m = marks
    if len({p, s, m}) < 3 or any(not x or x[0] != p[0] or x[0] in x[1:] for x in marks):
        raise ValueError("three different marks with a first character of their own")
    if any(a != b and a in b for a in marks for b in marks):
        raise ValueError("no mark may hold another")
    ship(docs.sparkSession)
    settings = Settings((p, s, m), fim_percent, spm_percent)

    def apply(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *columns in batches:
            hashes = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1)
            parts = [
                transform(data, ends, hashes[low:high], settings)
                for low, high, data, ends in byte_steps(texts)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], KIND)

    result = F.arrow_udf(apply, RESULT).asNondeterministic()(
        text_of(text), *id_hashes(F.col(f"`{doc_id}`"), seed)
    )
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    return with_result(docs, result, {name: name for name in names})


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text, read back from an output and its form."""
    p, s, m = marks

    def between(after: str, before: str | None) -> Column:
        rest = F.substring_index(output, after, -1)
        return rest if before is None else F.substring_index(rest, before, 1)

    return (
        F.when(form == PSM, F.concat(between(p, s), between(m, None), between(s, m)))
        .when(form == SPM, F.concat(between(p, m), between(m, None), between(s, p)))
        .otherwise(output)
    )
