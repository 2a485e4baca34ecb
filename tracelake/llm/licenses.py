"""Licence scan with ordered signature rules.

A text is turned into words (ASCII letters in lower case, digits, and everything
beyond ASCII), joined by blanks. Keywords found in it open the gates of the
rules that need them; the open rules are matched as regular expressions on whole
words. A detection inside another of higher priority, or of equal priority and
greater length or earlier rule, is suppressed. Base phrases are rules of their
own whose places are counted and are never suppressed.

Null texts count as empty: no words, no places, empty labels, score 0. Texts are
scanned whole. Repeated rows are scanned alike. An input column named like an
output column is replaced.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import ship, text_of, with_result
from tracelake.llm.license_rules import Rule, rules

FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("score", pa.float64()),
    ("detections", pa.list_(pa.struct([
        ("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()),
        ("weight", pa.float64()),
    ]))),
]
RESULT = (
    "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, "
    "base_labels: string, labels: string, score: double, "
    "detections: array<struct<label: string, start_word: bigint, end_word: bigint, weight: double>>>"
)

# Upper case to lower case, all other ASCII that is no letter or digit to a blank.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32
    for b in range(256)
)


@functools.cache
def gates() -> list[tuple[bytes, list[tuple[int, Rule, re.Pattern]]]]:
    """The compiled rules under their keywords."""
    found: dict[str, list[tuple[int, Rule, re.Pattern]]] = {}
    for order, rule in enumerate(rules()):
        # the blank before is part of the match, so that the search is for a fixed beginning
        whole = re.compile(b" " + rule.pattern.encode() + rb"(?= )")
        found.setdefault(rule.keyword, []).append((order, rule, whole))
    return [(b" " + keyword.encode(), under) for keyword, under in found.items()]


def scan(text: str) -> dict:
    """What the rules find in one text; words are counted from 0, ends are exclusive."""
    words = text.encode("utf-8").translate(WORD_BYTES).split(b" ")
    words = [w for w in words if w]
    joined = b" " + b" ".join(words) + b" "
    base, others = [], []
    for keyword, under in gates():
        if keyword not in joined:
            continue
        for order, rule, pattern in under:
            for m in pattern.finditer(joined):
                (base if rule.base else others).append((m.start() + 1, m.end(), order, rule))
    kept = suppressed(others)
    # places of characters to numbers of words, in one pass
    number, count, before = {}, -1, 0
    for at in sorted({x for start, end, _, _ in (*base, *kept) for x in (start, end)}):
        count += joined.count(b" ", before, at)
        number[at] = count
        before = at
    starts = [number[start] for start, _, _, _ in base]
    base_labels = {rule.label for *_, rule in base}
    missed = 1.0
    for *_, rule in (*base, *kept):
        missed *= 1 - rule.weight
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {rule.label for *_, rule in kept})),
        "score": 1 - missed,
        "detections": [
            {"label": r.label, "start_word": number[s], "end_word": number[e] + 1, "weight": r.weight}
            for s, e, _, r in sorted((*base, *kept), key=lambda d: d[:3])
        ],
    }


def suppressed(found: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, int, Rule]]:
    """The detections that no stronger one contains.

    They are passed by start, the longest first: what contains a detection comes
    before it and has not ended.
    """
    strength = lambda d: (d[3].priority, d[1] - d[0], -d[2])
    by_start = sorted(found, key=lambda d: (d[0], -d[1], -d[3].priority, d[2]))
    kept: list[tuple[int, int, int, Rule]] = []
    open_: list[tuple[int, int, int, Rule]] = []
    for one in by_start:
        open_ = [o for o in open_ if o[1] > one[0]]
        if not any(o[1] >= one[1] and strength(o) > strength(one) for o in open_):
            kept.append(one)
        open_.append(one)
    return kept


def scan_of(spark: SparkSession):
    """A column function from text to the struct ``RESULT``."""
    ship(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([scan(t.as_py() or "") for t in texts], pa.struct(FIELDS))

    return F.arrow_udf(run, RESULT).asNondeterministic()


def scan_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the fields of ``RESULT``."""
    names = {name: name for name, _ in FIELDS}
    return with_result(docs, scan_of(docs.sparkSession)(text_of(text)), names)
