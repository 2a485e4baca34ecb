"""Quality scores by histogram gradient-boosted trees over document statistics.

A text is described by statistics of its characters, words and lines. Trees of
fixed depth are boosted on the logistic loss over histograms of the binned
statistics, on a bounded sample of labelled rows, and flattened into arrays that
numpy walks for all texts of a batch and all trees at once.

Null texts count as empty and are scored like any text. Rows are sampled by a
hash of their id; labels other than 0 and 1 are not learnt from. Without labelled
rows the score is 0.5, with labels of one kind it is the smoothed share of that
kind. Repeated rows are scored alike. An input column named like an output
column is replaced.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import bounded_sample, id_remainder, ship, text_of, with_result

# The bound of the sample that the trees are fitted on, in rows.
SAMPLE_ROWS = 20_000
BINS = 64
TREES = 120
DEPTH = 4
RATE = 0.12
RIDGE = 1.0
LEAST_WEIGHT = 2.0  # of second derivatives in a leaf

KINDS = ("lower", "upper", "other letter", "digit", "space", "stop", "mark", "symbol", "control")
STATISTICS = (
    *(f"share of {kind} characters" for kind in KINDS),
    "log characters", "log words", "mean word length", "spread of word lengths", "longest word",
    "share of distinct words", "share of the commonest word", "share of words like the one before",
    "share of distinct pairs of words", "share of short words", "share of words in capitals",
    "share of words with a digit", "share of words ending in a letter", "share of bare symbols",
    "share of capitalised words", "words per stop", "log lines", "share of repeated lines",
    "words per line", "share of lines ending in a stop", "entropy of characters",
    "compressed alphabet", "share of the commonest symbol",
)


@functools.cache
def kind_table() -> np.ndarray:
    """The kind of each code point, as a place in ``KINDS``."""
    kinds = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        category = unicodedata.category(c)
        if c in ".,;:?!":
            kinds[code] = 5
        elif c.isspace():
            kinds[code] = 4
        elif category in ("Ll", "Lu"):
            kinds[code] = category == "Lu"
        else:
            kinds[code] = {"L": 2, "M": 2, "N": 3, "P": 6, "S": 7}.get(category[0], 8)
    return kinds


def statistics(text: str) -> np.ndarray:
    """The statistics of a text, all 0 for an empty one."""
    out = np.zeros(len(STATISTICS), dtype=np.float32)
    words = text.split()
    if not words:
        return out
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kinds = kind_table()[codes]
    out[:9] = np.bincount(kinds, minlength=9) / len(codes)
    n = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line.strip()]
    stops = sum(w[-1] in ".?!" for w in words)
    characters, found = np.unique(codes, return_counts=True)
    share = found / len(codes)
    marks = found[kind_table()[characters] >= 6]
    out[9:] = (
        np.log1p(len(codes)), np.log1p(n), lengths.mean(), lengths.std(), lengths.max(),
        len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        pairs / max(n - 1, 1), np.mean(lengths <= 2), sum(map(str.isupper, words)) / n,
        sum(not w.isalpha() and any(map(str.isdigit, w)) for w in words) / n,
        sum(w[-1].isalpha() for w in words) / n,
        sum(not w[0].isalnum() and not w[-1].isalnum() for w in words) / n,
        sum(map(str.istitle, words)) / n, n / (stops + 1), np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines), n / len(lines),
        sum(line.rstrip()[-1] in ".?!" for line in lines) / len(lines),
        -(share * np.log2(share)).sum(), len(characters) / np.sqrt(len(codes)),
        marks.max(initial=0) / len(codes),
    )
    return out


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth, flattened; a row for each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        if len(self.leaf):
            tree = np.arange(len(self.leaf))[None, :]
            row = np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.leaf)), dtype=np.int64)
            for _ in range(DEPTH):
                right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total += self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Fit the trees to rows of statistics and labels 0 or 1."""
    base = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(base / (1 - base)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    # x > edges[b] is the same as bin > b
    cell = bins + np.arange(width) * BINS
    score = np.full(n, start)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            at = ((node - first)[:, None] * (width * BINS) + cell).ravel()
            shape = (count, width, BINS)
            sums_g = np.bincount(at, np.repeat(g, width), count * width * BINS).reshape(shape)
            sums_h = np.bincount(at, np.repeat(h, width), count * width * BINS).reshape(shape)
            left_g, left_h = sums_g.cumsum(axis=2), sums_h.cumsum(axis=2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = (
                left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE)
                - all_g**2 / (all_h + RIDGE)
            )
            gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                f, edge = divmod(b, BINS)
                if gain[k, f, edge] > 1e-6 and edge < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][edge]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        place = node - inner
        leaf = -RATE * np.bincount(place, g, leaves) / (np.bincount(place, h, leaves) + RIDGE)
        score += leaf[place]
        features.append(feature)
        thresholds.append(threshold)
        values.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(values), start)


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``x, y``: statistics and labels of at most ``SAMPLE_ROWS`` labelled rows.

    Learnt from are ids whose remainder modulo four is not two.
    """
    ship(docs.sparkSession)
    known = labels.select(
        F.col("doc_id").alias("_id"), F.col(f"`{label}`").cast("int").alias("_y"),
        id_remainder("doc_id", 4).alias("_part"),
    ).where("_part != 2 AND _y IN (0, 1) AND _id IS NOT NULL")
    order = F.xxhash64(F.lit("quality sample"), F.col("_id").cast("string"), F.col("_y"))
    picked = bounded_sample(known, order, SAMPLE_ROWS)

    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t.as_py() or "") for t in texts], pa.list_(pa.float32()))

    described = F.arrow_udf(describe, "array<float>")
    rows = docs.select(F.col("doc_id").alias("_id"), text_of("text").alias("_text"))
    # at most SAMPLE_ROWS rows, so the broadcast is bounded
    return rows.join(F.broadcast(picked), "_id").select(
        "_id", described("_text").alias("x"), F.col("_y").alias("y")
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Trees:
    found = sample(docs, labels, label).toArrow().sort_by([("_id", "ascending"), ("y", "ascending")])
    y = found.column("y").to_numpy().astype(float)
    x = found.column("x").combine_chunks().values.to_numpy() if len(y) else np.zeros(0)
    x = x.reshape(len(y), len(STATISTICS)).astype(np.float64)
    # equal ids may come in any order; their rows do not depend on it
    order = np.lexsort((*x.T, y))
    return boost(x[order], y[order])


def score_of(trees: Trees, spark: SparkSession):
    """A column function from text to its score."""
    ship(spark)
    shared = spark.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [np.zeros(0)]
            for at in range(0, len(texts), 1000):
                x = [statistics(t.as_py() or "") for t in texts[at : at + 1000]]
                out.append(shared.value.scores(np.stack(x).astype(np.float64)))
            yield pa.array(np.concatenate(out), pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()


def score_documents(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """``docs`` with ``score``."""
    scored = score_of(trees, docs.sparkSession)(text_of(text))
    return with_result(docs, F.struct(scored.alias("s")), {"s": "score"})
