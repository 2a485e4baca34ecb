"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its hashed character n-grams (one to
four characters, inside words with their ends marked); a linear softmax on the
average gives the languages, and beside them one score for noise. Both layers are
trained together by stochastic gradient descent in numpy on a bounded sample of
labelled rows. Noise is learnt from the same rows: their letters shuffled, letters drawn
evenly from theirs, and n-grams never seen. A held-back part of the sample fixes the
temperature of the probabilities, and, against its own letters shuffled or drawn, how
much likelier than any language noise has to be for a text to be rejected.

Nulls, empty texts and texts without a letter get ``und`` with score 0 and are
rejected. Very long texts are averaged whole. Repeated rows are predicted alike. Without
any labelled row, as in an empty table, nothing is known and every text is ``und``. An
input column named like an output column is replaced.
"""

from __future__ import annotations

import functools
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import (
    below,
    id_remainder,
    ship,
    steps,
    stored,
    struct_array,
    text_of,
    with_result,
)
from tracelake.plans.joins import lookup_join, settle

UNKNOWN = "und"
# The sample that the model is fitted on, in rows: about so many of each language,
# and fewer of each where that would be more than about so many in all.
ROWS_PER_LANGUAGE = 1000
MAX_ROWS = 10_000
# Words of the stretches that are learnt from a text of the sample, its bound in words;
# held-back texts are whole, and so are texts that are predicted.
PIECE_WORDS = (3, 6, 15, 40)
BUCKETS = 1 << 15
WIDTH = 8
EPOCHS = 3
RATE = 0.5
# A text of a language that is rejected is as bad as this many of noise that are not.
REJECTED_COST = 20
SEED = 7

RESULT = "struct<lang_pred: string, score: double, rejected: boolean>"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # a row for each bucket: the languages' scores, then that of noise
    bias: np.ndarray
    temperature: float
    most_noise: float  # of noise's score less the best language's


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, the text each belongs to, letters seen.

    Everything that is not a letter separates words; runs of it count once.
    """
    joined = "\x00" + "\x00".join(t.replace("\x00", " ").lower() for t in texts) + "\x00"
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    letters = letter_table()[codes]
    owner = np.cumsum(codes == 0) - 1
    has_letter = np.zeros(len(texts), dtype=bool)
    has_letter[np.unique(owner[letters])] = True
    # one separator between words, then n-grams that do not span words
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    keep[:-1] |= letters[1:]
    codes = np.where(letters, codes, 0)[keep].astype(np.uint64)
    inside = letters[keep]
    owner = owner[keep]
    found, owners = [], []
    value = np.zeros(len(codes), dtype=np.uint64)
    reach = np.ones(len(codes), dtype=bool)
    for n in range(1, 5):
        size = len(codes) - n + 1
        if size <= 0:
            break
        # a separator may begin or end an n-gram, never stand inside it
        if n > 2:
            reach = reach[:size] & inside[n - 2 : n - 2 + size]
        else:
            reach = reach[:size]
        value = value[:size] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
        good = reach & (inside[:size] | inside[n - 1 :])
        mixed = value[good] * np.uint64(0xD6E8FEB86659FD93)
        found.append((mixed >> np.uint64(64 - 15)).astype(np.int64))
        owners.append(owner[:size][good])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    return np.concatenate(found), np.concatenate(owners), has_letter


@functools.cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool)


def bags(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their counts."""
    for text in texts:
        yield np.unique(ngram_buckets([text])[0], return_counts=True)


def logits(model_weights: np.ndarray, bias: np.ndarray, texts: list[str]):
    """Language scores per text, and which texts have a letter."""
    buckets, owners, has_letter = ngram_buckets(texts)
    found = np.bincount(owners, minlength=len(texts)).astype(float)
    total = np.stack(
        [
            np.bincount(owners, weights=model_weights[buckets, k], minlength=len(texts))
            for k in range(model_weights.shape[1])
        ],
        axis=1,
    )
    return total / np.maximum(found, 1.0)[:, None] + bias, has_letter


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame) -> DataFrame:
    """Bags of n-grams of a bounded sample of the labelled rows.

    Rows are picked by a hash of their id from ids and labels alone; texts are
    read for the picked rows only, and leave the executors as bags.
    """
    ship(docs.sparkSession)
    order = F.xxhash64(F.lit("language sample"), F.col("_id"))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("_id"), F.col("lang").alias("_lang"),
        id_remainder("doc_id", 5).alias("_part"), F.col("text").alias("_text"),
    ).where("_part != 0 AND _lang IS NOT NULL AND _id IS NOT NULL")
    # about the bound of each language by the hash alone, so no task meets a language;
    # the bound of all is dealt out to the languages, so nothing is cut afterwards
    names = rows.select("_id", "_lang", order.alias("_order"))
    counts = settle(names.groupBy("_lang").agg(F.count("*").alias("_rows")))
    each = min(ROWS_PER_LANGUAGE, MAX_ROWS / max(counts.df.count(), 1))
    picked = stored(
        lookup_join(names, counts, ["_lang"], spread_by="_id")
        .where(below(F.col("_order"), F.lit(float(each)) / F.col("_rows")))
        .select("_id").distinct(),
        "language-sample",
    )

    def to_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, lang, text in zip(*(batch.column(c) for c in ("_id", "_lang", "_text"))):
                name, text = name.as_py(), text.as_py() or ""
                held = zlib.crc32(f"held {name}".encode()) % 5 == 0
                parts = [text, *pieces(name, text)] if held else pieces(name, text)
                found = [(False, *bag) for bag in bags(parts)]
                found += [(True, *bag) for bag in noise(name, parts, held)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(found), pa.string()),
                        pa.array([lang.as_py()] * len(found), pa.string()),
                        pa.array([held] * len(found), pa.bool_()),
                        pa.array([n for n, _, _ in found], pa.bool_()),
                        pa.array(range(len(found)), pa.int32()),
                        pa.array([b.astype(np.int32) for _, b, _ in found], pa.list_(pa.int32())),
                        pa.array([c.astype(np.float32) for _, _, c in found], pa.list_(pa.float32())),
                    ],
                    names=["id", "lang", "held", "noise", "piece", "buckets", "counts"],
                )

    # about MAX_ROWS ids at most, so the broadcast is bounded
    return rows.join(F.broadcast(picked), "_id").select("_id", "_lang", "_text").mapInArrow(
        to_bags,
        "id string, lang string, held boolean, noise boolean, piece int, buckets array<int>, counts array<float>",
    )


def pieces(name: str, text: str) -> list[str]:
    """What is learnt from a text: stretches of several lengths all over it.

    They teach the model to be right about short texts too, and keep the bags
    small. Texts are predicted as wholes.
    """
    words = text.split()
    rng = np.random.default_rng(zlib.crc32(f"pieces {name}".encode()))
    starts = [(n, int(rng.integers(0, max(len(words) - n, 0) + 1))) for n in PIECE_WORDS]
    return [" ".join(words[i : i + n]) for n, i in starts]


def noise(name: str, parts: list[str], held: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bags of n-grams that no language has, made of the letters of some parts of a text.

    Of each other part the letters are shuffled, of the rest they are drawn evenly from
    all letters there; in training, the bag of the shortest part is spread over buckets
    at random, as n-grams never seen are.
    """
    rng = np.random.default_rng(zlib.crc32(f"noise {name}".encode()))
    # of held-back texts the whole text is left to the languages
    for k, part in enumerate(parts[1:] if held else parts):
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), dtype=np.uint32).copy()
        places = np.flatnonzero(letter_table()[codes])
        if not len(places):
            continue
        letters = codes[places]
        codes[places] = rng.permutation(letters) if k % 2 else rng.choice(np.unique(letters), len(letters))
        found = ngram_buckets([codes.tobytes().decode("utf-32-le")])[0]
        if not k and not held:
            found = rng.integers(0, BUCKETS, len(found))
        yield np.unique(found, return_counts=True)


def fit(docs: DataFrame) -> LanguageModel:
    """Train on about ``MAX_ROWS`` rows at most (ids may repeat) of ``docs``."""
    rows = sample(docs).toArrow().sort_by([(c, "ascending") for c in ("id", "lang", "piece")])
    rows = rows.filter(pc.greater(pc.list_value_length(rows.column("buckets")), 0)).combine_chunks()
    lang = rows.column("lang").to_pylist()
    languages = sorted(set(lang))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 1)), np.zeros(1), 1.0, np.inf)
    rng = np.random.default_rng(SEED)
    number = {lang: k for k, lang in enumerate(languages)}
    classes = len(languages) + 1  # the last is noise
    target = np.where(rows.column("noise"), len(languages), [number[name] for name in lang])
    is_held = np.array(rows.column("held"))
    # views into the columns; the sample is never turned into objects
    buckets_of, counts_of = (
        np.split(column.flatten().to_numpy(), column.offsets.to_numpy()[1:-1])
        for column in (rows.column(c).chunk(0) for c in ("buckets", "counts"))
    )
    held, train = np.flatnonzero(is_held), np.flatnonzero(~is_held)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    linear = rng.normal(0, 0.1, (WIDTH, classes))
    bias = np.zeros(classes)
    seen = np.bincount(target[train], minlength=classes)
    weight = np.minimum(len(train) / (classes * np.maximum(seen, 1)), 4.0)
    done, all_steps = 0, EPOCHS * max(len(train), 1)
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            rate = RATE * (1 - done / all_steps)
            done += 1
            buckets, share = buckets_of[i], counts_of[i] / counts_of[i].sum()
            mean = share @ table[buckets]
            score = mean @ linear + bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[target[i]] -= 1.0
            p *= weight[target[i]] * rate
            back = linear @ p
            linear -= np.outer(mean, p)
            bias -= 0.1 * p
            table[buckets] -= np.outer(share, back)
    weights = table @ linear
    if not len(held):
        return LanguageModel(languages, weights, bias, 1.0, np.inf)
    raw = np.stack(
        [counts_of[i] / counts_of[i].sum() @ weights[buckets_of[i]] + bias for i in held]
    )
    return LanguageModel(languages, weights, bias, *calibrate(raw, target[held]))


def calibrate(raw: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """The temperature of the least log loss, and how much likelier noise may be.

    Noise is the last class. The bound is the middle of the range in which texts
    rejected wrongly and noise kept cost least.
    """
    is_noise = target == raw.shape[1] - 1
    spoken, names = raw[~is_noise, :-1], target[~is_noise]

    def loss(power: float) -> float:
        p = softmax(spoken / np.exp(power))[np.arange(len(names)), names]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    power, step = 0.0, 4.0
    while len(names) and step > 0.01:
        # steps are halved around the best so far, so no grid bounds it
        best = min((power - step, power, power + step), key=loss)
        power, step = (best, step / 2) if best == power else (best, step)
        if abs(power) > 40:
            break  # all right or all wrong at any temperature
    excess = raw[:, -1] - raw[:, :-1].max(axis=1)
    return float(np.exp(power)), _bound(excess[~is_noise], excess[is_noise])


def _bound(spoken: np.ndarray, noise_: np.ndarray) -> float:
    """The bound on noise's excess between texts of languages and noise."""
    if not len(spoken) or not len(noise_):
        return float("inf")
    cuts = np.unique(np.concatenate([spoken, noise_]))
    rejected = 1 - np.searchsorted(np.sort(spoken), cuts, "right") / len(spoken)
    kept = np.searchsorted(np.sort(noise_), cuts, "right") / len(noise_)
    best = int(np.argmin(REJECTED_COST * rejected + kept))
    return float((cuts[best] + cuts[min(best + 1, len(cuts) - 1)]) / 2)


def language_of(model: LanguageModel, spark) -> "callable":
    """A column function from text to the struct ``RESULT``."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            names, scores, rejected = [], [], []
            for part in steps(texts):
                if not known.languages:
                    names += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
                    rejected += [True] * len(part)
                    continue
                raw, has_letter = logits(known.weights, known.bias, part)
                p = softmax(raw[:, :-1] / known.temperature)
                best = p.argmax(axis=1)
                top = p.max(axis=1)
                noisy = raw[:, -1] - raw[:, :-1].max(axis=1) > known.most_noise
                for ok, k, s, n in zip(has_letter.tolist(), best.tolist(), top.tolist(), noisy.tolist()):
                    names.append(known.languages[k] if ok else UNKNOWN)
                    scores.append(s if ok else 0.0)
                    rejected.append(not ok or n)
            yield struct_array([
                ("lang_pred", pa.array(names, pa.string())),
                ("score", pa.array(scores, pa.float64())),
                ("rejected", pa.array(rejected, pa.bool_())),
            ])

    # not to be run a second time for a filter on its result
    return F.arrow_udf(predict, RESULT).asNondeterministic()


def identify(docs: DataFrame, model: LanguageModel | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    model = model or fit(docs)
    result: Column = language_of(model, docs.sparkSession)(text_of(text))
    return with_result(
        docs, result, {"lang_pred": "lang_pred", "score": "score", "rejected": "rejected"}
    )
