"""Packing by lexical retrieval: neighbours of a document fill its window.

Each document becomes its token ids and an end id. Whole windows of a long
document are sequences by themselves; what is left of it, less than a window, is
packed with others. These rests are dealt to shards: a range of two weighted
min-hashes over their terms, so that rests with rare terms in common tend to
meet, and the hash of the row, so that a group of equal ones may be cut. A task
takes the rests of its range in order, a shard of bounded size at a time, and
builds an inverted index of the shard: postings of (rest, BM25 weight) by
token id, with document frequencies and mean length taken over all documents. The
first unused rest opens a window; the index returns its unused neighbours by
falling score; those that fit are placed whole, and the best one that does not is
cut to fill the window to the last token. What was cut off opens the next window
as its seed. Where no neighbour is left the next unused rest goes on. So only a
task's last window can have a gap.

Terms in more than half of all documents weigh nothing and are not indexed: the
inverse frequency of BM25 is not positive there. Statistics that reach the driver
have one row a token id of the vocabulary. Every id of every document is in one
piece, whatever its score: the index decides on the order, never on what is kept.

Null and empty texts are the end id alone. Very long texts are encoded whole, one
by one, and leave as windows; nothing else grows with a text. Repeated rows, equal
texts and null ids are documents like others. Special strings inside texts are
what the tokenizer makes of them by default. Other columns are ignored. An empty
table gives no pieces.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import ship, steps, text_of
from tracelake.llm.token_counts import BYTE_OF, BYTES, IS_LATIN, PRETOKENS, WORD_END
from tracelake.session import new_folder

WINDOW = 2048
END_ID = 1
# The usual parameters of BM25.
K1, B = 1.2, 0.75
# Tokens of one shard of the index, and of one task at most.
SHARD_TOKENS = 1 << 20
TASK_TOKENS = 64 << 20
# Characters of text that are encoded together.
STEP_CHARS = 8 << 20
# Words whose ids are put together at once, or those of one text.
STEP_WORDS = 1 << 15
# Words of a generation whose ids a worker remembers.
REMEMBERED = 500_000

WHOLE, REST, TERM = 0, 1, 2
# Counts that travel with the document frequencies, under terms of their own.
DOCS, RESTS, REST_TOKENS = -1, -2, -3
ENCODED = (
    "kind int, doc_id bigint, start bigint, doc_tokens bigint, ids binary, term int, df bigint"
)
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _schema(ddl)
    values = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)


# --- ids ------------------------------------------------------------------------

class _Remembered:
    """Ids of words as bytes, found when a word is first met.

    When the words of one generation are many it becomes the one before, and words
    not met again by the next change are forgotten.
    """

    def __init__(self, find):
        self._find, self._now, self._before = find, {}, {}

    def all(self, words: list[str]) -> list[bytes]:
        found = list(map(self._now.get, words))
        before, find = self._before.get, self._find
        for k, ids in enumerate(found):
            if ids is None:
                word = words[k]
                ids = before(word)
                if ids is None:
                    ids = find(word)
                found[k] = ids
                if len(word) <= 100:
                    self._now[word] = ids
        if len(self._now) >= REMEMBERED:
            self._now, self._before = {}, self._now
        return found


class Encoder:
    """The ids of texts, as the library gives them without begin and end.

    For a vocabulary of words with a mark at their end, in lower case, the words of
    Latin texts are cut by Arrow and looked up once for each step of texts; ids
    are put together by their word's number.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer_json)
        model = self._tokenizer.model
        self.size = 1 + max(self._tokenizer.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        as_bytes = [k.to_bytes(self.dtype.itemsize, "little") for k in range(self.size)]

        def of_word(word: str) -> bytes:
            if not word.isalpha() and len(pieces := PRETOKENS(word)) != 1:
                return b"".join(self._words.all(pieces))
            # printable ASCII stands for itself
            shown = word if word.isascii() else "".join(BYTES[b] for b in word.encode())
            return b"".join([as_bytes[t.id] for t in model.tokenize(shown)])

        self._words = _Remembered(of_word)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._by_words = (
            getattr(model, "end_of_word_suffix", None) == WORD_END
            and len(BYTE_OF) == 256
            and self._tokenizer.normalizer is not None
            and self._tokenizer.normalizer.normalize_str(" Ab  É ").split() == ["ab", "é"]
        )

    def __call__(self, text: str) -> np.ndarray:
        return next(self.encode([text]))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        known = [
            self._by_words and IS_LATIN(t) and not (self._special and self._special.search(t)) for t in texts
        ]
        latin = self._latin(pa.array([t for t, k in zip(texts, known) if k], pa.large_string()))
        for text, k in zip(texts, known):
            yield next(latin) if k else np.array(
                self._tokenizer.encode(text, add_special_tokens=False).ids, self.dtype
            )

    def _latin(self, texts: pa.Array) -> Iterator[np.ndarray]:
        # Latin texts have no other white space; the split by Unicode's misses blanks at
        # the end of what utf8_lower returns
        cut = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        numbered = cut.values.dictionary_encode()
        found = self._words.all(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, found), np.int32, len(found)) // self.dtype.itemsize
        begins = np.cumsum(lengths, dtype=np.int64) - lengths
        flat = np.frombuffer(b"".join(found), self.dtype)
        # numbers of half the size, wherever they are enough
        small = np.int32 if len(flat) < 1 << 31 else np.int64
        begins = begins.astype(small)
        word = numbered.indices.to_numpy()
        ends = cut.offsets.to_numpy()
        text = 0
        while text < len(ends) - 1:
            # texts of few words are put together at once
            last = max(int(np.searchsorted(ends, ends[text] + STEP_WORDS, "right")) - 1, text + 1)
            mine = word[ends[text] : ends[last]]
            count = lengths[mine]
            after = np.cumsum(count, dtype=np.int64)
            size = int(after[-1]) if len(after) else 0
            wide = small if size < 1 << 31 else np.int64
            before = (after - count).astype(wide)
            ids = flat[np.repeat(begins[mine].astype(wide, copy=False) - before, count) + np.arange(size, dtype=wide)]
            bounds = np.append(0, after)[ends[text : last + 1] - ends[text]].tolist()
            for low, high in zip(bounds[:-1], bounds[1:]):
                yield ids[low:high]
            text = last


_encoders: dict[str, Encoder] = {}


def _encoded(docs: DataFrame, tokenizer_json: str, window: int, end_id: int) -> DataFrame:
    """Windows, rests and document frequencies of each task, by ``kind``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value not in _encoders:
            _encoders[shared.value] = Encoder(shared.value)
        encoder = _encoders[shared.value]
        df, distinct = np.zeros(encoder.size, np.int64), Distinct(encoder.size)
        counts = {DOCS: 0, RESTS: 0, REST_TOKENS: 0}
        end = np.array([end_id], encoder.dtype)
        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for texts in steps(batch.column(1), STEP_CHARS):
                out = []
                for doc_id, ids in zip(itertools.islice(doc_ids, len(texts)), encoder.encode(texts)):
                    ids = np.append(ids, end)
                    df[distinct(ids)] += 1
                    counts[DOCS] += 1
                    last = len(ids) // window * window
                    for start in range(0, last, window):
                        piece = ids[start : start + window]
                        out.append((WHOLE, doc_id, start, len(ids), piece.tobytes(), None, None))
                    if last < len(ids):
                        out.append((REST, doc_id, last, len(ids), ids[last:].tobytes(), None, None))
                        counts[RESTS] += 1
                        counts[REST_TOKENS] += len(ids) - last
                yield _rows(out, ENCODED)
        seen = np.flatnonzero(df)
        totals = [*zip(seen.tolist(), df[seen].tolist()), *((t, n) for t, n in counts.items() if n)]
        yield _rows([(TERM, None, None, None, None, t, n) for t, n in totals], ENCODED)

    return docs.mapInArrow(encode, ENCODED)


class Distinct:
    """The distinct ids of an array, in order: sorted if they are few, else by marks on all ids."""

    def __init__(self, size: int):
        self._marks = np.zeros(size, dtype=bool)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        if 0 < len(ids) < len(self._marks) >> 5:
            # a radix sort, for numbers of two bytes
            ids = np.sort(ids, kind="stable")
            return ids[np.append(True, ids[1:] != ids[:-1])].astype(np.int64)
        self._marks[ids] = True
        found = np.flatnonzero(self._marks)
        self._marks[found] = False
        return found


# --- the index ------------------------------------------------------------------

@dataclass(frozen=True)
class Statistics:
    """Over all documents: inverse frequency of each term, mean length of a rest."""

    idf: np.ndarray
    mean_length: float
    dtype: str

    def ranks(self, number: int) -> np.ndarray:
        """Places of the terms in one weighted order: the first of a set is its min-hash.

        A term of weight w comes first of a set with a chance in proportion to w.
        """
        random = np.random.default_rng(number).random(len(self.idf))
        with np.errstate(divide="ignore"):
            arrival = -np.log1p(-random) / self.idf
        ranks = np.empty(len(arrival), np.int32)
        ranks[np.argsort(arrival, kind="stable")] = np.arange(len(arrival), dtype=np.int32)
        return ranks


def inverse_frequency(df: np.ndarray, docs: int) -> np.ndarray:
    """BM25's, nothing for terms in half of all documents or more."""
    return np.maximum(0.0, np.log((docs - df + 0.5) / (df + 0.5)))


class Index:
    """Postings of a shard by term: which rests hold it, with what weight."""

    def __init__(self, rests: list[np.ndarray], statistics: Statistics):
        self._count = len(rests)
        terms = len(statistics.idf)
        lengths = np.array([len(r) for r in rests], np.int64)
        # term and rest in one number, so that sorting makes the postings
        pairs = np.concatenate([r.astype(np.int64) for r in rests] or [np.zeros(0, np.int64)]) * self._count
        pairs += np.repeat(np.arange(self._count), lengths)
        pairs = pairs[statistics.idf[pairs // max(self._count, 1)] > 0]
        pairs, often = np.unique(pairs, return_counts=True)
        term, self._rest = np.divmod(pairs, max(self._count, 1))
        norm = K1 * (1 - B + B * lengths / statistics.mean_length)
        self._weight = statistics.idf[term] * often * (K1 + 1) / (often + norm[self._rest])
        self._begins = np.searchsorted(term, np.arange(terms + 1))
        self._held = self._count
        self._distinct = Distinct(terms)

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The BM25 score of each rest for the distinct terms of ``query``."""
        terms = self._distinct(query)
        low, high = self._begins[terms], self._begins[terms + 1]
        some = high > low
        parts = [slice(a, b) for a, b in zip(low[some].tolist(), high[some].tolist())]
        if not parts:
            return np.zeros(self._count)
        rests = np.concatenate([self._rest[p] for p in parts])
        return np.bincount(rests, np.concatenate([self._weight[p] for p in parts]), self._count)

    def forget(self, unused: np.ndarray) -> None:
        """Drop the postings of used rests, once half of those held are used."""
        left = int(unused.sum())
        if 2 * left <= self._held:
            kept = unused[self._rest]
            self._begins = np.concatenate([[0], np.cumsum(kept)])[self._begins]
            self._rest, self._weight, self._held = self._rest[kept], self._weight[kept], left


class Packer:
    """Fills windows one after the other; the open one goes on into the next shard."""

    def __init__(self, window: int):
        self._window = window
        self.sequence = self._filled = 0
        self._seed: np.ndarray | None = None

    def _room(self) -> int:
        return self._window - self._filled

    def shard(self, rests: list[np.ndarray], statistics: Statistics) -> Iterator[tuple[int, int, int, int, int]]:
        """Pieces of the rests: rest, from, to, sequence, offset."""
        index = Index(rests, statistics)
        lengths = np.array([len(r) for r in rests], np.int64)
        unused = np.ones(len(rests), dtype=bool)
        following = 0

        def place(rest: int, start: int, stop: int) -> tuple[int, int, int, int, int]:
            unused[rest] = False
            piece = (rest, start, stop, self.sequence, self._filled)
            self._filled += stop - start
            if self._filled == self._window:
                self.sequence, self._filled = self.sequence + 1, 0
            return piece

        def cut(rest: int) -> Iterator[tuple[int, int, int, int, int]]:
            """A rest that may not fit: what remains of it opens the next window."""
            part = min(self._room(), int(lengths[rest]))
            yield place(rest, 0, part)
            if part < lengths[rest]:
                yield place(rest, part, int(lengths[rest]))
            self._seed = rests[rest] if self._filled else None

        while True:
            if self._seed is not None:
                index.forget(unused)
                scores = index.scores(self._seed)
                ranked = np.flatnonzero((scores > 0) & unused)
                scores = scores[ranked]
                fitting = np.flatnonzero(lengths[ranked] <= self._room())
                while self._filled and len(fitting):
                    best = fitting[np.argmax(scores[fitting])]
                    yield place(int(ranked[best]), 0, int(lengths[ranked[best]]))
                    scores[best] = 0
                    fitting = fitting[(lengths[ranked[fitting]] <= self._room()) & (fitting != best)]
                if not self._filled:
                    self._seed = None
                elif len(ranked) and scores.max() > 0:
                    yield from cut(int(ranked[np.argmax(scores)]))
                    continue
            while following < len(rests) and not unused[following]:
                following += 1
            if following == len(rests):
                return
            yield from cut(following)


# --- in Spark -------------------------------------------------------------------

def _statistics(encoded: DataFrame, dtype: np.dtype, size: int) -> tuple[Statistics, int]:
    """The statistics, at most one row a term, and the tokens to be packed."""
    totals = encoded.where(F.col("kind") == TERM).groupBy("term").agg(F.sum("df").alias("df"))
    found = {r["term"]: r["df"] for r in totals.collect()}
    df = np.zeros(size, np.int64)
    for term, n in found.items():
        if term >= 0:
            df[term] = n
    tokens = found.get(REST_TOKENS, 0)
    mean = tokens / max(found.get(RESTS, 0), 1)
    return Statistics(inverse_frequency(df, found.get(DOCS, 0)), max(mean, 1.0), dtype.str), tokens


def _flat(batch: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows one after the other, a view, and where rows begin and end."""
    batch = batch.cast(pa.large_binary())
    _, offsets, data = batch.buffers()
    edges = np.frombuffer(offsets, np.int64)[batch.offset : batch.offset + len(batch) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[edges[0] : edges[-1]].view(dtype), (edges - edges[0]) // np.dtype(dtype).itemsize


def _signature(spark: SparkSession, statistics: Statistics):
    """A column function from ids to two weighted min-hashes."""
    ranks = spark.sparkContext.broadcast([statistics.ranks(k) for k in range(2)])
    dtype = statistics.dtype

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat, edges = _flat(batch, dtype)
            found = [np.minimum.reduceat(r[flat], edges[:-1]) if len(batch) else [] for r in ranks.value]
            yield pa.StructArray.from_arrays([pa.array(f, pa.int32()) for f in found], names=["a", "b"])

    return F.arrow_udf(sign, "struct<a: int, b: int>").asNondeterministic()


def _packed(ordered: DataFrame, statistics: Statistics, window: int) -> DataFrame:
    shared = ordered.sparkSession.sparkContext.broadcast(statistics)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, packer = shared.value, Packer(window)
        # even numbers, in a range of the task's own
        first = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rests = [np.frombuffer(ids, stats.dtype) for *_, ids in held]
            out = []
            for rest, a, b, sequence, offset in packer.shard(rests, stats):
                doc_id, start, doc_tokens, _ = held[rest]
                ids = rests[rest][a:b].astype("<u4").tobytes()
                out.append((doc_id, start + a, b - a, ids, doc_tokens, 2 * (first + sequence), offset))
            return _rows(out, PIECES)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[-1]) // np.dtype(stats.dtype).itemsize
                if size >= SHARD_TOKENS:
                    yield flush()
                    held, size = [], 0
        yield flush()

    return ordered.mapInArrow(pack, PIECES)


def _wide(dtype: np.dtype):
    """A column function that writes ids as 32-bit numbers."""
    kind = dtype.str

    def widen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.binary())
                continue
            flat, edges = _flat(batch, kind)
            buffers = [None, pa.py_buffer(4 * edges), pa.py_buffer(flat.astype("<u4"))]
            yield pa.Array.from_buffers(pa.large_binary(), len(batch), buffers).cast(pa.binary())

    return F.arrow_udf(widen, "binary").asNondeterministic()


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    window: int = WINDOW,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian 32-bit numbers. The encoded documents are stored in
    the shared folder while the plan is built.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        json = file.read()
    encoder = Encoder(json)
    path = new_folder(spark, "encoded")
    texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    # numbered as they are written, so the numbers stay
    numbered = _encoded(texts, json, window, end_id).withColumn("row", F.monotonically_increasing_id())
    numbered.write.partitionBy("kind").parquet(path)
    encoded = spark.read.schema(numbered.schema).parquet(path)
    statistics, tokens = _statistics(encoded, encoder.dtype, encoder.size)

    whole = encoded.where(F.col("kind") == WHOLE).select(
        "doc_id", "start", F.lit(window).cast("bigint").alias("length"),
        _wide(encoder.dtype)(F.col("ids")).alias("ids"), "doc_tokens",
        (2 * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // TASK_TOKENS))
    rests = encoded.where(F.col("kind") == REST).withColumn(
        "near", _signature(spark, statistics)(F.col("ids"))
    )
    order = ["near", "mixed"]
    ordered = (
        rests.select("doc_id", "start", "doc_tokens", "ids", "near", F.struct(F.xxhash64("row"), "row").alias("mixed"))
        .repartitionByRange(max(1, min(tasks, -(-tokens // SHARD_TOKENS))), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "start", "doc_tokens", "ids")
    )
    return whole.unionByName(_packed(ordered, statistics, window))


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the pieces of each sequence joined in order."""
    part = F.struct("offset", "ids")
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(part)).alias("parts"))
        .select("sequence_id", "length", F.aggregate(
            "parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])
        ).alias("ids"))
    )
