"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprints of 64 bits are linked when at most three bits differ. Cut into four
segments of 16 bits, a linked pair has a segment without a difference and, among
the other three, one with at most one (four differences would be needed
otherwise). A segment, padded to 23 bits, is decoded with the binary Golay code
to the indices of all codewords within four bits. The code is perfect with
radius three: the nearest codeword of one segment is within four bits of any
segment that differs from it in one bit, so both share its index. Hence every
linked pair shares a key made of one exact segment and one codeword index of
another; a fingerprint has about 64 such keys.

Equal fingerprints are merged before keys are made. Keys are sorted, and
fingerprints that meet at a key are verified on all 64 bits. A key gives links
that span what is linked there, not all pairs: starting from one fingerprint,
those near it are taken out and searched from in turn, so a tight cluster takes
a few passes. What meets at a key are distinct fingerprints, eight bytes each.

Null texts count as empty; texts without a word have fingerprint zero. Repeated
rows give repeated result rows. A row without an id is linked as any other, but
gives no component its name. Other columns do not matter.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import ship, stored, text_of
from tracelake.llm.components import components

DISTANCE = 3
WORDS = 3
HASH_SEED = 42
# Shingles whose bits are counted in one numpy step.
STEP_SHINGLES = 1 << 16

# Fixed value: the generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101


def fingerprint(text: str) -> int:
    """The majority bits of the XXH64 of all shingles, as a signed number."""
    words = text.encode("utf-8").lower().split()  # ASCII only, as bytes
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(WORDS))))
        total = len(words) - WORDS + 1
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    while part := [hashed(s, HASH_SEED) for s in itertools.islice(shingles, STEP_SHINGLES)]:
        octets = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    octets = np.packbits(counts * 2 > total, bitorder="little")
    return int(octets.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` for every row."""
    ship(docs.sparkSession)

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())

    fp = F.arrow_udf(of, "bigint").asNondeterministic()
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fp(text_of(text)).alias("fp"))


def _remainder(word: int) -> int:
    """The remainder of a 23-bit word by the generator."""
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@functools.cache
def error_table() -> np.ndarray:
    """For each remainder the error patterns of weight four or less; -1 fills up."""
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    single = [_remainder(1 << bit) for bit in range(23)]
    for weight in range(5):
        for bits in itertools.combinations(range(23), weight):
            remainder = functools.reduce(lambda r, b: r ^ single[b], bits, 0)
            found[remainder].append(sum(1 << b for b in bits))
    width = max(map(len, found))
    return np.array([row + [-1] * (width - len(row)) for row in found], dtype=np.int64)


@functools.cache
def codeword_table() -> np.ndarray:
    """For each 16-bit segment the indices of the codewords within four bits; -1 fills up.

    The code is systematic here: the upper twelve bits of a codeword number it.
    """
    values = np.arange(1 << 16, dtype=np.int64)
    remainder = values.copy()
    for bit in range(15, 10, -1):
        remainder ^= (remainder >> bit & 1) * (GENERATOR << (bit - 11))
    errors = error_table()[remainder]
    return np.where(errors < 0, -1, (values[:, None] ^ errors) >> 11)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of 32 bits and the position of the fingerprint each belongs to."""
    unsigned = fps.view(np.uint64)
    segment = [(unsigned >> np.uint64(16 * s) & np.uint64(0xFFFF)).astype(np.int64) for s in range(4)]
    near = [codeword_table()[s] for s in segment]
    found, owner = [], []
    for exact, fuzzy in itertools.permutations(range(4), 2):
        key = (exact << 30) + (fuzzy << 28) + (segment[exact] << 12)
        both = np.where(near[fuzzy] < 0, -1, key[:, None] + near[fuzzy])
        at, which = np.nonzero(both >= 0)
        found.append(both[at, which])
        owner.append(at)
    return np.concatenate(found), np.concatenate(owner)


def differing(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    # of a negative number the bits of its absolute value would be counted
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning_links(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected within distance, in one group."""
    found = []
    rest = fps[1:]
    frontier = [fps[0]]
    while len(rest):
        if not frontier:
            frontier, rest = [rest[0]], rest[1:]
            continue
        at = frontier.pop()
        near = differing(rest, at) <= DISTANCE
        if near.any():
            reached = rest[near]
            found.append((np.full(len(reached), at), reached))
            frontier.extend(reached)
            rest = rest[~near]
    return found


def links(distinct_fps: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints that span all their components."""
    spark = distinct_fps.sparkSession
    ship(spark)

    def to_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            if not len(fps):
                continue
            found, owner = keys(fps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.uint32).view(np.int32)), pa.array(fps[owner])],
                names=["key", "fp"],
            )

    def to_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, np.zeros(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                key, fps = np.zeros(0, np.int32), held[:0]
            else:
                key, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
                if not len(key):
                    continue
            if len(held):
                key = np.concatenate([np.full(len(held), held_key, dtype=key.dtype), key])
                fps = np.concatenate([held, fps])
                held = held[:0]
            if batch is not None:
                # the last key may go on in the next batch
                end = int(np.searchsorted(key, key[-1]))
                held_key, held = key[-1], fps[end:].copy()
                key, fps = key[:end], fps[:end]
            yield from _links_of(key, fps)

    keyed = distinct_fps.select("fp").mapInArrow(to_keys, "key int, fp bigint")
    met = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return met.mapInArrow(to_links, "a bigint, b bigint").distinct()


def _links_of(key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links of whole runs of equal keys."""
    if len(key) < 2:
        return
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    two = starts[sizes == 2]
    near = two[differing(fps[two], fps[two + 1]) <= DISTANCE]
    found = [(fps[near], fps[near + 1])]
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        found += spanning_links(fps[start : start + size])
    a = np.concatenate([x for x, _ in found])
    b = np.concatenate([y for _, y in found])
    if len(a):
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"]
        )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row.

    ``component_id`` is the smallest id reachable over links.
    """
    by_doc = stored(fingerprints(docs, doc_id, text), "fingerprints")
    by_fp = stored(by_doc.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = stored(components(links(by_fp)).select(F.col("node").alias("fp"), "root"), "roots")
    named = (
        roots.join(by_fp, "fp").groupBy("root").agg(F.min("first_id").alias("least_id"))
    )
    in_groups = roots.join(named, "root").select("fp", "least_id")
    # stored, so that the last join is one of two exchanges, which can be split where
    # a third of all rows share a fingerprint
    names = stored(
        by_fp.join(in_groups, "fp", "left").select(
            "fp", F.coalesce("least_id", "first_id").alias("component_id")
        ),
        "component-names",
    )
    return by_doc.join(names, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those whose group has a smaller id.

    Rows without an id stay, since no group can name them; of rows that share an
    id all stay if one does.
    """
    found = near_duplicates(docs, doc_id, text)
    stays = F.max(F.col("doc_id") == F.col("component_id"))
    gone = found.groupBy("doc_id").agg(stays.alias("stays")).where("NOT stays")
    gone = gone.select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs[doc_id] == gone["gone_id"], "left_anti")
