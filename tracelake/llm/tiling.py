"""Benchmark decontamination by greedy string tiling.

Words (runs of letters, digits and underscores, lower case) of a document and of
a benchmark item share seeds: equal runs of five words, found by their
Karp-Rabin hashes and compared in full. Seeds are grown to maximal matches, the
longest match of words not yet marked is marked on both sides, and this repeats
until none is left. The share of the item's words that is marked is its
coverage; order does not matter, so a passage whose sentences were moved around
is caught. A document with an item covered to 0.8 or more is contaminated.

The benchmark travels to the tasks in blocks of bounded size, a pass over the
documents for each block, so it may have any size; documents are never shuffled.
Null and empty texts match nothing. Items of fewer than five words cannot be
judged and match nothing. Repeated items give repeated result rows, repeated
documents too. Nulls in other columns and other columns' names do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import ship, stored, text_of

TILE_WORDS = 5
COVERAGE = 0.8
# Bytes of benchmark text that travel to the tasks at once.
BLOCK_BYTES = 16 << 20
WORD = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
RESULT = "array<struct<item_id: bigint, coverage: double, tiles: int, matched_words: int>>"


@dataclass(frozen=True)
class Benchmark:
    vocabulary: dict[str, int]
    item_ids: list[int | None]
    items: list[np.ndarray]
    seeds: np.ndarray  # sorted hashes of runs of five words
    seed_item: np.ndarray
    seed_place: np.ndarray


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` words."""
    count = len(ids) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(count, np.uint64)
    for k in range(size):
        value = value * BASE + ids[k : k + count].astype(np.uint64) + np.uint64(1)
    return value


def prepare(rows: list[tuple[int | None, str | None]]) -> Benchmark:
    vocabulary: dict[str, int] = {}
    item_ids, items, seeds, owner, place = [], [], [], [], []
    for item_id, text in rows:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text or "")]
        if len(ids) < TILE_WORDS:
            continue
        item = np.array(ids, dtype=np.int64)
        found = run_hashes(item, TILE_WORDS)
        seeds.append(found)
        owner.append(np.full(len(found), len(items)))
        place.append(np.arange(len(found)))
        items.append(item)
        item_ids.append(item_id)
    if not items:
        none = np.zeros(0, np.int64)
        return Benchmark({}, [], [], none.astype(np.uint64), none, none)
    flat = np.concatenate(seeds)
    order = np.argsort(flat, kind="stable")
    return Benchmark(
        vocabulary, item_ids, items,
        flat[order], np.concatenate(owner)[order], np.concatenate(place)[order],
    )


def tile(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Marked words of the item, and tiles, by greedy string tiling.

    Negative numbers in ``doc`` are words that match nothing.
    """
    free_doc, free_item = doc >= 0, np.ones(len(item), dtype=bool)
    doc_runs, item_runs = run_hashes(doc, TILE_WORDS), run_hashes(item, TILE_WORDS)
    marked = tiles = 0
    while True:
        # runs without a marked word on either side
        at_doc = np.flatnonzero(_all_free(free_doc))
        at_item = np.flatnonzero(_all_free(free_item))
        at_doc = at_doc[np.argsort(doc_runs[at_doc], kind="stable")]
        have = doc_runs[at_doc]
        low = np.searchsorted(have, item_runs[at_item], "left")
        count = np.searchsorted(have, item_runs[at_item], "right") - low
        j = np.repeat(at_item, count)
        i = at_doc[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
        # those that can be grown to the left belong to a longer match
        before = (i > 0) & (j > 0)
        before &= free_doc[i - 1] & free_item[j - 1] & (doc[i - 1] == item[j - 1])
        matches = [
            (-length, b, a)
            for a, b in zip(i[~before].tolist(), j[~before].tolist())
            if (length := _grown(doc, item, free_doc, free_item, a, b)) >= TILE_WORDS
        ]
        if not matches:
            return marked, tiles
        matches.sort()
        longest = -matches[0][0]
        for length, b, a in matches:
            if -length < longest:
                break
            if free_doc[a : a + longest].all() and free_item[b : b + longest].all():
                free_doc[a : a + longest] = False
                free_item[b : b + longest] = False
                marked += longest
                tiles += 1


def _all_free(free: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(free)])
    return total[TILE_WORDS:] - total[:-TILE_WORDS] == TILE_WORDS


def _grown(doc, item, free_doc, free_item, i: int, j: int) -> int:
    size = min(len(doc) - i, len(item) - j)
    same = (doc[i : i + size] == item[j : j + size]) & free_doc[i : i + size] & free_item[j : j + size]
    return size if same.all() else int(np.argmin(same))


def covered_items(bench: Benchmark, text: str, coverage: float) -> list[tuple]:
    """The items that a text covers: id, coverage, tiles and marked words."""
    known = bench.vocabulary
    ids = np.array([known.get(w, -1) for w in words(text)], dtype=np.int64)
    if len(ids) < TILE_WORDS or not len(bench.seeds):
        return []
    places = np.flatnonzero(_all_free(ids >= 0))
    if not len(places):
        return []
    hashes = run_hashes(ids, TILE_WORDS)[places]
    low = np.searchsorted(bench.seeds, hashes, "left")
    hit = low < len(bench.seeds)
    hit[hit] = bench.seeds[low[hit]] == hashes[hit]
    if not hit.any():
        return []
    places, hashes = places[hit], hashes[hit]
    # the seeds seen, and with them the items that may be covered at all
    seen, which = np.unique(hashes, return_inverse=True)
    low = np.searchsorted(bench.seeds, seen, "left")
    high = np.searchsorted(bench.seeds, seen, "right")
    by_item: dict[int, tuple[list[int], list[int]]] = {}
    for s, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        for k in range(a, b):
            seeds, at = by_item.setdefault(int(bench.seed_item[k]), ([], []))
            seeds.append(s)
            at.append(int(bench.seed_place[k]))
    found = []
    for number, (seeds, at) in sorted(by_item.items()):
        item = bench.items[number]
        reach = np.zeros(len(item), dtype=bool)
        for offset in range(TILE_WORDS):
            reach[np.array(at) + offset] = True
        if reach.sum() < coverage * len(item):
            continue
        mine = places[np.isin(which, seeds)]
        marked, tiles = tile(_stretches(ids, mine), item)
        if marked >= coverage * len(item):
            found.append((bench.item_ids[number], marked / len(item), tiles, marked))
    return found


def _stretches(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The words of all runs at ``starts``, with a -1 between separate stretches."""
    keep = np.zeros(len(ids) + 1, dtype=bool)
    for offset in range(TILE_WORDS):
        keep[starts + offset] = True
    part = np.append(ids, -1)
    part[~keep] = -1
    # one -1 after each stretch is enough
    return part[keep | np.append(False, keep[:-1])]


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Benchmark]:
    """The benchmark in blocks of about ``BLOCK_BYTES``."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("bigint").alias("i"), F.col(f"`{text}`").alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t") + 8), F.lit(0))).first()[0]
    count = max(1, -(-size // BLOCK_BYTES))
    for k in range(count):
        mine = rows.where(F.pmod(F.xxhash64("t", "i"), F.lit(count)) == k)
        yield prepare(sorted(((r["i"], r["t"]) for r in mine.collect()), key=repr))


def matcher(bench: Benchmark, spark: SparkSession, coverage: float = COVERAGE):
    """A column function from text to the items it covers, as ``RESULT``."""
    ship(spark)
    shared = spark.sparkContext.broadcast(bench)

    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([
            ("item_id", pa.int64()), ("coverage", pa.float64()),
            ("tiles", pa.int32()), ("matched_words", pa.int32()),
        ]))
        names = ("item_id", "coverage", "tiles", "matched_words")
        for texts in batches:
            yield pa.array(
                [
                    [dict(zip(names, x)) for x in covered_items(shared.value, t.as_py() or "", coverage)]
                    for t in texts
                ],
                kind,
            )

    return F.arrow_udf(match, RESULT).asNondeterministic()


def contaminations(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, coverage, tiles, matched_words``: one row per covered item."""
    found = None
    for bench in blocks(benchmark):
        match = matcher(bench, docs.sparkSession, coverage)
        part = docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.explode(match(text_of(text))).alias("m")
        ).select("doc_id", "m.*")
        found = part if found is None else found.unionByName(part)
    return found


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that cover no item."""
    kept, first = docs, True
    for bench in blocks(benchmark):
        if not first:
            kept = stored(kept, "clean")
        first = False
        match = matcher(bench, docs.sparkSession, coverage)
        kept = kept.where(F.size(match(text_of(text))) == 0)
    return kept
