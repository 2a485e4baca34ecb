"""Retrieval packing: whole ids, BM25 and the greedy filling against plain code."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.messy import TEXTS, empty, long_text, messy
from tracelake.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check_whole(pieces, texts, tokenizer, window):
    """Every id of every text in exactly one piece, sequences without gaps."""
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    parts = {}
    for r in pieces:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert 0 < r["length"] == len(ids)
        parts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
    got = []
    for (_, tokens), found in parts.items():
        found.sort()
        # documents of one id are told apart by where they begin
        while found:
            ids = []
            while len(ids) < tokens:
                k = next(k for k, (start, _) in enumerate(found) if start == len(ids))
                ids += found.pop(k)[1]
            got.append(ids)
    assert sorted(got) == sorted(want)
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= window
    return sequences


def test_messy_documents(spark, tokenizer):
    pieces = p.pack(messy(spark), PATH).collect()
    check_whole(pieces, [t for _, t in TEXTS], tokenizer, p.WINDOW)
    assert p.pack(empty(spark), PATH).collect() == []


def test_ids_of_a_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = p.pack(docs, PATH)
    rows = pieces.collect()
    sequences = check_whole(rows, [r["text"] for r in docs.collect()], tokenizer, p.WINDOW)
    # only the last window of a task is not full
    assert sum(sum(n for _, n in found) < p.WINDOW for found in sequences.values()) <= 1
    joined = {r["sequence_id"]: r for r in p.sequences(pieces).collect()}
    assert {k: r["length"] for k, r in joined.items()} == {k: sum(n for _, n in v) for k, v in sequences.items()}
    crc = {(r["doc_id"], r["start"]): r["c"] for r in pieces.select("doc_id", "start", F.crc32("ids").alias("c")).collect()}
    for r in rows[:50]:
        assert crc[r["doc_id"], r["start"]] == zlib.crc32(bytes(r["ids"]))
        assert bytes(joined[r["sequence_id"]]["ids"])[4 * r["offset"] :].startswith(bytes(r["ids"]))


def test_small_windows_shards_and_many_tasks(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(p, "SHARD_TOKENS", 700)
    rng = random.Random(3)
    texts = [long_text(k % 7, rng.randint(0, 120)) for k in range(150)] + ["copy of a text " * 9] * 60
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    pieces = p.pack(docs, PATH, window=64).collect()
    sequences = check_whole(pieces, texts, tokenizer, 64)
    # a gap for each of the four tasks
    assert sum(sum(n for _, n in found) < 64 for found in sequences.values()) <= 4


def test_very_long_text(spark, tokenizer):
    text = long_text(5, 200_000) + " 中文 end"
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id bigint, text string")
    check_whole(p.pack(docs, PATH).collect(), [text, "x"], tokenizer, p.WINDOW)


def test_encoder_on_random_texts(tokenizer):
    with open(PATH, encoding="utf-8") as file:
        encoder = p.Encoder(file.read())
    parts = ["a", "B", "é", "É", "ﬁ", "İ", "Σ", "ß", "中", "١", "½", " ", "\t", "\n", "\xa0", "\x85", "\x1c", "\x00",
             "'s", "'LL", "!", "--", "<|endoftext|>", "<|startoftext|>", "😀", "the", "12", "_", "ÿ", "ą", "don't"]
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert encoder(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_are_asked_directly():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        encoder = p.Encoder(file.read())
    want = Tokenizer.from_file(path).encode(" Some text, é.", add_special_tokens=False).ids
    assert encoder(" Some text, é.").tolist() == want


def test_forgotten_words_change_nothing(monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        json = file.read()
    text = long_text(2, 2000)
    whole = p.Encoder(json)(text).tolist()
    monkeypatch.setattr(p, "REMEMBERED", 3)
    assert p.Encoder(json)(text).tolist() == whole


def random_shard(seed, count, terms):
    rng = np.random.default_rng(seed)
    rests = [rng.zipf(1.5, rng.integers(1, 40)).clip(max=terms - 1).astype("<u2") for _ in range(count)]
    df = np.zeros(terms, np.int64)
    for r in rests:
        df[np.unique(r)] += 1
    mean = sum(map(len, rests)) / count
    return rests, df, p.Statistics(p.inverse_frequency(df, count), mean, "<u2")


def brute_scores(query, rests, df, mean):
    n = len(rests)
    out = []
    for rest in rests:
        score = 0.0
        for term in sorted(set(query.tolist())):
            tf = rest.tolist().count(term)
            idf = max(0.0, math.log((n - df[term] + 0.5) / (df[term] + 0.5)))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(rest) / mean))
        out.append(score)
    return out


def brute_pack(rests, df, mean, window):
    """The greedy filling, one window after the other."""
    left, out, room, sequence, seed = list(range(len(rests))), [], window, 0, None

    def place(rest, a, b):
        nonlocal room, sequence
        out.append((rest, a, b, sequence, window - room))
        room -= b - a
        if room == 0:
            room, sequence = window, sequence + 1

    while left:
        ranked = []
        if seed is not None:
            scores = brute_scores(seed, rests, df, mean)
            ranked = sorted((k for k in left if scores[k] > 0), key=lambda k: (-round(scores[k], 9), k))
            for k in list(ranked):
                if room < window and len(rests[k]) <= room:
                    place(k, 0, len(rests[k]))
                    ranked.remove(k)
                    left.remove(k)
            if room == window:
                seed, ranked = None, []
        if not left:
            break
        rest = ranked[0] if ranked else left[0]
        left.remove(rest)
        part = min(room, len(rests[rest]))
        place(rest, 0, part)
        if part < len(rests[rest]):
            place(rest, part, len(rests[rest]))
        seed = rests[rest] if room < window else None
    return out


def test_scores_equal_the_formula():
    rests, df, statistics = random_shard(1, 60, 50)
    index = p.Index(rests, statistics)
    unused = np.ones(60, dtype=bool)
    for k in range(60):
        got = index.scores(rests[k])
        want = brute_scores(rests[k], rests, df, statistics.mean_length)
        assert np.allclose(got[unused], np.array(want)[unused])
        unused[k] = False
        index.forget(unused)


def test_filling_equals_plain_code():
    for seed in range(30):
        rests, df, statistics = random_shard(seed, 5 + 3 * seed, 30 + seed)
        packer = p.Packer(41)
        assert list(packer.shard(rests, statistics)) == brute_pack(rests, df, statistics.mean_length, 41)


def test_neighbours_share_windows():
    rng = np.random.default_rng(6)
    topic = rng.integers(0, 12, 240)
    # twenty ids of the topic's forty, and ten that all topics use
    rests = [np.concatenate([40 * t + rng.integers(0, 40, 20), 480 + rng.integers(0, 20, 10)]).astype("<u2") for t in topic]
    df = np.zeros(500, np.int64)
    for r in rests:
        df[np.unique(r)] += 1
    statistics = p.Statistics(p.inverse_frequency(df, len(rests)), 30.0, "<u2")

    def shared(assigned):
        windows = {}
        for rest, w in assigned:
            windows.setdefault(w, []).append(int(topic[rest]))
        return sum(max(map(t.count, t)) for t in windows.values()) / sum(map(len, windows.values()))

    packed = [(x[0], x[3]) for x in p.Packer(300).shard(rests, statistics)]
    assert shared(packed) > 0.8 > 2 * shared([(k, k // 10) for k in range(240)])


def test_min_hashes_of_sets_follow_their_weights():
    rests, df, statistics = random_shard(7, 200, 300)
    ranks = [statistics.ranks(k) for k in range(200)]
    a, b = np.unique(rests[3]), np.unique(np.concatenate([rests[3], rests[4]]))
    same = np.mean([r[a].min() == r[b].min() for r in ranks])
    assert abs(same - statistics.idf[a].sum() / statistics.idf[b].sum()) < 0.12
    assert all(sorted(r.tolist()) == list(range(300)) for r in ranks[:3])


def test_blanks_at_the_end_of_a_lowered_text(tokenizer):
    with open(PATH, encoding="utf-8") as file:
        encoder = p.Encoder(file.read())
    for text in ("½\t", "ab\t", "AB\n", "é ", "x y\v"):
        assert encoder(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_blocks_of_texts_and_distinct_ones(tokenizer, monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        encoder = p.Encoder(file.read())
    texts = ["", "one", long_text(3, 40), "", "中文 x", long_text(4, 7), "two words", " "]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for words in (1, 8, 1 << 15):
        monkeypatch.setattr(p, "STEP_WORDS", words)
        assert [ids.tolist() for ids in encoder.encode(texts)] == want
    distinct, rng = p.Distinct(6400), np.random.default_rng(1)
    for size in (0, 1, 2, 100, 199, 200, 5000):
        ids = rng.integers(0, 6400, size).astype(np.uint16)
        got = distinct(ids)
        assert got.dtype == np.int64 and got.tolist() == np.unique(ids).tolist()
