"""Fill-in-middle against brute force over code points, and back."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.messy import TEXTS, empty, messy
from tracelake.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(text, hashes, fim=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((hashes[0] % (n + 1), hashes[1] % (n + 1)))
    if not text or any(m in text for m in fill_middle.MARKS) or hashes[2] % 100 >= fim:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if hashes[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def brute_hashes(doc_id, seed=42):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def formed(texts, hashes, bound):
    parts = [
        fill_middle.transform(data, ends, np.array(hashes[low:high]), fill_middle.Settings())
        for low, high, data, ends in fill_middle.byte_steps(pa.array(texts, pa.string()), bound)
    ]
    return [tuple(r.values()) for part in parts for r in part.to_pylist()]


def test_batches_of_random_texts():
    rng = random.Random(1)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "\x0b", "\x0e", "\x08", "\x1f", "!", "é", "中", "😀", "\x85",
             "\xa0", "<P>", "<", "P>", "\x7f", "\x80", "\x00", "word", "ÿ"]
    for _ in range(150):
        texts = [
            "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) if rng.random() > 0.1 else None
            for _ in range(rng.randint(1, 40))
        ]
        hashes = [[rng.randrange(2**32) for _ in range(4)] for _ in texts]
        want = [brute(t, h) for t, h in zip(texts, hashes)]
        assert formed(texts, hashes, rng.choice([1, 50, 10_000])) == want


def test_every_byte_is_marked_as_the_pattern_says():
    data = np.arange(256, dtype=np.uint8)
    marked = fill_middle.space_marks(data.view("<u8")).view(np.uint8)
    assert [b for b in range(256) if marked[b]] == [9, 10, 11, 12, 13, 32]
    begins = fill_middle.start_marks(data.view("<u8")).view(np.uint8)
    assert [b for b in range(256) if not begins[b]] == list(range(0x80, 0xC0))


def test_rank_and_select_agree():
    rng = random.Random(2)
    flags = np.array([rng.random() < 0.3 for _ in range(800)], dtype=np.uint8) * 0x80
    marks = fill_middle.Marks(flags.view("<u8"))
    places = np.flatnonzero(flags)
    assert marks.select(np.arange(1, len(places) + 1)).tolist() == places.tolist()
    assert marks.rank(np.arange(801)).tolist() == [int((places < k).sum()) for k in range(801)]


def test_long_texts_are_cut_whole():
    rng = random.Random(3)
    text = " ".join(rng.choice(["word", "中文", "é"]) for _ in range(300_000)) + "\n\n"
    for low in (10, 99):
        hashes = [[123_456, 298_000, low, low]] * 3
        assert formed(["x", text, ""], hashes, 1000) == [brute(t, h) for t, h in zip(("x", text, ""), hashes)]


@pytest.mark.parametrize("fim, spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_messy_documents(spark, fim, spm):
    docs = messy(spark)
    got = fill_middle.fill_in_middle(docs, fim_percent=fim, spm_percent=spm)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    rows = got.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", back.alias("back")).collect()
    want = [(i, t, *brute(t, brute_hashes(i), fim, spm), t or "") for i, t in TEXTS]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert fill_middle.fill_in_middle(empty(spark)).count() == 0


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", "old", 7)], "doc_id bigint, text string, form string, N int")
    got = fill_middle.fill_in_middle(docs)
    assert got.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert got.first()["n"] == 2


def test_marks_that_could_arise_where_parts_meet_are_refused(spark):
    for marks in (("<P>", "<P>", "<M>"), ("aa", "ab", "ac"), ("<P", "<P>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(messy(spark), marks=marks)
