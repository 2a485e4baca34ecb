"""Exact and near-duplicates, repeated passages and components against brute force."""

import hashlib
import os
import random
import time
import re

import numpy as np
import pytest
import xxhash

from tests.llm.messy import TEXTS, empty, long_text, messy
from tracelake.llm import components, content_sort, golay, passages


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), first, sha))
            first = False
    return sorted(out, key=repr)


def test_equal_texts_on_messy_rows(spark):
    got = sorted((tuple(r) for r in content_sort.equal_texts(messy(spark)).collect()), key=repr)
    assert got == brute_exact(TEXTS)


def test_a_group_cut_over_many_partitions_keeps_one_row(spark):
    rows = [(i, "the  same text") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = sorted((tuple(r) for r in content_sort.equal_texts(df).collect()), key=repr)
        kept = content_sort.distinct_texts(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_exact(rows)
    assert sorted(r.doc_id for r in kept) == [0, *range(1000, 1050)]


def test_distinct_texts_keeps_whole_rows(spark):
    kept = content_sort.distinct_texts(messy(spark))
    assert kept.columns == messy(spark).columns
    texts = [norm(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(t) for _, t in TEXTS})
    assert {r.doc_id for r in kept.collect()} >= {1, 3, 6} and 7 not in {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("operator", [
    content_sort.equal_texts, content_sort.distinct_texts, golay.near_duplicates,
    golay.representatives, passages.repeated_passages,
])
def test_empty_tables(spark, operator):
    assert operator(empty(spark)).count() == 0


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_on_messy_rows(spark):
    rows = messy(spark)
    got = golay.near_duplicates(rows).select("doc_id", golay.hex_fingerprint().alias("f"), "component_id")
    fps = [brute_fingerprint(t) for _, t in TEXTS]
    roots = brute_components(fps)
    ids = {r: min((i for (i, _), q in zip(TEXTS, roots) if q == r and i is not None), default=None) for r in roots}
    want = sorted(((i, f"{f:016x}", ids[r]) for (i, _), f, r in zip(TEXTS, fps, roots)), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_long_texts_are_counted_in_steps(monkeypatch):
    text = long_text(3, 500)
    whole = golay.fingerprint(text)
    monkeypatch.setattr(golay, "STEP_SHINGLES", 7)
    assert golay.fingerprint(text) == whole


def test_the_code_is_perfect():
    found = (golay.error_table() >= 0).sum(axis=1)
    assert sorted(np.bincount(found).nonzero()[0].tolist()) == [1, 6]
    assert found.sum() == 1 + 23 + 253 + 1771 + 8855


def test_linked_fingerprints_share_a_key():
    rng = random.Random(5)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 3):
            y ^= 1 << bit
        keys, owner = golay.keys(np.array([x, y], dtype=np.uint64).view(np.int64))
        assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_links_span_what_brute_force_links(spark):
    rng = random.Random(9)
    fps = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        fps.add(centre)
        for _ in range(rng.choice([0, 1, 40])):
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                centre ^= 1 << bit
            fps.add(centre)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint").repartition(3)
    found = components.components(golay.links(df))
    root = {r.node: r.root for r in found.collect()}
    groups = {}
    for f, s in zip(fps, signed):
        groups.setdefault(root.get(s, s), set()).add(f)
    want = {}
    for f, r in zip(fps, brute_components(fps)):
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(found) == 61 + 50
    assert len({r.root for r in found if r.node < 100}) == 1
    assert len({r.root for r in found if r.node >= 100}) == 1


def brute_windows(h, length):
    """Minimum and reach of every stretch of at least the length, grouped."""
    found = {}
    for a in range(len(h)):
        for b in range(a + length, len(h) + 1):
            low = h[a:b].min()
            found.setdefault(int(low), set()).add((a, b - 1))
    return found


def test_compact_windows_are_nodes_of_the_tree(monkeypatch):
    monkeypatch.setattr(passages, "LENGTH", 4)
    rng = np.random.default_rng(2)
    for n in (3, 4, 5, 17, 40):
        for top in (5, 1000):
            h = rng.integers(0, top, n).astype(np.uint64)
            nodes = passages.compact_windows(h)
            want = brute_windows(h, 4)
            got = {}
            for place, first, last in nodes:
                assert h[place] == h[first : last + 1].min()
                got.setdefault(int(h[place]), set()).update(
                    (a, b) for a in range(first, last + 1) for b in range(a + 3, last + 1)
                    if h[a : b + 1].min() == h[place]
                )
            assert got == want


def test_repeated_passages_are_found_between_texts(spark):
    shared, other = long_text(11, 55), long_text(77, 70)
    changed = shared.split()
    changed[27] = "different"
    rows = [
        (1, long_text(21, 80) + " " + shared + " " + long_text(22, 60)),
        (2, long_text(23, 10) + " " + shared.upper() + "\n" + long_text(24, 90)),
        (3, long_text(25, 90)),
        (4, other), (5, other), (5, other),
        (6, " ".join(long_text(60, 400).split()[:200])),
        (7, " ".join(w if k != 100 else "odd" for k, w in enumerate(long_text(60, 400).split()[:200]))),
        (8, " ".join(shared.split()[:40]) + " " + long_text(90, 100)),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.source_id): r for r in passages.repeated_passages(df).collect()}
    assert set(found) == {(2, 1), (5, 4), (7, 6)}
    r = found[2, 1]
    assert (r.start_word, r.n_words, r.source_start, r.similarity) == (10, 55, 80, 1.0)
    assert found[5, 4].n_words == 70


def test_passages_of_messy_rows(spark):
    found = passages.repeated_passages(messy(spark)).collect()
    assert [(r.doc_id, r.source_id, r.n_words) for r in found] == [(7, 6, 3000)]


@pytest.mark.parametrize("held", [40, 49])
def test_a_first_text_that_holds_too_little_hides_no_passage(spark, held):
    shared = [long_text(500 + k, 50) for k in range(6)]
    rows = []
    for k, passage in enumerate(shared):
        part = " ".join(passage.split()[:held])
        rows += [
            (10 * k + 1, f"{long_text(600 + k, 30)} {part} {long_text(700 + k, 40)}"),
            (10 * k + 2, f"{long_text(800 + k, 20)} {passage} {long_text(900 + k, 30)}"),
            (10 * k + 3, f"{long_text(1000 + k, 35)} {passage} {long_text(1100 + k, 25)}"),
        ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(
        (r.doc_id, r.source_id, r.start_word, r.n_words) for r in passages.repeated_passages(df).collect()
    )
    brute = []
    for b, two in rows:
        for a, one in rows:
            if a < b:
                one_tokens, two_tokens = (passages.tokens(x.encode()) for x in (one, two))
                brute += [(b, a, j, m) for _, _, j, m, _ in passages.exact_passages(one_tokens, two_tokens)]
    assert len(brute) == 6 and found == sorted(brute)


def test_near_passage_by_similarity():
    one = long_text(31, 300).split()
    two = list(one)
    for k in (40, 85, 130, 175, 220):
        two[k] = "other"
    join = lambda w: passages.tokens(" ".join(w).encode())
    (a, n, _, m, similarity), = passages.shared_passages(join(one), join(two))
    assert a == 0 and n >= 270 and m >= 270 and 0.8 <= similarity < 1


def brute_similar(one, two):
    """Whether places are held by any pair of stretches on one diagonal that is similar enough."""
    held = set()
    for shift in range(-len(one), len(two)):
        low, high = max(0, -shift), min(len(one), len(two) - shift)
        if (one[low:high] == two[low + shift : high + shift]).sum() < passages.LENGTH // 2:
            continue
        for a in range(low, high):
            for b in range(a + passages.LENGTH, high + 1):
                left, right = set(one[a:b].tolist()), set(two[a + shift : b + shift].tolist())
                if len(left & right) >= passages.SIMILARITY * len(left | right):
                    held.update(range(a, b))
    return held


def edited(words, places):
    return [f"edit{k}" if k in places else w for k, w in enumerate(words)]


@pytest.mark.parametrize("parts", [
    [(70, ()), (60, (30,))],
    [(60, (30,)), (60, (29,))],
    [(60, (31,)), (70, (20,))],
    [(20, (3, 6, 9, 12, 15)), (60, (28,)), (20, (3, 6, 9, 12, 15))],
])
@pytest.mark.parametrize("swapped", [False, True])
def test_several_passages_in_one_hull(parts, swapped):
    own = [long_text(300 + k, n).split() for k, (n, _) in enumerate(parts)]
    changed = [edited(w, places) for w, (_, places) in zip(own, parts)]
    gap = [long_text(320 + k, 25).split() for k in range(2 * len(parts))]
    if swapped:
        changed.reverse()
    one = [w for k, part in enumerate(own) for w in part + gap[k]]
    two = [w for k, part in enumerate(changed) for w in part + gap[len(own) + k]]
    left, right = (passages.tokens(" ".join(w).encode()) for w in (one, two))
    found = passages.shared_passages(left, right)
    assert len(found) == sum(n >= 50 for n, _ in parts)
    got = {x for a, n, *_ in found for x in range(a, a + n - passages.TOKEN_WORDS + 1)}
    # every place that brute force finds, but for what sticks out over the last equal tokens
    want = brute_similar(left, right) & set(np.flatnonzero(np.isin(left, right)).tolist())
    assert want - got == set()


def test_a_token_far_away_hides_no_near_passage():
    part = long_text(340, 60).split()
    one = part + long_text(341, 20).split()
    two = edited(part, (30,)) + long_text(342, 80).split() + part[10:16]
    left, right = (passages.tokens(" ".join(w).encode()) for w in (one, two))
    (a, n, c, m, similarity), = passages.shared_passages(left, right)
    assert (a, n, c, m) == (0, 60, 0, 60) and similarity >= 0.8


def test_representatives_keep_the_smallest_id(spark):
    base = long_text(5, 800)
    rows = [(9, base), (4, base), (6, base + " tail"), (7, "apart from the others"), (None, base)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = golay.representatives(df)
    assert kept.columns == ["doc_id", "text"]
    assert {r.doc_id for r in kept.collect()} == {4, 7, None}


def test_repeated_lines_are_compared_in_little_time():
    rng = random.Random(12)
    lines = [" ".join(f"w{rng.randrange(40)}" for _ in range(9)).encode() for _ in range(12)]
    for words, runs, seconds in ((400, 100, 1), (1000, 700, 4)):
        texts = [b" ".join(rng.choice(lines) for _ in range(words // 9)) for _ in range(2)]
        one, two = map(passages.tokens, texts)
        assert len(passages.runs_along_diagonals(one, two)) > runs
        begun = time.process_time()
        passages.shared_passages(one, two)
        assert time.process_time() - begun < seconds
    # one word over and over: each alignment is one run, all taken from one table
    one, two = passages.tokens(b"x " * 60), passages.tokens(b"x " * 1500)
    begun = time.process_time()
    found = passages.shared_passages(one, two)
    assert time.process_time() - begun < 5 and found[0][:4] == (0, 60, 0, 60)


def test_repetitions_are_reported_once():
    words = "alpha beta gamma delta eta".split()
    one = passages.tokens(" ".join(" ".join([w] * 70) for w in words).encode())
    two = passages.tokens(" ".join(" ".join([w] * 200) for w in reversed(words)).encode())
    for found in (passages.exact_passages(one, two), passages.shared_passages(one, two)):
        assert sorted((n, c // 200) for _, n, c, _, _ in found) == [(70, k) for k in range(5)]
    # the same for lines, in a text that has them between its own words
    lines = [long_text(1200 + k, 20) for k in range(3)]
    one = passages.tokens(" ".join(" ".join([x] * 8) for x in lines).encode())
    text = " ".join(f"{long_text(1300 + k, 60)} " + " ".join([x] * 30) for k, x in enumerate(lines))
    two = passages.tokens(text.encode())
    found = passages.exact_passages(one, two)
    held = {tuple(two[s : s + passages.LENGTH]) for _, n, c, _, _ in found for s in range(c, c + n - 49)}
    stretches = [
        {tuple(x[s : s + passages.LENGTH]) for s in range(len(x) - passages.LENGTH + 1)} for x in (one, two)
    ]
    assert held == stretches[0] & stretches[1] and len(found) == 3


def test_repeated_lines_with_a_changed_word_are_similar():
    first, second = long_text(1400, 30).split(), long_text(1401, 30).split()
    changed = [*second[:12], "odd", *second[13:]]
    one = passages.tokens(" ".join([*first * 30, *second * 40]).encode())
    two = passages.tokens(" ".join([*first * 30, *changed * 40]).encode())
    (a, n, c, m, similarity), = passages.shared_passages(one, two)
    assert (a, n, c, m) == (0, 2100, 0, 2100) and 0.8 <= similarity < 0.9


@pytest.mark.parametrize("holders, small", [(0, 32), (6, 4)])
def test_a_first_text_hides_no_link_between_two_similar_ones(spark, monkeypatch, holders, small):
    monkeypatch.setattr(passages, "SMALL", small)
    rows = []
    for k in range(4):
        words = long_text(2000 + k, 120).split()
        # texts that have a line of the passage, in some cases more than a small group
        line = " ".join(words[:28])
        rows += [(100 * k + h, f"{line} {long_text(2100 + 50 * k + h, 40)}") for h in range(holders)]
        # the two changed ones are similar, but have no equal 50 words
        for n, at in enumerate((None, 30, 80)):
            passage = " ".join(w if x != at else f"odd{n}" for x, w in enumerate(words))
            around = [long_text(2600 + 50 * k + 10 * n + x, 30) for x in range(2)]
            rows.append((100 * k + 50 + n, f"{around[0]} {passage} {around[1]}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.source_id) for r in passages.repeated_passages(df).collect()}
    tokens = {k: passages.tokens(text.encode()) for k, text in rows}
    brute = {(b, a) for b in tokens for a in tokens if a < b and passages.shared_passages(tokens[a], tokens[b])}
    assert len(brute) == 12 and found == brute


def test_similar_texts_of_a_large_group_are_linked_each_with_each(spark):
    words = long_text(3000, 95).split()
    rows = []
    for k in range(passages.SMALL + 8):
        at = 46 + k % 3
        passage = " ".join(w if x != at else f"odd{k}" for x, w in enumerate(words))
        rows.append((k, f"{long_text(3100 + k, 30)} {passage} {long_text(3200 + k, 30)}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.source_id) for r in passages.repeated_passages(df).collect()}
    tokens = {k: passages.Stretch(passages.tokens(text.encode())) for k, text in rows}
    brute = {(b, a) for b in tokens for a in range(b) if passages._compared(tokens[a], tokens[b])[0]}
    assert len(brute) == len(rows) * (len(rows) - 1) // 2 and found == brute


@pytest.mark.parametrize("block", [512, 7])
def test_blocks_of_a_group_meet_each_once(block):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    size = 40
    names = ["key", "doc", "first", "last", "begin", "end", "others", "tokens"]
    keys = [np.sort(rng.choice(6, 3, replace=False)) * 8 + np.arange(1, 4) for _ in range(size)]
    tokens = [rng.choice(60, 50, replace=False).astype(np.uint16) for _ in range(size)]
    known = [(0, int(rng.integers(0, 51))) for _ in range(size)]
    rows = [
        (64, k, 0, 49, *known[k], keys[k].astype(np.int32).tobytes(), tokens[k].tobytes()) for k in range(size)
    ]
    blocks = -(-size // block)
    dealt = [
        (*row, k % blocks, min(k % blocks, n), max(k % blocks, n)) for k, row in enumerate(rows) for n in range(blocks)
    ]
    dealt.sort(key=lambda r: (r[-2], r[-1]))
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.binary(), *[pa.int32()] * 3]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(zip(*dealt), kinds)], names=[*names, "own", "x", "y"]
    )
    found = sorted((x["a"], x["b"], x["functions"]) for part in passages._region_links(iter([batch])) for x in part.to_pylist())
    brute = []
    for a in range(size):
        for b in range(a + 1, size):
            functions = 1 | sum({1 << (int(k) & 7) for k in set(keys[a]) & set(keys[b])})
            common = set(tokens[a].tolist()) & set(tokens[b].tolist())
            apart = all(common - set(tokens[x][slice(*known[x])].tolist()) for x in (a, b))
            if functions.bit_count() >= 3 and len(common) >= 37 and apart:
                brute.append((a, b, functions))
    assert brute and found == brute


def test_only_windows_whose_keys_come_twice_are_dealt_out():
    import pyarrow as pa

    shared = long_text(4000, 90)
    texts = [f"{long_text(4100 + k, 300)} {shared} {long_text(4200 + k, 300)}" for k in range(6)]
    texts += [long_text(4300 + k, 700) for k in range(6)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(12), pa.int64()), pa.array(texts)], names=["text_key", "text"]
    )
    halves = [batch.slice(0, 5), batch.slice(5)]
    dealt = [r for half in halves for b in passages._key_parts(iter([half]), 3) for r in b.to_pylist()]
    dealt = pa.RecordBatch.from_pylist(
        sorted(dealt, key=lambda r: r["part"]), pa.schema([("part", pa.int32()), ("codes", pa.binary())])
    )
    filters = [tuple(r.values()) for b in passages._meeting_bits(iter([dealt])) for r in b.to_pylist()]
    meeting = passages.MeetingKeys(3, filters)
    words = [t.encode().split() for t in texts]
    key, text_key = passages._window_columns(list(range(12)), words)[:2]
    holders = {}
    for k, t in zip(key.tolist(), text_key.tolist()):
        holders.setdefault(k, set()).add(t)
    several = {k for k, h in holders.items() if len(h) > 1}
    kept = [set(b.column("key").to_pylist()) for h in halves for b in passages._windows(iter([h]), meeting)]
    kept = set().union(*kept)
    assert several <= kept and len(kept) < len(several) + 0.1 * len(holders) < len(holders)
    # texts of which no key meets, and no text at all
    none = passages.MeetingKeys(3, [])
    assert sum(b.num_rows for b in passages._windows(iter([batch]), none)) == 0
    assert not list(passages._key_parts(iter([batch.slice(0, 0)]), 3))


def test_side_tables_of_passages_are_deleted(spark, tmp_path):
    from tracelake.llm.common import finished, stored

    made = []

    def make():
        made.append(stored(spark.range(9), "side"))
        return made[0].where("id > 3")

    found = finished(spark, "whole", make)
    assert sorted(r.id for r in found.collect()) == [4, 5, 6, 7, 8]
    folder = re.sub(r"^file:/*", "/", found.inputFiles()[0]).rsplit("/", 1)[0]
    side = re.sub(r"^file:/*", "/", made[0].inputFiles()[0]).rsplit("/", 1)[0]
    assert os.path.isdir(folder) and not os.path.exists(side)


def test_regions_without_tokens_are_not_alike():
    group = {n: np.zeros(3, dtype=np.int64) for n in ("begin", "end")}
    full = np.arange(50, dtype=np.uint16).tobytes()
    assert not passages._alike(group, [b""] * 3).any()
    assert passages._alike(group, [full, b"", full])[0].tolist() == [True, False, True]


def test_outermost_passages_once_each():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    rows = sorted(
        (int(rng.integers(0, 2)), int(rng.integers(2, 4)), *(int(x) for x in rng.integers(0, 6, 4)), float(rng.integers(0, 2)))
        for _ in range(200)
    )
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64()]
    names = ["a", "b", "first", "words", "first2", "words2", "similarity"]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=names)
        for part in (rows[:70], rows[70:])
    ]

    def holds(y, x):
        ends = all(y[k] <= x[k] and x[k] + x[k + 1] <= y[k] + y[k + 1] for k in (2, 4))
        return x[:2] == y[:2] and ends and (y[3] > x[3] or y[5] > x[5])

    found = sorted(tuple(r.values()) for b in passages._outermost(iter(batches)) for r in b.to_pylist())
    assert found == sorted(x for x in set(rows) if not any(holds(y, x) for y in rows))


def test_texts_share_windows_of_larger_groups():
    import pyarrow as pa

    rng = np.random.default_rng(7)
    windows = [
        [{"key": int(k), "first": int(k) + n, "last": int(k) + 50 + n} for k in rng.choice(48, 8, replace=False) if k % 8 < 6]
        for n in range(60)
    ]
    kind = pa.list_(pa.struct([("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))
    functions = [1 << int(rng.integers(0, 6)) for _ in range(30)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(30)), pa.array(range(30, 60)), pa.array(functions, pa.int32()),
         pa.array(windows[:30], kind), pa.array(windows[30:], kind)],
        names=["a", "b", "functions", "windows_a", "windows_b"],
    )
    brute = []
    for a, known in enumerate(functions):
        shared = [(x, y) for x in windows[a] for y in windows[30 + a] if x["key"] == y["key"]]
        for x, _ in shared:
            known |= 1 << (x["key"] & 7)
        if known.bit_count() >= passages.ENOUGH:
            brute += [(a, 30 + a, 1 << (x["key"] & 7), x["first"], x["last"], y["first"], y["last"]) for x, y in shared]
    found = sorted(tuple(r.values()) for b in passages._shared_windows(iter([batch])) for r in b.to_pylist())
    assert brute and found == sorted(brute)


def test_links_are_merged_in_any_parts():
    rng = np.random.default_rng(8)
    for _ in range(50):
        count = int(rng.integers(1, 60))
        first = rng.integers(0, 400, count)
        last = first + rng.integers(passages.LENGTH - 1, 120, count)
        links = [rng.integers(0, 2, count), rng.integers(2, 4, count), 1 << rng.integers(0, 6, count), first, last,
                 first + 7, last + 7]
        brute = []
        for a, b in sorted(set(zip(links[0].tolist(), links[1].tolist()))):
            group = None
            for x in sorted((r for r in zip(*[c.tolist() for c in links]) if r[:2] == (a, b)), key=lambda r: r[3:5]):
                if group is None or x[3] + passages.LENGTH - 1 > group[4]:
                    group = list(x)
                    brute.append(group)
                group[2] |= x[2]
                group[4], group[5], group[6] = max(group[4], x[4]), min(group[5], x[5]), max(group[6], x[6])
        part = rng.random(count) < 0.5
        halves = [passages.merged([c[m] for c in links]) for m in (part, ~part)]
        for found in (passages.merged(links), passages.merged([np.concatenate(c) for c in zip(*halves)])):
            assert [list(x) for x in zip(*[c.tolist() for c in found])] == brute


def test_a_stretch_is_hashed_once_for_a_group_of_pairs(spark, monkeypatch):
    import pyarrow as pa

    hashed = []
    plain = passages.tokens
    monkeypatch.setattr(passages, "tokens", lambda text: hashed.append(text) or plain(text))
    text = " ".join(f"w{k}" for k in range(80)).encode()
    texts = [(1, 1, k, None, 0, 75, None, None, [text]) for k in range(9)]
    pairs = [(1, 1, a, b, 0, 75, 0, 75, None) for b in range(9) for a in range(b)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.binary())]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*texts, *pairs), kinds)]
    batch = pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(9)])
    found = [x for part in passages._verified(iter([batch])) for x in part.to_pylist()]
    assert len(hashed) == 9 and len(found) == 36 and all(x["words"] == 80 and x["shown"] for x in found)


@pytest.mark.parametrize("many", [2, 5, 1000])
def test_frequent_keys_give_the_same_passages(spark, monkeypatch, many):
    rng = random.Random(5)
    line = [f"l{k}" for k in range(60)]
    rows = []
    for k in range(12):
        own = [f"d{k % 4}x{n}" for n in range(70)]
        own[rng.randrange(70)] = f"y{k}"
        rows.append((k, " ".join([*own, *line, *[f"z{k}n{n}" for n in range(60)]])))
    monkeypatch.setattr(passages, "SMALL", 4)
    monkeypatch.setattr(passages, "MANY", many)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {(r.doc_id, r.source_id) for r in passages.repeated_passages(df).collect()}
    # every text has the line of the first, and the part of its own kind
    assert {(k, 0) for k in range(1, 12)} <= found and {(k, k - 4) for k in range(4, 12)} <= found
