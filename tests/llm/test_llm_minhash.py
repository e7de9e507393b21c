from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from landfall.llm import minhash_dedup, similar, words
from landfall.llm.frames import read_table

SF = "/root/testdata/sf0.001"


def _edited(base, rng, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.random()}"
    return " ".join(w)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, component long, lang string")


def _answer(rows):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows.collect()}


def test_groups_of_edited_copies_equal_brute_force(spark):
    rng = random.Random(5)
    texts, n = {}, 0
    for group, size in enumerate([60, 5, 2]):
        base = [f"w{group}_{rng.randrange(10**6)}" for _ in range(rng.choice([40, 120]))]
        for _ in range(size):
            texts[n] = _edited(base, rng, rng.randrange(7))
            n += 1
    texts |= {n: None, n + 1: "", n + 2: " \t\n", n + 3: "One", n + 4: "one", n + 5: "a b", n + 6: "A b c", n + 7: "a b"}
    texts[n + 8] = " ".join(f"long{i}" for i in range(60_000))
    texts[n + 9] = texts[n + 8] + " end"
    rows = [(i, t, 1, "en") for i, t in texts.items()]
    for k, percent in ((3, 85), (5, 80)):
        got = _answer(minhash_dedup.near_duplicates(_frame(spark, rows), k, percent))
        expected = brute.near_components(texts, k, percent)
        assert {i: c for i, (_, c, _) in got.items()} == expected
        assert {i: s for i, (s, _, _) in got.items()} == {i: len(brute.shingle_set(t, k)) for i, t in texts.items()}
        assert all(kept == (i == c) for i, (_, c, kept) in got.items())


def test_real_rows_equal_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = _answer(minhash_dedup.near_duplicates(docs, 3, 85))
    assert {i: c for i, (_, c, _) in got.items()} == brute.near_components(texts, 3, 85)


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a b c d e f", 1, "en"), (4, "a b c d e f", 1, "en"), (4, "a b c d e f", 1, "en"), (None, "z", 1, "en"), (None, None, 1, "en")]
    got = sorted(map(tuple, minhash_dedup.near_duplicates(_frame(spark, rows)).drop("text_hash").collect()), key=str)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 1, None, True), (None, 0, None, True)], key=str)
    assert minhash_dedup.near_duplicates(_frame(spark, [])).collect() == []


def test_small_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 4)
    monkeypatch.setattr(similar, "SLICE", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    texts = {i: _edited(base, rng, rng.randrange(9)) for i in range(70)}
    got = _answer(minhash_dedup.near_duplicates(_frame(spark, [(i, t, 1, "en") for i, t in texts.items()]), 3, 85))
    assert {i: c for i, (_, c, _) in got.items()} == brute.near_components(texts, 3, 85)


def test_a_block_of_long_alike_sets_takes_little_memory():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    sets = {i: np.sort(np.concatenate((common, rng.integers(0, 2**63, 500, dtype=np.uint64)))) for i in range(240)}
    sets |= {i + 240: np.sort(np.concatenate((sets[i][:-20], rng.integers(0, 2**63, 20, dtype=np.uint64)))) for i in range(0, 240, 10)}
    rows = [(i, streamed) for streamed in (False, True) for i in sets]
    columns = {name: pa.array([0] * len(rows), pa.int64()) for name in ("component", "token", "block", "slice")}
    columns |= {"streamed": [s for _, s in rows], "node": [i for i, _ in rows], "linked": [False] * len(rows), "shingles": [sets[i].tobytes() for i, _ in rows]}
    batch = pa.RecordBatch.from_pydict(columns)
    tracemalloc.start()
    found = [tuple(map(int, pair)) for out in similar._within_blocks(80)(iter([batch])) for pair in zip(*(c.to_pylist() for c in out.columns))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(tuple(sorted(pair)) for pair in found) == [(i, i + 240) for i in range(0, 240, 10)]
    assert peak < 150e6


def test_blocks_of_long_sets_are_smaller_and_change_nothing(spark, monkeypatch):
    for name, most in (("BLOCK_SHINGLES", 500), ("PART_SHINGLES", 300), ("PAIRS", 7)):
        monkeypatch.setattr(similar, name, most)
    dealt, in_blocks = [], similar._in_blocks

    def seen(workspace, open_rows, percent, name):
        dealt.append(open_rows.agg(F.max("blocks")).first()[0])
        return in_blocks(workspace, open_rows, percent, name)

    monkeypatch.setattr(similar, "_in_blocks", seen)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    texts = {i: _edited(base, rng, rng.randrange(9)) for i in range(70)}
    got = _answer(minhash_dedup.near_duplicates(_frame(spark, [(i, t, 1, "en") for i, t in texts.items()]), 3, 85))
    assert {i: c for i, (_, c, _) in got.items()} == brute.near_components(texts, 3, 85)
    assert dealt[0] > 5


@pytest.mark.parametrize("size", [1, 12, 400])
def test_signature_agreement_estimates_similarity(size):
    rng = np.random.default_rng(size)
    signer, same = minhash_dedup.Signer(), []
    for _ in range(60):
        common = rng.integers(0, 2**63, 4 * size, dtype=np.uint64)
        a, b = (np.unique(np.concatenate((common, rng.integers(0, 2**63, size // 2, dtype=np.uint64)))) for _ in range(2))
        same.append((signer.signature(a) == signer.signature(b)).mean())
    true = 4 * size / (4 * size + 2 * (size // 2))
    assert abs(np.mean(same) - true) < 0.05


def test_shingles_depend_on_order_and_length():
    a, b, c = (words.word_hashes(x) for x in (b"A b c", b"c b a", b"a b"))
    assert len(words.shingles(a, 3)) == 1 and words.shingles(a, 3)[0] != words.shingles(b, 3)[0] != words.shingles(c, 3)[0]
    assert words.word_hashes("x y  z".encode()).size == 2


def test_one_row_of_each_group_stays(spark):
    rows = [(2, "a b c d e f", 1, "en"), (1, "a b c d e f", 2, "de"), (1, "a b c d e f", 2, "de"), (3, None, 3, "en"), (4, "g", 4, None)]
    left = sorted(map(tuple, minhash_dedup.deduplicated(_frame(spark, rows)).collect()))
    assert left == [(1, "a b c d e f", 2, "de"), (3, None, 3, "en"), (4, "g", 4, None)]
