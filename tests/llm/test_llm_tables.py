from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from landfall.llm import containment, mixing, sharding, similar, substring_dedup, words
from landfall.llm.components import connected_components
from landfall.llm.frames import Workspace, read_table

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


# --- sharding ---

def test_sharding_laws(spark):
    docs = read_table(spark, SF, "documents").withColumn("slot", F.lit("x"))
    rows = sharding.sharded(docs)
    assert Counter(rows.columns) == Counter([*docs.drop("slot").columns, "size", "text_crc32", "law", "shard", "slot", "grown_shard"])
    got = rows.collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.size == len(r.text.encode()) + 1 and r.text_crc32 == zlib.crc32(r.text.encode()) and r.law == "key"
        assert r.grown_shard in (r.shard, 16)
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and 30 < len(slots) < 100
    assert 30 < sum(r.grown_shard == 16 for r in got) < 95
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(docs.repartition(5)).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    before = sharding.topology()
    after = [sharding.Shard(s.number, s.region, s.rack, 3.0 if s.number == 5 else s.weight) for s in before]
    gone = [sharding.Shard(s.number, s.region, s.rack, 0.0 if s.number == 5 else s.weight) for s in before]
    ids = spark.range(20_000).select(*[sharding.shard_of(F.col("id"), t).alias(n) for n, t in (("a", before), ("b", after), ("c", gone))])
    rows = ids.collect()
    place = {s.number: (s.region, s.rack) for s in before}
    for r in rows:
        if r.a != r.b:  # into the region of shard 5, within it into its rack, within that into it
            assert place[r.b][0] == place[5][0]
            assert place[r.a][0] != place[5][0] or place[r.b][1] == place[5][1]
            assert place[r.a] != place[5] or r.b == 5
        if r.a != r.c:
            assert place[r.a][0] == place[5][0]
    share = Counter(r.b for r in rows)
    assert abs(share[5] / len(rows) - 3 / 18) < 0.02 and abs(share[0] / len(rows) - 1 / 18) < 0.01
    assert Counter(r.c for r in rows)[5] == 0


def test_sharding_odd_rows(spark):
    rows = spark.createDataFrame([(None, None), (None, None), (1, ""), (1, ""), (2, "é")], "doc_id long, text string")
    got = sharding.sharded(rows).collect()
    assert sorted(r.size for r in got) == [1, 1, 1, 1, 3] and {r.text_crc32 for r in got} == {0, zlib.crc32("é".encode())}
    slots: dict = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(rows.filter("false")).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("x"), [sharding.Shard(0, "a", "b", 0.0)])


# --- mixing ---

def _targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        free = [s for s in names if s not in full]
        left, weight = total - sum(2 * sizes[s] for s in full), sum(weights[s] for s in free)
        out = {s: 2.0 * sizes[s] if s in full else left * weights[s] / weight for s in names}
        over = [s for s in free if out[s] > 2 * sizes[s]]
        if not over:
            return out
        full.update(over)


def _check_mix(docs, near=0.02):
    rows = docs.collect()
    sizes: dict = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    targets = _targets(sizes)
    mix = mixing.Mix(docs)
    got = mix.per_document().collect()
    assert len(got) == len(rows)
    source = {r.doc_id: r.source for r in rows}
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - targets[s]) <= 1e-6 * (1 + targets[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in targets:
        assert abs(taken[s] - targets[s]) <= near * targets[s] + 20, (s, taken[s], targets[s])
    assert sorted(map(tuple, mixing.Mix(docs.repartition(3)).per_document().collect())) == sorted(map(tuple, got))
    return mix, got


def test_mix_meets_targets(spark):
    docs = read_table(spark, SF, "documents")
    mix, got = _check_mix(docs)
    used = mix.rows().collect()
    counts, size = Counter(r.doc_id for r in used), {r.doc_id: r.size for r in got}
    assert all(counts[r.doc_id] * r.size == r.taken for r in got)
    assert set(used[0].asDict()) == {*docs.columns, "mix_pass", "mix_shard", "mix_order"}
    blocks = Counter(r.shard for r in mix.tokens.collect())
    assert max(blocks.values()) - min(blocks.values()) <= 3 and len(blocks) == mixing.SHARDS


def test_mix_with_null_and_hot_sources(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 else f"s{i % 7}", "w " * rng.randrange(40)) for i in range(3000)]
    _check_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"))


def test_mix_of_nothing(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "a", ""), (2, "a", " ")], "doc_id long, source string, text string")
    assert {(r.size, r.target, r.taken) for r in mixing.Mix(rows).per_document().collect()} == {(0, 0.0, 0)}
    assert mixing.Mix(rows.filter("false")).per_document().collect() == []
    same = spark.createDataFrame([(7, "a", "b c")] * 3, rows.schema)
    assert {r.taken for r in mixing.Mix(same).per_document().collect()} <= {2, 4}


def test_splitting_tree_keeps_quotas(spark):
    work = Workspace(spark, "test-quotas")
    quotas = {f"s{i}": i * 37 % 50 for i in range(20)}
    rows = spark.createDataFrame([(True, s, q) for s, q in quotas.items()], "named boolean, name string, quota long")
    got = mixing.shard_quotas(work, rows, 8).collect()
    per_source, per_shard = Counter(), Counter()
    for r in got:
        assert r.quota >= 0
        per_source[r.name] += r.quota
        per_shard[r.shard] += r.quota
    assert all(per_source[s] == q for s, q in quotas.items())
    assert max(per_shard.values()) - min(per_shard.values()) <= 3


# --- decontamination ---

def _contained(docs: dict, items: dict, k=5, percent=80):
    out = set()
    sets = {i: brute.shingle_set(t, k) for i, t in items.items() if len(brute.words(t)) >= k}
    for d, text in docs.items():
        own = brute.shingle_set(text, k) if len(brute.words(text)) >= k else set()
        for i, s in sets.items():
            if 100 * len(s & own) >= percent * len(s):
                out.add((d, i, len(s), len(s & own)))
    return out


def test_contained_items_equal_brute_force(spark, monkeypatch):
    docs, items = read_table(spark, SF, "documents"), read_table(spark, SF, "benchmark")
    expected = _contained({r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in items.collect()})
    for size in (containment.ITEM_BYTES, 2000):
        monkeypatch.setattr(containment, "ITEM_BYTES", size)
        got = {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in containment.contained(docs, items).collect()}
        assert got == expected and expected
    left = containment.decontaminated(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.select("doc_id").collect()} == {r.doc_id for r in docs.collect()} - {e[0] for e in expected}


def test_partial_and_scattered_items(spark, monkeypatch):
    monkeypatch.setattr(containment, "PIECE", 500)
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 6, 20, 70, 300]))) for i in range(30)}
    docs = {}
    for d in range(60):
        w, item = rng.choices(vocabulary, k=rng.randrange(0, 1500)), items[d % 30].split()
        if d % 4 == 0:
            item = item[: len(item) * 9 // 10 + 1]
        if d % 5 == 0:
            item[len(item) // 2 : len(item) // 2] = ["new"]
        at = rng.randrange(len(w) + 1)
        docs[d] = " ".join(w[:at] + [x.upper() for x in item] + w[at:])
    docs |= {100: None, 101: "", 102: "a b"}
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs.items()], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*[(str(i), t, None) for i, t in items.items()], ("x", None, None), ("0", items[0], None)], "item_id string, text string, doc_id int")
    got = [(r.doc_id, int(r.item_id), r.n_item_shingles, r.n_shared) for r in containment.contained(frame, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == _contained(docs, items)
    assert containment.contained(frame.filter("false"), bench).collect() == []
    assert containment.contained(frame, bench.filter("false")).collect() == []


# --- repeated passages ---

def _passage_docs():
    rng = random.Random(6)
    def prose(n):
        return [f"p{rng.randrange(10**6)}" for _ in range(n)]

    passages = [prose(n) for n in (52, 60, 90, 300)]
    docs, holds = {}, {}
    for d in range(40):
        w = prose(rng.randrange(20, 400))
        if d < 20:
            at = rng.randrange(len(w))
            w[at:at] = passages[d % 4]
            holds[d] = d % 4
        docs[d] = "\n".join(" ".join(w[i : i + 37]) for i in range(0, len(w), 37))
    return docs, holds, passages


def test_passages_are_found_and_clean_documents_left(spark):
    docs, holds, passages = _passage_docs()
    docs |= {50: None, 51: "", 52: "That it.", 53: "That it.", 54: docs[39] + " " + docs[39]}
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs.items()], "doc_id long, text string, component int")
    found = substring_dedup.repeated_passages(frame).collect()
    assert {r.doc_id for r in found} == {*holds, 39, 54}
    for r in found:
        w = b" ".join(brute.words(docs[r.doc_id])[r.first_word : r.first_word + r.n_words]).decode()
        own = brute.shingle_set(w, 5)
        others = [d for d in docs if d != r.doc_id and 100 * len(own & brute.shingle_set(docs[d], 5)) >= 80 * len(own)]
        assert others and r.component_id in (r.doc_id, *others)
        assert r.removed == (r.doc_id != r.component_id)
    covered = Counter()
    for r in found:
        covered[r.doc_id] += r.n_words
    assert all(20 <= covered[d] <= len(passages[p]) + 4 for d, p in holds.items())
    cut = {r.doc_id: r.text for r in substring_dedup.without_passages(frame, substring_dedup.repeated_passages(frame)).collect()}
    assert set(cut) == set(docs) and cut[50] is None and cut[30] == docs[30]
    removed = Counter()
    for r in found:
        removed[r.doc_id] += r.n_words if r.removed else 0
    assert all(len(brute.words(cut[d])) == len(brute.words(docs[d])) - removed[d] for d in docs)


def test_short_passages_are_found_to_their_last_word(spark):
    rng = random.Random(51)
    passages = [[f"s{rng.randrange(10**6)}" for _ in range(51 + i % 10)] for i in range(400)]
    docs, holds = {}, {}
    for i, passage in enumerate(passages):
        for d in (2 * i, 2 * i + 1):
            w = [f"h{rng.randrange(10**7)}" for _ in range(90)]
            w[30:30] = passage
            docs[d], holds[d] = " ".join(w), (30, 30 + len(passage))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = substring_dedup.repeated_passages(frame).collect()
    places: dict = {}
    for r in found:
        places.setdefault(r.doc_id, []).extend(range(r.first_word, r.first_word + r.n_words))
        assert r.removed == (r.doc_id % 2 == 1)
    assert set(places) == set(docs)
    for d, (low, high) in holds.items():
        assert len(places[d]) == len(set(places[d])) <= high - low + 4 and set(range(low, high)) <= set(places[d])


def test_words_without_a_cut_are_followed_to_their_end(spark):
    """Equal words hold no cut; the edges are compared in more than one turn."""
    rng = random.Random(52)
    passage = [f"s{rng.randrange(10**6)}" for _ in range(60)] + ["ha"] * 300
    own = [[f"{d}h{i}" for i in range(40)] for d in range(3)]
    frame = spark.createDataFrame([(d, " ".join(own[d][:20] + passage + own[d][20:])) for d in range(3)], "doc_id long, text string")
    cut = {r.doc_id: r.text.split() for r in substring_dedup.without_passages(frame, substring_dedup.repeated_passages(frame)).collect()}
    assert cut[0] == own[0][:20] + passage + own[0][20:] and cut[1] == own[1] and cut[2] == own[2]


def test_near_paragraphs_join_and_no_rows(spark):
    shared = [f"n{i}" for i in range(200)]
    w = list(shared)
    starts = substring_dedup.paragraph_starts(words.word_hashes(" ".join(w).encode())).tolist()
    assert starts[0] == 0 and min(np.diff(starts)) > substring_dedup.REACH
    frame = spark.createDataFrame([(1, " ".join(shared), 0), (2, "pre " + " ".join(shared), 0), (None, " ".join(shared), 0)], "doc_id long, text string, node int")
    found = substring_dedup.repeated_passages(frame).collect()
    assert {1, 2} <= {r.doc_id for r in found}
    assert substring_dedup.repeated_passages(frame.filter("false")).collect() == []
    assert substring_dedup.repeated_passages(frame.filter("doc_id = 1").unionByName(frame.filter("doc_id = 1"))).collect() == []


def test_passages_with_changed_words(spark):
    """Passages of which one word in fifty is changed: copies are cut but for a few words, and what is their own stays."""
    rng = random.Random(53)
    docs, own = {}, {}
    for i in range(60):
        passage = [f"s{rng.randrange(10**6)}" for _ in range(200)]
        for d in (2 * i, 2 * i + 1):
            held = list(passage)
            for at in rng.sample(range(5, 195), 4 if d % 2 else 0):
                held[at] = f"x{d}x{at}"
            own[d] = [f"h{d}h{n}" for n in range(80)]
            docs[d] = " ".join(own[d][:40] + held + own[d][40:])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = substring_dedup.repeated_passages(frame)
    cut = {r.doc_id: r.text.split() for r in substring_dedup.without_passages(frame, found).collect()}
    assert all(cut[d] == docs[d].split() for d in docs if d % 2 == 0)
    left = [len(set(cut[d]) - set(own[d])) for d in docs if d % 2]
    assert sum(left) / len(left) < 0.25 * 200 and all(set(own[d]) <= set(cut[d]) for d in docs)


def test_changed_copies_beside_exact_ones_and_without_an_equal_paragraph(spark):
    """Long paragraphs at the threshold are linked if all short ones of one repeat elsewhere, and if they have no short one in common."""
    rng = random.Random(55)
    docs, own = {}, {}
    for i in range(40):
        passage = [f"s{rng.randrange(10**6)}" for _ in range(200)]
        for d in (3 * i, 3 * i + 1, 3 * i + 2):
            held = list(passage)
            for at in rng.sample(range(5, 195), 4 if d % 3 == 2 else 0):
                held[at] = f"x{d}x{at}"
            own[d] = [f"h{d}h{n}" for n in range(80)]
            docs[d] = " ".join(own[d][:40] + held + own[d][40:])
    # In the order of their hashes, words hold no cut.
    line = [f"q{i}" for i in range(52)]
    order = np.argsort(words.mix(words.word_hashes(" ".join(line).encode()) + np.uint64(77)))
    line = [line[i] for i in order]
    docs |= {500: " ".join(line), 501: " ".join([*line[:26], "other", *line[27:]])}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = substring_dedup.repeated_passages(frame)
    cut = {r.doc_id: r.text.split() for r in substring_dedup.without_passages(frame, found).collect()}
    assert cut[500] == line and len(cut[501]) <= 2
    left = [len(set(cut[d]) - set(own[d])) for d in own if d % 3 == 2]
    assert sum(left) / len(left) < 0.25 * 200 and all(set(own[d]) <= set(cut[d]) for d in own)


def test_a_paragraph_at_the_end_of_a_text_is_equal_to_one_that_goes_on(spark):
    """A cut with fewer than five words after it may be none where the text goes on."""
    rng = random.Random(56)
    docs, wanted = {}, {}
    for d in range(0, 400, 2):
        passage = [f"s{rng.randrange(10**7)}" for _ in range(26)]
        docs[d] = " ".join([f"a{d}a{i}" for i in range(60)] + passage)
        docs[d + 1] = " ".join([f"b{d}b{i}" for i in range(60)] + passage + [f"c{d}c{i}" for i in range(60)])
        starts = [substring_dedup.paragraph_starts(words.word_hashes(docs[x].encode())).tolist() for x in (d, d + 1)]
        late = [x for x in starts[0] if x > 86 - 6]
        inside = [[x for x in own if 60 <= x <= 86] for own in starts]
        if late and inside[1] == [*inside[0][:-1], 86] and len(inside[1]) == 2:
            wanted[d] = inside[1][0]
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.doc_id for r in substring_dedup.repeated_passages(frame).collect()}
    assert wanted and {x for d, first in wanted.items() if 86 - first >= 20 for x in (d, d + 1)} <= found


def test_links_of_stars_equal_all_pairs(spark):
    """Sets of all similarities: components of the links found are those of all pairs at the threshold, and recall of single pairs is measured."""
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**62, size=(60, 40)).astype(np.uint64)
    sets = []
    for row in base:
        sets.append(np.unique(row))
        for changed in (2, 4, 6, 12):
            other = row.copy()
            other[rng.choice(40, changed, replace=False)] = rng.integers(1, 2**62, size=changed)
            sets.append(np.unique(other))
    bands, rows = substring_dedup.tuned_bands()
    keys = substring_dedup._Bands(bands, rows).keys(sets)
    nodes = [words.set_key(own) for own in sets]
    frame = spark.createDataFrame([(n, k.tolist()) for n, k in zip(nodes, keys)], "node long, bands array<long>")
    held = spark.createDataFrame([(n, bytearray(own.tobytes())) for n, own in zip(nodes, sets)], "node long, shingles binary")
    work = Workspace(spark, "test-stars")
    links = similar.links_of_stars(work, similar.star_edges(work, frame), held, 80)
    got = {r.node: r.component for r in connected_components(work, links, "test").collect()}
    pairs = [(a, b) for i, a in enumerate(nodes) for j, b in enumerate(nodes[:i]) if similar.enough(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), 80)]
    expected = brute.components({x for p in pairs for x in p}, pairs)
    assert got == expected and len(pairs) > 100


def test_recall_of_the_bands():
    """Measured on 20,000 pairs at a similarity of just 0.8."""
    rng = np.random.default_rng(6)
    bands, rows = substring_dedup.tuned_bands()
    assert rows >= 2
    signer, missed, n = substring_dedup._Bands(bands, rows), 0, 20_000
    for _ in range(10):
        shared = rng.integers(1, 2**62, size=(n // 10, 45)).astype(np.uint64)
        left, right = ([np.sort(np.concatenate((row[:40], rng.integers(1, 2**62, size=5).astype(np.uint64)))) for row in shared] for _ in range(2))
        missed += int((~(signer.keys(left) == signer.keys(right)).any(axis=1)).sum())
    assert missed / n < 1e-3


def test_removal_tells_rows_of_one_id_apart(spark):
    """A second row of a doc_id with another text loses nothing of its own; clashing names and odd rows come through."""
    rng = random.Random(54)
    passage = [f"s{rng.randrange(10**6)}" for _ in range(120)]
    text = " ".join([f"a{i}" for i in range(30)] + passage)
    other, kept = " ".join(f"o{i}" for i in range(200)), " ".join(passage + [f"b{i}" for i in range(30)])
    rows = [(1, kept, 0, "x"), (2, text, 1, "x"), (2, other, 2, "x"), (2, None, 3, "x"), (3, "", 4, None), (None, other + " z", 5, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans int, _id string")
    found = substring_dedup.repeated_passages(frame)
    cut = substring_dedup.without_passages(frame, found)
    assert cut.columns == frame.columns
    left = {r.spans: r.text for r in cut.collect()}
    assert left == {0: kept, 1: " ".join(f"a{i}" for i in range(30)) + " ", 2: other, 3: None, 4: "", 5: other + " z"}


# --- components ---

def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)] + [(rng.randrange(6000, 6100), rng.randrange(6000, 6100)) for _ in range(80)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    expected = brute.components(nodes, [e for e in edges if e[0] != e[1]])
    frame = spark.createDataFrame(edges + edges[:50], "a long, b long")
    got = {r.node: r.component for r in connected_components(Workspace(spark, "test-components"), frame, "c").collect()}
    assert got == expected
