"""The prefix trie and clustering against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from contextlib import contextmanager

import numpy as np
import pytest

from landfall.llm import centroids, prefix_trie

TURNS = "conv_id long, turn int, role string, text string, node int, path string, head string"


@contextmanager
def many_partitions(spark, number):
    settings = {"spark.sql.shuffle.partitions": str(number), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, _digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        ends.setdefault(whole, []).append(c)
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
    children = {node: 0 for node in members}
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, held in members.items():
        cost = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += cost
    return sorted(
        (min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, held in members.items()
    )


def _trie(spark, rows):
    frame = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], TURNS)
    found = prefix_trie.conversation_trie(frame)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(row) for row in found.select(*columns).collect())


def _random_turns(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é", ""])))
    return rows


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_trie_of_random_conversations(spark, partitions):
    """Small alphabets share prefixes at every depth, and with many tasks most nodes are put together from parts."""
    rows = _random_turns(partitions, 300, 7)
    with many_partitions(spark, partitions):
        assert _trie(spark, rows) == brute_trie(rows)


def test_trie_of_a_deep_conversation_and_a_hot_prefix(spark):
    rows = [(1, turn, "user", f"t{turn}") for turn in range(700)]
    rows += [(1000 + c, turn, "user", "same") for c in range(900) for turn in range(3)]
    with many_partitions(spark, 16):
        assert _trie(spark, rows) == brute_trie(rows)


def test_trie_digest_in_blocks(spark, monkeypatch):
    """Ids of a run longer than a block are hashed block by block."""
    def sequences(batches):
        import landfall.llm.prefix_trie as module

        module.BLOCK = 64
        yield from module._peel(batches)

    monkeypatch.setattr(prefix_trie, "_peel", sequences)
    rows = [(c, 0, "user", "same") for c in range(0, 500)]
    with many_partitions(spark, 4):
        assert _trie(spark, rows) == brute_trie(rows)


def test_trie_of_odd_turns(spark):
    """Nulls in every column, ties and repeated rows, negative ids, no rows."""
    rows = [
        (None, 0, "user", "lost"), (5, None, None, None), (5, 0, "user", "a"), (5, 0, "user", "a"), (5, 0, "assistant", "b"), (7, 1, "user", None),
        (-3, 0, "user", "a"), (-5, 0, "user", "z"), (6, 0, "", ""), (6, None, "user", "ü" * 50_000), (8, 3, "u", "ser"), (9, 3, "us", "er"),
    ]
    assert _trie(spark, rows) == brute_trie(rows)
    assert _trie(spark, []) == []


VECTORS = "vec_id long, embedding array<float>, cluster string, point int, distance string"


def _points(rows):
    kept = []
    for vec_id, values in rows:
        if values is not None and len(values) == 64 and all(x is not None and np.isfinite(x) for x in values):
            kept.append((vec_id, [min(max(int(np.floor(256 * float(np.float32(x)))), -(1 << 27)), 1 << 27) for x in values]))
    return kept


def brute_clusters(rows, clusters=40, rounds=5):
    kept = _points(rows)
    order = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), np.array(p, "<i4").tobytes(), p) for i, p in kept)
    middle = [p for _, _, p in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(middle)) for _, p in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(middle)):
            held = [p for (_, p), (_, number) in zip(kept, found) if number == j]
            if held:
                middle[j] = [sum(column) // len(held) for column in zip(*held)]
    found = assign()
    total = {}
    for distance, number in found:
        total[number] = total.get(number, 0) + distance
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(
        (-1 if i is None else i, number, distance, total[number], sum(total.values()), sha[number]) for (i, _), (distance, number) in zip(kept, found)
    )


def _clusters(spark, rows, **parameters):
    frame = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], VECTORS)
    found = centroids.clustered(frame, **parameters)
    return sorted((-1 if r[0] is None else r[0], *r[1:6]) for r in found.collect()), found


def _blobs(seed, n):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, 64))
    return [(int(i), (middle[rng.integers(12)] + rng.normal(size=64) * 0.2).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("clusters, rounds, lead", [(40, 5, 8), (7, 3, 1), (40, 2, 64)])
def test_clusters_are_exact(spark, clusters, rounds, lead):
    rows = _blobs(lead, 240)
    found, frame = _clusters(spark, rows, clusters=clusters, rounds=rounds, lead=lead)
    assert found == brute_clusters(rows, clusters, rounds)
    verified = [r.n_verified for r in frame.collect()]
    assert min(verified) >= 1
    if lead == 8:
        assert np.mean(verified) < clusters / 2  # the bound rules out most centroids


def test_clusters_of_odd_vectors(spark):
    """Vectors left out; ties, copies, huge components, fewer vectors than clusters, no vectors."""
    good = _blobs(3, 10)
    same = [0.5] * 64
    odd = [
        (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [float("nan")] + [1.0] * 63),
        (106, [float("inf")] + [1.0] * 63), (None, same), (107, same), (107, same), (108, same), (109, [3.0e38] * 64), (110, [-3.0e38] * 64),
    ]
    found, _ = _clusters(spark, good + odd)
    assert found == brute_clusters(good + odd)
    ties = [(i, [float(i % 3)] * 64) for i in range(30)]
    assert _clusters(spark, ties, clusters=9)[0] == brute_clusters(ties, 9)
    assert _clusters(spark, odd[:7])[0] == []
    assert _clusters(spark, [])[0] == []
