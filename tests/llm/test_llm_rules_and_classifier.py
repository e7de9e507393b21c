from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from landfall.llm import quality_classifier, quality_rules
from landfall.llm.frames import read_table

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def _base(text):
    w = [x.decode() for x in brute.words(text, lower=False)]
    text = text or ""
    lines = [x for x in text.split("\n") if brute.words(x, lower=False)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows: dict = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_base_statistics_equal_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    odd = ["", None, " \n\t", "a b c d e a b c d e", "x\ny\nx\n\n\nx", "é b c\x85d # <|>", "one " * 11, "w " * 50_000]
    extra = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    rows = docs.select("doc_id", "text", "lang", "source").unionByName(extra, allowMissingColumns=True).withColumn("kept", F.lit(1)).withColumn("rule", F.lit(1))
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = quality_rules.quality_rules(rows).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_clean_documents_stay_and_junk_goes(spark):
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    got = {r.doc_id: r for r in quality_rules.quality_rules(read_table(spark, SF, "documents")).collect()}
    clean = [got[i] for i, q in labels.items() if q == 1 and not got[i].base_failed]
    junk = [got[i] for i, q in labels.items() if q == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


@pytest.mark.parametrize("share", [20, 30, 60])
def test_a_source_of_much_junk_does_not_set_its_own_fences(spark, share):
    """A source of which 20, 30 or 60 % is junk loses it, and clean documents of both sources stay."""
    rng = np.random.default_rng(share)
    stock = ["the", "a", "river", "house", "green", "walked", "slowly", "over", "bridge", "and", "saw", "many", "people", "there", "yesterday", "evening"]
    rows = []
    for i in range(800):
        words = rng.choice(stock, 80)
        junk = i >= 400 and i % 100 < share
        text = " ".join(f"{w}{'#$%'[n % 3] * 3}" if junk and n % 2 else str(w) for n, w in enumerate(words))
        rows.append((i, text + f" {i}", "en", "clean" if i < 400 else "mixed", junk))
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept or r.base_failed for r in quality_rules.quality_rules(docs).collect()}
    junk = [kept[r[0]] for r in rows if r[4]]
    assert sum(junk) <= 0.05 * len(junk)
    assert sum(kept[r[0]] for r in rows if not r[4]) >= 0.99 * (len(rows) - len(junk))


def test_sketch_quartiles_are_near_exact_ones_and_merge(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 100_000, 3000)
    rows = spark.createDataFrame([("en", f"s{i % 7}", int(v)) for i, v in enumerate(values)], "lang string, source string, v long")
    starts = rows.select("v", quality_rules.bucket_start(quality_rules.bucket(F.col("v"))).alias("start")).collect()
    assert all(r.start <= r.v <= r.start * 33 / 32 + 1 for r in starts)
    counts = rows.select("lang", "source", F.lit("x").alias("rule"), quality_rules.bucket(F.col("v")).alias("bucket")).groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n"))
    of_all = quality_rules._quartiles(counts, ["lang"]).first()
    assert of_all.rows == 3000
    for q, at in (("q1", 0.25), ("q3", 0.75)):
        assert abs(of_all[q] - np.quantile(values, at)) <= np.quantile(values, at) / 30


def test_rules_keep_all_columns_and_take_no_rows(spark):
    docs = read_table(spark, SMALL, "documents").withColumn("n_words", F.lit("x"))
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < docs.count()
    assert quality_rules.quality_rules(docs.filter("false")).collect() == []
    nulls = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    assert quality_rules.quality_rules(nulls).count() == docs.count()


def test_held_out_quality_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = {r.doc_id: r for r in quality_classifier.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)


def test_held_out_labels_make_no_difference(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality_classifier.quality_scores(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_classifier_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "a b", 3.0), (1, "x " * 40_000, 4.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_classifier.quality_scores(docs, labels).collect()
    assert len(got) == 4 and {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert quality_classifier.quality_scores(docs.filter("false"), labels).collect() == []


@pytest.mark.parametrize("rows", [1, 400])
def test_flat_forest_equals_walking_each_tree(rows):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(500, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > 0)).astype(float)
    forest = quality_classifier.fit(x, y)
    some = rng.normal(size=(rows, 5))

    def walk(row):
        margin = forest.start
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-margin))

    assert np.allclose(forest.scores(some), [walk(row) for row in some])
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.95
