"""The registered queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import brute
import compare
import corpus_pipeline
from landfall.llm import frames, quality_rules, queries
from landfall.llm.frames import read_table

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    connection = compare.connect(SF)
    assert compare.differences(queries.registered()[name](spark, SF), connection, queries.oracle_sql()[name]) == ""


def test_every_operator_and_the_pipeline_are_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.oracle_sql()) <= set(driver.oracle_sql())


def _rows(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_stages_one_by_one(spark, tmp_path):
    documents = read_table(spark, SF, "documents")
    docs, outs = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        made = stage(spark, docs, SF)
        path = str(tmp_path / name)
        made.write.parquet(path)
        docs = outs[name] = spark.read.parquet(path)
        if name != "shard":
            assert docs.columns == documents.columns
        if name == "quality":
            kept = {r.doc_id for r in quality_rules.quality_rules(before).collect() if r.kept}
            assert {r.doc_id for r in docs.collect()} == kept
        elif name == "near_dedup":
            texts = {r.doc_id: r.text for r in before.collect()}
            found = brute.near_components(texts, 5, 80)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(found.values()))
        elif name == "decontaminate":
            items = [brute.shingle_set(r.text, 5) for r in read_table(spark, SF, "benchmark").collect()]
            clean = {r.doc_id for r in before.collect() if not any(100 * len(i & brute.shingle_set(r.text, 5)) >= 80 * len(i) for i in items)}
            assert {r.doc_id for r in docs.collect()} == clean
        elif name == "mix":
            texts, uses = {r.doc_id: r.text for r in before.collect()}, _rows(docs)
            assert all(n <= 2 and texts[i] == t for (i, t), n in uses.items())
            size = {i: len(brute.words(t)) for i, t in texts.items()}
            taken = sum(size[i] * n for (i, _), n in uses.items())
            assert abs(taken - 1.5 * sum(size.values())) < 0.03 * taken
        elif name == "shard":
            assert _rows(docs) == _rows(before)
            for shard in range(16):
                slots = sorted(r.slot for r in docs.filter(f"shard = {shard}").collect())
                assert slots == list(range(len(slots)))
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_pipeline_of_odd_documents(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, and no rows at all."""
    read_table(spark, SMALL, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = read_table(spark, SMALL, "documents")
    prose = docs.orderBy("doc_id").first().text
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, prose, None, "a", 5), (2, prose, None, "a", 5), (None, prose, "xx", None, None)]
    for number, frame in enumerate((docs.unionByName(spark.createDataFrame(odd, docs.schema)), docs.filter("false"))):
        out = frame
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, out, str(tmp_path)).write.parquet(str(tmp_path / f"{number}-{name}"))
            out = spark.read.parquet(str(tmp_path / f"{number}-{name}"))
        assert (out.count() > 0) == (number == 0)
        assert out.filter("text is null or text = ''").count() == 0


CLASHES = ["_id", "_hash", "_spans", "before", "number", "mix_pass", "mix_order", "doc", "place", "block", "named", "node", "slot_bucket", "uses", "a.b"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_columns_with_any_name_stay(spark, name):
    """Columns named like an operator's own come through every stage with their values."""
    docs = read_table(spark, SMALL, "documents").limit(60)
    clashing = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    repeated = clashing.unionByName(clashing.limit(5))
    out = dict(corpus_pipeline.STAGES)[name](spark, repeated, SMALL)
    assert out.columns[: len(clashing.columns)] == clashing.columns
    rows = out.collect()
    assert rows
    for row in rows:
        assert [row[c] for c in CLASHES] == [f"{c}-{row.doc_id}" for c in CLASHES]


def test_texts_of_certainly_kept_rows_do_not_move(spark):
    """However many rows are rejected, a text whose key is not among them for certain passes no exchange."""
    docs = read_table(spark, SF, "documents")
    rejected = docs.filter("doc_id % 7 = 0").select("doc_id", F.xxhash64("text").alias("text_hash"))
    left = frames.without(docs, rejected)
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == sorted(r.doc_id for r in docs.filter("doc_id % 7 <> 0").select("doc_id").collect())
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text"))
    keys = F.xxhash64(F.col("doc_id").cast("string"), "text_hash")
    certain, possible = frames.probe.split(docs, hashed, frames.probe.bitmap(rejected, keys))
    assert possible.count() <= rejected.count() + 2
    plan = certain._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    again = docs.unionByName(docs.filter("doc_id % 7 = 0").withColumn("text", F.lit("another")))
    assert frames.without(again, rejected).filter("text = 'another'").count() == rejected.count()
