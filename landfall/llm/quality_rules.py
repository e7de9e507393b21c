"""Quality rules: fixed base rules, and thresholds that follow each language and source.

A first pass measures every text. Its statistics go into quantile sketches, counts per (lang, source, rule, bucket)
whose buckets are a 32nd of their value wide. Sketches merge by addition, in any order, to the same counts, so
thresholds can be repeated. The quartiles of a group are blended with those of its language, and these with those of all documents, as
if PRIOR_ROWS of the wider ones were its own: few documents lean on their language, many stand for themselves, without a border.

A fence lies some spreads beyond the median. The spread is that of the half on the other side, which stays clean as long as less than
half of the group is junk. No fence lies further out than MOST_REACH spreads of the language allow, nor further in than its own fence, so that a
source which is mostly junk neither keeps it nor loses what is clean. The fences are joined back to the measured rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace, map_batches, text_bytes, with_text_hash, without

MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
# A fence lies REACH spreads from the median; a spread is the distance to the quartile on the other side, or the rule's least.
REACH, MOST_REACH, PRIOR_ROWS = 4, 8, 50
# rule: (statistic in thousandths, least spread, whether it has an upper fence, a lower one)
RULES = {
    "symbols": ("n_symbols * 1000 div n_words", 30, True, False),
    "exclaims": ("n_exclaims * 1000 div n_words", 50, True, False),
    "upper": ("n_upper * 1000 div word_chars", 50, True, False),
    "dup_lines": ("n_dup_lines * 1000 div n_lines", 150, True, False),
    "distinct": ("n_distinct * 1000 div n_words", 60, False, True),
    "word_length": ("word_chars * 1000 div n_words", 1500, True, True),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaims", "n_distinct"]


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text. Windows are compared exactly: numbered words,
    then numbered pairs of numbers."""
    n = len(words)
    if n <= width:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    codes = ids[: n - width + 1]
    for i in range(1, width):
        codes = pd.factorize(codes * n + ids[i : n - width + 1 + i])[0].astype(np.int64)
    often = np.bincount(codes)[codes] > 1
    if not often.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """COUNTS of one text. Word characters are code points: bytes that do not continue one."""
    text = text or b""
    words = text.split()
    packed = b"".join(words)
    raw = np.frombuffer(packed, np.uint8)
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return (
        len(words), int(((raw & 0xC0) != 0x80).sum()), sum(text.count(s) for s in (bytes([b]) for b in SYMBOLS)), len(lines) - len(set(lines)),
        repeated_window_words(words), len(lines), int(((raw >= 65) & (raw <= 90)).sum()), text.count(b"!"), len(set(words)),
    )


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts = np.array([measure(text) for text in text_bytes(batch)], np.int64)
    columns = [batch.column(c) for c in ("doc_id", "lang", "source", "text_hash")] + [pa.array(c) for c in counts.T]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "source", "text_hash", *COUNTS])


def bucket(value: Column) -> Column:
    """Bucket of a value of 0 or more: itself below 64, then 32 to each doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * 32).cast("long") + F.call_function("shiftright", value, shift)


def bucket_start(number: Column) -> Column:
    shift = F.greatest((F.floor(number / 32) - 1).cast("int"), F.lit(0))
    return F.call_function("shiftleft", number - (shift * 32).cast("long"), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """`(lang, source, rule, bucket, n)`: the counts of every group's quantile sketches, over texts that have words."""
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), bucket(F.expr(value)).alias("bucket")) for name, (value, *_) in RULES.items()])
    rows = measured.filter("n_words > 0").select("lang", "source", F.inline(rules))
    return rows.groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n"))


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """`(*keys, rule, rows, q1, q2, q3)` of summed sketches."""
    group = Window.partitionBy(*keys, "rule")
    summed = counts.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    ranked = summed.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("rows", F.sum("n").over(group))
    at = {q: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * i, F.col("bucket"))) for q, i in (("q1", 1), ("q2", 2), ("q3", 3))}
    return ranked.groupBy(*keys, "rule").agg(F.max("rows").alias("rows"), *[bucket_start(v).alias(q) for q, v in at.items()])


def _blended(rows: DataFrame, own: str, wider: str) -> DataFrame:
    """Quartiles `own` as if PRIOR_ROWS of the documents had the `wider` ones, in whole numbers."""
    rest = [c for c in rows.columns if c not in ("q1", "q2", "q3")]
    blends = [F.expr(f"({own}rows * {own}{q} + {PRIOR_ROWS} * {wider}{q}) div ({own}rows + {PRIOR_ROWS})").alias(f"{own}{q}") for q in ("q1", "q2", "q3")]
    return rows.select(*[c for c in rest if c not in {f"{own}{q}" for q in ("q1", "q2", "q3")}], *blends)


def thresholds(counts: DataFrame) -> DataFrame:
    """`(lang, source, fences)`: per rule the lowest and highest statistic that passes."""
    quartiles = ("q1", "q2", "q3")
    of_all = _quartiles(counts, []).select(F.col("rule").alias("_all"), *[F.col(q).alias(f"all_{q}") for q in quartiles])
    of_lang = _quartiles(counts, ["lang"]).select(F.col("lang").alias("_lang"), F.col("rule").alias("_rule"), *[F.col(c).alias(f"lang_{c}") for c in ("rows", *quartiles)])
    of_lang = _blended(of_lang.join(of_all, F.col("_rule") == F.col("_all")), "lang_", "all_").select("_lang", "_rule", *[f"lang_{q}" for q in quartiles])
    own = _quartiles(counts, ["lang", "source"]).select("lang", "source", "rule", *[F.col(c).alias(f"own_{c}") for c in ("rows", *quartiles)])
    joined = own.join(of_lang, own["lang"].eqNullSafe(F.col("_lang")) & (own["rule"] == F.col("_rule")))
    chosen = _blended(joined, "own_", "lang_")
    least = F.create_map(*[F.lit(x) for name, (_, spread, *_) in RULES.items() for x in (name, spread)])[F.col("rule")]

    def fence(of: str, reach: int, side: int) -> Column:
        low, middle, high = (F.col(f"{of}_{q}") for q in quartiles)
        return middle + side * reach * F.greatest(middle - low if side > 0 else high - middle, least)

    low = F.greatest(F.least(fence("own", REACH, -1), fence("lang", REACH, -1)), fence("lang", MOST_REACH, -1))
    high = F.least(F.greatest(fence("own", REACH, 1), fence("lang", REACH, 1)), fence("lang", MOST_REACH, 1))
    per_rule = [F.max(F.when(F.col("rule") == name, F.struct(low.alias("low"), high.alias("high")))).alias(name) for name in RULES]
    return chosen.groupBy("lang", "source").agg(*per_rule)


def quality_rules(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text, lang, source, ...)` -> one row for each row: doc_id, text_hash (of Spark), COUNTS, base_failed,
    failed (names of the rules broken), kept.

    base_failed: fewer than MIN_WORDS words, or more than REPEAT_PERCENT of them in repeated windows. Null, empty
    and word-less texts fail so. Null languages and sources are groups of their own. Extra columns are ignored,
    repeated rows are judged each, and no rows give no rows.
    """
    work = Workspace(docs.sparkSession, "quality-rules")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, source string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS)
    plain = with_text_hash(docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text"))
    measured = work.table(map_batches(plain, _measured, schema), "measured")
    fences = work.table(thresholds(work.table(sketches(measured), "sketches")), "fences")
    limits = fences.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.struct(*RULES).alias("fences"))
    rows = measured.join(limits, measured["lang"].eqNullSafe(F.col("_lang")) & measured["source"].eqNullSafe(F.col("_source")), "left")
    base_failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")
    broken = []
    for name, (value, _, upper, lower) in RULES.items():
        outside = F.lit(False)
        if upper:
            outside = outside | (F.expr(value) > F.col(f"fences.{name}.high"))
        if lower:
            outside = outside | (F.expr(value) < F.col(f"fences.{name}.low"))
        broken.append(F.when((F.col("n_words") > 0) & outside, F.lit(name)))
    failed = F.filter(F.array(*broken), lambda x: x.isNotNull())
    rows = rows.withColumn("base_failed", base_failed).withColumn("failed", failed)
    return rows.select("doc_id", "text_hash", *COUNTS, "base_failed", "failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns, whatever their names. Null, empty and word-less texts go, and
    rows that repeat a doc_id and text go or stay together."""
    work = Workspace(docs.sparkSession, "quality-filtered")
    rejected = work.table(quality_rules(docs).filter("not kept").select("doc_id", "text_hash"), "rejected")
    return without(docs, rejected)
