"""Quality of a text: histogram gradient-boosted trees over document statistics.

Statistics are measured once for every text, where the rows are. The trees are fitted on at most FIT_ROWS labelled
rows, taken by the hash of their id; they are complete, so a forest is three arrays, and numpy walks all rows
and trees down a level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace, fold, map_batches, text_bytes
from landfall.llm.quality_rules import measure

FIT_ROWS = 20_000
FOLDS, HELD_OUT = 3, 1
TREES, DEPTH, BINS, RATE, LEAST_WEIGHT = 60, 4, 64, 0.2, 2.0
STATISTICS = [
    "log_words", "word_length", "symbol_rate", "dup_line_share", "repeat_share", "words_per_line", "upper_share", "exclaim_rate",
    "distinct_share", "digit_share", "mark_share", "high_byte_share", "space_share",
]


def statistics(text: bytes | None) -> list[float]:
    """STATISTICS of one text; rates of nothing are 0."""
    text = text or b""
    n, characters, symbols, dup_lines, repeats, lines, upper, exclaims, distinct = measure(text)
    raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n1, lines1 = max(len(text), 1), max(n, 1), max(lines, 1)
    marks = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()
    return [
        float(np.log1p(n)), characters / n1, symbols / n1, dup_lines / lines1, repeats / n1, n / lines1, upper / max(characters, 1), exclaims / n1,
        distinct / n1, raw[48:58].sum() / size, marks / size, raw[128:].sum() / size, (raw[9:14].sum() + raw[32]) / size,
    ]


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = np.array([statistics(text) for text in text_bytes(batch)], np.float64)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in rows.T]], ["doc_id", *STATISTICS])


@dataclass
class Forest:
    """Complete trees: `feature` and `cut` by (tree, inner node), `leaf` by (tree, leaf); a row goes right above the cut."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = np.arange(len(self.leaf)), self.feature.shape[1] if len(self.leaf) else 0
        node = np.zeros((len(rows), len(trees)), np.int64)
        for _ in range(int(np.log2(inner + 1)) if inner else 0):
            value = np.take_along_axis(rows, self.feature[trees, node], axis=1)
            node = 2 * node + 1 + (value > self.cut[trees, node])
        margin = self.start + (self.leaf[trees, node - inner].sum(axis=1) if len(trees) else np.zeros(len(rows)))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _cuts(column: np.ndarray) -> np.ndarray:
    """Upper edges of at most BINS bins of about equal counts."""
    return np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))


def fit(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Trees for the logistic loss. Without rows, or with one label only, there are none and the smoothed share of
    label 1 is every row's score."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = float(np.log(share / (1 - share)))
    none = Forest(np.empty((0, 0), int), np.empty((0, 0)), np.empty((0, 0)), start)
    if len(np.unique(labels)) < 2:
        return none
    cuts = [_cuts(column) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, rows.T)], axis=1)
    features, inner = rows.shape[1], (1 << DEPTH) - 1
    slots = np.arange(features) * BINS
    margin = np.full(len(rows), start)
    out = Forest(np.zeros((TREES, inner), int), np.full((TREES, inner), np.inf), np.zeros((TREES, 1 << DEPTH)), start)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = labels - p, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            width, first = 1 << level, (1 << level) - 1
            at = ((node - first)[:, None] * (features * BINS) + slots + binned).ravel()
            sums = [np.bincount(at, np.repeat(x, features), width * features * BINS).reshape(width, features, BINS) for x in (gradient, weight)]
            left_g, left_w = (np.cumsum(s, axis=2) for s in sums)
            all_g, all_w = left_g[:, :, -1:], left_w[:, :, -1:]
            gain = left_g**2 / (left_w + 1) + (all_g - left_g) ** 2 / (all_w - left_w + 1) - all_g**2 / (all_w + 1)
            gain[(left_w < LEAST_WEIGHT) | (all_w - left_w < LEAST_WEIGHT)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i, (choice, found) in enumerate(zip(best, gain.reshape(width, -1).max(axis=1))):
                f, b = divmod(int(choice), BINS)
                if found > 1e-6 and b < len(cuts[f]):
                    out.feature[tree, first + i], out.cut[tree, first + i] = f, cuts[f][b]
            value = rows[np.arange(len(rows)), out.feature[tree, node]]
            node = 2 * node + 1 + (value > out.cut[tree, node])
        leaf = node - inner
        up, down = (np.bincount(leaf, x, 1 << DEPTH) for x in (gradient, weight))
        out.leaf[tree] = RATE * up / (down + 1)
        margin += out.leaf[tree][leaf]
    return out


def _scored(broadcast):
    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(broadcast.value.scores(rows))], ["doc_id", "score"])

    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs(doc_id, text, ...)`, `labels(doc_id, quality, ...)` -> one row for each row of `docs`: doc_id, held_out, score, predicted.

    Only labels whose fold, crc32 of doc_id modulo FOLDS, is not HELD_OUT are learnt from; of more than FIT_ROWS such rows, the
    ones of the smallest hashed id are. A score sees the text only; null and empty texts are scored by their
    statistics, all 0. Null labels are ignored, repeated rows count each, ties in the sample order are broken by the
    statistics. Without labels every score is 0.5. Extra columns are ignored; no rows give no rows.
    """
    work = Workspace(docs.sparkSession, "quality-classifier")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{s} double" for s in STATISTICS)
    measured = work.table(map_batches(docs.select("doc_id", "text"), _measured, schema), "statistics")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    known = labels.filter("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("double").alias("quality"))
    sample = measured.join(known, "doc_id").filter(~held_out).select(F.xxhash64("doc_id").alias("order"), "doc_id", *STATISTICS, "quality")
    # Of many rows only those below a hash are sorted, twice as many as are needed.
    share = min(1.0, 2 * FIT_ROWS / max(sample.count(), 1))
    sample = sample.filter(F.col("order") <= int((share - 0.5) * 2**64) - 1)
    sample = sample.orderBy("order", "doc_id", *STATISTICS, "quality").limit(FIT_ROWS).toPandas()
    forest = fit(sample[STATISTICS].to_numpy(np.float64), pd.to_numeric(sample["quality"]).to_numpy(np.float64))
    broadcast = docs.sparkSession.sparkContext.broadcast(forest)
    scored = map_batches(measured, _scored(broadcast), f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
