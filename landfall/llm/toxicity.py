"""Toxicity of a text: terms learnt from labelled documents, found misspelt too, and judged by what stands around them.

1. Words of labelled documents are counted where the documents are. A word that goes with the label too surely for chance becomes a
   term. Words near a term that clean documents use are ordinary; of the rest, a term's own near misses among labelled documents
   tell how likely one is meant ill.
2. Every text is read once with the automaton of `lexicon.py`. A hit counts by its weight and its window: other
   hits and an address near it raise it, words of reporting before it lower it, and hits inside quotation marks are summed up apart.
3. A logistic model of these sums, held near prior weights, gives the score.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace, fold, map_batches
from landfall.llm.lexicon import LONGEST, Lexicon, Match, Matcher

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
# The classifier is fitted on so many labelled rows at most, its terms on LABELLED, those of the smallest hashed id.
LABELLED, FIT_ROWS = 200_000, 20_000
MOST_TERMS, MOST_ORDINARY = 2_000, 20_000
# A term has so many letters at least, goes with the label in half of its documents, and is a chance find in one corpus of twenty.
SHORTEST, LEAST_RATE, CHANCE = 3, 0.5, 0.05
# What a word one or two edits from a term is believed to be before any was seen, as if so many had been.
NEAR_MISS, SEEN_BEFORE = (0.6, 0.4), 4
WORDS_HELD = 200_000  # distinct words a task counts before it hands them on

WINDOW = 6  # words on either side
NEIGHBOUR, MOST_NEIGHBOURS, ADDRESSED, REPORTED = 0.25, 2, 0.25, 0.5
QUOTATION = re.compile(r'"[^"\n]{1,400}"|“[^”\n]{1,400}”|«[^»\n]{1,400}»|„[^“”\n]{1,400}[“”]|^>[^\n]*', re.MULTILINE)
# Fixed words of four languages: who is spoken to, and that somebody else's words follow.
ADDRESS = frozenset("you your yours u ur du dich dir dein deine ihr euch sie tu toi te ton ta vous votre usted tú ti vosotros ustedes".split())
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes reads term word sagte sagt schrieb nannte zitat wort dit écrit appelé citation mot dijo dice escribió llamó cita palabra".split()
)
WORD = re.compile(r"[^\W_]+")

FEATURES = ["open_mass", "near_mass", "quoted_mass", "highest", "rate", "terms"]
# What the model believes before it sees a label: logit for one unit of each feature.
PRIOR, PRIOR_ROWS = (2.0, 1.5, 0.3, 2.0, 0.2, 0.5), 1.0


# --- learning the terms -----------------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word, and a 64-bit linear counter of what stood before it under label 1."""
    counts: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        columns = list(zip(*counts.values())) or [(), (), ()]
        bits = [b - (1 << 64) if b >> 63 else b for b in columns[2]]
        arrays = [pa.array(list(counts), pa.string()), *[pa.array(c, pa.int64()) for c in (*columns[:2], bits)]]
        return pa.RecordBatch.from_arrays(arrays, ["word", "toxic", "clean", "contexts"])

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = [w.lower() for w in WORD.findall(text or "")]
            if toxic:
                before = dict(zip(reversed(words), reversed(["", *words[:-1]])))  # of a word's first place
                for word, last in before.items():
                    if len(word) <= LONGEST + 2:
                        held = counts.setdefault(word, [0, 0, 0])
                        held[0] += 1
                        held[2] |= 1 << zlib.crc32(last.encode()) % 64
            else:
                for word in set(words):
                    if len(word) <= LONGEST + 2:
                        counts.setdefault(word, [0, 0, 0])[1] += 1
            if len(counts) > WORDS_HELD:
                yield out()
                counts.clear()
    yield out()


def _sampled(rows: DataFrame, most: int, *ties: str) -> DataFrame:
    """At most `most` rows, those of the smallest hashed doc_id. Of many rows only those below a hash are sorted."""
    share = min(1.0, 2 * most / max(rows.count(), 1))
    below = rows.withColumn("order", F.xxhash64("doc_id")).filter(F.col("order") <= int((share - 0.5) * 2**64) - 1)
    return below.orderBy("order", "doc_id", *ties).limit(most).drop("order")


def _learnable(labels: DataFrame) -> DataFrame:
    """doc_id, toxic as 0 or 1 of the rows that may be learnt from."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    return known.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))


def learnt_lexicon(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Terms from the labelled documents of every fold but the held-out one. The driver gets at most MOST_TERMS terms and MOST_ORDINARY ordinary words."""
    work = Workspace(docs.sparkSession, "toxic-terms")
    # At most LABELLED narrow rows are broadcast.
    sample = F.broadcast(_sampled(_learnable(labels), LABELLED, "toxic"))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic")
    partial = rows.mapInArrow(_counted, "word string, toxic long, clean long, contexts long")
    words = partial.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("contexts").alias("contexts"))
    words = work.table(words, "words")
    total = _label_share(docs, sample)
    tested = max(words.count(), 1)
    needed = math.log(tested / CHANCE)
    # Evidence is at most the documents times -log(share), so rarer words need not be looked at.
    fewest = math.ceil(needed / -math.log(total))
    usable = F.char_length("word").between(SHORTEST, LONGEST) & (F.col("toxic") >= fewest) & (F.col("toxic") >= LEAST_RATE * (F.col("toxic") + F.col("clean")))
    judged = words.filter(usable).withColumn("evidence", _evidence(total)).filter(F.col("evidence") >= needed)
    terms = judged.orderBy(F.col("evidence").desc(), "word").limit(MOST_TERMS).collect()
    exact = {row.word: (row.toxic + 1) / (row.toxic + row.clean + 2) for row in terms}
    return _with_near_misses(work, words, exact)


def _evidence(share: float) -> Column:
    """How surely a word goes with the label: the exponent of the chance that a word of no meaning looks so (Chernoff's bound). Copies
    of one document count once, since no more documents are believed than were seen by the 64-bit linear counter of contexts."""
    n = F.col("toxic") + F.col("clean")
    rate = F.col("toxic") / n
    clean = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    contexts = 64 * F.log(64 / F.greatest(64 - F.bit_count("contexts"), F.lit(1)))
    gain = F.when(rate > share, rate * F.log(rate / share) + clean).otherwise(0.0)
    return n * F.least(F.lit(1.0), contexts / F.greatest("toxic", F.lit(1))) * gain


def _label_share(docs: DataFrame, sample: DataFrame) -> float:
    """Smoothed share of label 1; a tenth where there are no labels."""
    n, toxic = docs.select("doc_id").join(sample, "doc_id").agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    return (toxic + 1) / (n + 10)


def _with_near_misses(work: Workspace, words: DataFrame, exact: dict[str, float]) -> Lexicon:
    """Words within the edits of a term: ordinary ones by themselves, the others summed up for each term and distance."""
    if not exact:
        return Lexicon()
    bare = Lexicon({term: (weight, 1.0, 1.0) for term, weight in exact.items()})

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(bare)
        for batch in batches:
            found = [(i, m) for i, w in enumerate(batch.column("word").to_pylist()) if (m := matcher.match(w)) and m.distance]
            kept = batch.select(["word", "toxic", "clean"]).take(pa.array([i for i, _ in found], pa.int64()))
            extra = [pa.array([m.term for _, m in found], pa.string()), pa.array([m.distance for _, m in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*kept.columns, *extra], ["word", "toxic", "clean", "term", "distance"])

    misses = work.table(words.mapInArrow(near, "word string, toxic long, clean long, term string, distance int"), "near-misses")
    # Seen more than once, and mostly in clean documents. Rarer ones that find no place count for their term instead.
    plain = misses.filter("clean > 1 and clean > toxic").select("word", "clean").orderBy(F.col("clean").desc(), "word").limit(MOST_ORDINARY)
    ordinary = frozenset(row.word for row in plain.collect())
    rest = misses.join(F.broadcast(plain.select("word")), "word", "left_anti").groupBy("term", "distance").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = {(row.term, row.distance): (row.toxic, row.toxic + row.clean) for row in rest.collect()}
    weights = {}
    for term, weight in exact.items():
        counts = [seen.get((term, distance), (0, 0)) for distance in (1, 2)]
        near_weights = [min(weight, (t + SEEN_BEFORE * prior) / (n + SEEN_BEFORE)) for (t, n), prior in zip(counts, NEAR_MISS)]
        weights[term] = (weight, *near_weights)
    return Lexicon(weights, ordinary, THRESHOLD)


# --- reading texts ----------------------------------------------------------------------------------

class Hit:
    __slots__ = ("start", "end", "word", "match", "quoted", "score")

    def __init__(self, start: int, end: int, word: str, match: Match) -> None:
        self.start, self.end, self.word, self.match, self.quoted, self.score = start, end, word, match, False, 0.0


def text_hits(text: str, matcher: Matcher) -> tuple[int, list[Hit]]:
    """Number of words, and the hits in order with their window's score."""
    words = [w.lower() for w in WORD.findall(text)]
    found = matcher.matches(set(words))
    if not found:
        return len(words), []
    places = [(i, w) for i, w in enumerate(words) if w in found]
    spans = [m.span() for m in WORD.finditer(text)]
    quotes = [m.span() for m in QUOTATION.finditer(text)]
    starts, at = [start for start, _ in quotes], [i for i, _ in places]
    hits = []
    for number, (i, word) in enumerate(places):
        hit = Hit(*spans[i], word, found[word])
        quote = bisect_right(starts, hit.start) - 1
        hit.quoted = quote >= 0 and hit.end <= quotes[quote][1]
        others = sum(1 for j in at[max(number - 2, 0) : number + 3] if j != i and abs(j - i) <= WINDOW)
        before, around = words[max(i - WINDOW, 0) : i], words[max(i - WINDOW, 0) : i + WINDOW + 1]
        bonus = NEIGHBOUR * min(others, MOST_NEIGHBOURS) + ADDRESSED * (not ADDRESS.isdisjoint(around))
        hit.score = hit.match.weight * (1 + bonus) * (1.0 if REPORTING.isdisjoint(before) else REPORTED)
        hits.append(hit)
    return len(words), hits


def features(text: str | None, matcher: Matcher) -> list[float]:
    """FEATURES of one text; all 0 without hits."""
    n, hits = text_hits(text or "", matcher)
    free = [h for h in hits if not h.quoted]
    exact, near = (sum(h.score for h in free if bool(h.match.distance) == fuzzy) for fuzzy in (False, True))
    quoted = sum(h.score for h in hits if h.quoted)
    terms = len({h.match.term for h in free})
    return [math.log1p(exact), math.log1p(near), math.log1p(quoted), max((h.score for h in free), default=0.0), min(100 * (exact + near) / max(n, 1), 20.0), math.log1p(terms)]


def found_hits(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """`docs(doc_id, text, ...)` -> one row for each hit: doc_id, start, stop (characters of the text), word, term, distance, weight, quoted, score."""
    names = ["doc_id", "start", "stop", "word", "term", "distance", "weight", "quoted", "score"]
    types = [None, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.bool_(), pa.float64()]
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for h in text_hits(text or "", matcher)[1]:
                    rows.append((i, h.start, h.end, h.word, h.match.term, h.match.distance, h.match.weight, h.quoted, h.score))
            columns = list(zip(*rows)) or [()] * len(names)
            ids = batch.column("doc_id").take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns[1:], types[1:])]], names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, stop long, word string, term string, distance int, weight double, quoted boolean, score double"
    return docs.select("doc_id", "text").mapInArrow(read, schema)


# --- scores -----------------------------------------------------------------------------------------

def fitted(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of the features and the constant: logistic loss by Newton steps, held near PRIOR."""
    share = (labels.sum() + 1) / (len(labels) + 10)
    prior = np.array([*PRIOR, math.log(share / (1 - share))])
    x = np.column_stack([rows, np.ones(len(rows))]) if len(rows) else np.empty((0, len(prior)))
    weights = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (labels - p) - PRIOR_ROWS * (weights - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_ROWS * np.eye(len(prior))
        step = np.linalg.solve(hessian, gradient)
        weights += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _scored(weights: np.ndarray):
    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
        margin = rows @ weights[:-1] + weights[-1]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))], ["doc_id", "score"])

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs(doc_id, text, ...)`, `labels(doc_id, toxic, ...)` -> one row for each row of `docs`: doc_id, held_out, score, predicted.

    Only labels whose fold, crc32 of doc_id modulo FOLDS, is not HELD_OUT are learnt from, at most LABELLED for the terms and FIT_ROWS
    for the model. A score sees the text only; null and empty texts have no hits and get the score of such. Null labels and ids are not
    learnt from, repeated rows count each, ties in the samples are broken by the values. Without labels no word is a term, and every score is
    0.1. Words of more than 34 letters are no terms nor near one. Extra columns are ignored, whatever their names; no rows give no rows.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    lexicon = docs.sparkSession.sparkContext.broadcast(learnt_lexicon(docs, labels))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon.value)
        for batch in batches:
            rows = np.array([features(text, matcher) for text in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in rows.T]], ["doc_id", *FEATURES])

    schema = f"doc_id {id_type}, " + ", ".join(f"{f} double" for f in FEATURES)
    measured = work.table(docs.select("doc_id", "text").mapInArrow(read, schema), "features")
    sample = _sampled(measured.join(_learnable(labels), "doc_id"), FIT_ROWS, *FEATURES, "toxic").toPandas()
    weights = fitted(sample[FEATURES].to_numpy(np.float64), sample["toxic"].to_numpy(np.float64))
    scored = map_batches(measured, _scored(weights), f"doc_id {id_type}, score double")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
