"""Language of a text: interpolated Kneser-Ney character models, one for each language of the training rows.

Characters are lower-cased letters, and a space for each run of anything else. All training texts are counted: 4-grams
are counted where the rows are and summed in Spark, and the continuation counts of the lower orders are groupings of
the table below. No gram is dropped, and the models stay tables. The grams that texts have get their costs in every language from them
once, and these are stored in sorted arrays, one for each range of the grams' hash. A batch of texts sends its
different grams to the ranges as one packed array each, they are found by binary search, and their costs come back packed. The
language with the lowest cross-entropy per character wins. How far a text may lie from the training rows of its language is
calibrated over all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm import words
from landfall.llm.frames import Workspace, fold, map_batches

ORDER = 4
FOLDS, HELD_OUT = 4, 2
SPACE, UNKNOWN = 32, "und"
# Characters that are looked at at once; longer texts are read in pieces of this length, each going on where the one before ends.
PIECE = 1 << 20
# Grams of one sorted array, about.
RANGE_GRAMS = 1 << 15
# A text is rejected if it lies further from its language than this many deviations beyond the training rows' mean.
REACH = 6.0
# Characters that count as independent evidence for the score.
EVIDENCE = 12


@cache
def _letters() -> np.ndarray:
    """Of each 16-bit code point: its lower-case letter, or a space."""
    out = np.full(1 << 16, SPACE, np.uint16)
    for code in range(1 << 16):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            out[code] = ord(lower) if len(lower) == 1 and ord(lower) < 1 << 16 else code
    return out


def _characters(text: str | None) -> Iterator[np.ndarray]:
    """Normalised characters of a text, PIECE of its own at a time, each with the ORDER - 1 before them, which are spaces at the start.
    Nothing if there is no letter. Letters above 16 bits are folded into 4,096 private codes."""
    before, after_letter = np.full(ORDER - 1, SPACE, np.uint16), False
    for at in range(0, len(text or ""), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        out = _letters()[np.minimum(codes, 0xFFFF)]
        for code in np.unique(codes[codes > 0xFFFF]):
            out[codes == code] = 0xE000 | int(code) & 0xFFF if chr(code).isalpha() else SPACE
        letter = out != SPACE
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter = bool(letter[-1])
        if keep.any():
            part = np.concatenate((before, out[keep]))
            before = part[1 - ORDER :]
            yield part


def _grams(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all ORDER-grams that end in a part, 16 bits a character, and how many each part has."""
    every = np.concatenate(parts).astype(np.uint64)
    codes = every.copy()
    for back in range(1, ORDER):
        codes[back:] |= every[:-back] << np.uint64(16 * back)
    lengths = np.array([len(p) for p in parts])
    ends = np.ones(len(every), bool)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    for back in range(ORDER - 1):
        ends[starts + back] = False
    return codes[ends], lengths - (ORDER - 1)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts' numbers and characters, about PIECE characters at a time."""
    owners, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for part in _characters(text):
            owners.append(i)
            parts.append(part)
            held += len(part)
            if held >= PIECE:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
    out: tuple[list, list, list] = ([], [], [])
    for lang in sorted(set(langs)):
        for _, parts in _pieces([t for t, own in zip(texts, langs) if own == lang]):
            numbers, grams = pd.factorize(_grams(parts)[0])
            out[0].extend([lang] * len(grams))
            out[1].append(words.signed(grams))
            out[2].append(np.bincount(numbers, minlength=len(grams)))
    grams, counts = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out[1:])
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])


def _order_tables(work: Workspace, training: DataFrame) -> list[DataFrame]:
    """For orders 1 to ORDER: (lang, gram, n), raw counts at the top and numbers of different characters before a gram below."""
    counted = map_batches(training, _counted, "lang string, gram long, n long")
    tables = [work.table(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), f"grams-{ORDER}")]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
        shorter = tables[0].select("lang", suffix).groupBy("lang", "gram").agg(F.count("*").alias("n"))
        tables.insert(0, work.table(shorter, f"grams-{order}"))
    return tables


def _suffix(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit((1 << 16 * order) - 1))


class Models:
    """The models of all languages, as tables. For each order: of a gram its discounted share of its context, and of a context
    the weight of the order below, by the language's number."""

    def __init__(self, work: Workspace, langs: list[str]) -> None:
        self.work, self.langs, self.orders, self.floor = work, langs, [], 1.0 / (1 << 16)

    def probabilities(self, wanted: DataFrame, name: str, order: int = ORDER) -> DataFrame:
        """`wanted(gram)`, each once -> `(gram, p)`: of its last character after the ones before it, in each language."""
        lower = None
        for at in range(1, order + 1):
            shares, weights = self.orders[at - 1]
            rows = wanted.select(_suffix(F.col("gram"), at).alias("gram")).distinct() if at < order else wanted.select("gram")
            rows = rows.join(shares, "gram", "left").withColumn("context", F.shiftrightunsigned("gram", 16)).join(weights, "context", "left")
            if lower is None:
                below = lambda i: F.lit(self.floor)
            else:
                rows = rows.withColumn("shorter", _suffix(F.col("gram"), at - 1)).join(lower, "shorter")
                below = lambda i: F.col("below")[i]
            numbers = F.array(*[F.lit(i) for i in range(len(self.langs))])
            p = F.transform(numbers, lambda i: F.coalesce(F.try_element_at("shares", i), F.lit(0.0)) + F.coalesce(F.try_element_at("weights", i), F.lit(1.0)) * below(i))
            found = self.work.table(rows.select("gram", p.alias("p")), f"{name}-{at}")
            lower = found.select(F.col("gram").alias("shorter"), F.col("p").alias("below"))
        return found

    def __getitem__(self, lang: str) -> _Language:
        return _Language(self, self.langs.index(lang))


class _Language:
    """One language of the models, asked for single grams."""

    def __init__(self, models: Models, number: int) -> None:
        self.models, self.number = models, number

    def probability(self, order: int, codes: np.ndarray) -> np.ndarray:
        own = words.signed(np.asarray(codes, np.uint64)).tolist()
        wanted = self.models.work.spark.createDataFrame([(c,) for c in sorted(set(own))], "gram long")
        found = {r.gram: r.p[self.number] for r in self.models.probabilities(wanted, f"asked-{uuid.uuid4().hex}", order).collect()}
        return np.array([found[c] for c in own])


def _fit(work: Workspace, tables: list[DataFrame]) -> Models:
    """The models. What comes to the driver are the languages and a discount for each of them and order."""
    discounts = []
    for table in tables:
        ones, twos = (F.count_if(F.col("n") == i) for i in (1, 2))
        found = table.groupBy("lang").agg(ones.alias("ones"), twos.alias("twos")).collect()
        discounts.append({r.lang: r.ones / (r.ones + 2 * r.twos) if r.ones and r.twos else 0.5 for r in found})
    models = Models(work, sorted(discounts[0]))
    for order, (table, discount) in enumerate(zip(tables, discounts), 1):
        facts = [(lang, number, float(discount[lang])) for number, lang in enumerate(models.langs)]
        facts = F.broadcast(work.spark.createDataFrame(facts, "lang string, number int, discount double"))
        own = table.withColumn("context", F.shiftrightunsigned("gram", 16)).join(facts, "lang")
        contexts = own.groupBy("number", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types"), F.first("discount").alias("discount"))
        contexts = work.table(contexts, f"contexts-{order}")
        share = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        weight = F.col("discount") * F.col("types") / F.col("total")

        def by_number(key: str, value: Column, name: str) -> list[Column]:
            return [F.col(key), F.struct("number", value.alias("value")).alias(name)]

        shares = own.join(contexts.select("number", "context", "total"), ["number", "context"]).select(*by_number("gram", share, "shares"))
        weights = contexts.select(*by_number("context", weight, "weights"))
        grouped = [rows.groupBy(key).agg(F.map_from_entries(F.collect_list(name)).alias(name)) for rows, key, name in ((shares, "gram", "shares"), (weights, "context", "weights"))]
        models.orders.append(tuple(work.table(rows, f"{name}-{order}") for rows, name in zip(grouped, ("shares", "weights"))))
    return models


def _chunked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row for a batch: its rows, their characters, and its different grams."""
    owners, parts, grams = [], [], np.empty(0, np.uint64)
    for numbers, some in _pieces(batch.column("text").to_pylist()):
        grams = np.union1d(grams, _grams(some)[0])
        owners += numbers
        parts += some
    letters, packed = _packed(np.concatenate(parts) if parts else np.empty(0, np.uint16))

    def whole(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    lists = [batch.column(c) for c in ("doc_id", "train", "lang")] + [pa.array(x, pa.int64()) for x in (owners, [len(p) for p in parts])] + [pa.array(words.signed(grams)), pa.array(letters.astype(np.int32))]
    columns = [pa.array([uuid.uuid4().int >> 65]), *map(whole, lists), pa.array([packed], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["chunk", "doc_id", "train", "lang", "owners", "sizes", "grams", "letters", "characters"])


def _packed(every: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The different characters, and the places of all among them, compressed; a byte each where they are few."""
    letters = np.flatnonzero(np.bincount(every, minlength=1 << 16)).astype(np.uint16)
    place = np.zeros(1 << 16, np.uint8 if len(letters) <= 256 else np.uint16)
    place[letters] = np.arange(len(letters))
    return letters, pa.Codec("zstd", compression_level=3).compress(place[every].tobytes(), asbytes=True)


def _unpacked(letters: np.ndarray, packed: bytes, size: int) -> np.ndarray:
    kind = np.dtype(np.uint8 if len(letters) <= 256 else np.uint16)
    return letters.astype(np.uint16)[np.frombuffer(pa.decompress(packed, kind.itemsize * size, "zstd", asbytes=True), kind)] if size else np.empty(0, np.uint16)


def _parts(owners: np.ndarray, sizes: np.ndarray, every: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """What _pieces gave, from a chunk: about PIECE characters at a time."""
    ends = np.cumsum(sizes)
    turns = ends // PIECE
    for turn in np.unique(turns):
        at = np.flatnonzero(turns == turn)
        yield owners[at], [every[ends[i] - sizes[i] : ends[i]] for i in at]


def _range_of(grams: np.ndarray, ranges: int) -> np.ndarray:
    return (words.mix(grams) >> np.uint64(33)) % np.uint64(ranges)


_ENTRY, _QUERY = "range long, is_query boolean, chunk long, grams binary, costs binary", ["range", "is_query", "chunk", "grams", "costs"]


def _entries(ranges: int):
    """Grams and their costs in bits, by ranges of the hash."""

    def entries(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams = batch.column("gram").to_numpy().view(np.uint64)
        bits = -np.log2(batch.column("p").flatten().to_numpy().reshape(len(grams), -1)).astype("<f4")
        own = _range_of(grams, ranges)
        order = np.lexsort((grams, own))
        grams, bits, own = grams[order], bits[order], own[order]
        numbers, first = np.unique(own, return_index=True)
        cuts = [*first.tolist(), len(own)]
        packed = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (grams, bits)]
        n = len(numbers)
        columns = [pa.array(numbers.astype(np.int64)), pa.array([False] * n), pa.nulls(n, pa.int64()), *[pa.array(x, pa.binary()) for x in packed]]
        return pa.RecordBatch.from_arrays(columns, _QUERY)

    return entries


def _queries(ranges: int):
    """The different grams of chunks, as one array for each range."""

    def queries(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], []]
        for chunk, grams in zip(batch.column("chunk").to_pylist(), batch.column("grams")):
            grams = grams.values.to_numpy().view(np.uint64)
            own = _range_of(grams, ranges)
            for number in np.unique(own).tolist():
                for column, value in zip(out, (number, chunk, grams[own == number].tobytes())):
                    column.append(value)
        n = len(out[0])
        columns = [pa.array(out[0], pa.int64()), pa.array([True] * n, pa.bool_()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, _QUERY)

    return queries


def _look_up(languages: int):
    """Ranges come one after the other, each with its parts of the sorted array before the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, keys, bits = None, [], None, None
        for batch in batches:
            out = [[], [], []]
            for number, is_query, chunk, grams, costs in zip(*(batch.column(c).to_pylist() for c in _QUERY)):
                if number != now:
                    now, parts, keys = number, [], None
                if not is_query:
                    parts.append((np.frombuffer(grams, np.uint64), np.frombuffer(costs, "<f4").reshape(-1, languages)))
                    continue
                if keys is None:
                    keys, bits = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(keys)
                    keys, bits = keys[order], bits[order]
                found = bits[np.searchsorted(keys, np.frombuffer(grams, np.uint64))]
                for column, value in zip(out, (chunk, number, found.tobytes())):
                    column.append(value)
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "range", "costs"])

    return run


def _costs(work: Workspace, models: Models, chunks: DataFrame) -> tuple[DataFrame, int]:
    """`(chunk, costs)`: for each range, the costs in every language of the chunk's grams in it; and the number of ranges."""
    wanted = work.table(chunks.select(F.explode("grams").alias("gram")).distinct(), "wanted")
    priced = models.probabilities(wanted, "wanted")
    ranges = max(1, -(-wanted.count() // RANGE_GRAMS))
    rows = map_batches(priced, _entries(ranges), _ENTRY).unionByName(map_batches(chunks.select("chunk", "grams"), _queries(ranges), _ENTRY))
    ordered = rows.repartition("range").sortWithinPartitions("range", "is_query")
    found = ordered.mapInArrow(_look_up(len(models.langs)), "chunk long, range long, costs binary")
    return found.groupBy("chunk").agg(F.collect_list(F.struct("range", "costs")).alias("costs")), ranges


def _scored(names: list[str], ranges: int):
    def score_chunk(chunk: dict) -> list[pa.Array]:
        owners, sizes = (chunk[c].values.to_numpy(zero_copy_only=False) for c in ("owners", "sizes"))
        every = _unpacked(chunk["letters"].values.to_numpy(), chunk["characters"].as_py(), int(sizes.sum()) if len(sizes) else 0)
        n = len(chunk["doc_id"].values)
        sums, lengths = np.zeros((len(names), n)), np.zeros(n, np.int64)
        keys = chunk["grams"].values.to_numpy().view(np.uint64)
        bits = np.empty((len(names), len(keys)))
        if names and chunk["costs"].is_valid:
            own = _range_of(keys, ranges)
            for found in chunk["costs"].as_py():
                bits[:, own == found["range"]] = np.frombuffer(found["costs"], "<f4").reshape(-1, len(names)).T
        for own, parts in _parts(owners, sizes, every):
            codes, counts = _grams(parts)
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            np.add.at(lengths, own, counts)
            if names:
                at = np.searchsorted(keys, codes)
                for i in range(len(names)):
                    np.add.at(sums[i], own, np.add.reduceat(bits[i][at], starts))
        known = lengths > 0
        lang, entropy, score = [UNKNOWN] * n, np.full(n, np.nan), np.zeros(n)
        if names and known.any():
            each = sums[:, known] / lengths[known]
            best = each.argmin(axis=0)
            entropy[known] = each.min(axis=0)
            apart = (each - each.min(axis=0)) * np.minimum(lengths[known], EVIDENCE)
            score[known] = 1 / np.exp2(-apart).sum(axis=0)
            for at, b in zip(np.flatnonzero(known), best):
                lang[at] = names[b]
        return [*[chunk[c].values for c in ("doc_id", "train", "lang")], pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(lengths)]

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunks = [score_chunk({c: batch.column(c)[i] for c in batch.schema.names}) for i in range(batch.num_rows)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*chunks)], ["doc_id", "train", "lang", "lang_pred", "score", "cross_entropy", "n_letters"])

    return score


def language_id(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text, lang, ...)` -> one row for each row: doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    Models learn from rows that have a lang and whose fold, crc32 of doc_id modulo FOLDS, is not HELD_OUT; a prediction sees
    the text only. Null, empty and letterless texts, and all texts if there is nothing to learn from, get UNKNOWN, a
    score of 0 and rejected true. Otherwise the nearest language is named, with the share of the evidence that speaks for it;
    rejected says that the text is further from it than its training rows allow, and halves the score. Equal
    cross-entropies give the first language by name. Repeated rows are judged each, extra columns are ignored.
    """
    work = Workspace(docs.sparkSession, "language-id")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), (~held_out & F.col("lang").isNotNull()).alias("train"))
    models = _fit(work, _order_tables(work, rows.filter("train and text is not null").select("text", "lang")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = f"doc_id array<{id_type}>, train array<boolean>, lang array<string>, owners array<long>, sizes array<long>, grams array<long>, letters array<int>"
    chunks = work.table(map_batches(rows, _chunked, f"chunk long, {lists}, characters binary"), "chunks")
    ranges = 1
    if models.langs:
        costs, ranges = _costs(work, models, chunks)
        chunks = chunks.join(costs, "chunk", "left")
    else:
        chunks = chunks.withColumn("costs", F.lit(None).cast("array<struct<range:bigint,costs:binary>>"))
    schema = f"doc_id {id_type}, train boolean, lang string, lang_pred string, score double, cross_entropy double, n_letters long"
    scored = work.table(map_batches(chunks, _scored(models.langs, ranges), schema), "scored")
    return _calibrated(work, scored).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def _calibrated(work: Workspace, scored: DataFrame) -> DataFrame:
    """Distances from the mean of a language's training rows, in deviations for the text's length, and their usual range."""
    own = scored.filter("train and n_letters > 0 and lang = lang_pred")
    centre = own.groupBy("lang_pred").agg((F.sum(F.col("cross_entropy") * F.col("n_letters")) / F.sum("n_letters")).alias("centre"))
    centre = work.table(centre, "centres")
    distance = (F.col("cross_entropy") - F.col("centre")) * F.sqrt("n_letters")
    spread = own.join(centre, "lang_pred").groupBy("lang_pred").agg(F.avg(distance).alias("mean"), F.coalesce(F.stddev_pop(distance), F.lit(0.0)).alias("deviation"))
    limits = work.table(centre.join(spread, "lang_pred").select(F.col("lang_pred").alias("_lang"), "centre", "mean", "deviation"), "limits")
    joined = scored.join(limits, F.col("lang_pred") == F.col("_lang"), "left")
    far = F.coalesce(distance > F.col("mean") + F.lit(REACH) * F.col("deviation") + F.lit(1e-6), F.lit(False))
    rejected = (F.col("n_letters") == 0) | (F.col("lang_pred") == UNKNOWN) | far
    return joined.withColumn("rejected", rejected).withColumn("score", F.when(rejected, F.col("score") / 2).otherwise(F.col("score")))
