"""Passages that repeat across documents: MinHash banding of paragraphs, exact Jaccard, removals by components.

Passages are pasted anywhere in a line, so paragraphs are cut by their content: a word starts a paragraph if its hash
is the smallest within some words on either side. The cuts inside a passage are the same wherever it stands. Two lengths are cut:

* Short ones, REACH words on either side, so that a passage of 50 words holds whole ones wherever it stands. They repeat if they are
  equal, and are extended word by word as far as the first equal one has the same words around it.
* Long ones, of many short ones, in which a changed word leaves most shingles as they are. All are banded by MinHash; those that
  share a band are compared on their full sets, and the components of their links are near copies: short paragraphs in them repeat,
  though changed.

Texts are read twice, and nothing is kept of paragraphs that do not repeat: the first reading counts short paragraphs and the bands of long
ones, and bitmaps of fixed size tell the second one which of them may have a partner.

Runs of enough words are reported.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm import similar, words
from landfall.llm.components import connected_components
from landfall.llm.frames import Workspace, among, map_batches, text_bytes, unused, with_text_hash
from landfall.operators import probe

REACH, LONG_REACH = 5, 24
# Long paragraphs that are signed at once: their shingles stay in a core's cache.
SIGNED_AT_ONCE = 1024
# Keys are counted in ranges, 2 to the power of this, each of which a task holds at a time.
RANGE_BITS = 10
_PACK = ["range", "keys", "others"]
# Words around a paragraph that are compared at first; those that agree in all of them are compared again in more.
EDGE, EDGE_GROWTH = 16, 32
SHINGLE, PERCENT, RECALL = 5, 80, 0.9999
# A run may have one paragraph in it that does not repeat; one of fewer words is not reported.
RUN_WORDS, RUN_GAP = 20, 2
# Words in a hundred of a changed paragraph that it must have in common with the first copy.
COMMON = 50
# Chance that two unrelated paragraphs agree in one minimum.
BACKGROUND = 1e-5
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tuned_bands(percent: int = PERCENT, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows), two rows at least: the cheapest that find a pair at `percent` with `recall`. A band costs one row for each paragraph; a
    paragraph that meets an unrelated one by chance costs a thousand."""
    best = None
    for rows in range(2, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))
        cost = bands + 1000 * (1 - (1 - BACKGROUND**rows) ** bands)
        best = min(best or (math.inf, 0, 0), (cost, bands, rows))
    return best[1:]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` values in a row."""
    size, least, out = 1, values, len(values) - width + 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    return np.minimum(least[:out], least[width - size : width - size + out])


def paragraph_starts(hashes: np.ndarray, reach: int = REACH, firsts: np.ndarray | None = None) -> np.ndarray:
    """First words of the paragraphs of one text, or of texts one after the other that begin at `firsts`; the first of equal hashes counts as
    the smallest. A cut has `reach` words before it."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    firsts = np.zeros(1, np.int64) if firsts is None else firsts
    gaps = reach * np.arange(len(firsts))
    mixed = np.full(n + reach * len(firsts), np.uint64(2**64 - 1))
    mixed[np.arange(n) + np.repeat(gaps, np.diff(firsts, append=n))] = words.mix(hashes + np.uint64(77))
    if len(mixed) <= 2 * reach:
        return firsts
    low, own = _least(mixed, reach), mixed[reach:-reach]
    at = reach + np.flatnonzero((own < low[: len(own)]) & (own <= low[reach + 1 :]))
    text = np.searchsorted(firsts + gaps, at, "right") - 1
    at -= gaps[text]
    return np.sort(np.concatenate((firsts, at[at - firsts[text] > reach])))


class _Cuts:
    """Words of many texts one after the other, and their paragraphs as ranges of them."""

    def __init__(self, texts: list[bytes | None]) -> None:
        each = [words.word_hashes(text) for text in texts]
        lengths = np.array([len(own) for own in each])
        self.hashes = np.concatenate(each)
        self.texts = np.flatnonzero(lengths)
        self.firsts = (np.cumsum(lengths) - lengths)[self.texts]
        self.raw = self.hashes.tobytes()

    def ranges(self, reach: int) -> tuple[np.ndarray, np.ndarray]:
        starts = paragraph_starts(self.hashes, reach, self.firsts)
        return starts, np.append(starts[1:], len(self.hashes))[: len(starts)]

    def owner(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the texts holds each paragraph, and the text's first word."""
        at = np.searchsorted(self.firsts, starts, "right") - 1
        return self.texts[at], self.firsts[at]

    def late(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which paragraphs end at a cut that has fewer than REACH words after it. In another text these may go on and take the cut away."""
        past = np.append(self.firsts[1:], len(self.hashes))[np.searchsorted(self.firsts, starts, "right") - 1]
        return np.flatnonzero((ends < past) & (past - ends <= REACH))

    def keys(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the words of ranges, as signed longs."""
        raw, digest = self.raw, xxhash.xxh3_64_intdigest
        return words.signed(np.fromiter((digest(raw[a:b]) for a, b in zip((8 * starts).tolist(), (8 * ends).tolist())), np.uint64, len(starts)))

    def long(self, signer: _Bands, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Long paragraphs of a shingle at least, and their band keys; of shorter texts only equal ones are alike."""
        starts, ends = self.ranges(LONG_REACH)
        wide = ends - starts >= shingle
        starts, ends, keys = starts[wide], ends[wide], [np.empty((0, signer.shape[0]), np.int64)]
        for at in range(0, len(starts), SIGNED_AT_ONCE):
            a, b = starts[at : at + SIGNED_AT_ONCE], ends[at : at + SIGNED_AT_ONCE]
            codes = words.shingles(self.hashes[a[0] : b[-1]], shingle)
            keys.append(signer.of_ranges(codes, a - a[0], b - a[0] - shingle + 1))
        return starts, ends, np.concatenate(keys)


def _set_of(hashes: np.ndarray, shingle: int) -> np.ndarray:
    return np.unique(words.shingles(hashes, shingle))


class _Bands:
    def __init__(self, bands: int, rows: int) -> None:
        self.shape = (bands, rows)
        self.factors = words.mix(np.arange(31, 31 + bands * rows, dtype=np.uint64)) | np.uint64(1)

    def of_ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(set, band) keys of the values in ranges, none of them empty, one hash function at a time."""
        values, at = np.append(values, np.uint64(0)), np.stack((starts, ends), axis=1).ravel()
        minima = np.stack([np.minimum.reduceat(words.mix(values * f), at)[::2] for f in self.factors], axis=1)
        bands, rows = self.shape
        return words.signed(words.mix(minima.reshape(-1, bands, rows).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)))

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        ends = np.cumsum([len(s) for s in sets])
        return self.of_ranges(np.concatenate(sets), np.concatenate(([0], ends[:-1])), ends)


def _packed(kind: int, keys: np.ndarray, values: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """Keys with their smallest and largest value, in packs by ranges of the keys."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    ends = first | np.append(first[1:], True)[: len(keys)]
    keys, values = keys[ends], values[ends]
    number = (keys.view(np.uint64) >> np.uint64(64 - RANGE_BITS)).astype(np.int64)
    # As signed numbers, keys from the middle on come first.
    cuts = np.flatnonzero(np.append(True, number[1:] != number[:-1])[: len(number)]).tolist()
    ranges = zip(cuts, [*cuts[1:], len(keys)])
    return [(kind << RANGE_BITS | int(number[a]), keys[a:b].tobytes(), values[a:b].tobytes()) for a, b in ranges]


def _counted(shingle: int, bands: int, rows: int):
    """Packs of what is counted of texts: short paragraphs with the document, and bands of long ones with the paragraph's own key."""
    signer = _Bands(bands, rows)

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts = _Cuts(text_bytes(batch))
        starts, ends = cuts.ranges(REACH)
        late = cuts.late(starts, ends)
        starts, ends = np.append(starts, starts[late]), np.append(ends, ends[late + 1])
        owner, _ = cuts.owner(starts)
        known = np.array(batch.column("doc_id").is_valid())[owner]
        documents = np.array(batch.column("doc_hash"))[owner][known]
        long_starts, long_ends, buckets = cuts.long(signer, shingle)
        packs = _packed(0, cuts.keys(starts[known], ends[known]), documents)
        packs += _packed(1, buckets.ravel(), np.repeat(cuts.keys(long_starts, long_ends), bands))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in packs], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], _PACK)

    return counted


def _shared(batches):
    """Of packs in the order of their ranges, the keys with two different values: of short paragraphs the key, of bands the smallest value too."""
    now, held = None, []

    def found():
        keys, values = (np.concatenate([np.frombuffer(x[i], np.int64) for x in held]) for i in (0, 1))
        order = np.lexsort((values, keys))
        keys, values = keys[order], values[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        several = values[first] != values[np.append(first[1:], len(keys)) - 1]
        heads = pa.array(values[first][several], mask=np.full(int(several.sum()), now >> RANGE_BITS == 0))
        return pa.RecordBatch.from_arrays([pa.array(keys[first][several]), heads], ["node", "head"])

    for batch in batches:
        for number, *pack in zip(*(batch.column(c).to_pylist() for c in _PACK)):
            if number != now and held:
                yield found()
                held.clear()
            now = number
            held.append(pack)
    if held:
        yield found()


def _broadcast_bits(maps: DataFrame):
    """A bitmap as one array of fixed size, for tasks."""
    bits = np.zeros(probe.BITS // 8, np.uint8)
    for row in maps.collect():
        own = np.frombuffer(row.bits, np.uint8)
        bits[row.number * probe.MAP_BITS // 8 :][: len(own)] = own
    return maps.sparkSession.sparkContext.broadcast(bits)


def _are_set(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    place = np.mod(hashed, probe.BITS)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


_PIECE = ["doc_id", "text_hash", "paragraph", "first_word", "n_words", "node", "n_text", "late", "starts", "hashes", "bands"]


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values, pa.int64()))


def _pieces(bits, band_bits, shingle: int, bands: int, rows: int):
    """Short paragraphs that may repeat, and long ones that may share a band: with their short ones' places, words and those bands."""
    signer = _Bands(bands, rows)

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts = _Cuts(text_bytes(batch))
        short, short_ends = cuts.ranges(REACH)
        nodes = cuts.keys(short, short_ends)
        late = cuts.late(short, short_ends)
        late_nodes = cuts.keys(short[late], short_ends[late + 1])
        may, late_may = _are_set(bits.value, nodes), _are_set(bits.value, late_nodes)
        late, late_nodes = late[late_may], late_nodes[late_may]
        starts, ends, buckets = cuts.long(signer, shingle)
        shared = _are_set(band_bits.value, buckets)
        held = shared.any(axis=1)
        starts, ends, buckets, shared = starts[held], ends[held], buckets[held], shared[held]
        low, past = np.searchsorted(short, starts), np.searchsorted(short, ends)
        inside = np.repeat(low - np.concatenate(([0], np.cumsum(past - low)[:-1])), past - low) + np.arange((past - low).sum()) if len(low) else low
        firsts = np.concatenate((short[may], short[late], starts))
        owner, text = cuts.owner(firsts)
        numbers = np.searchsorted(short, firsts) - np.searchsorted(short, text)
        columns = [numbers, firsts - text, np.concatenate((short_ends[may], short_ends[late + 1], ends)) - firsts]
        columns.append(np.concatenate((nodes[may], late_nodes, cuts.keys(starts, ends))))
        none = int(may.sum()) + len(late)
        empty = np.zeros(none, np.int64)
        places = _lists(short[inside] - np.repeat(text[none:], past - low), np.concatenate((empty, past - low)))
        hashes = pa.array([None] * none + [cuts.raw[8 * a : 8 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())
        lists = _lists(buckets[shared], np.concatenate((empty, shared.sum(axis=1))))
        columns.append(np.append(cuts.firsts[1:], len(cuts.hashes))[np.searchsorted(cuts.firsts, text)] - text)
        at, is_late = pa.array(owner), np.zeros(len(owner), bool)
        is_late[none - len(late) : none] = True
        own = [*[pa.array(c, pa.int64()) for c in columns], pa.array(is_late), places, hashes, lists]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_hash").take(at), *own], _PIECE)

    return pieces


def _sets(shingle: int):
    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [_set_of(np.frombuffer(x, np.uint64), shingle).tobytes() for x in batch.column("hashes").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(own, pa.binary())], ["node", "shingles"])

    return sets


def _edges(reach: int):
    def edges(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, sides = [], ([], [])
        for text, spots in zip(text_bytes(batch), batch.column("spots").to_pylist()):
            hashes = words.word_hashes(text)
            for s in spots:
                first, end = s["first_word"], s["first_word"] + s["n_words"]
                keys.append(s["spot"])
                sides[0].append(hashes[max(0, first - reach) : first][::-1] if s["left"] else hashes[:0])
                sides[1].append(hashes[end : end + reach] if s["right"] else hashes[:0])
        lists = [_lists(words.signed(np.concatenate(side)) if side else np.empty(0, np.int64), np.array([len(x) for x in side])) for side in sides]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *lists], ["spot", "left", "right"])

    return edges


def _agreeing(side: str) -> Column:
    """Words at the start of `own_` and `first_` lists that are the same."""
    differs = f"array_position(zip_with(own_{side}, first_{side}, (x, y) -> not (x <=> y)), true)"
    return F.expr(f"if({differs} = 0, size(own_{side}), {differs} - 1)").cast("long").alias(side)


def _shared_edges(work: Workspace, plain: DataFrame, pairs: DataFrame, copied: DataFrame) -> DataFrame:
    """`pairs(spot, doc_id, text_hash, first_word, n_words, first, left, right)` -> `(spot, left, right)`: words before and after a paragraph
    that the first of its component has there too, on the sides that are asked for; for the first, the most that another one shares with
    it. `copied(spot, first_spot, left, right)` are known, since their texts are the same. A match of all words that were looked at is looked at again in more of them."""
    place, known, reach, turn = ["doc_id", "text_hash", "first_word", "n_words", "spot"], [copied], EDGE, 0
    asked = [F.max(c).alias(c) for c in ("left", "right")]
    while True:
        spots = pairs.select(*place, "left", "right").unionByName(pairs.select(*[f"first.{c}" for c in place], "left", "right"))
        spots = spots.groupBy(*place).agg(*asked)
        spots = spots.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first_word", "n_words", "spot", "left", "right")).alias("spots"))
        readers = among(plain, work.table(spots, f"spots-{turn}"), "inner").select("text", "spots")
        edges = work.table(map_batches(readers, _edges(reach), "spot long, left array<long>, right array<long>"), f"edges-{turn}")
        edges = edges.groupBy("spot").agg(F.first("left").alias("left"), F.first("right").alias("right"))
        own = edges.select("spot", F.col("left").alias("own_left"), F.col("right").alias("own_right"))
        first = edges.select(F.col("spot").alias("first_spot"), F.col("left").alias("first_left"), F.col("right").alias("first_right"))
        joined = pairs.select("spot", F.col("first.spot").alias("first_spot")).join(own, "spot").join(first, "first_spot")
        lengths = work.table(joined.select("spot", "first_spot", _agreeing("left"), _agreeing("right")), f"shared-{turn}")
        known.append(lengths)
        longer = lengths.filter(f"left >= {reach} or right >= {reach}")
        if longer.isEmpty():
            break
        longer = longer.select("spot", *[(F.col(c) >= reach).alias(c) for c in ("left", "right")])
        pairs, reach, turn = work.table(pairs.drop("left", "right").join(longer, "spot"), f"longer-{turn}"), reach * EDGE_GROWTH, turn + 1
    every = reduce(DataFrame.unionByName, known)
    of_first = every.select(F.col("first_spot").alias("spot"), "left", "right")
    return work.table(every.select("spot", "left", "right").unionByName(of_first).groupBy("spot").agg(*asked), "shared")


def _extended(work: Workspace, plain: DataFrame, found: DataFrame) -> DataFrame:
    """`found`, one row for each paragraph of a text, with removed, and first_word and n_words carried on to where the
    words end that repeat. Words that lie in another paragraph of `found` stay with it.

    Where the paragraph before has its first one just before this one's first, what the two share before it is what this
    one shares, so only the ends of such sequences are compared."""
    by_doc = Window.partitionBy("doc_id", "text_hash").orderBy("paragraph")
    end = F.col("first_word") + F.col("n_words")
    place = ["doc_id", "paragraph", "text_hash", "first_word", "n_words", "spot"]
    found = found.withColumn("spot", F.xxhash64("doc_id", "text_hash", "first_word", "n_words"))
    first = found.groupBy("node").agg(F.min(F.struct(*place)).alias("first"), F.min("doc_id").alias("component_id"), F.max("doc_id").alias("last"))
    first = first.filter("component_id <> last").drop("last")
    removed = F.struct("doc_id", "paragraph") != F.struct("first.doc_id", "first.paragraph")
    found = found.join(first, "node").withColumn("removed", removed)
    # A paragraph that repeats as it is goes before the one that it makes with the rest of its text.
    found = found.withColumn("plain", ~F.min("late").over(by_doc.rangeBetween(0, 0))).filter("not (late and plain)").drop("late", "plain")
    beside = F.struct("first.doc_id", "first.text_hash", (F.col("first.first_word") - F.col("first_word")).alias("shift"))
    before = F.coalesce((F.lag(end).over(by_doc) == F.col("first_word")) & F.lag(beside).over(by_doc).eqNullSafe(beside), F.lit(False))
    after = F.coalesce((F.lead("first_word").over(by_doc) == end) & F.lead(beside).over(by_doc).eqNullSafe(beside), F.lit(False))
    found = found.withColumns({"asked_left": ~before & (F.col("first_word") > 0), "asked_right": ~after})
    found = work.table(found, "marked")
    pairs = found.filter("spot <> first.spot and (asked_left or asked_right)")
    whole = F.coalesce((F.col("text_hash") == F.col("first.text_hash")) & (F.col("first_word") == F.col("first.first_word")), F.lit(False))
    copied = pairs.filter(whole).select("spot", F.col("first.spot").alias("first_spot"), F.col("first_word").alias("left"), (F.col("n_text") - end).alias("right"))
    pairs = pairs.filter(~whole).select("spot", "doc_id", "text_hash", "first_word", "n_words", "first", F.col("asked_left").alias("left"), F.col("asked_right").alias("right"))
    shared = _shared_edges(work, plain, pairs, copied)
    found = found.join(shared, "spot", "left")
    low, high = F.col("first_word") - F.coalesce("left", F.lit(0)), end + F.coalesce("right", F.lit(0))
    low = F.min(low).over(by_doc.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    high = F.max(high).over(by_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = found.withColumn("high", F.least(F.greatest(high, end), F.coalesce(F.lead("first_word").over(by_doc), high)))
    found = found.withColumn("low", F.greatest(low, F.coalesce(F.lag("high").over(by_doc), F.lit(0))))
    return found.withColumn("first_word", F.col("low")).withColumn("n_words", F.col("high") - F.col("low"))


def _bigrams(hashes: np.ndarray) -> np.ndarray:
    return words.mix(words.mix(hashes[:-1]) + hashes[1:])


def _kept_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The short paragraphs of a long one of which COMMON words in a hundred stand in pairs that its first copy has too, from the
    first such word to the last."""
    out = [[] for _ in range(4)]
    for i, (own, other, first, starts, paragraph) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("hashes", "other", "first_word", "starts", "paragraph")))):
        mine = np.frombuffer(own, np.uint64)
        paired = np.isin(_bigrams(mine), _bigrams(np.frombuffer(other, np.uint64)))
        covered = np.zeros(len(mine), bool)
        covered[:-1] |= paired
        covered[1:] |= paired
        for number, (low, high) in enumerate(zip(starts, [*starts[1:], first + len(mine)])):
            common = low + np.flatnonzero(covered[low - first : high - first])
            if len(common) and 100 * len(common) >= COMMON * (high - low):
                for column, value in zip(out, (i, paragraph + number, common[0], common[-1] + 1 - common[0])):
                    column.append(value)
    at = pa.array(out[0], pa.int64())
    names = ["near", "component_id", "doc_id", "text_hash"]
    same = [batch.column(c).take(at) for c in names]
    return pa.RecordBatch.from_arrays([*same, *[pa.array(x, pa.int64()) for x in out[1:]]], [*names, "paragraph", "first_word", "n_words"])


def _near_copies(work: Workspace, long: DataFrame, heads: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Short paragraphs, changed or not, of long ones that are near copies of one in another document, but for each component's first:
    doc_id, text_hash, paragraph, first_word, n_words, component (near), component_id, copies."""
    edges = similar.star_edges(work, long.select("node", "bands"), heads)
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    held = work.table(_with_partner(long.drop("bands"), nodes, "node"), "long-places")
    one = held.groupBy("node").agg(F.min("hashes").alias("hashes"))
    sets = work.table(map_batches(one, _sets(shingle), "node long, shingles binary"), "long-sets")
    linked = connected_components(work, similar.links_of_stars(work, edges, sets, percent), "long-links")
    place = F.struct("doc_id", "paragraph", "text_hash")
    placed = work.table(held.join(linked, "node").withColumnRenamed("component", "near"), "long-linked")
    spread = placed.groupBy("near").agg(F.min("doc_id").alias("component_id"), F.max("doc_id").alias("last"), F.min(F.struct(place.alias("place"), "hashes")).alias("first"))
    spread = spread.filter("component_id <> last").select("near", "component_id", F.col("first.place").alias("first"), F.col("first.hashes").alias("other"))
    others = placed.join(spread, "near").filter(place != F.col("first"))
    id_type = long.schema["doc_id"].dataType.simpleString()
    schema = f"near long, component_id {id_type}, doc_id {id_type}, text_hash long, paragraph long, first_word long, n_words long"
    inside = map_batches(others.select("near", "component_id", "doc_id", "text_hash", "paragraph", "first_word", "hashes", "starts", "other"), _kept_words, schema)
    key = ["doc_id", "text_hash", "paragraph", "first_word", "n_words", "component_id"]
    return inside.groupBy(*key, F.col("near").alias("component")).agg(F.count("*").alias("copies"))


def _with_partner(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """`rows` whose `key`, a hash, is among `keys`; only those that may be are moved."""
    return probe.split(rows, F.col(key), probe.bitmap(keys, F.col(key)))[1].join(keys, key)


def repeated_passages(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs(doc_id, text, ...)` -> one row for each repeated paragraph: doc_id, text_hash, paragraph, first_word, n_words, component_id,
    run_words, removed. first_word and n_words take in the words beside a paragraph that repeat with it.

    component_id is the smallest doc_id that holds a paragraph of the component. Its first paragraph, by doc_id and
    place, stays; removed marks the others. Runs of fewer than RUN_WORDS repeated words are left alone, so short phrases and
    single words are not reported. Null, empty and word-less texts hold no paragraphs. Rows of one doc_id are one document,
    and repeats within a document alone are not reported; rows of a null doc_id take part but do not count as another document. Extra
    columns are ignored.
    """
    work = Workspace(docs.sparkSession, "substring-dedup")
    plain = with_text_hash(docs.select("doc_id", "text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shape = (shingle, *tuned_bands(percent))
    texts = plain.select("doc_id", F.xxhash64("doc_id").alias("doc_hash"), "text")
    packs = map_batches(texts, _counted(*shape), "range long, keys binary, others binary").repartition("range").sortWithinPartitions("range")
    counted = work.table(packs.mapInArrow(_shared, "node long, head long"), "repeated")
    heads = counted.filter("head is not null").select(F.col("node").alias("bucket"), "head")
    bits, band_bits = _broadcast_bits(probe.bitmap(counted.filter("head is null"), F.col("node"))), _broadcast_bits(probe.bitmap(heads, F.col("bucket")))
    place = ["doc_id", "text_hash", "paragraph", "first_word"]
    schema = f"doc_id {id_type}, text_hash long, paragraph long, first_word long, n_words long, node long, n_text long, late boolean, starts array<long>, hashes binary, bands array<long>"
    pieces = work.table(map_batches(plain, _pieces(bits, band_bits, *shape), schema), "pieces")
    # What the bitmap let through and does not repeat goes when the first ones of all nodes are known.
    found = pieces.filter("hashes is null").groupBy(*place, "n_words", "node", "n_text", "late").agg(F.count("*").alias("copies"))
    found = work.table(found, "found")
    columns = [*place, "n_words", "node", F.col("node").alias("component"), "component_id", "copies", "removed"]
    found = work.table(_extended(work, plain, found).select(*columns), "extended")
    near = work.table(_near_copies(work, pieces.filter("hashes is not null"), heads, shingle, percent), "near")
    found = _between(found, _changed(near))
    by_doc = Window.partitionBy("doc_id", "text_hash").orderBy("paragraph")
    apart = F.col("first_word") > F.lag(F.col("first_word") + F.col("n_words")).over(by_doc)
    jump = F.coalesce((F.col("paragraph") - F.lag("paragraph").over(by_doc) > RUN_GAP) & apart, F.lit(True))
    found = found.withColumn("jump", jump).withColumn("run", F.sum(F.col("jump").cast("int")).over(by_doc))
    found = found.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("doc_id", "text_hash", "run")))
    found = found.filter(F.col("run_words") >= RUN_WORDS).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return found.select("doc_id", "text_hash", "paragraph", "first_word", "n_words", "component_id", "run_words", "removed")


def _changed(near: DataFrame) -> DataFrame:
    """Each paragraph of near copies once, with the columns of `found`."""
    rest = near.groupBy("doc_id", "text_hash", "paragraph", "first_word", "n_words")
    rest = rest.agg(F.min("component").alias("component"), F.min("component_id").alias("component_id"), F.max("copies").alias("copies"))
    return rest.withColumn("node", F.lit(None).cast("long")).withColumn("removed", F.lit(True))


def _between(found: DataFrame, changed: DataFrame) -> DataFrame:
    """`found`, and the `changed` paragraphs that are not among them, without the words that extended ones beside them have taken in."""
    rows = found.withColumn("exact", F.lit(True)).unionByName(changed.withColumn("exact", F.lit(False)))
    by_doc = Window.partitionBy("doc_id", "text_hash").orderBy("paragraph")
    end = F.col("first_word") + F.col("n_words")
    taken = F.max(F.when(F.col("exact"), end)).over(by_doc.rangeBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("exact"), F.col("first_word"))).over(by_doc.rangeBetween(1, Window.unboundedFollowing))
    same = F.max("exact").over(by_doc.rangeBetween(0, 0))
    rows = rows.withColumns({"taken": taken, "following": following, "same": same}).filter("exact or not same")
    low, high = F.greatest("first_word", "taken"), F.least(end, "following")
    rows = rows.withColumn("low", F.when(F.col("exact"), F.col("first_word")).otherwise(low)).withColumn("high", F.when(F.col("exact"), end).otherwise(high))
    rows = rows.filter("high > low").withColumn("first_word", F.col("low")).withColumn("n_words", F.col("high") - F.col("low"))
    return rows.drop("low", "high", "exact", "taken", "following", "same")


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """`docs` with the removed paragraphs of `passages`, as `repeated_passages` gives them, cut out of their texts; all columns stay, whatever
    their names, and texts without one as they are. Rows that repeat a doc_id are told apart by their text, so each loses only its own."""
    (spans_name,) = unused("spans")
    spans = passages.filter("removed").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first_word", "n_words")).alias(spans_name))
    touched = among(docs, spans, "inner")
    untouched = among(docs, spans.select("doc_id", "text_hash"), "left_anti")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(text_bytes(batch), batch.column(spans_name).to_pylist()):
            words_at = [m.span() for m in _WORD.finditer(text)]
            ranges = [(s["first_word"], s["first_word"] + s["n_words"]) for s in spans]
            for low, high in sorted((r for r in ranges if r[1] <= len(words_at)), reverse=True):
                end = words_at[high][0] if high < len(words_at) else len(text)
                text = text[: words_at[low][0]] + text[end:]
            out.append(text)
        names = [n for n in batch.schema.names if n != spans_name]
        columns = [pa.array(out, pa.binary()).cast(pa.string()) if n == "text" else batch.column(n) for n in names]
        return pa.RecordBatch.from_arrays(columns, names)

    return untouched.union(touched.mapInArrow(_each(cut), docs.schema))


def _each(function):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return run
