"""Phrases of two to four words that stand together more often than their parts suggest, per language.

First the n-grams that can be frequent are found by hash, then those are counted exactly as text. Finding them takes one round for each
length (words, pairs, then three and four words together). In a round every task counts the n-grams of its texts in bounded
memory and hands the counts to hash partitions. Each hash partition keeps one Misra-Gries summary, to which the tasks' counts
are merged: beyond its capacity it takes the same amount off every counter, which together with all taken off before is less than the
threshold as long as the capacity exceeds the partition's mass divided by the threshold. There are as many hash partitions as let the capacity
be twice that for the mass to be expected; a summary that would still lose too much, because more than expected came to it, grows instead. So
every n-gram as frequent as the threshold survives, whatever the order and the split of the rows.

Survivors of a round become a Bloom filter of at most `MOST_BITS` bits. The next round takes only n-grams whose own parts are in it:
parts are at least as frequent as the whole. A filter lets some false ones pass, keeps no true one back, and a full one merely saves
nothing; the exact count decides. A frequent phrase never meets in one task before each task has counted its own.

Text of a lower-cased (A-Z) document is cut into pieces at `.,;:!?` and line breaks (codes 10 to 13), pieces into words at spaces and
tabs; phrases do not cross pieces. For a phrase of frequency a, cut after its first k words into parts of frequency l and r, the score is
floor(2000000 a / (l + r)); the cut with the lowest counts, the first of equal ones. A phrase inside a longer one at least 80 %
as frequent gives way to it, whether that one stays or not.

Results for odd input: null text is empty; null lang is `und`, together with a lang of that name. Repeated rows and equal or null
doc_ids count each. A long text is read in cuts that end where a piece ends. Empty table: no rows. Columns other than lang
and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import _BYTE, _FOLD, _powers, mix, slices, small_batches, small_enough, stored

#: Fixed: bytes that end a piece, and bytes that separate words inside one.
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[32, 9]] = True
LONGEST = 4
#: Counters of a task before it hands them on; of a summary to begin with; expected per hash partition.
HELD, CAPACITY = 1 << 21, 1 << 18
#: Bits of a filter per survivor, and at most; a key sets one bit for each shift of its hash.
BITS_EACH, MOST_BITS, SHIFTS = 32, 1 << 27, (0, 20, 37)
#: Counted phrases are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 300_000
_STEP = [np.uint64(0x9E3779B97F4A7C15 * (2 * j + 1) & 0xFFFFFFFFFFFFFFFF) | np.uint64(1) for j in range(LONGEST)]


class Summary:
    """A Misra-Gries summary of counts by key: `lost` is what has been taken off every counter at most, always below the threshold."""

    def __init__(self, threshold: int, capacity: int = CAPACITY):
        self.threshold, self.capacity, self.lost = threshold, capacity, 0
        self.keys, self.counts, self.parts, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting >= self.capacity:
            self.settle()

    def merge(self, other: Summary) -> None:
        """Add another summary; what both have lost has to stay below the threshold together."""
        if self.lost + other.lost >= self.threshold:
            raise ValueError("summaries have lost too much to be merged")
        self.lost += other.lost
        other.settle()
        self.add(other.keys, other.counts)

    def settle(self) -> None:
        if self.parts:
            keys, counts = (np.concatenate(x) for x in zip((self.keys, self.counts), *self.parts, strict=True))
            self.keys, self.counts = added(keys, counts)
            self.parts, self.waiting = [], 0
        while len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            if self.lost + off >= self.threshold:
                self.capacity *= 2
                continue
            self.lost += off
            keep = self.counts > off
            self.keys, self.counts = self.keys[keep], self.counts[keep] - off

    def survivors(self) -> np.ndarray:
        """All keys whose true count may reach the threshold."""
        self.settle()
        return self.keys[self.counts + self.lost >= self.threshold]


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _cuts(text: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """Parts of a text that end where a piece ends, of about `most` bytes; a longer piece is whole."""
    at = 0
    while len(text) - at > most:
        near = np.frombuffer(text, np.uint8, min(len(text) - at, 64 * most), at)
        ends = np.flatnonzero(_BREAK[near])
        ends = ends[max(0, int(np.searchsorted(ends, most)) - 1):][:1]
        if not len(ends):
            break
        yield text[at:at + int(ends[0]) + 1]
        at += int(ends[0]) + 1
    yield text[at:]


def _grams(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, longest: int = LONGEST):
    """The words of some texts: lower-cased bytes, starts, ends, and per length up to `longest` the hashes with where they are whole."""
    data = _FOLD[data]
    gap = _GAP[data]
    start = ~gap
    start[1:] &= gap[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = ~gap[heads]
    at = np.flatnonzero(start)
    if not len(at):
        return data, at, at, []
    span = np.diff(np.append(at, len(data)))
    place = np.arange(at[0], len(data)) - np.repeat(at, span)
    value = np.where(gap[at[0]:], np.uint64(0), _BYTE[data[at[0]:]] * _powers(int(place.max()) + 1)[place])
    text = np.searchsorted(offsets, at, side="right") - 1
    word = mix(np.add.reduceat(value, at - at[0]))
    # A piece ends at a break, and with its text.
    piece = np.cumsum(_BREAK[data])[at] + text
    ends = at + np.add.reduceat(~gap[at[0]:], at - at[0])
    found = []
    for n in range(1, longest + 1):
        m = len(word) - n + 1
        if m <= 0:
            found.append((np.zeros(0, np.uint64), np.zeros(0, bool)))
            continue
        rolled = langs[text[:m]] + np.uint64(n)
        for j in range(n):
            rolled = rolled + word[j:j + m] * _STEP[j]
        found.append((mix(rolled), piece[:m] == piece[n - 1:]))
    return data, at, ends, found


def _passed(found: list, bitmaps: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Per length the places of n-grams that may be frequent: in the filter of their length, and so are both n-grams one word shorter."""
    whole, before = [], None
    for n, (hashes, inside) in enumerate(found, 1):
        good = inside.copy()
        if n > 1:
            good &= before[:len(good)] & before[1:len(good) + 1]
        if n in bitmaps and len(good):
            left = np.flatnonzero(good)
            for shift in SHIFTS:
                cell = (hashes[left] >> np.uint64(shift)) & np.uint64(len(bitmaps[n]) * 64 - 1)
                left = left[(bitmaps[n][(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)]
            good = np.zeros(len(good), bool)
            good[left] = True
        before = good
        whole.append(good)
    return whole


def _texts(batch: pa.RecordBatch):
    """(bytes, offsets, hash of the lang per text, langs) of about a MiB each."""
    langs = batch.column(0).to_pylist()
    salt = np.array([zlib.crc32(x.encode()) << 16 for x in langs], np.uint64)
    for row, data, offsets in slices(batch.column(1)):
        if len(offsets) == 2 and len(data) > 1 << 20:
            for cut in _cuts(data.tobytes()):
                yield np.frombuffer(cut, np.uint8), np.array([0, len(cut)]), salt[row:row + 1], langs[row:row + 1]
        else:
            yield data, offsets, salt[row:row + len(offsets) - 1], langs[row:row + len(offsets) - 1]


def _counted(sizes: tuple[int, ...], bitmaps, held: int = HELD):
    """A task's counts of n-grams that may be frequent, by hash; rows (h, c) once it holds too many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = {n: m.value for n, m in bitmaps.items()}
        keys, counts, parts, waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0
        out = lambda: pa.RecordBatch.from_pydict({"h": keys.view(np.int64), "c": counts})
        for batch in batches:
            for data, offsets, salt, _ in _texts(batch):
                found = _grams(data, offsets, salt, max(sizes))[3]
                for n, good in enumerate(_passed(found, maps), 1):
                    if n in sizes:
                        some = added(found[n - 1][0][good], np.ones(int(good.sum()), np.int64))
                        parts.append(some)
                        waiting += len(some[0])
                if waiting >= held:
                    keys, counts = added(*(np.concatenate(x) for x in zip((keys, counts), *parts, strict=True)))
                    parts, waiting = [], 0
                    if len(keys) >= held:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        if parts:
            keys, counts = added(*(np.concatenate(x) for x in zip((keys, counts), *parts, strict=True)))
        if len(keys):
            yield out()
    return run


def _summarised(threshold: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(threshold, capacity)
        for batch in batches:
            summary.add(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_pydict({"h": summary.survivors().view(np.int64)})
    return run


def frequent(texts: DataFrame, sizes: tuple[int, ...], threshold: int, mass: int, bitmaps: dict, capacity: int = CAPACITY) -> DataFrame:
    """Hashes h of all n-grams of these sizes that occur `threshold` times, and of some others."""
    spark = texts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * mass // (threshold * CAPACITY) + 1)
    counts = texts.mapInArrow(_counted(sizes, bitmaps), "h long, c long")
    return counts.repartition(parts, "h").mapInArrow(_summarised(threshold, capacity), "h long")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The hashes as a filter of a power of two of bits, built in Spark; its size, not the number of hashes, bounds what comes to the driver."""
    hashes = stored(hashes, "survivors")
    bits = min(MOST_BITS, 1 << max(10, (BITS_EACH * hashes.count()).bit_length()))
    cells = hashes.select(F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(F.lit(bits - 1)) for s in SHIFTS])).alias("cell"))
    rows = cells.groupBy(F.expr("cast(shiftright(cell, 6) as int)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits")).toArrow()
    found = np.zeros(bits // 64, np.uint64)
    found[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return found


def _exact(bitmaps, held: int = 600_000):
    """A task's counts (lang, words, phrase, f) of the phrases that may be frequent, as text."""
    out = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])

    def batches_of(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, n), of in counts.items():
            phrases = pa.array(of.keys(), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(of), pa.string()), pa.array(np.full(len(of), n, np.int32)), phrases,
                                              pa.array(of.values(), pa.int64())], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, counts = {n: m.value for n, m in bitmaps.items()}, {}
        for batch in batches:
            for data, offsets, salt, langs in _texts(batch):
                data, at, ends, found = _grams(data, offsets, salt)
                raw, text = data.tobytes(), np.searchsorted(offsets, at, side="right") - 1
                for n, good in enumerate(_passed(found, maps), 1):
                    where = np.flatnonzero(good)
                    _, first, many = np.unique(found[n - 1][0][where], return_index=True, return_counts=True)
                    where = where[first]
                    for i, end, t, times in zip(at[where].tolist(), ends[where + n - 1].tolist(), text[where].tolist(), many.tolist(), strict=True):
                        of = counts.get((langs[t], n))
                        if of is None:
                            of = counts[langs[t], n] = {}
                        phrase = raw[i:end] if n == 1 else b" ".join(raw[i:end].split())
                        of[phrase] = of.get(phrase, 0) + times
                if sum(map(len, counts.values())) >= held:
                    yield from batches_of(counts)
                    counts = {}
        yield from batches_of(counts)
    return run


def counted(docs: DataFrame, threshold: int = 30, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, words, phrase, f of all phrases of one to four words that occur `threshold` times in a lang;
    lang and n, its number of words."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    pattern = "[^ \\t.,;:!?\\n\\x0B\\f\\r]+"
    totals = stored(texts.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(pattern))).cast("long").alias("n")), "totals")
    mass = totals.agg(F.sum("n")).first()[0] or 0
    bitmaps = {}
    for sizes in ((1,), (2,), (3, 4)):
        found = _bitmap(frequent(texts, sizes, threshold, mass * len(sizes), bitmaps, capacity))
        shared = spark.sparkContext.broadcast(found)
        bitmaps.update(dict.fromkeys(sizes, shared))
    exact = texts.mapInArrow(_exact(bitmaps), "lang string, words int, phrase string, f long")
    exact = stored(exact.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= threshold), "phrases")
    for shared in set(bitmaps.values()):
        shared.destroy()
    return exact, totals


def phrases(docs: DataFrame, threshold: int = 30, percent: int = 80, most: int = 2000, capacity: int = CAPACITY) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's first `most` phrases."""
    exact, totals = counted(docs, threshold, capacity)
    few = small_enough(exact, BROADCAST_ROWS)
    parts = exact.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias("_f"))
    parts = F.broadcast(parts) if few else parts
    longer = exact.where("words > 1").withColumn("w", F.split("phrase", " "))

    def looked_up(df: DataFrame, part: str, name: str) -> DataFrame:
        return df.join(parts, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).withColumnRenamed("_f", name).drop("_lang", "_part")

    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"), "w").selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') as head", "array_join(slice(w, k + 1, size(w)), ' ') as tail")
    cuts = looked_up(looked_up(cuts, "head", "l"), "tail", "r")
    # 2000000 a may pass 64 bits: whole numbers of 38 digits.
    cuts = cuts.withColumn("score", F.expr("cast((cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (l + r) as long)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    # Every shorter phrase that stands inside a longer one, with the highest frequency of such.
    inside = longer.where("words > 2").select("lang", "f", "w", F.explode(F.expr("sequence(2, words - 1)")).alias("m"))
    inside = inside.select("lang", "f", F.explode(F.expr("transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))")).alias("_inner"))
    inside = inside.groupBy(F.col("lang").alias("_lang"), "_inner").agg(F.max("f").alias("_longer"))
    kept = scored.join(inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner")), "left").where(
        f"_longer is null or {100} * cast(_longer as decimal(19,0)) < {percent} * cast(a as decimal(19,0))")
    best = kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return best.join(F.broadcast(totals) if small_enough(totals, 10_000) else totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
