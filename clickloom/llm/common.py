"""What the operators share: scratch tables, ranks without one task per group, components, word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.session import fresh_dir

#: Fixed: white space that separates words, and the letters that are lower-cased.
SPACE_BYTES = (9, 10, 11, 12, 13, 32)
SPACE_RE = "[\\\\x09-\\\\x0D\\\\x20]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder (spark.checkpoint.dir) and read again: cuts the lineage, fixes row order ids."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python workers take texts in batches of so many rows, unless the session says how many: texts may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(rows))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: str) -> str:
    """SQL for the words of a text column as an array; null text gives an empty array."""
    return f"filter(split(coalesce({text}, ''), '{SPACE_RE}'), x -> x != '')"


def ranked(df: DataFrame, group: list[str], order: list[str], weight: str | None = None, blocks: int = 1024) -> DataFrame:
    """Add `before`: rows (or the sum of `weight`) that precede each row of its group.

    Rows are dealt to blocks by the hash of `order`; block sums are accumulated, so that no task
    sees a whole group. The order within a group is (block, order); rows equal in `order` are ties.
    """
    value = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    cut = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int")).withColumn("_value", value)
    sums = cut.groupBy(*group, "_block").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_block").alias("_b"),
                       F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry"))
    on = F.col("_block") == F.col("_b")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = (Window.partitionBy(*group, "_block").orderBy(F.xxhash64(*order, F.lit(7)), *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    cut = cut.withColumn("_in", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return (cut.join(sums, on).withColumn("before", F.col("_in") + F.col("_carry"))
            .drop("_block", "_value", "_in", "_carry", "_b", *[f"_g{i}" for i in range(len(group))]))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of edges (a, b): (node, root), root the smallest node of the component.

    Alternating large-star and small-star rounds. A node's neighbours are never gathered: each round
    takes a minimum per node and joins it back, so that Spark can split a hub's edges.
    """
    now = stored(edges.select("a", "b").where("a != b").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                             F.col("m").alias("b"))
        now = stored(small.where("a != b").distinct(), "edges")
        got = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(got):
            break
        mark = tuple(got)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def small_enough(df: DataFrame, most: int) -> bool:
    """Whether a frame has at most `most` rows: the check before any broadcast."""
    return df.count() <= most


# Word hashes of whole Arrow batches -------------------------------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        more = np.full(max(n, 2 * len(_POWERS)), _BASE, dtype=np.uint64)
        more[0] = 1
        _POWERS = np.multiply.accumulate(more)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, most: int = 1 << 20):
    """Cut a string column into (first row, bytes, offsets) of about `most` bytes; a longer text is whole."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and where each text's words begin (one entry more than texts)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = _FOLD[data]
    blank = _IS_SPACE[data]
    start = ~blank
    start[1:] &= blank[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = ~blank[heads]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    place = np.arange(at[0], len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    value = np.where(blank[at[0]:], np.uint64(0), _BYTE[data[at[0]:]] * _powers(int(place.max()) + 1)[place])
    # A text that ends without white space is followed by the next text's first word, which starts anew.
    return mix(np.add.reduceat(value, at - at[0])), np.searchsorted(at, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """For each text its distinct shingles of k words, sorted; a shorter text is one shingle, no words none."""
    hashes, begin = word_hashes(data, offsets)
    n = len(hashes)
    rolled = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        rolled += hashes[j:n - k + 1 + j] * np.uint64(2 * int(_BYTE[j] >> np.uint64(2)) + 1)
    rolled = mix(rolled)
    for i in range(len(offsets) - 1):
        lo, hi = int(begin[i]), int(begin[i + 1])
        if hi - lo >= k:
            yield np.unique(rolled[lo:hi - k + 1])
        elif hi > lo:
            whole = np.full(1, hi - lo, np.uint64)
            for j in range(lo, hi):
                whole = mix(hashes[j:j + 1] ^ (whole * _BASE))
            yield whole
        else:
            yield np.zeros(0, np.uint64)


HASHES = 1 << 31


def bound(want: int, total: int) -> int:
    """Below this place there are surely `want` of `total` distinct keys, and not many more."""
    return HASHES if total <= 3 * want else HASHES * 3 * want // total


def sampled(df: DataFrame, keys: list[str], want: int, group: str | None = None) -> DataFrame:
    """At most `want` rows, of each value of `group` if one is named: those with the smallest hashes of their keys, equal keys once.

    Only hashes are ranked, and those that can hardly be among the smallest are left out before. Where repeated rows leave
    too few of them, all are ranked. What comes to the driver is a row per value of `group`.
    """
    of = F.lit("") if group is None else F.col(group).cast("string")
    df = df.withColumn("_of", of).withColumn("_hash", F.xxhash64(*keys))
    order = [F.pmod("_hash", F.lit(HASHES)), F.col("_hash")]
    total = {r["_of"]: r["count"] for r in df.groupBy("_of").count().collect()}
    if not total:
        return df.drop("_of", "_hash")
    limits = {of: bound(want, n) for of, n in total.items()}

    def last(limits: dict[str, int]) -> dict[str, tuple[int, int, int]]:
        most = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        rank = F.row_number().over(Window.partitionBy("_of").orderBy(*order))
        found = df.select("_of", "_hash").where(order[0] < F.element_at(most, F.col("_of"))).distinct()
        found = found.withColumn("_rank", rank).where(F.col("_rank") <= want)
        ends = found.groupBy("_of").agg(F.max(F.struct(order[0].alias("p"), order[1].alias("h"))).alias("e"), F.count("*").alias("n"))
        return {r["_of"]: (r["e"]["p"], r["e"]["h"], r["n"]) for r in ends.collect()}

    ends = last(limits)
    short = {of: HASHES for of, limit in limits.items() if limit < HASHES and ends.get(of, (0, 0, 0))[2] < want}
    if short:
        ends |= last({of: short.get(of, 0) for of in limits})
    p, h = (F.element_at(F.create_map(*[F.lit(x) for of, e in ends.items() for x in (of, e[i])]), F.col("_of")) for i in (0, 1))
    return df.where((order[0] < p) | ((order[0] == p) & (order[1] <= h))).dropDuplicates(["_of", "_hash"]).drop("_of", "_hash")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def require(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
