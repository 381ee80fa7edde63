"""Similarity join of word shingles by Jaccard, with adaptive multi-match prefixes, and its components.

Every text becomes the set of its distinct k-word shingles; equal sets are one class. All shingles have
one global order, rare ones first (frequencies come from a counter array filled by all documents). If two
sets overlap enough, their prefixes of length `size - overlap + l` share at least l shingles, for every l.
Each document picks its own l: a longer prefix reads more postings but leaves fewer pairs to verify, and
the cheaper sum wins. The larger document of a pair is the one whose l counts.

Large groups of near copies would give many postings for every two of them. So candidates are found in two passes:
first every posting is compared with one hub of its shingle, and verified links are merged into components; then
all pairs are formed whose ends are still in different components. A bitmap of each set (parities of its shingles)
rejects most other pairs inside the join. What these passes skip lies inside a component, as all similar pairs do. So
in a third pass the sets of each component are compared, every two of them: they are dealt to bands of length, a band
to blocks of bounded size, and a task takes two blocks at a time. Its work grows with the square of a component, its memory does not.

Results for odd input: null text, empty text or white space only: no shingles, no links, a component of
its own. A text shorter than k words: its whole word sequence is its one shingle. Repeated rows and equal
texts: one class, one component. Null doc_id: never the smallest id of a component; null where alone.
Empty table: no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import components, mix, shingle_sets, slices, small_batches, small_enough, stored

CHUNK = 4096
#: Chunks of counters that leave a task together.
CHUNKS_AT_ONCE = 32
#: The largest count that is told apart: counters take four bytes.
MOST_COUNT = (1 << 32) - 1
#: Columns of a set's bitmap: 256 parities, each of the number of shingles that hash to it.
MAP = ["b0", "b1", "b2", "b3"]
PROFILE = ["doc_id", "key", "n", "cid", "slot", "counts", *MAP]
#: Ids of candidate documents (8 bytes each) are broadcast up to this many, joined by shuffle beyond.
BROADCAST_ROWS = 1_000_000
#: Shingles and sets of a component that are compared at once with as many others, about.
BLOCK_SHINGLES, BLOCK_SETS = 1 << 18, 512
TASK = ["root", "l_band", "l_block", "r_band", "r_block"]


def _signature(s: np.ndarray) -> int:
    both = s.sum(dtype=np.uint64, keepdims=True) * np.uint64(31) ^ np.bitwise_xor.reduce(mix(s)) ^ np.uint64(len(s))
    return int(mix(both).view(np.int64)[0])


def _bitmap(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _packed(counts: np.ndarray) -> bytes:
    """Counters in as few bytes each as the largest needs; how many tells the length."""
    most = int(counts.max())
    return counts.astype(next(f"<u{size}" for size in (1, 2, 4, 8) if most < 1 << 8 * size)).tobytes()


def _unpacked(packed: bytes, many: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // many}")


def _profiles(k: int, counter_bits: int):
    """Per document its class; at the end of the task, how often each counter's shingles occurred."""
    shift = np.uint64(64 - counter_bits)

    def run(batches):
        counts = np.zeros(1 << counter_bits, np.int64)
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            n, sig, maps = [], [], []
            for _, data, offsets in slices(text):
                sets = list(shingle_sets(data, offsets, k))
                n += [len(s) for s in sets]
                sig += [_signature(s) if len(s) else None for s in sets]
                maps += [_bitmap(s) for s in sets]
                got = np.concatenate(sets)
                at, many = np.unique((got >> shift).astype(np.int64), return_counts=True)
                counts[at] += many
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            maps = np.array(maps, np.int64).reshape(-1, len(MAP))
            yield pa.RecordBatch.from_arrays([ids, batch.column(2), pa.array(n, pa.int32()), pa.array(sig, pa.int64()), *none,
                                              *(pa.array(maps[:, j]) for j in range(len(MAP)))], PROFILE)
        for start in range(0, -(-len(counts) // CHUNK), CHUNKS_AT_ONCE):
            rows = [(i, counts[i * CHUNK:(i + 1) * CHUNK]) for i in range(start, start + CHUNKS_AT_ONCE)]
            rows = [(i, _packed(c)) for i, c in rows if c.any()]
            empty = [pa.nulls(len(rows), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([i for i, _ in rows], pa.int32()),
                                              pa.array([c for _, c in rows], pa.binary()),
                                              *[pa.nulls(len(rows), pa.int64())] * len(MAP)], PROFILE)

    return run


def _added(many: int):
    """Of packed counters of one chunk, the first row with the sum of all."""
    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(many, np.int64)
        for c in table.column("counts"):
            total += _unpacked(c.as_py(), many)
        return table.slice(0, 1).set_column(table.schema.get_field_index("counts"), "counts", pa.array([_packed(total)], pa.binary()))
    return run


def _postings(k: int, percent: int, levels: int, counter_bits: int, counters):
    """Prefix shingles of each document: their place in the order, the l from which the prefix has them."""
    shift = np.uint64(64 - counter_bits)
    names = ["token", "cid", "n", "pos", "level", "ell"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches):
        counts = counters.value
        noise = max(1.0, float(counts.mean(dtype=np.float64)))
        for batch in batches:
            for _, data, offsets in slices(batch.column(1)):
                out = [[] for _ in names]
                for s in shingle_sets(data, offsets, k):
                    n = len(s)
                    if not n:
                        continue
                    need = -(-percent * n // 100)
                    top = min(levels, need)
                    often = counts[(s >> shift).astype(np.int64)].astype(np.int64)
                    first = np.lexsort((s, often))[:n - need + top]
                    cost = np.maximum(1.0, often[first] - noise)
                    reads = np.cumsum(cost)[n - need:]
                    ells = np.arange(1, top + 1)
                    # Pairs left to verify are at most the postings read over l; verifying costs about the set's size.
                    ell = int(ells[np.argmin(reads + reads / ells * (1 + n / 16))])
                    pos = np.arange(len(first))
                    for o, v in zip(out, (s[first].view(np.int64), np.full(len(first), _signature(s)), np.full(len(first), n),
                                          pos, np.maximum(1, pos - (n - need) + 1), np.full(len(first), ell)), strict=True):
                        o.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(o), t) for o, t in zip(out, kinds, strict=True)], names)

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for _, data, offsets in slices(batch.column(1)):
                sets = [s for s in shingle_sets(data, offsets, k) if len(s)]
                if sets:
                    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_signature(s) for s in sets], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                        ["cid", "tokens"])

    return run


def _linked(percent: int):
    """Of the sets of one or two blocks, how many of the other block (of its own, if there is one) are similar to each."""
    def run(table: pa.Table) -> pa.Table:
        lists = table.column("tokens").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        tokens, n = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])
        odd = np.bincount(np.repeat(np.arange(len(n)), n) * 256 + (tokens & 255), minlength=256 * len(n)) & 1
        odd = odd.reshape(-1, 256).astype(np.float32)
        names, place = np.unique(tokens, return_inverse=True)
        right = table.column("right").to_numpy()
        rows, others = np.flatnonzero(~right), np.flatnonzero(right)
        alone = not len(others)
        others = rows if alone else others
        n_links, here = np.zeros(len(n), np.int64), np.zeros(len(names), np.uint8)
        bits = odd[others].sum(axis=1)
        for i, x in enumerate(rows):
            y = others[i + 1:] if alone else others
            differ = odd[x].sum() + bits[len(others) - len(y):] - 2 * (odd[y] @ odd[x])
            total = n[x] + n[y]
            # Bitmaps differ in no more bits than sets differ in shingles.
            y = y[(100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & ((100 + percent) * (total - differ) >= 2 * percent * total)]
            if not len(y):
                continue
            here[place[ends[x]:ends[x + 1]]] = 1
            found = here[np.concatenate([place[ends[j]:ends[j + 1]] for j in y])]
            both = np.add.reduceat(found, np.concatenate([[0], np.cumsum(n[y])[:-1]]), dtype=np.int64)
            here[place[ends[x]:ends[x + 1]]] = 0
            y = y[(100 + percent) * both >= percent * (n[x] + n[y])]
            n_links[x] += len(y)
            n_links[y] += 1
        some = n_links > 0
        return pa.table({"cid": table.column("cid").filter(pa.array(some)), "n_links": pa.array(n_links[some])})
    return run


def _links(members: DataFrame, sets_of, percent: int) -> DataFrame:
    """How many sets are similar to each set (cid) of a component (root): rows (cid, n_links). n is the number of a set's shingles."""
    # Sets that differ more in length than similar ones lie two bands apart at least.
    width = math.log(100 / percent) * (1 + 1e-9) or 1e-9
    members = members.withColumn("band", F.floor(F.log("n") / F.lit(width)))
    many = members.groupBy("root").agg(F.count("*").alias("_many"))
    # Two sets are a component by the link between them.
    two = members.join(many.where("_many = 2").select("root"), "root", "left_semi").select("cid", F.lit(1).cast("long").alias("n_links"))
    members = members.join(many.where("_many > 2").select("root"), "root", "left_semi")
    bands = members.groupBy("root", "band").agg(
        F.ceil(F.greatest(F.sum("n") / F.lit(BLOCK_SHINGLES), F.count("*") / F.lit(BLOCK_SETS))).alias("blocks"))
    members = stored(members.join(bands, ["root", "band"]).select(
        "root", "band", F.pmod(F.xxhash64("cid", F.lit(11)), F.col("blocks")).alias("block"), "cid"), "members")
    blocks = members.select("root", "band", "block").distinct()
    left, right = (blocks.select("root", F.col("band").alias(f"{s}_band"), F.col("block").alias(f"{s}_block")) for s in "lr")
    tasks = left.join(right, "root").where("r_band = l_band + 1 or (r_band = l_band and r_block >= l_block)")
    ends = F.array(F.struct(F.col("l_band").alias("band"), F.col("l_block").alias("block"), F.lit(False).alias("right")),
                   F.struct(F.col("r_band").alias("band"), F.col("r_block").alias("block"), F.lit(True).alias("right")))
    tasks = tasks.select(*TASK, F.inline(ends)).where("not right or r_band != l_band or r_block != l_block")
    sent = members.join(tasks, ["root", "band", "block"]).join(sets_of(members), "cid").select(*TASK, "cid", "right", "tokens")
    found = sent.groupBy(*TASK).applyInArrow(_linked(percent), "cid long, n_links long")
    return two.unionByName(found).groupBy("cid").agg(F.sum("n_links").alias("n_links"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (x, y) those whose sets reach the similarity, as edges (a, b)."""
    x = sets.select(F.col("cid").alias("x"), F.col("tokens").alias("tx"))
    y = sets.select(F.col("cid").alias("y"), F.col("tokens").alias("ty"))
    both = F.size(F.array_intersect("tx", "ty"))
    return (pairs.join(x, "x").join(y, "y")
            .where(100 * both >= percent * (F.size("tx") + F.size("ty") - both))
            .select(F.col("x").alias("a"), F.col("y").alias("b")))


def jaccard_join(docs: DataFrame, k: int = 3, percent: int = 90, levels: int = 4, counter_bits: int = 21) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, n_links, component_id, key, group_id.

    class_id names the set (null without shingles); n_links counts the other classes that are similar to its class,
    each of them verified. component_id is the smallest doc_id of the component.
    key is the hash of the text, group_id names the component by a class of it (null without shingles), also where doc_ids repeat or are null.
    `levels` is the largest l; `counter_bits` sizes the frequency counters (4 bytes each on every worker, 8 while a task counts) and
    should grow with the corpus: counters only decide the order, so results do not depend on them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = "doc_id long, key long, n int, cid long, slot int, counts binary, " + ", ".join(f"{b} long" for b in MAP)
    profile = stored(docs.withColumn("key", F.xxhash64("text")).mapInArrow(_profiles(k, counter_bits), schema), "profiles")

    parts = (profile.where("slot is not null").select("slot", "counts")
             .withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(32)).cast("int")))
    many = min(CHUNK, 1 << counter_bits)
    total = parts.groupBy("slot", "part").applyInArrow(_added(many), parts.schema)
    total = total.groupBy("slot").applyInArrow(_added(many), parts.schema)
    # Counters decide the order only, so the largest need not be told apart; half as wide, they take half of every worker's memory.
    counts = np.zeros(1 << counter_bits, np.uint32)
    for row in total.select("slot", "counts").collect():  # at most 2 ** counter_bits counters
        counts[row.slot * CHUNK:(row.slot + 1) * CHUNK] = np.minimum(_unpacked(row.counts, many).astype(np.int64), MOST_COUNT)
    counters = spark.sparkContext.broadcast(counts)

    every = profile.where("slot is null").select("doc_id", "key", "n", "cid", *MAP)
    kind = "token long, cid long, n int, pos int, level int, ell int"
    postings = docs.mapInArrow(_postings(k, percent, levels, counter_bits, counters), kind)
    # Most shingles stand in one prefix only. Counting needs the shingles alone, so the first shuffle is slim.
    often = postings.groupBy("token").agg(F.count("*").alias("_seen")).where("_seen > 1").select("token")
    near = postings.join(often, "token").dropDuplicates(["token", "cid"])
    maps = every.where("cid is not null").groupBy("cid").agg(*[F.min(b).alias(b) for b in MAP])
    near = stored(near.join(maps, "cid"), "postings")
    counters.destroy()
    del counts
    hubs = near.groupBy("token").agg(F.min(F.struct("pos", "n", "cid", *MAP)).alias("hub"), F.min("cid").alias("_least"),
                                     F.max("cid").alias("_most"))
    near = near.join(hubs.where("_least != _most").select("token", "hub"), "token")

    one = every.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("least"), F.min("n").alias("n"))

    def sets_in(pairs: DataFrame) -> DataFrame:
        return sets_of(pairs.select(F.col("x").alias("cid")).union(pairs.select("y")))

    def sets_of(classes: DataFrame) -> DataFrame:
        """The sets of classes, from the texts of one document each."""
        ids = classes.select("cid").distinct().join(one, "cid")
        ids = ids.select(F.col("least").alias("_id")).distinct()
        ids = F.broadcast(ids) if small_enough(ids, BROADCAST_ROWS) else ids
        text = docs.join(ids, docs.doc_id.eqNullSafe(F.col("_id")), "left_semi")
        return stored(text.mapInArrow(_sets(k), "cid long, tokens array<long>").dropDuplicates(["cid"]), "sets")

    def within(x: str, y: str, ell: str) -> str:
        """Whether sets of these sizes, with a shingle in common at these places, can be similar.

        Both places have to lie in the prefixes needed for l shared shingles; and bitmaps differ in no more
        bits than sets differ in shingles.
        """
        a, b = f"{x}n", f"{y}n"
        need = f"ceil({percent} * ({a} + {b}) / {100 + percent})"
        bits = " + ".join(f"bit_count({x}{m} ^ {y}{m})" for m in MAP)
        return (f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b}) and {x}pos < {a} - {need} + {ell} "
                f"and {y}pos < {b} - {need} + {ell} and {bits} <= {a} + {b} - 2 * {need}")

    star = near.where("cid != hub.cid").where(within("", "hub.", "1"))
    star = stored(star.select(F.greatest("cid", "hub.cid").alias("x"), F.least("cid", "hub.cid").alias("y")).distinct(), "pairs")
    first = stored(_verified(star, sets_in(star), percent), "links")
    found = components(first)

    label = found.select(F.col("node").alias("cid"), F.col("root"))
    near = near.join(label, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    hubs = label.select(F.col("cid").alias("_hub"), F.col("root").alias("hub_root"))
    near = (near.withColumn("_hub", F.col("hub.cid")).join(hubs, "_hub", "left")
            .withColumn("hub_root", F.coalesce("hub_root", "_hub")))
    near = stored(near.select("token", "cid", "n", "pos", "level", "ell", *MAP, "root", (F.col("root") != F.col("hub_root")).alias("other")), "rooted")
    cut = ["cid", "n", "pos", "level", "ell", "root", "other", *MAP]
    left = near.where("other").select("token", *[F.col(c).alias(f"l_{c}") for c in cut])
    right = near.join(near.where("other").select("token").distinct(), "token", "left_semi")
    right = right.select("token", *[F.col(c).alias(f"r_{c}") for c in cut])
    ahead = "(l_n, l_cid) > (r_n, r_cid)"
    ell = f"(case when {ahead} then l_ell else r_ell end)"
    pairs = left.join(right, "token").where(
        f"l_root != r_root and (not r_other or {ahead}) and l_level <= {ell} and r_level <= {ell} and "
        + within("l_", "r_", ell))
    pairs = (pairs.select(F.expr(f"if({ahead}, l_cid, r_cid)").alias("x"), F.expr(f"if({ahead}, r_cid, l_cid)").alias("y"),
                          F.expr(ell).alias("ell"), F.ceil(F.expr(f"{percent} * (l_n + r_n) / {100 + percent}")).alias("need"))
             .groupBy("x", "y").agg(F.count("*").alias("hits"), F.max("ell").alias("ell"), F.max("need").alias("need"))
             .where("hits >= least(ell, need)").select("x", "y"))
    pairs = stored(pairs, "pairs")
    more = stored(_verified(pairs, sets_in(pairs), percent), "links")
    if not more.isEmpty():
        # The components found before are nodes now; what joins them is little.
        root = lambda c: F.coalesce(F.col(c), F.col(c[1:]))
        ends = more.join(label.select(F.col("cid").alias("a"), F.col("root").alias("_a")), "a", "left").join(
            label.select(F.col("cid").alias("b"), F.col("root").alias("_b")), "b", "left").select(root("_a").alias("a"), root("_b").alias("b"))
        joined = components(ends).select("node", F.col("root").alias("_top"))
        label = label.join(joined, F.col("root") == F.col("node"), "left").select("cid", F.coalesce("_top", "root").alias("root")).unionByName(
            joined.join(label.select("cid"), F.col("node") == F.col("cid"), "left_anti").select(F.col("node").alias("cid"), F.col("_top").alias("root")))
    found = label
    degree = stored(_links(found.join(one.select("cid", "n"), "cid"), sets_of, percent), "degrees")
    classes = (one.join(found, "cid", "left").join(degree, "cid", "left")
               .withColumn("root", F.coalesce("root", "cid")))
    roots = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(roots, "root").select("cid", "component_id", "root", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return every.join(classes, "cid", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("cid").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "key", F.col("root").alias("group_id"))
