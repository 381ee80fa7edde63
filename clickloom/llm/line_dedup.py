"""Line deduplication across documents by an exact set-similarity join.

The tokens of a line are its distinct shingles of k words (a shorter line is one token). Tokens have one global order,
rare ones first, by counts over all lines in hashed counters. Lines with equal token sets are one class, placed where it
first occurs. If two sets are similar enough, their prefixes share a token; pairs are filtered by length and by the places of that
token, then verified with whole sets. A line is removed if an earlier line of any document is similar to it;
earlier means smaller (doc_id, text hash, line number).

One earlier match is enough. So each posting is first compared with two hubs of its token, the class that occurs first and the one
in whose order the token stands first; only classes that have found no match by then are compared with all others.
A frequent passage or a large group of near copies therefore never gives a pair for every two of its lines.
Fully in DataFrame functions.

Results for odd input: null text has no lines; an empty text is one empty line. Lines without words are never removed.
Repeated rows (equal doc_id and text) are one document: their lines stand at the same place and each row gets the same result.
Null doc_ids come last. Empty table: no rows. Columns other than doc_id and text are ignored, or kept by
`without_repeated_lines`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.functions.barrier import once
from clickloom.llm.common import small_enough, stored, unused, words

#: Counters of token frequencies (they only decide the order), and the largest count that is told apart.
COUNTERS, MOST_COUNT = 65_536, (1 << 22) - 1
#: Ids of candidate documents are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def tokens(line: str, k: int) -> str:
    """SQL for the token hashes of a line, repeats included."""
    parts = ", ".join(f"w[i + {j}]" for j in range(k))
    return (f"transform(array({words(f'lower({line})')}), w -> case when size(w) = 0 then cast(array() as array<bigint>) "
            f"when size(w) < {k} then array(xxhash64(w)) "
            f"else transform(sequence(0, size(w) - {k}), i -> xxhash64({parts})) end)[0]")


def _counts(lines: DataFrame, k: int) -> DataFrame:
    """(b, count): how often the tokens of each counter occur, repeats included; the hashes are those of `tokens`."""
    parts = ", ".join(f"w[i + {j}]" for j in range(k))
    # A row per token lets Spark compile the hashing, which costs several times as much inside a lambda.
    each = once(lines.select("txt"), w=F.expr(words("lower(txt)"))).where("size(w) > 0").select(
        "w", F.explode(F.expr(f"sequence(0, greatest(size(w) - {k}, 0))")).alias("i"))
    each = each.select(F.expr(f"case when size(w) < {k} then xxhash64(w) else xxhash64({parts}) end").alias("h"))
    return each.groupBy(F.expr(f"cast(h & {COUNTERS - 1} as int)").alias("b")).count()


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"),
                       F.posexplode(F.split("text", "\n", -1)).alias("line", "txt"))


def _within(x: str, y: str, percent: int) -> str:
    """Whether sets of these sizes, with a token in common at these places, can be similar."""
    need = f"ceil({percent} * ({x}n + {y}n) / {100 + percent})"
    return (f"100 * least({x}n, {y}n) >= {percent} * greatest({x}n, {y}n) and {x}pos <= {x}n - {need} and {y}pos <= {y}n - {need} "
            f"and least({x}pos, {y}pos) + least({x}n - {x}pos, {y}n - {y}pos) >= {need}")


def repeated_lines(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, key, n_lines, removed): per document its number of lines and the numbers, from 0, of those to remove."""
    lines = _lines(docs)
    counts = _counts(lines, k).collect()  # at most COUNTERS rows
    often = {r["b"]: min(r["count"], MOST_COUNT) for r in counts}
    # One number per token that sorts by rarity: the count above, 41 bits of the hash below.
    table = F.split(F.lit(",".join(str(often.get(b, 0) << 41) for b in range(COUNTERS))), ",").cast("array<bigint>")

    def ranked_token(h):
        return F.get(table, h.bitwiseAND(F.lit(COUNTERS - 1).cast("long")).cast("int")).bitwiseOR(F.shiftrightunsigned(h, 23))

    sets = once(lines, t=F.array_distinct(F.expr(tokens("txt", k)))).where("size(t) > 0")
    sets = sets.select("doc_id", "key", "line", F.size("t").alias("n"), F.sort_array(F.transform("t", ranked_token)).alias("order"),
                       F.expr("if(size(t) = 1, t[0], 0L)").alias("single"))
    # The sorted numbers name the set; a set of one token needs its whole hash for that.
    sets = stored(sets.select("doc_id", "key", "line", "n", F.xxhash64("order", "single").alias("class"),
                              F.expr(f"slice(order, 1, n - cast(ceil({percent} * n / 100) as int) + 1)").alias("prefix")), "lines")

    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "line")
    first = stored(sets.groupBy("class").agg(F.min(place).alias("first")), "classes")
    postings = sets.select("class", "n", F.posexplode("prefix").alias("pos", "token"))
    # One shuffle by token finds the tokens of several classes and keeps a row for each of these.
    own = Window.partitionBy("token")
    near = postings.withColumn("_least", F.min("class").over(own)).withColumn("_most", F.max("class").over(own)).where("_least != _most")
    near = near.drop("_least", "_most").dropDuplicates(["token", "class"])
    near = stored(near.join(first, "class"), "postings")

    cut = ["class", "n", "pos", "first"]
    hubs = near.groupBy("token").agg(F.min(F.struct("first", "class", "n", "pos")).alias("early"),
                                     F.min(F.struct("pos", "n", "class", "first")).alias("low"))
    star = near.join(hubs, "token").select(*cut, F.explode(F.array(*[F.struct(*[F.col(f"{h}.{c}").alias(c) for c in cut]) for h in ("early", "low")])).alias("hub"))
    star = star.where(F.col("class") != F.col("hub.class")).where(_within("", "hub.", percent))
    later = F.col("first") > F.col("hub.first")
    star = star.select(F.when(later, F.col("class")).otherwise(F.col("hub.class")).alias("x"),
                       F.when(later, F.col("hub.class")).otherwise(F.col("class")).alias("y")).distinct()
    gone = stored(_verified(stored(star, "pairs"), docs, first, k, percent), "matched")

    left = near.select("token", *[F.col(c).alias(f"l_{c}") for c in cut])
    left = left.join(gone.select(F.col("x").alias("l_class")), "l_class", "left_anti")
    right = near.select("token", *[F.col(c).alias(f"r_{c}") for c in cut])
    pairs = left.join(right, "token").where(F.col("l_first") > F.col("r_first")).where(_within("l_", "r_", percent))
    pairs = stored(pairs.select(F.col("l_class").alias("x"), F.col("r_class").alias("y")).distinct(), "pairs")
    gone = gone.union(_verified(pairs, docs, first, k, percent)).select(F.col("x").alias("class"), F.lit(True).alias("gone"))

    marked = sets.select("doc_id", "key", "line", "class").join(first, "class").join(gone, "class", "left")
    removed = marked.where(F.col("gone") | (place > F.col("first"))).select("doc_id", "key", "line").distinct()
    removed = removed.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("line")).alias("removed"))
    removed = removed.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "removed")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"),
                        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    every = every.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    return every.join(removed, every["doc_id"].eqNullSafe(F.col("_d")) & (every["key"] == F.col("_k")), "left").select(
        "doc_id", "key", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def _verified(pairs: DataFrame, docs: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """The distinct x of pairs (x, y) of classes whose sets reach the similarity; sets come from the texts again."""
    ids = pairs.select(F.col("x").alias("class")).union(pairs.select("y")).distinct().join(first, "class")
    ids = stored(ids.select("class", F.col("first.doc_id").alias("_d"), F.col("first.key").alias("_k"), F.col("first.line").alias("_l")), "wanted")
    few = small_enough(ids, BROADCAST_ROWS)
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    texts = ids.select("_d", "_k").distinct()
    lines = _lines(lines.join(F.broadcast(texts) if few else texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left_semi"))
    lines = lines.join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")) & (F.col("line") == F.col("_l")))
    sets = stored(lines.select("class", F.array_distinct(F.expr(tokens("txt", k))).alias("t")).dropDuplicates(["class"]), "sets")
    x = sets.select(F.col("class").alias("x"), F.col("t").alias("tx"))
    y = sets.select(F.col("class").alias("y"), F.col("t").alias("ty"))
    both = F.size(F.array_intersect("tx", "ty"))
    return (pairs.join(x, "x").join(y, "y").where(100 * both >= percent * (F.size("tx") + F.size("ty") - both)).select("x").distinct())


def without_repeated_lines(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, their text without repeated lines; a text all of whose lines go is empty."""
    d, key, gone = (unused(docs, c) for c in ("_d", "_k", "_gone"))
    found = repeated_lines(docs, k, percent).where("size(removed) > 0").dropDuplicates(["doc_id", "key"])
    found = found.select(F.col("doc_id").alias(d), F.col("key").alias(key), F.col("removed").alias(gone))
    own = docs.join(found, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(key)), "left")
    lines = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return own.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)).drop(d, key, gone)
