"""Benchmark decontamination: items whose word shingles a document contains, found by MinHash and verified.

Items are partitioned by the size of their shingle set (powers of two). The sketch of an item holds the smallest min-hash
values of its set, as many as its partition's largest item may miss and one more: a document that contains the
wanted share of an item has at least one of them, so the search loses nothing. Documents are not sketched, since a short
item in a long document would hardly be in the document's sketch; their shingles look for the sketch values of all
partitions in one pass. The candidates, few by then, are verified with all shingles of the item.

Sketches are broadcast if their number is below a limit, otherwise joined by shuffle. Items with equal shingle sets
are searched once and listed each. Fully in DataFrame functions.

Results for odd input: null or empty texts, and items or documents of fewer words than a shingle, match
nothing. Null ids: searched like others and reported as null. Repeated items: each listed. Repeated documents: one row per
doc_id and item, with the largest containment of the texts under that doc_id. Empty tables: no rows. Columns other than the id and the
text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import small_enough, stored, unused, words

#: Sketch values and candidates are broadcast up to these many rows (some 40 bytes each), joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def shingles(text: str, k: int) -> str:
    """SQL for the hashed k-word shingles of a text column, repeats included; fewer words give none."""
    parts = ", ".join(f"w[i + {j}]" for j in range(k))
    return (f"transform(transform(array({words(f'lower({text})')}), w -> "
            f"if(size(w) < {k}, cast(array() as array<bigint>), transform(sequence(0, greatest(size(w) - {k}, 0)), "
            f"i -> xxhash64({parts})))), h -> h)[0]")


def sketch(items: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(classes, items): per distinct shingle set its class, shingles, size partition and sketch; items with their class."""
    sets = (items.select(F.col("item_id").cast("long").alias("item_id"), F.expr(f"sort_array(array_distinct({shingles('text', k)}))").alias("set"))
            .where("size(set) > 0").withColumn("class", F.xxhash64("set")))
    sets = stored(sets, "items")
    # Of n shingles a match has at least ceil(percent * n / 100): one of any n - that + 1 is in the document.
    classes = (sets.groupBy("class").agg(F.first("set").alias("set"))
               .withColumn("n", F.size("set"))
               .withColumn("part", F.ceil(F.log2("n")).cast("int"))
               .withColumn("keep", F.expr(f"least(n, cast(pow(2, part) as int) - ceil({percent} * pow(2, part) / 100) + 1)").cast("int"))
               .withColumn("sketch", F.expr("transform(slice(sort_array(transform(set, h -> struct(xxhash64(h, 17) as m, h as h))), 1, keep), x -> x.h)")))
    return classes, sets.select("item_id", "class")


def _found(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, key, class, n_shared, n_item) of the classes a text contains to `percent`; key is the hash of the text."""
    small = lambda df: F.broadcast(df) if small_enough(df, BROADCAST_ROWS) else df
    values = stored(classes.select("class", "part", F.explode("sketch").alias("h")), "sketches")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), F.explode(F.expr(shingles("text", k))).alias("h"))
    hits = stored(rows.join(small(values), "h").select("doc_id", "key", "class").distinct(), "candidates")

    texts = hits.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).distinct()
    again = docs.withColumn("key", F.xxhash64("text")).join(
        small(texts), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left_semi")
    own = again.select("doc_id", "key", F.explode(F.array_distinct(F.expr(shingles("text", k)))).alias("h")).distinct()
    full = classes.select(F.explode("set").alias("h"), F.col("class").alias("_c"), "n")
    wanted = hits.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("class"))
    shared = own.join(small(stored(full, "shingles")), "h").groupBy("doc_id", "key", F.col("_c")).agg(
        F.count("*").alias("n_shared"), F.max("n").alias("n_item"))
    return shared.where(f"100 * n_shared >= {percent} * n_item").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")) & (F.col("_c") == F.col("class"))).select(
        "doc_id", "key", "class", "n_shared", "n_item")


def contained(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Pairs (doc_id, item_id, n_item, n_shared, containment) of items whose shingles a document contains to `percent`."""
    classes, members = sketch(items, k, percent)
    found = _found(docs, classes, k, percent).groupBy("doc_id", "class").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))
    return found.join(members, "class").groupBy("doc_id", "item_id").agg(
        F.max("n_item").cast("long").alias("n_item"), F.max("n_shared").cast("long").alias("n_shared"),
        F.max(F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminated(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, without those that contain an item; other texts under the same or no doc_id stay."""
    name, text = unused(docs, "_bad"), unused(docs, "_text")
    classes, _ = sketch(items, k, percent)
    bad = _found(docs, classes, k, percent).select(F.col("doc_id").alias(name), F.col("key").alias(text)).distinct()
    bad = stored(bad, "contaminated")
    bad = F.broadcast(bad) if small_enough(bad, BROADCAST_ROWS) else bad
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64("text") == F.col(text)), "left_anti")
