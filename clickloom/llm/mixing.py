"""Mixing overlapping sources to target weights: a min-cost flow of token capacity, then seeded documents.

Documents are summed up by membership pattern, the set of sources that hold them. A pattern can give its words
once at no cost, a second time at a cost, a third time at a higher one: the costs are convex, so a copy is only
repeated where nothing fresh is left. Successive shortest paths route this capacity to the quotas of the sources.
The flow has as many nodes as there are patterns and sources, whatever the number of documents. Sources that no chain of
shared documents connects have nothing to give each other, so each group of connected sources is routed on its own; a
source that shares nothing, such as one per web host, needs no search at all.

What flows from a pattern to a source is then filled with whole documents in a seeded order: large documents
first, then middle ones, then small ones, each class aiming at what the classes before have left.
So the remaining error is at most about half a small document.

Results for odd input: null or empty text has size 0, is selected like others and takes no words. A null
source (or no source) is a source of its own, the last. Repeated rows and equal doc_ids: each row counts, equal rows are ties
that may end on either side of a cut. An empty table gives no rows; a source without words has target 0.
Columns other than doc_id, text and the sources are ignored.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ranked, small_enough, stored

#: Sizes in words from which a document is of the large and of the middle class.
CLASSES = (1024, 64)
#: Patterns and sources come to the driver; more than this many is an error, not a cut.
MOST_PATTERNS = 100_000


def targets(sizes: dict[str | None, int], total: int, weights: tuple[int, ...], share: Fraction, most: int) -> dict[str | None, Fraction]:
    """Words per source: `share` of `total` by weight, at most `most` times a source's size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, share * total, list(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not above:
            out.update({s: unit * weight[s] for s in open_})
            break
        for s in above:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def flow(capacity: dict[tuple, int], quota: dict, most: int) -> dict[tuple, list[int]]:
    """Min-cost flow of pattern -> source: for each (pattern, source) the words taken in the 1st, 2nd, ... copy.

    capacity: words per pattern (a tuple of sources). The k-th copy of a word costs k - 1.
    """
    patterns, sources = list(capacity), list(quota)
    arcs: list[list] = []                                # to, capacity, cost; the reverse arc is at index ^ 1
    out: dict = {}

    def arc(a, b, room, cost):
        for x, y, c, w in ((a, b, room, cost), (b, a, 0, -cost)):
            out.setdefault(x, []).append(len(arcs))
            arcs.append([y, c, w])

    for p in patterns:
        for copy in range(most):
            arc("s", ("p", p), capacity[p], copy)
        for source in p:
            arc(("p", p), ("q", source), most * capacity[p], 0)
    for source in sources:
        arc(("q", source), "t", quota[source], 0)
    height: dict = {}
    while True:
        best, via, heap, tie = {"s": 0}, {}, [(0, 0, "s")], 0
        done = set()
        while heap:
            d, _, at = heapq.heappop(heap)
            if at in done:
                continue
            done.add(at)
            for i in out.get(at, ()):
                to, room, cost = arcs[i]
                step = d + cost + height.get(at, 0) - height.get(to, 0)
                if room > 0 and step < best.get(to, 1 << 60):
                    best[to], via[to], tie = step, i, tie + 1
                    heapq.heappush(heap, (step, tie, to))
        if "t" not in best:
            break
        for at, d in best.items():
            height[at] = height.get(at, 0) + d
        path, at = [], "t"
        while at != "s":
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount
    taken = {}
    for p in patterns:
        # Copies of a pattern are handed to its sources one after another, first copies first.
        left = [capacity[p]] * most
        for i in out.get(("p", p), ()):
            if i % 2 == 0:
                need, got = arcs[i ^ 1][1], []
                for copy in range(most):
                    x = min(need, left[copy])
                    left[copy] -= x
                    need -= x
                    got.append(x)
                taken[p, arcs[i][0][1]] = got
    return taken


def connected(capacity: dict[tuple, int]) -> list[list[tuple]]:
    """The patterns, those together whose sources shared documents connect."""
    above: dict = {}

    def top(source):
        while above.setdefault(source, source) != source:
            above[source] = above[above[source]]
            source = above[source]
        return source

    for p in capacity:
        for source in p[1:]:
            above[top(source)] = top(p[0])
    groups: dict = {}
    for p in capacity:
        groups.setdefault(top(p[0]), []).append(p)
    return list(groups.values())


def routed(capacity: dict[tuple, int], quota: dict, most: int) -> dict[tuple, int]:
    """Words that each pattern gives, repeats counted: the flow of every group of connected sources."""
    goals = dict.fromkeys(capacity, 0)
    for patterns in connected(capacity):
        if len(patterns) == 1 and len(patterns[0]) == 1:
            (p,) = patterns
            goals[p] = min(quota[p[0]], most * capacity[p])
            continue
        own = {source: quota[source] for p in patterns for source in p}
        for (p, _), copies in flow({p: capacity[p] for p in patterns}, own, most).items():
            goals[p] += sum(copies)
    return goals


def selected(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (pattern, size, ...) with copies added: whole documents whose sizes sum up to about `wanted` per pattern.

    wanted: (pattern, goal), goal the words of the pattern to take, repeats counted. Documents are all taken
    floor(goal / total) times, and once more in seeded order until the rest is reached.
    """
    totals = rows.groupBy("pattern").agg(F.sum("size").alias("_all"))
    plan = totals.join(wanted, totals.pattern.eqNullSafe(wanted.pattern)).select(
        totals.pattern.alias("_p"), F.expr("case when _all > 0 then goal div _all else 0 end").alias("_base"),
        F.expr("case when _all > 0 then goal % _all else 0 end").alias("_goal"), "_all")
    kind = F.when(F.col("size") >= CLASSES[0], 0).when(F.col("size") >= CLASSES[1], 1).otherwise(2)
    dealt = ranked(rows.withColumn("_class", kind), ["pattern", "_class"], ["doc_id", "size", "_key"], "size")
    dealt = stored(dealt.join(F.broadcast(plan), F.col("pattern").eqNullSafe(F.col("_p"))).drop("_p"), "dealt")
    # A class takes its share of the goal and what the classes before have missed; it ends at the nearer side of a document.
    done = None
    for c in range(3):
        part = dealt.where(F.col("_class") == c)
        sums = dealt.groupBy("pattern").agg(F.sum(F.when(F.col("_class") < c, F.col("size")).otherwise(0)).alias("_gone"),
                                            F.sum(F.when(F.col("_class") == c, F.col("size")).otherwise(0)).alias("_here"),
                                            F.max("_goal").alias("_g"), F.max("_all").alias("_a"))
        if done is None:
            sums = sums.withColumn("_taken", F.lit(0).cast("long"))
        else:
            before = done.groupBy("pattern").agg(F.sum(F.when(F.col("_more"), F.col("size")).otherwise(0)).alias("_taken"))
            before = before.select(F.col("pattern").alias("_q"), "_taken")
            sums = (sums.join(before, F.col("pattern").eqNullSafe(F.col("_q")), "left").drop("_q")
                    .withColumn("_taken", F.coalesce("_taken", F.lit(0).cast("long"))))
        due = sums.select(F.col("pattern").alias("_q"), F.expr(
            "least(_here, greatest(0, case when _a > 0 then cast(_g * cast(_gone + _here as decimal(38,0)) / _a as bigint) else 0 end"
            " - _taken))").alias("_due"))
        part = (part.join(due, F.col("pattern").eqNullSafe(F.col("_q"))).drop("_q")
                .withColumn("_more", F.expr("2 * (_due - before) > size or (size = 0 and before < _due)")).drop("_due"))
        done = stored(part if done is None else done.unionByName(part), "taken")
    return done.withColumn("copies", F.col("_base") + F.col("_more").cast("long")).drop(
        "_class", "_base", "_goal", "_all", "_more", "before")


def mix(
    docs: DataFrame, sources: str = "array(source)", weights: tuple[int, ...] = (5, 2, 1), share: Fraction = Fraction(3, 2),
    most: int = 2, seed: int = 0,
) -> DataFrame:
    """One row per document: doc_id, size, pattern, source_size, target, copies, taken, and the key `_key` of its text.

    sources: SQL for the array of sources that hold a document. They share `share` of the words of all documents, a
    document of several sources counted once. source_size and target are those of its first
    source by name. taken = copies * size.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", F.expr(f"array_sort(array_distinct(if(size({sources}) > 0, {sources}, array(cast(null as string)))))").alias("pattern"),
                        F.expr("size(filter(split(coalesce(text, ''), '[\\\\x09-\\\\x0D\\\\x20]+'), x -> x != ''))").cast("long").alias("size"),
                        F.xxhash64("text", F.lit(seed)).alias("_key"))
    sized = stored(sized, "sizes")
    sums = sized.groupBy("pattern").agg(F.sum("size").alias("size"))
    if not small_enough(sums, MOST_PATTERNS):
        raise ValueError(f"more than {MOST_PATTERNS} patterns of sources")
    capacity = {tuple(r.pattern): r["size"] for r in sums.collect()}
    held: dict = {}
    for p, n in capacity.items():
        for s in p:
            held[s] = held.get(s, 0) + n
    target = targets(held, sum(capacity.values()), weights, share, most)
    goals = routed(capacity, {s: int(t + Fraction(1, 2)) for s, t in target.items()}, most)
    wanted = spark.createDataFrame([(list(p), g) for p, g in goals.items()], "pattern array<string>, goal long")
    facts = spark.createDataFrame([(s, held[s], float(target[s])) for s in held], "_s string, source_size long, target double")
    got = selected(sized, wanted)
    # One row per source, at most MOST_PATTERNS.
    return (got.join(F.broadcast(facts), F.get("pattern", F.lit(0)).eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "pattern", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "_key"))
