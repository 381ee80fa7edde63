"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Vectors are dealt to shards by the hash of their id. Each shard is indexed in one task: every vector draws a
top level, level l holds the vectors that reach it. Within a level each vector is linked to near vectors that are
not nearer to one already chosen, and back. A level is one flat array of neighbours, a row of fixed length
per vector. A search walks down greedily and keeps a beam on the lowest level; all queries walk side
by side. The best of each shard are merged, with cosines of the original vectors in double precision.

Vectors of a shard with one direction are one node, however many; behind it stand the rows that any query can need of it, and
those of the nodes found are compared exactly. Where the nearest vectors are all of one tight group, links are chosen among the
whole shard, and a row with more links than room keeps those it chose before those that only lead to it. So large groups of
copies or near copies neither cut the graph nor fill the beam.

Shards have about `per_shard` vectors, so memory and time per task do not depend on the table. Every vector is
indexed, none is sampled.

Results for odd input: vectors that are null, empty, zero, or hold a null or a number that is not finite take no
part, neither as query nor as candidate; vectors of another length than most of the query's shard are compared only with
their like. Ties go to the smaller vec_id. Repeated rows: each is a candidate of its own; a repeated query id is answered for
its first vector. Rows with null vec_id take no part. Fewer candidates than k: all of them. Empty table: no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import stored


#: Vectors whose cosines to the nearest one are all above this are one group, which is no guide to what lies around it.
TIGHT = 0.95


class Graph:
    """The graph of one shard's unit vectors."""

    def __init__(self, unit: np.ndarray, links: int = 16, seed: int = 1, block: int = 512):
        n = len(unit)
        self.unit = unit
        draw = np.random.default_rng(seed).random(n)
        top = np.floor(-np.log(np.maximum(draw, 1e-12)) / math.log(links)).astype(int)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []   # members, neighbours as places within the level
        level = 0
        while True:
            members = np.flatnonzero(top >= level)
            self.levels.append((members, self._linked(unit[members], links * (2 if level == 0 else 1), block)))
            if len(members) <= links or level >= 12 or not (top > level).any():
                break
            level += 1

    @classmethod
    def stored(cls, unit: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> Graph:
        graph = cls.__new__(cls)
        graph.unit, graph.levels = unit, levels
        return graph

    @staticmethod
    def _linked(unit: np.ndarray, width: int, block: int) -> np.ndarray:
        """Neighbours of each row, -1 where there are fewer; links are diverse and go both ways as far as rows have room."""
        n = len(unit)
        reach = min(n - 1, 2 * width)
        if reach < 1:
            return np.full((n, 1), -1, np.int32)
        near = np.empty((n, reach), np.int32)
        for a in range(0, n, block):
            sims = unit[a:a + block] @ unit.T
            sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -np.inf
            part = np.argpartition(-sims, reach - 1, axis=1)[:, :reach]
            order = np.argsort(-np.take_along_axis(sims, part, 1), axis=1, kind="stable")
            near[a:a + block] = np.take_along_axis(part, order, 1)
        keep = np.zeros((n, reach), bool)
        half = width // 2
        own_choice = []            # links that diversity chose
        for a in range(0, n, block):
            rows = near[a:a + block]
            vectors = unit[rows]
            own = np.einsum("rkd,rd->rk", vectors, unit[a:a + block])
            mutual = np.einsum("rid,rjd->rij", vectors, vectors)
            chosen = np.zeros(rows.shape, bool)
            for j in range(reach):
                closer = (mutual[:, j, :] > own[:, j, None]) & chosen
                chosen[:, j] = ~closer.any(axis=1) & (chosen.sum(axis=1) < half)
            # Places that diversity leaves open go to the nearest others.
            spare = np.cumsum(~chosen, axis=1) <= (half - chosen.sum(axis=1))[:, None]
            keep[a:a + block] = chosen | (spare & ~chosen)
            row, rank = np.nonzero(chosen)
            own_choice.append(np.column_stack([row + a, rows[row, rank]]))
            if reach < n - 1:
                tight = np.flatnonzero((chosen.sum(axis=1) <= half // 4) | (mutual[:, 0].min(axis=1) >= TIGHT))
                own_choice.append(Graph._spread(unit, tight + a, half))
        source, rank = np.nonzero(keep)
        chosen = np.unique(np.concatenate(own_choice).astype(np.int64), axis=0)
        forth = np.concatenate([np.column_stack([source, near[source, rank]]), chosen])
        both = np.unique(np.concatenate([forth, forth[:, ::-1]]), axis=0)
        # A row with more links than fit keeps those it chose, then its nearest.
        other = ~np.isin(both[:, 0] * n + both[:, 1], chosen[:, 0] * n + chosen[:, 1])
        sims = np.einsum("ed,ed->e", unit[both[:, 0]], unit[both[:, 1]])
        both = both[np.lexsort((-sims, other, both[:, 0]))]
        begin = np.searchsorted(both[:, 0], np.arange(n))
        place = np.arange(len(both)) - begin[both[:, 0]]
        out = np.full((n, width), -1, np.int32)
        fits = place < width
        out[both[fits, 0], place[fits]] = both[fits, 1]
        return out

    @staticmethod
    def _spread(unit: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
        """Diverse links (row, other) among all vectors: the nearest, then the nearest not nearer to one chosen, and so on."""
        if not len(rows):
            return np.zeros((0, 2), np.int64)
        own = unit[rows] @ unit.T
        left = own.copy()
        left[np.arange(len(rows)), rows] = -np.inf
        found = []
        for _ in range(most):
            at = left.argmax(axis=1)
            some = np.flatnonzero(left[np.arange(len(rows)), at] > -np.inf)
            if not len(some):
                break
            found.append(np.column_stack([rows[some], at[some]]))
            left[unit[at] @ unit.T > own] = -np.inf
            left[np.arange(len(rows)), at] = -np.inf
        return np.concatenate(found)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the places and cosines of up to `beam` vectors, nearest first; -1 where there are fewer."""
        q = len(queries)
        here = np.zeros(q, np.int64)                      # place within the level's members
        for level in range(len(self.levels) - 1, 0, -1):
            members, neighbours = self.levels[level]
            best = np.einsum("qd,qd->q", queries, self.unit[members[here]])
            while True:
                next_ = neighbours[here]
                sims = np.einsum("qkd,qd->qk", self.unit[members[next_]], queries)
                sims[next_ < 0] = -np.inf
                at = sims.argmax(axis=1)
                got = sims[np.arange(q), at]
                better = got > best
                if not better.any():
                    break
                here[better], best[better] = next_[np.arange(q), at][better], got[better]
            here = np.searchsorted(self.levels[level - 1][0], members[here])
        members, neighbours = self.levels[0]
        n, width = neighbours.shape
        beam = min(beam, n)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        seen = np.zeros((q, n), bool)
        ids[:, 0], open_[:, 0] = here, True
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.unit[here])
        seen[np.arange(q), here] = True
        active = np.arange(q)
        while len(active):
            place = np.where(open_[active], sims[active], -np.inf).argmax(axis=1)
            node = ids[active, place]
            open_[active, place] = False
            fresh = neighbours[node]
            new = (fresh >= 0) & ~seen[active[:, None], fresh]
            rows, cols = np.nonzero(new)
            seen[active[rows], fresh[rows, cols]] = True
            got = np.full(fresh.shape, -np.inf, np.float32)
            got[rows, cols] = np.einsum("ed,ed->e", self.unit[fresh[rows, cols]], queries[active[rows]])
            all_ids = np.concatenate([ids[active], np.where(new, fresh, -1)], axis=1)
            all_sims = np.concatenate([sims[active], got], axis=1)
            all_open = np.concatenate([open_[active], new], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            open_[active] = np.take_along_axis(all_open, top, 1)
            active = active[open_[active].any(axis=1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def usable(column: str) -> str:
    """SQL: a vector that is not null, empty or zero and holds finite numbers only."""
    return (f"size({column}) > 0 and not exists({column}, x -> x is null or isnan(x) or abs(x) = double('infinity')) "
            f"and exists({column}, x -> x != 0)")


def units(exact: np.ndarray) -> np.ndarray:
    return (exact / np.linalg.norm(exact, axis=1, keepdims=True)).astype(np.float32)


def nodes(ids: np.ndarray, exact: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, begin): the rows to keep, node after node, and where each node begins; a node has one direction.

    Of rows with equal vectors, whose scores are equal for every query, those of the k + 1 smallest ids are kept, k of each id:
    enough for any query, which leaves out its own id.
    """
    _, node = np.unique(units(exact) + np.float32(0), axis=0, return_inverse=True)
    _, same = np.unique(exact + 0.0, axis=0, return_inverse=True)
    rows = np.lexsort((ids, same.ravel(), node.ravel()))
    node, same, name = node.ravel()[rows], same.ravel()[rows], ids[rows]
    group = np.concatenate([[True], same[1:] != same[:-1]])
    new = group | np.concatenate([[True], name[1:] != name[:-1]])
    at = np.arange(len(rows))
    rank = np.cumsum(new)
    rank -= rank[np.maximum.accumulate(np.where(group, at, 0))]
    keep = (rank <= k) & (at - np.maximum.accumulate(np.where(new, at, 0)) < k)
    node = node[keep]
    return rows[keep], np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))


INDEX = ("shard int, size int, ids binary, vectors binary, begin binary, members array<binary>, neighbours array<binary>")


def index(vectors: DataFrame, per_shard: int, links: int, k: int) -> tuple[DataFrame, int]:
    """One row per shard (and length of vectors): ids and vectors by node, and the neighbour arrays of each level; the number of shards."""
    shards = max(1, -(-vectors.count() // per_shard))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for size, part in pdf.groupby(pdf["v"].map(len)):
            part = part.sort_values("vec_id")
            ids, exact = part["vec_id"].to_numpy(np.int64), np.stack(part["v"].to_numpy())
            kept, begin = nodes(ids, exact, k)
            exact = exact[kept]
            graph = Graph(units(exact[begin]), links)
            rows.append((pdf["shard"].iloc[0], size, ids[kept].tobytes(), exact.tobytes(), begin.astype(np.int64).tobytes(),
                         [m.astype(np.int64).tobytes() for m, _ in graph.levels], [n.tobytes() for _, n in graph.levels]))
        return pd.DataFrame(rows, columns=["shard", "size", "ids", "vectors", "begin", "members", "neighbours"])

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(build, INDEX), "graphs"), shards


def nearest(vectors: DataFrame, query: str, k: int = 5, per_shard: int = 4096, links: int = 16, beam: int = 96,
            query_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors found nearest by cosine to each row that the SQL `query` selects.

    A task searches one shard for at most about `query_block` queries, so neither side of it grows with the table.
    """
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    vectors = vectors.where("vec_id is not null").where(usable("v"))
    graphs, shards = index(vectors, per_shard, links, k)
    asked = stored(vectors.where(query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    # A stated set of queries against all rows, in blocks.
    asked = asked.withColumn("shard", F.explode(F.expr(f"sequence(0, {shards - 1})")))
    graphs = graphs.withColumn("block", F.explode(F.expr(f"sequence(0, {blocks - 1})")))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, best, scores, owners = [], [], [], []
        for row in left.itertuples():
            ask = right[right["v"].map(len) == row.size]
            names = np.frombuffer(row.ids, np.int64)
            exact = np.frombuffer(row.vectors, np.float64).reshape(len(names), row.size)
            norms = np.linalg.norm(exact, axis=1)
            levels = [np.frombuffer(m, np.int64) for m in row.members]
            levels = [(m, np.frombuffer(n, np.int32).reshape(len(m), -1)) for m, n in zip(levels, row.neighbours, strict=True)]
            begin = np.frombuffer(row.begin, np.int64)
            counts = np.diff(begin, append=len(names))
            graph = Graph.stored(units(exact[begin]), levels)
            for a in range(0, len(ask), 256):
                own, x = ask["vec_id"].to_numpy()[a:a + 256], np.stack(ask["v"].to_numpy()[a:a + 256])
                length = np.linalg.norm(x, axis=1)
                at, _ = graph.search((x / length[:, None]).astype(np.float32), beam)
                for i in range(len(x)):
                    found = at[i][at[i] >= 0]
                    many = counts[found]
                    found = np.repeat(begin[found] - np.cumsum(many) + many, many) + np.arange(many.sum())
                    found = found[names[found] != own[i]]
                    # Summed row by row, so that equal vectors have equal scores in every shard.
                    score = (exact[found] * x[i]).sum(axis=1) / (norms[found] * length[i])
                    first = np.lexsort((names[found], -score))[:k]
                    owners.append(np.full(len(first), own[i]))
                    ids.append(names[found][first])
                    scores.append(score[first])
        if not ids:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.DataFrame({"query_id": np.concatenate(owners), "vec_id": np.concatenate(ids), "score": np.concatenate(scores)})

    found = graphs.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        run, "query_id long, vec_id long, score double")
    # At most k rows per query and shard are ranked.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (stored(found, "found").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
