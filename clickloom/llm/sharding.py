"""Sharding by balanced label propagation: linked documents gather in a shard, all shards hold equally many rows.

Documents are linked through hubs, what they share; the query takes the text as a hub. To begin with, the documents of a hub are
put into one shard: hubs that hold more than a 256th of a shard, of which there are few, go one by one, largest first, to the shard with the most room, all
others by sums over blocks to intervals of the room that is left. Then documents move in rounds: each round sums the weight of every (hub,
shard), gives each hub its heaviest shard, and moves documents whose hubs weigh more in another shard than in their own. A
shard takes as many as it has room for, and two full shards exchange as many as wish to go both ways. Ranks come from sums over
blocks, so that no task ranks a whole shard or a whole hub. Documents without links wait and fill the room that is left
at the end, which makes the row counts exact. A hub larger than a shard fills one after another, and one that finds no shard with enough
room is cut. The rounds end when nothing moves, or after `rounds`: links that overlap may gain from further ones.

Law `rows`: counts differ by at most one. Fully in DataFrame functions.

Results for odd input: null text has size 1, crc 0 and no links; empty texts equal each other and are linked. Repeated rows
and equal or null doc_ids: each row has a slot of its own. Fewer rows than shards: some shards are empty. Empty
table: no rows. Columns other than doc_id and text are ignored, unless `hub` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ranked, stored


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row per shard
    return [found.get(s, 0) for s in range(shards)]


def _table(numbers: list[int]) -> Column:
    """Numbers as one literal, an array of longs."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def propagate(state: DataFrame, links: DataFrame, quotas: list[int], rounds: int) -> DataFrame:
    """Move nodes between shards: state (node, shard), links (node, hub, weight); loads stay within the quotas."""
    shards = len(quotas)
    for _ in range(rounds):
        here = links.join(state, "node")
        weight = here.groupBy("hub", "shard").agg(F.sum("weight").alias("w"))
        best = weight.groupBy("hub").agg(F.max(F.struct("w", F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("best"), F.count("*").alias("_in"))
        pull = weight.join(best.where("_in > 1"), "hub").select("hub", "shard", "w", F.col("best.shard").alias("to"), F.col("best.w").alias("to_w"))
        wish = (here.join(pull, ["hub", "shard"]).groupBy("node", "shard", "to")
                .agg(F.sum("w").alias("stay"), F.sum("to_w").alias("go")))
        # Equal weights move towards the hub's choice, which all of its nodes share.
        wish = wish.where("to != shard and go >= stay").groupBy("node", "shard").agg(
            F.max(F.struct("go", F.xxhash64("node", "to").alias("tie"), "to")).alias("m"))
        wish = stored(wish.select("node", "shard", F.col("m.to").alias("to")), "wishes")
        wanted = {(r["shard"], r["to"]): r["n"] for r in wish.groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}  # pairs of shards
        if not wanted:
            break
        room = [q - n for q, n in zip(quotas, _loads(state, shards), strict=True)]
        admit = {(s, t): min(n, wanted.get((t, s), 0)) for (s, t), n in wanted.items()}
        for (s, t), n in sorted(wanted.items()):
            more = min(n - admit[s, t], room[t])
            admit[s, t], room[t] = admit[s, t] + more, room[t] - more
        if not any(admit.values()):
            break
        most = _table([admit.get((s, t), 0) for s in range(shards) for t in range(shards)])
        movers = (ranked(wish, ["shard", "to"], ["node"]).where(F.col("before") < F.get(most, F.col("shard") * shards + F.col("to")))
                  .select("node", "to"))
        state = stored(state.join(movers, "node", "left").select("node", F.coalesce("to", "shard").alias("shard")), "labels")
    return state


def _packed(groups: list[tuple[str, int]], room: list[int]) -> dict[str, list[tuple[int, int]]]:
    """Per group (shard, rows) parts; the largest first to the shard with the most room. Where none has enough, one group is moved or
    two of different sizes are exchanged to make it; where that does not help either, the group is cut. Changes `room`."""
    homes, held = {}, [{} for _ in room]  # per shard: size to names of whole groups

    def put(name: str, n: int, s: int) -> None:
        homes[name] = [(s, n)]
        held[s].setdefault(n, []).append(name)
        room[s] -= n

    def take(n: int, s: int) -> str:
        room[s] += n
        name = held[s][n].pop()
        if not held[s][n]:
            del held[s][n]
        return name

    def make_room(n: int) -> int | None:
        for a in sorted(range(len(room)), key=lambda s: -room[s]):
            lack = n - room[a]
            for b in (b for b, r in enumerate(room) if b != a and r >= lack):
                for x in held[a]:
                    if lack <= x <= room[b]:
                        put(take(x, a), x, b)
                        return a
                    if x - lack in held[b]:
                        there, here = take(x, a), take(x - lack, b)
                        put(there, x, b)
                        put(here, x - lack, a)
                        return a
        return None

    for name, n in sorted(groups, key=lambda x: (-x[1], x[0])):
        fits = [s for s, r in enumerate(room) if r == n] or [max(range(len(room)), key=lambda s: (room[s], -s))]
        home = fits[0] if room[fits[0]] >= n else make_room(n)
        if home is not None:
            put(name, n, home)
            continue
        parts = homes[name] = []
        for s in sorted(range(len(room)), key=lambda s: (-room[s], s)):
            rows = min(n, room[s])
            if rows:
                parts.append((s, rows))
                room[s], n = room[s] - rows, n - rows
    return homes


def _begin(links: DataFrame, quotas: list[int]) -> DataFrame:
    """(node, shard): the nodes of each hub in one shard where it has room; a node of several hubs goes with its largest."""
    shards, fine = len(quotas), max(1, min(quotas) // 256)
    sizes = links.groupBy("hub").agg(F.count("*").alias("n"))
    mine = links.join(sizes, "hub").groupBy("node").agg(F.max(F.struct("n", "hub")).alias("h")).select("node", F.col("h.hub").alias("hub"))
    mine = stored(mine, "nodes-of-hubs")
    groups = stored(mine.groupBy("hub").agg(F.count("*").alias("n")), "hubs")
    big = [(r["hub"], r["n"]) for r in groups.where(F.col("n") > fine).collect()]  # fewer than shards * 256, or 2 a shard
    room = list(quotas)
    homes = _packed(big, room)
    # Small groups: shard s takes those that begin in its interval of the sums, in proportion to its room.
    small = groups.where(F.col("n") <= fine).withColumn("_all", F.lit(0))
    total, free = small.agg(F.sum("n")).first()[0] or 0, max(1, sum(room))
    ends = _table([total * sum(room[:s + 1]) // free for s in range(shards)])
    place = F.least(F.size(F.filter(ends, lambda e: e <= F.col("before"))), F.lit(shards - 1)).cast("int")
    small = ranked(small, ["_all"], ["hub"], weight="n", blocks=8192).select("hub", "n", place.alias("shard"))
    # The last ones of a shard that has no slack may not fit: fewer rows than the largest small group has. They look for room like big ones.
    small = stored(ranked(small, ["shard"], ["hub"], weight="n").withColumn("_fits", F.col("before") + F.col("n") <= F.get(_table(room), F.col("shard")))
                   .select("hub", "n", "shard", "_fits"), "small-hubs")
    for r in small.where("_fits").groupBy("shard").agg(F.sum("n").alias("n")).collect():
        room[r["shard"]] -= r["n"]
    homes |= _packed([(r["hub"], r["n"]) for r in small.where("not _fits").collect()], room)
    found = mine.join(small.where("_fits").select("hub", "shard"), "hub").select("node", "shard")
    if homes:
        rows = ", ".join(f"('{name}', {s}, {sum(n for _, n in parts[:i])}L, {n}L, {len(parts)})" for name, parts in homes.items() for i, (s, n) in enumerate(parts))
        parts = links.sparkSession.sql(f"select * from values {rows} as t(hub, shard, _from, _rows, _parts)")
        whole = mine.join(parts.where("_parts = 1").select("hub", "shard"), "hub").select("node", "shard")
        cut = ranked(mine.join(parts.where("_parts > 1").select("hub").distinct(), "hub", "left_semi"), ["hub"], ["node"])
        cut = cut.join(parts.where("_parts > 1"), "hub").where("before >= _from and before < _from + _rows").select("node", "shard")
        found = found.unionByName(whole).unionByName(cut)
    return found


def shard(docs: DataFrame, shards: int = 16, hub: str = "if(text is null, null, sha2(text, 256))", rounds: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, its rank `node` and text key `_key`.

    hub: SQL for what links documents that have it in common; null links with nothing. slot counts the
    rows of a shard without gaps from 0.
    """
    known = docs.select("doc_id", F.md5(F.expr(hub).cast("string")).alias("hub"), F.xxhash64("doc_id", "text").alias("_key"),
                        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    # The rank is a row number over everything: it names the row, and deals rows evenly to begin with.
    nodes = stored(ranked(known.withColumn("_all", F.lit(0)), ["_all"], ["doc_id", "_key"], blocks=8192)
                   .withColumnRenamed("before", "node").drop("_all"), "nodes")
    total = nodes.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]

    hubs = nodes.where("hub is not null").groupBy("hub").agg(F.count("*").alias("_n")).where("_n > 1").select("hub")
    links = stored(nodes.join(hubs, "hub").select("node", "hub", F.lit(1).alias("weight")), "links")
    state = propagate(stored(_begin(links, quotas), "labels"), links, quotas, rounds)

    # Documents without links, in order of their rank, fill the shards' room: shard s takes the ranks of its interval.
    room = [q - n for q, n in zip(quotas, _loads(state, shards), strict=True)]
    ends = [sum(room[:s + 1]) for s in range(shards)]
    alone = ranked(nodes.join(state, "node", "left_anti").select("node").withColumn("_all", F.lit(0)), ["_all"], ["node"], blocks=8192)
    place = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("before")))
    state = state.unionByName(alone.select("node", place.cast("int").alias("shard")))
    named = nodes.join(state, "node")
    return (ranked(named, ["shard"], ["node"]).select(
        "doc_id", "_key", "node", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("before").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard")))
