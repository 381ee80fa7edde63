"""A trie of conversations: the nodes are the distinct sequences of first turns.

A turn is named by 16 bytes (MD5 of its role and text), a conversation by the bytes of its turns one after another. Equal keys are
counted first. The distinct keys are sorted over the cluster and cut into runs; each run becomes an adaptive radix tree
(`radix_tree`), and only byte depths that are whole turns are nodes of the trie.

A node is complete inside its run unless it lies on the way to the first or the last key of the run: any other run's keys stand before or after.
The nodes on these two ways, at most two keys' worth of turns per run, are added up over runs by Spark, and their subtree sums are
taken by doubling: after i rounds a node knows the sum over descendants less than 2^i levels below, so the rounds grow with the
logarithm of the depth. No task holds more than a run, whatever many conversations have in common.

The ids of conversations that end in a node are hashed as one text. They are sorted over the cluster and joined to pieces of
`PIECE` ids in parallel; one task per node feeds the pieces to the hash one by one, since a hash has to read its text in order.

Results for odd input: null role or text counts as empty. Turns are ordered by turn, null first; ties are ordered by their digest, and each
repeated row is a turn. Rows without conv_id belong to no conversation. Empty table: no rows. Columns other than conv_id, turn, role and
text are ignored. A conversation is one key of 16 bytes a turn and has to fit into a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.barrier import once
from clickloom.llm.common import stored
from clickloom.llm.radix_tree import Tree

#: Bytes that name a turn; keys and bytes of keys per run; ids per piece of a node's list.
WIDTH, RUN_KEYS, RUN_BYTES, PIECE = 16, 20_000, 4 << 20, 8192

NODES = pa.schema([
    ("run", pa.int64()), ("place", pa.int64()), ("up", pa.int64()), ("border", pa.bool_()), ("node", pa.binary()), ("parent", pa.binary()),
    ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("n_words", pa.int64()), ("n_ends", pa.int64()), ("end_id", pa.int64()), ("ends", pa.string())])
NODE_TYPES = ("run long, place long, up long, border boolean, node binary, parent binary, conv_id long, parent_conv_id long, depth long, "
              "n_convs long, n_children long, n_leaves long, saved long, n_words long, n_ends long, end_id long, ends string")


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns in order, each as id (hex) and number of words."""
    role, text = (f"coalesce({c}, '')" for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").selectExpr(
        "cast(conv_id as long) as conv_id",
        f"struct(cast(turn as long) as turn, md5(concat(length({role}), ':', {role}, {text})) as id, "
        f"regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+') as words) as t")
    lists = once(turns.groupBy("conv_id").agg(F.collect_list("t").alias("t")), turns=F.sort_array("t"))
    return lists.selectExpr("conv_id", "transform(turns, t -> struct(t.id as id, t.words as words)) as turns")


def with_shared_heads(lists: DataFrame, every: int = 20) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % every, then their own after their first h;
    h = crc32(c) % 4. A head that does not exist is empty."""
    heads = lists.where(f"conv_id % {every} = 0").selectExpr("conv_id as _base", "slice(turns, 1, 3) as _head")
    own = lists.selectExpr("conv_id", "turns", f"conv_id - conv_id % {every} as _base", "cast(crc32(cast(conv_id as string)) % 4 as int) as _h")
    return own.join(heads, "_base", "left").selectExpr(
        "conv_id", "concat(slice(coalesce(_head, array()), 1, _h), slice(turns, _h + 1, size(turns))) as turns")


def _key(lists: DataFrame) -> DataFrame:
    return lists.selectExpr("conv_id", "unhex(array_join(transform(turns, t -> t.id), '')) as key", "transform(turns, t -> t.words) as words")


def _pieces(most: int):
    """Sorted (digest, conv_id) to rows (digest, first id, ids as text) of at most so many ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, rows = None, [], []
        for batch in batches:
            for digest, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (digest != now or len(ids) == most):
                    rows.append({"digest": now, "first": ids[0], "ids": ",".join(map(str, ids))})
                    ids = []
                now = digest
                ids.append(conv)
            if rows:
                yield pa.RecordBatch.from_pylist(rows)
                rows = []
        if ids:
            yield pa.RecordBatch.from_pylist([{"digest": now, "first": ids[0], "ids": ",".join(map(str, ids))}])
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, first, ids) to (digest, ends): the hash of each digest's pieces, comma-joined, one piece at a time."""
    now, state, rows = None, None, []
    for batch in batches:
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if digest != now:
                if state is not None:
                    rows.append((now, state.hexdigest()))
                now, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(b",")
                state.update(ids.encode())
        if rows:
            yield pa.RecordBatch.from_pydict({"digest": [r[0] for r in rows], "ends": [r[1] for r in rows]})
            rows = []
    if state is not None:
        yield pa.RecordBatch.from_pydict({"digest": [now], "ends": [state.hexdigest()]})


def end_hashes(members: DataFrame, piece: int = PIECE) -> DataFrame:
    """(digest, ends) from (digest, conv_id): SHA-256 of the conv_ids of a digest, ascending and comma-joined."""
    pieces = members.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id").mapInArrow(
        _pieces(piece), "digest string, first long, ids string")
    return pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(_hashed, "digest string, ends string")


def _run(run: int, keys: list[tuple]) -> pa.RecordBatch:
    """All trie nodes of a run of sorted keys (key, words, n, least id, ends)."""
    tree = Tree()
    for row in keys:
        tree.insert(row[0], row)
    first, last = keys[0][0], keys[-1][0]
    border = {id(node): key for key in (first, last) for node in tree.path(key)}

    # Nodes before their children: (node, index of the one above, byte depth above, byte depth of the node's end).
    order, at = [(tree.root, -1, -1, len(tree.root.path))], 0
    while at < len(order):
        node, _, _, end = order[at]
        order.extend((kid, at, end, end + 1 + len(kid.path)) for kid in node.children())
        at += 1
    many, least, some = [0] * at, [None] * at, [None] * at
    for i in range(at - 1, -1, -1):
        node, up = order[i][0], order[i][1]
        if node.value is not None:
            many[i] += node.value[2]
            least[i] = node.value[3] if least[i] is None else min(least[i], node.value[3])
            some[i] = node.value[1]
        if up >= 0:
            many[up] += many[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
            some[up] = some[i]

    # Each node covers the depths after the node above it up to its own end; those at whole turns are trie nodes.
    cells, below, parents = [], [None] * at, []
    for i, (node, up, above, end) in enumerate(order):
        holder = below[up] if up >= 0 else None
        for depth in range(above // WIDTH + 1 if above >= 0 else 0, end // WIDTH + 1):
            ends = node.value if depth * WIDTH == end and node.value is not None else None
            cells.append([holder, id(node) in border, border.get(id(node)), least[i], depth, many[i], some[i][depth - 1] if depth else 0, ends])
            parents.append(holder)
            holder = len(cells) - 1
        below[i] = holder
    kids, leaves, saved = [0] * len(cells), [0] * len(cells), [0] * len(cells)
    for c in range(len(cells) - 1, -1, -1):
        holder, on_border, _, _, _, n, words, _ = cells[c]
        if on_border:  # other runs may add to it: only its complete children count here
            continue
        leaves[c] += not kids[c]
        saved[c] += (n - 1) * words
        if holder is not None:
            kids[holder] += 1
            leaves[holder] += leaves[c]
            saved[holder] += saved[c]

    # The name of a node on the border is the hash of its key, taken forward turn by turn.
    names = {}
    for key in (first, last):
        state = hashlib.md5()
        names[key] = [state.digest()]
        for depth in range(len(key) // WIDTH):
            state.update(key[depth * WIDTH:(depth + 1) * WIDTH])
            names[key].append(state.digest())
    columns = [[] for _ in NODES.names]
    for c, (holder, on_border, key, conv, depth, n, words, ends) in enumerate(cells):
        above = cells[holder] if holder is not None else None
        row = (run, c, holder if above is not None and above[1] else None, on_border, names[key][depth] if on_border else None,
               names[key][depth - 1] if on_border and depth else None, conv, above[3] if above is not None and not above[1] else None, depth, n, kids[c],
               leaves[c], saved[c], words, ends[2] if ends else 0, ends[3] if ends else None, ends[4] if ends else None)
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, NODES.types, strict=True)], schema=NODES)


def _runs(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, keys, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and (len(keys) >= most or size >= RUN_BYTES):
                    yield _run((task << 32) + number, keys)
                    number, keys, size = number + 1, [], 0
                keys.append(row)
                size += len(row[0])
        if keys:
            yield _run((task << 32) + number, keys)
    return run


def _on_borders(nodes: DataFrame) -> DataFrame:
    """The border nodes of all runs as one row each, with their whole counts and subtree sums."""
    seen = nodes.where("border")
    one = stored(seen.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("n_words").alias("n_words"), F.sum("n_ends").alias("n_ends"), F.min("end_id").alias("end_id"),
        F.max("ends").alias("ends")), "border")
    kids = one.where("parent is not null").groupBy(F.col("parent").alias("_up")).agg(F.count("*").alias("_kids"))
    up = one.select(F.col("node").alias("_p"), F.col("conv_id").alias("parent_conv_id"))
    one = one.join(kids, one["node"] == kids["_up"], "left").join(up, F.col("parent") == F.col("_p"), "left").selectExpr(
        "*", "inner + coalesce(_kids, 0) as n_children").drop("_up", "_kids", "_p", "inner")
    one = stored(one.selectExpr("*", "leaves + if(n_children = 0, 1, 0) as own_leaves", "saved + (n_convs - 1) * n_words as own_saved"), "border")

    deepest = one.agg(F.max("depth")).first()[0] or 0
    sums = one.selectExpr("node", "parent as jump", "own_leaves as l", "own_saved as s")
    reach = 1
    while reach <= deepest:
        # l and s: sums over descendants less than `reach` levels below; jump: the node that many levels above.
        far = sums.where("jump is not null")
        add = far.groupBy(F.col("jump").alias("_to")).agg(F.sum("l").alias("_l"), F.sum("s").alias("_s"))
        hop = sums.where("jump is not null").selectExpr("node as _from", "jump as _next")
        sums = sums.join(add, sums["node"] == add["_to"], "left").join(hop, F.col("jump") == F.col("_from"), "left")
        sums = stored(sums.selectExpr("node", "_next as jump", "l + coalesce(_l, 0) as l", "s + coalesce(_s, 0) as s"), "sums")
        reach *= 2
    sums = sums.selectExpr("node as _n", "l as n_leaves", "s as saved_tokens")
    return stored(one.drop("leaves", "saved").join(sums, one["node"] == sums["_n"]).drop("_n"), "border")


def trie(lists: DataFrame, run_keys: int = RUN_KEYS, piece: int = PIECE) -> DataFrame:
    """One row per node from (conv_id, turns) as `turn_lists` gives them: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, n_ends. saved_tokens counts the words that the node's subtree need not repeat."""
    convs = stored(_key(lists).withColumn("digest", F.md5("key")), "keys")
    classes = convs.groupBy("digest", "key", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    ends = end_hashes(convs.select("digest", "conv_id"), piece).withColumnRenamed("digest", "_digest")
    classes = classes.join(ends, F.col("digest") == F.col("_digest")).select("key", "words", "n", "least", "ends")
    nodes = stored(classes.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_runs(run_keys), NODE_TYPES), "nodes")

    border = _on_borders(nodes)
    cut = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "n_ends"]
    # Complete nodes below a border node take its smallest member by the place of that node in their own run.
    places = nodes.where("border").selectExpr("run as _run", "place as _place", "node as _node").join(
        border.selectExpr("node as _name", "conv_id as _conv"), F.col("_node") == F.col("_name")).select("_run", "_place", "_conv")
    inside = nodes.where("not border").withColumnRenamed("saved", "saved_tokens")
    under = inside.where("up is not null").join(places, (F.col("run") == F.col("_run")) & (F.col("up") == F.col("_place")))
    found = inside.where("up is null").select(cut).unionByName(
        under.withColumn("parent_conv_id", F.col("_conv")).select(cut)).unionByName(border.select(cut))
    return found.withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256))).drop("ends")
