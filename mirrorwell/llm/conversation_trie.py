"""The trie of all conversations' turns, built as a burst trie.

A turn is known by a digest of its role and text, a conversation by the digests of its turns
end to end: its path. Equal conversations are one path with many members. Containers hold
paths under a trie head. The root's container holds all; one too large is burst by the ids
of the next turns, which makes a container for each child, until all are small. Shards hold
whole containers, sorted; a sweep over neighbours turns each into nodes. Nodes at or above
the heads are summed from what the containers tell about themselves.

Texts do not move: only digests and lengths of turns are gathered by conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, text_of

#: Bytes of a turn's id, and of the paths one container holds at most, but for a single path.
ID_BYTES = 16
CONTAINER_BYTES = 8 << 20
#: Rows a sweep gives back at a time.
OUT_ROWS = 50_000
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")
NO_ENDS = hashlib.sha256(b"").hexdigest()
_HEADS = "path binary, lens array<long>, conv_id long, n_convs long, n_children long, leaves long, saved long, ends string"


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of a SHA-256 over role and text, told apart by the role's length."""
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(told, 256), 1, 2 * ID_BYTES)


def turn_lists(turns: DataFrame) -> DataFrame:
    """``(conv_id, ids, lens)``: ids and text lengths of each conversation's turns, in order."""
    role, text = text_of("role"), text_of("text")
    told = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"), role.alias("role"),
                 turn_id(role, text).alias("id"), F.char_length(text).cast("long").alias("len")).alias("t"))
    lists = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.col("t.id").alias("ids"), F.col("t.len").alias("lens"))


def paths_of(lists: DataFrame) -> DataFrame:
    """``(conv_id, path, lens)`` of conversations as they are."""
    return lists.select("conv_id", F.unhex(F.array_join("ids", "")).alias("path"), "lens")


def shared_openings(lists: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``lists`` rebuilt: the first h turns come from conversation ``conv_id - conv_id % every``,
    with h the CRC-32 of the conv_id's decimal digits modulo ``most``; its own turns follow from
    the (h + 1)th on. ``%`` has the sign of the conv_id, as in SQL."""
    bases = lists.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"),
        *(F.slice(c, 1, most - 1).alias(f"base_{c}") for c in ("ids", "lens")))
    given = lists.withColumn("base", F.expr(f"conv_id - conv_id % {every}")).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    met = given.join(bases, "base", "left")

    def put(column: str) -> Column:
        head = F.when(F.col("h") > 0, F.slice(F.coalesce(f"base_{column}", F.array().cast(f"array<{kinds[column]}>")),
                                              1, F.greatest("h", F.lit(1)))).otherwise(
            F.array().cast(f"array<{kinds[column]}>"))
        tail = F.slice(column, F.col("h") + 1, F.greatest(F.size(column), F.lit(1)))
        return F.concat(head, tail).alias(column)

    kinds = {"ids": "string", "lens": "bigint"}
    return met.select("conv_id", put("ids"), put("lens"))


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a path come one after the other, by conv_id: their digest is taken as they
    come, so a path of any number of members is one running state."""
    key, digest, first, count = None, None, 0, 0

    def done() -> tuple:
        return key, first, count, digest.hexdigest()

    for batch in batches:
        out = []
        keys = batch.column("key").to_pylist()
        ids = np.asarray(batch.column("conv_id"))
        turns = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
        for a, b in zip(turns, turns[1:]):
            said = ",".join(map(str, ids[a:b].tolist())).encode()
            if key == keys[a]:
                digest.update(b"," + said)
                count += b - a
                continue
            if key is not None:
                out.append(done())
            key, digest, first, count = keys[a], hashlib.sha256(said), int(ids[a]), b - a
        yield _columns(out, (pa.binary(), pa.int64(), pa.int64(), pa.string()), ("key", "conv_id", "n_convs", "ends"))
    if key is not None:
        yield _columns([done()], (pa.binary(), pa.int64(), pa.int64(), pa.string()),
                       ("key", "conv_id", "n_convs", "ends"))


def _columns(rows: list[tuple], kinds, names) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(names))


def sweep(rows: list[tuple], depth: int) -> tuple[list[tuple], tuple]:
    """Nodes below a head at ``depth`` from its container: ``(path, lens, conv_id, n_convs,
    ends)`` sorted by path. Also ``(conv_id, n_convs, n_children, leaves, saved, ends)`` of the
    head, whose leaves and savings are those below it.

    Neighbours share the nodes of their common prefix: those of the last path that the next
    one leaves are complete, and are told with their parent's smallest member once that is.
    """
    nodes: list[list] = []  # conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends
    # the open path: its nodes' places in ``nodes``, the head first
    head = [None, depth, -1, 0, 0, 0, 0, NO_ENDS]
    nodes.append(head)
    stack, before, sizes = [0], b"", ()

    def close(to: int) -> None:
        while len(stack) - 1 > to:
            node = nodes[stack.pop()]
            if node[4] == 0:
                node[5] = 1
            node[6] += (node[3] - 1) * sizes[node[1] - 1]
            parent = nodes[stack[-1]]
            parent[4] += 1
            parent[5] += node[5]
            parent[6] += node[6]
            parent[3] += node[3]
            parent[0] = node[0] if parent[0] is None else min(parent[0], node[0])

    for path, lens, conv, count, ends in rows:
        turns = len(path) // ID_BYTES
        same, most = depth, min(len(before) // ID_BYTES, turns)
        while same < most and path[same * ID_BYTES:(same + 1) * ID_BYTES] == before[same * ID_BYTES:(same + 1) * ID_BYTES]:
            same += 1
        close(same - depth)
        before, sizes = path, lens
        for at in range(same + 1, turns + 1):
            nodes.append([None, at, stack[-1], 0, 0, 0, 0, NO_ENDS])
            stack.append(len(nodes) - 1)
        last = nodes[stack[-1]]
        last[0] = conv if last[0] is None else min(last[0], conv)
        last[3] += count
        last[7] = ends
    close(0)
    found = [(n[0], n[1], nodes[n[2]][0], *n[3:]) for n in nodes[1:]]
    return found, (head[0], head[3], head[4], head[5], head[6], head[7])


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers of a shard, and a row about each container's head."""
    kinds = (pa.int64(),) * 7 + (pa.string(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
             "ends_sha256", "path", "lens", "leaves", "saved")
    rows: list[tuple] = []
    head, depth = None, 0
    out: list[tuple] = []

    def finish() -> None:
        found, told = sweep(rows, depth)
        out.extend((*n, None, None, None, None) for n in found)
        conv, count, children, leaves, saved, ends = told
        out.append((conv, None, None, count, children, None, None, ends, head, rows[0][1][:depth], leaves, saved))

    for batch in batches:
        # everything moves in Arrow but the few values a sweep looks at
        cols = [batch.column(c).to_pylist() for c in ("head", "path", "lens", "conv_id", "n_convs", "ends")]
        for h, *row in zip(*cols):
            if h != head and rows:
                finish()
                rows = []
                if len(out) >= OUT_ROWS:
                    yield _columns(out, kinds, names)
                    out.clear()
            head, depth = h, len(h) // ID_BYTES
            rows.append(tuple(row))
    if rows:
        finish()
    if out:
        yield _columns(out, kinds, names)


def _prefix(depth: Column | int) -> Column:
    """The first ``depth`` turns of a path, the whole path if it has fewer."""
    return F.substring(F.col("path"), F.lit(1), F.lit(ID_BYTES) * depth)


def containers(classes: DataFrame, scratch: Scratch, most: int = CONTAINER_BYTES) -> DataFrame:
    """``classes`` (with ``path``) and the ``head`` of the container each is in.

    Containers of more than ``most`` bytes of paths burst by the next turn, those still too
    large by the next two, four and so on, so a long prefix that many share takes few
    rounds. Sizes are summed where paths are read; a round reads what is still open.
    """
    weight = F.octet_length("path") + 64
    still, depth, step, number = classes, 0, 1, 0
    placed: DataFrame | None = None
    while True:
        large = still.groupBy(F.md5(_prefix(F.lit(depth))).alias("_key")).agg(
            F.sum(weight).alias("_bytes"), F.max(F.octet_length("path")).alias("_longest")).where(
            (F.col("_bytes") > most) & (F.col("_longest") > ID_BYTES * depth)).select("_key")
        large = scratch.keep(large, f"large-{number}")
        sized = still.withColumn("head", _prefix(F.lit(depth)))
        if large.isEmpty():
            return sized if placed is None else placed.unionByName(sized)
        keyed = sized.withColumn("_key", F.md5("head"))
        done = keyed.join(large, "_key", "left_anti").drop("_key")
        placed = done if placed is None else placed.unionByName(done)
        still = scratch.keep(keyed.join(large, "_key", "left_semi").drop("_key", "head"), f"open-{number}")
        depth, step, number = depth + step, step * 2, number + 1


def trie_nodes(paths: DataFrame, most: int = CONTAINER_BYTES) -> DataFrame:
    """The nodes of the trie of ``paths`` (``conv_id, path, lens``, as ``paths_of`` gives them):
    :data:`NODES`, a row to a node, the root with a null parent.

    An empty table has no nodes. A conversation without turns is a member of the root and
    ends there.
    """
    scratch = Scratch(paths.sparkSession, "trie")
    paths = scratch.keep(paths, "paths")
    key = F.unhex(F.substring(F.sha2("path", 256), 1, 2 * ID_BYTES))
    ended = paths.select(key.alias("key"), "conv_id").repartition("key").sortWithinPartitions(
        "key", "conv_id").mapInArrow(_ended, "key binary, conv_id long, n_convs long, ends string")
    ended = scratch.keep(ended.drop("key"), "ended")
    classes = scratch.keep(paths.join(ended, "conv_id"), "classes")
    scratch.drop("paths", "ended")

    shards = containers(classes, scratch, most).repartition("head").sortWithinPartitions("head", "path")
    swept = scratch.keep(shards.select("head", "path", "lens", "conv_id", "n_convs", "ends").mapInArrow(
        _swept, "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                "saved_tokens long, ends_sha256 string, path binary, lens array<long>, leaves long, saved long"),
        "swept")
    below = swept.where("depth is not null").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                                    "n_leaves", "saved_tokens", "ends_sha256")
    return below.unionByName(_upper_nodes(swept.where("depth is null"), scratch))


def _upper_nodes(heads: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes at the heads and above, from what each container tells about its head."""
    turns = (F.octet_length("path") / ID_BYTES).cast("int")
    up = heads.select("*", F.explode(F.sequence(F.lit(0), turns)).alias("at")).withColumn(
        "own", F.col("at") == turns)
    node = _prefix(F.col("at")).alias("node")
    top = up.groupBy(node, "at").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum(F.when(F.col("own"), F.col("n_children")).otherwise(0)).alias("below"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max(F.when(F.col("own"), F.col("ends_sha256"))).alias("ends"),
        F.any_value(F.when(F.col("at") > 0, F.try_element_at("lens", F.greatest("at", F.lit(1)))).otherwise(0)).alias("len"))
    top = scratch.keep(top, "top")
    parent = F.substring("node", F.lit(1), ID_BYTES * (F.col("at") - 1)).alias("node")
    children = scratch.keep(top.where("at > 0").groupBy(parent).agg(F.count("*").alias("children")), "children")
    top = scratch.keep(top.join(children, "node", "left").withColumn(
        "n_children", F.col("below") + F.coalesce("children", F.lit(0))).drop("below", "children"), "top-children")
    # what each of these nodes adds to those it hangs under, itself included
    own = top.select(
        F.col("node").alias("path"), "at", ((F.col("n_convs") - 1) * F.col("len")).alias("own_saved"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).alias("own_leaf"))
    own = own.select("path", "own_saved", "own_leaf", F.explode(F.sequence(F.lit(0), "at")).alias("to"))
    own = own.select("own_saved", "own_leaf", _prefix(F.col("to")).alias("node"))
    sums = scratch.keep(own.groupBy("node").agg(
        F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaves")), "top-sums")
    over = top.select("node", F.col("conv_id").alias("parent_conv_id")).withColumnRenamed("node", "over")
    over = scratch.keep(over, "top-parents")
    found = top.join(sums, "node").withColumn(
        "over", F.when(F.col("at") > 0, F.substring("node", F.lit(1), ID_BYTES * (F.col("at") - 1))))
    return found.join(over, "over", "left").select(
        "conv_id", F.col("at").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves") + F.col("own_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, openings: bool = False, most: int = CONTAINER_BYTES) -> DataFrame:
    """The trie of the conversations in ``turns`` (``conv_id, turn, role, text``): :data:`NODES`.

    Turns go by ``turn``, null first, then by role and by the digest of role and text; a
    repeated row is a turn of its own. Null role or text is empty. A row without conv_id
    belongs to no conversation. Other columns are not read. With ``openings`` conversations
    are first rebuilt as :func:`shared_openings` says. An empty table has no nodes.

    ``(conv_id, depth)`` names a node: its smallest member and how many turns it stands for.
    A task holds one conversation's digests (24 bytes a turn), or one container's.
    """
    lists = turn_lists(turns)
    if openings:
        scratch = Scratch(turns.sparkSession, "conversations")
        lists = shared_openings(scratch.keep(lists, "lists"))
    return trie_nodes(paths_of(lists), most)
