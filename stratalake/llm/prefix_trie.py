"""The trie of conversations: one node per distinct beginning, with counts over its members and its subtree.

A turn is known by the SHA-256 of its role and text, cut to 128 bits, and by the number of its words; texts are not shuffled. A
conversation is the row of its turns. The rows are dealt into shards by range, of their first turns and then their id, so that
a beginning shared by any number of conversations is split like any other range. A shard is a matrix of
turn ids, padded in blocks of ``BLOCK`` columns that only rows reaching them take part in. It is put in order with lexsort. At each depth a
node starts where its parent does or its column changes, and reduceat gives its members, ends and children.

Nodes that may go on in a neighbouring shard, those of a shard's first and last row, are emitted as partial sums under
the hash of their turns and recombined: sums by node, then each node's own share in its subtree's sums is carried up
once, within one of the shards that hold it.

Conversations without turns belong to the root alone. Rows with a null id belong to no conversation. Turns go by ``turn``, null first, and
among equal turns by the hash of role and text; repeated rows are turns like others. Null roles and texts are empty. Without conversations
there are no nodes, not even a root. Other columns do not matter, whatever their names.

What one task must hold: a shard (some 250,000 turns, or one longer conversation) and a conversation, 40 bytes a turn. The ends of
a node are hashed in one stream, since SHA-256 has no other way, but in packed lists of 50,000 ids, never as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import store

TURNS_PER_SHARD, LEAST_TURNS = 250_000, 5_000
#: Turns by which shards are cut, and columns of a block of the matrix.
KEY_TURNS, BLOCK = 4, 8
IDS_PER_LIST = 50_000
_ROWS = 50_000
_WORDS = "[^\\x20\\x09-\\x0D]+"
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_INNER, _EDGE, _ENDS = 0, 1, 2
_SCHEMA = (
    "kind int, shard int, key binary, parent_key binary, depth bigint, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, words bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)
_ARROW = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary())]
    + [(c, pa.int64()) for c in _SCHEMA.replace(" bigint", "").split(", ")[4:12]]
    + [("ends", pa.string())]
)


def sequences(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id`` and its ``turns`` in order, each an ``id`` of 16 bytes and its ``words``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            # the hash of the role has a fixed length, so no other role and text give the same string
            F.unhex(F.substring(F.sha2(F.concat(F.sha2(role, 256), text), 256), 1, 32)).alias("id"),
            F.regexp_count(text, F.lit(_WORDS)).alias("words"),
        ).alias("turn"),
    ).where("conv_id is not null")
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"], t["words"])).alias("turns"))


def with_shared_heads(rows: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of a common one: c takes them from c - c % ``every``, h = crc32(c) % ``most``."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    heads = rows.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head")
    )
    joined = rows.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % every).join(heads, "head_id", "left")
    own = F.expr("slice(turns, h + 1, size(turns))")
    first = F.expr("coalesce(slice(head, 1, h), slice(turns, 1, 0))")
    return joined.withColumn("h", h).select("conv_id", F.concat(first, own).alias("turns"))


def _in_order(conv: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The rows by their turns, a shorter one before those it begins, and then by conversation.

    Blocks of columns are ranked from the last to the first; padding is zero, which no hash is.
    """
    lengths = np.diff(offsets)
    rank = np.full(len(conv), -1)
    deepest = int(lengths.max(initial=0))
    for start in range((deepest - 1) // BLOCK * BLOCK, -1, -BLOCK):
        rows = np.flatnonzero(lengths > start)
        width = min(BLOCK, deepest - start)
        place = offsets[rows, None] + start + np.arange(width)
        real = place < offsets[rows + 1, None]
        matrix = np.where(real[..., None], ids[np.minimum(place, len(ids) - 1)], 0)
        columns = (matrix[:, j, half] for j in range(width - 1, -1, -1) for half in (1, 0))
        order = np.lexsort([conv[rows], rank[rows], *columns])
        # a row that ends before this block stays below all that reach it
        rank[:] = -1
        rank[rows[order]] = np.arange(len(rows))
    return np.lexsort([conv, rank])


class _Shard:
    """The nodes of one shard, parents before children."""

    def __init__(self, conv: np.ndarray, offsets: np.ndarray, ids: np.ndarray, words: np.ndarray):
        order = _in_order(conv, offsets, ids)
        conv, begins, lengths = conv[order], offsets[:-1][order], np.diff(offsets)[order]
        rows, node = np.arange(len(conv)), np.zeros(len(conv), np.int64)
        none = np.zeros(1, np.int64)
        columns = [[none - 1], [none], [conv.min(keepdims=True)], [none + len(conv)], [none], [none == 0], [none]]
        enders = [(np.flatnonzero(lengths == 0), none, np.array([(lengths == 0).sum()]))]
        nodes, depth = 1, 0
        self.levels = [(0, 1)]
        while (live := lengths[rows] > depth).any():
            rows, node = rows[live], node[live]
            turn = begins[rows] + depth
            depth += 1
            starts = np.ones(len(rows), bool)
            starts[1:] = (node[1:] != node[:-1]) | (ids[turn[1:]] != ids[turn[:-1]]).any(axis=1)
            at = np.flatnonzero(starts)
            parent = node[at]
            if depth <= KEY_TURNS:
                edge = np.zeros(len(at), bool)
                edge[0] |= rows[0] == 0
                edge[-1] |= rows[-1] == len(conv) - 1
            else:
                edge = columns[5][-1][parent - self.levels[-1][0]]
            ends = lengths[rows] == depth
            found = (
                parent,
                np.full(len(at), depth),
                np.minimum.reduceat(conv[rows], at),
                np.diff(at, append=len(rows)),
                words[turn[at]],
                edge,
                turn[at],
            )
            for column, values in zip(columns, found, strict=True):
                column.append(values)
            enders.append((rows[ends], np.arange(nodes, nodes + len(at)), np.add.reduceat(ends.astype(np.int64), at)))
            node = nodes + np.cumsum(starts) - 1
            self.levels.append((nodes, nodes + len(at)))
            nodes += len(at)
        self.parent, self.depth, self.conv, self.members, self.words, self.edge, self.turn = map(np.concatenate, columns)
        self.ids, self.enders, self.sorted_conv = ids, enders, conv

    def below(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children, leaves of the subtree and tokens saved in it, without what edge nodes are themselves."""
        inner = ~self.edge
        children = np.bincount(self.parent[1:][inner[1:]], minlength=len(self.parent))
        leaves = ((children == 0) & inner).astype(np.int64)
        saved = np.where(inner, (self.members - 1) * self.words, 0)
        for first, last in reversed(self.levels[1:]):
            up = self.parent[first:last]
            at = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
            for sums in (leaves, saved):
                sums[up[at]] += np.add.reduceat(sums[first:last], at)
        return children, leaves, saved

    def keys(self) -> dict[int, bytes]:
        """The hash of all turns of each edge node."""
        states = {}
        for node in np.flatnonzero(self.edge).tolist():
            state = states[self.parent[node]].copy() if node else hashlib.sha256()
            if node:
                state.update(self.ids[self.turn[node]].tobytes())
            states[node] = state
        return {node: state.digest()[:16] for node, state in states.items()}

    def ends(self) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes at which conversations end, and these in order."""
        for rows, nodes, counts in self.enders:
            lists = np.split(self.sorted_conv[rows], np.cumsum(counts)[:-1])
            yield from ((int(n), x) for n, x in zip(nodes, lists, strict=True) if len(x))


def _text(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _batches(shard: int, nodes: _Shard) -> Iterator[pa.RecordBatch]:
    children, leaves, saved = nodes.below()
    keys = nodes.keys()
    ends = np.full(len(nodes.parent), _NO_ENDS, object)
    lists = []
    for node, ids in nodes.ends():
        if nodes.edge[node]:
            lists += [(node, ids[i : i + IDS_PER_LIST]) for i in range(0, len(ids), IDS_PER_LIST)]
        else:
            ends[node] = hashlib.sha256(_text(ids).encode()).hexdigest()
    parent_edge = np.zeros(len(ends), bool)
    parent_edge[1:] = nodes.edge[nodes.parent[1:]]
    for a in range(0, len(ends), _ROWS):
        cut = slice(a, a + _ROWS)
        n = len(ends[cut])
        edge, up = nodes.edge[cut], nodes.parent[cut]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(edge.astype(np.int32)),  # _EDGE or _INNER
                pa.array(np.full(n, shard, np.int32)),
                pa.array([keys.get(i) for i in range(a, a + n)], pa.binary()),
                pa.array([keys.get(i) for i in up.tolist()], pa.binary()),
                pa.array(nodes.depth[cut]),
                pa.array(nodes.conv[cut]),
                pa.array(nodes.conv[up], mask=parent_edge[cut] | (up < 0)),
                *(pa.array(x[cut].astype(np.int64)) for x in (nodes.members, nodes.words, children, leaves, saved)),
                pa.array(ends[cut], pa.string(), mask=edge),
            ],
            schema=_ARROW,
        )
    for node, ids in lists:
        row = dict.fromkeys(_ARROW.names) | {"kind": _ENDS, "shard": shard, "key": keys[node]}
        yield pa.RecordBatch.from_pylist([row | {"conv_id": int(ids[0]), "ends": _text(ids)}], schema=_ARROW)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    conv = table.column("conv_id").to_numpy()
    turns = table.column("ids").combine_chunks()
    offsets = turns.offsets.to_numpy().astype(np.int64)
    flat = turns.flatten().cast(pa.large_binary())
    ids = np.zeros((0, 2), np.uint64)
    if len(flat):
        first = int(np.frombuffer(flat.buffers()[1], np.int64)[flat.offset])
        raw = np.frombuffer(flat.buffers()[2], np.uint8)[first : first + 16 * len(flat)]
        ids = raw.view(">u8").astype(np.uint64).reshape(-1, 2)
    words = table.column("words").combine_chunks().flatten().to_numpy().astype(np.int64)
    yield from _batches(TaskContext.get().partitionId(), _Shard(conv, offsets - offsets[0], ids, words))


def _carried_up(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over each edge node's subtree of what is counted in this shard."""
    rows = rows.sort_values("depth", ascending=False, kind="stable")
    sums = {k: [a, b] for k, a, b in zip(rows["key"], rows["leaf"], rows["saved"], strict=True)}
    for key, parent in zip(rows["key"], rows["parent_key"], strict=True):
        if parent is not None:
            sums[parent][0] += sums[key][0]
            sums[parent][1] += sums[key][1]
    return pd.DataFrame(
        {"key": list(sums), "leaves": [x[0] for x in sums.values()], "saved": [x[1] for x in sums.values()]}
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key over its lists, which come sorted; holds a list at a time."""
    key, state, done = None, None, []
    for batch in batches:
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if k != key:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_py().encode())
    if state:
        done.append((key, state.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["key", "ends"]
    )


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie of ``rows`` (``conv_id``, unique, and ``turns`` as :func:`sequences` gives them).

    Per node: ``conv_id``, its smallest member; ``depth``; ``parent_conv_id``, that of its parent (null for the root); ``n_convs``
    members; ``n_children``; ``n_leaves``, childless nodes of the subtree; ``saved_tokens``, summed over the subtree, the members
    but one times the words of the node's last turn; ``ends_sha256`` of the members that end here, ascending.
    """
    spark = rows.sparkSession
    rows = store(rows.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words")), "sequences")
    total = rows.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    most = min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // LEAST_TURNS)
    shards = max(1, most, -(-total // TURNS_PER_SHARD))
    dealt = rows.repartitionByRange(shards, F.slice("ids", 1, KEY_TURNS), "conv_id")
    parts = store(dealt.mapInArrow(_shards, _SCHEMA), "nodes")

    pieces = parts.where(F.col("kind") == _EDGE)
    merged = pieces.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.first("words").alias("words"),
        *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
        F.min("shard").alias("counted_in"),
    )
    among = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("edges"))
    merged = merged.join(among, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("edges", F.lit(0)))
    merged = store(merged.drop("edges"), "edges")

    own = merged.select(
        "key", "counted_in", (F.col("n_children") == 0).cast("long").alias("leaf"), F.expr("(n_convs - 1) * words").alias("saved")
    )
    counted = pieces.select("shard", "key", "parent_key", "depth").join(own, "key")
    here = F.col("shard") == F.col("counted_in")
    counted = counted.select(
        "shard", "key", "parent_key", "depth", *(F.when(here, F.col(c)).otherwise(0).alias(c) for c in ("leaf", "saved"))
    )
    carried = (
        counted.groupBy("shard")
        .applyInPandas(_carried_up, "key binary, leaves bigint, saved bigint")
        .groupBy("key")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    lists = parts.where(F.col("kind") == _ENDS).select("key", "ends", "conv_id")
    ends = lists.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digests, "key binary, ends string")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("known_conv_id"))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    edges = (
        merged.join(carried, "key")
        .join(ends, "key", "left")
        .join(parents, "parent_key", "left")
        .withColumns(
            {
                "parent_conv_id": F.col("known_conv_id"),
                "n_leaves": F.col("n_leaves") + F.col("leaves"),
                "saved_tokens": F.col("saved_tokens") + F.col("saved"),
                "ends_sha256": F.coalesce("ends", F.lit(_NO_ENDS)),
            }
        )
    )
    inner = parts.where(F.col("kind") == _INNER).withColumnRenamed("ends", "ends_sha256")
    # only children of edge nodes look for their parent elsewhere
    hung = inner.where("parent_key is not null").join(parents, "parent_key", "left")
    hung = hung.withColumn("parent_conv_id", F.col("known_conv_id"))
    whole = inner.where("parent_key is null")
    return edges.select(*columns).unionByName(hung.select(*columns)).unionByName(whole.select(*columns))
