"""Prefix trie of conversations from vertical bitmaps.

Conversations are dealt to shards by ranges of conv_id. A shard numbers its
conversations and indexes them vertically: for every (position, turn) a bitset
of the conversations that have that turn there, and for every length a bitset
of those that end there. A depth-first walk from the bitset of all its conversations intersects the
parent's bitset with the posting of the first remaining member's next turn:
that is a child, and its members leave the remainder. Popcounts, the smallest
member and the list of ends are read off the bitsets.

Nodes of different shards are the same node when their paths are equal (a
128-bit hash chained over the turns). Each node is owned by the shard that has its smallest
conv_id. Counts of members add up over shards; what must be counted once
(children, childless nodes, the bytes of a turn) is counted by the owner. So
subtree sums are made inside each shard, by one pass over its nodes in
depth-first order, and added up: four shuffles of node rows whatever the depth, and a node that a third of all
conversations share is one row per shard, not one per conversation.

The digest of the conversations that end in a node needs their ids in one
sequence: lists of ends come sorted by shard and go through the hash as a
stream, so a node with many ends costs time in one task but no memory.

Edge cases: rows without conv_id belong to no conversation; null role and text
are empty, a null turn comes first; turns of equal number are ordered by role,
then by hash of the text, and repeated rows are repeated turns; a rebuilt
conversation without turns ends in the root; an empty table gives no node, not even a root. Other columns are
not read. A task holds the turn hashes (not the texts) of one shard, about
``SHARD_ROWS`` turns, or of one longer conversation.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384
GROUP = 5
LARGEST_PREFIX = 9
ROOT = bytes(16)
BATCH = 8_192

NODES = "path binary, shard long, seq long, depth long, n long, first long, bytes long, child boolean, ends binary"
SHARES = "conv_id long, depth long, parent_conv_id long, first long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"
TRIE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, base (the smallest conv_id that it can take turns from), turn, role, id (16 bytes), bytes."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    c = F.col("conv_id").cast("long")
    return conversations.where(c.isNotNull()).select(
        c.alias("conv_id"),
        (c - c % GROUP).alias("base"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def rebuilt(own: dict[int, list[int]]) -> Iterator[tuple[int, list[int]]]:
    """Conversations of whole groups, ascending: the first h turns of the group's base, then the own ones after h."""
    for c in sorted(own):
        base = c - int(math.fmod(c, GROUP))
        h = zlib.crc32(str(c).encode()) % LARGEST_PREFIX
        yield c, own[c] if base == c else own.get(base, [])[:h] + own[c][h:]


def walk(ids: list[int], turns: list[list[int]], names: list[bytes], sizes: list[int]) -> Iterator[tuple]:
    """Nodes of one shard in depth-first order: (path, depth, members, smallest, bytes of the last turn, has child, ends)."""
    postings: dict[tuple[int, int], int] = {}
    ending: dict[int, int] = {}
    for i, seq in enumerate(turns):
        bit = 1 << i
        for p, t in enumerate(seq):
            postings[p, t] = postings.get((p, t), 0) | bit
        ending[len(seq)] = ending.get(len(seq), 0) | bit
    stack = [(ROOT, 0, (1 << len(ids)) - 1, -1)]
    while stack:
        path, depth, members, turn = stack.pop()
        ends = members & ending.get(depth, 0)
        rest = members ^ ends
        low = (members & -members).bit_length() - 1
        yield path, depth, members.bit_count(), ids[low], sizes[turn] if depth else 0, rest != 0, [ids[i] for i in bits(ends)]
        children = []
        while rest:
            t = turns[(rest & -rest).bit_length() - 1][depth]
            child = rest & postings[depth, t]
            children.append((hashlib.blake2b(path + names[t], digest_size=16).digest(), depth + 1, child, t))
            rest ^= child
        stack.extend(reversed(children))


def bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _local_nodes(batches):
    number: dict[bytes, int] = {}
    names: list[bytes] = []
    sizes: list[int] = []
    own: dict[int, list[int]] = {}
    for batch in batches:
        for c, t, n in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "id", "bytes"))):
            k = number.get(t)
            if k is None:
                k = number[t] = len(names)
                names.append(t)
                sizes.append(n)
            own.setdefault(c, []).append(k)
    if not own:
        return
    shard = TaskContext.get().partitionId()
    ids, turns = map(list, zip(*rebuilt(own)))
    rows = []
    for seq, (path, depth, n, first, size, child, ends) in enumerate(walk(ids, turns, names, sizes)):
        rows.append((path, shard, seq, depth, n, first, size, child, np.array(ends, "<i8").tobytes() if ends else None))
        if len(rows) == BATCH:
            yield _batch(rows, _NODES)
            rows = []
    yield _batch(rows, _NODES)


_KIND = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def _fields(schema: str) -> pa.Schema:
    return pa.schema([(x.split()[0], _KIND[x.split()[1]]) for x in schema.split(", ")])


_NODES, _SHARES, _TRIE = map(_fields, (NODES, SHARES, TRIE))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def shares_of(nodes: list[dict]) -> list[tuple]:
    """What one shard adds to its nodes, given in depth-first order with conv_id, n_convs, leaf and first."""
    parents, above = [], []
    for v in nodes:
        del above[v["depth"] :]
        parents.append(above[-1] if above else None)
        above.append(v["conv_id"])
    out = []
    # per depth: children, leaves and saved tokens of the subtrees since the last node above that depth
    sums: list[list[int]] = []
    for v, parent in zip(reversed(nodes), reversed(parents)):
        d = v["depth"]
        while len(sums) < d + 2:
            sums.append([0, 0, 0])
        owner = v["first"] == v["conv_id"]
        children, leaves, saved = sums[d + 1]
        sums[d + 1] = [0, 0, 0]
        leaves += owner and v["leaf"]
        saved += (v["n"] - owner) * v["bytes"]
        own = sums[d]
        own[0] += owner
        own[1] += leaves
        own[2] += saved
        out.append((v["conv_id"], d, parent, v["first"], v["n_convs"], children, leaves, saved, v["ends"]))
    return out


def _shares(batches):
    shard, held = None, []
    for batch in batches:
        for v in batch.to_pylist():
            if v["shard"] != shard and held:
                yield from _sliced(shares_of(held))
                held = []
            shard = v["shard"]
            held.append(v)
    if held:
        yield from _sliced(shares_of(held))


def _sliced(rows: list[tuple]):
    for a in range(0, len(rows), BATCH):
        yield _batch(rows[a : a + BATCH], _SHARES)


def _summed(batches):
    """Rows of one node follow each other, by shard; the ids of its ends pass through the digest."""
    key, sums, digest, empty, rows = None, None, None, True, []
    for batch in batches:
        for c, depth, parent, _, n_convs, children, leaves, saved, ends in zip(*(x.to_pylist() for x in batch.columns)):
            if (c, depth) != key:
                if key:
                    rows.append((*key, *sums, digest.hexdigest()))
                    if len(rows) == BATCH:
                        yield _batch(rows, _TRIE)
                        rows = []
                key, sums, digest, empty = (c, depth), [parent, n_convs, 0, 0, 0], hashlib.sha256(), True
            sums[2] += children
            sums[3] += leaves
            sums[4] += saved
            if ends:
                digest.update((("" if empty else ",") + ",".join(map(str, np.frombuffer(ends, "<i8").tolist()))).encode())
                empty = False
    if key:
        rows.append((*key, *sums, digest.hexdigest()))
    yield _batch(rows, _TRIE)


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; columns as in ``TRIE``."""
    turns = turn_rows(conversations)
    shards = max(1, math.ceil(conversations.count() / shard_rows))
    nodes = (
        turns.repartitionByRange(shards, "base")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "id")
        .select("conv_id", "id", "bytes")
        .mapInArrow(_local_nodes, NODES)
    )
    same = Window.partitionBy("path")
    merged = nodes.select(
        "shard", "seq", "depth", "n", "first", "bytes", "ends",
        F.min("first").over(same).alias("conv_id"),
        F.sum("n").over(same).alias("n_convs"),
        (~F.max("child").over(same)).alias("leaf"),
    )
    shares = merged.repartition("shard").sortWithinPartitions("shard", "seq").mapInArrow(_shares, SHARES)
    return shares.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(_summed, TRIE)
