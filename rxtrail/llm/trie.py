"""The prefix trie of conversations: union-find over sorted neighbours' common prefixes.

A node is a distinct sequence of first turns. Conversations are sorted by their turns, so a
node's members are neighbours, and every pair of neighbours is an edge as deep as their longest
common prefix. Edges are taken in descending depth; each joins two components, lifts both to its
depth, and the node at that depth, now with the children of both, is a branching node. What a
component passes on the way up are nodes with one child.

**Partitions.** Sorted conversations are cut into ranges by turns and conversation, so a third of
all conversations may be copies of one: their nodes then span many partitions. Each partition
builds its forest alone. Nodes without the partition's first and last conversation are complete.
The others, two paths at most, are all that is left of a forest once it is contracted; they go on
with sums, under a digest of their prefix. Where two partitions meet, the edge between the last
conversation of one and the first of the next is as deep as those two paths are one path: nodes
on it were counted on both sides, which the edge corrects. Paths are merged by digest, with a
partial aggregate like any other.

A conversation is a row of 32-byte digests of its turns, which is also what is sorted, so texts
move no further than their own scan. Members that end at a node are hashed as they come in
sorted order; where a node spans partitions, in chunks that follow one another.

Defined results: turns without a conv_id belong to no conversation and are left out; a null role
or text is empty; a null turn comes first; turns of one number follow each other by digest;
repeated rows are turns of their own; an empty table has no nodes, not even a root; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rxtrail.llm.shared import text_or_empty
from rxtrail.sources.staging import Staging

#: Turns per partition, about; more turns make more partitions.
PARTITION_TURNS = 500_000
#: Conversation ids that are joined to one chunk of a list to be hashed.
CHUNK_IDS = 50_000
#: Paths are given to all tasks up to this many nodes, else joined by shuffles.
BROADCAST_NODES = 200_000


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each as the digest of role and text and the text's bytes."""
    role, text = text_or_empty("role"), text_or_empty("text")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    one = F.struct("turn", F.unhex(F.sha2(whole, 256)).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    in_order = F.sort_array(F.collect_list(one))
    return turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.transform(in_order, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("path")
    )


def _head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % 9).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The query's conversations: the head of conversation c - c % 5 (0 to 4), then c's own other turns.

    All turns move once, by c - c % 5; the few conversations that share a head meet there.
    """
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(5))
    own = conversations(turns.withColumn("family", first).repartition("family"))
    family = W.partitionBy(first)
    head = F.max(F.when(F.col("conv_id") == first, F.struct(F.slice("path", 1, 8).alias("turns")))).over(family)
    none = F.slice("path", 1, 0)
    length = _head_length(F.col("conv_id"))
    rest = F.slice("path", length + 1, F.greatest(F.size("path") - length, F.lit(0)))
    joined = F.concat(F.slice(F.coalesce(F.col("head.turns"), none), F.lit(1), length), rest)
    return own.withColumn("head", head).select("conv_id", joined.alias("path"))


class Forest:
    """Nodes of one partition; lists have one entry per node. A node that was joined to another
    names it in ``same``."""

    def __init__(self) -> None:
        self.depth, self.left, self.members = array("l"), array("l"), array("l")
        self.least, self.children, self.leaves = array("q"), array("l"), array("l")
        self.saved, self.ends, self.parent, self.same = array("q"), array("l"), array("l"), array("l")

    def add(self, depth: int, left: int, members: int, least: int, children: int, leaves: int, saved: int, ends: int) -> int:
        self.depth.append(depth)
        self.left.append(left)
        self.members.append(members)
        self.least.append(least)
        self.children.append(children)
        self.leaves.append(leaves)
        self.saved.append(saved)
        self.ends.append(ends)
        self.parent.append(-1)
        self.same.append(len(self.same))
        return len(self.same) - 1

    def find(self, node: int) -> int:
        while self.same[node] != node:
            self.same[node] = self.same[self.same[node]]
            node = self.same[node]
        return node

    def lift(self, node: int, depth: int, sizes: array) -> int:
        """The component's node at a lesser depth; ``sizes`` are the bytes of its path's turns."""
        while self.depth[node] > depth:
            above, n = self.depth[node] - 1, self.members[node]
            saved = self.saved[node] + (n - 1) * sizes[above]
            self.saved[node] = saved
            self.parent[node] = self.add(above, self.left[node], n, self.least[node], 1, self.leaves[node], saved, 0)
            node = self.parent[node]
        return node

    def join(self, a: int, b: int) -> int:
        """One node of two neighbouring ones at the same depth, a being the left one."""
        self.leaves[a] = (self.leaves[a] if self.children[a] else 0) + (self.leaves[b] if self.children[b] else 0)
        self.children[a] += self.children[b]
        self.leaves[a] = self.leaves[a] if self.children[a] else 1
        self.members[a] += self.members[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.saved[a] += self.saved[b]
        self.ends[a] += self.ends[b]
        self.same[b] = a
        return a


def build(ids: array, paths: list[list[bytes]], sizes: list[array]) -> Forest:
    """The trie of sorted conversations, as a forest whose last node is the root.

    ``saved`` of a node is that of its subtree; while a component may still be joined, its top
    node lacks its own share, which lifting adds.
    """
    forest, n = Forest(), len(ids)
    shared = array("l", [0]) * n
    for i in range(1, n):
        a, b = paths[i - 1], paths[i]
        most, d = min(len(a), len(b)), 0
        while d < most and a[d] == b[d]:
            d += 1
        shared[i] = d
    component = array("l", range(n))  # of a conversation, its component's leftmost one
    top = array("l", (forest.add(len(p), i, 1, ids[i], 0, 1, 0, 1) for i, p in enumerate(paths)))

    def leftmost(i: int) -> int:
        while component[i] != i:
            component[i] = component[component[i]]
            i = component[i]
        return i

    for i in sorted(range(1, n), key=shared.__getitem__, reverse=True):
        a, b, d = leftmost(i - 1), i, shared[i]
        left = forest.lift(top[a], d, sizes[i - 1])
        right = forest.lift(top[b], d, sizes[i])
        top[a] = forest.join(left, right)
        component[b] = a
    root = forest.lift(top[0], 0, sizes[0])
    assert forest.depth[root] == 0
    return forest


def prefix_digests(path: list[bytes]) -> list[bytes]:
    """A digest of every prefix of a path, the empty one included."""
    digests = [b"root"]
    for turn in path:
        digests.append(hashlib.sha256(digests[-1] + turn).digest())
    return digests


NODE = (
    "kind string, part int, seq int, key binary, parent_key binary, parent_conv_id long, conv_id long, depth long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids string, "
    "first_path array<binary>, last_path array<binary>, sizes array<long>"
)
_ARROW = {
    "string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64(),
    "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64()),
}
_FIELDS = [field.split() for field in NODE.split(", ")]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r.get(name) for r in rows], _ARROW[kind]) for name, kind in _FIELDS]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in _FIELDS])


def _chunks(ids: array, start: int, end: int) -> Iterator[str]:
    for i in range(start, end, CHUNK_IDS):
        yield ",".join(map(str, ids[i : min(end, i + CHUNK_IDS)]))


def _digest(chunks: Iterator[str]) -> str:
    digest, begun = hashlib.sha256(), False
    for chunk in chunks:
        digest.update(("," * begun + chunk).encode())
        begun = True
    return digest.hexdigest()


def _forest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's complete nodes, the nodes of its two outer paths, and how it meets others."""
    part, ids, paths, sizes = TaskContext.get().partitionId(), array("q"), [], []
    for batch in batches:
        ids.extend(batch.column(0).to_pylist())
        paths.extend(batch.column(1).to_pylist())
        sizes.extend(array("q", x) for x in batch.column(2).to_pylist())
    if not ids:
        return
    forest, n = build(ids, paths, sizes), len(ids)
    first, last = prefix_digests(paths[0]), prefix_digests(paths[-1])

    def key(node: int) -> bytes | None:
        """The digest of a node on an outer path."""
        if forest.left[node] == 0:
            return first[forest.depth[node]]
        return last[forest.depth[node]] if forest.left[node] + forest.members[node] == n else None

    rows: list[dict] = [{"kind": "edge", "part": part, "first_path": paths[0], "last_path": paths[-1], "sizes": list(sizes[0])}]
    for node in range(len(forest.same)):
        if forest.same[node] != node:
            continue
        outer = key(node)
        row = {
            "kind": "node" if outer is None else "path", "part": part, "key": outer, "conv_id": forest.least[node],
            "depth": forest.depth[node], "n_convs": forest.members[node], "n_children": forest.children[node],
            "n_leaves": forest.leaves[node], "saved_tokens": forest.saved[node],
        }
        if forest.depth[node]:
            parent = forest.find(forest.parent[node])
            row["parent_key"] = key(parent)
            row["parent_conv_id"] = forest.least[parent] if row["parent_key"] is None else None
        start = forest.left[node]
        chunks = _chunks(ids, start, start + forest.ends[node])
        if outer is None:
            row["ends_sha256"] = _digest(chunks)
        else:
            rows.extend({"kind": "ends", "part": part, "seq": i, "key": outer, "ids": chunk} for i, chunk in enumerate(chunks))
        rows.append(row)
        if len(rows) >= 2000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the edge between two partitions takes back from the nodes on its path."""
    for batch in batches:
        for row in batch.to_pylist():
            a, b, sizes = row["before"], row["first_path"], row["sizes"]
            most, shared = min(len(a), len(b)), 0
            while shared < most and a[shared] == b[shared]:
                shared += 1
            again, rows = 0, []
            for depth, digest in reversed(list(enumerate(prefix_digests(b[:shared])))):
                again += sizes[depth - 1] if depth else 0
                rows.append({
                    "key": digest, "depth": depth, "n_children": -1 if depth < shared else 0,
                    "n_leaves": -1 if shared == len(a) else 0, "saved_tokens": again,
                })
            yield _batch([r | {"kind": "path", "n_convs": 0} for r in rows])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's chunks, which come in order."""
    key, digest = None, None
    for batch in batches:
        for this, chunk in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if this != key:
                if digest:
                    yield _batch([{"key": key, "ends_sha256": digest.hexdigest()}])
                key, digest = this, hashlib.sha256()
                digest.update(chunk.encode())
            else:
                digest.update(("," + chunk).encode())
    if digest:
        yield _batch([{"key": key, "ends_sha256": digest.hexdigest()}])


NO_ENDS = hashlib.sha256(b"").hexdigest()
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(convs: DataFrame, staging: Staging, partition_turns: int = PARTITION_TURNS, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """All nodes of the trie of conversations with ``conv_id`` and ``path``, as `conversations` has them."""
    spark = convs.sparkSession
    stored = staging.write(convs.select("conv_id", "path.digest", "path.size"), "paths")
    n_turns = stored.select(F.sum(F.size("size")).alias("n")).first().n or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_turns // partition_turns))
    order = ["digest", "conv_id"]
    in_order = stored.select("conv_id", "digest", "size").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    forests = staging.write(in_order.mapInArrow(_forest_rows, NODE), "forests")

    # One row per partition, so this window sees as many rows as there are partitions.
    edges = forests.where("kind = 'edge'").select("part", "first_path", "last_path", "sizes")
    before = F.lag("last_path").over(W.orderBy("part"))
    edges = edges.select("first_path", "sizes", before.alias("before")).where("before IS NOT NULL")
    corrections = edges.mapInArrow(_corrections, NODE)

    paths = forests.where("kind = 'path'").unionByName(corrections).groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("parent_key", ignorenulls=True).alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    chunks = forests.where("kind = 'ends'").select("key", "part", "seq", "ids")
    # One list is one hash, so its chunks follow each other in one task, which holds one of them.
    ends = chunks.repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_ends, NODE)
    paths = paths.join(ends.select("key", "ends_sha256"), "key", "left")
    paths = staging.write(paths.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "outer_paths")

    parents = paths.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("outer_parent"))
    whole = forests.where("kind = 'node'").select("parent_key", *COLUMNS).unionByName(
        paths.withColumn("parent_conv_id", F.lit(None).cast("long")).drop("key")
    )
    if paths.count() <= broadcast_nodes:
        joined = whole.join(F.broadcast(parents), "parent_key", "left")
    else:
        # A root may have any number of children: they are dealt over as many slots as partitions,
        # which grow with the turns, and their parent to each.
        slot = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(parts)).cast("int")
        dealt = parents.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        joined = whole.withColumn("slot", slot).join(dealt, ["parent_key", "slot"], "left")
    return joined.select(*[F.coalesce("parent_conv_id", "outer_parent").alias(c) if c == "parent_conv_id" else c for c in COLUMNS])


SQL_REPORT = r"""
WITH RECURSIVE
crc(i, v, k) AS (SELECT i, i, 0 FROM range(256) t(i)
                 UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(r)::VARCHAR || ':' || r || t)) AS p, {'r': r, 't': t} AS x
          FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT c, list(x ORDER BY p) AS xs FROM turns GROUP BY c),
hash AS (SELECT c, xs, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
                                       lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h FROM own, tab),
built AS (SELECT a.c, coalesce(b.xs, [])[1:a.h] || a.xs[a.h + 1:] AS xs FROM hash a LEFT JOIN own b ON b.c = a.c - (a.c % 5 + 5) % 5),
pre AS (SELECT c, d, xs[1:d] AS k, len(xs) = d AS here FROM (SELECT c, xs, unnest(range(len(xs) + 1)) AS d FROM built)),
node AS (SELECT k, d, min(c) AS c, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE here), '') AS ends FROM pre GROUP BY k, d),
kid AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
whole AS (SELECT node.*, coalesce(kid.n, 0) AS kids, CASE WHEN d > 0 THEN (node.n - 1) * strlen(k[d].t) ELSE 0 END AS mine FROM node LEFT JOIN kid USING (k)),
up AS (SELECT k[1:e] AS k, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum(mine) AS saved
       FROM (SELECT k, kids, mine, unnest(range(d + 1)) AS e FROM whole) GROUP BY ALL)
SELECT f.c::BIGINT AS conv_id, f.d::BIGINT AS depth, p.c::BIGINT AS parent_conv_id, f.n::BIGINT AS n_convs, f.kids::BIGINT AS n_children,
       up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM whole f JOIN up USING (k) LEFT JOIN node p ON f.d > 0 AND p.k = f.k[1:f.d - 1]
"""
