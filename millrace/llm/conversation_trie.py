"""The prefix trie of conversations: one row per distinct sequence of first turns.

Conversations are sorted by their turns' hashes and cut into ranges. In each range the lengths of the prefixes
that neighbours share are edges; joined in descending depth by union-find, every merge of components makes the
node at which their paths part. Paths between such nodes have the members of their lower end. Nodes that reach
over a boundary of ranges are contracted to partial counts under the hash of their prefix, and merged by it:
all counts are sums over conversations and their neighbours, so that parts add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

WIDTH = 16
PIECE_IDS = 50_000
CLOSED, BELOW_OPEN, OPEN, ENDS = range(4)
SCHEMA = ("kind int, part int, prefix binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, piece long, ids binary")
FIELDS = [f.split() for f in SCHEMA.split(", ")]


def turns(table: DataFrame) -> DataFrame:
    """``conv_id, turns``: of each conversation its turns in order, each as ``turn, role, head, hash, words``.

    Null turns come first; rows of one turn follow each other by role, the first 32 characters of the text, and hash.
    Null roles and texts are empty. Rows without a conv_id are left out. A conversation is one row of turn hashes.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("int")
    rows = table.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn"), role.alias("role"), F.substring(text, 1, 32).alias("head"),
                                                digest.alias("hash"), words.alias("words")).alias("t"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["hash"].alias("hash"), t["words"].alias("words"))).alias("turns"))


def as_paths(conversations: DataFrame, turns_col: Column) -> DataFrame:
    """``conv_id, path, words``: the turns' hashes one after another as bytes, and the words of each turn."""
    return conversations.select("conv_id", turns_col.alias("t")).select(
        "conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["hash"]), "")).alias("path"),
        F.transform("t", lambda t: t["words"]).alias("words"))


def with_shared_heads(conversations: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """Paths of conversations rebuilt: the first ``h`` turns of the leading one of its ``group``, then its own after ``h``;
    ``h`` is the CRC-32 of the id modulo ``most + 1``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = conversations.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("leader"), F.slice("turns", 1, most).alias("head"))
    rows = conversations.withColumn("leader", F.col("conv_id") - F.col("conv_id") % group).join(heads, "leader", "left")
    empty = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", empty), 1, h)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return as_paths(rows, F.concat(head, own))


def shared_turns(a: bytes, b: bytes) -> int:
    """The number of first turns that two paths share."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    low, high = 0, most  # shares low, but not high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


class Forest:
    """The trie of one sorted range of paths, its nodes being components joined over edges of descending depth.

    ``left`` and ``right``: what the first and the last path share with the neighbouring ranges, -1 without one.
    """

    def __init__(self, paths: list[bytes], ids: list[int], words: list, left: int, right: int) -> None:
        self.paths, self.ids, self.words = paths, ids, words
        n = len(paths)
        self.sizes = [len(p) // WIDTH for p in paths]
        self.shared = [left, *(shared_turns(paths[i - 1], paths[i]) for i in range(1, n)), right]
        self.link = list(range(n))  # union-find over nodes; node i < n begins as the end of path i
        self.depth = list(self.sizes)
        self.first, self.last, self.least, self.members = list(range(n)), list(range(n)), list(ids), [1] * n
        self.leaves = [int(self.shared[i + 1] < self.sizes[i]) for i in range(n)]
        self.saved = [self.words[i][d - 1] * (1 - self.begins(i, d)) if (d := self.sizes[i]) else 0 for i in range(n)]
        self.children = [0] * n
        self.below: list[list[int]] = [[] for _ in range(n)]  # nodes that hang below a node
        at_path = list(range(n))
        for edge in sorted(range(1, n), key=lambda i: -self.shared[i]):
            a, b = self.find(at_path[edge - 1]), self.find(at_path[edge])
            if a != b:
                self.merge(a, b, self.shared[edge])

    def begins(self, path: int, depth: int) -> int:
        """1 if the node of this depth occurs first with this path."""
        return int(self.shared[path] < depth)

    def find(self, node: int) -> int:
        while self.link[node] != node:
            self.link[node] = self.link[self.link[node]]
            node = self.link[node]
        return node

    def raised(self, node: int, depth: int) -> int:
        """The component as a node of this depth: itself, or a new node above it."""
        if self.depth[node] == depth:
            return node
        top = len(self.link)
        first, members = self.first[node], self.members[node]
        saved, words = self.saved[node], self.words[first]
        for d in range(self.depth[node] - 1, depth - 1, -1):
            if d:
                saved += words[d - 1] * (members - self.begins(first, d))
        for values, value in ((self.link, top), (self.depth, depth), (self.first, first), (self.last, self.last[node]),
                              (self.least, self.least[node]), (self.members, members), (self.leaves, self.leaves[node]),
                              (self.saved, saved), (self.children, self.begins(first, depth + 1)), (self.below, [node])):
            values.append(value)
        self.link[node] = top
        return top

    def merge(self, a: int, b: int, depth: int) -> None:
        """Join two components at the depth that their paths share."""
        a, b = self.raised(a, depth), self.raised(b, depth)
        if depth:  # what each side counted for this node alone, without its first occurrence
            word = self.words[self.first[a]][depth - 1]
            both = self.begins(min(self.first[a], self.first[b]), depth)
            self.saved[a] += self.saved[b] + word * (self.begins(self.first[a], depth) + self.begins(self.first[b], depth) - both)
        else:
            self.saved[a] += self.saved[b]
        self.link[b] = a
        self.first[a], self.last[a] = min(self.first[a], self.first[b]), max(self.last[a], self.last[b])
        self.least[a] = min(self.least[a], self.least[b])
        self.members[a] += self.members[b]
        self.leaves[a] += self.leaves[b]
        self.children[a] += self.children[b]
        self.below[a] += self.below[b]

    def rows(self, part: int) -> Iterator[tuple]:
        """Rows of ``SCHEMA``, from the root down."""
        left, right, last = self.shared[0], self.shared[-1], len(self.paths) - 1
        root = self.raised(self.find(0), 0)
        nothing = hashlib.sha256(b"").hexdigest()
        stack = [(root, -1, None, False)]
        while stack:
            node, above, parent_least, parent_open = stack.pop()
            first, low = self.first[node], self.depth[node]
            path, words, members, least = self.paths[first], self.words[first], self.members[node], self.least[node]
            saved = [self.saved[node]]
            for d in range(low - 1, above, -1):
                saved.append(saved[-1] + (words[d - 1] * (members - self.begins(first, d)) if d else 0))
            for depth in range(above + 1, low + 1):
                is_open = first == 0 and depth <= left or self.last[node] == last and depth <= right
                ends = self.ended(node) if depth == low else []
                children = self.children[node] if depth == low else self.begins(first, depth + 1)
                prefix, parent = (hashlib.md5(path[: d * WIDTH]).digest() if d >= 0 and (is_open or parent_open) else None for d in (depth, depth - 1))
                digest = None if is_open else hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else nothing
                yield (OPEN if is_open else BELOW_OPEN if parent_open else CLOSED, part, prefix, parent, least, depth,
                       None if is_open or parent_open else parent_least, members, children, self.leaves[node], saved[low - depth], digest, None, None)
                if is_open:
                    for i in range(0, len(ends), PIECE_IDS):
                        yield (ENDS, part, prefix, *(None,) * 9, i, ",".join(map(str, ends[i : i + PIECE_IDS])).encode())
                parent_least, parent_open = least, is_open
            stack += [(b, low, least, parent_open) for b in self.below[node]]

    def ended(self, node: int) -> list[int]:
        """Ids of the paths that end at a node; they come first among its paths."""
        at, low, out = self.first[node], self.depth[node], []
        while at <= self.last[node] and self.sizes[at] == low:
            out.append(self.ids[at])
            at += 1
        return out


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, FIELDS)], [n for n, _ in FIELDS])


def _forests(ranges: DataFrame, bounds: dict[int, tuple[int, int]]) -> DataFrame:
    """Nodes of all ranges (``part, path, conv_id, words``), each range's trie built by itself."""
    shared = ranges.sparkSession.sparkContext.broadcast(bounds)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, paths, ids, words = None, [], [], []

        def finish() -> Iterator[pa.RecordBatch]:
            if paths:
                held = []
                for row in Forest(paths, ids, words, *shared.value[part]).rows(part):
                    held.append(row)
                    if len(held) == 10_000:
                        yield _record_batch(held)
                        held = []
                if held:
                    yield _record_batch(held)

        for batch in batches:
            parts = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for start, stop in zip(cuts, cuts[1:]):
                if start < stop:
                    if parts[start] != part:
                        yield from finish()
                        part, paths, ids, words = int(parts[start]), [], [], []
                    piece = batch.slice(start, stop - start)
                    paths += piece.column("path").to_pylist()
                    ids += piece.column("conv_id").to_pylist()
                    words += piece.column("words").to_pylist()
        yield from finish()

    dealt = ranges.repartition("part").sortWithinPartitions("part", "path", "conv_id")
    return dealt.select("part", "path", "conv_id", "words").mapInArrow(build, SCHEMA)


def _digests(pieces: DataFrame) -> DataFrame:
    """``prefix, digest`` of the ids that end at open nodes: each node's pieces pass one hash in order."""

    def hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, state = None, None
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for own, ids in zip(batch.column("prefix").to_pylist(), batch.column("ids").to_pylist()):
                if own != prefix:
                    if state is not None:
                        done.append((prefix, state.hexdigest()))
                    prefix, state = own, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.binary()), pa.array([d for _, d in done])], ["prefix", "digest"])
                done = []
        if state is not None:
            done.append((prefix, state.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.binary()), pa.array([d for _, d in done])], ["prefix", "digest"])

    dealt = pieces.repartition("prefix").sortWithinPartitions("prefix", "part", "piece")
    return dealt.select("prefix", "ids").mapInArrow(hash_pieces, "prefix binary, digest string")


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``paths`` (``conv_id, path, words``; distinct ids): ``conv_id`` (its least member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Paths are ranged by path and id, so a large group of equal paths is cut too. One row per range (what its ends share
    with its neighbours) comes to the driver. The SHA-256 over the ids of a node that reaches over ranges is one
    sequence by its definition: its ids pass one task as ready text, 50,000 a piece, and are never held together.
    A table without conversations has no nodes.
    """
    ranges = materialize(paths.repartitionByRange("path", "conv_id").withColumn("part", F.spark_partition_id()))
    ends = sorted((r.part, bytes(r.low), bytes(r.high)) for r in ranges.groupBy("part").agg(
        F.min("path").alias("low"), F.max("path").alias("high")).collect())
    between = [-1, *(shared_turns(a[2], b[1]) for a, b in zip(ends, ends[1:])), -1]
    nodes = materialize(_forests(ranges, {part: (between[i], between[i + 1]) for i, (part, _, _) in enumerate(ends)}))
    open_ = nodes.filter(F.col("kind") == OPEN)
    merged = open_.groupBy("prefix").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    merged = materialize(merged.join(_digests(nodes.filter(F.col("kind") == ENDS)), "prefix", "left").withColumn(
        "ends_sha256", F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256))))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = merged.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # a parent's rows are looked up range by range, so that no parent meets all its children in one task
    local = open_.select("part", F.col("prefix").alias("parent")).join(above, "parent")
    below = nodes.filter(F.col("kind") == BELOW_OPEN).drop("parent_conv_id").join(local, ["part", "parent"])
    return nodes.filter(F.col("kind") == CLOSED).select(*columns).unionByName(below.select(*columns)).unionByName(
        merged.join(above, "parent", "left").select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The registered query: nodes of the trie of all conversations (``conv_id, turn, role, text``) with shared heads."""
    return prefix_trie(materialize(with_shared_heads(turns(conversations))))
