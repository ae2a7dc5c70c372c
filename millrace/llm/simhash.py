"""SimHash near-duplicates: 64-bit fingerprints, linked within a Hamming radius by BK-trees over shards.

Two fingerprints within radius r agree in one of r + 1 blocks of bits. Equal block values are
the shards: each task holds one shard's BK-tree at a time, asks it for every member, and gives
back at most one link per member. Shards above a bound are cut into tiles of two chunks each,
so that no tree grows with the data and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_type, small_batches, text_list
from millrace.session import materialize

SEED = 42
BITS = 64
SHARD_ROWS = 4096
BLOCK_HASHES = 100_000


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit integer; 0 without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK_HASHES):
        block = np.array(hashes[at : at + BLOCK_HASHES], "<u8")
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (long) of every row. Null and empty texts have fingerprint 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            values = [fingerprint(t, shingle) for t in text_list(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        compute, f"doc_id {id_type(docs, id_col)}, fingerprint long")


class BKTree:
    """Integers by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if self.values:
            node = 0
            while True:
                distance = (self.values[node] ^ value).bit_count()
                child = self.children[node].get(distance)
                if child is None:
                    self.children[node][distance] = len(self.values)
                    break
                node = child
        self.values.append(value)
        self.children.append({})

    def near(self, value: int, radius: int) -> list[int]:
        """Places of the nodes within the radius: only edges within it of the own distance are followed."""
        found, stack = [], [0] if self.values else []
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            stack += [c for d, c in self.children[node].items() if -radius <= d - distance <= radius]
        return found

    def near_all(self, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node reached, the places in ``values`` within its radius; all values go down together."""
        stack = [(0, np.arange(len(values)))] if self.values else []
        while stack:
            node, asking = stack.pop()
            distance = np.bitwise_count(values[asking] ^ np.uint64(self.values[node])).astype(np.int16)
            yield node, asking[distance <= radius]
            for edge, child in self.children[node].items():
                inside = asking[np.abs(distance - edge) <= radius]
                if len(inside):
                    stack.append((child, inside))


def shard_labels(values: np.ndarray, radius: int) -> np.ndarray:
    """For each value of a shard the place of a member of its group: values joined by links within the radius."""
    tree, n = BKTree(), len(values)
    labels = np.arange(n)
    if n <= 32:
        for i, value in enumerate(values.tolist()):
            for j in tree.near(value, radius):
                if labels[i] != labels[j]:
                    labels[labels == labels[i]] = labels[j]
            tree.add(value)
        return labels
    for value in values.tolist():
        tree.add(value)
    for node, hits in tree.near_all(values, radius):
        others = labels[hits]
        if (others != labels[node]).any():
            labels[np.isin(labels, others)] = labels[node]
    return labels


def _shard_keys(fingerprint: Column, radius: int, levels: int) -> Column:
    """The shards of a fingerprint, as integers: one of its blocks, on level 2 with one block of the remaining bits."""
    blocks = radius + 1
    width = BITS // blocks
    keys = []
    for b in range(blocks):
        # the last block takes the bits left over
        size = BITS - b * width if b == blocks - 1 else width
        value = F.shiftrightunsigned(fingerprint, b * width).bitwiseAND(F.lit((1 << size) - 1))
        if levels == 1:
            keys.append(value * blocks + b)
            continue
        low = fingerprint.bitwiseAND(F.lit((1 << b * width) - 1))
        high = F.shiftleft(F.shiftrightunsigned(fingerprint, b * width + size), b * width) if b < blocks - 1 else F.lit(0)
        rest, bits = low.bitwiseOR(high), BITS - size
        part = bits // blocks
        for c in range(blocks):
            part_size = bits - c * part if c == blocks - 1 else part
            inner = F.shiftrightunsigned(rest, c * part).bitwiseAND(F.lit((1 << part_size) - 1))
            keys.append(F.xxhash64(F.lit(b * blocks + c), value, inner))
    return F.array(*[k.cast("long") for k in keys])


def links(distinct: DataFrame, radius: int = 3, *, shard_rows: int = SHARD_ROWS, fine_above: int = 50_000_000) -> DataFrame:
    """Links ``a, b``, some of them repeated, whose components are those of all pairs of fingerprints within the radius.

    ``distinct``: stored, one row per ``fingerprint``. A shard gives one link per member to a
    member of its group. Above ``fine_above`` fingerprints shards take a second block, which
    makes them smaller; the components are the same. A shard of more than ``shard_rows`` is cut
    into chunks by hash, and each pair of chunks is a tile with a tree of its own.
    """
    if not 0 <= radius <= 15:
        raise ValueError("radius must be 0 to 15")
    levels = 2 if distinct.count() > fine_above else 1
    keyed = distinct.select("fingerprint", F.explode(_shard_keys(F.col("fingerprint"), radius, levels)).alias("shard"))
    large = materialize(keyed.groupBy("shard").count().filter(F.col("count") > shard_rows).select(
        "shard", F.ceil(F.col("count") * 2 / shard_rows).cast("int").alias("parts")))
    zero = F.lit(0).alias("x"), F.lit(0).alias("y")
    if large.isEmpty():
        tiles = keyed.select("shard", *zero, "fingerprint")
    else:
        part = F.pmod(F.xxhash64("fingerprint", F.lit("part")), F.col("parts")).cast("int")
        cut = keyed.join(large, "shard").withColumn("part", part).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        tiles = keyed.join(large, "shard", "left_anti").select("shard", *zero, "fingerprint").unionByName(cut.select(
            "shard", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "fingerprint"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((4, 0), np.int64)
        for batch in _then_none(batches):
            if batch is not None:
                new = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
                kept = np.concatenate([kept, new], 1)
            if not kept.shape[1]:
                continue
            starts = np.concatenate([[0], np.flatnonzero((np.diff(kept[:3], axis=1) != 0).any(0)) + 1])
            stops = np.append(starts[1:], kept.shape[1])
            if batch is not None:  # the last tile may go on
                starts, stops, last = starts[:-1], stops[:-1], starts[-1]
            else:
                last = kept.shape[1]
            left, right = [], []
            many = stops - starts > 1
            for start, stop in zip(starts[many].tolist(), stops[many].tolist()):
                own = kept[3, start:stop]
                roots = own[shard_labels(own.view(np.uint64), radius)]
                linked = roots != own
                left.append(own[linked])
                right.append(roots[linked])
            kept = kept[:, last:]
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    dealt = tiles.repartition("shard", "x", "y").sortWithinPartitions("shard", "x", "y")
    return dealt.select("shard", "x", "y", "fingerprint").mapInArrow(search, "a long, b long")


def _then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``): the least node reachable. Alternating large and small stars.

    Each step takes minima with partial sums before the shuffle and joins them from a stored
    table, so that a node with very many links is split by the engine's skew handling. It ends
    when every node either has greater neighbours only or is linked to one node.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        if least.filter("m < a and n > 1").isEmpty():
            break
        # large star: the greater neighbours of a node link to the least of the node and all its neighbours
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        edges = materialize(large)
        # small star: a node and its lesser neighbours link to the least of them
        least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")))
        small = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
    return least.select(F.col("a").alias("node"), F.least("a", "m").alias("root"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the least id of its group.

    Documents with equal fingerprints are one node; nodes within the radius are linked, and
    groups are the components of the links. Documents without words share fingerprint 0.
    A null id never names a group unless all ids of the group are null. Repeated rows stay.
    """
    marked = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    distinct = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = materialize(components(links(distinct, radius, shard_rows=shard_rows)))
    rooted = materialize(distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")))
    named = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    groups = materialize(rooted.join(named, "root").select("fingerprint", "component_id"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return marked.join(groups, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
