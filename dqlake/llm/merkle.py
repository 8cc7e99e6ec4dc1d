"""Merkle manifest of a dataset, kept as a postorder append log.

Rows become leaves, leaves become a tree per group (runs of ``arity`` neighbours), the roots of the
groups become one more tree of the same kind. A tree is built in rounds: in each, aligned builders
take up to ``BLOCK`` neighbours, a power of the arity, and append nodes to a log as they are completed, so that a node
follows its children. Where a node stands follows from the sizes of the subtrees before it: the node
of level l that ends at leaf e is number ``l + sum over j of e // arity ** j``. So a proof reads its
siblings at computed places, without any search, out of one segment of the log a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, partitions
from .runs import dealt, sorted_groups

#: Leaves of a builder at most (or ``arity``, if that is more): about 100 KB of log a segment.
BLOCK = 2500
#: Bytes of a digest in the log; hashing takes digests as hex text.
SIZE = 32


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Lowercase hex sha256 of the values as text, each with its length."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def tree_key(group: Column) -> Column:
    """Name of a group's tree; names sort as groups do: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def parent(children: list[bytes]) -> bytes:
    """Digest of a run of digests (hex text)."""
    return hashlib.sha256(b"".join(children)).hexdigest().encode()


def levels(arity: int) -> int:
    """Levels a builder completes: 7 at arity 3, for 2,187 leaves."""
    up, size = 1, arity
    while size * arity <= BLOCK:
        up, size = up + 1, size * arity
    return up


def place(arity: int, level: int | np.ndarray, end: int | np.ndarray) -> int | np.ndarray:
    """Postorder number, in an aligned segment, of the node of ``level`` whose last leaf is ``end``."""
    at, size = level + end, arity
    for _ in range(levels(arity)):
        at, size = at + end // size, size * arity
    return at


def append_all(leaves: list[bytes], arity: int, top: int) -> list[bytes]:
    """Log of one aligned run of leaves: each node once its last child is there, up to level ``top``."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(top + 1)]
    last = len(leaves) - 1
    for i, leaf in enumerate(leaves):
        node, size = leaf, 1
        for level in range(top + 1):
            log.append(node)
            open_[level].append(node)
            size *= arity
            if level == top or ((i + 1) % size and i != last):
                break
            node, open_[level] = parent(open_[level]), []
    return log


def height(n: int, arity: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def number(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``idx``, from 0 in each group by ``order``, and ``n``, the rows of the group.

    Rows are sorted over the cluster by ranges; a range counts its rows of each group, and only those
    counts are added up along the ranges. So a group of any size is spread over many tasks.
    """
    sorted_ = rows.repartitionByRange(partitions(rows.sparkSession), group, *order).sortWithinPartitions(group, *order)
    kept = keep(sorted_.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()), "numbered")
    along = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (kept.groupBy(group, "part").agg(F.count("*").alias("here"), F.min("seq").alias("from"))
              .withColumn("before", F.coalesce(F.sum("here").over(along), F.lit(0)))
              .withColumn("n", F.sum("here").over(Window.partitionBy(group))))
    return (kept.join(starts, [group, "part"]).withColumn("idx", F.col("before") + F.col("seq") - F.col("from"))
            .drop("part", "seq", "here", "from", "before"))


def _build(arity: int):
    most = levels(arity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, ["tree", "block"]):
            trees, blocks, n = (table.column(k) for k in ("tree", "block", "n"))
            for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                total = n[start].as_py()
                top = min(most, height(total, arity))
                leaves = [d.hex().encode() for d in table.column("digest").slice(start, end - start).to_pylist()]
                log = append_all(leaves, arity, top)
                yield pa.RecordBatch.from_arrays(
                    [trees.slice(start, 1).combine_chunks(), blocks.slice(start, 1).combine_chunks(), pa.array([total], pa.int64()),
                     pa.array([end - start], pa.int64()), pa.array([top], pa.int32()),
                     pa.array([bytes.fromhex(b"".join(log).decode())], pa.binary()), pa.array([bytes.fromhex(log[-1].decode())], pa.binary())],
                    ["tree", "block", "total", "n", "top", "nodes", "digest"])

    return run


def build(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """The rounds of the trees over ``leaves`` (tree, idx, n, digest): each a written table of segments
    (tree, block, total, n, top, nodes, digest), the last with one segment per tree. ``nodes`` is the
    log of the block, ``digest`` its last node."""
    span, rounds = arity ** levels(arity), []
    while True:
        cut = leaves.select("tree", F.floor(F.col("idx") / span).cast("long").alias("block"), "idx", "n", "digest")
        segments = keep(dealt(cut, ["tree", "block"], ["idx"]).mapInArrow(
            _build(arity), "tree string, block long, total long, n long, top int, nodes binary, digest binary"), "segments")
        rounds.append(segments)
        if segments.where(F.col("total") > span).isEmpty():
            return rounds
        # a tree that fits in one block is done: it goes up unchanged, as the only leaf of the next round
        leaves = segments.select("tree", F.col("block").alias("idx"), F.ceil(F.col("total") / span).cast("long").alias("n"), "digest")


def _paths(arity: int):
    """(tree, child, digest, path): for each leaf of a segment, its proof up to the root. A path is,
    level by level, the number of siblings before, of those after, and their digests."""

    span = arity ** levels(arity)

    def siblings(n: int, top: int, nodes: np.ndarray) -> list[bytes]:
        """Path of every leaf within the segment."""
        leaf = np.arange(n)
        steps: list[list[bytes]] = [[] for _ in range(n)]
        for level in range(top):
            size, many = arity ** level, -(-n // arity ** level)
            ends = np.minimum((np.arange(many) + 1) * size, n) - 1
            digests = nodes[place(arity, level, ends)]
            own = leaf // size
            first = own // arity * arity
            made: dict[int, bytes] = {}
            for x, i, f in zip(leaf.tolist(), own.tolist(), first.tolist(), strict=True):
                step = made.get(i)
                if step is None:
                    last = min(f + arity, many)
                    made[i] = step = bytes((i - f, last - i - 1)) + digests[f:i].tobytes() + digests[i + 1:last].tobytes()
                steps[x].append(step)
        return [b"".join(s) for s in steps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {k: batch.column(j)[i].as_py() for j, k in enumerate(batch.schema.names)}
                nodes = np.frombuffer(r["nodes"], f"V{SIZE}")
                ends = place(arity, 0, np.arange(r["n"]))
                above = r["above"] or b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * r["n"], pa.string()), pa.array(r["block"] * span + np.arange(r["n"])),
                     pa.array([x.tobytes() for x in nodes[ends]], pa.binary()),
                     pa.array([p + above for p in siblings(r["n"], r["top"], nodes)], pa.binary())],
                    ["tree", "idx", "digest", "path"])

    return run


def proofs(rounds: list[DataFrame], arity: int, above: DataFrame | None = None) -> DataFrame:
    """(tree, idx, digest, path) of every leaf of the trees. ``above`` (tree, path) is what follows the
    roots, such as their own proofs in the tree of trees. Each segment is read once."""
    upper = above
    for i, segments in enumerate(reversed(rounds)):
        if upper is None:
            met = segments.withColumn("above", F.lit(None).cast("binary"))
        elif i == 0:
            met = segments.join(upper.withColumnRenamed("path", "above"), "tree", "left")
        else:
            met = segments.join(upper.select("tree", F.col("idx").alias("block"), F.col("path").alias("above")), ["tree", "block"])
        upper = met.select("tree", "block", "n", "top", "nodes", "above").mapInArrow(
            _paths(arity), "tree string, idx long, digest binary, path binary")
    return upper


def fold_path(leaf: bytes, path: bytes) -> tuple[bytes, bytes]:
    """(root, all sibling digests) from a leaf's hex digest and its path."""
    node, at, seen = leaf, 0, []
    while at < len(path):
        before, after = path[at], path[at + 1]
        middle, end = at + 2 + before * SIZE, at + 2 + (before + after) * SIZE
        left, right = path[at + 2:middle].hex().encode(), path[middle:end].hex().encode()
        node, at = hashlib.sha256(left + node + right).hexdigest().encode(), end
        seen += (left, right)
    return node, b"".join(seen)


def folded(proven: DataFrame, leaf_col: str, path_col: str = "path") -> DataFrame:
    """``proven`` with ``folded_root``, the root that follows from ``leaf_col`` (hex) and its path, and
    ``proof_sha256``, the hash of the path's digests. The path itself goes."""
    names = [c for c in proven.columns if c != path_col]
    schema = proven.select(*names, F.lit("").alias("folded_root"), F.lit("").alias("proof_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, hashes = [], []
            get = batch.schema.get_field_index
            for leaf, path in zip(batch.column(get(leaf_col)).to_pylist(), batch.column(get(path_col)).to_pylist(), strict=True):
                root, digests = fold_path(leaf.encode(), path)
                roots.append(root.decode()), hashes.append(hashlib.sha256(digests).hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(get(c)) for c in names), pa.array(roots, pa.string()), pa.array(hashes, pa.string())],
                                             [*names, "folded_root", "proof_sha256"])

    return proven.mapInArrow(run, schema)


class Manifest:
    """Merkle trees over the rows of a table: one per group, and one over the groups' roots.

    ``leaves`` holds (tree, id, leaf, digest, idx, n) and what ``carry`` names; ``rounds`` and ``top``
    are the logs of the groups' trees and of the tree over them. All are written tables.
    """

    def __init__(self, docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source",
                 arity: int = 3, carry: dict[str, Column] | None = None):
        """The leaf of a row hashes ``columns`` in their order, see ``leaf_hash``.

        Leaves of a group ascend by id (null ids first), rows equal in id by their leaf, so that any
        order of the input gives the same root; equal rows are leaves of their own. A null group is a
        group, the first. Null values hash as ``-``, which no value does; a text of any length is
        hashed where it lies and not moved. A group of one row has its leaf as root. An empty table has
        no leaves, no groups and no root. Columns not named are not read; ``carry`` adds expressions of
        the row under names that must differ from tree, id, leaf, digest, idx and n.
        """
        if arity < 2 or arity > 255:
            raise ValueError("arity must be from 2 to 255")
        self.arity = arity
        extra = [c.alias(k) for k, c in (carry or {}).items()]
        leaf = leaf_hash(*[F.col(c) for c in columns])
        rows = docs.select(tree_key(F.col(group_col)).alias("tree"), F.col(id_col).alias("id"), leaf.alias("leaf"), *extra)
        rows = keep(number(rows, "tree", "id", "leaf"), "leaves")
        self.leaves = rows.withColumn("digest", F.unhex("leaf"))
        self.rounds = build(self.leaves, arity)
        self.subroots = self.rounds[-1].select("tree", "digest")
        groups = number(self.subroots.select(F.lit("").alias("all"), "tree", "digest"), "all", "tree")
        self.groups = keep(groups, "groups")
        self.top = build(self.groups.select(F.lit("").alias("tree"), "idx", "n", "digest"), arity)
        self.root = self.top[-1].select("digest")

    def proofs(self) -> DataFrame:
        """(tree, idx, subroot, root, path) of every leaf; paths lead to the root over all groups."""
        over = proofs(self.top, self.arity).select("idx", "path")
        above = self.groups.select("tree", "idx", F.col("digest").alias("subroot")).join(over, "idx").drop("idx")
        paths = proofs(self.rounds, self.arity, above.select("tree", "path"))
        # a digest, whatever the input; no root, no leaves
        root = self.root.first()
        hex_root = F.lit(root["digest"].hex() if root else None).cast("string")
        return (paths.select("tree", "idx", "path").join(above.select("tree", F.lower(F.hex("subroot")).alias("subroot")), "tree")
                .withColumn("root", hex_root))

    def proven(self) -> DataFrame:
        """The leaves with their proofs."""
        return self.leaves.drop("digest").join(self.proofs(), ["tree", "idx"])
