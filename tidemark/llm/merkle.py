"""Merkle manifests of a table of documents, their subtrees stored in van Emde Boas order.

A leaf is the SHA-256 of a document's fields.  The leaves of one group (a language) ascend by id and
pair up level by level to the group's subroot; the subroots, in order of their groups, pair up the
same way to the root.  A tree of any size is cut into aligned subtrees of ``1 << HEIGHT`` leaves, the
blocks; the roots of one level's blocks are the leaves of the next level's.  So a task holds one block,
each level has a few thousandths of the rows below it, and no group is ever sorted or held whole.

A block is one binary value: its nodes of 32 bytes, laid out recursively.  A subtree is split at half
its height, the upper half comes first, then the lower subtrees from left to right, each laid out
alike.  ``address`` computes where a node lies, for construction and for the siblings of a proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import small_batches
from tidemark.operators.joins import lookup_join
from tidemark.operators.ranking import rank_within
from tidemark.workspace import durable

#: A block holds up to 4,096 leaves: 256 KB of nodes.
HEIGHT = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BLOCK = ("tree string, n long, block long, height int, size int, root binary, nodes binary, "
          "ids array<long>, others array<binary>")
_PATH = "tree string, block long, alone boolean, path binary, subroot binary, root binary"
_PROOF = ("tree string, doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of one depth (0: the root) in a block of ``levels`` levels."""
    place = np.zeros(len(index), np.int64)
    index = np.asarray(index, np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        below = levels - upper
        depth -= upper
        place += (1 << upper) - 1 + (index >> depth) * ((1 << below) - 1)
        index = index & ((1 << depth) - 1)
        levels = below
    return place


def _parent(children: str) -> str:
    return sha256(children.encode()).hexdigest()


def store(leaves: list[bytes], height: int) -> bytes:
    """The nodes of a block; places that a last, shorter block does not fill are zero."""
    levels = height + 1
    nodes = np.zeros(((1 << levels) - 1, 32), np.uint8)
    row = [leaf.hex() for leaf in leaves]
    for depth in range(height, -1, -1):
        nodes[address(levels, depth, np.arange(len(row)))] = np.frombuffer(
            bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        if depth:
            row = [_parent("".join(row[i:i + 2])) for i in range(0, len(row), 2)]
    return nodes.tobytes()


def siblings(nodes: str, height: int, size: int) -> list[list[tuple[str, int]]]:
    """For each leaf of a block (its nodes as hex text) the siblings upwards: (digest, side).

    Side 1 is a sibling to the left, 2 to the right, 0 none.
    """
    out = [[] for _ in range(size)]
    index = np.arange(size)
    for depth in range(height, 0, -1):
        width = -(-size // (1 << (height - depth)))
        beside = index ^ 1
        side = np.where(beside >= width, 0, np.where(beside < index, 1, 2)).tolist()
        at = (address(height + 1, depth, beside) * 64).tolist()
        for path, a, s in zip(out, at, side):
            path.append((nodes[a:a + 64] if s else "", s))
        index = index >> 1
    return out


def _pack(path: list[tuple[str, int]]) -> bytes:
    return b"".join(bytes([s]) + (bytes.fromhex(h) if s else bytes(32)) for h, s in path)


def _unpack(path: bytes) -> list[tuple[str, int]]:
    return [(path[i + 1:i + 33].hex() if path[i] else "", path[i]) for i in range(0, len(path), 33)]


def fold(leaf: str, path: list[tuple[str, int]]) -> str:
    """The root that a leaf and its siblings give."""
    for beside, side in path:
        leaf = _parent(beside + leaf if side == 1 else leaf + beside)
    return leaf


def leaf_of(columns: dict[str, Column]) -> Column:
    """SHA-256 over the fields: ``-`` for null, else byte count, colon, value."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*(field(columns[f]) for f in FIELDS)), 256))


def _blocks(leaves: DataFrame, height: int) -> DataFrame:
    """One row per block of ``leaves`` (tree, n leaves of the tree, pos, digest, id, other)."""
    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n, count = table.column("n")[0].as_py(), table.num_rows
        tall = height if n > 1 << height else (n - 1).bit_length()
        nodes = store(table.column("digest").to_pylist(), tall)
        return pa.table([[table.column("tree")[0].as_py()], [n], [key[1].as_py()], [tall], [count],
                         [nodes[:32]], [nodes], [table.column("id").to_pylist()],
                         [table.column("other").to_pylist()]], schema=schema)

    schema = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("block", pa.int64()),
                        ("height", pa.int32()), ("size", pa.int32()), ("root", pa.binary()),
                        ("nodes", pa.binary()), ("ids", pa.list_(pa.int64())),
                        ("others", pa.list_(pa.binary()))])
    return (leaves.withColumn("_block", F.shiftright("pos", height)).groupBy("tree", "_block")
            .applyInArrow(build, _BLOCK))


def _levels(leaves: DataFrame, height: int) -> list[DataFrame]:
    """The block tables of all levels; a tree ends at the level where it is one block."""
    out = [durable(_blocks(leaves, height), "blocks")]
    while True:
        more = out[-1].filter(F.col("n") > 1 << height)
        if more.isEmpty():
            return out
        out.append(durable(_blocks(more.select(
            "tree", F.ceil(F.col("n") / (1 << height)).alias("n"), F.col("block").alias("pos"),
            F.col("root").alias("digest"), F.lit(None).cast("long").alias("id"),
            F.lit(None).cast("binary").alias("other")), height), "blocks"))


def _tops(levels: list[DataFrame], height: int) -> DataFrame:
    """(tree, root) of every tree."""
    tops = [t.filter(F.col("n") <= 1 << height).select("tree", "root") for t in levels]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _paths(blocks: DataFrame, height: int) -> DataFrame:
    """The path of every leaf of ``blocks`` (with the path above), for the blocks of the level below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = siblings(row["nodes"].hex(), row["height"], row["size"])
                first = row["block"] << height
                n = len(found)
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([row["tree"]] * n, pa.string()),
                    "block": pa.array(range(first, first + n), pa.int64()),
                    "alone": [False] * n, "path": [_pack(p) + row["path"] for p in found],
                    "subroot": pa.array([row["subroot"]] * n, pa.binary()),
                    "root": pa.array([row["top"]] * n, pa.binary())})
    return blocks.mapInArrow(run, _PATH)


def _downwards(levels: list[DataFrame], known: DataFrame, height: int) -> DataFrame:
    """The lowest level's blocks with their paths above, found from the highest level down."""
    below = None
    for depth, table in reversed(list(enumerate(levels))):
        table = lookup_join(
            table.withColumn("alone", F.col("n") <= 1 << height).drop("root"),
            known if below is None else known.unionByName(below), ["tree", "block", "alone"],
            unique=["tree", "block"]).withColumnRenamed("root", "top")
        if depth == 0:
            return table
        below = durable(_paths(table, height), "paths")
    raise ValueError("no levels")


@dataclass
class Manifest:
    """Block tables of the groups' trees and of the tree over their subroots, lowest level first."""

    groups: list[DataFrame]
    over: list[DataFrame]
    height: int

    def root(self) -> bytes | None:
        """The root of all; None without documents."""
        row = _tops(self.over, self.height).first()
        return None if row is None else bytes(row["root"])


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, id, digest, other, at) with place and size within their tree."""
    placed = durable(rank_within(rows, ["tree"], [F.col("id"), F.col("digest"), F.col("at")], "pos"),
                     "placed")
    sizes = placed.groupBy("tree").agg(F.count("*").alias("n"))
    return lookup_join(placed, sizes, ["tree"]).select(
        "tree", "n", (F.col("pos") - 1).alias("pos"), "digest", "id", "other")


def build(docs: DataFrame, altered: dict[str, Column] | None = None,
          height: int = HEIGHT) -> Manifest:
    """The manifest of ``docs``; ``altered`` columns give each leaf a second, later version.

    Only the five fields are read, so extra columns do not matter.  Null fields, null languages and
    null ids are values like any other (null first); rows of one id are ordered by their digests;
    a repeated row is a leaf of its own.  Very long texts are hashed by Spark.  No rows: no blocks.
    """
    own = {f: F.col(f) for f in FIELDS}
    changed = F.lit(False)
    for name, value in (altered or {}).items():
        changed = changed | ~value.eqNullSafe(own[name])
    leaves = durable(docs.select(
        F.col("lang").alias("tree"), F.col("doc_id").cast("long").alias("id"),
        leaf_of(own).alias("digest"),
        F.when(changed, leaf_of(own | (altered or {}))).alias("other")), "leaves")
    # the last key only spreads repeated rows over the ranges
    groups = _levels(_numbered(leaves.withColumn("at", F.monotonically_increasing_id())), height)
    tops = durable(_tops(groups, height), "subroots")
    named = tops.select("tree", F.col("root").alias("digest"), F.lit(0).alias("all"))
    placed = durable(rank_within(named, ["all"], [F.col("tree")], "pos"), "placed")
    n = placed.count()
    over = _levels(placed.select(
        F.lit(None).cast("string").alias("tree"), F.lit(n).cast("long").alias("n"),
        (F.col("pos") - 1).alias("pos"), "digest", F.lit(None).cast("long").alias("id"),
        F.encode("tree", "utf-8").alias("other")), height)
    return Manifest(groups, over, height)


def prove(manifest: Manifest) -> DataFrame:
    """One row per document: its leaf, subroot, root, the digest of its proof and the folded root.

    The proof is checked with the altered version of the leaf where there is one.
    """
    over = manifest.over
    start = over[-1].select(
        "tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("alone"),
        F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), "root")
    with small_batches(start.sparkSession, 16):
        lowest = _downwards(over, start, manifest.height)
        named = durable(_subroot_paths(lowest), "subroot-paths")
        found = _downwards(manifest.groups, named, manifest.height)
        return durable(found.mapInArrow(_proofs, _PROOF), "proofs")


def _subroot_paths(blocks: DataFrame) -> DataFrame:
    """(tree, path, ...) of every group from the lowest blocks over the subroots.

    There the leaves are the subroots, and the names of their groups are kept as their others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hexed = row["nodes"].hex()
                found = siblings(hexed, row["height"], row["size"])
                at = address(row["height"] + 1, row["height"], np.arange(row["size"])).tolist()
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([None if x is None else x.decode() for x in row["others"]],
                                     pa.string()),
                    "block": pa.array([0] * len(at), pa.int64()), "alone": [True] * len(at),
                    "path": [_pack(p) + row["path"] for p in found],
                    "subroot": [row["nodes"][32 * a:32 * a + 32] for a in at],
                    "root": pa.array([row["top"]] * len(at), pa.binary())})
    return blocks.mapInArrow(run, _PATH)


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            hexed, above = row["nodes"].hex(), _unpack(row["path"])
            at = address(row["height"] + 1, row["height"], np.arange(row["size"])).tolist()
            root, leaves, proofs, folded = row["top"].hex(), [], [], []
            for path, a, other in zip(siblings(hexed, row["height"], row["size"]), at, row["others"]):
                path = path + above
                leaf = hexed[64 * a:64 * a + 64]
                leaves.append(leaf)
                proofs.append(_parent("".join(h for h, _ in path)))
                folded.append(fold(other.hex() if other else leaf, path))
            n = len(leaves)
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([row["tree"]] * n, pa.string()),
                "doc_id": pa.array(row["ids"], pa.int64()), "leaf": leaves,
                "subroot": [row["subroot"].hex()] * n, "root": [root] * n, "proof_sha256": proofs,
                "folded_root": folded, "verified": [f == root for f in folded]})
