"""Merkle manifest of a table: a leaf per row, a tree per group, a tree above the groups, and versions after changes of leaves.

Nodes of a group are gathered in runs of eight, level by level. Four levels make an aligned block of 4,096 nodes, which
one task holds; the tops of the blocks are the nodes of the next storey, which is cut into blocks again, and so on. A
tree is never changed: a version after the change of a leaf has nodes of its own on the way from that leaf to the root
and shares all others with the tree it came from. Digests are SHA-256 in lowercase hexadecimal, and a node's is that of
the texts of its children's, one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthtide.llm.common import settled, small

#: Children of a node.
FAN_OUT = 8
#: Levels within a block, and the nodes of its lowest level.
BLOCK_LEVELS = 4
BLOCK = FAN_OUT**BLOCK_LEVELS

#: The nodes beside a way up: for each level those before it in its run, and those after it.
Path = list[tuple[list[str], list[str]]]

_PATH = "array<struct<before: array<string>, after: array<string>>>"
_PATH_TYPE = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))
#: Groups whose paths, of up to some kilobytes each, are broadcast at most.
_FEW_GROUPS = 10_000
_IN_PART = 33  # bits of monotonically_increasing_id that count rows within a partition


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: of each value its size in bytes, a colon and its text; a hyphen for null."""
    texts = [v.cast("string") for v in values]
    told = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*told), 256)


def node(children: Sequence[str]) -> str:
    """Digest of a run of nodes."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN_OUT), levels + 1
    return levels


class Tree:
    """So many levels over consecutive nodes; the last run of a level may be shorter. Its nodes never change."""

    def __init__(self, nodes: Sequence[str], levels: int) -> None:
        self.levels = [list(nodes)]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([node(below[i : i + FAN_OUT]) for i in range(0, len(below), FAN_OUT)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def node(self, level: int, at: int) -> str:
        return self.levels[level][at]

    def beside(self, at: int) -> Path:
        """The nodes beside the way up from a place of the lowest level."""
        found = []
        for below in self.levels[:-1]:
            start = at - at % FAN_OUT
            found.append((below[start:at], below[at + 1 : start + FAN_OUT]))
            at //= FAN_OUT
        return found

    def changed(self, at: int, leaf: str) -> Version:
        """The version of this tree with another leaf at a place."""
        return Version(self, at, fold(leaf, self.beside(at)))


@dataclass(frozen=True)
class Version:
    """A tree after the change of one leaf: the nodes copied, from the leaf up; all others are those of the tree."""

    base: Tree
    at: int
    copied: list[str] = field(repr=False)

    @property
    def top(self) -> str:
        return self.copied[-1]

    def node(self, level: int, at: int) -> str:
        return self.copied[level] if at == self.at // FAN_OUT**level else self.base.node(level, at)


def fold(leaf: str, path: Path) -> list[str]:
    """A leaf and the nodes above it, up along a path."""
    way = [leaf]
    for before, after in path:
        way.append(node([*before, way[-1], *after]))
    return way


def _numbered(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """rows with each one's place in its group (at) and the group's size, in this order; rows equal in it by where they lie.

    Ranges of group and order are dealt out and sorted, so that many tasks share a large group; what is summed up are
    the numbers of rows by group and partition.
    """
    order = [F.col("group").asc_nulls_first(), *order, F.col("_at").asc()]
    # Written first: the ranges are found by a pass of their own.
    rows = settled(rows.withColumn("_at", F.monotonically_increasing_id()))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at")
    ranged = settled(ranged.withColumn("_seq", F.monotonically_increasing_id()))
    part = F.shiftright("_seq", _IN_PART)
    in_group = Window.partitionBy("_group")  # a row for each partition
    counts = ranged.groupBy(F.col("group").alias("_group"), part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    counts = counts.withColumns({"_before": F.sum("_n").over(in_group.orderBy("_part")) - F.col("_n"), "size": F.sum("_n").over(in_group)})
    joined = ranged.join(small(counts), F.col("group").eqNullSafe(F.col("_group")) & (part == F.col("_part")))
    return joined.withColumn("at", F.col("_seq") - F.col("_first") + F.col("_before")).drop("_seq", "_first", "_before", "_n", "_part", "_group")


def _group_key() -> Column:
    """The group, null told apart from all texts."""
    return F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")).alias("_key")


def _block() -> Column:
    return F.floor(F.col("at") / BLOCK).alias("_block")


def _tree(nodes: pa.Table) -> Tree:
    """Of the sorted nodes of a block."""
    return Tree(nodes["leaf"].to_pylist(), min(BLOCK_LEVELS, height(nodes["size"][0].as_py())))


def _tops(nodes: DataFrame) -> DataFrame:
    """The next storey: (group, at, size, leaf) of the top of each block of nodes (group, at, size, leaf)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, size = table["at"][0].as_py() // BLOCK, -(-table["size"][0].as_py() // BLOCK)
        columns = [table["group"].slice(0, 1), pa.array([at], pa.int64()), pa.array([size], pa.int64()), pa.array([_tree(table).top])]
        return pa.table(columns, names=["group", "at", "size", "leaf"])

    nodes = nodes.select("group", "at", "size", "leaf")
    return nodes.groupBy(_group_key(), _block()).applyInArrow(run, "group string, at long, size long, leaf string")


def _with_path(nodes: DataFrame, paths: DataFrame, work: Callable[[pa.Table, Path, dict], pa.Table], schema: str) -> DataFrame:
    """work on each block of nodes (in order), the path above its top, and that path's row."""

    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        told = above.to_pylist()[0]
        return work(rows.sort_by("at"), [(p["before"], p["after"]) for p in told["path"]], told)

    blocks = nodes.groupBy(_group_key(), _block())
    return blocks.cogroup(paths.groupBy(_group_key(), F.col("at").alias("_block"))).applyInArrow(run, schema)


def _told(path: Path) -> list[dict]:
    return [{"before": before, "after": after} for before, after in path]


def _paths(nodes: DataFrame) -> DataFrame:
    """(group, at, path, root) of nodes (group, at, size, leaf): the path from each to the root of its group.

    Storeys are added until each group has one node left. Then paths come down: those within a block, on which the
    path of the block's top follows.
    """
    storeys = [settled(nodes)]
    while (storeys[-1].agg(F.max("size")).first()[0] or 0) > 1:
        storeys.append(settled(_tops(storeys[-1])))
    paths = storeys.pop().select("group", "at", F.array().cast(_PATH).alias("path"), F.col("leaf").alias("root"))

    def work(table: pa.Table, above: Path, told: dict) -> pa.Table:
        tree = _tree(table)
        found = pa.array([_told(tree.beside(k) + above) for k in range(table.num_rows)], _PATH_TYPE)
        roots = pa.array([told["root"]] * table.num_rows, pa.string())
        return pa.table([table["group"], table["at"], found, roots], names=["group", "at", "path", "root"])

    while storeys:
        paths = settled(_with_path(storeys.pop(), paths, work, f"group string, at long, path {_PATH}, root string"))
    return paths


def manifest(rows: DataFrame) -> DataFrame:
    """Roots, proofs and versions of rows (group string, id long, leaf string, changed string).

    The leaves of a group ascend by id (null last), equal ids by leaf; the roots of all groups, in the order of the
    groups (null first, then by bytes), are the leaves of the tree above them. changed is what a row's leaf becomes in
    the version that changes this row alone; null where there is no such version. Returned are group, id, at (place in
    the group), leaf, subroot, root, proof (the nodes beside the way up, from the leaf's run to the root), copied (the
    nodes that the row's version has for itself, from the changed leaf up, null without a version) and folded_root, the
    root computed from the changed leaf, or else the leaf, and the proof.
    Repeated rows are leaves of their own. No rows give no rows.
    """
    leaves = _numbered(rows.select("group", "id", "leaf", "changed"), [F.col("id").asc_nulls_last(), F.col("leaf").asc()])
    below = _paths(_tops(leaves))
    subroots = below.where("at = 0").select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("leaf"))
    ranked = settled(_numbered(subroots, [F.col("name").asc_nulls_first()]))
    over = _paths(ranked.drop("name")).select("at", F.col("path").alias("_over"), F.col("root").alias("top"))
    named = ranked.select("at", "name").join(over, "at").select("name", "_over", "top")
    joined = below.join(small(named, _FEW_GROUPS), F.col("group").eqNullSafe(F.col("name")))
    paths = joined.select("group", "at", F.concat("path", "_over").alias("path"), F.col("root").alias("subroot"), F.col("top").alias("root"))

    def work(table: pa.Table, above: Path, told: dict) -> pa.Table:
        tree, proofs, copied, folded = _tree(table), [], [], []
        for at, (leaf, changed) in enumerate(zip(table["leaf"].to_pylist(), table["changed"].to_pylist())):
            beside = tree.beside(at)
            proofs.append([digest for before, after in (*beside, *above) for digest in (*before, *after)])
            if changed is None:
                copied.append(None)
                folded.append(fold(leaf, [*beside, *above])[-1])
            else:
                within = tree.changed(at, changed)
                copied.append([*within.copied, *fold(within.top, above)[1:]])
                folded.append(copied[-1][-1])
        n, texts = table.num_rows, pa.list_(pa.string())
        columns = [pa.array([told["subroot"]] * n), pa.array([told["root"]] * n), pa.array(proofs, texts), pa.array(copied, texts), pa.array(folded)]
        kept = [table[c] for c in ("group", "id", "at", "leaf")]
        return pa.table([*kept, *columns], names=["group", "id", "at", "leaf", "subroot", "root", "proof", "copied", "folded_root"])

    schema = "group string, id long, at long, leaf string, subroot string, root string, proof array<string>, copied array<string>, folded_root string"
    return _with_path(leaves, paths, work, schema)
