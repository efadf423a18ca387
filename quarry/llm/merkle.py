"""Merkle dataset manifest: a witness for every row, extended as the rows after it arrive.

A tree has ``ARITY`` children a node. Its nodes are appended in order. A node
that is appended joins the open run of its level; when the run has all its
siblings it closes: every child's witness gets its step (the siblings left
and right of it), and the run's digest is appended one level up. A child
stands for the whole subtree below it, so one step extends the witnesses of
all rows in that subtree (``Frontier``).

Distributed, rows append in aligned blocks of ``ARITY ** HEIGHT``:
a task appends one block and gives its root; the roots of a tree's blocks are
further appends of the same kind (``witnesses`` calls itself on them, so the
number of roots falls as much each time), and a root's witness extends
those of its block. Rows of digests are shuffled, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.frames import col
from quarry.operators.util import bounded_broadcast, checkpoint, with_global_index

ARITY = 8
HEIGHT = 4

Step = tuple[str, str]  # digests left of the node in its run, digests right of it, end to end


def digest(parts: Sequence[str]) -> str:
    """Lower-case hex sha256 of the parts, end to end."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Frontier:
    """Appends digests one by one; keeps only the open run of each level and the steps already known."""

    def __init__(self) -> None:
        self.open: list[list[str]] = [[]]
        self.total = [0]
        self.steps: list[list[Step]] = [[]]

    def append(self, node: str, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
            self.total.append(0)
            self.steps.append([])
        self.open[level].append(node)
        self.total[level] += 1
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.steps[level] += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
        self.append(digest(run), level + 1)

    def close(self, height: int | None = None) -> str:
        """The root: after ``height`` levels, or where one node remains. Runs that are short close as they are."""
        level = 0
        while level < height if height is not None else self.total[level] > 1:
            if self.open[level]:
                self._complete(level)
            level += 1
        self.height = level
        return self.open[level][0]

    def witness(self, i: int) -> list[Step]:
        """Steps of the ``i``-th appended node from its own level up to the root; after ``close``."""
        return [self.steps[level][i // ARITY**level] for level in range(self.height)]


def _appended(nodes: pa.Table, height: int) -> tuple[Frontier, str]:
    """One block, in order. A tree's only block ends where one node remains; others are of equal height."""
    whole = Frontier()
    for d in nodes.column("digest").to_pylist():
        whole.append(d)
    return whole, whole.close(height if nodes.column("n")[0].as_py() > ARITY**height else None)


def _block_root(height: int):
    def root_of(key: tuple[pa.Scalar, ...], nodes: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        _, root = _appended(nodes.sort_by("pos"), height)
        blocks = -(-nodes.column("n")[0].as_py() // ARITY**height)
        return pa.table({"tree": pa.array([tree], pa.int64()), "pos": pa.array([block], pa.int64()), "n": pa.array([blocks], pa.int64()), "digest": [root]})

    return root_of


_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _extended(height: int):
    def rows_of(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        """A block's rows with their witnesses in the block, then that of the block's root, and the roots beside it."""
        nodes = nodes.sort_by("pos")
        appended, _ = _appended(nodes, height)
        above = [(s["before"], s["after"]) for s in upper.column("_above")[0].as_py()]
        steps = [appended.witness(i) + above for i in range(len(nodes))]
        ends = [0]
        for w in steps:
            ends.append(ends[-1] + len(w))
        flat = [s for w in steps for s in w]
        pairs = pa.StructArray.from_arrays([pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())], fields=list(_STEPS.value_type))
        out = nodes.drop_columns(["_block"]).append_column("witness", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs, type=_STEPS))
        for name in ("subroot", "root"):
            out = out.append_column(name, pa.array([upper.column(f"_{name}")[0].as_py()] * len(nodes), pa.string()))
        return out

    return rows_of


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("_block", F.expr(f"pos div {ARITY**height}"))


def block_witnesses(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``(tree, _block, _above, _subroot)``: of every block, the witness of its root in its tree and the tree's root."""
    light = _blocks(nodes.select("tree", "pos", "n", "digest"), height)
    roots = checkpoint(light.groupBy("tree", "_block").applyInArrow(_block_root(height), "tree long, pos long, n long, digest string"))
    if roots.where("n > 1").limit(1).count():
        above = witnesses(roots, height)
        return checkpoint(above.select("tree", F.col("pos").alias("_block"), F.col("witness").alias("_above"), F.col("subroot").alias("_subroot")))
    none = F.array().cast("array<struct<before:string,after:string>>")
    return roots.select("tree", F.col("pos").alias("_block"), none.alias("_above"), F.col("digest").alias("_subroot"))


def extend(nodes: DataFrame, upper: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``nodes`` with ``witness``, ``subroot`` and ``root`` from ``(tree, _block, _above, _subroot, _root)``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    schema = f"{fields}, witness array<struct<before:string,after:string>>, subroot string, root string"
    return _blocks(nodes, height).groupBy("tree", "_block").cogroup(upper.groupBy("tree", "_block")).applyInArrow(_extended(height), schema)


def witnesses(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``nodes`` with ``witness array<struct<before, after>>``, and the root of each one's tree as ``subroot`` and ``root``.

    ``nodes`` has ``tree long`` (not null), ``pos long`` (0, 1, .. gapless in
    a tree), ``n long`` (nodes of the tree) and ``digest string``; columns
    named like the new ones or ``_block`` must not be there, others pass. It
    is read twice, so pass a written table. A task holds one block of
    ``ARITY ** height`` nodes, however many a tree has. No nodes give no rows.
    """
    return extend(nodes, block_witnesses(nodes, height).withColumn("_root", F.col("_subroot")), height)


def leaf(*values: Column) -> Column:
    """Digest of a row's values: ``-`` for a null, else UTF-8 byte count, ``:``, the value as text."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(witness, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_digest(witness: Column) -> Column:
    """Digest of all siblings of a witness, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(rows: DataFrame, tree: str = "lang", order: str = "doc_id", leaf_col: str = "leaf", keep: tuple[str, ...] = (),
             height: int = HEIGHT) -> DataFrame:
    """Every row's leaf with its witness up to the root of all trees.

    Rows of one ``tree`` value (null is a value of its own) form a tree in
    ascending ``order`` (null first, equal ones by leaf); the trees' roots,
    by ``tree`` bytewise with null first, are the leaves of the tree above.
    Returns ``<tree>, <order>, leaf, pos, witness, subroot, root`` and the
    columns of ``keep``: one row per input row, repeated rows and all. The
    rows should hold digests and keys only: they are sorted and written.
    Empty input gives no rows.
    """
    rows = checkpoint(rows.select(col(tree).alias("_tree"), col(order).alias("_order"), col(leaf_col).alias("digest"), *[col(c).alias(f"_k{i}") for i, c in enumerate(keep)]))
    # equal rows part at their place in the input, so a third of all rows alike are still many ranges
    placed = with_global_index(rows.withColumn("_tie", F.monotonically_increasing_id()), ["_tree", "_order", "digest", "_tie"], "_idx").drop("_tie")
    trees = checkpoint(placed.groupBy("_tree").agg(F.min("_idx").alias("tree"), F.count(F.lit(1)).alias("n")))
    named = bounded_broadcast(trees.withColumnRenamed("_tree", "_name"))
    nodes = placed.join(named, F.col("_tree").eqNullSafe(F.col("_name"))).withColumn("pos", F.col("_idx") - F.col("tree"))
    nodes = nodes.drop("_name", "_idx")
    blocks = checkpoint(block_witnesses(nodes, height))
    # the trees' roots append to the tree above, in the order of the trees
    roots = blocks.where("_block = 0").select(F.col("tree").alias("start"), F.col("_subroot").alias("digest"))
    tops = checkpoint(with_global_index(roots, ["start"], "pos").withColumn("tree", F.lit(0).cast("long")).withColumn("n", F.lit(trees.count()).cast("long")))
    more = witnesses(tops, height).select(F.col("start").alias("tree"), F.col("witness").alias("_more"), F.col("root").alias("_root"))
    upper = blocks.join(more, "tree").select("tree", "_block", F.concat("_above", "_more").alias("_above"), "_subroot", "_root")
    return extend(nodes, upper, height).select(F.col("_tree").alias(tree), F.col("_order").alias(order), F.col("digest").alias("leaf"), "pos",
                                       "witness", "subroot", "root", *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)])
