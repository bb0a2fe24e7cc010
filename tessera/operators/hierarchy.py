"""Hierarchy roll-ups over parent/child tables.

Input: ``(tree_id, node_id, parent_id, side, value)`` -- one row per node,
``parent_id`` NULL at a root, ``side`` 'L' / 'R' under an operator node.  Node
ids are unique within a tree only, so every join and group uses both ids.
Both operators are loops of joins; the driver holds counts alone.  Each
round is a reliable checkpoint in the shared folder, so nothing is recomputed
when an executor is lost.  Nodes that no root reaches (a cycle, or a parent
that does not exist) raise :class:`TreeError`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

# --- fixed values: operator codes of expression trees ------------------------------
OP_ADD = -1
OP_SUBTRACT = -2
OP_DIVIDE = -3          # truncating division toward zero
# any other negative value multiplies
# ------------------------------------------------------------------------------


class TreeError(ValueError):
    """Some nodes are on a cycle or below a missing parent."""


def _doubled(state: DataFrame) -> DataFrame:
    """One round of pointer doubling: a node that knows the 2^k-th node above it learns the 2^(k+1)-th, and the sum up to it."""
    up = state.select(F.col("tree_id").alias("t"), F.col("node_id").alias("up"), F.col("above").alias("a"), F.col("top").alias("o"),
                      F.col("total").alias("s"), F.col("steps").alias("d"))
    met = state.join(up, (F.col("tree_id") == F.col("t")) & (F.col("above") == F.col("up")), "left")
    return met.select("tree_id", "node_id", F.col("a").alias("above"), F.coalesce("o", "top").alias("top"),
                      (F.col("total") + F.coalesce("s", F.lit(0))).alias("total"), (F.col("steps") + F.coalesce("d", F.lit(0))).alias("steps"))


def branch_sums(nodes: DataFrame) -> DataFrame:
    """For every leaf, the sum of values on the path from its root.

    Pointer doubling: each node keeps the node 2^k above it, the sum of the
    nodes below that one and their number; a round joins a node to the one it
    points at, so a tree of depth d takes log2(d) rounds, each one join and one
    checkpoint.  ``path`` (node ids root->leaf) orders leaves left to right; it
    is spelled out for leaves alone, from the pointers of the rounds: every
    place on a path is a sum of powers of two.  A leaf is a node without
    children.
    """
    edges = cut_lineage(nodes.select("tree_id", "node_id", "parent_id", "value"))
    inner = edges.where(F.col("parent_id").isNotNull()).select("tree_id", F.col("parent_id").alias("node_id")).distinct()
    lost = inner.join(edges, ["tree_id", "node_id"], "left_anti").count()
    if lost:
        raise TreeError(f"{lost} parents do not exist")
    total = edges.count()
    state = edges.select("tree_id", "node_id", F.col("parent_id").alias("above"), F.col("node_id").alias("top"),
                         F.col("value").cast("bigint").alias("total"), F.lit(1).cast("bigint").alias("steps"))
    pointers = []
    while True:
        jumps = state.where(F.col("above").isNotNull()).select("tree_id", "node_id", "above")
        if jumps.isEmpty():
            break
        if 1 << len(pointers) > total:  # nothing lies that far above anything
            raise TreeError("nodes above each other, or reached twice")
        pointers.append(jumps)
        state = cut_lineage(_doubled(state))
    leaves = cut_lineage(state.join(inner, ["tree_id", "node_id"], "left_anti"))
    # places on the paths: the leaf itself, then from the longest jumps down each place also jumps
    places = leaves.select("tree_id", F.col("node_id").alias("leaf"), "node_id", F.lit(0).cast("bigint").alias("up"))
    for k in reversed(range(len(pointers))):
        jump = pointers[k].select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "above")
        far = places.join(jump, (F.col("tree_id") == F.col("t")) & (F.col("node_id") == F.col("n"))).select(
            "tree_id", "leaf", F.col("above").alias("node_id"), (F.col("up") + (1 << k)).alias("up"))
        places = cut_lineage(places.unionByName(far))
    # one path per leaf: the output row itself
    path = places.groupBy("tree_id", F.col("leaf").alias("node_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("p"), F.col("node_id").cast("string").alias("n")))), lambda x: x["n"]).alias("path"))
    return leaves.join(path, ["tree_id", "node_id"]).select(
        "tree_id", F.col("node_id").alias("leaf_id"), F.col("top").alias("root_id"), F.col("total").alias("branch_sum"), F.col("steps").cast("int").alias("depth"), "path")


def evaluate(nodes: DataFrame) -> DataFrame:
    """H02 + F19: bottom-up value of every root.

    Leaves (value >= 0) are their value; operator nodes combine their 'L' and
    'R' children (a missing child counts 0): -1 add, -2 subtract, -3 divide
    toward zero (NULL when dividing by zero), other negatives multiply.  An
    operator keeps the sums of the children that have a value; once all have
    one it gets its own and hands it to its parent, so a round is one aggregate
    of the new values, one join and one checkpoint of the operators still
    open, and there are as many rounds as the highest tree has levels of
    operators.  No depth has to be known.
    """
    nodes = nodes.select("tree_id", "node_id", "parent_id", "side", "value")
    leaf = F.col("value") >= 0
    ops = nodes.where(~leaf).withColumnRenamed("value", "op")
    below = _handed_up(nodes, F.when(leaf, F.col("value").cast("bigint")), leaf)
    zero = F.lit(0).cast("bigint")
    joined = ops.join(below, ["tree_id", "node_id"], "left").select(
        *ops.columns, F.coalesce("kids", zero).alias("kids"), F.coalesce("known", zero).alias("known"), F.coalesce("l", zero).alias("l"), F.coalesce("r", zero).alias("r"))
    roots = [nodes.where(leaf & F.col("parent_id").isNull()).select("tree_id", F.col("value").cast("bigint").alias("result"))]
    left = None
    while left != 0:
        state = cut_lineage(joined)
        done, pending = state.where("known = kids"), state.where("known < kids")
        roots.append(done.where("parent_id is null").select("tree_id", _value().alias("result")))
        now = pending.count()
        if now and now == left:
            raise TreeError(f"{now} operator nodes wait for each other")
        left = now
        new = _handed_up(done, _value(), F.lit(True)).select(
            "tree_id", "node_id", F.col("known").alias("n"), F.col("l").alias("nl"), F.col("r").alias("nr"))
        add = lambda old, more: (F.col(old) + F.coalesce(more, zero)).alias(old)
        joined = pending.join(new, ["tree_id", "node_id"], "left").select(
            *ops.columns, "kids", add("known", "n"), add("l", "nl"), add("r", "nr"))
    return reduce(DataFrame.unionByName, roots)


def _handed_up(nodes: DataFrame, value: Column, known: Column) -> DataFrame:
    """Per parent: children, children with a value, and the sums of their values on the left and the right."""
    return nodes.where(F.col("parent_id").isNotNull()).groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(
        F.count(F.lit(1)).alias("kids"), F.count(F.when(known, 1)).alias("known"),
        F.sum(F.when(F.col("side") == "L", value)).alias("l"), F.sum(F.when(F.col("side") == "R", value)).alias("r"))


def _value() -> Column:
    """The value of an operator whose children are all known."""
    a, b, op = F.col("l"), F.col("r"), F.col("op")
    return F.when(op == OP_ADD, a + b).when(op == OP_SUBTRACT, a - b).when(
        op == OP_DIVIDE, F.when(b != 0, F.expr("l div r"))).otherwise(a * b).cast("bigint")
