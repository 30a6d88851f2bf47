"""Connected components of a table of links, by repeated contraction to smaller neighbours."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialise


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of one task as stars: each key but the smallest of its group, and that smallest."""
    keys, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    x, y = flat[:len(left)], flat[len(left):]
    root = np.arange(len(keys))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        if not open_.any():
            break
        x, y = x[open_], y[open_]
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(jump := root[root], root):
            root = jump
    moved = root != np.arange(len(keys))
    return keys[moved], keys[root[moved]]


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a`` and ``b``, long).

    The component is the smallest node reachable. Links may repeat, point either way, or join a
    node with itself; rows with a null end are no links. Each round gives every node the smallest
    of its neighbours, follows such steps twice, and goes on with the links between what is left,
    so their number falls at least by half, and long chains take a logarithm of their length.
    Rounds are written to the shared folder, so a lost executor costs no more than one of them.
    """
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    rest = materialise(links.where("a is not null and b is not null").select(a, b).distinct(),
                       "links")
    steps = []
    while True:
        ends = rest.select(F.explode(F.array(
            F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
        lowest = materialise(
            ends.groupBy("e.node").agg(F.min("e.other").alias("low"))
            .select("node", F.least("node", "low").alias("low")), "lowest")
        jump = lowest.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        step = materialise(lowest.join(jump, "low").select("node", F.col("lower").alias("low")),
                           "step")
        steps.append(step)
        at = step.select(F.col("node").alias("a"), F.col("low").alias("x"))
        to = step.select(F.col("node").alias("b"), F.col("low").alias("y"))
        moved = rest.join(at, "a").join(to, "b").where("x <> y")
        rest = materialise(moved.select(F.least("x", "y").alias("a"),
                                        F.greatest("x", "y").alias("b")).distinct(), "links")
        if rest.isEmpty():
            break
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("low"), F.col("low").alias("next"))
        found = found.join(later, "low", "left").select(
            "node", F.coalesce("next", "low").alias("low"))
    return found.select("node", F.col("low").alias("component"))
