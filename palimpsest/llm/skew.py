"""Joins whose keys may be hot, and connected components, without hot tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.storage import Scratch

HOT_SHARE = 1_000  # A key is hot with more than this part of all rows; fewer keys than this can be.


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows with `groups`, one written row per key, on `key`. `size` says how many rows a key has.

    Hot keys are joined by broadcast, fewer than HOT_SHARE rows whatever the data; the rest as Spark sees fit.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_SHARE > total
    mark = "is_hot_key"
    head = rows.join(F.broadcast(groups.where(hot).withColumn(mark, F.lit(True))), key, "left")
    tail = head.where(F.col(mark).isNull()).select(*rows.columns).join(groups.where(~hot), key)
    return head.where(mark).drop(mark).unionByName(tail)


def components(nodes: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(v, c): every node with the smallest node of its component. `nodes` is such a table to begin with, `links`
    has the columns (a, b).

    Links are lifted to the components of `nodes` once. Each turn then hooks every component to the smallest one it is
    linked with, follows the hooks to their ends and lifts the links to these; many links between the same components
    become one, so tables shrink from turn to turn. Nodes are told where they have come to at the end.
    """
    roots = nodes.select(F.col("v").alias("a"), F.col("c").alias("ca"))
    degree = scratch.keep(links.groupBy("a").agg(F.count("*").alias("n")).join(roots, "a").select("a", "n", "ca"), f"{name}-degree")
    lifted = hot_join(links, degree, "a", "n").join(nodes.select(F.col("v").alias("b"), F.col("c").alias("cb")), "b")
    moves, turn = None, 0  # (a, b): where a component has gone.
    while True:
        turn += 1
        links = lifted.where("ca <> cb").select(F.least("ca", "cb").alias("b"), F.greatest("ca", "cb").alias("a"))
        links = scratch.keep(links.distinct(), f"{name}-links-{turn}")
        if links.isEmpty():
            break
        hooks = scratch.keep(links.groupBy("a").agg(F.min("b").alias("b"), F.count("*").alias("n")), f"{name}-hooks-{turn}")
        jump, moved = 0, True
        while moved:  # Hooks lead to smaller nodes, so they end; each pass halves the way.
            jump += 1
            ahead = hooks.select(F.col("a").alias("b"), F.col("b").alias("next"))
            further = hooks.join(ahead, "b", "left").select("a", "n", F.coalesce("next", "b").alias("b"), F.col("next").isNotNull().alias("moved"))
            further = scratch.keep(further, f"{name}-hooks-{turn}-{jump}")
            moved = not further.where("moved").isEmpty()
            hooks = further.select("a", "n", "b")
        ends = hooks.select(F.col("a").alias("b"), F.col("b").alias("cb"))
        lifted = hot_join(links, hooks.select("a", "n", F.col("b").alias("ca")), "a", "n").join(ends, "b", "left")
        lifted = lifted.select("ca", F.coalesce("cb", "b").alias("cb"))
        if moves is not None:  # Only components that have not moved yet have hooks.
            moves = moves.join(ends, "b", "left").select("a", F.coalesce("cb", "b").alias("b"))
            moves = scratch.keep(moves.unionByName(hooks.select("a", "b")), f"{name}-moves-{turn}")
        else:
            moves = hooks.select("a", "b")
    if moves is None:
        return nodes
    lower = moves.select(F.col("a").alias("c"), F.col("b").alias("lower"))
    target = nodes.groupBy("c").agg(F.count("*").alias("n")).join(lower, "c", "left").select("c", "n", F.coalesce("lower", "c").alias("lower"))
    target = scratch.keep(target, f"{name}-target")
    return scratch.keep(hot_join(nodes, target, "c", "n").select("v", F.col("lower").alias("c")), f"{name}-nodes")
