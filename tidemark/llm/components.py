"""Connected components of a distributed edge list.

Each round every vertex points at its smallest neighbour, pointers are
doubled until they reach a root, and the edges between different roots go to
the next round: at most half of the vertices that still have an edge are
roots. Tables are written between steps; nothing is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_groups
from tidemark.session import materialize


def _follow(rows: DataFrame, column: str, pointers: DataFrame, total: int) -> DataFrame:
    """``column`` replaced by what it points at (itself where nothing)."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    to = counts.join(pointers.select(F.col("v").alias(column), F.col("to").alias("__to")), column)
    out = join_groups(rows, to, [column], "__n", total, [c for c in rows.columns if c != column])
    return out.withColumn(column, F.coalesce("__to", column)).select(*rows.columns)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(v, root)`` for every vertex of an edge; equal roots, one component.

    Defined cases: loops and repeated edges are allowed; an empty edge list
    gives an empty result; vertices must not be NULL.
    """
    both = edges.select(F.col(a).alias("v"), F.col(b).alias("u")).where("v <> u")
    live = materialize(both.unionByName(both.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct(),
                       name="cc-edges")
    roots = None
    while not live.isEmpty():
        pointers = materialize(live.groupBy("v").agg(F.min("u").alias("m"))
                               .select("v", F.least("v", "m").alias("to")), name="cc-pointers")
        size = pointers.count()
        while True:  # pointer doubling until all point at roots
            doubled = materialize(_follow(pointers, "to", pointers, size), name="cc-doubled")
            moved = doubled.select("v", F.col("to").alias("t2")).join(pointers, "v").where("t2 <> to")
            done = moved.isEmpty()
            pointers = doubled
            if done:
                break
        if roots is None:
            roots = pointers.select("v", F.col("to").alias("root"))
        else:
            merged = _follow(roots, "root", pointers, roots.count())
            roots = materialize(merged, name="cc-roots")
        n = live.count()
        moved_edges = _follow(_follow(live, "v", pointers, n), "u", pointers, n)
        live = materialize(moved_edges.where("v <> u").distinct(), name="cc-edges")
    if roots is None:
        return live.select("v", F.col("u").alias("root"))
    return roots
