"""Connected components of an edge table, by repeated contraction.

A graph of at most ``SMALL`` edges, counted first, is solved in one task. A
larger one shrinks in rounds until it is that small.

Each round every vertex hooks onto the neighbour (or itself) with the smallest
hash under that round's seed, and edges are moved to the hooks; the random
order shrinks the graph by a constant factor a round whatever the shape of the
components. Rounds are written to the shared folder, so nothing depends on the
lineage of earlier ones. Neighbourhood minima are combined before the shuffle,
so a vertex with very many edges is no burden.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import stored

SMALL = 200_000  # edges


def _solve(edges: DataFrame) -> DataFrame:
    """(v, root) of a small graph, in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if held is None or not held.num_rows:
            return
        ends = pa.concat_arrays([held.column(c).combine_chunks() for c in ("a", "b")]).dictionary_encode()
        code = ends.indices.to_numpy().reshape(2, -1).T.tolist()
        parent = list(range(len(ends.dictionary)))
        for i, j in code:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            while parent[j] != j:
                parent[j] = parent[parent[j]]
                j = parent[j]
            parent[i] = j
        roots = np.arange(len(parent))
        up = np.array(parent)
        while (up[roots] != roots).any():
            roots = up[roots]
        yield pa.RecordBatch.from_arrays([ends.dictionary, ends.dictionary.take(pa.array(roots))], names=["v", "root"])

    return edges.select("a", "b").coalesce(1).mapInArrow(run, f"v {kind}, root {kind}")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every vertex of ``edges`` with the smallest id of its
    component. Null ends and loops are ignored; repeated edges count once."""
    spark = edges.sparkSession

    def tidy(e: DataFrame) -> DataFrame:
        return (e.where(F.col("a") != F.col("b"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    live = stored(spark, tidy(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    hooks: list[DataFrame] = []
    while (n := live.count()) > SMALL:
        seed = F.lit(len(hooks))
        order = lambda c: F.struct(F.xxhash64(F.col(c), seed).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        sides = live.select("a", order("b").alias("o")).union(live.select("b", order("a")))
        near = sides.groupBy("a").agg(F.min("o").alias("o"))
        hook = stored(spark, near.select(F.col("a").alias("v"), F.least("o", order("a"))["v"].alias("to")), "hooks")
        moved = (live.join(hook.select(F.col("v").alias("a"), F.col("to").alias("x")), "a")
                 .join(hook.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
                 .select(F.col("x").alias("a"), F.col("y").alias("b")))
        live = stored(spark, tidy(moved), "edges")
        hooks.append(hook)
    if not n and not hooks:
        return live.select(F.col("a").alias("id"), F.col("a").alias("component"))
    # a vertex that a hook leads to may hook on in a later round
    roots = _solve(live)
    for hook in reversed(hooks):
        later = roots.select(F.col("v").alias("to"), "root")
        roots = hook.join(later, "to", "left").select("v", F.coalesce("root", "to").alias("root"))
    roots = stored(spark, roots, "roots")
    least = roots.groupBy("root").agg(F.min("v").alias("component"))
    return stored(spark, roots.join(least, "root").select(F.col("v").alias("id"), "component"), "components")
