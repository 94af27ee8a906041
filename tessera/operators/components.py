"""Connected components over an edge DataFrame.

Alternating large-star / small-star contraction (Kiveris et al., SoCC 2014):
every round rewires edges towards the smallest neighbour, so paths of length n
contract in O(log n) rounds.  Before the first round every task turns the edges
it holds into stars, which settles small inputs and shortens long paths.  All
state stays distributed; each round is a written table in the shared folder, so
a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import discard, materialize

#: Edges that a task folds into stars at a time.
BLOCK = 1 << 20


def _star(edges: DataFrame, large: bool, kept: list[str]) -> DataFrame:
    """One star step. Edges are (u, v) with u > v.

    The smallest neighbours are written first, so the join with them has plain exchanges on both sides and a node with
    very many neighbours can be split over tasks (AQE); where they are few they are broadcast and no edge moves.
    """
    if large:
        sym = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sym = edges.select("u", "v")
    low = materialize(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low", kept)
    joined = sym.join(low, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (u, v) as stars: every node but the smallest of its component, and that smallest node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := root[root], root):
            root = above
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task as stars, in blocks that hold about ``BLOCK`` edges at once."""
    held: list[pa.RecordBatch] = []

    def fold() -> pa.RecordBatch:
        columns = [pa.chunked_array([x.column(i) for x in held]) for i in (0, 1)]
        stars = contracted(*[c.to_numpy() for c in columns])
        return pa.RecordBatch.from_arrays([pa.array(s, type=c.type) for s, c in zip(stars, columns, strict=True)], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= BLOCK:
            held = [fold()]
            if 2 * held[0].num_rows > BLOCK:  # few of these edges meet: the rounds join them
                yield held.pop()
    if held:
        yield fold()


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one smaller node that points to none."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("root")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up + root > 1 and up > 0").isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 64) -> DataFrame:
    """Label every node that has an edge with the smallest node id of its component.

    Self loops and nulls are ignored; repeated edges are harmless.  Ids are
    numbers or strings.  Returns ``(id, component)`` with one row per node, the
    smallest node included.
    """
    kept: list[str] = []
    old: list[str] = []
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u > v").distinct()
    now = materialize(pairs.mapInArrow(_contract, pairs.schema), "cc", kept)
    for _ in range(max_rounds):
        if _settled(now):
            break
        old, kept = kept, []
        wide = materialize(_star(now, True, old), "cc", old)
        now = materialize(_star(wide, False, old), "cc", kept)
        discard(spark, old)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
