"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.session import materialise_counted

_EDGE = "u long, v long"
# edges reduced together inside a task; bounds its memory, not the result
_CHUNK_EDGES = 1_000_000
_COMPOSE_STEP = 8


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Replace edges by one edge per node to the smallest node it reaches among them."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        low = np.minimum(la[apart], lb[apart])
        np.minimum.at(label, la[apart], low)
        np.minimum.at(label, lb[apart], low)
        while True:
            onward = label[label]
            if np.array_equal(onward, label):
                break
            label = onward
        a, b = a[apart], b[apart]
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[label[moved]]), pa.array(nodes[moved])], names=["u", "v"]
    )


def _reduce_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_u, held_v, held = [], [], 0
    for batch in batches:
        held_u.append(batch.column("u").to_numpy())
        held_v.append(batch.column("v").to_numpy())
        held += batch.num_rows
        if held >= _CHUNK_EDGES:
            yield _stars(np.concatenate(held_u), np.concatenate(held_v))
            held_u, held_v, held = [], [], 0
    if held:
        yield _stars(np.concatenate(held_u), np.concatenate(held_v))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node with an edge; component = smallest node.

    Contraction rounds: every node moves to the best-ranked of itself and its
    neighbours, edges are rewritten to the new nodes, finished components leave
    the edge table. Even rounds rank by id, which finishes stars at once; odd
    rounds rank by a pseudo-random number that changes each time, so no layout
    of ids can force one round per link of a chain (Bögeholz, Brand, Todor 2020):
    the expected number of rounds is logarithmic in the number of nodes.

    Before each round every task replaces its chunks of edges by a spanning star
    per chunk, a map-side combine that also removes duplicates. Minima combine
    map-side as well, so a hub with a large share of the edges needs no single task.
    """
    left, right = F.col(src).cast("long"), F.col(dst).cast("long")
    start = edges.select(left.alias("u"), right.alias("v")).filter("u <> v")
    live, n_live = materialise_counted(start.mapInArrow(_reduce_edges, _EDGE), "edges")
    moves = []
    while n_live:
        seed = len(moves)
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))

        def rank(node: str, seed: int = seed):
            return F.xxhash64(node, F.lit(seed)) if seed % 2 else F.col(node)

        best = both.groupBy("u").agg(
            F.min_by("v", rank("v")).alias("v"), F.min(rank("v")).alias("rank")
        )
        move, _ = materialise_counted(
            best.select(
                F.col("u").alias("node"),
                F.when(F.col("rank") < rank("u"), F.col("v")).otherwise(F.col("u")).alias("to"),
            ),
            "moves",
        )
        moves.append(move)
        rewritten = (
            live.join(move.select(F.col("node").alias("u"), F.col("to").alias("nu")), "u")
            .join(move.select(F.col("node").alias("v"), F.col("to").alias("nv")), "v")
            .select(F.col("nu").alias("u"), F.col("nv").alias("v"))
            .filter("u <> v")
        )
        live, n_live = materialise_counted(rewritten.mapInArrow(_reduce_edges, _EDGE), "edges")
    if not moves:
        return live.select(F.col("u").alias("node"), F.col("v").alias("component"))

    # follow the moves from the last (smallest) round back to the first
    end = moves[-1]
    for step, move in enumerate(reversed(moves[:-1]), start=1):
        after = end.select(F.col("node").alias("to"), F.col("to").alias("end"))
        end = move.join(after, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
        if step % _COMPOSE_STEP == 0:
            end, _ = materialise_counted(end, "moves")
    end, _ = materialise_counted(end, "components")
    smallest = end.groupBy("to").agg(F.min("node").alias("component"))
    return end.join(smallest, "to").select("node", "component")
