"""Cosine similarity self-join: exact, partitioned by pivots, computed in blocks.

1. Equal vectors are reduced to their first id; copies are linked to it.
2. Some vectors become pivots. Every vector lives in the cell of its nearest pivot
   and is sent to another cell only if the bisecting plane between both pivots is
   close enough for a partner to be there (``x.p - x.q <= eps * |p - q|`` holds for
   every x that has a partner of cell q within chord distance eps). Of two cells
   the one with the lower number hosts the pair. Nothing that reaches the
   threshold is lost; how much is pruned depends on the data.
   Pivots that a sample shows to prune little are left out, down to a single cell, as each
   row would be copied to most of their cells.
3. Rows of a cell are split into blocks; a task multiplies two blocks, in tiles of bounded
   size. A cell with a large share of all rows is thus spread over many tasks. Beyond
   ``_BLOCKS`` blocks grow before they become more, up to ``_BLOCK_BYTES``, so the copies of a row
   do not grow with the input; the dot products do where vectors do not prune.

``links`` is the form for clustering: vectors within half the threshold angle of
their pivot are all similar to each other, so one link to the pivot replaces
their comparison, and every block gives a spanning forest instead of all its
pairs. Its output is linear in the input, with the same connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.operators.bloom import bloom_words, maybe_in
from newsight.session import bounded_batches, materialise, materialise_counted

# roles of a row in a cell
_LOOSE, _TIGHT, _FAR, _NEAR = 0, 1, 2, 3
# block comparisons: kind -> (role of side a, role of side b)
_PAIRINGS = {
    0: (_LOOSE, _LOOSE),
    1: (_LOOSE, _TIGHT),
    2: (_LOOSE, _FAR),
    3: (_LOOSE, _NEAR),
    4: (_TIGHT, _FAR),
}
_SLACK = 1e-9
# candidates sampled per pivot wanted
_OVERSAMPLE = 4
# cells that a row may be in on average, and the largest share of all cells that makes them worth it
_COPIES, _SHARE = 8, 0.25
# blocks of a cell, and bytes of vectors in a block from which on there are more
_BLOCKS, _BLOCK_BYTES = 8, 1 << 25
# places of rows and pivots that are looked at together
_NEAR_CELLS = 1 << 20


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column -> unit rows in double precision."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(values), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _spread(sample: list, wanted: int, threshold: float) -> tuple[list, np.ndarray]:
    """Up to ``wanted`` sampled rows, none within half the threshold angle of another.

    Otherwise a dense group would hold many pivots, and each of its rows would have
    to visit the cells of all of them.
    """
    rows = np.array([row.vec for row in sample], dtype=np.float64)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    half_angle = math.cos(math.acos(threshold) / 2.0)
    picked = []
    for i in range(len(rows)):
        if len(picked) == wanted:
            break
        if not picked or (rows[picked] @ rows[i]).max() < half_angle:
            picked.append(i)
    return [sample[i] for i in picked], rows[picked]


def _reach(near: np.ndarray, home: np.ndarray, apart: np.ndarray, threshold: float) -> np.ndarray:
    """Cells of lower number that may hold a partner of each row, from its products with the pivots."""
    eps = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    gap = near[np.arange(len(home)), home][:, None] - near
    reach = gap <= eps * apart[home] + _SLACK
    return reach & (np.arange(near.shape[1])[None, :] < home[:, None])


def _apart(pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (pivots @ pivots.T)))


def _useful(sample: list, pivots: np.ndarray, threshold: float) -> int:
    """How many of the pivots to use, from the cells that sampled rows would be in.

    Copies of rows grow with the cells they reach: where most cells are in reach, nothing is
    saved and one cell is enough.
    """
    rows = np.array([row.vec for row in sample[: 4 * _NEAR_CELLS // len(pivots)]], dtype=np.float64)
    near = rows @ pivots.T / np.linalg.norm(rows, axis=1, keepdims=True)
    apart, n = _apart(pivots), len(pivots)
    while n > 1:
        home = near[:, :n].argmax(axis=1)
        cells = 1 + _reach(near[:, :n], home, apart[:n, :n], threshold).sum() / len(rows)
        if cells <= min(_COPIES, max(2.0, _SHARE * n)):
            break
        n //= 2
    return n


def _assigner(pivots: np.ndarray, threshold: float, collapse: bool):
    apart = _apart(pivots)
    half_angle = math.cos(math.acos(threshold) / 2.0) + _SLACK
    step = max(1, _NEAR_CELLS // len(pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(lo, step) for batch in batches for lo in range(0, batch.num_rows, step))
        for batch in parts:
            vectors = _matrix(batch.column("vec"))
            near = vectors @ pivots.T
            home = near.argmax(axis=1)
            at = np.arange(len(home))
            reach = _reach(near, home, apart, threshold)
            within = near >= half_angle if collapse else np.zeros_like(near, dtype=bool)
            out_row, out_cell = np.nonzero(reach)
            row = np.concatenate([at, out_row])
            cell = np.concatenate([home, out_cell])
            role = np.concatenate([
                np.where(within[at, home], _TIGHT, _LOOSE),
                np.where(within[out_row, out_cell], _NEAR, _FAR),
            ])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row)),
                    batch.column("vec").take(pa.array(row)),
                    pa.array(cell.astype(np.int32)),
                    pa.array(role.astype(np.int32)),
                ],
                names=["id", "vec", "cell", "role"],
            )

    return assign


def _forest(close: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[list, list]:
    """Spanning forest of a bipartite closeness matrix."""
    src, dst = [], []
    row_free = close.any(axis=1)
    col_free = close.any(axis=0)
    for start in np.nonzero(row_free)[0]:
        if not row_free[start]:
            continue
        row_free[start] = False
        rows = [start]
        while rows:
            r = rows.pop()
            for c in np.nonzero(close[r] & col_free)[0]:
                col_free[c] = False
                src.append(left[r])
                dst.append(right[c])
                for n in np.nonzero(close[:, c] & row_free)[0]:
                    row_free[n] = False
                    src.append(left[n])
                    dst.append(right[c])
                    rows.append(n)
    return src, dst


def _close(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which products reach the threshold. Single precision finds the few that are computed in double."""
    rough = threshold - 1e-6 - 4 * left.shape[1] * float(np.finfo(np.float32).eps)
    close = left.astype(np.float32) @ right.astype(np.float32).T >= rough
    if close.sum() * 64 > close.size:
        return left @ right.T >= threshold
    at, to = np.nonzero(close)
    close[at, to] = np.einsum("ij,ij->i", left[at], right[to]) >= threshold
    return close


def _comparer(threshold: float, links_only: bool, tile: int):
    def compare(unit: pa.Table) -> pa.Table:
        ids = unit.column("id").to_numpy()
        side = unit.column("side").to_numpy()
        same = unit.column("kind")[0].as_py() == 0 and (
            unit.column("block_a")[0].as_py() == unit.column("block_b")[0].as_py()
        )
        in_a = side == 0
        in_b = in_a if same else ~in_a
        rows_a, rows_b = np.nonzero(in_a)[0], np.nonzero(in_b)[0]
        vectors = unit.column("vec").combine_chunks()
        found = [np.zeros((2, 0), np.int64)]
        for i in range(0, len(rows_a), tile):
            part = rows_a[i : i + tile]
            left = _matrix(vectors.take(pa.array(part)))
            for j in range(i if same else 0, len(rows_b), tile):
                other = rows_b[j : j + tile]
                close = _close(left, _matrix(vectors.take(pa.array(other))), threshold)
                if same and i == j:
                    close &= ids[part][:, None] != ids[other][None, :]
                if links_only:
                    src, dst = _forest(close, ids[part], ids[other])
                else:
                    at, to = np.nonzero(np.triu(close, 1) if same and i == j else close)
                    src, dst = ids[part][at], ids[other][to]
                src, dst = np.asarray(src, np.int64), np.asarray(dst, np.int64)
                found.append(np.array([np.minimum(src, dst), np.maximum(src, dst)]))
        src, dst = np.concatenate(found, axis=1)
        return pa.table({"src": src, "dst": dst})

    return compare


def _blocked(rows: DataFrame, block_rows: int, full_rows: int) -> DataFrame:
    """Give every row the block comparisons it takes part in.

    Blocks have ``block_rows`` rows while they are few and at most ``full_rows`` when they are many.
    """
    sizes = rows.groupBy("cell").pivot("role", [_LOOSE, _TIGHT, _FAR, _NEAR]).count()

    def blocks_of(role: int) -> Column:
        size = F.coalesce(F.col(str(role)), F.lit(0))
        few = F.least(F.ceil(size / block_rows), F.lit(_BLOCKS))
        return F.greatest(few, F.ceil(size / full_rows)).cast("int").alias(f"n{role}")

    blocks = sizes.select("cell", *[blocks_of(r) for r in (_LOOSE, _TIGHT, _FAR, _NEAR)])
    # one row per pivot, and the number of pivots is bounded
    placed = rows.join(F.broadcast(blocks), "cell")
    counts = F.array(*[F.col(f"n{r}") for r in (_LOOSE, _TIGHT, _FAR, _NEAR)])
    block = F.pmod(F.xxhash64("id"), F.element_at(counts, F.col("role") + 1)).cast("int")

    def partners(count: str, make) -> Column:
        none = F.array().cast("array<struct<kind:int,block_a:int,block_b:int,side:int>>")
        return F.when(
            F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)
        ).otherwise(none)

    def unit(kind, a, b, side):
        return F.struct(
            F.lit(kind).alias("kind"), a.cast("int").alias("block_a"),
            b.cast("int").alias("block_b"), side.cast("int").alias("side"),
        )

    mine = F.col("block")

    def as_left(kind):
        return lambda j: unit(kind, mine, j, F.lit(0))

    def as_right(kind):
        return lambda j: unit(kind, j, mine, F.lit(1))

    units_of = {r: [] for r in range(4)}
    for kind, (a, b) in _PAIRINGS.items():
        if kind == 0:
            units_of[a].append(
                partners(
                    f"n{a}",
                    lambda j: unit(0, F.least(mine, j), F.greatest(mine, j), (mine > j)),
                )
            )
            continue
        units_of[a].append(partners(f"n{b}", as_left(kind)))
        units_of[b].append(partners(f"n{a}", as_right(kind)))
    units = F.lit(None).cast("array<struct<kind:int,block_a:int,block_b:int,side:int>>")
    for role, lists in units_of.items():
        units = F.when(F.col("role") == role, F.flatten(F.array(*lists))).otherwise(units)
    return placed.withColumn("block", block).select(
        "id", "vec", "cell", F.inline(units)
    )


def _copies(vectors: DataFrame) -> DataFrame:
    """``(first id, id)`` of rows equal to an earlier row.

    Only fingerprints are grouped over all rows; vectors meet only where those agree.
    """
    marked = vectors.withColumn("mark", F.xxhash64("vec"))
    shared = marked.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    # an inner join, as Spark would move a semi-join before the filter
    suspects = maybe_in(marked, "mark", bloom_words(shared, "mark")).join(shared, "mark")
    firsts = suspects.groupBy("mark", "vec").agg(F.min("id").alias("src"))
    return (
        suspects.join(firsts, ["mark", "vec"])
        .filter("id <> src")
        .select("src", F.col("id").alias("dst"))
    )


def _similar(
    vectors: DataFrame,
    id_col: str,
    vec_col: str,
    threshold: float,
    links_only: bool,
    rows_per_cell: int,
    block_rows: int,
    max_pivots: int,
) -> DataFrame:
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must lie between 0 and 1")
    bounded_batches(vectors.sparkSession)
    vec = F.col(vec_col).cast("array<float>")
    # a zero vector is similar to nothing; stored, as making vectors is costly
    usable = materialise(
        vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
            F.exists("vec", lambda x: x != 0)
        ),
        "vectors",
    )
    copy_links = materialise(_copies(usable), "copies")
    firsts, total = materialise_counted(
        usable.join(copy_links.select(F.col("dst").alias("id")), "id", "left_anti"), "vectors"
    )
    wanted = min(max_pivots, math.ceil(total / rows_per_cell))
    # a bounded sample reaches the driver
    sample = firsts.orderBy(F.xxhash64("id"), "id").limit(_OVERSAMPLE * wanted).collect()
    if not sample:
        return copy_links
    chosen, pivots = _spread(sample, wanted, threshold)
    used = _useful(sample, pivots, threshold)
    chosen, pivots = chosen[:used], pivots[:used]
    full_rows = max(block_rows, _BLOCK_BYTES // (4 * pivots.shape[1]))

    placed = materialise(
        firsts.select("id", "vec").mapInArrow(
            _assigner(pivots, threshold, links_only),
            "id long, vec array<float>, cell int, role int",
        ),
        "cells",
    )
    pairs = (
        _blocked(placed, block_rows, full_rows)
        .groupBy("cell", "kind", "block_a", "block_b")
        .applyInArrow(_comparer(threshold, links_only, block_rows), "src long, dst long")
    )
    found = pairs.unionByName(copy_links)
    if links_only:
        pivot_ids = F.array(*[F.lit(row.id) for row in chosen])
        centre = F.element_at(pivot_ids, F.col("cell") + 1)
        stars = placed.filter(F.col("role").isin(_TIGHT, _NEAR)).select(
            centre.alias("src"), F.col("id").alias("dst")
        )
        found = found.unionByName(stars.filter("src <> dst"))
    return found


def cosine_pairs(
    vectors: DataFrame,
    id_col: str = "article_id",
    vec_col: str = "embedding",
    threshold: float = settings.SIMILARITY_THRESHOLD,
    rows_per_cell: int = 4000,
    block_rows: int = 2000,
    max_pivots: int = 1024,
) -> DataFrame:
    """``(src, dst)`` for all distinct vectors with cosine >= threshold; copies link to their first.

    The result itself grows with the square of a group of similar vectors: use
    ``similarity_links`` when only the groups are wanted.
    """
    return _similar(
        vectors, id_col, vec_col, threshold, False, rows_per_cell, block_rows, max_pivots
    )


def similarity_links(
    vectors: DataFrame,
    id_col: str = "article_id",
    vec_col: str = "embedding",
    threshold: float = settings.SIMILARITY_THRESHOLD,
    rows_per_cell: int = 4000,
    block_rows: int = 2000,
    max_pivots: int = 1024,
) -> DataFrame:
    """A linear-size subset of the similar pairs with the same connected components."""
    return _similar(
        vectors, id_col, vec_col, threshold, True, rows_per_cell, block_rows, max_pivots
    )


def first_similar(
    vectors: DataFrame,
    id_col: str = "article_id",
    vec_col: str = "embedding",
    threshold: float = settings.SIMILARITY_THRESHOLD,
    **layout,
) -> DataFrame:
    """``(id, first)``: the smallest earlier id with cosine >= threshold, where there is one.

    One row for each vector, however large its group, and exact with copies: a copy has its
    first, and whatever its first is similar to. Pairs are reduced to minima in the task
    that finds them (runs jobs, as ``cosine_pairs`` does).
    """
    pairs = cosine_pairs(vectors, id_col, vec_col, threshold, **layout)
    usable = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("vec")
    ).filter(F.exists("vec", lambda x: x != 0))
    copies = materialise(_copies(usable), "copies").select(F.col("dst").alias("id"), "src")
    # the least similar vector of each, in either direction; copies of it come later
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("other")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("other")),
    ))
    least = materialise(
        pairs.select(ends.alias("e")).groupBy("e.id").agg(F.min("e.other").alias("least")), "least"
    )
    of_firsts = least.join(copies, "id", "left_anti").filter("least < id")
    of_copies = copies.join(
        least.select(F.col("id").alias("src"), "least"), "src", "left"
    ).select("id", F.least("src", F.coalesce("least", "src")).alias("least"))
    return of_firsts.unionByName(of_copies).select("id", F.col("least").alias("first"))
