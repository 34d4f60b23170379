"""Cosine similarity self-join of sparse unit vectors: an inverted index with bounds. Exact.

Terms are ordered from rare to frequent. A vector posts itself under its first terms only, until
the norm of the rest is below the threshold: two vectors with no common posted term have a
smaller product (Bayardo, Ma, Srikant 2007; Chaudhuri, Ganti, Kaushik 2006). The products of posted
terms are summed for each pair that meets. Whatever else the two share lies behind the end of
the shorter posting, so the norm there (``tail``) times the norm that the other one has left
behind that term bounds the missing part. Pairs that cannot reach the threshold go before any
vector moves; the others are computed.

Rows are dealt to a few blocks, and a task compares two of them: it sums the products of their posted
terms row by row in a dense array of bounded size, so no pair that is not a candidate ever leaves a
task. A row meets every block, and blocks become more once they are full; all pairs of blocks are compared in
passes that move a row a few times only, and each pass frees its shuffle. Candidates are computed
in passes of bounded bytes as well, so the disk in use is linear in the input; the rows moved in all and
the sums inside the tasks are not. ``sparse_links`` is the form for clustering:
first every row is compared with one row of each of its lists only, which joins near copies into
groups; after that rows of one group are not paired, and its output is linear for groups of near copies.
Of many candidates one or two of each row are computed first, and those inside the groups that
they make are left out.

The vectors are read several times and are not stored here: weights are wide and do not compress, while
those of ``doc_vectors`` are made from stored counts at each reading.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.operators.bloom import bloom_words, maybe_in
from newsight.operators.components import connected_components
from newsight.session import bounded_batches, discard, free_shuffles, materialise, materialise_counted

_PREFIX = "id long, terms array<int>, weights array<float>, tail float"
_PAIRS = "src long, dst long, score double"
# least rows of a block, blocks that rows are dealt to, and rows and postings of a block from which on
# there are more
BLOCK_ROWS, BLOCKS, FULL_ROWS, FULL_POSTINGS = 1_000, 4, 96_000, 1_500_000
# copies of a row that are on disk at once while blocks are compared
COPIES = 4
# terms of the vectors that are moved for candidates at once, as a share of all vectors' terms, and a number
# that is always moved
MOVED_SHARE, MOVED_TERMS = 0.5, 2_000_000
# times that a few candidates of each row are computed before all that are left, and the
# candidates per row that are gathered at most before they are computed
_ROUNDS, _GATHERED = 3, 4
# products, and cells of the dense array, that are summed at once in a task
_PRODUCTS, _CELLS = 1 << 18, 1 << 19
_BOUNDED = 1 << 11  # pairs whose bound is computed at once
# the norm behind a posting's end, as a share of the threshold: the lower, the more terms are
# posted and the fewer pairs are left to compute
_POSTED = 0.94
_SLACK = 1e-9
# prefixes hold single precision; the candidates are computed in double
_ROUGH = 1e-5
# squares are summed as integers of this unit, rounded up, so a norm behind a term is never too small
_UNIT = float(1 << 40)


def _marked(vectors: DataFrame) -> DataFrame:
    """``(id, n, mark)``: the number of each vector's terms, and the SHA-256 of its terms and weights, so that
    wide rows need not move to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens = batch.column("terms").value_lengths().to_numpy()
            ends = np.concatenate([[0], np.cumsum(lens)]).tolist()
            terms, weights = (
                np.ascontiguousarray(batch.column(c).flatten().to_numpy(), kind).view(np.uint8)
                for c, kind in (("terms", np.int32), ("weights", np.float64))
            )
            marks = []
            for lo, hi in zip(ends[:-1], ends[1:]):
                mark = hashlib.sha256(terms[4 * lo : 4 * hi])
                mark.update(weights[8 * lo : 8 * hi])
                marks.append(mark.digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lens, pa.int32()), pa.array(marks, pa.binary())],
                names=["id", "n", "mark"],
            )

    return vectors.select("id", "terms", "weights").mapInArrow(run, "id long, n int, mark binary")


def _copies(marked: DataFrame) -> DataFrame:
    """``(src, dst)``: rows equal to an earlier row, linked to the first one; stored."""
    shared = marked.groupBy("mark").agg(F.min("id").alias("src"), F.count("*").alias("n")).filter("n > 1")
    firsts = materialise(shared.select("mark", "src"), "sparse-firsts")
    copies = marked.join(firsts, "mark").filter("id <> src").select("src", F.col("id").alias("dst"))
    copies = materialise(copies, "sparse-copies")
    discard(firsts)
    return copies


def _norms(owner: np.ndarray, w: np.ndarray, tail: np.ndarray | None = None) -> np.ndarray:
    """Norm of each entry and those behind it in its row, ``tail`` behind the last one."""
    sums = np.concatenate([[0.0], np.cumsum(w.astype(np.float64) ** 2)])
    end = np.searchsorted(owner, owner, "right")
    behind = sums[end] - sums[:-1] + (0.0 if tail is None else tail.astype(np.float64)[owner] ** 2)
    return np.sqrt(np.maximum(behind, 0.0))


def prefixes(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(id, terms, weights, tail)`` of each vector's rare terms, as far as the threshold asks.

    Terms are numbered anew from rare to frequent and ascend. ``tail`` is the norm behind the last.
    """
    entries = vectors.select(F.explode("terms").alias("term"))
    frequency = materialise(entries.groupBy("term").agg(F.count("*").alias("df")), "term-frequency")
    dims = frequency.agg(F.max("term")).first()[0]
    if dims is None:
        return entries.sparkSession.createDataFrame([], _PREFIX)
    # one counter per term; the number of hashed terms is fixed by the vectors' maker
    df, seen = np.zeros(dims + 1, np.int64), frequency.toArrow()
    df[seen["term"].to_numpy()] = seen["df"].to_numpy()
    rank = np.empty(dims + 1, np.int64)
    rank[np.lexsort((np.arange(dims + 1), df))] = np.arange(dims + 1)
    shared = vectors.sparkSession.sparkContext.broadcast(rank.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens = batch.column("terms").value_lengths().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), lens)
            term = shared.value[batch.column("terms").flatten().to_numpy()]
            w = batch.column("weights").flatten().to_numpy()
            order = np.lexsort((term, owner))
            term, w = term[order], w[order]
            posted = np.flatnonzero(_norms(owner, w) >= _POSTED * threshold - _SLACK)
            left = np.bincount(owner, w * w, batch.num_rows) - np.bincount(owner[posted], w[posted] ** 2, batch.num_rows)
            offsets = pa.array(np.searchsorted(owner[posted], np.arange(batch.num_rows + 1)), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(x[posted].astype(kind)))
                for x, kind in ((term, np.int32), (w, np.float32))
            ]
            tail = np.sqrt(np.maximum(left, 0.0)).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *lists, pa.array(tail)], names=["id", "terms", "weights", "tail"]
            )

    return vectors.select("id", "terms", "weights").mapInArrow(run, _PREFIX)


def postings(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(term, id, w)``: the prefixes, one row per term."""
    entries = prefixes(vectors, threshold).select("id", F.explode(F.arrays_zip("terms", "weights")).alias("e"))
    return entries.select(F.col("e.terms").alias("term"), "id", F.col("e.weights").alias("w"))


def _rests(prefix: DataFrame) -> DataFrame:
    """``(term, id, w, rest, last, tail)`` of each posting: ``rest`` is the norm behind it, ``last``
    the row's last term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens = batch.column("terms").value_lengths().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), lens)
            term, w = (batch.column(c).flatten().to_numpy() for c in ("terms", "weights"))
            tail = batch.column("tail").to_numpy()
            rest = np.sqrt(np.maximum(_norms(owner, w, tail) ** 2 - w.astype(np.float64) ** 2, 0.0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(term), batch.column("id").take(pa.array(owner)), pa.array(w),
                    pa.array(rest.astype(np.float32)), pa.array(term[np.cumsum(lens) - 1][owner]),
                    pa.array(tail[owner]),
                ],
                names=["term", "id", "w", "rest", "last", "tail"],
            )

    return prefix.mapInArrow(run, "term int, id long, w float, rest float, last int, tail float")


def _with_leaders(prefix: DataFrame, threshold: float) -> DataFrame:
    """Candidates of each row with the smallest row of each of its lists; nothing is shuffled for them.

    Only the lists that this row leads are summed, so a similar pair may be passed over here; the
    comparison of groups, which sums all lists, finds it.
    """
    fields = ("id", "w", "rest", "last", "tail")
    # one row per term, whose number is fixed
    lead = _rests(prefix).groupBy("term").agg(F.min(F.struct(*fields)).alias("m")).select("term", "m.*").toArrow()
    at, table = lead["term"].to_numpy(), {}
    size = int(at.max(initial=-1)) + 1
    for name in fields:
        values = lead[name].to_numpy()
        table[name] = np.zeros(size, values.dtype)
        table[name][at] = values
    shared = prefix.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        led = shared.value
        for batch in batches:
            lens = batch.column("terms").value_lengths().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), lens)
            term, w = (batch.column(c).flatten().to_numpy() for c in ("terms", "weights"))
            tail = batch.column("tail").to_numpy()
            rest = np.sqrt(np.maximum(_norms(owner, w, tail) ** 2 - w.astype(np.float64) ** 2, 0.0))
            end = np.cumsum(lens) - 1
            ids, src = batch.column("id").to_numpy(), led["id"][term]
            met = np.flatnonzero(src < ids[owner])
            own, t, src = owner[met], term[met], src[met]
            behind = np.where(
                led["last"][t] <= term[end[own]], led["tail"][t] * rest[met], tail[own] * led["rest"][t]
            )
            missing = np.minimum(behind, led["rest"][t] * rest[met])
            order = np.lexsort((src, own))
            own, src = own[order], src[order]
            new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (src[1:] != src[:-1])])[: len(own)])
            if not len(new):
                continue
            # the bound is smallest at the last term that both have posted
            product = np.add.reduceat((led["w"][t] * w[met])[order].astype(np.float64), new)
            reach = product + np.minimum.reduceat(missing[order], new) >= threshold - _ROUGH
            kept = new[reach]
            yield pa.RecordBatch.from_arrays(
                [pa.array(src[kept]), pa.array(ids[own[kept]]), pa.array(product[reach])],
                names=["src", "dst", "score"],
            )

    return prefix.mapInArrow(run, _PAIRS)


def _sides(placed: DataFrame, diagonals: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Left and right sides of block pairs x <= y of rows with ``own`` of ``blocks``; of those with y - x in
    ``diagonals``, or all."""
    if diagonals is None:
        y, x = F.sequence("own", F.col("blocks") - 1), F.sequence(F.lit(0), "own")
    else:
        y = F.filter(F.array(*[F.col("own") + d for d in diagonals]), lambda k: k < F.col("blocks"))
        x = F.filter(F.array(*[F.col("own") - d for d in diagonals]), lambda k: k >= 0)
    left, right = placed.withColumn("y", F.explode(y)), placed.withColumn("x", F.explode(x))
    return left.withColumn("x", F.col("own")), right.withColumn("y", F.col("own"))


def units(posted: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Left and right sides of all block pairs ``(term, x, y)`` with x <= y.

    A list of up to ``block_rows`` postings is one unit; each posting of a longer one stands once
    per block of its list.
    """
    sizes = posted.groupBy("term").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    sizes = sizes.filter("blocks > 1")
    placed = posted.join(sizes, "term", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return _sides(placed.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int")))


def passes(blocks: int) -> list[list[int]]:
    """All diagonals y - x of the block pairs, in parts of which each moves a row up to ``COPIES`` times.

    Diagonals d and ``blocks`` - d hold every block twice together, as 0 and the middle one do once.
    """
    parts, moved = [[]], 0
    for d in range(blocks // 2 + 1):
        both = sorted({d, (blocks - d) % blocks})
        copies = len(both)
        if moved and moved + copies > COPIES:
            parts, moved = [*parts, []], 0
        parts[-1] += both
        moved += copies
    return parts


class _Side:
    """One block's prefixes as flat arrays."""

    def __init__(self, rows: pa.Table):
        self.id, self.group = rows.column("id").to_numpy(), rows.column("group").to_numpy()
        terms, weights = (rows.column(c).combine_chunks() for c in ("terms", "weights"))
        self.lens = terms.value_lengths().to_numpy().astype(np.int64)
        self.term, self.w = terms.flatten().to_numpy(), weights.flatten().to_numpy()
        self.start = np.concatenate([[0], np.cumsum(self.lens)])
        self.last, self.tail = self.term[self.start[1:] - 1], rows.column("tail").to_numpy()
        squares = self.w.astype(np.float64)
        squares *= squares
        squares *= _UNIT
        self.sums = np.zeros(len(squares) + 1, np.int64)
        np.cumsum(np.ceil(squares, out=squares).astype(np.int64), out=self.sums[1:])

    def behind(self, rows: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Norm of some rows behind one term each."""
        lo, end = self.start[rows], self.start[rows + 1]
        hi = end
        while (lo < hi).any():
            # an end that is reached points behind the last entry at most, and is not moved
            middle = (lo + hi) // 2
            before = (lo < hi) & (self.term[np.minimum(middle, len(self.term) - 1)] <= term)
            lo, hi = np.where(before, middle + 1, lo), np.where(before, hi, middle)
        return np.sqrt((self.sums[end] - self.sums[lo]) / _UNIT + self.tail[rows].astype(np.float64) ** 2)


def _missing(a: _Side, b: _Side, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Most that terms which are not posted in both may add: all others end with the shorter posting."""
    out = np.zeros(len(u))
    for lo in range(0, len(u), _BOUNDED):
        i, j = u[lo : lo + _BOUNDED], v[lo : lo + _BOUNDED]
        out[lo : lo + _BOUNDED] = np.where(
            a.last[i] <= b.last[j], a.tail[i] * b.behind(j, a.last[i]), b.tail[j] * a.behind(i, b.last[j])
        )
    return out


def _candidates(a: _Side, b: _Side, same: bool, threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of different groups, one of each side, that may reach the threshold, and their products so far."""
    dims = int(max(a.term.max(), b.term.max())) + 1
    by_term = np.argsort(b.term, kind="stable")
    row_of = np.repeat(np.arange(len(b.id), dtype=np.int32), b.lens)[by_term]
    w_of = b.w[by_term]
    del by_term
    held = np.bincount(b.term, minlength=dims)
    first = np.concatenate([[0], np.cumsum(held)])
    width = len(b.id)
    # products of all rows before each row; no row is without terms
    made = np.concatenate([[0], np.cumsum(np.add.reduceat(held.astype(np.int32)[a.term], a.start[:-1], dtype=np.int64))])
    least = threshold - _ROUGH - float(max(a.tail.max(), b.tail.max()))
    lo = 0
    while lo < len(a.id):
        most = np.searchsorted(made, made[lo] + _PRODUCTS, "right") - 1
        hi = max(lo + 1, min(len(a.id), int(most), lo + _CELLS // width))
        part = slice(a.start[lo], a.start[hi])
        own, term = np.repeat(np.arange(hi - lo) * width, a.lens[lo:hi]), a.term[part]
        n = held[term]
        ends = np.cumsum(n)
        place = np.arange(ends[-1]) + np.repeat(first[term] - ends + n, n)
        cell = row_of[place] + np.repeat(own, n)
        sums = np.bincount(cell, np.repeat(a.w[part], n) * w_of[place], minlength=(hi - lo) * width)
        found = np.flatnonzero(sums >= least) if least > 0 else np.unique(cell)
        u, v = found // width + lo, found % width
        kept = a.group[u] != b.group[v]
        kept &= (a.id[u] < b.id[v]) if same else (a.id[u] != b.id[v])
        u, v, product = u[kept], v[kept], sums[found[kept]]
        kept = product + _missing(a, b, u, v) >= threshold - _ROUGH
        src, dst = a.id[u[kept]], b.id[v[kept]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(src, dst)), pa.array(np.maximum(src, dst)), pa.array(product[kept].astype(np.float64))],
            names=["src", "dst", "score"],
        )
        lo = hi


def _compared(
    grouped: DataFrame, threshold: float, block_rows: int
) -> tuple[int, list[Callable[[], DataFrame]]]:
    """Rows of ``grouped``, which is stored, and the passes that give its candidate pairs of different groups."""
    total, posted = grouped.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    rows = min(FULL_ROWS, max(block_rows, -(-total // BLOCKS)))
    blocks = max(1, -(-total // rows), -(-posted // FULL_POSTINGS))
    placed = grouped.select(
        "id", "group", "terms", "weights", "tail",
        F.lit(blocks).alias("blocks"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("own"),
    )

    def run(unit: pa.Table) -> pa.Table:
        none = pa.table({"src": pa.array([], pa.int64()), "dst": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        side = unit.column("side").to_numpy()
        same = unit.column("x")[0].as_py() == unit.column("y")[0].as_py()
        parts = [unit.filter(pa.array(side == k)) for k in (0, 1)]
        del unit
        if not parts[0].num_rows or not (same or parts[1].num_rows):
            return none
        a = _Side(parts[0])
        b = a if same else _Side(parts[1])
        del parts
        found = [none, *map(lambda x: pa.Table.from_batches([x]), _candidates(a, b, same, threshold))]
        # rows with equal ids name a pair more than once
        pairs = pa.concat_tables(found).group_by(["src", "dst"]).aggregate([("score", "max")])
        del a, b, found
        pa.default_memory_pool().release_unused()  # an idle worker would keep it
        return pairs.select(["src", "dst", "score_max"]).rename_columns(["src", "dst", "score"])

    def part(diagonals: list[int]) -> DataFrame:
        left, right = _sides(placed, diagonals)
        # a block that meets itself moves once
        sides = left.withColumn("side", F.lit(0)).unionByName(right.filter("x < y").withColumn("side", F.lit(1)))
        return sides.select("x", "y", "side", "id", "group", "terms", "weights", "tail").groupBy("x", "y").applyInArrow(
            run, _PAIRS
        )

    return total, [lambda d=d: part(d) for d in passes(blocks)]


def _met(grouped: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """Candidate pairs of different groups; ``grouped`` is stored. All passes but the last are done here."""
    return _in_passes(_compared(grouped, threshold, block_rows)[1], "sparse-met")


def _in_passes(parts: list[Callable[[], DataFrame]], name: str) -> DataFrame:
    """The rows of all parts; all but the last one are stored, and their shuffles freed."""
    stored = []
    for part in parts[:-1]:
        stored.append(materialise(part(), name))
        free_shuffles(stored[-1].sparkSession)
    return reduce(DataFrame.unionByName, stored, parts[-1]())


def _parts(pairs: DataFrame, lens: DataFrame) -> int:
    """Passes that the pairs' vectors ask for: each moves one vector of a pair twice, the other one once."""
    size = lambda k: lens.select(F.col("id").alias(k), F.col("n").cast("long").alias(f"n_{k}"))
    moved = pairs.join(size("src"), "src").join(size("dst"), "dst").agg(F.sum(F.expr("2 * n_src + n_dst"))).first()[0]
    every = lens.agg(F.sum("n")).first()[0]
    return max(1, math.ceil((moved or 0) / max(MOVED_TERMS, MOVED_SHARE * (every or 0))))


def _reaching(pairs: DataFrame, vectors: DataFrame, threshold: float, parts: int) -> DataFrame:
    """The pairs whose product reaches the threshold; ``pairs`` are stored.

    Bloom filters thin the vectors out before they move; the joins decide. All passes but the last are done here.
    """

    def side(k: str, n: int, some: DataFrame) -> DataFrame:
        wanted = maybe_in(vectors, "id", bloom_words(some, k))
        return wanted.select(F.col("id").alias(k), F.col("terms").alias(f"terms{n}"), F.col("weights").alias(f"weights{n}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, weights = [], []
            for n in (0, 1):
                terms = batch.column(f"terms{n}")
                pair = np.repeat(np.arange(batch.num_rows, dtype=np.int64), terms.value_lengths().to_numpy())
                keys.append(pair << 32 | terms.flatten().to_numpy().astype(np.int64))
                weights.append(batch.column(f"weights{n}").flatten().to_numpy())
            # terms ascend in a vector, so the keys of a side ascend and never repeat
            _, here, there = np.intersect1d(*keys, assume_unique=True, return_indices=True)
            dots = np.bincount(keys[0][here] >> 32, weights[0][here] * weights[1][there], minlength=batch.num_rows)
            kept = pa.array(np.flatnonzero(dots >= threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column("src").take(kept), batch.column("dst").take(kept)], names=["src", "dst"]
            )

    def computed(k: int) -> DataFrame:
        some = pairs.select("src", "dst").filter(F.pmod(F.xxhash64("src", "dst"), F.lit(parts)) == k)
        both = some.join(side("src", 0, some), "src").join(side("dst", 1, some), "dst")
        return both.mapInArrow(run, "src long, dst long")

    return _in_passes([lambda k=k: computed(k) for k in range(parts)], "sparse-reached")


def _some_of_each(pairs: DataFrame) -> DataFrame:
    """Of each row's pairs with earlier rows, that with the first of them and that with the largest product so far."""
    chosen = pairs.groupBy("dst").agg(F.min("src").alias("low"), F.max_by("src", "score").alias("best"))
    return chosen.select(F.explode(F.array_distinct(F.array("low", "best"))).alias("src"), "dst")


def _apart(pairs: DataFrame, links: list[DataFrame]) -> DataFrame:
    """The pairs of rows that no links join yet."""
    groups = materialise(connected_components(reduce(DataFrame.unionByName, links)), "sparse-groups")
    of = lambda k: groups.select(F.col("node").alias(k), F.col("component").alias(f"{k}_group"))
    both = pairs.join(of("src"), "src", "left").join(of("dst"), "dst", "left")
    return both.filter(F.coalesce("src_group", "src") != F.coalesce("dst_group", "dst")).select("src", "dst", "score")


def _joined(
    pairs: DataFrame, links: list[DataFrame], vectors: DataFrame, lens: DataFrame, threshold: float
) -> list[DataFrame]:
    """``links`` and those of the candidates that reach the threshold and join more groups; all stored.

    Candidates inside a group, which grow with its square, are left out, as its links are there.
    """
    spark, links = vectors.sparkSession, list(links)
    ids = pairs.select(F.explode(F.array("src", "dst")).alias("id"))
    wanted = materialise(maybe_in(vectors, "id", bloom_words(ids, "id")), "sparse-wanted")
    free_shuffles(spark)
    parts = _parts(pairs, lens)
    for _ in range(_ROUNDS):
        if parts == 1:
            break
        first = materialise(_some_of_each(pairs), "sparse-first")
        links.append(materialise(_reaching(first, wanted, threshold, _parts(first, lens)), "sparse-links"))
        free_shuffles(spark)
        rest = pairs.join(first, ["src", "dst"], "left_anti")
        pairs = materialise(_apart(rest, links), "sparse-rest")
        free_shuffles(spark)
        parts = _parts(pairs, lens)
    links.append(materialise(_reaching(pairs, wanted, threshold, parts), "sparse-links"))
    discard(wanted)
    free_shuffles(spark)
    return links


def _prepared(
    vectors: DataFrame, id_col: str, threshold: float
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Vectors, and stored lengths, copies, and prefixes of the rows that are no copies."""
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must lie between 0 and 1")
    bounded_batches(vectors.sparkSession)
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), "terms", "weights").filter(F.size("terms") > 0)
    marked = materialise(_marked(usable), "sparse-marks")
    copies = _copies(marked)
    every = prefixes(usable, threshold).filter("id IS NOT NULL AND size(terms) > 0")
    prefix = materialise(every.join(copies.select(F.col("dst").alias("id")), "id", "left_anti"), "prefixes")
    free_shuffles(vectors.sparkSession)
    return usable, marked.select("id", "n"), copies, prefix


def sparse_pairs(
    vectors: DataFrame, id_col: str = "article_id",
    threshold: float = settings.SIMILARITY_THRESHOLD, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(src, dst)`` of all distinct vectors with cosine >= threshold; copies link to their first.

    ``vectors`` holds unit vectors as ``terms`` (ascending) and ``weights`` (positive). The result itself
    grows with the square of a group of similar vectors: use ``sparse_links`` for groups.
    """
    usable, lens, copies, prefix = _prepared(vectors, id_col, threshold)
    found = materialise(_met(prefix.withColumn("group", F.col("id")), threshold, block_rows), "sparse-candidates")
    return _reaching(found, usable, threshold, _parts(found, lens)).unionByName(copies)


def sparse_links(
    vectors: DataFrame, id_col: str = "article_id",
    threshold: float = settings.SIMILARITY_THRESHOLD, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A subset of the similar pairs with the same connected components; stored."""
    spark = vectors.sparkSession
    usable, lens, copies, prefix = _prepared(vectors, id_col, threshold)
    near = materialise(_with_leaders(prefix, threshold), "sparse-candidates")
    free_shuffles(spark)
    links = _joined(near, [], usable, lens, threshold)
    groups = connected_components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "id")
    grouped = prefix.join(groups, "id", "left").withColumn("group", F.coalesce("component", "id"))
    grouped = materialise(grouped.drop("component"), "sparse-grouped")
    discard(prefix, near)
    free_shuffles(spark)
    rows, compared = _compared(grouped, threshold, block_rows)
    met, gathered, behind = [], 0, False
    for k, part in enumerate(compared, start=1):
        pairs, n = materialise_counted(part(), "sparse-candidates")
        free_shuffles(spark)
        if k == len(compared):
            discard(grouped)
        met, gathered = [*met, pairs], gathered + n
        if k == len(compared) or gathered > _GATHERED * rows:
            found = reduce(DataFrame.unionByName, met)
            # those of links that were made after ``grouped``
            found = materialise(_apart(found, links), "sparse-rest") if behind else found
            links = _joined(found, links, usable, lens, threshold)
            discard(*met)
            met, gathered, behind = [], 0, True
    return reduce(DataFrame.unionByName, links).unionByName(copies)
