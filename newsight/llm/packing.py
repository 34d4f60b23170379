"""Best-fit packing with bound-certified repacking.

Documents are tokenised once; only those longer than a sequence are cut. Pieces are dealt
evenly over partitions and packed best-fit decreasing. Dual-feasible functions (Lueker
1983; Fekete, Schepers 2001) give a lower bound for each partition and for the whole input.
Partitions release bins with gaps: a certified partition its emptiest ones, any other all it
could not fill. The released documents are dealt to new, fewer partitions and packed again,
until the total meets the global bound, or a round saves nothing. A round holds a small
part of the round before, and no task more than the pieces of one partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import keyed_text, release, stored

# pieces packed by one task: more of them leave fewer gaps (0.6 % at 5,000 and 0.1 % at 60,000
# over the bound for evenly spread lengths)
PARTITION_PIECES = 50_000
# a certified partition releases one in so many of its bins, and so many at least
OPEN_SHARE, LEAST_OPEN = 20, 4
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", part long, bin long, offset long, free long, is_open boolean"
# letters and signs on which both tokenizer libraries are known to split alike
_PLAIN_TEXT = r"[\t\n\r\x20-\x7e¡-ɏ‐-…€]*"


class Encoder:
    """Token ids by the vocabulary file of the tokenizers library.

    With ``ranks_path``, the same vocabulary as ranks, texts of common Latin characters are
    encoded by tiktoken, which gives the same ids several times faster; all others go
    through the tokenizers library. Strings of special tokens are ordinary text.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None):
        import re

        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(tokenizer_path)
        self.exact.encode_special_tokens = True
        self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )
        self.plain = re.compile(_PLAIN_TEXT).fullmatch

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and self.plain(text):
            return np.asarray(self.fast.encode_to_numpy(text), np.uint32)
        ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32)


def pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
    capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Token ids of each document and ``end_id``, cut so that only the first piece is short."""
    own = keyed_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path, ranks_path, pattern)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids_of, out = batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids_of, batch.column("text").to_pylist(), strict=True):
                ids = np.concatenate([encode(text), end]).astype("<u4")
                at, k = 0, 0
                while at < len(ids):
                    upto = at + ((len(ids) - at) % capacity or capacity)
                    out.append((doc_id, k, at, upto - at, zlib.crc32(ids[at:upto].tobytes())))
                    at, k = upto, k + 1
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return own.mapInArrow(run, _PIECES)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; ``counts[s]`` pieces have size s.

    The largest of the bounds of U(a) (sizes above C - a count whole, below a nothing)
    and of u(k) (sizes rounded down to multiples of 1/k, exact multiples of 1/(k+1) kept).
    """
    c = capacity
    size = np.arange(c + 1, dtype=np.int64)
    counts = counts[: c + 1].astype(np.int64)
    weight = size * counts
    many, heavy = np.cumsum(counts), np.cumsum(weight)
    a = np.arange(c // 2 + 1)
    below = np.where(a > 0, heavy[np.maximum(a - 1, 0)], 0)
    whole = many[c] - many[c - a]
    best = int((whole - (-(heavy[c - a] - below) // c)).max())
    for k in range(1, 21):
        m, rest = np.divmod((k + 1) * size, c)
        value = np.where(rest == 0, m * k, m * (k + 1))
        best = max(best, -(-int((value * counts).sum()) // (k * (k + 1))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each piece, its offset there, free space of each bin).

    Bins wait under their free space; the lowest set bit of one long integer finds the
    tightest space that still holds a piece.
    """
    order = np.argsort(-lengths, kind="stable")
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    for i in order:
        size = int(lengths[i])
        fit = spaces >> size
        if fit:
            space = size + (fit & -fit).bit_length() - 1
            b = waiting[space].pop()
            if not waiting[space]:
                spaces ^= 1 << space
        else:
            b, space = len(free), capacity
            free.append(capacity)
        where[i], offset[i] = b, capacity - space
        free[b] = left = space - size
        if left:
            waiting[left].append(b)
            spaces |= 1 << left
    return where, offset, np.array(free, np.int64)


def _pack_partition(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable")
        lengths = rows["length"].to_numpy()
        where, offset, free = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        is_open = free > 0
        if len(free) == bound:  # certified: what it lacks, only other partitions can give
            few = max(LEAST_OPEN, len(free) // OPEN_SHARE)
            is_open[np.argsort(-free, kind="stable")[few:]] = False
        return rows.assign(bin=where, offset=offset, free=free[where], is_open=is_open[where])

    return pack


def pack_pieces(cut: DataFrame, capacity: int = 2048, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces (runs jobs)."""
    sizes = cut.groupBy("length").count().collect()  # a row for each size up to capacity
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    bound, total, n = lower_bound(counts, capacity), None, int(counts.sum())
    closed: list[DataFrame] = []
    live, lanes = cut, None
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    turn = 0
    while n:
        before = lanes
        lanes = -(-n // partition_pieces)
        key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(lanes))
        packed = stored(
            live.select(*names, key.alias("part")).groupBy("part")
            .applyInPandas(_pack_partition(capacity), _PACKED),
            "packed",
        ).withColumn("turn", F.lit(turn))
        used = packed.groupBy("part", "bin").agg(
            F.first("is_open").alias("is_open"), F.count("*").alias("n")
        ).agg(
            F.count("*").alias("bins"), F.sum(F.col("is_open").cast("long")).alias("open_bins"),
            F.sum(F.when(F.col("is_open"), F.col("n"))).alias("open_pieces"),
        ).first()
        if total is None:
            total = used["bins"]
        else:
            saved = open_bins - used["bins"]
            if saved <= 0:  # the packing before stays
                closed.append(open_rows)
                break
            total -= saved
        closed.append(packed.filter("NOT is_open"))
        open_rows, open_bins, n = packed.filter("is_open"), used["open_bins"] or 0, used["open_pieces"] or 0
        if total == bound or before == 1:
            closed.append(open_rows)
            break
        live, turn = open_rows, turn + 1
    if not closed:
        closed = [cut.sparkSession.createDataFrame([], _PACKED + ", turn int")]
    out = None
    for part in closed:
        rows = part.select(
            *names,
            (F.shiftleft(F.col("turn").cast("long"), 57) + F.shiftleft("part", 24) + F.col("bin"))
            .alias("sequence_id"),
            "offset",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def pack_documents(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
    capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece (runs jobs).

    Null and empty texts are the end token alone. Repeated rows and rows without doc_id are
    packed like any other. An empty table gives no sequence. Other columns are not read.
    """
    cut = stored(
        pieces(docs, tokenizer_path, ranks_path, pattern, capacity, end_id, id_col, text_col),
        "pieces",
    )
    out = pack_pieces(cut, capacity)
    release(cut)
    return out
