"""Prefix trie of conversations from sorted sequences, without building a trie.

Turns become 16-byte keys, a conversation their concatenation, and equal conversations one
row with its members. All distinct sequences are range-sorted into blocks. In a block the
common prefix lengths (LCPs) of neighbours get a sparse table for range minima; every
candidate prefix then binary-searches its left and its right extent on its own, and the
interval of its members gives all its figures by prefix sums and range minima. A prefix
that reaches over a block's end adds up over blocks: all figures are sums, minima, or stand in
one block only. A block sees the nearest sequence of each neighbour, so that what is new
in a block is new in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsight.llm.common import bounded_batches, stored

KEY = 16
# members of a sequence are first joined over ranges of so many ids
ID_RANGE_BITS = 9
WORD = r"[^\x20\x09-\x0D]+"
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, node binary, parent binary"
)
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``keys`` (hex, in order of turns, null turn first) and ``words`` per turn.

    Equal turn numbers are ordered by their key. A null role or text is empty. Rows without
    ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * KEY).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"),
        ).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def share_openings(own: DataFrame, every: int = 20, shared: int = 4) -> DataFrame:
    """The first h turns come from conversation ``conv_id - conv_id % every``, the rest is its own.

    h is crc32 of the decimal id modulo ``shared``. An absent conversation gives no turns.
    """
    heads = own.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("keys", 1, shared).alias("head_keys"), F.slice("words", 1, shared).alias("head_words"),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")

    def rebuilt(head: str, mine: str) -> Column:
        first = F.when(F.col("base").isNotNull(), F.slice(head, F.lit(1), F.col("h")))
        rest = F.slice(mine, F.col("h") + 1, F.size(mine))
        return F.concat(F.coalesce(first, F.slice(mine, 1, 0)), rest)

    joined = own.withColumn("h", h).join(
        heads, own["conv_id"] - own["conv_id"] % every == heads["base"], "left"
    )
    return joined.select(
        "conv_id", rebuilt("head_keys", "keys").alias("keys"), rebuilt("head_words", "words").alias("words")
    )


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """``seq``, ``words``, ``n``, ``first`` member and ``ends`` (SHA-256 of its members' ids).

    Members are joined for each range of ids before a sequence's ranges meet, and those are
    hashed as a stream, so a sequence of a third of all conversations fills no task.
    """
    keyed = convs.select(
        "conv_id", "words", F.unhex(F.array_join("keys", "")).alias("seq"),
        F.shiftright("conv_id", ID_RANGE_BITS).alias("id_range"),
    ).withColumn("seq_key", F.unhex(F.sha2("seq", 256)))
    ranges = keyed.groupBy("seq_key", "id_range").agg(
        F.first("seq").alias("seq"), F.first("words").alias("words"),
        F.count("*").alias("n"), F.min("conv_id").alias("first"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha = None, None
        schema = pa.schema([
            ("seq", pa.binary()), ("words", pa.list_(pa.int32())), ("n", pa.int64()),
            ("first", pa.int64()), ("ends", pa.string()),
        ])
        for batch in batches:
            done = []
            keys, ids = batch.column("seq_key").to_pylist(), batch.column("ids").to_pylist()
            n, first = batch.column("n").to_pylist(), batch.column("first").to_pylist()
            for i, key in enumerate(keys):
                if held is not None and held["seq_key"] == key:
                    held["n"] += n[i]
                    held["first"] = min(held["first"], first[i])
                    sha.update(b"," + ids[i].encode())
                    continue
                if held is not None:
                    done.append(held | {"ends": sha.hexdigest()})
                held = {
                    "seq_key": key, "seq": batch.column("seq")[i].as_py(),
                    "words": batch.column("words")[i].as_py(), "n": n[i], "first": first[i],
                }
                sha = hashlib.sha256(ids[i].encode())
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held | {"ends": sha.hexdigest()}], schema=schema)

    dealt = ranges.repartition("seq_key").sortWithinPartitions("seq_key", "id_range")
    return dealt.mapInArrow(digest, "seq binary, words array<int>, n long, first long, ends string")


def sorted_blocks(seqs: DataFrame) -> DataFrame:
    """Sequences in blocks of a global order, each with the nearest one of either neighbour.

    A neighbour's sequence has ``side`` -1 or 1 and no members; own rows have 0.
    """
    own = stored(
        seqs.repartitionByRange("seq").sortWithinPartitions("seq")
        .withColumn("block", F.spark_partition_id()), "trie-blocks",
    )
    ends = own.groupBy("block").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    order = Window.orderBy("block")  # one row per block
    near = ends.select(
        "block", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after")
    )
    ghosts = near.select(
        "block", F.explode(F.array(
            F.struct(F.lit(-1).alias("side"), F.col("before").alias("seq")),
            F.struct(F.lit(1).alias("side"), F.col("after").alias("seq")),
        )).alias("g"),
    ).filter("g.seq IS NOT NULL").select("block", "g.side", "g.seq")
    return own.withColumn("side", F.lit(0)).unionByName(ghosts, allowMissingColumns=True)


class SparseTable:
    """Range minima of an array by powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def minimum(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of each range ``[low, high]``, both ends included."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            out[at] = np.minimum(table[low[at]], table[high[at] + 1 - (1 << int(k))])
        return out

    def right_extent(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Largest r with all values in ``(start, r]`` at least ``least``, for each query."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            can = np.flatnonzero(at + 1 < len(table))
            can = can[table[at[can] + 1] >= least[can]]
            at[can] += 1 << k
        return at

    def left_extent(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest l with all values in ``(l, start]`` at least ``least``, for each query."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, width = self.levels[k], 1 << k
            can = np.flatnonzero(at - width >= 0)
            can = can[table[at[can] - width + 1] >= least[can]]
            at[can] -= width
        return at


def common_prefixes(seqs: list[bytes]) -> np.ndarray:
    """Keys that each sequence shares with the one before it; -1 for the first."""
    lens = np.array([len(s) // KEY for s in seqs], np.int64)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    keys = np.frombuffer(b"".join(seqs), np.dtype("V16"))
    halves = keys.view(np.uint64).reshape(-1, 2)
    lcp = np.zeros(len(seqs), np.int64)
    active, depth = np.arange(1, len(seqs)), 0
    while len(active):
        active = active[(lens[active] > depth) & (lens[active - 1] > depth)]
        a, b = halves[starts[active] + depth], halves[starts[active - 1] + depth]
        active = active[(a == b).all(axis=1)]
        depth += 1
        lcp[active] = depth
    lcp[0] = -1
    return lcp


def path_hashes(seq: bytes) -> list[bytes]:
    """Hash of each prefix of a sequence, the empty one first."""
    h = hashlib.sha256()
    out = [h.digest()]
    for at in range(0, len(seq), KEY):
        h.update(seq[at : at + KEY])
        out.append(h.copy().digest())
    return out


def block_nodes(rows: pa.Table) -> pa.Table:
    """All prefixes of one block's sequences with their figures inside the block."""
    order = sorted(
        zip(rows["side"].to_pylist(), rows["seq"].to_pylist(), range(rows.num_rows), strict=True)
    )
    take = [i for _, _, i in order]
    seqs = [s for _, s, _ in order]
    side = np.array([s for s, _, _ in order])
    lcp = common_prefixes(seqs)
    own = np.flatnonzero(side == 0)
    lead, last = int(own[0]), int(own[-1])
    follow = int(lcp[last + 1]) if last + 1 < len(seqs) else -1  # shared with the next block
    # from here on rows of this block only; lcp[0] is what it shares with the block before
    lcp = lcp[own]
    seqs = [seqs[i] for i in own]
    picked = rows.take(pa.array([take[i] for i in own]))
    m = len(seqs)
    lens = np.array([len(s) // KEY for s in seqs], np.int64)
    n = picked["n"].to_numpy().astype(np.int64)
    first = picked["first"].to_numpy().astype(np.int64)
    ends = picked["ends"].to_pylist()
    words = picked["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    run = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)

    def words_upto(i: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return run[base[i] + np.maximum(depth, 0)] - run[base[i]]

    every = np.arange(m)
    beyond = np.append(lcp[1:], follow)  # shared with the next sequence
    total = words_upto(every, lens)
    sums = lambda values: np.concatenate([[0], np.cumsum(values)]).astype(np.int64)
    members, weighted = sums(n), sums(n * total)
    fresh, leaves = sums(total - words_upto(every, lcp)), sums(beyond < lens)
    by_lcp = np.lexsort((every, lcp))
    ranked = lcp[by_lcp] * (m + 1) + by_lcp

    # candidates: prefixes that no earlier sequence of this block has
    seen = lcp.copy()
    seen[0] = -1
    counts = lens - seen
    row = np.repeat(every, counts)
    depth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + seen[row] + 1
    inner = lcp.copy()
    inner[0] = -1
    extents = SparseTable(inner)
    low, high = extents.left_extent(row, depth), extents.right_extent(row, depth)
    smallest = SparseTable(first)
    conv = smallest.minimum(low, high)

    n_convs = members[high + 1] - members[low]
    continued = lcp[low] >= depth  # the block before has it too
    elsewhere = np.where(continued, 0, words_upto(low, depth - 1) - words_upto(low, lcp[low]))
    saved = (
        weighted[high + 1] - weighted[low] - n_convs * words_upto(low, depth - 1)
        - (fresh[high + 1] - fresh[low] - elsewhere)
    )
    # a child starts at a row that shares just this prefix with the row before it, or at the top
    n_children = (
        np.searchsorted(ranked, depth * (m + 1) + high, "right")
        - np.searchsorted(ranked, depth * (m + 1) + low, "right")
    ) + ((lens[low] > depth) & (lcp[low] <= depth))
    right_open = (high == m - 1) & (follow >= depth)
    # the parent's interval: that of the prefix one shorter, searched like any other
    up = np.maximum(depth - 1, 0)
    p_low, p_high = extents.left_extent(row, up), extents.right_extent(row, up)
    parent = smallest.minimum(p_low, p_high)
    parent_open = (lcp[p_low] >= up) | ((p_high == m - 1) & (follow >= up))
    parent_open &= depth > 0

    # open prefixes all lie on the block's first or last sequence
    path_of = {i: path_hashes(seqs[i]) for i in {0, m - 1}}

    def named(open_here: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[bytes | None]:
        out = [None] * len(open_here)
        for k in np.flatnonzero(open_here):
            out[k] = path_of[0 if start[k] == 0 else m - 1][int(length[k])]
        return out

    ends_here = (lens[low] == depth) & ~continued
    digest = [ends[i] if e else None for i, e in zip(low.tolist(), ends_here.tolist(), strict=True)]
    return pa.table({
        "conv_id": conv, "depth": depth.astype(np.int64),
        "parent_conv_id": pa.array(parent, pa.int64(), mask=(depth == 0) | parent_open),
        "n_convs": n_convs, "n_children": n_children.astype(np.int64),
        "n_leaves": leaves[high + 1] - leaves[low], "saved_tokens": saved,
        "ends_sha256": pa.array(digest, pa.string()), "node": pa.array(named(continued | right_open, low, depth), pa.binary()),
        "parent": pa.array(named(parent_open, p_low, up), pa.binary()),
    })


def prefix_nodes(convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations (``conv_id``, ``keys``, ``words``).

    ``conv_id`` is the smallest member and ``depth`` the prefix's length; with them a node is
    named. Nodes inside one block are whole; those open to a neighbour are summed by the hash of
    their prefix. A child of an open node reads its parent's smallest member by block, so
    a node with very many children is no hot key.
    """
    bounded_batches(convs.sparkSession)
    blocks = sorted_blocks(distinct_sequences(convs))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = block_nodes(rows)
        return found.append_column("block", pa.array([key[0].as_py()] * found.num_rows, pa.int32()))

    found = stored(blocks.groupBy("block").applyInArrow(run, _NODE + ", block int"), "trie-nodes")
    is_open = F.col("node").isNotNull()
    summed = found.filter(is_open).groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"), F.first("parent").alias("parent"),
    )
    summed = stored(summed, "trie-open")
    names = summed.select(F.col("node").alias("parent"), F.col("conv_id").alias("named"))
    # the open nodes of each block, with their smallest member over all blocks
    local = found.filter(is_open).select("block", F.col("node").alias("parent")).join(names, "parent")
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    whole = found.filter(~is_open).join(local, ["block", "parent"], "left").withColumn(
        "parent_conv_id", F.coalesce("named", "parent_conv_id")
    )
    wide = summed.join(names, "parent", "left").withColumn("parent_conv_id", F.col("named"))
    return whole.select(columns).unionByName(wide.select(columns)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_MEMBERS))
    )


def conversation_trie(conversations: DataFrame, every: int = 20, shared: int = 4) -> DataFrame:
    """Nodes of the prefix trie over the rebuilt conversations (see ``share_openings``).

    Null roles and texts are empty, a null turn comes first, equal turns are ordered by their
    key, repeated rows are turns like others. Rows with a null ``conv_id`` belong to no
    conversation. A conversation without turns ends at the root. An empty table has no nodes. A
    conversation is one row of the sort, at 16 bytes a turn; other columns play no part.
    """
    return prefix_nodes(share_openings(sequences(conversations), every, shared))
