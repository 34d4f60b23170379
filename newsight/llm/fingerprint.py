"""Document fingerprints: randomised edit embedding, bit sampling, banding, verification.

The embedding (Chakraborty, Goldenberg, Koucky 2016) walks over the characters: at step j it
writes the current character and moves on if a random bit shared by all documents, drawn
for (j, character), is set. Walks over two texts meet again soon after an edit, so a small
edit distance becomes a small Hamming distance. A fingerprint samples the written sequence at
the multiples of 2^k, where k follows from the length, as 4-bit hashes of the three
characters there: 64 to 128 steps of the walk's expected length, evenly over the whole text.
Two fingerprints are compared at the multiples they have in common.

Fingerprints with a band key in common are a bucket. Every pair of a bucket is compared, in
blocks of two chunks of ``CHUNK`` members; a pair with several keys in common is compared
under the smallest one. A block returns a spanning forest of its links and sums for each
member, so no pair of a bucket is ever a row. Components of the links are the classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsight.llm.common import free_shuffles, keyed_text, release, stored
from newsight.llm.minhash import forest
from newsight.operators.components import connected_components

SAMPLES = 64  # least number of samples of a text with enough characters
WALK_CHARS = 4_000_000  # characters walked over at once; bounds a task's memory
GRAM_CHARS = 1 << 19  # characters whose samples are hashed at once
BANDS, BAND_SAMPLES = 12, 6
NEAR = 0.8
CHUNK, TILE = 2048, 128  # members of a bucket in a block, rows of a block compared at once; no caps
PAIRS = 32_768  # fingerprint pairs compared at once
_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double,"
    " lane int, place string, text string"
)
_FOUND = "src long, dst long, links long, near_id long, near_likeness double"
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def level(n_chars: int) -> int:
    """k of the sampling grid: the expected walk of 2n steps has 64 to 128 multiples of 2^k."""
    return max(0, (2 * n_chars // SAMPLES).bit_length() - 1)


def _spread(x: np.ndarray) -> np.ndarray:
    """32-bit hash of each value (constants of a published integer finaliser)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def fingerprints(texts: list[np.ndarray]) -> list[str]:
    """Fingerprints of texts given as code points; all texts walk in step."""
    order = np.argsort([len(t) for t in texts], kind="stable")
    size = np.array([len(texts[i]) for i in order], np.int64)
    out = np.full((len(texts), 3 * SAMPLES + 2), 255, np.uint8)
    ks = np.array([level(int(n)) for n in size], np.int64)
    first = np.concatenate([[0], np.cumsum(size + 3)])
    chars = np.zeros(int(first[-1]), np.uint32)
    for at, i in zip(first, order, strict=False):
        chars[at : at + len(texts[i])] = texts[i] + np.uint32(1)
    wide = np.empty_like(chars)  # zero for the padding: the walk stays at the end
    for at in range(0, len(chars), GRAM_CHARS):
        wide[at : at + GRAM_CHARS] = _spread(chars[at : at + GRAM_CHARS])
    gram = np.zeros(max(0, len(chars) - 2), np.uint8)
    for at in range(0, len(gram), GRAM_CHARS):
        to = min(at + GRAM_CHARS, len(gram))
        near = chars[at:to] + wide[at + 1 : to + 1] * np.uint32(5) + wide[at + 2 : to + 2] * np.uint32(25)
        gram[at:to] = _spread(near) >> np.uint32(28)
    del chars
    rows = np.nonzero(size > 0)[0]
    pos, end = first[rows].copy(), first[rows] + size[rows]
    own_k = ks[rows]
    due = np.searchsorted(own_k, np.arange(66), "right")  # rows with a level up to tz
    bits = np.zeros(0, np.uint32)
    j = 0
    while len(rows):
        if j % 4096 == 0:
            bits = _spread(np.arange(j, j + 4096, dtype=np.uint32) * np.uint32(2654435761) + np.uint32(97)) | np.uint32(1)
        trailing = (j & -j).bit_length() - 1 if j else 64
        c = due[trailing]
        if c:
            at = pos[:c]
            column = j >> own_k[:c]
            live = (at < end[:c]) & (column < out.shape[1])
            out[rows[:c][live], column[live]] = gram[at[live]]
        pos += (wide[pos] * bits[j % 4096]) >> np.uint32(31)
        j += 1
        if j % 64 == 0:
            live = pos < end
            if not live.all():
                rows, pos, end, own_k = rows[live], pos[live], end[live], own_k[live]
                due = np.searchsorted(own_k, np.arange(66), "right")
    found: list[str] = [""] * len(texts)
    for row, i in enumerate(order):
        digits = out[row][: int((out[row] != 255).sum())]
        found[i] = f"{ks[row]:02x}" + _HEX[digits].tobytes().decode()
    return found


def likeness(a: str, b: str) -> float:
    """Share of equal samples at common multiples, less what chance gives; 0 to 1."""
    if a == b:
        return 1.0
    k = max(int(a[:2], 16), int(b[:2], 16))
    x, y = a[2 :: 1 << (k - int(a[:2], 16))], b[2 :: 1 << (k - int(b[:2], 16))]
    most = max(len(x), len(y))
    if not most or not min(len(x), len(y)):
        return 0.0
    equal = sum(p == q for p, q in zip(x, y, strict=False)) / most
    return max(0.0, (equal - 1 / 16) / (15 / 16))


def _rows_of(held: list[tuple[int, str]]) -> list[tuple]:
    """Result rows of all but the last of ``held``, each with the document after it."""
    own = [codes(t) for _, t in held]
    edited = []
    for (_, text), (_, after) in zip(held, held[1:], strict=False):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    prints = fingerprints(own + [codes(t) for t in edited])
    out = []
    for i, text in enumerate(edited):
        a, b, c = prints[i], prints[len(own) + i], prints[i + 1]
        out.append((
            held[i][0], len(own[i]), hashlib.sha256(text.encode()).hexdigest(), a, b,
            likeness(a, b), likeness(a, c), None, None, None,
        ))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64(), pa.int32(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _ROW.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names
    )


def _walk_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition; its first and last document also go out with their text."""
    lane = TaskContext.get().partitionId()
    held: list[tuple[int, str]] = []
    chars, any_row = 0, False
    for batch in batches:
        for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if not any_row:
                yield _batch([(row[0], *[None] * 6, lane, "first", row[1])])
                any_row = True
            held.append(row)
            chars += len(row[1])
            if chars >= WALK_CHARS and len(held) > 1:
                yield _batch(_rows_of(held))
                held, chars = held[-1:], len(held[-1][1])
    if len(held) > 1:
        yield _batch(_rows_of(held))
    if held:
        yield _batch([(held[-1][0], *[None] * 6, lane, "last", held[-1][1])])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness (runs jobs).

    The edited text has the last half of the code points replaced by the first ones of the
    next document in descending doc_id order (null ids come last; after the last one, the
    first). Rows with equal ids follow each other by text. Null texts are empty; an empty text has
    the fingerprint of no samples. A single document is its own next. Other columns are not
    read.

    One range shuffle puts each document before its next; only the first and last document
    of each range travel again.
    """
    own = keyed_text(docs, id_col, text_col)
    key = F.col("doc_id").desc_nulls_last()
    ranged = own.repartitionByRange(key).sortWithinPartitions(key, "text")
    walked = stored(ranged.mapInArrow(_walk_sorted, _ROW), "fingerprints")
    done = walked.filter("lane IS NULL").drop("lane", "place", "text")
    # at most two rows for each task of the shuffle above
    edges = walked.filter("lane IS NOT NULL")
    lanes = edges.filter("place = 'first'").select("lane")
    order = Window.orderBy("lane")
    after = lanes.select(
        "lane",
        F.coalesce(F.lead("lane").over(order), F.min("lane").over(Window.orderBy(F.lit(0)))).alias("next_lane"),
    )
    heads = edges.filter("place = 'first'").select(
        F.col("lane").alias("next_lane"), F.col("doc_id").alias("next_id"), F.col("text").alias("next_text")
    )
    joined = edges.filter("place = 'last'").select("doc_id", "text", "lane").join(after, "lane").join(
        heads, "next_lane"
    )

    def last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "text", "next_id", "next_text")]
            rows = []
            for i, t, j, u in zip(*cols, strict=True):
                rows += _rows_of([(i, t), (j, u)])
            yield _batch(rows)

    ends = joined.mapInArrow(last_rows, _ROW).drop("lane", "place", "text")
    return done.unionByName(ends)


# Walks of 2^(i/3) to 2^((i+1)/3) steps are class i. Texts of a likeness of at least NEAR differ
# in length by less than one class, so each text has the keys of its own class and the one below.
_LEAST_STEPS = 2.0 ** (np.arange(150) / 3)


def _grid(of: int) -> int:
    """Level of a class's bands: every text with its keys has the multiples of 2^level."""
    return max(0, of // 3 - 5)


@cache
def _places(of: int) -> np.ndarray:
    """Places of each band on the class's grid, over all that its shortest text has.

    Bands draw from windows of half of the places; each begins a twelfth later and the ends
    meet, so that a change confined to a fifth of the text leaves some bands whole.
    """
    span = int(_LEAST_STEPS[of] * (1 + 1e-9)) >> _grid(of)
    width = -(-span // 2)
    bands = []
    for band in range(BANDS):
        drawn = np.random.default_rng([of, band, 11]).choice(width, min(BAND_SAMPLES, width), replace=False)
        bands.append(np.sort((drawn + band * span // BANDS) % span))
    return np.array(bands)


_BAND_BIT, _CLASS_BIT = 4 * BAND_SAMPLES, 4 * BAND_SAMPLES + 4  # a key is class, band, digits


def digit_table(prints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Levels, numbers of samples, and the samples with 255 behind the last one."""
    ks = np.array([int(f[:2], 16) for f in prints], np.int64)
    n = np.array([len(f) - 2 for f in prints], np.int64)
    table = np.full((len(prints), max(1, int(n.max(initial=0)))), 255, np.uint8)
    flat = np.frombuffer("".join([f[2:] for f in prints]).encode(), np.uint8)
    table[np.arange(table.shape[1]) < n[:, None]] = np.where(flat >= 97, flat - 87, flat - 48)
    return ks, n, table


def key_table(ks: np.ndarray, n: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """Band keys of each fingerprint: ``BANDS`` columns for its class and for the one below.

    -1 where there is no key (empty texts; grids finer than the fingerprint's own).
    """
    out = np.full((len(ks), 2 * BANDS), -1, np.int64)
    classes = np.searchsorted(_LEAST_STEPS, n << ks, "right") - 1
    for k, own in {(int(k), int(c)) for k, c in zip(ks, classes, strict=True)}:
        rows = np.nonzero((ks == k) & (classes == own))[0]
        for step in (0, 1):
            of = own - step
            if of < 0 or _grid(of) < k:
                continue
            places = _places(of)
            sampled = digits[rows][:, places << (_grid(of) - k)].astype(np.int64)
            value = (sampled << 4 * np.arange(places.shape[1])).sum(axis=2)
            out[rows, step * BANDS : (step + 1) * BANDS] = of << _CLASS_BIT | np.arange(BANDS) << _BAND_BIT | value
    return out


def band_keys(fingerprint: str) -> list[int]:
    return [int(key) for key in key_table(*digit_table([fingerprint]))[0] if key >= 0]


def _smaller_keys(keys: np.ndarray, key: int) -> np.ndarray:
    """Digits of the keys below ``key`` that members of its bucket may share, in equal columns."""
    of, band = key >> _CLASS_BIT, key >> _BAND_BIT & 15
    columns = []
    for wanted, width in ((of - 1, BANDS), (of, band)):
        found = np.full((len(keys), width), -1, np.int64)
        for half in (0, BANDS):
            part = keys[:, half : half + width]
            found = np.where((part >= 0) & (part >> _CLASS_BIT == wanted), part & (1 << _BAND_BIT) - 1, found)
        columns.append(found)
    return np.concatenate(columns, axis=1).astype(np.int32)


def block_likeness(
    ks: np.ndarray, n: np.ndarray, digits: np.ndarray, u: np.ndarray, v: np.ndarray
) -> np.ndarray:
    """``likeness`` of the index pairs."""
    out = np.zeros(len(u))
    apart = ks[v] - ks[u]
    for d in np.unique(apart):
        own = np.nonzero(apart == d)[0]
        for at in range(0, len(own), PAIRS):
            part = own[at : at + PAIRS]
            x, y = 1 << max(0, int(d)), 1 << max(0, -int(d))
            a, b = digits[u[part], ::x], digits[v[part], ::y]
            width = min(a.shape[1], b.shape[1])
            a, b = a[:, :width], b[:, :width]
            equal = np.count_nonzero((a == b) & (a != 255), axis=1)
            most = np.maximum(-(-n[u[part]] // x), -(-n[v[part]] // y))
            out[part] = np.maximum(0.0, (equal / np.maximum(most, 1) - 1 / 16) / (15 / 16))
    return out


def bucket_links(key: int, prints: list[str], side: np.ndarray, near: float) -> tuple[np.ndarray, ...]:
    """Links of a block: forest (two index arrays), then number, smallest earlier partner
    (-1: none) and its likeness for each member.

    ``side``: pairs are taken between the two sides, or among all if there is one side.
    Pairs with a smaller key in common are left to its bucket.
    """
    table = digit_table(prints)
    left = _smaller_keys(key_table(*table), key)
    right = np.where(left < 0, -2, left)
    m, cross = len(prints), len(np.unique(side)) > 1
    links, first, like = np.zeros(m, np.int64), np.full(m, m), np.zeros(m)
    edges = np.zeros((2, 0), np.int64)
    for lo in range(0, m, TILE):
        rows = np.arange(lo, min(m, lo + TILE))
        mine = np.arange(m) > rows[:, None]
        if cross:
            mine &= side != side[rows][:, None]
        for c in range(left.shape[1]):
            mine &= left[rows, c][:, None] != right[:, c]
        u, v = np.nonzero(mine)
        u += lo
        found = block_likeness(*table, u, v)
        near_by = found >= near
        u, v, found = u[near_by], v[near_by], found[near_by]
        if not len(u):
            continue
        links += np.bincount(u, minlength=m) + np.bincount(v, minlength=m)
        before = first.copy()
        np.minimum.at(first, v, u)
        new = (u == first[v]) & (first[v] < before[v])
        like[v[new]] = found[new]
        edges = np.array(forest(np.append(edges[0], u), np.append(edges[1], v), m))
    return *edges, links, np.where(first < m, first, -1), like


def _links_of(key: int, rows: list[tuple[int, int, int, str]], near: float) -> pa.RecordBatch | None:
    """Rows of ``_FOUND`` for one block, given as (chunk, doc_id, node, fingerprint) by doc_id."""
    if len(rows) < 2:
        return None
    chunks, docs, nodes, prints = zip(*rows, strict=True)
    docs, nodes = np.array(docs, np.int64), np.array(nodes, np.int64)
    src, dst, links, first, like = bucket_links(key, list(prints), np.array(chunks), near)
    some = np.nonzero(links)[0]
    if not len(some):
        return None
    edge, pad = np.arange(len(src) + len(some)) < len(src), np.zeros(len(src))
    none = np.append(pad == 0, first[some] < 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(nodes[np.append(src, some)]),
            pa.array(nodes[np.append(dst, some)], mask=~edge),
            pa.array(np.append(pad, links[some]).astype(np.int64)),
            pa.array(docs[np.append(src, first[some])], mask=none),
            pa.array(np.append(pad, like[some]), mask=none),
        ],
        names=["src", "dst", "links", "near_id", "near_likeness"],
    )


def near_matches(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """``fingerprint, near_id, near_likeness, class_id, n_links`` (runs jobs).

    ``prints`` has ``doc_id, fingerprint``; rows without an id take no part. Equal
    fingerprints are one node, carried by their smallest doc_id. Nodes with a band key in
    common and a likeness of at least ``near`` are linked. ``near_id`` is the smallest
    doc_id of a linked node that comes before the own one (null: none), ``n_links`` the
    number of linked nodes, ``class_id`` the smallest doc_id reachable by links, the node's
    own one without any.
    Only narrow keys are shuffled before a bucket is known to have two members.
    """
    spark = prints.sparkSession
    nodes = stored(
        prints.filter("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("node", F.xxhash64("fingerprint")),
        "print-nodes",
    )

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = key_table(*digit_table(batch.column("fingerprint").to_pylist()))
            row, column = np.nonzero(keys >= 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(row)), pa.array(keys[row, column])], names=["node", "key"]
            )

    keys = stored(nodes.mapInArrow(banded, "node long, key long"), "print-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    spread = F.ceil(F.col("n") / CHUNK).cast("int")
    members = keys.join(shared.hint("shuffle_hash"), "key").select(
        "node", "key", F.pmod(F.xxhash64("node"), spread).cast("int").alias("chunk"), spread.alias("n_chunks")
    )
    blocks = (
        members.join(nodes.hint("shuffle_hash"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
        .select(
            "key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
            "chunk", "doc_id", "node", "fingerprint",
        )
        .repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "doc_id", "node")
    )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            own = zip(*[batch.column(c).to_pylist() for c in ("key", "a", "b")], strict=True)
            rest = zip(*[batch.column(c).to_pylist() for c in ("chunk", "doc_id", "node", "fingerprint")], strict=True)
            for k, row in zip(own, rest, strict=True):
                if k != block:
                    if block and (out := _links_of(block[0], rows, near)) is not None:
                        yield out
                    block, rows = k, []
                rows.append(row)
        if block and (out := _links_of(block[0], rows, near)) is not None:
            yield out

    found = stored(blocks.mapInArrow(linked, _FOUND), "print-links")
    release(keys)
    free_shuffles(spark)
    linked_to = connected_components(found.filter("dst IS NOT NULL").select("src", "dst"))
    classes = nodes.select("doc_id", "node").join(linked_to.hint("shuffle_hash"), "node")
    smallest = classes.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    of_node = classes.join(smallest, "component").select("node", "class_id")
    first = F.when(F.col("near_id").isNotNull(), F.struct("near_id", "near_likeness"))
    sums = found.filter("dst IS NULL").groupBy(F.col("src").alias("node")).agg(
        F.sum("links").alias("n_links"), F.min(first).alias("m")
    )
    return (
        nodes.join(sums.hint("shuffle_hash"), "node", "left").join(of_node.hint("shuffle_hash"), "node", "left")
        .select(
            "fingerprint", "m.near_id", "m.near_likeness",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        )
    )


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``edited_fingerprints`` with the columns of ``near_matches`` (runs jobs)."""
    prints = stored(edited_fingerprints(docs, id_col, text_col), "prints")
    free_shuffles(docs.sparkSession)
    found = near_matches(prints.select("doc_id", "fingerprint"))
    return prints.join(found.hint("shuffle_hash"), "fingerprint", "left")
