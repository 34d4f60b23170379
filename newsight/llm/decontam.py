"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Each place of a test item seeds the shortest n-gram that the corpus is not expected to hold
by chance: its words' corpus shares multiply to less than ``CHANCE`` occurrences among all
tokens. Word counts cover all documents. How often the n-gram itself occurs plays no part,
so a passage copied into a third of all documents keeps its seeds. Two more seeds at each place
leave out every third and every fourth word, so a copy with these words replaced is
still met. Documents are scanned for seeds where they are; around each hit the item is aligned
with the document's words (local alignment, Smith and Waterman 1981), which scores copies with
words replaced, dropped or added. An alignment counts if it reaches a share of an exact copy
of the item, or the score of an exact copy of ``EXCERPT_WORDS`` words of it.

The test items are the stated query set. They are taken in blocks of ``BLOCK_BYTES``, one
pass over the documents for each, so what is broadcast has a fixed bound for any benchmark.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import (
    bounded_batches, hash_words, keyed_text, mix, plain_words, slices, split_all, text_bytes,
)

BLOCK_BYTES = 4_000_000
# words of a seed by their distance from its first one, and how many of them it has at least
SHAPES = [(0, 1, 2, 3, 4, 5, 6, 7), (0, 1, 3, 4, 6, 7, 9, 10), (0, 1, 2, 4, 5, 6, 8, 9)]
SHAPE_MIN = [3, 3, 4]
CHANCE = 1.0
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5  # score as a share of an exact copy's
EXCERPT_WORDS = 30
_HITS = "doc_id long, item_id long, score double, first_word int, last_word int"


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, first place, last place) in ``text``; linear gap cost.

    Rows are items' words. Inside a row a gap runs to the right, which a running maximum
    of ``score + place`` resolves. Each cell carries where its alignment begins.
    """
    m = len(text)
    place = np.arange(m)
    score, begin = np.zeros(m, np.int64), place.copy()
    best = (0, 0, -1)
    for word in item:
        diag = np.concatenate([[0], score[:-1]])
        diag_begin = np.where(diag > 0, np.concatenate([[0], begin[:-1]]), place)
        new = diag + np.where(text == word, MATCH, MISMATCH)
        from_up = score + GAP
        new_begin = np.where(new >= from_up, diag_begin, begin)
        new = np.maximum(new, from_up)
        fresh = new <= 0
        new[fresh], new_begin[fresh] = 0, place[fresh]
        lifted = new - GAP * place
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, place, 0))
        score, begin = top + GAP * place, new_begin[source]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(begin[at]), at)
    return best


def _word_counts(docs: DataFrame, words: np.ndarray) -> tuple[np.ndarray, int]:
    """Corpus counts of the sorted hashes ``words``, and the number of all tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts = np.zeros(len(known) + 1, np.int64)  # the last one: all tokens
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for lo, hi in slices(texts):
                own = hash_words(split_all(texts[lo:hi], plain_words)[0])
                counts[-1] += len(own)
                at = np.searchsorted(known, own)
                at[at == len(known)] = 0
                hit = known[at] == own if len(known) else np.zeros(len(own), bool)
                counts[:-1] += np.bincount(at[hit], minlength=len(known))
        used = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["i", "n"])

    rows = (
        docs.select("text").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
        .collect()  # one row for each word of the block
    )
    counts = np.zeros(len(words) + 1, np.int64)
    for r in rows:
        counts[r["i"]] = r["n"]
    return counts[:-1], int(counts[-1])


def _turned(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix((h << np.uint64(1) | h >> np.uint64(63)) ^ words)


def seeds_of(items: list[np.ndarray], words: np.ndarray, counts: np.ndarray, total: int):
    """Sorted seed hashes with their shape and number of words (one code), item and place."""
    out = []
    for k, item in enumerate(items):
        share = np.log((counts[np.searchsorted(words, item)] + 1.0) / (total + 1.0))
        for i in range(len(item)):
            for s, shape in enumerate(SHAPES):
                at = [i + o for o in shape if i + o < len(item)]
                # an item of one or two words is its own seed
                n = SHAPE_MIN[s] if s else min(SHAPE_MIN[s], len(item))
                if len(at) < n:
                    continue
                while n < len(at) and np.log(total + 1.0) + share[at[:n]].sum() >= np.log(CHANCE):
                    n += 1
                h = np.zeros(1, np.uint64)
                for w in item[at[:n]]:
                    h = _turned(h, w)
                out.append((int(h[0]), s * 16 + n, k, i))
    out.sort()
    return (
        np.array([o[0] for o in out], np.uint64), np.array([o[1] for o in out], np.int64),
        np.array([o[2] for o in out], np.int64), np.array([o[3] for o in out], np.int64),
    )


def seed_hits(words: np.ndarray, ends: np.ndarray, seed: np.ndarray, codes: np.ndarray):
    """(place, seed row) for every seed that stands in one document; repeated seeds count each."""
    places, rows = [], []
    last = np.repeat(ends, np.diff(np.concatenate([[0], ends])))  # end of the place's document
    for s, shape in enumerate(SHAPES):
        h = np.zeros(len(words), np.uint64)
        for n, offset in enumerate(shape, start=1):
            h = h[: len(words) - offset]
            if not len(h):
                break
            h = _turned(h, words[offset:])
            own = np.nonzero(codes == s * 16 + n)[0]
            if not len(own):
                continue
            known = seed[own]
            # most places hold no seed: look at some bits first
            bits = np.zeros(1 << 16, bool)
            bits[known & np.uint64(0xFFFF)] = True
            at = np.nonzero(bits[h & np.uint64(0xFFFF)])[0]
            lo, hi = np.searchsorted(known, h[at], "left"), np.searchsorted(known, h[at], "right")
            for j in np.nonzero((hi > lo) & (at + offset < last[at]))[0]:
                for r in range(lo[j], hi[j]):
                    places.append(int(at[j]))
                    rows.append(int(own[r]))
    return places, rows


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of aligned passages (runs jobs).

    One row for each document row and item whose best alignment reaches ``threshold`` of an
    exact copy's score, or that of an exact copy of ``EXCERPT_WORDS`` words; ``score`` is the share
    of a copy of the whole item. Places count words of the lower-cased text without ASCII
    punctuation. Items without words (null, empty) match nothing; an item of one or two
    words is its own seed. Null and empty texts match nothing. Repeated documents and items
    give a row each. Other columns are not read.
    """
    own = keyed_text(docs, id_col, text_col)
    found = [_search(own, block, threshold) for block in _blocks(items, item_col, item_text)]
    out = docs.sparkSession.createDataFrame([], _HITS)
    for part in found:
        out = out.unionByName(part)
    return out


def _prepared(docs: DataFrame, block: list[tuple[int, bytes]]) -> tuple:
    """Item ids, words, and seeds of a block; counts its words in all documents (runs a job)."""
    items = [hash_words(plain_words(t)) for _, t in block]
    words = np.unique(np.concatenate([*items, np.zeros(0, np.uint64)]))
    counts, total = _word_counts(docs, words)
    return [i for i, _ in block], items, *seeds_of(items, words, counts, total)


def aligned(texts: list[bytes], prepared: tuple, threshold: float) -> Iterator[tuple]:
    """(text, item id, score, first word, last word) of every text and item that align."""
    ids, items, seed, codes, item_of, place_in = prepared
    for lo, hi in slices(texts):
        split, n = split_all(texts[lo:hi], plain_words)
        own, ends = hash_words(split), np.cumsum(n)
        near: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        places, rows = seed_hits(own, ends, seed, codes)
        docs_of = np.searchsorted(ends, places, "right")
        for p, r, d in zip(places, rows, docs_of, strict=True):
            k, size = int(item_of[r]), len(items[item_of[r]])
            begin, slack = p - int(place_in[r]), size // 4 + 4
            first, end = int(ends[d] - n[d]), int(ends[d])
            near[int(d), k].append((max(first, begin - slack), min(end, begin + size + slack)))
        for (d, k), windows in near.items():
            windows.sort()
            merged = [list(windows[0])]
            for a, b in windows[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            best = max(
                (s, -(a + i), a + j)
                for a, b in merged for s, i, j in [align(items[k], own[a:b])]
            )
            share = best[0] / (MATCH * len(items[k]))
            if share >= threshold or best[0] >= MATCH * EXCERPT_WORDS:
                first = int(ends[d] - n[d])
                yield lo + d, ids[k], share, -best[1] - first, best[2] - first


def _search(docs: DataFrame, block: list[tuple[int, bytes]], threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_prepared(docs, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = aligned(text_bytes(batch.column("text")), shared.value, threshold)
            out = [(ids[i], *rest) for i, *rest in found]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["doc_id", "item_id", "score", "first_word", "last_word"],
            )

    return docs.mapInArrow(run, _HITS)


def _blocks(items: DataFrame, item_col: str, item_text: str) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of about BLOCK_BYTES; one partition of the table at a time."""
    block, held = [], 0
    rows = items.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")
    ).filter("text IS NOT NULL")
    for row in rows.toLocalIterator():
        block.append((row["item_id"], row["text"].encode()))
        held += len(block[-1][1])
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def without_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
    text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, that align with no item (runs jobs).

    Rows are dropped where they are read; nothing is shuffled. See ``contaminated``.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for block in _blocks(items, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(_prepared(own, block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, *_ in aligned(text_bytes(batch.column(text_col)), shared.value, threshold):
                    keep[i] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
