"""Near-duplicates: an inverted join on MinHash signature coordinates.

Every distinct shingle set is posted under ``COORDINATES`` signature values, and two sets are
candidates when they share at least ``MATCHES`` of them. A pair with a Jaccard similarity of 0.8
shares fewer than 32 of 64 with a probability of 2e-8.

* Prefix: two sets with ``MATCHES`` shared values share one of the ``COORDINATES - MATCHES + 1``
  rarest of each. Only these are posted; values that stand in one set count as the rarest, so
  a set with many of them is skipped as a whole.
* Inside a list collisions are counted over ``SIGNATURE`` coordinates, and a pair goes on with
  ``AGREE`` of them (a pair at 0.8 has fewer with a probability of 3e-8). Lists are compared in blocks of
  two chunks of ``CHUNK`` sets; no pair of a group is ever a row.
* First pass: every set names two candidates in the first chunks of its lists, which are confirmed on
  the full sets. That joins groups of near copies at linear cost.
* Families: the named pairs connect sets, and lists that still hold sets of several families are compared
  whole; each block returns a spanning forest of its candidates between families.
* Second pass: families in which confirmed components differ are compared, again in blocks of two chunks.
  Sets with a candidate in another component fetch their texts and are confirmed by exact intersections.
  Sets of one component need no further link; no candidate is a link before its full sets were
  compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import (
    free_shuffles, gram_hashes, hash_words, keyed_text, mix, release, slices, split_all, stored,
    text_bytes,
)
from newsight.operators.bloom import bloom_words, maybe_in
from newsight.operators.components import connected_components

COORDINATES, MATCHES = 64, 32
SIGNATURE, AGREE = 128, 76
CHUNK = 512
PAIRS = 50_000  # pairs compared at once inside a task; bounds its memory, not the result
_MEMBER = "list long, a int, b int, node long, chunk int, label long, signature array<int>"
_ROW = "doc_id long, n_shingles long, node long, signature array<int>"


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``n`` words are one shingle, none are none."""
    return np.unique(gram_hashes(words, min(n, len(words)))) if len(words) else words


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """Sets of texts: A-Z in lower case, words split at ASCII white space."""
    for lo, hi in slices(texts):
        words, counts = split_all(texts[lo:hi], lambda t: t.lower().split())
        hashed = hash_words(words)
        ends = np.cumsum(counts)
        for end, count in zip(ends, counts, strict=True):
            yield shingle_set(hashed[end - count : end], n)


def node_of(shingles: np.ndarray) -> int:
    """64-bit identity of a set."""
    return int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))


def _multipliers() -> np.ndarray:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**63, SIGNATURE, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each multiplication, upper half."""
    least = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 4096):
        part = shingles[lo : lo + 4096]
        np.minimum(least, (part[None, :] * by[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, n: int, text_key: bool = False) -> DataFrame:
    """``doc_id, n_shingles, node, signature``; node and signature are null for no words.

    With ``text_key``, the text's SHA-256 too.
    """
    by, own = _multipliers(), keyed_text(docs)
    kept = ["doc_id"]
    if text_key:
        own, kept = own.withColumn("text_key", F.sha2("text", 256)), ["text_key", "doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, node, sign = [], [], []
            for s in shingle_sets(text_bytes(batch.column("text")), n):
                size.append(len(s))
                node.append(node_of(s) if len(s) else None)
                sign.append(signature(s, by) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept], pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                    pa.array(sign, pa.list_(pa.int32())),
                ],
                names=[*kept, "n_shingles", "node", "signature"],
            )

    return own.mapInArrow(run, f"text_key string, {_ROW}" if text_key else _ROW)


def prefixes(classes: DataFrame) -> DataFrame:
    """``node, signature, prefix`` of the sets that may have a candidate; ``prefix`` has the lists that the
    set is posted in, with their lengths."""
    postings = classes.select("node", F.posexplode(F.slice("signature", 1, COORDINATES)).alias("c", "v"))
    lists = postings.groupBy("c", "v").agg(F.count("*").alias("n")).filter("n > 1")
    shared = postings.join(lists.hint("shuffle_hash"), ["c", "v"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", F.xxhash64("c", "v").alias("list")))).alias("p")
    )
    rarest = shared.filter(F.size("p") >= MATCHES).select(
        "node", F.slice("p", F.lit(1), F.size("p") - (MATCHES - 1)).alias("prefix")
    )
    return rarest.join(classes.select("node", "signature").hint("shuffle_hash"), "node")


def labelled(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """With ``label``, the component of a set; a set without one is a component of its own."""
    return sets.join(labels.hint("shuffle_hash"), "node", "left").withColumn("label", F.coalesce("label", "node"))


def in_blocks(members: DataFrame, posted: DataFrame, key: str, size: str) -> DataFrame:
    """Members of each key, dealt to blocks of two of its chunks, with their signatures."""
    spread = F.ceil(F.col(size) / CHUNK).cast("int")
    return members.select(
        F.col(key).alias("list"), "node", "label", F.pmod(F.xxhash64("node"), spread).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), spread - 1)).alias("other"),
    ).join(posted.select("node", "signature").hint("shuffle_hash"), "node").select(
        "list", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
        "node", "chunk", "label", "signature",
    )


def of_several(members: DataFrame, key: str) -> DataFrame:
    """Keys whose members belong to several components, with the number of members."""
    return (
        members.groupBy(key).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
        .filter("low < high").select(key, "size")
    )


def list_blocks(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Blocks of the lists that hold sets of several labels (without labels, all sets differ)."""
    sets = posted.withColumn("label", F.col("node")) if labels is None else labelled(posted, labels)
    members = sets.select("node", "label", F.explode("prefix").alias("p")).select("node", "label", "p.list", "p.n")
    mixed = members.join(of_several(members, "list").hint("shuffle_hash"), "list", "left_semi")
    return in_blocks(mixed, posted, "list", "n")


def family_blocks(posted: DataFrame, labels: DataFrame, families: DataFrame) -> DataFrame:
    """Blocks of the families that hold sets of several components."""
    members = labelled(families, labels)
    mixed = members.join(of_several(members, "family").hint("shuffle_hash"), "family")
    return in_blocks(mixed, posted, "family", "size")


def dealt(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("list", "a", "b").sortWithinPartitions("list", "a", "b", "node")


def whole_groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``key`` as tables that hold groups whole, with the first row of each group."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        first = _firsts(held, key)
        if len(first) > 1:
            yield held.slice(0, int(first[-1])), first[:-1]
            held = held.slice(int(first[-1])).combine_chunks()
    if held is not None and len(held):
        yield held, _firsts(held, key)


def _firsts(rows: pa.Table, key: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in key:
        own = rows.column(name).to_numpy()
        new[1:] |= own[1:] != own[:-1]
    return np.nonzero(new)[0]


def agreeing(rows: pa.Table, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidate pairs of rows in blocks, and in how many coordinates they agree.

    A pair of one component, or of one chunk in a block of two, is none.
    """
    sign = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, SIGNATURE)
    label, chunk = rows.column("label").to_numpy(), rows.column("chunk").to_numpy()
    alone = rows.column("a").to_numpy() == rows.column("b").to_numpy()
    size = np.diff(np.append(first, len(rows)))
    after = np.repeat(first + size, size) - np.arange(len(rows)) - 1  # partners of each row
    done = np.concatenate([[0], np.cumsum(after)])
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIRS, "right")) - 1)
        many = after[lo:hi]
        u = np.repeat(np.arange(lo, hi), many)
        v = u + 1 + np.arange(len(u)) - np.repeat(done[lo:hi] - done[lo], many)
        lo = hi
        apart = (label[u] != label[v]) & (alone[u] | (chunk[u] != chunk[v]))
        u, v = u[apart], v[apart]
        agree = (sign[u] == sign[v]).sum(1)
        enough = agree >= AGREE
        yield u[enough], v[enough], agree[enough]


def first_partners(blocks: DataFrame) -> DataFrame:
    """Pairs ``src, dst``: of each set with its first and its most similar candidate in all its blocks.

    A task combines its blocks before it returns a row for a set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in whole_groups(batches, ("list", "a", "b")):
            node, at = np.unique(rows.column("node").to_numpy(), return_inverse=True)
            low = np.full(len(node), len(node))
            near, most = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
            for u, v, agree in agreeing(rows, first):
                u, v = at[u], at[v]
                for own, other in ((u, v), (v, u)):
                    np.minimum.at(low, own, other)
                    rising = np.argsort(agree, kind="stable")
                    best, count = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
                    best[own[rising]], count[own[rising]] = other[rising], agree[rising]
                    near = np.where(count > most, best, near)
                    most = np.maximum(count, most)
            named = np.nonzero(most)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (node[named], node[low[named]], node[near[named]], most[named])],
                names=["node", "low", "near", "agree"],
            )

    found = dealt(blocks.filter("a = 0")).mapInArrow(run, "node long, low long, near long, agree long")
    chosen = found.groupBy("node").agg(
        F.min("low").alias("low"), F.max_by("near", F.struct("agree", "near")).alias("near")
    )
    return chosen.select("node", F.explode(F.array("low", "near")).alias("other")).select(
        F.least("node", "other").alias("src"), F.greatest("node", "other").alias("dst")
    ).distinct()


def candidate_forest(blocks: DataFrame) -> DataFrame:
    """Edges ``src, dst`` that connect the candidates of each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in whole_groups(batches, ("list", "a", "b")):
            node = rows.column("node").to_numpy()
            for u, v, _ in agreeing(rows, first):
                if len(u):
                    u, v = forest(u, v, len(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], names=["src", "dst"])

    return dealt(blocks).mapInArrow(run, "src long, dst long")


def members_with_candidates(blocks: DataFrame) -> DataFrame:
    """The rows of blocks that have a candidate there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in whole_groups(batches, ("list", "a", "b")):
            wanted = np.zeros(len(rows), bool)
            for u, v, _ in agreeing(rows, first):
                wanted[u] = wanted[v] = True
            yield from rows.filter(pa.array(wanted)).to_batches()

    return dealt(blocks).mapInArrow(run, _MEMBER)


def stars(pairs: DataFrame) -> DataFrame:
    """Pairs as blocks of one set and a chunk of its partners."""
    many = pairs.groupBy("src").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("spread"))
    spokes = pairs.join(many.hint("shuffle_hash"), "src").select(
        F.col("src").alias("list"), F.lit(0).alias("a"),
        F.pmod(F.xxhash64("dst"), F.col("spread")).cast("int").alias("b"), F.col("dst").alias("node"), F.lit(1).alias("chunk"),
    )
    hubs = many.select(
        F.col("src").alias("list"), F.lit(0).alias("a"),
        F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("b"), F.col("src").alias("node"), F.lit(0).alias("chunk"),
    )
    return spokes.unionByName(hubs)


def block_links(
    sets: list[np.ndarray], side: np.ndarray, percent: int, among: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose Jaccard similarity is at least ``percent`` / 100, from exact counts.

    ``side``: pairs are taken between the two sides, or among all if there is one side. ``among``:
    a matrix of the pairs to look at.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), size)
    every = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    owner, value = owner[order], every[order]
    new = np.concatenate([[True], value[1:] != value[:-1]]) if len(value) else np.zeros(0, bool)
    start = np.nonzero(new)[0]
    length = np.diff(np.append(start, len(value)))
    group = np.empty(len(value), np.int64)  # posting list of each element, in set order
    group[order] = np.cumsum(new) - 1
    cross = len(np.unique(side)) > 1
    left, right = [], []
    at = 0
    for i in range(m):
        own = group[at : at + size[i]]
        at += size[i]
        if (cross and side[i] != side.min()) or (among is not None and not among[i].any()):
            continue
        own = own[length[own] > 1]
        if not len(own):
            continue
        n = length[own]
        places = np.repeat(start[own] - np.concatenate([[0], np.cumsum(n[:-1])]), n) + np.arange(n.sum())
        shared = np.bincount(owner[places], minlength=m)
        links = 100 * shared >= percent * (size[i] + size - shared)
        links &= (side != side[i]) if cross else (np.arange(m) > i)
        if among is not None:
            links &= among[i]
        found = np.nonzero(links)[0]
        left.append(np.full(len(found), i))
        right.append(found)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(u: np.ndarray, v: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """One link for each index that is not the smallest of its component."""
    label = np.arange(m)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    moved = np.nonzero(label != np.arange(m))[0]
    return label[moved], moved


def confirmed_links(docs: DataFrame, wanted: DataFrame, n: int, percent: int) -> DataFrame:
    """A spanning forest ``src, dst`` of the links inside each block, from full texts.

    ``wanted`` has ``doc_id, list, a, b, node, chunk``: one document for each set of a block. With signatures,
    only pairs that agree are looked at, else all between its two chunks.
    """
    signed = "signature" in wanted.columns
    carried = ["list", "a", "b", "node", "chunk"] + ["label", "signature"] * signed
    # a Bloom filter thins the texts out before they move; the join decides
    near = maybe_in(keyed_text(docs), "doc_id", bloom_words(wanted, "doc_id"))
    # the members grow with the corpus: never rely on broadcasting them
    texts = wanted.hint("merge").join(near, "doc_id").select(*carried, "text")

    def links(rows: pa.Table) -> pa.RecordBatch | None:
        node, kept, sets, seen = rows.column("node").to_pylist(), [], [], set()
        texts = [t for part in rows.column("text").chunks for t in text_bytes(part)]
        for i, s in enumerate(shingle_sets(texts, n)):
            # repeated rows, and other texts under a repeated doc_id
            if node[i] not in seen and len(s) and node_of(s) == node[i]:
                seen.add(node[i])
                kept.append(i)
                sets.append(s)
        if len(sets) < 2:
            return None
        rows = rows.drop_columns(["text"]).take(kept).combine_chunks()
        among = None
        if signed:
            among = np.zeros((len(sets), len(sets)), bool)
            for u, v, _ in agreeing(rows, np.zeros(1, np.int64)):
                among[u, v] = among[v, u] = True
        u, v = block_links(sets, rows.column("chunk").to_numpy(), percent, among)
        if not len(u):
            return None
        u, v = forest(u, v, len(sets))
        nodes = rows.column("node").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(nodes[u]), pa.array(nodes[v])], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in whole_groups(batches, ("list", "a", "b")):
            for lo, hi in zip(first, np.append(first[1:], len(rows)), strict=True):
                if (out := links(rows.slice(int(lo), int(hi - lo)))) is not None:
                    yield out

    return dealt(texts).mapInArrow(run, "src long, dst long")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80,
    id_col: str = "doc_id", text_col: str = "text", text_key: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every input row (runs jobs).

    With ``text_key`` also the SHA-256 of the row's text, which tells rows with one id and different
    texts apart: each is judged by its own text.

    A document's set holds its distinct shingles of ``shingle_words`` words (the whole
    sequence if it has fewer). Documents with a Jaccard similarity of at least ``percent``
    / 100 are linked; ``component_id`` is the smallest doc_id reachable, and ``kept`` marks
    the documents that carry it. Null, empty and blank texts have no shingle and are linked
    with nothing. Rows without doc_id are returned with a null component and kept = false.
    Repeated rows get equal results. Other columns are not read.
    """
    spark = docs.sparkSession
    own = keyed_text(docs, id_col, text_col)
    base = stored(signatures(own, shingle_words, text_key), "signatures")
    classes = stored(
        base.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.any_value("signature").alias("signature")
        ),
        "classes",
    )
    free_shuffles(spark)
    posted = stored(prefixes(classes), "prefixes")
    free_shuffles(spark)
    documents = classes.select("node", "doc_id")

    def confirmed(wanted: DataFrame, name: str) -> DataFrame:
        named = stored(wanted.join(documents.hint("shuffle_hash"), "node"), name)
        found = stored(confirmed_links(own, named, shingle_words, percent), "near-links")
        release(named)
        free_shuffles(spark)
        return found

    pairs = stored(first_partners(list_blocks(posted, None)), "partners")
    free_shuffles(spark)
    links = confirmed(stars(pairs), "stars")
    near = connected_components(pairs).select("node", F.col("component").alias("label"))
    edges = stored(candidate_forest(list_blocks(posted, near)), "near-edges")
    free_shuffles(spark)
    families = connected_components(pairs.unionByName(edges)).select("node", F.col("component").alias("family"))
    groups = connected_components(links).select("node", F.col("component").alias("label"))
    rest = confirmed(members_with_candidates(family_blocks(posted, groups, families)), "candidates")
    linked = connected_components(links.unionByName(rest))
    labelled = classes.select("doc_id", "node").join(linked, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = stored(
        labelled.join(smallest, "component").select("node", "component_id"), "near-components"
    )
    release(classes, posted, pairs, links, edges, rest)
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    )
    names = ["doc_id", "n_shingles"] + ["text_key"] * text_key
    return base.select(*names, "node").join(of_node.hint("shuffle_hash"), "node", "left").select(
        *names, component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )
