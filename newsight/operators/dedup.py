"""Duplicate removal: keep-first by key, and the order-dependent two-key form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsight.functions.text import is_blank, strip
from newsight.functions.url import canonical_url
from newsight.operators.components import connected_components
from newsight.session import materialise, materialise_counted


def keep_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """First row of each key.

    Spark keeps only the best row per key and task before it shuffles (window
    group limit), so copies of a hot key never meet in one task.
    """
    order = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def drop_repeats(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """Same rows as ``keep_first``, for wide rows of which few repeat a key.

    Only key and order are shuffled to find the repeats; the rows themselves then
    meet the list of repeats on the unique ``order_by``. ``df`` should be stored,
    as it is read twice.
    """
    narrow = df.select(key, order_by)
    repeated = (
        narrow.groupBy(key)
        .agg(F.min(order_by).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(key, "_first")
    )
    repeats = narrow.join(repeated, key).filter(F.col(order_by) != F.col("_first"))
    return df.join(repeats.select(order_by), order_by, "left_anti").select(*df.columns)


def _scan_group(rows: pa.Table) -> pa.Table:
    """Kept positions of one conflict group of bounded size, in one walk over its rows.

    Keys are integer codes; each code has a slot that says whether a kept row holds it.
    """
    rows = rows.sort_by("at")
    codes, width = [], 0
    for name in ("a", "b"):
        column = rows.column(name).combine_chunks().dictionary_encode()
        codes.append(column.indices.fill_null(-1).to_numpy() + width)
        width += len(column.dictionary)
    # a null second key conflicts with nothing: it gets a slot of its own
    free = rows.column("b").is_null().to_numpy()
    codes[1] = np.where(free, width + np.arange(len(rows)), codes[1])
    taken, kept = bytearray(width + len(rows)), []
    for place, slots in enumerate(zip(codes[0].tolist(), codes[1].tolist(), strict=True)):
        if not any(taken[s] for s in slots):
            for s in slots:
                taken[s] = 1
            kept.append(place)
    return pa.table({"at": rows.column("at").take(pa.array(kept, pa.int64()))})


def _close_small_groups(pending: DataFrame, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """Kept positions of all conflict groups of at most ``group_rows`` rows, and the other rows.

    A conflict group is a component of rows connected by equal keys.
    """
    links = None
    for key in ("a", "b"):
        leads = pending.groupBy(key).agg(F.min("at").alias("lead"))
        linked = pending.join(leads, key).select("at", "lead")
        links = linked if links is None else links.unionByName(linked)
    groups = connected_components(links, "at", "lead")
    placed = pending.join(groups, F.col("at") == F.col("node"), "left").select(
        "at", "a", "b", F.coalesce("component", "at").alias("group")
    )
    sizes = placed.groupBy("group").agg(F.count("*").alias("n"))
    sized = materialise(placed.join(sizes, "group"), "dedup-groups")
    small = sized.filter(F.col("n") <= group_rows).select("group", "at", "a", "b")
    large = sized.filter(F.col("n") > group_rows).select("at", "a", "b")
    return small.groupBy("group").applyInArrow(_scan_group, "at long"), large


def _leads(pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First row of each first key ``(at, b, a)`` and of each second key ``(at, b)``."""
    lead_a = pending.groupBy("a").agg(F.min(F.struct("at", "b")).alias("m")).select("m.*", "a")
    return lead_a, pending.filter("b is not null").groupBy("b").agg(F.min("at").alias("at"))


def _chain_links(pending: DataFrame, lead_a: DataFrame, lead_b: DataFrame) -> DataFrame:
    """``(at, to, odd)`` of rows with just one earlier conflict, the row ``to``.

    Such a row comes first for one key (or has no second key) and second for the other.
    """
    def seconds(key: str, lead: DataFrame) -> DataFrame:
        firsts = lead.select(key, F.col("at").alias("to"))
        behind = pending.join(firsts, key).filter("at > to")
        other = "b" if key == "a" else "a"
        return behind.groupBy(key).agg(F.min(F.struct("at", other, "to")).alias("m")).select("m.*")

    by_a = seconds("a", lead_a).join(lead_b.select("at", F.lit(True).alias("leads")), "at", "left")
    by_b = seconds("b", lead_b).join(lead_a.select("at"), "at", "left_semi")
    links = by_a.filter("b is null or leads").select("at", "to").unionByName(by_b.select("at", "to"))
    return links.withColumn("odd", F.lit(True))


def _follow(links: DataFrame) -> tuple[DataFrame | None, int]:
    """Where each chain starts, and whether a row is an odd number of links behind it.

    Pointer jumping: each step doubles the links that a row has followed, so a chain of n rows
    takes about log2(n) steps. Also returns the number of steps.
    """
    live, n_live = materialise_counted(links, "dedup-chains")
    ended, steps = None, 0
    while n_live:
        known = live if ended is None else live.unionByName(ended)
        onward = known.select(F.col("at").alias("to"), F.col("to").alias("next"), F.col("odd").alias("more"))
        jumped = materialise(
            live.join(onward, "to", "left").select(
                "at", F.coalesce("next", "to").alias("to"),
                (F.col("odd") != F.coalesce("more", F.lit(False))).alias("odd"),
                F.col("next").isNull().alias("done"),
            ),
            "dedup-chains",
        )
        at_start = jumped.filter("done").drop("done")
        ended = at_start if ended is None else ended.unionByName(at_start)
        live = jumped.filter("not done").drop("done")
        n_live, steps = live.count(), steps + 1
    return ended, steps


def greedy_two_key(
    df: DataFrame,
    first_key: str,
    second_key: str,
    order_by: str,
    rounds: int = 6,
    group_rows: int = 100_000,
) -> DataFrame:
    """Rows kept by a scan in ``order_by`` order that keeps a row iff neither its
    first key nor its (non-null) second key occurs in a row kept before.

    Rejected rows do not mark their keys, so this differs from two chained
    single-key passes. It is the greedy matching of an edge list, which can be
    built in parallel (Blelloch, Fineman, Shun 2012): a row that comes first for
    both of its keys is kept; rows sharing a key with a kept row go; repeat.

    A chain of rows that each conflict with one earlier row only would cost one round per
    link. Such a row is kept iff the row before it is not, so its place in the chain decides:
    when a round has left more than half of the rows, chains are followed to their start by pointer
    jumping and closed at once, whatever their length. What is left are rows with several earlier conflicts that wait
    for each other; in general no short parallel form is known for those (the problem is
    P-complete), so after every ``rounds`` rounds the conflict groups of at most
    ``group_rows`` rows are finished at once, each in one task; larger ones go on in rounds.

    ``order_by`` is a unique integer. Hot keys: rows equal in both keys are reduced
    to their first one before any shuffle, the minima combine map-side, and kept
    rows carry each key once, so the anti-joins are skewed on one side only,
    which adaptive execution splits.
    """
    order, two = F.col(order_by).cast("long"), F.col(second_key)
    # a missing first key is a value like any other; joins would not match a null
    one = F.coalesce(F.concat(F.lit("="), F.col(first_key)), F.lit(""))
    pending, n_pending = materialise_counted(
        df.groupBy(one.alias("a"), two.alias("b")).agg(F.min(order).alias("at")).select("at", "a", "b"),
        "dedup-pending",
    )
    kept, done, slow = [], 0, False
    while n_pending:
        lead_a, lead_b = _leads(pending)
        first = lead_a.join(lead_b.select("at", F.lit(True).alias("leads_b")), "at", "left").filter(
            F.col("b").isNull() | F.col("leads_b")
        )
        chosen = materialise(first.select("at", "a", "b"), "dedup-kept")
        if slow:
            places, _ = _follow(_chain_links(pending, lead_a, lead_b))
            if places is not None:
                even = places.filter("not odd").join(chosen.select(F.col("at").alias("to")), "to", "left_semi")
                closed = materialise(pending.join(even.select("at"), "at", "left_semi"), "dedup-kept")
                chosen = chosen.unionByName(closed)
        kept.append(chosen.select("at"))
        left = pending.join(chosen.select("a"), "a", "left_anti").join(
            chosen.select("b").filter("b is not null"), "b", "left_anti"
        )
        before = n_pending
        pending, n_pending = materialise_counted(left.select("at", "a", "b"), "dedup-pending")
        done, slow = done + 1, 2 * n_pending > before
        if n_pending and done % rounds == 0:
            closed, pending = _close_small_groups(pending, group_rows)
            kept.append(materialise(closed, "dedup-kept"))
            n_pending = pending.count()
    if not kept:
        return df
    positions = kept[0]
    for more in kept[1:]:
        positions = positions.unionByName(more)
    return df.join(positions.withColumnRenamed("at", order_by), order_by, "left_semi").select(
        *df.columns
    )


def dedup_articles(articles: DataFrame) -> DataFrame:
    """Greedy dedup on canonical URL and stripped title, in ``ord`` order.

    Blank titles never conflict.
    """
    title = strip(F.col("title"))
    keyed = articles.withColumn("_url", canonical_url(F.col("url"))).withColumn(
        "_title", F.when(~is_blank(F.col("title")), title)
    )
    return greedy_two_key(keyed, "_url", "_title", "ord").drop("_url", "_title")
