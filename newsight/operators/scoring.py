"""Text scoring with pluggable batch scorers.

A scorer maps a column of ``array<string>`` (all pieces of one row) to an array of
the same length. Scores stay in the row they belong to: no explode, no shuffle,
no join back, whatever the text length.

* ``lexicon_*`` scorers are built-in expressions and run in the JVM.
* ``batch_scorer`` wraps a Python model: loaded once per worker process, fed with
  the distinct pieces of an Arrow batch in mini-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.binding import let
from newsight.functions.numeric import round2
from newsight.functions.text import is_blank, label_text, phrases, token_windows, tokens, topic_text

ArrayScorer = Callable[[Column], Column]


# ---- scorers ----------------------------------------------------------------


def batch_scorer(
    load: Callable[[], Callable[[list[str]], list]],
    result: str,
    batch_size: int = settings.PHRASE_BATCH_SIZE,
) -> ArrayScorer:
    """Scorer around a Python model.

    ``load()`` returns a function from a list of texts to a list of results of
    Spark type ``result``. Keep rows in one Arrow batch few when texts are long
    (``spark.sql.execution.arrow.maxRecordsPerBatch``). Project and filter first:
    neither passes through a Python step. Write the output before filtering on
    it, or the model runs twice.
    """

    @F.pandas_udf(f"array<{result}>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for rows in batches:
            texts = list(dict.fromkeys(t for row in rows if row is not None for t in row))
            known = {}
            for at in range(0, len(texts), batch_size):
                chunk = texts[at : at + batch_size]
                known.update(zip(chunk, model(chunk), strict=True))
            yield rows.map(lambda row: None if row is None else [known[t] for t in row])

    return score


def weighted_polarity(weights: dict[str, float]) -> Callable[[], Callable[[list[str]], list[str]]]:
    """A small Python model for ``batch_scorer``: sign of the summed weights of a piece's words.

    Words are lower-case runs of letters. Stands in for a hosted classifier in tests and as an
    example of what ``load`` has to return.
    """

    def load() -> Callable[[list[str]], list[str]]:
        import regex

        words = regex.compile(r"\p{L}+").findall

        def label(piece: str) -> str:
            total = sum(weights.get(w, 0) for w in words(piece.lower()))
            return "positive" if total > 0 else "negative" if total < 0 else "neutral"

        return lambda pieces: [label(p) for p in pieces]

    return load


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))


def _hits(words: Column, vocabulary: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(vocabulary)))


def lexicon_polarity(positive: list[str], negative: list[str]) -> ArrayScorer:
    """Label of each piece by majority of listed words: positive, negative, neutral."""

    def label(piece: Column) -> Column:
        return let(
            _words(piece),
            lambda words: F.when(_hits(words, positive) > _hits(words, negative), F.lit("positive"))
            .when(_hits(words, positive) < _hits(words, negative), F.lit("negative"))
            .otherwise(F.lit("neutral")),
        )

    return lambda pieces: F.transform(pieces, label)


def lexicon_labels(vocabularies: dict[str, list[str]]) -> ArrayScorer:
    """Share of each label's words among all words of a piece, as ``map<label, score>``."""

    def shares(piece: Column) -> Column:
        def entry(words: Column) -> Column:
            total = F.greatest(F.size(words), F.lit(1))
            parts = []
            for name, vocabulary in vocabularies.items():
                parts += [F.lit(name), _hits(words, vocabulary) / total]
            return F.create_map(*parts)

        return let(_words(piece), entry)

    return lambda pieces: F.transform(pieces, shares)


def window_texts(text: Column) -> Column:
    """Token windows of a text, each as text again."""
    return F.transform(token_windows(tokens(text)), lambda w: F.array_join(w, " "))


# ---- aggregation of scores within a row -------------------------------------


def sentiment_ratio(labels: Column) -> Column:
    """(positive - negative) / (positive + negative), two digits; 0.0 if there are none."""

    def ratio(names: Column) -> Column:
        pos = F.size(F.filter(names, lambda n: F.contains(F.lower(n), F.lit("positive"))))
        neg = F.size(
            F.filter(
                names,
                lambda n: F.contains(F.lower(n), F.lit("negative"))
                & ~F.contains(F.lower(n), F.lit("positive")),
            )
        )
        return F.coalesce(round2(F.try_divide(pos - neg, pos + neg)), F.lit(0.0))

    return F.coalesce(let(labels, ratio), F.lit(0.0))


def ranked_labels(scores: Column, threshold: float = 0.0) -> Column:
    """``map<label, score>`` -> structs by falling score, ties by label."""
    entries = F.transform(
        F.map_entries(scores),
        lambda e: F.struct((-e["value"]).alias("order"), e["key"].alias("label")),
    )
    return F.filter(
        F.transform(
            F.array_sort(entries),
            lambda e: F.struct(e["label"].alias("label"), (-e["order"]).alias("score")),
        ),
        lambda e: e["score"] >= threshold,
    )


def top_label(scores: Column) -> Column:
    return F.try_element_at(ranked_labels(scores), F.lit(1))["label"]


def max_pool(window_scores: Column, labels: list[str]) -> Column:
    """Best score of each label over all windows, two digits, as ``map<label, score>``."""
    def pooled(maps: Column) -> Column:
        parts = []
        for name in labels:
            best = F.array_max(F.transform(maps, lambda m: F.try_element_at(m, F.lit(name))))
            parts += [F.lit(name), F.coalesce(round2(best), F.lit(0.0))]
        return F.create_map(*parts)

    return let(window_scores, pooled)


# ---- article operators ------------------------------------------------------
# A generator over a one-element array computes a score once even if several
# columns come from it; a plain projection may be inlined into each of them.


def _eligible() -> Column:
    return ~is_blank(F.col("scraped_content")) & ~is_blank(F.col("title"))


def with_pieces(rows: DataFrame, pieces: Column, name: str = "_pieces") -> DataFrame:
    """Add the texts that a scorer reads as a column of their own.

    A generator keeps them apart from the scorer's expression: over a file scan Spark does not
    move a Python function out of a plan if its input has lambdas inside lambdas.
    """
    return rows.select("*", F.explode(F.array(pieces)).alias(name))


def with_sentiment(articles: DataFrame, scorer: ArrayScorer) -> DataFrame:
    """Add ``sentiment``; 0.0 unless the scrape succeeded."""
    pieces = F.when(F.col("scrape_status") == "success", phrases(F.col("scraped_content")))
    scored = with_pieces(articles, pieces).withColumn("sentiment", sentiment_ratio(scorer(F.col("_pieces"))))
    return scored.drop("_pieces")


def with_topic(
    articles: DataFrame, scorer: ArrayScorer, names_fr: dict[str, str] = settings.TOPIC_LABELS_FR
) -> DataFrame:
    """Add ``iptc_topic`` and ``iptc_topic_fr``; null without title and content."""
    text = F.when(_eligible(), F.array(topic_text(F.col("title"), F.col("scraped_content"))))
    best = top_label(F.element_at(scorer(F.col("_pieces")), 1))

    def both(topic: Column) -> Column:
        return F.struct(topic.alias("iptc_topic"), topic_name(topic, names_fr).alias("iptc_topic_fr"))

    staged = with_pieces(articles, text)
    return staged.select(*articles.columns, F.inline(F.transform(F.array(best), both)))


def topic_name(topic: Column, names: dict[str, str] = settings.TOPIC_LABELS_FR) -> Column:
    """Display name of a topic, the topic itself if it has none.

    The list is a short constant, so it rides in the expression as a literal map.
    """
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), topic), topic)


def with_label_scores(
    articles: DataFrame,
    scorer: ArrayScorer,
    columns: dict[str, str] = settings.LABEL_COLUMNS,
) -> DataFrame:
    """Add one score column per label, best window of the whole text; 0.0 by default."""
    text = label_text(F.col("title"), F.col("scraped_content"))
    windows = F.when(_eligible(), window_texts(text))
    pooled = max_pool(scorer(F.col("_pieces")), list(columns))

    def spread(scores: Column) -> Column:
        return F.struct(
            *[
                F.coalesce(F.try_element_at(scores, F.lit(label)), F.lit(0.0)).alias(column)
                for label, column in columns.items()
            ]
        )

    staged = with_pieces(articles, windows)
    return staged.select(*articles.columns, F.inline(F.transform(F.array(pooled), spread)))
