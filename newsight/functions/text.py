"""Text expressions: strip, phrase split, token windows, truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.binding import let

# every character a Unicode-aware strip removes, built from the rule itself
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# the same set as a regex class body (Java's \s with U misses U+001C..U+001F)
_SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (SQL ``trim`` removes U+0020 only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(text), F.lit("")) == ""


def ascii_squeeze(text: Column) -> Column:
    """Each run of non-ASCII characters becomes one space."""
    return F.regexp_replace(text, r"[^\x00-\x7F]+", " ")


def truncate(text: Column, limit: int) -> Column:
    """Keep the first ``limit`` characters and mark the cut."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(settings.ELLIPSIS))
    ).otherwise(text)


def phrases(
    text: Column,
    min_chars: int = settings.PHRASE_MIN_CHARS,
    max_chars: int = settings.PHRASE_MAX_CHARS,
) -> Column:
    """Sentences of at least ``min_chars``; longer ones than ``max_chars`` are sliced.

    Splits at whitespace that follows ``.``, ``!`` or ``?``. Null text gives an
    empty array. One row in, one row out: no shuffle.
    """
    sentences = F.filter(
        F.transform(F.split(text, rf"(?U)(?<=[.!?]){_SPACE}+"), strip),
        lambda s: F.length(s) >= min_chars,
    )

    def pieces(sentence: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(sentence), F.lit(max_chars))
        cut = F.transform(starts, lambda at: strip(F.substring(sentence, at, F.lit(max_chars))))
        return F.when(F.length(sentence) <= max_chars, F.array(sentence)).otherwise(
            F.filter(cut, lambda p: F.length(p) >= min_chars)
        )

    return F.coalesce(
        F.flatten(F.transform(sentences, pieces)), F.array().cast("array<string>")
    )


def tokens(text: Column) -> Column:
    """Whitespace tokens; the place where a model tokenizer may be plugged in."""
    return F.filter(F.split(text, rf"(?U){_SPACE}+"), lambda t: t != "")


def token_windows(
    toks: Column,
    size: int = settings.WINDOW_TOKENS,
    stride: int = settings.WINDOW_STRIDE,
) -> Column:
    """Overlapping windows of a token array; a short array is its own window."""

    def cut(all_tokens: Column) -> Column:
        n = F.size(all_tokens)
        starts = F.sequence(F.lit(0), n - 1, F.lit(stride))
        return F.when(n <= size, F.array(all_tokens)).otherwise(
            F.transform(starts, lambda at: F.slice(all_tokens, at + 1, F.lit(size)))
        )

    return let(toks, cut)


def topic_text(
    title: Column, content: Column, limit: int = settings.TOPIC_CONTENT_CHARS
) -> Column:
    """Title and the head of the content, the input of the topic model."""
    return F.concat(strip(title), F.lit(". "), F.substring(strip(content), 1, limit))


def label_text(title: Column, content: Column) -> Column:
    """Title and whole content, the input of the multi-label model."""
    return F.concat(strip(title), F.lit(". "), strip(content))


def fill(template: str, **values: Column) -> Column:
    """Concatenate a ``{name}`` template with columns."""
    parts, rest = [], template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(values[name])
    return F.concat(*parts)


def article_prompt(
    title: Column, content: Column, limit: int = settings.SUMMARY_CONTENT_CHARS
) -> Column:
    """Prompt of the summary step for one article, content cut to ``limit``."""
    return fill(
        settings.ARTICLE_PROMPT, title=strip(title), content=truncate(strip(content), limit)
    )


def retry_article_prompt(title: Column, content: Column) -> Column:
    """Shorter prompt used after a reply that was not JSON."""
    first = truncate(strip(content), settings.SUMMARY_CONTENT_CHARS)
    return fill(
        settings.ARTICLE_PROMPT,
        title=strip(title),
        content=truncate(first, settings.SUMMARY_RETRY_CHARS),
    )
