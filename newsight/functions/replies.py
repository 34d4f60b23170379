"""Model replies: repair, parse, validate, normalise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.text import strip
from newsight.schemas import ANALYSIS_JSON, RELEVANCE_JSON

_FENCE = "```"
# Jackson accepts these by default; standard JSON does not
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def drop_cut_escapes(text: Column) -> Column:
    r"""Delete ``\u`` escapes that lack their four hex digits."""
    return F.regexp_replace(text, r"\\u(?![0-9a-fA-F]{4})[0-9a-fA-F]{0,3}", "")


def repair_batch_reply(raw: Column) -> Column:
    """Text between the first two fences, ``json`` tag dropped, escapes repaired."""
    text = strip(raw)
    fenced = F.split_part(text, F.lit(_FENCE), F.lit(2))
    untagged = F.when(fenced.startswith("json"), F.substring(fenced, 5, F.length(fenced)))
    inner = F.coalesce(untagged, fenced)
    return strip(drop_cut_escapes(F.when(text.startswith(_FENCE), inner).otherwise(text)))


def repair_article_reply(raw: Column) -> Column:
    """Text after the fence line up to the last fence, escapes repaired.

    A fence without a line break cannot be opened: null.
    """
    text = strip(raw)
    first_line = F.substring_index(text, "\n", 1)
    rest = F.substring(text, F.length(first_line) + 2, F.length(text))
    tail = F.substring_index(rest, _FENCE, -1)
    closed = F.left(rest, F.length(rest) - F.length(tail) - len(_FENCE))
    inner = F.when(F.contains(rest, F.lit(_FENCE)), closed).otherwise(rest)
    opened = F.when(F.contains(text, F.lit("\n")), strip(inner))
    return drop_cut_escapes(F.when(text.startswith(_FENCE), opened).otherwise(text))


def _strict_json(text: Column, schema: str) -> Column:
    # the JSON reader stops after the first value; a valid document ends with it
    return F.when(strip(text).rlike(r"[\]}]$"), F.from_json(text, schema, _STRICT))


def parse_batch_reply(text: Column) -> Column:
    """Array of reply objects, null if the text is not JSON of that shape."""
    return _strict_json(text, RELEVANCE_JSON)


def score_value(raw: Column) -> Column:
    """Integer score from a JSON number or a quoted number."""
    return raw.try_cast("double").try_cast("int")


def batch_item_problems(item: Column) -> Column:
    """Names of the fields of one reply object that break its schema."""
    number = item["relevance_score"].try_cast("double")
    checks = [
        ("article_id", item["article_id"].isNull()),
        ("relevance_score", F.coalesce(number != F.floor(number), F.lit(True))),
        ("category", ~F.coalesce(item["category"], F.lit("")).isin(settings.RELEVANCE_CATEGORIES)),
        ("reasoning", item["reasoning"].isNull()),
        ("key_indicators", item["key_indicators"].isNull()),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))


def parse_article_reply(text: Column) -> Column:
    """Reply object; a lone object and the first of a list are treated alike."""
    return F.try_element_at(_strict_json(text, ANALYSIS_JSON), F.lit(1))


def _perception(raw: Column) -> Column:
    value = strip(F.lower(raw))
    out = F.lit(None).cast("string")
    for canonical, forms in settings.PERCEPTION_FORMS.items():
        out = F.when(value.isin(forms), F.lit(canonical)).otherwise(out)
    return out


def normalise_analysis(summary: Column, quebec: Column, perception: Column, flag: Column) -> Column:
    """Normalised fields plus the names of the rejected ones.

    The reply is usable only if ``problems`` is empty. Length is tested before the
    summary is stripped.
    """
    place = strip(F.lower(quebec))
    mood = _perception(perception)
    mark = strip(flag)
    checks = [
        ("summary", F.coalesce(
            ~F.length(summary).between(1, settings.SUMMARY_MAX_CHARS) | (strip(summary) == ""),
            F.lit(True),
        )),
        ("quebec", ~F.coalesce(place, F.lit("")).isin(settings.QUEBEC_VALUES)),
        ("perception", mood.isNull()),
        ("Flag", ~F.coalesce(mark, F.lit("")).isin(settings.FLAG_VALUES)),
    ]
    problems = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))
    return F.struct(
        strip(summary).alias("summary"),
        place.alias("quebec"),
        mood.alias("perception"),
        mark.alias("Flag"),
        problems.alias("problems"),
    )
