"""Publication dates as text -> naive UTC timestamps (TIMESTAMP_NTZ).

Each accepted shape is one regular expression whose groups feed
``try_make_timestamp_ntz``: nothing here throws on dirty input, and no pattern
parser raises and swallows an exception per row.
"""

from __future__ import annotations

import calendar
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsight import settings
from newsight.functions.binding import let
from newsight.functions.text import strip

_MAIL = (
    r"(?i)^(?:[a-z]{3,}\.?,?\s+|[a-z]{3},)?(\d{1,2})[\s\-]+([a-z]{3,})[\s\-]+(\d{4}|\d{2}),?\s+"
    r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\s*([+\-]\d{2}:?\d{2}|[a-z]+)\b.*)?$"
)
# other orders and separators of mail dates, brought to the order day, month, year, time
_MAIL_VARIANTS = [
    (r"\s*\([^()]*\)(?=\s)", ""),  # a comment before the zone
    (r"(?i)^([a-z]{3,}\.?,?\s.*\s)(\d{1,2})\.(\d{2})\.(\d{2})(?=\s|$)", "$1$2:$3:$4"),
    (
        r"(?i)^(?:[a-z]{3,}\.?,?\s+)?([a-z]{3,})\s+(\d{1,2}),?\s+(\d{1,2}:\d{2}(?::\d{2})?)\s+(\d{4})(?=\s|$)",
        "$2 $1 $4 $3",
    ),
    (r"(?i)^[a-z]{3,}\.?,?\s+([a-z]{3,})\s+(\d{1,2}),?\s+(\d{4}),?\s+(?=\d{1,2}:)", "$2 $1 $3 "),
]
_ISO = (
    r"^(\d{4})-?(\d{2})-?(\d{2})T(\d{2})(?::?(\d{2}))?(?::?(\d{2})(?:[.,](\d+))?)?"
    r"(?:([+\-])(\d{2}):?(\d{2})?)?$"
)
_PLAIN = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:\s+(\d{1,2}):(\d{1,2}):(\d{1,2}))?$"
_MONTH_FIRST = (
    r"(?i)^([a-z]+)\s+(\d{1,2}),\s+(\d{4})"
    r"(?:,\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s+(am|pm))?$"
)
_SLASHES = r"(?i)^(\d{1,2})/(\d{1,2})/(\d{4})(?:\s+(\d{1,2}):(\d{1,2})\s+(am|pm))?$"
_DAY_FIRST = r"(?i)^(\d{1,2})\s+([a-z]+)\s+(\d{4})$"
_AGO = r"(?s)^(\d+)\s+(minute|hour|day|week)s?\s+ago"

_UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _match(text: Column, pattern: str, count: int, body: Callable[..., Column]) -> Column:
    """``body`` of the pattern's groups (empty text if unmatched); null without a match.

    One regular expression run per shape, and the groups are split once per row.
    """
    joined = "\x01".join(f"${i}" for i in range(1, count + 1))
    parts = F.split(F.regexp_replace(text, pattern, joined), "\x01")
    return let(
        parts,
        lambda g: F.when(
            (F.size(g) == count) & ~F.contains(text, F.lit("\x01")), body(*[F.element_at(g, i) for i in range(1, count + 1)])
        ),
    )


def _int(digits: Column) -> Column:
    """A matched group of digits; an unmatched group counts as 0.

    Empty text never reaches the cast: a failing cast costs an exception per row.
    """
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))


def _lookup(table: dict[str, int], key: Column) -> Column:
    entries = ", ".join(f"'{name}', {number}" for name, number in table.items())
    return F.try_element_at(F.expr(f"map({entries})"), key)


def _month(name: Column) -> Column:
    """Month number of an English month name or its three-letter form."""
    table = {}
    for number in range(1, 13):
        table[calendar.month_abbr[number].lower()] = number
        table[calendar.month_name[number].lower()] = number
    return _lookup(table, F.lower(name))


def _make(year, month, day, hour=None, minute=None, second=None) -> Column:
    zero = F.lit(0)
    second = zero if second is None else second
    # second 60 would roll over in make_timestamp; here it is not a time
    return F.when(
        second < 60,
        F.try_make_timestamp_ntz(
            year, month, day,
            zero if hour is None else hour,
            zero if minute is None else minute,
            second.cast("decimal(16,6)"),
        ),
    )


def _minus_seconds(ts: Column, seconds: Column) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def _half_day(hour: Column, marker: Column) -> Column:
    """24-hour value of a 12-hour clock reading; null outside 1..12."""
    h = _int(hour)
    return (
        F.when(marker == "", F.lit(0))
        .when(h.between(1, 12), h % 12 + F.when(F.lower(marker) == "pm", 12).otherwise(0))
    )


def _mail_date(text: Column) -> Column:
    def build(day, month, year, hour, minute, second, zone):
        short = _int(year) + F.when(_int(year) > 68, 1900).otherwise(2000)
        full_year = F.when(F.length(year) == 2, short).otherwise(_int(year))
        hours, minutes = F.substring(zone, 2, 2), F.substring(zone, -2, 2)
        clock = hours.try_cast("int") * 60 + minutes.try_cast("int")
        offset = (
            F.when(zone.startswith("-"), -clock)
            .when(zone.startswith("+"), clock)
            .otherwise(F.coalesce(_lookup(settings.MAIL_ZONE_MINUTES, F.upper(zone)), F.lit(0)))
        )
        local = _make(full_year, _month(month), _int(day), _int(hour), _int(minute), _int(second))
        return _minus_seconds(local, offset * 60)

    for pattern, order in _MAIL_VARIANTS:
        text = F.regexp_replace(text, pattern, order)
    return _match(text, _MAIL, 7, build)


def _iso_date(text: Column) -> Column:
    def build(year, month, day, hour, minute, second, fraction, sign, zone_hour, zone_minute):
        micros = F.concat(F.lit("0."), F.rpad(fraction, 6, "0")).try_cast("decimal(16,6)")
        offset = _int(zone_hour) * 3600 + _int(zone_minute) * 60
        local = _make(
            _int(year), _int(month), _int(day), _int(hour), _int(minute), _int(second) + micros
        )
        return _minus_seconds(local, F.when(sign == "-", -offset).otherwise(offset))

    zoned = F.when(text.endswith("Z"), F.replace(text, F.lit("Z"), F.lit("+00:00")))
    return _match(F.coalesce(zoned, text), _ISO, 10, build)


def _plain_date(text: Column) -> Column:
    return _match(text, _PLAIN, 6, lambda *parts: _make(*[_int(p) for p in parts]))


def parse_date(text: Column) -> Column:
    """Mail date, else ISO with ``T``, else ``Y-m-d`` with or without a time, else null.

    Zone-less dates are read as UTC. Mail dates may put the month first, the year last, dots in
    the time, or a comment before the zone; a zone with a colon is read like one without.
    ISO week dates and offsets with seconds are refused (null).
    """
    text = strip(text)
    return F.coalesce(_mail_date(text), _iso_date(text), _plain_date(text))


def as_of_literal(as_of: datetime | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def parse_relative_date(text: Column, as_of: datetime | str | Column) -> Column:
    """``2 hours ago``, ``yesterday``, ``just now``, absolute forms, then ``parse_date``."""
    now = as_of_literal(as_of)
    clean = strip(text)
    lowered = F.lower(clean)

    def ago(amount, unit):
        count = F.when(F.length(amount) <= 9, amount.try_cast("long"))
        return _minus_seconds(now, count * _lookup(_UNIT_SECONDS, unit))

    def month_first(month, day, year, hour, minute, second, half):
        return _make(
            _int(year), _month(month), _int(day), _half_day(hour, half), _int(minute), _int(second)
        )

    def slashes(month, day, year, hour, minute, half):
        return _make(_int(year), _int(month), _int(day), _half_day(hour, half), _int(minute))

    def day_first(day, month, year):
        return _make(_int(year), _month(month), _int(day))

    return (
        F.when(lowered.rlike(_AGO), _match(lowered, _AGO + ".*$", 2, ago))
        .when(F.contains(lowered, F.lit("yesterday")), _minus_seconds(now, F.lit(86400)))
        .when(F.contains(lowered, F.lit("just now")), now)
        .otherwise(
            F.coalesce(
                _match(clean, _MONTH_FIRST, 7, month_first),
                _match(clean, _SLASHES, 6, slashes),
                _match(clean, _DAY_FIRST, 3, day_first),
                parse_date(text),
            )
        )
    )
