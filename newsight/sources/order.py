"""One sortable number for the place of an entry among all sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsight import settings


def _within(value: Column, bits: int, what: str) -> Column:
    """``value``, or an error that stops the job: a wrong order must not go unseen."""
    fits = value.isNull() | value.between(0, (1 << bits) - 1)
    message = F.concat(F.lit(f"{what} needs more than {bits} bits: "), value.cast("string"))
    return F.when(fits, value).otherwise(F.raise_error(message).cast("long"))


def search_source_ord(search_ord: Column, page: Column) -> Column:
    """Source number of a search-result page; all sort after the feeds."""
    search = _within(search_ord.cast("long"), settings.SEARCH_ORD_BITS, "search_ord")
    page = _within(page.cast("long"), settings.SEARCH_PAGE_BITS, "page")
    return F.lit(settings.SEARCH_SOURCE_BASE) + F.shiftleft(search, settings.SEARCH_PAGE_BITS) + page


def packed_ord(source_ord: Column, item_ord: Column) -> Column:
    source = _within(source_ord.cast("long"), settings.SOURCE_ORD_BITS, "source_ord")
    item = _within(item_ord.cast("long"), settings.ITEM_ORD_BITS, "item_ord")
    return F.shiftleft(source, settings.ITEM_ORD_BITS) + item
