"""Column expressions: rates, shapes, tags, text and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a photo counts as recent for this many days.
RECENT_DAYS = 30


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(value: dt.date | str) -> Column:
    """A date literal."""
    return F.lit(str(value)).cast("date")


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def per_view_rate(counter: Column | str, views: Column | str = "views") -> Column:
    """``counter / views * 100``; 0 without views, NULL where the counter itself is NULL."""
    counter, views = col(counter).cast("double"), col(views)
    return F.when(views > 0, counter / views * 100).otherwise(F.lit(0.0))


def aspect_ratio(width: Column | str = "width", height: Column | str = "height") -> Column:
    """Width over height; NULL for a zero or missing height."""
    return F.try_divide(col(width).cast("double"), col(height).cast("double"))


def orientation(width: Column | str = "width", height: Column | str = "height") -> Column:
    width, height = col(width), col(height)
    return (
        F.when(width > height, "landscape").when(height > width, "portrait").otherwise("square")
    )


def mean2(total: Column, count: Column) -> Column:
    """Mean rounded to two places, as a double."""
    return F.round(F.try_divide(total.cast("double"), count), 2)


def mean_decimal(total: Column, count: Column) -> Column:
    """Mean as decimal(10,2), 0 for an empty group."""
    return F.when(count > 0, total.cast("double") / count).otherwise(0.0).cast("decimal(10,2)")


def parse_ts(c: Column | str) -> Column:
    """ISO-8601 text with ``Z`` or an offset to a timestamp; NULL if it does not parse."""
    return col(c).try_cast("timestamp")


def clean_tags(tags: Column | str = "tags") -> Column:
    """Titles of raw tag objects in order, without null or empty ones; never NULL."""
    titles = F.transform(F.coalesce(col(tags), F.array()), lambda t: t["title"])
    return F.filter(titles, lambda title: title != "")


def first_tag(tags: Column | str = "tags") -> Column:
    return F.get(col(tags), 0)


def tag_bag(tags: Column | str = "tags") -> Column:
    """Distinct tags of one photo with their multiplicity, sorted by tag."""
    tags = col(tags)
    distinct = F.array_sort(F.array_distinct(tags))

    def entry(n):
        return lambda tag: F.struct(tag.alias("tag"), n(tag).cast("bigint").alias("n"))

    once = F.transform(distinct, entry(lambda tag: F.lit(1)))
    counted = F.transform(
        distinct, entry(lambda tag: F.size(F.filter(tags, lambda x: x.eqNullSafe(tag))))
    )
    return F.when(F.size(distinct) == F.size(tags), once).otherwise(counted)


def shorten(c: Column | str, width: int = 50) -> Column:
    """Text cut to ``width`` characters plus ``...`` where it is longer."""
    c = col(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def matches_any(q: str, *columns: str) -> Column:
    """Case-insensitive substring match in any column; ``%`` and ``_`` in ``q`` are wildcards."""
    found = F.lit(False)
    for name in columns:
        found = found | F.coalesce(F.col(name).ilike(f"%{q}%"), F.lit(False))
    return found
