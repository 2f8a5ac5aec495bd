"""Column expressions for untrusted text, keys, dates and money (no Python per row)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date10(c: Column | str) -> Column:
    """Date from the first ten characters; blank or impossible dates become null."""
    return F.try_to_date(F.substring(column(c), 1, 10), "yyyy-MM-dd")


def to_timestamp_or_null(c: Column | str) -> Column:
    return F.try_to_timestamp(column(c))


def empty_to_null(c: Column | str) -> Column:
    """Blank after trimming becomes null; anything else is returned untrimmed."""
    c = column(c)
    return F.when(F.trim(c) != "", c)


def int_or_null(c: Column | str) -> Column:
    return column(c).try_cast("int")


def long_or_null(c: Column | str) -> Column:
    return column(c).try_cast("bigint")


def double_or_null(c: Column | str) -> Column:
    return column(c).try_cast("double")


def bool_or_null(c: Column | str) -> Column:
    return column(c).try_cast("boolean")


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def uri_tail(c: Column | str) -> Column:
    """Last path segment of a URI, the entity id in linked-data results."""
    return F.substring_index(column(c), "/", -1)


def year_text(c: Column | str) -> Column:
    """First four characters of a date, as shown in labels."""
    return F.substring(column(c).cast("string"), 1, 4)


def titled_year(title: Column | str, date: Column | str) -> Column:
    return F.concat(column(title), F.lit(" ("), F.coalesce(year_text(date), F.lit("")), F.lit(")"))


def is_title_key(c: Column | str) -> Column:
    return column(c).rlike("^tt[0-9]+$")


def is_name_key(c: Column | str) -> Column:
    return column(c).rlike("^nm[0-9]+$")


def like_pattern(term: str, wildcards: bool = True) -> str:
    """Pattern for a contains search. ``%`` and ``_`` in the term stay wildcards
    unless ``wildcards`` is off, in which case they match themselves."""
    if not wildcards:
        for special in ("\\", "%", "_"):
            term = term.replace(special, "\\" + special)
    return f"%{term}%"


def contains_ci(c: Column | str, term: str, wildcards: bool = True) -> Column:
    return column(c).ilike(like_pattern(term, wildcards))


def mean_of_known(*columns: Column | str) -> Column:
    """Mean of the non-null inputs, null when all are null."""
    cols = [column(c) for c in columns]
    known = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.when(known > 0, total / known)


def known_money(c: Column | str) -> Column:
    """Zero means unknown in the sources, so it becomes null."""
    c = column(c)
    return F.when(c > 0, c)


def profit(revenue: Column | str, budget: Column | str) -> Column:
    return known_money(revenue) - known_money(budget)
