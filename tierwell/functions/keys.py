"""Positional parsers of the encoded business keys (native expressions).

* ``global_case_number``    = 3-char prefix + 3-char client code + case number
* ``global_request_number`` = 3-char prefix + client code + case number + '.' + line
* ``request_number``        = ``global_request_number`` without the prefix
* ``event_city``            = 3-char country + separator + city, or 'OTHER'
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import specs


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tail_from(col, pos: int) -> Column:
    """``substr(x, pos, length(x))``: everything from 1-based ``pos``."""
    c = _c(col)
    return c.substr(F.lit(pos), F.length(c))


def client_of_case(gcn) -> Column:
    return _c(gcn).substr(4, 3)


def case_number(gcn) -> Column:
    return tail_from(gcn, 7)


def case_key(gcn) -> Column:
    """Client code + case number: what a request number starts with."""
    return tail_from(gcn, 4)


def request_number(grn) -> Column:
    return tail_from(grn, 4)


def client_of_request(rn) -> Column:
    return _c(rn).substr(1, 3)


def case_key_of_request(rn) -> Column:
    """Text before the first '.'; '' when there is no dot (not the whole string)."""
    c = _c(rn)
    return c.substr(F.lit(1), F.instr(c, ".") - 1)


def day_of(ts) -> Column:
    """Calendar day of a timestamp (the first 10 characters of its ISO text)."""
    return F.to_date(_c(ts))


def city_country(event_city) -> Column:
    c = _c(event_city)
    return F.when(c == specs.OTHER_CITY, F.lit(specs.OTHER_COUNTRY)).otherwise(c.substr(1, 3))


def city_name(event_city) -> Column:
    c = _c(event_city)
    return F.when(c == specs.OTHER_CITY, F.lit(specs.OTHER_CITY)).otherwise(tail_from(c, 5))


def ilike_prefix(col, pattern_lower: str) -> Column:
    """ASCII case-insensitive LIKE as the source database evaluates it."""
    return F.lower(_c(col)).like(pattern_lower)
