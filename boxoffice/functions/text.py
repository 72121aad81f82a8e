"""Text helpers: slugs, padding, venue labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_slug(x) -> Column:
    """Every run of non-alphanumerics becomes one ``-``, then lower case."""
    return F.lower(F.regexp_replace(_c(x), "[^0-9A-Za-z]+", "-"))


def underscore_slug(x) -> Column:
    """Same with ``_``: ``Admin Fee (Not a Gratuity)`` -> ``admin_fee_not_a_gratuity_``."""
    return F.lower(F.regexp_replace(_c(x), "[^0-9A-Za-z]+", "_"))


def ljust(x, width: int, pad: str) -> Column:
    """Pad on the right to ``width``; never truncates (unlike bare ``rpad``)."""
    c = _c(x)
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, pad))


def short_venue(x) -> Column:
    """Lower case, spaces to ``_``, ``nightclub`` -> ``nc``, ``dayclub`` -> ``day``."""
    c = F.replace(F.lower(_c(x)), F.lit(" "), F.lit("_"))
    c = F.replace(c, F.lit("nightclub"), F.lit("nc"))
    return F.replace(c, F.lit("dayclub"), F.lit("day"))


def strip_spaces(x) -> Column:
    return F.replace(_c(x), F.lit(" "), F.lit(""))
