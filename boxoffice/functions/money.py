"""Money columns: text at rest, decimal(10,2) in queries, decimal(38,2) out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

MONEY = "decimal(10,2)"
ROW = "decimal(18,2)"   # per-row money out: long-backed, no BigDecimal per value
WIDE = "decimal(38,2)"  # sums out


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """``CAST(x AS DECIMAL(10,2))`` — rounds half-up, null stays null."""
    return _c(x).cast(MONEY)


def money_or_zero(x) -> Column:
    """Cast then default: ``COALESCE(CAST(x AS DECIMAL(10,2)), 0.00)``."""
    return F.coalesce(money(x), F.lit(0).cast(MONEY))


def zero_then_money(x) -> Column:
    """Default then cast: ``CAST(COALESCE(x, '0.00') AS DECIMAL(10,2))``."""
    return F.coalesce(_c(x), F.lit("0.00")).cast(MONEY)


def money18(x) -> Column:
    """A per-row money value in the shared output type (fits a long)."""
    return _c(x).cast(ROW)


def money38(x) -> Column:
    """Widen a sum to the output type shared with the oracle."""
    return _c(x).cast(WIDE)


def money_text(x) -> Column:
    """``'%.2f'`` of a decimal: two decimals, as text."""
    return _c(x).cast(WIDE).cast("string")


def sum_money(x, over: WindowSpec | None = None) -> Column:
    """Exact sum of a two-decimal money column (over a window, if one is given), as ``decimal(38,2)``.

    Accumulated as integer cents in a long (a plain ``sum`` of ``decimal(10,2)``
    widens to ``decimal(20,2)``, whose buffer is a ``BigDecimal`` per update).
    Null in, null out; an overflow raises under ANSI mode instead of wrapping.
    """
    cents = (_c(x) * 100).cast("bigint")
    total = F.sum(cents)
    return (total.over(over) if over is not None else total).cast("decimal(38,0)") * F.lit(0.01).cast("decimal(2,2)")
