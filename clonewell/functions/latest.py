"""One sortable number for (time, smallest id), so that "the latest row" stays a plain hash aggregate.

``max(struct(time, -id))`` makes Spark sort its input, since a struct can't be changed in place in
an aggregation buffer; a decimal can.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Above the number of bigints; half of it shifts them above 0. The sum of both parts stays exact.
_BASE = Decimal(2 * 10**19)
_SHIFT = Decimal(10**19)
_NEVER = 10**17


def recency_key(time: Column, row_id: Column) -> Column:
    """decimal(38,0) that is smaller for a later time (null is earliest), then for a smaller id."""
    ago = F.coalesce(-F.unix_micros(time.cast("timestamp")), F.lit(_NEVER)).cast("decimal(18,0)")
    return (ago * F.lit(_BASE) + (row_id.cast("decimal(20,0)") + F.lit(_SHIFT))).cast("decimal(38,0)")


def id_of(key: Column) -> Column:
    """The row id that ``recency_key`` packed."""
    return (F.pmod(key, F.lit(_BASE).cast("decimal(38,0)")) - F.lit(_SHIFT)).cast("bigint")
