"""Local business days of naive timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.params import BUSINESS_ZONE, STATEMENT_ZONE


def shift_zone(ts: Column | str, source: str, target: str) -> Column:
    """A naive timestamp read on ``source`` clocks, shown on ``target`` clocks."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def local_day(ts: Column | str, source: str = STATEMENT_ZONE, target: str = BUSINESS_ZONE) -> Column:
    return F.to_date(shift_zone(ts, source, target))
