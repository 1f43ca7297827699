"""Service-day clock: seconds since midnight that may pass 24 hours, and weekday masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_to_seconds(text: Column) -> Column:
    """``HH:MM`` or ``HH:MM:SS``, hours may be 24 or more; null if it isn't one."""
    parts = F.split(text, ":")
    seconds = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("0")).try_cast("int")
    return F.try_element_at(parts, F.lit(1)).try_cast("int") * 3600 + F.try_element_at(parts, F.lit(2)).try_cast("int") * 60 + seconds


def seconds_to_clock(seconds: Column) -> Column:
    """Rounded half to even, as ``HH:MM:SS``."""
    s = F.bround(seconds, 0).cast("long")
    return F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") if pad else x for x, pad in ((_hours(s), False), (F.floor(s / 60) % 60, True), (s % 60, True))])


def _hours(s: Column) -> Column:
    h = F.floor(s / 3600).cast("string")
    return F.when(F.length(h) < 2, F.lpad(h, 2, "0")).otherwise(h)


def mask_valid(mask: Column) -> Column:
    """Seven binary digits, Monday first, not all zero."""
    return mask.rlike("^[01]{7}$") & (mask != "0000000")


def mask_bits(mask: Column) -> Column:
    return F.conv(mask, 2, 10).cast("int")


def masks_overlap(a: Column, b: Column) -> Column:
    return mask_bits(a).bitwiseAND(mask_bits(b)) != 0
