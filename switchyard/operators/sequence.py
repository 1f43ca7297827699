"""Operators on ordered stop lists. ``keys`` name a sequence, ``order`` its unique order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from switchyard.functions.geo import haversine_m


def along(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def so_far(keys: list[str], order: list[str]) -> WindowSpec:
    return along(keys, order).rowsBetween(Window.unboundedPreceding, 0)


def hops(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``hop_m``: metres from the sequence's previous row (``lat``, ``lon``); null at the first."""
    w = along(keys, order)
    return df.withColumn("hop_m", haversine_m(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")))


def drop_repeats(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose ``value`` differs from the row before, numbered anew from 1 as ``seq``."""
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(along(keys, order))) | (F.row_number().over(along(keys, order)) == 1)
    return df.withColumn("_changed", changed).where("_changed").drop("_changed").withColumn("seq", F.row_number().over(along(keys, order)))


def spikes_and_long_hops(df: DataFrame, keys: list[str], order: list[str], spike_m: float = 5000, long_m: float = 20_000) -> DataFrame:
    """``is_spike``: both legs over ``spike_m`` and their sum over three times the direct way; ``is_long``: hop over ``long_m``."""
    w = along(keys, order)
    before, after = haversine_m(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")), haversine_m(F.col("lat"), F.col("lon"), F.lead("lat").over(w), F.lead("lon").over(w))
    direct = haversine_m(F.lag("lat").over(w), F.lag("lon").over(w), F.lead("lat").over(w), F.lead("lon").over(w))
    legs = df.withColumns({"_before": before, "_after": after, "_direct": direct})
    spike = (F.col("_before") > spike_m) & (F.col("_after") > spike_m) & (F.col("_before") + F.col("_after") > 3 * F.col("_direct"))
    return legs.withColumns({"is_spike": F.coalesce(spike, F.lit(False)), "is_long": F.coalesce(F.col("_before") > long_m, F.lit(False))}).drop("_before", "_after", "_direct")


def interpolate_anchors(df: DataFrame, keys: list[str], order: list[str], estimate: str, anchor: str) -> DataFrame:
    """``time``: anchors where they stand, linear in ``estimate`` between them, ahead and back at the ends.

    All anchors of a sequence go if any of them decreases. Times start at 0 and never fall.
    """
    w = along(keys, order)
    whole = Window.partitionBy(*keys)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    falls = df.withColumn("_last", F.last(anchor, ignorenulls=True).over(before))
    good = falls.withColumn("_bad", F.max(F.coalesce(F.col(anchor) < F.col("_last"), F.lit(False))).over(whole))
    use = F.when(~F.col("_bad"), F.col(anchor))
    at = F.when(use.isNotNull(), F.struct(use.alias("t"), F.col(estimate).alias("e")))
    ends = good.withColumn("_at", at).withColumns({"_left": F.last("_at", ignorenulls=True).over(so_far(keys, order)), "_right": F.first("_at", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    left, right, e = F.col("_left"), F.col("_right"), F.col(estimate)
    span = right["e"] - left["e"]
    inside = left["t"] + F.when(span != 0, (right["t"] - left["t"]) * (e - left["e"]) / F.nullif(span, F.lit(0.0))).otherwise(0.0)
    raw = F.when(left.isNull() & right.isNull(), e).when(left.isNull(), right["t"] - (right["e"] - e)).when(right.isNull(), left["t"] + e - left["e"]).otherwise(inside)
    based = ends.withColumn("_raw", raw).withColumn("_raw", F.col("_raw") - F.first("_raw").over(w))
    return based.withColumn("time", F.max("_raw").over(so_far(keys, order))).drop("_last", "_bad", "_at", "_left", "_right", "_raw")


def unwrap_midnight(df: DataFrame, keys: list[str], order: list[str], minute: str, slack: int = 1) -> DataFrame:
    """``unwrapped``: a day of minutes more after each fall of over ``slack`` minutes."""
    w = along(keys, order)
    falls = F.coalesce((F.col(minute) < F.lag(minute).over(w) - slack).cast("int"), F.lit(0))
    return df.withColumn("_falls", falls).withColumn("unwrapped", F.col(minute) + 1440 * F.sum("_falls").over(so_far(keys, order))).drop("_falls")


def repair_times(times: Column) -> Column:
    """Fold over ordered struct(arrival, departure): arrivals a day on until not before the last departure,
    departures a day on if over twelve hours early, and not before arrival."""
    day, half = 86_400, 43_200
    start = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<struct<arrival:long,departure:long>>").alias("out"))

    def step(state: Column, row: Column) -> Column:
        late = F.coalesce(state["last"] - row["arrival"], F.lit(0))
        arrival = row["arrival"] + F.when(late > 0, F.ceil(late / day) * day).otherwise(0)
        gap = arrival - row["departure"]
        departure = F.greatest(row["departure"] + F.when(gap > half, day).otherwise(0), arrival)
        return F.struct(departure.cast("long").alias("last"), F.concat(state["out"], F.array(F.struct(arrival.cast("long").alias("arrival"), departure.cast("long").alias("departure")))).alias("out"))

    return F.aggregate(times, start, step, lambda s: s["out"])


def mirrored(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Both directions of each sequence: as it is (0) and reversed (1)."""
    back = df.withColumn(seq, F.max(seq).over(Window.partitionBy(*keys)) + 1 - F.col(seq)).withColumn("direction", F.lit(1))
    return df.withColumn("direction", F.lit(0)).unionByName(back)


def lagged(df: DataFrame, keys: list[str], order: str, values: list[str], width: int) -> DataFrame:
    """``df`` with ``was_<value>`` of the row before in ``order`` (a whole number, unique within ``keys``).

    For few keys with very many rows: rows are dealt to pieces of ``width`` in ``order``, each a task's window of its
    own, and a piece's first row takes the last row of the piece before it that has any. Only the pieces' last rows, one
    each, come together by key.
    """
    piece = F.floor(F.col(order) / width).alias("_piece")
    rows = df.withColumn("_piece", piece).withColumn("_row", F.struct(*values))
    inside = rows.withColumn("_was", F.lag("_row").over(Window.partitionBy(*keys, "_piece").orderBy(order)))
    last = rows.groupBy(*keys, "_piece").agg(F.max_by("_row", order).alias("_last"))
    carry = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_piece")).alias("_carry")
    before = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_piece").alias("_p"), carry)
    same = F.col("_piece") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    met = inside.join(before, same, "left").withColumn("_was", F.coalesce("_was", "_carry"))
    return met.select(*df.columns, *[F.col("_was")[v].alias(f"was_{v}") for v in values])


def carried_forward(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The latest non-null ``value`` at or before each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(so_far(keys, order)))
