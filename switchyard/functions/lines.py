"""Lines of positions: text encoding in steps of 1e-5 degrees, and simplification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTS = T.ArrayType(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]))
# Metres of one degree, as the line format's users take them.
M_LON, M_LAT = 111_320.0, 110_540.0


def _step_text(step: Column) -> Column:
    """One signed step: the sign in the lowest bit, then five bits a character from the low end."""
    z = F.when(step < 0, -2 * step - 1).otherwise(2 * step)
    digits = F.length(F.conv(z.cast("string"), 10, 32))  # base 32, so as many digits as characters

    def letter(i: Column) -> Column:
        low = F.floor(z / F.pow(F.lit(32.0), i)).cast("long") % 32
        return F.char(low + F.when(i < digits - 1, 95).otherwise(63))

    return F.array_join(F.transform(F.sequence(F.lit(0), digits - 1), letter), "")


def encode_polyline(points: Column) -> Column:
    """Text of an array of struct(lat, lon); empty for an empty array, null for null."""
    grid = F.transform(points, lambda p: F.struct(F.rint(p["lat"] * 1e5).cast("long").alias("y"), F.rint(p["lon"] * 1e5).cast("long").alias("x")))
    origin = F.array(F.struct(F.lit(0).cast("long").alias("y"), F.lit(0).cast("long").alias("x")))
    before = F.slice(F.concat(origin, grid), F.lit(1), F.size(grid))
    steps = F.zip_with(grid, before, lambda a, b: F.concat(_step_text(a["y"] - b["y"]), _step_text(a["x"] - b["x"])))
    return F.array_join(steps, "")


@F.pandas_udf(POINTS)
def decode_polyline(text: pd.Series) -> pd.Series:
    """Positions of an encoded line; a step that is cut off at the end is left out."""

    def one(line):
        if line is None:
            return None
        bits = np.frombuffer(line.encode("ascii"), np.uint8).astype(np.int64) - 63
        ends = np.flatnonzero(bits < 32)
        if not len(ends):
            return []
        starts = np.r_[0, ends[:-1] + 1]
        place = np.arange(ends[-1] + 1) - np.repeat(starts, ends - starts + 1)
        z = np.add.reduceat((bits[: ends[-1] + 1] & 31) << (5 * place), starts)
        steps = (z >> 1) ^ -(z & 1)
        yx = np.cumsum(steps[: len(steps) // 2 * 2].reshape(-1, 2), axis=0) / 1e5
        return [{"lat": float(y), "lon": float(x)} for y, x in yx]

    return text.map(one)


def _kept(lat: np.ndarray, lon: np.ndarray, tolerance: float) -> np.ndarray:
    """Mask of the points that stay: ends, and whatever lies further than ``tolerance`` metres off its chord."""
    z = lon * M_LON * np.cos(np.radians(lat[0])) + 1j * lat * M_LAT
    keep = np.zeros(len(z), bool)
    keep[[0, -1]] = True
    spans = [slice(0, len(z))]
    while spans:
        span = spans.pop()
        part = z[span]
        if len(part) < 3:
            continue
        chord, inner = part[-1] - part[0], part[1:-1] - part[0]
        along = np.clip((inner * np.conj(chord)).real / abs(chord) ** 2, 0, 1) if chord else np.zeros(len(inner))
        off = abs(inner - along * chord)
        far = int(off.argmax())
        if off[far] > tolerance:
            at = span.start + far + 1
            keep[at] = True
            spans += [slice(span.start, at + 1), slice(at, span.stop)]
    return keep


def simplify(points: Column, tolerance_m: float) -> Column:
    """Douglas-Peucker in a plane at the first point; fewer than three points stay as they are."""

    @F.pandas_udf(POINTS)
    def run(lines: pd.Series) -> pd.Series:
        def one(line):
            if line is None or len(line) < 3:
                return line
            mask = _kept(np.array([p["lat"] for p in line], float), np.array([p["lon"] for p in line], float), tolerance_m)
            return [p for p, stays in zip(line, mask) if stays]

        return lines.map(one)

    return run(points)
