"""Greedy, order-dependent grouping of places by key and distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from switchyard.functions.geo import EARTH_M


def _metres(lat: float, lon: float, lats: np.ndarray, lons: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lats)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lons - lon) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.minimum(1.0, np.sqrt(h)))


class _Centres:
    """Clusters of one key: centre and size, in growing arrays."""

    def __init__(self) -> None:
        self.count, self.at, self.size = 0, np.empty((16, 2)), np.zeros(16, np.int64)

    def place(self, lat: float, lon: float, metres: float, moving: bool) -> int:
        near = np.flatnonzero(_metres(lat, lon, self.at[: self.count, 0], self.at[: self.count, 1]) <= metres)
        if len(near):
            c = int(near[0])
            self.size[c] += 1
            if moving:
                self.at[c] += (np.array([lat, lon]) - self.at[c]) / self.size[c]
            return c
        if self.count == len(self.size):
            self.at, self.size = np.concatenate([self.at, np.empty_like(self.at)]), np.concatenate([self.size, np.zeros_like(self.size)])
        self.at[self.count], self.size[self.count] = (lat, lon), 1
        self.count += 1
        return self.count - 1


def first_fit(df: DataFrame, key: str, order: list[str], metres: float, *, moving: bool = True) -> DataFrame:
    """``cluster`` (from 0 in a key) and ``opened`` (first of its cluster) of every row with a position.

    Rows are taken by ``order`` (a total order); each joins the first cluster whose centre is within ``metres``. The
    centre is the members' mean, or with ``moving=False`` the first member. Rows without position get null and false.

    A key is walked as a sorted stream: memory holds its cluster centres, not its rows. The walk is sequential by
    definition, so a key is one task's work.
    """
    out = T.StructType([*df.schema.fields, T.StructField("cluster", T.LongType()), T.StructField("opened", T.BooleanType())])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, centres = object(), _Centres()
        for rows in batches:
            found, opened = [], []
            for k, lat, lon in zip(rows[key], rows["lat"], rows["lon"]):
                k = None if pd.isna(k) else k
                if k != current:
                    current, centres = k, _Centres()
                if pd.isna(lat) or pd.isna(lon):
                    found.append(None)
                    opened.append(False)
                    continue
                known = centres.count
                found.append(centres.place(lat, lon, metres, moving))
                opened.append(centres.count > known)
            yield rows.assign(cluster=pd.Series(found, index=rows.index, dtype="Int64"), opened=pd.Series(opened, index=rows.index, dtype=bool))

    return df.repartition(key).sortWithinPartitions(key, *order).mapInPandas(walk, out)


def drop_near_copies(df: DataFrame, key: str, order: list[str], metres: float) -> DataFrame:
    """Rows without an earlier kept row of their key within ``metres``; rows without position stay."""
    walked = first_fit(df, key, order, metres, moving=False)
    return walked.where("opened OR cluster IS NULL").drop("cluster", "opened")
