"""Writers of feed files, bundles, network JSON and worklists."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_feed_table(df: DataFrame, path: str, order: list[str]) -> None:
    """Delimited text in one order: header, null as blank, LF line ends; replaces what was there.

    Rows are range-partitioned by ``order``, so a large table is written by many tasks; parts sort by name.
    """
    ordered = df.orderBy(*order) if order else df
    texts = ordered.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    texts.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').option("lineSep", "\n").csv(path)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())


class _Stream:
    """A file of shared storage that is written from front to back."""

    def __init__(self, spark: SparkSession, target: str):
        spot = spark._jvm.org.apache.hadoop.fs.Path(target)
        self.stream = spot.getFileSystem(spark._jsc.hadoopConfiguration()).create(spot, True)

    def write(self, data) -> int:
        self.stream.write(bytearray(data))
        return len(data)

    def flush(self) -> None:
        self.stream.flush()


def bundle(spark: SparkSession, tables: dict[str, str], notes: dict[str, str], target: str) -> None:
    """Zip of written feed tables (member name to folder) and of note texts, streamed line by line to ``target``."""
    out = _Stream(spark, target)
    with zipfile.ZipFile(io.BufferedWriter(_Raw(out), 1 << 20), "w", zipfile.ZIP_DEFLATED) as z:
        for member, folder in sorted(tables.items()):
            with z.open(member, "w", force_zip64=True) as file:
                for n, part in enumerate(_files(spark, folder)[1]):
                    for i, line in enumerate(spark.read.text(part.toString()).toLocalIterator()):
                        if i or not n:
                            file.write((line.value + "\n").encode())
        for member, text in notes.items():
            z.writestr(member, text)
        z.fp.flush()
    out.stream.close()


class _Raw(io.RawIOBase):
    def __init__(self, out: _Stream):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        return self.out.write(bytes(data))


def attribution(sources: list[tuple[str, str, str]], publisher: str) -> str:
    """Text of who made what: (name, licence, address) of each source, and who publishes."""
    lines = [f"- {name}: {licence} ({address})" for name, licence, address in sources]
    return "\n".join(["This feed holds data of", "", *lines, "", f"Published by {publisher}.", ""])


def write_by_mode(df: DataFrame, folder: str, name: str, order: list[str], mode: str = "mode") -> list[str]:
    """A feed table for each mode, at folder/mode/name; returns the modes."""
    modes = [r[0] for r in df.select(mode).where(F.col(mode).isNotNull()).distinct().orderBy(mode).collect()]  # a handful
    for m in modes:
        write_feed_table(df.where(F.col(mode) == m).drop(mode), f"{folder}/{m}/{name}", order)
    return modes


class BuildLog:
    """Lines of a build; details (indented) are kept but not shown."""

    def __init__(self, show=print):
        self.lines: list[str] = []
        self.show = show

    def say(self, line: str) -> None:
        self.lines.append(line)
        if not line.startswith(" "):
            self.show(line)

    def text(self) -> str:
        return "\n".join([*self.lines, ""])


def report(title: str, counts: DataFrame, by: str) -> str:
    """Markdown table of counters, one row a group, all of them; for aggregates of few groups."""
    names = [c for c in counts.columns if c != by]
    rows = ([str(r[by]), *("" if r[c] is None else str(r[c]) for c in names)] for r in counts.orderBy(by).toLocalIterator())
    table = ["| " + " | ".join(cells) + " |" for cells in ([by, *names], ["---"] * (1 + len(names)), *rows)]
    return "\n".join([f"# {title}", "", *table, ""])


def places_json(places: DataFrame, areas: DataFrame) -> DataFrame:
    """One line of JSON a place: name, position in five decimals, type, rank, area's id and up to five other names.

    ``places(id, name, lat, lon, type, rank, alts)``, ``areas(id, area)``.
    """
    met = places.join(areas, "id", "left")
    row = F.struct("id", "name", F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), "type", "rank", "area", F.when(F.size("alts") > 0, F.slice("alts", 1, 5)).alias("alts"))
    return met.select("id", F.to_json(row).alias("value"))


def network_json(patterns: DataFrame, keep: list[str]) -> DataFrame:
    """One line of JSON a row, without nulls or spaces; positions in five decimals."""
    short = [F.round(c, 5).alias(c) if c in ("lat", "lon") else F.col(c) for c in keep]
    return patterns.select(F.to_json(F.struct(*short)).alias("value"))


def worklist(used: DataFrame, located: DataFrame, name: str, route: str, most: int = 5) -> DataFrame:
    """Names without a position: number of routes, and the first few of them."""
    open_names = used.join(located.select(name).distinct(), name, "left_anti").select(name, route).distinct()
    return open_names.groupBy(name).agg(F.count(F.lit(1)).alias("n_routes"), F.slice(F.array_sort(F.collect_set(route)), 1, most).alias("routes"))
