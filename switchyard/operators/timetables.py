"""Printed timetables: words with boxes to a grid of times, and what the grid says of each direction.

``words(doc, page, place, text, x0, x1, top)``: ``place`` counts a page's words in reading order. Nothing here reads
PDF files; any layout tool that gives words and boxes will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.operators.rail import window_gaps

# What a time looks like, height of a row, and minutes of the day that count as peak and as the rest.
TIME, ROW_HEIGHT = r"^\d{1,2}[:.]\d{2}$", 3
PEAK, OFF_PEAK, WIDEST_GAP = [(480, 660), (1020, 1200)], [(660, 960)], 90


def headers(words: DataFrame, code: str) -> DataFrame:
    """doc, page, column, code, x of the headers that hold for each page: its own if it has two or more, else those of the last page that has.

    ``code`` is the pattern of a header. Columns count from 0 by their left edges. Pages ahead of the first header have none.
    """
    own = words.where(F.col("text").rlike(code)).withColumn("_n", F.count("*").over(Window.partitionBy("doc", "page"))).where("_n > 1")
    columns = own.select("doc", F.col("page").alias("own"), (F.row_number().over(Window.partitionBy("doc", "page").orderBy("x0", "place")) - 1).alias("column"), F.col("text").alias("code"), ((F.col("x0") + F.col("x1")) / 2).alias("x"))
    pages = words.select("doc", "page").distinct().join(columns.select("doc", F.col("own").alias("page"), "own").distinct(), ["doc", "page"], "left")
    held = pages.withColumn("own", F.last("own", ignorenulls=True).over(Window.partitionBy("doc").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)))
    return held.where("own IS NOT NULL").join(columns, ["doc", "own"]).select("doc", "page", "column", "code", "x")


def nearest_columns(tokens: DataFrame, columns: DataFrame) -> DataFrame:
    """``tokens(doc, page, x, ...)`` with the ``column`` and ``code`` nearest by x on their page, the lower column of equally near ones.

    As-of in both directions: tokens and columns lie in one order by x, and each token looks at the last column before
    it and the first after it. No token meets more than two columns.
    """
    keys = ["doc", "page"]
    columns = columns.groupBy(*keys, "x").agg(F.min(F.struct("column", "code")).alias("_c")).withColumn("_is", F.lit(True))
    both = tokens.withColumns({"_c": F.lit(None).cast(columns.schema["_c"].dataType), "_is": F.lit(False)}).unionByName(columns, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("x", F.desc("_is"))
    at = F.when(F.col("_is"), F.struct(F.col("x").alias("x"), F.col("_c.column").alias("column"), F.col("_c.code").alias("code")))
    near = both.withColumn("_at", at).withColumns({
        "_left": F.last("_at", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_right": F.first("_at", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    })
    far = lambda side: F.when(F.col(side).isNotNull(), F.struct(F.abs(F.col(f"{side}.x") - F.col("x")).alias("far"), F.col(f"{side}.column").alias("column"), F.col(f"{side}.code").alias("code")))
    chosen = near.where("NOT _is").withColumn("_best", F.array_min(F.array_compact(F.array(far("_left"), far("_right")))))
    return chosen.where("_best IS NOT NULL").select(*tokens.columns, F.col("_best.column").alias("column"), F.col("_best.code").alias("code"))


def grid(words: DataFrame, code: str) -> DataFrame:
    """doc, page, row, column, code, minute: every time in the row and column it stands in.

    Rows are bands of three units of height, rounded half to even. Of two times in one cell the later word holds.
    """
    parts = F.split("text", "[:.]")
    minute = F.get(parts, 0).cast("int") * 60 + F.get(parts, 1).cast("int")
    times = words.where(F.col("text").rlike(TIME)).select("doc", "page", "place", ((F.col("x0") + F.col("x1")) / 2).alias("x"), F.bround(F.col("top") / ROW_HEIGHT).cast("long").alias("row"), minute.alias("minute"))
    placed = nearest_columns(times, headers(words, code))
    return placed.groupBy("doc", "page", "row", "column", "code").agg(F.max_by("minute", "place").alias("minute"))


def halves(words: DataFrame, code: str) -> DataFrame:
    """doc, column, code, direction, is_first, is_last: the columns of a document's last header, halved into two directions."""
    last = headers(words, code).withColumn("_last", F.max("page").over(Window.partitionBy("doc"))).where("page = _last")
    n = F.floor(F.count("*").over(Window.partitionBy("doc")) / 2)
    cut = last.select("doc", "column", "code", (F.col("column") >= n).cast("int").alias("direction"))
    w = Window.partitionBy("doc", "direction")
    return cut.select("*", (F.col("column") == F.min("column").over(w)).alias("is_first"), (F.col("column") == F.max("column").over(w)).alias("is_last"))


def column_figures(cells: DataFrame, sides: DataFrame) -> DataFrame:
    """doc, direction, column, code, n, first, last, offset: count, ends and the median offset of full trips from the direction's first column.

    A full trip has a time in the first and the last column of its direction.
    """
    met = cells.drop("code").join(sides, ["doc", "column"])
    trip = ["doc", "page", "row", "direction"]
    ends = met.groupBy(*trip).agg(F.max(F.when(F.col("is_first"), F.col("minute"))).alias("_from"), F.max(F.when(F.col("is_last"), F.col("minute"))).alias("_to")).where("_from IS NOT NULL AND _to IS NOT NULL")
    timed = met.join(ends, trip, "left").groupBy("doc", "column").agg(F.count("*").alias("n"), F.min("minute").alias("first"), F.max("minute").alias("last"), F.median(F.col("minute") - F.col("_from")).alias("offset"))
    every = sides.join(timed, ["doc", "column"], "left")
    return every.select("doc", "direction", "column", "code", F.coalesce("n", F.lit(0)).alias("n"), "first", "last", "offset", "is_last")


def direction_figures(cells: DataFrame, sides: DataFrame) -> DataFrame:
    """doc, direction, measured_at, trips, peak, off_peak, end_to_end: medians at the column with most times, the first of equals."""
    figures = column_figures(cells, sides)
    best = figures.groupBy("doc", "direction").agg(F.min(F.struct((-F.col("n")).alias("least"), "column", "code")).alias("b"), F.max(F.when(F.col("is_last"), F.col("offset"))).alias("end_to_end"))
    best = best.select("doc", "direction", F.col("b.column").alias("column"), F.col("b.code").alias("measured_at"), (-F.col("b.least")).alias("trips"), "end_to_end")
    times = cells.select("doc", "column", "minute").join(best.select("doc", "direction", "column"), ["doc", "column"])
    for name, windows in (("peak", PEAK), ("off_peak", OFF_PEAK)):
        inside = F.lit(False)
        for begin, end in windows:
            inside = inside | ((F.col("minute") >= begin) & (F.col("minute") < end))
        gaps = window_gaps(times.where(inside), ["doc", "direction"], "minute", windows, 0, WIDEST_GAP).withColumnRenamed("headway", name)
        best = best.join(gaps, ["doc", "direction"], "left")
    return best.select("doc", "direction", "measured_at", "trips", "peak", "off_peak", "end_to_end")


def anchored(calls: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Positions of time points on their stop sequences: keys, place, stop, minute, seq (null: there is none).

    ``calls(keys, seq, stop)``, ``anchors(keys, place, stop, minute)``, taken in order of ``place``. Each anchor goes to
    the first call at its stop after the call of the anchor before, so on a loop that passes a stop twice the order
    decides; this finds a place for all anchors if there is any. An anchor without a place leaves the next ones theirs.
    """
    wanted = anchors.select(*keys, F.col("stop")).distinct()
    at = calls.join(wanted, [*keys, "stop"]).groupBy(*keys, "stop").agg(F.array_sort(F.collect_list("seq")).alias("_seqs"))
    listed = anchors.join(at, [*keys, "stop"], "left").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("place", "stop", "minute", "_seqs"))).alias("_a"))
    seq, fields = calls.schema["seq"].dataType.simpleString(), ("place", "stop", "minute")
    kinds = ",".join(f"{f}:{anchors.schema[f].dataType.simpleString()}" for f in fields) + f",seq:{seq}"
    start = F.struct(F.lit(None).cast(seq).alias("last"), F.array().cast(f"array<struct<{kinds}>>").alias("out"))

    def step(state, a):
        here = F.array_min(F.filter(F.coalesce(a["_seqs"], F.array().cast(f"array<{seq}>")), lambda s: state["last"].isNull() | (s > state["last"])))
        row = F.struct(*[a[f].alias(f) for f in fields], here.alias("seq"))
        return F.struct(F.coalesce(here, state["last"]).alias("last"), F.concat(state["out"], F.array(row)).alias("out"))

    return listed.select(*keys, F.inline(F.aggregate("_a", start, step, lambda s: s["out"])))


def with_anchors(calls: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """``calls`` with the ``minute`` of the anchors that stand on them. Raises if an anchor finds no place, naming some."""
    placed = anchored(calls, anchors, keys)
    lost = placed.where("seq IS NULL").limit(5).collect()
    if lost:
        raise ValueError(f"time points without a stop: {[tuple(r[c] for c in [*keys, 'place', 'stop']) for r in lost]}")
    return calls.join(placed.select(*keys, "seq", "minute"), [*keys, "seq"], "left")
