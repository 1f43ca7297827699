"""Place search: tokens of names against tokens of queries, spelling mistakes as a second pass.

Entries are indexed by what a query token may meet: the prefixes of their distinct tokens, the first letters and the
runs of five letters of their joined names, and for mistakes the forms with up to two letters out. Queries meet the
index by equi-joins, which give every entry that can score and few others; only those are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from switchyard.functions import names
from switchyard.functions.likeness import edit_distance, edits
from switchyard.storage import materialize

# Fixed values of the ranking.
EXACT, PREFIX_LAST, PREFIX, TYPO, CONTEXT = 3.0, 2.5, 2.0, 1.0, 1.0
FEW, FUZZY_COST, SHOWN = 5, 8.0, 8


def entries(places: DataFrame) -> DataFrame:
    """Search entries of ``places(id, name, alts, area, type, rank, lat, lon)``."""
    context = names.tokens(F.concat_ws(" ", F.coalesce("area", F.lit("")), F.coalesce("type", F.lit(""))))
    spelt = F.transform(F.coalesce("alts", F.array().cast("array<string>")), lambda a: names.tokens(a))
    toks = names.tokens(F.coalesce("name", F.lit("")))
    return places.select("id", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("rank", F.lit(0)).cast("double").alias("rank"), "lat", "lon", toks.alias("toks"), F.array_join(toks, "").alias("key"), spelt.alias("alt_toks"), context.alias("context"))


def _token_points(want: str, have: str, last: bool, fuzzy: bool) -> float:
    if have == want:
        return EXACT
    if have.startswith(want) and (last or len(want) >= 2 or any(c.isdigit() for c in want)):
        return PREFIX_LAST if last else PREFIX
    if fuzzy and min(len(want), len(have)) >= 4:
        most = 2 if len(want) >= 7 else 1
        if edits(want, have[: len(want)] if last else have, most) <= most:
            return TYPO
    return 0.0


def match(query: list[str], name: list[str], context: list[str], fuzzy: bool) -> tuple[float, bool, float] | None:
    """(points, whether the first word was met by the first, covered share of the name); None if a token has no place."""
    free, points, first = dict(enumerate(name)), 0.0, False
    for i, want in enumerate(query):
        last = i + 1 == len(query)
        worth = max(((_token_points(want, have, last, fuzzy), -j) for j, have in free.items()), default=(0.0, 0))
        if worth[0] > 0:
            points += worth[0]
            del free[-worth[1]]
            first |= i == 0 and worth[1] == 0
        elif any(c == want or (len(want) >= 3 and c.startswith(want)) for c in context):
            points += CONTEXT
        else:
            return None
    covered = len(name) - len(free)
    return (points, first, covered / len(name)) if covered else None


def _spelling_score(query: list[str], joined: str, name: list[str], context: list[str], fuzzy: bool) -> float | None:
    got, key = match(query, name, context, fuzzy), "".join(name)
    if got is None and len(joined) >= 4 and key.startswith(joined):
        got = (PREFIX_LAST * len(query), True, len(joined) / len(key))
    elif got is None and len(joined) >= 5 and joined in key[1:]:
        got = (1.5 * len(query), False, len(joined) / len(key))
    return None if got is None else 10 * got[0] + 12 * got[1] + 15 * got[2]


def score(query: list[str], toks: list[str], alt_toks: list[list[str]], context: list[str], rank: float, name: str, fuzzy: bool) -> float | None:
    joined = "".join(query)
    scores = [_spelling_score(query, joined, toks, context, fuzzy)]
    scores += [None if s is None else s - 4 for s in (_spelling_score(query, joined, alt, context, fuzzy) for alt in alt_toks)]
    best = max((s for s in scores if s is not None), default=None)
    return None if best is None else best + 4 * rank - 0.15 * min(len(name), 60)


def _spellings(found_in: DataFrame) -> DataFrame:
    """id, spelling, toks, joined, context: an entry's name and its other names."""
    every = F.concat(F.array("toks"), "alt_toks")
    rows = found_in.select("id", "context", F.posexplode(every).alias("spelling", "toks"))
    return rows.withColumn("joined", F.array_join("toks", ""))


def _deletions(word, most: int):
    """``word`` and what is left of it without up to ``most`` letters, as struct(form, out)."""
    less = lambda w: F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))).otherwise(F.array().cast("array<string>"))
    forms = F.array(word)
    out = F.transform(forms, lambda f: F.struct(f.alias("form"), F.lit(0).alias("out")))
    for n in range(1, most + 1):
        forms = F.array_distinct(F.flatten(F.transform(forms, less)))
        out = F.concat(out, F.transform(forms, _form_of(n)))
    return out


def _form_of(n: int):
    return lambda f: F.struct(f.alias("form"), F.lit(n).alias("out"))


def _typos(wanted: DataFrame, tokens: DataFrame) -> DataFrame:
    """want, last, token of ``wanted(want, last)`` and ``tokens(token)`` within one edit, two from seven letters on; of
    a query's last token against the token's beginning of its length."""
    wanted = wanted.where(F.length("want") >= 4).withColumn("most", F.when(F.length("want") >= 7, 2).otherwise(1))
    long = tokens.where(F.length("token") >= 4)
    begun = long.withColumn("n", F.explode(F.sequence(F.lit(4), F.length("token")))).select("token", F.substring("token", F.lit(1), F.col("n")).alias("form"))
    forms = begun.withColumn("whole", F.col("form") == F.col("token"))
    left = wanted.select("want", "last", "most", F.explode(_deletions(F.col("want"), 2)).alias("w")).where("w.out <= most").select("want", "last", "most", F.col("w.form").alias("_form"))
    right = forms.select("token", "form", "whole", F.explode(_deletions(F.col("form"), 2)).alias("f")).select("token", "form", "whole", F.col("f.form").alias("_form"), F.col("f.out").alias("out"))
    # a last token meets the beginning of its own length, or the whole of a shorter token
    fits = F.when(F.col("last"), (F.length("form") == F.length("want")) | (F.col("whole") & (F.length("token") < F.length("want")))).otherwise(F.col("whole"))
    pairs = left.join(right, "_form").where((F.col("out") <= F.col("most")) & fits).select("want", "last", "most", "token", "form").distinct()
    return pairs.where(edit_distance(F.col("want"), F.col("form"), 2) <= F.col("most")).select("want", "last", "token").distinct()


def candidates(found_in: DataFrame, asked: DataFrame, fuzzy: bool) -> DataFrame:
    """query_id, id of every entry that can score for ``asked(query_id, query)``, the queries' tokens."""
    spelt = materialize(_spellings(found_in), "search-spellings")
    posted = spelt.select("id", "spelling", F.explode("toks").alias("token"), F.lit(True).alias("named"))
    posted = posted.unionByName(spelt.select("id", "spelling", F.explode("context").alias("token"), F.lit(False).alias("named"))).distinct()
    tokens = materialize(posted.select("token").distinct(), "search-tokens")
    n = F.size("query")
    words = asked.select("query_id", n.alias("n"), F.posexplode("query").alias("place", "want")).withColumn("last", F.col("place") + 1 == F.col("n"))
    wanted = words.select("want", "last").distinct()
    begun = tokens.where("token <> ''").withColumn("k", F.explode(F.sequence(F.lit(1), F.length("token")))).select("token", F.substring("token", F.lit(1), F.col("k")).alias("want"))
    met = wanted.join(begun, "want").select("want", "last", "token")
    if fuzzy:
        met = met.unionByName(_typos(wanted, tokens)).distinct()
    met = materialize(met, "search-met")
    # each word of the query has to meet the name or its context, and one the name; how well is for the score to say
    hits = words.join(met, ["want", "last"]).join(posted, "token").groupBy("query_id", "n", "id", "spelling").agg(F.count_distinct("place").alias("places"), F.max("named").alias("named"))
    out = hits.where("places = n AND named").select("query_id", "id")
    joined = asked.select("query_id", F.array_join("query", "").alias("want")).where(F.length("want") >= 4)
    opened = joined.withColumn("_at", F.substring("want", 1, 4)).join(spelt.select("id", "joined", F.substring("joined", 1, 4).alias("_at")), "_at").where(F.startswith("joined", "want"))
    five = F.transform(F.sequence(F.lit(2), F.length("joined") - 4), lambda i: F.substring(F.col("joined"), i, F.lit(5)))
    runs = spelt.where(F.length("joined") >= 6).select("id", "joined", F.explode(F.array_distinct(five)).alias("_at"))
    inside = joined.where(F.length("want") >= 5).withColumn("_at", F.substring("want", 1, 5)).join(runs, "_at").where(F.contains(F.substring(F.col("joined"), F.lit(2), F.length("joined")), F.col("want")))
    return out.unionByName(opened.select("query_id", "id")).unionByName(inside.select("query_id", "id")).distinct()


def _scored(found_in: DataFrame, asked: DataFrame, pairs: DataFrame, fuzzy: bool) -> DataFrame:
    rows = pairs.join(asked, "query_id").join(found_in, "id").select("query_id", "query", "id", "key", "copies", "toks", "alt_toks", "context", "rank", "name")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [score(list(r.query), list(r.toks), [list(a) for a in r.alt_toks], list(r.context), r.rank, r.name, fuzzy) for r in batch.itertuples(index=False)]
            out = batch[["query_id", "id", "key", "copies"]].assign(score=pd.Series(found, index=batch.index, dtype="float64"))
            out = out[out["score"].notna()]
            yield out.assign(score=out["score"] - FUZZY_COST) if fuzzy else out

    return rows.mapInPandas(run, "query_id long, id long, key string, copies long, score double")


def _contents(found_in: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(contents, shown): entries that differ in id and place alone are one content, with ``copies`` and ``id`` its number;
    ``shown(content, cell_lat, cell_lon, id)`` holds of each content and cell the least id, the only one that can be shown."""
    kept = ["name", "rank", "toks", "key", "alt_toks", "context"]
    cell = [F.floor(F.col(c) * 50 + 0.5).alias(f"cell_{c}") for c in ("lat", "lon")]
    cells = found_in.groupBy(*kept, *cell).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    # the least id of a content is its number, so equal runs number alike
    cells = materialize(cells.withColumn("content", F.min("id").over(Window.partitionBy(*kept))), "search-cells")
    contents = cells.groupBy("content").agg(*[F.min(c).alias(c) for c in kept], F.sum("copies").alias("copies")).withColumnRenamed("content", "id")
    return materialize(contents, "search-contents"), cells.select("content", "cell_lat", "cell_lon", "id")


def search_all(found_in: DataFrame, texts: DataFrame) -> DataFrame:
    """query_id, rank, id, score: up to 8 for each of ``texts(query_id, text)``, one per key and cell of 0.02 degrees.

    Queries with under five strict hits get a pass that forgives spelling mistakes. Queries of under two characters or
    no token find nothing. Entries of like content are found and scored once.
    """
    contents, cells = _contents(found_in)
    asked = texts.select(F.col("query_id").cast("long").alias("query_id"), F.trim("text").alias("text")).where(F.length("text") >= 2)
    asked = materialize(asked.select("query_id", names.tokens(F.col("text")).alias("query")).where(F.size("query") > 0), "search-asked")
    strict = materialize(_scored(contents, asked, candidates(contents, asked, False), False), "search-strict")
    enough = strict.groupBy("query_id").agg(F.sum("copies").alias("n")).where(F.col("n") >= FEW)
    again = materialize(asked.where(F.length(F.array_join("query", "")) >= 4).join(enough, "query_id", "left_anti"), "search-again")
    hits = strict
    if again.take(1):
        pairs = candidates(contents, again, True).join(strict.select("query_id", "id"), ["query_id", "id"], "left_anti")
        hits = strict.unionByName(_scored(contents, again, pairs, True))
    met = hits.withColumnRenamed("id", "content").join(cells, "content")
    best = met.groupBy("query_id", "key", "cell_lat", "cell_lon").agg(F.min(F.struct((-F.col("score")).alias("s"), "id")).alias("b"))
    shown = best.select("query_id", F.col("b.id").alias("id"), (-F.col("b.s")).alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return shown.withColumn("rank", place).where(F.col("rank") <= SHOWN).select("query_id", "rank", "id", "score")


def search(spark: SparkSession, found_in: DataFrame, texts: list[str]) -> DataFrame:
    """:func:`search_all` for a list of texts; query_id is the place in it."""
    return search_all(found_in, spark.createDataFrame(list(enumerate(texts)), "query_id long, text string"))
