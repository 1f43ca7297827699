"""Queries on the types of places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.functions import kinds
from switchyard.plans import roles
from switchyard.plans.registry import query

_TAGS = sorted({f"{k}={v}" for r in kinds.RULES for k in r.keys for v in (r.values or ("other",))} | {"waterway=river", "place=county", "amenity"})
_RELIGIONS = ["hindu", "muslim", "christian", "sikh", "other"]
_WORDS = ["setu", "Tech Park", "gate", "IBM"]


def _places(spark, d) -> DataFrame:
    """Customers as mapped places: their key chooses the tag, the religion and a word of the name, their balance the extent."""
    k, pick = F.col("c_custkey"), lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    # the quotient by the number of tags, so that every tag meets every religion, word and extent
    q = F.floor(k / len(_TAGS)).cast("long")
    name = F.concat("c_name", F.lit(" "), pick(_WORDS, q))
    return roles.table(spark, d, "customer").select(
        k.alias("place_id"), pick(_TAGS, k).alias("tag"), name.alias("name"), (q * 37 % 500).alias("span"), F.when(q % 4 != 0, q * 613 % 4000).alias("len"),
        F.when(q % 6 != 0, pick(_RELIGIONS, q)).alias("religion"))


def _text(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_text, values)) + "]" if values else "CAST(NULL AS VARCHAR[])"


_PLACES_SQL = f"""k AS (SELECT c_custkey AS place_id, c_name, c_custkey // {len(_TAGS)} AS q FROM customer),
p AS (SELECT place_id, {_list(_TAGS)}[place_id % {len(_TAGS)} + 1] AS tag, c_name || ' ' || {_list(_WORDS)}[q % {len(_WORDS)} + 1] AS name, q * 37 % 500 AS span, CASE WHEN q % 4 <> 0 THEN q * 613 % 4000 ELSE 0 END AS len,
 CASE WHEN q % 6 <> 0 THEN {_list(_RELIGIONS)}[q % {len(_RELIGIONS)} + 1] END AS religion FROM k),
rules(number, keys, vals, religions, span, len, pattern, type, rank) AS (VALUES {", ".join(
    f"({r.number}, {_list(r.keys)}, {_list(r.values)}, {_list(r.religions)}, {_text(r.span)}, {_text(r.length)}, {_text(r.pattern and kinds.NAME_PATTERNS[r.pattern].removeprefix('(?i)'))}, {_text(r.type)}, {_text(r.rank)})" for r in kinds.RULES)}),
met AS (SELECT p.place_id, min(r.number) AS number FROM p JOIN rules r ON list_contains(r.keys, split_part(p.tag, '=', 1)) AND (r.vals IS NULL OR list_contains(r.vals, split_part(p.tag, '=', 2)))
 AND (r.religions IS NULL OR list_contains(r.religions, p.religion)) AND (r.span IS NULL OR p.span > r.span) AND (r.len IS NULL OR p.len > r.len) AND (r.pattern IS NULL OR regexp_matches(p.name, r.pattern, 'i')) GROUP BY p.place_id)"""


@query(f"""WITH {_PLACES_SQL}
SELECT p.place_id, p.tag, r.number AS rule, r.type, r.rank FROM p LEFT JOIN met USING (place_id) LEFT JOIN rules r USING (number)""")
def q_place_kinds(spark, d):
    """Type and rank of every place by the first rule that holds."""
    return kinds.classified(_places(spark, d)).select("place_id", "tag", "rule", "type", "rank")


@query(f"""WITH {_PLACES_SQL}
SELECT r.number AS rule, r.type, r.rank, count(met.place_id) AS places FROM rules r LEFT JOIN met USING (number) GROUP BY ALL""")
def q_rule_report(spark, d):
    """How many places each rule of the type table took, unused rules included."""
    return kinds.rule_report(_places(spark, d))
