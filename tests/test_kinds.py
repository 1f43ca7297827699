"""Rules of place types."""

import pytest

from switchyard.functions import kinds

ROW = "id long, tag string, name string, span long, len long, religion string"


def test_every_rule_has_a_place_that_it_takes(spark):
    """One row made for each rule, just past its figures; no rule is hidden by those before it."""
    rows = []
    for r in kinds.RULES:
        name = {"bridge": "Old SETU 2", "it_park": "x tech park"}.get(r.pattern, "y")
        figures = [None if f is None else f + 1 for f in (r.span, r.length)]
        rows.append((r.number, f"{r.keys[0]}={r.values[0] if r.values else 'anything'}", name, *figures, r.religions[0] if r.religions else None))
    got = {x.id: (x.rule, x.type, x.rank) for x in kinds.classified(spark.createDataFrame(rows, ROW)).collect()}
    assert got == {r.number: (r.number, r.type, r.rank) for r in kinds.RULES}
    assert all(x.places == 1 for x in kinds.rule_report(spark.createDataFrame(rows, ROW)).collect())


def test_hand_picked_places(spark):
    cases = [
        ("highway=primary", "Bridgeton Road", None, 2000, None, "Street", 6), ("highway=primary", "Howrah bridge", None, 1, None, "Bridge", 6),
        ("amenity=place_of_worship", "z", 100, None, "muslim", "Mosque", 4), ("amenity=place_of_worship", "z", 101, None, "shinto", "Place of worship", 6),
        ("leisure=stadium", "z", 80, None, None, "Landmark", 3), ("leisure=track", "z", 100, None, None, None, None), ("man_made=bridge", "z", 100, None, None, None, None),
        ("office=government", "IBM house", 61, None, None, "IT park", 6), ("office=government", "Ibmore", 61, None, None, "Government office", 4),
        ("place=county", "z", None, None, None, None, None), ("waterway=river", "z", None, None, None, None, None), ("shop", None, None, None, None, "Market", 4),
        (None, "z", 1, 1, "sikh", None, None), ("", None, None, None, None, None, None), ("shop=a=b", "z", None, None, None, "Market", 4),
    ]
    got = kinds.classified(spark.createDataFrame([(i, *c[:5]) for i, c in enumerate(cases)], ROW)).orderBy("id").collect()
    assert [(x.type, x.rank) for x in got] == [c[5:] for c in cases]
    assert kinds.classified(spark.createDataFrame([], ROW)).count() == 0


def test_tables_of_other_rules(spark):
    rules = kinds.parse("a x = One 1\na * span>5 = -\na * = Two words 2\n")
    rows = [(0, "a=x", "", 9, 0, None), (1, "a=y", "", 6, 0, None), (2, "a=y", "", 5, 0, None), (3, "b=x", "", 0, 0, None)]
    got = [(x.rule, x.type, x.rank) for x in kinds.classified(spark.createDataFrame(rows, ROW), rules).orderBy("id").collect()]
    assert got == [(1, "One", 1), (2, None, None), (3, "Two words", 2), (None, None, None)]
    assert {x.rule: x.places for x in kinds.rule_report(spark.createDataFrame(rows[:1], ROW), rules).collect()} == {1: 1, 2: 0, 3: 0}
    for wrong in ("a x spam>5 = One 1", "a x name~nothing = One 1"):
        with pytest.raises(ValueError, match="rule 1"):
            kinds.parse(wrong)


def test_gazetteer_codes(spark):
    df = spark.createDataFrame([("PPLA2",), ("XXX",), (None,)], "code string").select(kinds.gazetteer_type(df_code()).alias("t"))
    assert [x.t and tuple(x.t) for x in df.collect()] == [("Town", 8), None, None]


def df_code():
    from pyspark.sql import functions as F

    return F.col("code")
