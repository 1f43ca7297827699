import pytest
from pyspark.sql import functions as F

from switchyard.functions import clock, geo, names


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, seconds", [("06:00", 21600), ("25:10:05", 90605), ("x", None), (None, None)])
def test_clock_to_seconds(spark, text, seconds):
    assert one(spark, clock.clock_to_seconds(F.lit(text).cast("string"))) == seconds


@pytest.mark.parametrize("seconds, text", [(21600, "06:00:00"), (90605, "25:10:05"), (0, "00:00:00"), (360000, "100:00:00")])
def test_seconds_to_clock(spark, seconds, text):
    assert one(spark, clock.seconds_to_clock(F.lit(seconds))) == text


@pytest.mark.parametrize("mask, good", [("1111100", True), ("0000000", False), ("111110", False), ("1111102", False)])
def test_mask_valid(spark, mask, good):
    assert one(spark, clock.mask_valid(F.lit(mask))) is good


def test_haversine_is_symmetric_and_zero_at_a_point(spark):
    p = [F.lit(x) for x in (22.5, 88.3, 22.6, 88.4)]
    there, back = one(spark, geo.haversine_m(*p)), one(spark, geo.haversine_m(p[2], p[3], p[0], p[1]))
    assert there == pytest.approx(back) == pytest.approx(15_150, rel=0.01)
    assert one(spark, geo.haversine_m(p[0], p[1], p[0], p[1])) == 0


def test_transfer_seconds(spark):
    assert one(spark, geo.transfer_seconds(F.lit(61.0))) == 240


@pytest.mark.parametrize("name", ["Park Circus", "Sovabazar", "Shyam Bazaar Rd", "Bagbazar (Ghat)"])
def test_keys_are_idempotent(spark, name):
    once = one(spark, names.norm_key(F.lit(name)))
    assert one(spark, names.norm_key(F.lit(once))) == once


def test_spellings_share_keys(spark):
    assert one(spark, names.skeleton_key(F.lit("Chowrasta"))) == one(spark, names.skeleton_key(F.lit("Chourasta")))
    assert one(spark, names.token_key(F.lit("ii"))) == "2"
    assert one(spark, names.first_word(F.lit("Park Circus - Seven Point"))) == "park"
    assert one(spark, names.first_word(F.lit("Metro Station"))) is None


def test_fold_spreads_what_stands_for_several_letters(spark):
    from switchyard.functions import names

    texts = ["№ 5 Gate", "½ mile", "ﬁne…", "Brand™", "é–ñ漢", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(names.fold(F.col("t"))).collect()]
    assert got == ["No 5 Gate", "12 mile", "fine...", "BrandTM", "e-n", "", None]


def test_edits_of_many_pairs_at_once_are_those_of_each():
    from itertools import product

    from switchyard.functions.likeness import all_edits, edits

    words = ["".join(w) for n in range(5) for w in product("ab", repeat=n)] + ["Garia", "Gaira", "Graia", "Howrah", "Hawra", "é–漢x", "漢–éx", "😀a", "a😀"]
    a, b = zip(*product(words, words))
    for most in (0, 1, 2, 3):
        assert all_edits(list(a), list(b), most).tolist() == [edits(p, q, most) for p, q in zip(a, b)]
    assert all_edits([], [], 2).tolist() == []
