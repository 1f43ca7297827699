"""Type and rank of a place from its map tag, by an ordered table of rules compiled into one expression."""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys, values (* any), conditions, then the type and its rank; the first line that holds counts, and what
# no line holds for, or one with "-", is left out. ``span`` and ``len`` are metres; ``~`` asks the name for a pattern.
TAG_RULES = """
place city,town = Town 9
place suburb = Area 8
place quarter,neighbourhood = Area 7
place city_block = Block 6
place village = Village 5
place hamlet = Village 3
place locality = Area 4
place isolated_dwelling = Place 2
place square = Landmark 5
place island = Place 4
highway bus_stop = Bus stop 3
highway * name~bridge = Bridge 6
highway motorway,trunk,primary len>2000 = Street 7
highway motorway,trunk,primary = Street 6
highway secondary len>2000 = Street 6
highway secondary = Street 5
highway tertiary len>2000 = Street 5
highway tertiary = Street 4
highway * len>2000 = Street 4
highway * = Street 3
junction yes = Crossing 6
aeroway aerodrome = Airport 9
railway,public_transport station,halt = Station 5
railway,public_transport stop,platform,tram_stop,stop_position = Bus stop 2
amenity hospital = Hospital 7
healthcare hospital span>80 = Hospital 7
healthcare hospital = Hospital 6
amenity,healthcare clinic,centre,nursing_home,blood_bank,laboratory,sample_collection,doctor = Clinic 3
amenity,healthcare university = University 7
amenity,healthcare college = College 6
amenity,healthcare school,kindergarten span>60 = School 4
amenity,healthcare school,kindergarten = School 3
amenity,healthcare place_of_worship religion=hindu,jain,buddhist span>100 = Temple 6
amenity,healthcare place_of_worship religion=hindu,jain,buddhist = Temple 4
amenity,healthcare place_of_worship religion=muslim span>100 = Mosque 6
amenity,healthcare place_of_worship religion=muslim = Mosque 4
amenity,healthcare place_of_worship religion=christian span>100 = Church 6
amenity,healthcare place_of_worship religion=christian = Church 4
amenity,healthcare place_of_worship religion=sikh span>100 = Gurdwara 6
amenity,healthcare place_of_worship religion=sikh = Gurdwara 4
amenity,healthcare place_of_worship span>100 = Place of worship 6
amenity,healthcare place_of_worship = Place of worship 4
amenity,healthcare marketplace = Market 6
amenity,healthcare cinema = Cinema 5
amenity,healthcare theatre,arts_centre = Landmark 5
amenity,healthcare conference_centre,exhibition_centre,events_venue,community_centre,library span>100 = Landmark 5
amenity,healthcare conference_centre,exhibition_centre,events_venue,community_centre,library = Landmark 4
amenity,healthcare police = Police station 4
amenity,healthcare post_office = Post office 3
amenity,healthcare townhall,courthouse,public_building = Government office 5
amenity,healthcare bus_station = Bus terminus 5
amenity,healthcare ferry_terminal = Ghat 5
amenity,healthcare restaurant = Restaurant 2
amenity,healthcare bank = Office 2
amenity,healthcare grave_yard,crematorium = Cemetery 4
amenity,healthcare ticket_validator,bench,shelter = -
amenity,healthcare * = Landmark 3
shop mall,department_store = Mall 7
shop * = Market 4
tourism attraction,zoo,theme_park,viewpoint = Landmark 7
tourism museum,gallery = Museum 7
tourism hotel,hostel,guest_house,motel = Hotel 2
tourism apartment = Housing 3
tourism artwork,information,picnic_site,camp_site = -
tourism * = Landmark 3
leisure stadium span>80 = Stadium 7
leisure sports_centre span>80 = Stadium 5
leisure park,garden,nature_reserve,water_park,golf_course span>400 = Park 6
leisure park,garden,nature_reserve,water_park,golf_course span>100 = Park 4
leisure park,garden,nature_reserve,water_park,golf_course = Park 3
leisure playground,pitch,fitness_centre,swimming_pool,track,fitness_station span>100 = Park 2
leisure playground,pitch,fitness_centre,swimming_pool,track,fitness_station = -
leisure * = Landmark 3
historic city_gate,milestone,boundary_stone = -
historic * span>50 = Landmark 6
historic * = Landmark 4
office * name~it_park = IT park 6
office government span>60 = Government office 4
office government = Government office 3
office * span>60 = Office 4
office * = Office 3
landuse residential = Housing 4
landuse retail = Market 5
landuse commercial name~it_park = IT park 6
landuse commercial = Office 4
landuse religious = Temple 5
landuse cemetery = Cemetery 4
landuse recreation_ground,village_green = Park 4
landuse industrial,railway,military = Landmark 3
building apartments,residential,house,dormitory span>40 = Housing 3
building apartments,residential,house,dormitory = Housing 2
building hospital = Hospital 5
building school = School 3
building college,university = College 5
building mosque = Mosque 4
building church,chapel = Church 4
building temple,religious,shrine = Temple 4
building commercial,office,retail name~it_park = IT park 6
building commercial,office,retail = Office 3
building train_station,transportation = -
building * span>40 = Building 3
building * = Building 2
man_made bridge span>100 = Bridge 5
bridge * = Bridge 5
natural water = Lake 4
"""
NAME_PATTERNS = {
    "bridge": r"(?i)\b(setu|bridge)\b",
    "it_park": r"(?i)\b(tech ?park|it park|infospace|infinity|techpolis|tech ?city|software|ecospace|eco space|bengal intelligent|dlf|candor|unitech|webel|tcs|wipro|infosys|cognizant|accenture|ibm|godrej waterside)\b",
}
# Type and rank of a gazetteer's feature codes.
GAZETTEER_CODES = """
PPL Area 6, PPLX Area 7, PPLA Town 9, PPLA2 Town 8, PPLA3 Town 8, PPLL Village 4, UNIV University 7, AIRP Airport 9, SHRN Temple 6,
TMPL Temple 6, CH Church 5, MSQE Mosque 5, GHAT Ghat 5, HSP Hospital 6, SCH School 4, MALL Mall 7, MKT Market 6, PRK Park 5,
BLDG Building 3, STDM Stadium 7, MUS Museum 7, FT Landmark 5, CMTY Cemetery 4, MNMT Landmark 6, BDG Bridge 6
"""


class Rule(NamedTuple):
    """One line of a table; an empty field asks nothing."""

    number: int
    keys: tuple[str, ...]
    values: tuple[str, ...]
    religions: tuple[str, ...]
    span: int | None
    length: int | None
    pattern: str | None
    type: str | None
    rank: int | None


def parse(table: str) -> list[Rule]:
    """The rules of a table, numbered from 1; a line that says something unknown raises ValueError with its number."""
    out = []
    for number, line in enumerate(filter(str.strip, table.splitlines()), 1):
        asked, _, given = (s.strip() for s in line.partition(" ="))
        keys, values, *conditions = asked.split()
        more = {}
        for c in conditions:
            name, sign, value = re.fullmatch(r"(\w+)([>=~])(.+)", c).groups() if re.fullmatch(r"(\w+)([>=~])(.+)", c) else (c, "", "")
            if (name, sign) not in {("span", ">"), ("len", ">"), ("name", "~"), ("religion", "=")} or (sign == "~" and value not in NAME_PATTERNS):
                raise ValueError(f"rule {number}: unknown condition {c!r}")
            more[name] = value
        label, rank = (None, None) if given == "-" else (given.rpartition(" ")[0], int(given.rpartition(" ")[2]))
        religions = tuple(more["religion"].split(",")) if "religion" in more else ()
        span, length = (int(more[k]) if k in more else None for k in ("span", "len"))
        out.append(Rule(number, tuple(keys.split(",")), () if values == "*" else tuple(values.split(",")), religions, span, length, more.get("name"), label, rank))
    return out


RULES = parse(TAG_RULES)


def rule_number(tag: Column, name: Column, span: Column, length: Column, religion: Column, rules: list[Rule] = RULES) -> Column:
    """Number of the first rule that holds for a tag ``key=value``, null if none does. Null figures count as 0, a null
    name matches no pattern; a tag without ``=`` has the empty value."""
    key, valued = F.substring_index(tag, "=", 1), F.contains(tag, F.lit("="))
    value = F.when(valued, F.substring(tag, F.length(key) + 2, F.length(tag))).otherwise("")
    span, length = F.coalesce(span, F.lit(0)), F.coalesce(length, F.lit(0))

    def holds(r: Rule) -> Column:
        asks = [key.isin(*r.keys)]
        asks += [value.isin(*r.values)] if r.values else []
        asks += [F.coalesce(religion.isin(*r.religions), F.lit(False))] if r.religions else []
        asks += [span > r.span] if r.span is not None else []
        asks += [length > r.length] if r.length is not None else []
        asks += [F.coalesce(name.rlike(NAME_PATTERNS[r.pattern]), F.lit(False))] if r.pattern else []
        return reduce(Column.__and__, asks)

    first, *rest = rules
    return reduce(lambda c, r: c.when(holds(r), r.number), rest, F.when(holds(first), first.number))


def _given(number: Column, rules: list[Rule]) -> Column:
    """struct(type, rank) of a rule's number, looked up in one literal array; null where the rule leaves out."""
    shown = F.array(*[F.struct(F.lit(r.type).cast("string").alias("type"), F.lit(r.rank).cast("int").alias("rank")) for r in rules])
    found = F.get(shown, number - 1)
    return F.when(found["type"].isNotNull(), found)


def classified(places: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``places(tag, name, span, len, religion, ...)`` with ``rule``, ``type`` and ``rank``, all null where no rule holds."""
    at = places.withColumn("rule", rule_number(*[F.col(c) for c in ("tag", "name", "span", "len", "religion")], rules))
    given = _given(F.col("rule"), rules)
    return at.withColumns({"type": given["type"], "rank": given["rank"]})


def rule_report(places: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """rule, type, rank, places: how many places each rule took, those that took none included."""
    spark = places.sparkSession
    hits = classified(places, rules).groupBy("rule").agg(F.count(F.lit(1)).alias("places"))
    table = spark.createDataFrame([(r.number, r.type, r.rank) for r in rules], "rule int, type string, rank int")  # a row a rule
    return table.join(F.broadcast(hits.where("rule IS NOT NULL")), "rule", "left").select("rule", "type", "rank", F.coalesce("places", F.lit(0)).alias("places"))


def gazetteer_type(code: Column) -> Column:
    """struct(type, rank) of a gazetteer's feature code, null for others."""
    rows = [entry.split() for entry in GAZETTEER_CODES.replace("\n", " ").split(",")]
    table = F.create_map(*[x for c, label, rank in rows for x in (F.lit(c), F.struct(F.lit(label).alias("type"), F.lit(int(rank)).alias("rank")))])
    return F.element_at(table, code)
