"""Travel speed from the tags of a way, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paceway.functions.grid import _c

# --- fixed values -----------------------------------------------------------------------------
# class of way -> speed in km/h
CLASS_KMH = {
    "motorway": 100, "trunk": 70, "primary": 65, "secondary": 60, "tertiary": 50,
    "unclassified": 30, "residential": 30, "service": 20,
    "motorway_link": 70, "trunk_link": 65, "primary_link": 60, "secondary_link": 50,
    "tertiary_link": 40, "living_street": 10, "pedestrian": 6, "track": 20, "road": 35,
}
# class of way -> speed in mph
CLASS_MPH = {
    "motorway": 65, "trunk": 45, "primary": 40, "secondary": 35, "tertiary": 30,
    "unclassified": 20, "residential": 20, "service": 15,
    "motorway_link": 45, "trunk_link": 40, "primary_link": 35, "secondary_link": 30,
    "tertiary_link": 25, "living_street": 5, "pedestrian": 5, "track": 15, "road": 20,
}
# country limit code -> speed in km/h
COUNTRY_KMH = {
    "at:urban": 50, "at:rural": 100, "at:trunk": 100, "at:motorway": 130,
    "ch:urban": 50, "ch:rural": 80, "ch:trunk": 100, "ch:motorway": 120,
    "cz:urban": 50, "cz:rural": 90, "cz:trunk": 130, "cz:motorway": 130,
    "dk:urban": 50, "dk:rural": 80, "dk:motorway": 130,
    "de:living_street": 7, "de:urban": 50, "de:walk": 7, "de:rural": 100,
    "fi:urban": 50, "fi:rural": 80, "fi:trunk": 100, "fi:motorway": 120,
    "fr:urban": 50, "fr:rural": 90, "fr:trunk": 110, "fr:motorway": 130,
    "hu:urban": 50, "hu:rural": 90, "hu:trunk": 110, "hu:motorway": 130,
    "it:urban": 50, "it:rural": 90, "it:trunk": 110, "it:motorway": 130,
    "jp:national": 60, "jp:motorway": 100,
    "ro:urban": 50, "ro:rural": 90, "ro:trunk": 100, "ro:motorway": 130,
    "ru:living_street": 20, "ru:rural": 90, "ru:urban": 60, "ru:motorway": 110,
    "sk:urban": 50, "sk:rural": 90, "sk:trunk": 130, "sk:motorway": 130,
    "si:urban": 50, "si:rural": 90, "si:trunk": 110, "si:motorway": 130,
    "se:urban": 50, "se:rural": 70, "se:trunk": 90, "se:motorway": 110,
    "gb:nsl_single": 96.54, "gb:nsl_dual": 112.63, "gb:motorway": 112.63,
    "ua:urban": 60, "ua:rural": 90, "ua:trunk": 110, "ua:motorway": 130,
    "living_street": 6,
}
# values that tell nothing about the speed
NO_INFORMATION = (
    "maxspeed", "ambiguous", "signals", "none", "walk",
    "variable", "national", "fixme", "unposted", "implicit",
)
# symbol of a velocity unit -> km/h
VELOCITY_KMH = {
    "km/h": 1.0, "mph": 1.609344, "kn": 1.852, "m/s": 3.6, "ft/s": 1.09728, "km/s": 3600.0,
}
# units looked for in free text, in this order, and their conversion to the target unit
TEXT_UNITS = {
    "kmh": {"kph": 1.0, "km/h": 1.0, "kmh": 1.0, "mph": 1.609, "knots": 1.852},
    "mph": {"kph": 1 / 1.609344, "km/h": 1.0, "kmh": 1.0, "mph": 1.0, "knots": 0.868976},
}
# classes walked rather than driven, and their speed
PATH_CLASSES = ("footway", "steps", "bridleway", "path")
PATH_SPEED = 3.74
# ----------------------------------------------------------------------------------------------

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
VELOCITY = r"^([-+]?[0-9]*[.]?[0-9]+(?:[eE][-+]?[0-9]+)?) *(" + "|".join(VELOCITY_KMH) + ")$"


def lookup(key, table: dict) -> Column:
    """Value of a small constant table; NULL when the key is not in it."""
    pairs = [F.lit(x) for k, v in table.items() for x in (k, float(v))]
    return F.try_element_at(F.create_map(*pairs), _c(key))


def _classes(unit: str) -> dict:
    return {"kmh": CLASS_KMH, "mph": CLASS_MPH}[unit]


def class_speed(highway, unit: str = "kmh") -> Column:
    """Default speed of a road class; an unknown class counts as ``road``."""
    table = _classes(unit)
    return F.coalesce(lookup(highway, table), F.lit(float(table["road"])))


def country_speed(code) -> Column:
    return lookup(code, COUNTRY_KMH)


def _strip(s) -> Column:
    return F.regexp_replace(_c(s), r"^\s+|\s+$", "")


def is_number(s) -> Column:
    """Whether text, blanks around it aside, is a plain decimal number."""
    return _strip(s).rlike(NUMBER)


def _number(s: Column) -> Column:
    return F.when(is_number(s), _strip(s).try_cast("double"))


def parse_velocity(s) -> Column:
    """Speed in km/h from a number followed by a unit symbol; NULL if it is not written so."""
    number = F.regexp_extract(_c(s), VELOCITY, 1)
    unit = F.regexp_extract(_c(s), VELOCITY, 2)
    return F.when(number != "", number.try_cast("double") * lookup(unit, VELOCITY_KMH))


def speed_chain(highway, maxspeed) -> Column:
    """Speed in km/h: written velocity, country code, class, else ``road``; never NULL.

    Both tags are needed: a way that lacks one gets the speed of ``road`` whatever the other says.
    """
    road = F.lit(float(CLASS_KMH["road"]))
    both = _c(highway).isNotNull() & _c(maxspeed).isNotNull()
    found = F.coalesce(
        parse_velocity(maxspeed), country_speed(maxspeed), lookup(highway, CLASS_KMH), road
    )
    return F.when(both, found).otherwise(road)


def speed_source(highway, maxspeed) -> Column:
    """Which link of ``speed_chain`` decided."""
    return (
        F.when(_c(highway).isNull() | _c(maxspeed).isNull(), "missing_tag")
        .when(parse_velocity(maxspeed).isNotNull(), "velocity")
        .when(country_speed(maxspeed).isNotNull(), "country")
        .when(lookup(highway, CLASS_KMH).isNotNull(), "class")
        .otherwise("road")
    )


def max_speed_of(s, text_unit, unit: str = "kmh", literal_split: bool = False) -> Column:
    """Largest positive number among the parts of a value, converted to ``unit``; else NULL.

    ``text_unit`` (text or column) is blanked out of each part first and sets the conversion.
    ``literal_split`` cuts only at the four characters ``;|,-`` in a row, which in effect
    never splits; the default cuts at each of ``;``, ``|`` and ``,``.
    """
    word = F.lit(text_unit) if isinstance(text_unit, str) else text_unit
    factor = F.coalesce(lookup(word, TEXT_UNITS[unit]), F.lit(1.0))
    parts = F.split(_c(s), r";\|,-" if literal_split else "[;|,]")
    best = F.array_max(F.transform(parts, lambda p: _number(F.replace(p, word, F.lit(""))))) * factor
    return F.when(best > 0, best)


def plain_text(maxspeed) -> Column:
    """Lower case without blanks around; a missing value counts as empty."""
    return F.lower(_strip(F.coalesce(_c(maxspeed), F.lit(""))))


def text_unit_of(s, unit: str = "kmh") -> Column:
    """First known unit that occurs in the text, else the empty text."""
    found = F.when(F.lit(False), "")
    for word in TEXT_UNITS[unit]:
        found = found.when(F.contains(_c(s), F.lit(word)), word)
    return found.otherwise("")


def speed_of_text(s, text_unit, base, unit: str = "kmh", literal_split: bool = False) -> Column:
    """Speed from plain text ``s``, its unit and the class default ``base``.

    Given as columns of their own, the three are worked out once per row.
    """
    s, text_unit, base = _c(s), _c(text_unit), _c(base)
    number = F.when(s.rlike(NUMBER), s.try_cast("double"))
    bare = text_unit == ""
    speed = F.when(s == "", base).when(number.isNotNull(), F.when(number > 0, number).otherwise(base))
    if unit == "kmh":
        code = country_speed(s)
        speed = speed.when(bare & code.isNotNull(), code)
    speed = speed.when(bare & s.isin(*NO_INFORMATION), base)
    return speed.otherwise(F.coalesce(max_speed_of(s, text_unit, unit, literal_split), base))


def speed_notebook(highway, maxspeed, unit: str = "kmh", literal_split: bool = False) -> Column:
    """Speed from free text: number, number with unit, country code (km/h only), else class."""
    s = plain_text(maxspeed)
    return speed_of_text(s, text_unit_of(s, unit), class_speed(highway, unit), unit, literal_split)
