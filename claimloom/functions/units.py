"""Units of measurement: spellings, sizes and number formats.

A dimension is named by the common unit of the parameters that use it. The size of a unit is
the factor (and offset) that turns a value in it into the dimension's common unit.
"""

from __future__ import annotations

LB = 0.45359237  # kg
ACRE = 0.40468564224  # ha
INCH = 2.54  # cm
BUSHEL_HL = 0.3523907  # hectolitres of a bushel of grain

_LB_AC = LB / ACRE

#: dimension -> [(spellings, factor, offset, per_bushel)]; per_bushel: the factor is still to be
#: multiplied by the crop's pounds per bushel (mass = density x volume).
DIMENSIONS: dict[str, list[tuple[tuple[str, ...], float, float, bool]]] = {
    "celsius": [
        (("celsius", "c", "°c", "degrees celsius", "degree celsius", "degrees c", "deg c", "deg. c", "degc"), 1.0, 0.0, False),
        (("fahrenheit", "f", "°f", "degrees fahrenheit", "degree fahrenheit", "degrees f", "deg f", "deg. f", "degf"), 5.0 / 9.0, -160.0 / 9.0, False),
        (("kelvin", "k", "kelvins", "°k", "deg k"), 1.0, -273.15, False),
    ],
    "t/ha": [
        (("t/ha", "t ha-1", "t per ha", "tonnes/ha", "tonne/ha", "tonnes per hectare", "tonne per hectare", "metric tons/ha", "metric tons per hectare", "metric ton/ha", "mg/ha", "mg ha-1", "tons/ha"), 1.0, 0.0, False),
        (("kg/ha", "kg ha-1", "kg per ha", "kilograms per hectare", "kilogram per hectare"), 0.001, 0.0, False),
        (("dt/ha", "dt ha-1", "q/ha", "q ha-1", "quintals per hectare", "quintals/ha", "decitonnes per hectare"), 0.1, 0.0, False),
        (("g/m2", "g m-2", "grams per square metre", "grams per square meter"), 0.01, 0.0, False),
        (("lb/ac", "lb ac-1", "lbs/ac", "lb/a", "lb/acre", "lbs/acre", "lbs per acre", "lb per acre", "pounds per acre", "pounds/acre"), _LB_AC / 1000.0, 0.0, False),
        (("bu/ac", "bu ac-1", "bu/a", "bu/acre", "bu per acre", "bushels per acre", "bushels/acre", "bushel per acre"), _LB_AC / 1000.0, 0.0, True),
    ],
    "kg/ha": [
        (("kg/ha", "kg ha-1", "kg per ha", "kilograms per hectare", "kilogram per hectare"), 1.0, 0.0, False),
        (("t/ha", "t ha-1", "tonnes per hectare", "tonnes/ha"), 1000.0, 0.0, False),
        (("g/m2", "g m-2", "grams per square metre", "grams per square meter"), 10.0, 0.0, False),
        (("lb/ac", "lb ac-1", "lbs/ac", "lb/a", "lb/acre", "lbs/acre", "lbs per acre", "lb per acre", "pounds per acre", "pounds/acre"), _LB_AC, 0.0, False),
        (("bu/ac", "bu ac-1", "bu/a", "bu/acre", "bushels per acre", "bushels/acre"), _LB_AC, 0.0, True),
    ],
    "cm": [
        (("cm", "centimetre", "centimetres", "centimeter", "centimeters"), 1.0, 0.0, False),
        (("mm", "millimetre", "millimetres", "millimeter", "millimeters"), 0.1, 0.0, False),
        (("m", "metre", "metres", "meter", "meters"), 100.0, 0.0, False),
        (("in", "inch", "inches", '"', "″"), INCH, 0.0, False),
        (("ft", "foot", "feet", "'"), 12 * INCH, 0.0, False),
    ],
    "m": [
        (("m", "metre", "metres", "meter", "meters"), 1.0, 0.0, False),
        (("cm", "centimetre", "centimetres", "centimeter", "centimeters"), 0.01, 0.0, False),
        (("mm", "millimetre", "millimetres", "millimeter", "millimeters"), 0.001, 0.0, False),
        (("in", "inch", "inches", '"', "″"), INCH / 100, 0.0, False),
        (("ft", "foot", "feet", "'"), 12 * INCH / 100, 0.0, False),
    ],
    "plants/m2": [
        (("plants/m2", "plants m-2", "plants per m2", "plants per square metre", "plants per square meter"), 1.0, 0.0, False),
        (("plants/ha", "plants ha-1", "plants per ha", "plants per hectare"), 1e-4, 0.0, False),
        (("thousand plants/ha", "thousand plants per hectare", "thousand plants ha-1"), 0.1, 0.0, False),
        (("plants/ac", "plants/acre", "plants ac-1", "plants per acre"), 1e-4 / ACRE, 0.0, False),
        (("plants/ft2", "plants ft-2", "plants per square foot", "plants per ft2"), 1.0 / 0.09290304, 0.0, False),
    ],
    "mm": [
        (("mm", "millimetre", "millimetres", "millimeter", "millimeters"), 1.0, 0.0, False),
        (("cm", "centimetre", "centimetres", "centimeter", "centimeters"), 10.0, 0.0, False),
        (("in", "inch", "inches", '"', "″"), 10 * INCH, 0.0, False),
        (("m3/ha", "m3 ha-1", "cubic metres per hectare", "cubic meters per hectare"), 0.1, 0.0, False),
        (("ml/ha", "megalitres per hectare", "megaliters per hectare"), 100.0, 0.0, False),
    ],
    "m3/ha": [
        (("m3/ha", "m3 ha-1", "cubic metres per hectare", "cubic meters per hectare"), 1.0, 0.0, False),
        (("mm", "millimetre", "millimetres", "millimeter", "millimeters"), 10.0, 0.0, False),
        (("cm", "centimetre", "centimetres", "centimeter", "centimeters"), 100.0, 0.0, False),
        (("ml/ha", "ml ha-1", "megalitres per hectare", "megaliters per hectare"), 1000.0, 0.0, False),
        (("acre-inches/ac", "acre-inches per acre", "acre-inch/ac", "acre-in/ac", "acre-inches/acre", "in", "inch", "inches"), 100 * INCH, 0.0, False),
    ],
    "fraction": [
        (("fraction", "kg/kg", "kg kg-1", "g/g", "g g-1"), 1.0, 0.0, False),
        (("%", "percent", "per cent", "pct"), 0.01, 0.0, False),
        (("g/kg", "g kg-1"), 0.001, 0.0, False),
    ],
    "%": [
        (("%", "percent", "per cent", "pct"), 1.0, 0.0, False),
        (("fraction", "kg/kg", "kg kg-1", "g/g", "g g-1"), 100.0, 0.0, False),
        (("g/kg", "g kg-1"), 0.1, 0.0, False),
    ],
    "days": [
        (("days", "day", "d"), 1.0, 0.0, False),
        (("weeks", "week", "wk", "wks"), 7.0, 0.0, False),
    ],
    "kg/hl": [
        (("kg/hl", "kg hl-1", "kilograms per hectolitre"), 1.0, 0.0, False),
        (("g/l", "g l-1", "grams per litre", "kg/m3", "kg m-3"), 0.1, 0.0, False),
        (("lb/bu", "lbs/bu", "lb bu-1", "pounds per bushel", "lb per bushel"), LB / BUSHEL_HL, 0.0, False),
    ],
}

#: Number words in place of digits (fixed values).
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty")


def spelling_rows() -> list[tuple[str, str, str, float, float, bool]]:
    """(dimension, spelling, name of the unit, factor, offset, per_bushel) of every known spelling."""
    return [(dim, s, names[0], factor, offset, per_bushel) for dim, units in DIMENSIONS.items() for names, factor, offset, per_bushel in units for s in names]


def normal_spelling(text: str) -> str:
    """The Python twin of units_spelling() in operators.harmonise_units, for tests."""
    import re

    t = text.lower().replace("²", "2").replace("³", "3").replace("⁻", "-").replace("¹", "1").replace("−", "-").replace("℃", "°c").replace("℉", "°f")
    t = re.sub(r"\s+", " ", t).strip()
    return re.sub(r"(?<=[a-z])\.$", "", t)
