"""Values and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE, SLACK = 0.05, 0.5


def fahrenheit_to_celsius(col: Column) -> Column:
    return F.round((col - 32.0) * 5.0 / 9.0, 2)


def interval_low(value: Column, low: Column) -> Column:
    """A number is an interval of one point."""
    return F.coalesce(low, value)


def interval_high(value: Column, high: Column) -> Column:
    return F.coalesce(high, value)


def compatible(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    return F.greatest(lo1, lo2) <= F.least(hi1, hi2) + SLACK


def numeric_match(gold: Column, value: Column, low: Column, high: Column) -> Column:
    """Within 5 % of a predicted number, or inside a predicted range."""
    near = F.abs(value - gold) <= TOLERANCE * F.greatest(F.abs(gold), F.lit(1e-9))
    return F.coalesce(near, F.lit(False)) | F.coalesce((gold >= low) & (gold <= high), F.lit(False))


def range_match(gold_low: Column, gold_high: Column, value: Column, low: Column, high: Column) -> Column:
    overlap = (F.greatest(gold_low, low) <= F.least(gold_high, high)) & low.isNotNull() & high.isNotNull()
    return F.coalesce(overlap, F.lit(False)) | F.coalesce((value >= gold_low) & (value <= gold_high), F.lit(False))


def text_match(needle: Column, hay: Column) -> Column:
    n = F.lower(F.trim(F.coalesce(needle, F.lit(""))))
    return (n == "") | F.contains(F.lower(F.coalesce(hay, F.lit(""))), n)


def safe_ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(F.round(a / b, 4))


def year_in(col: Column) -> Column:
    """The first year 19xx or 20xx in a text; null where none stands."""
    return F.regexp_extract(F.coalesce(col, F.lit("")), r"((?:19|20)[0-9]{2})", 1).try_cast("int")


def temperatures(col: Column) -> Column:
    """All numbers that a temperature unit follows, as written."""
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"([0-9]+(?:\.[0-9]+)?) ?(?:°C|celsius|deg C|degrees Celsius)"), F.lit(1))


def measurement_range(col: Column, part: int) -> Column:
    """Number 1 or 2 of the first 'a to b' or 'a-b'."""
    return F.regexp_extract(F.coalesce(col, F.lit("")), r"([0-9]+(?:\.[0-9]+)?) ?(?:to|-|–) ?([0-9]+(?:\.[0-9]+)?)", part).try_cast("double")


def value_signature(value_type: Column, value: Column, low: Column, high: Column, text: Column, unit: Column) -> Column:
    """One spelling for equal values: numbers at four places with the unit, texts in one letter case."""
    n = lambda c: F.format_string("%.4f", c)
    u = F.coalesce(unit, F.lit(""))
    return F.when((value_type == "numeric") & value.isNotNull(), F.concat_ws("|", F.lit("n"), n(value), u)).when((value_type == "range") & low.isNotNull() & high.isNotNull(), F.concat_ws("|", F.lit("r"), n(low), n(high), u)).otherwise(F.concat_ws("|", F.lit("t"), F.lower(F.trim(F.coalesce(text, F.lit(""))))))


#: What a statement observes, by its qualifier (fixed values).
OBSERVATIONS = {"risk": "risk", "recommended": "recommendation", "threshold": "threshold", "optimal": "condition", "descriptive": "condition"}


def observation_type(qualifier: Column, kinds: dict[str, str] = OBSERVATIONS, default: str = "condition") -> Column:
    table = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(F.coalesce(qualifier, F.lit(""))))), F.lit(default))


def all_temperatures(col: Column) -> Column:
    """Every temperature in a text in degrees Celsius (Fahrenheit converted), in order of mention."""
    pattern = r"(-?[0-9]+(?:\.[0-9]+)?) ?(?:°|degrees |deg )?([CF]|Celsius|Fahrenheit|celsius|fahrenheit)\b"
    t = F.coalesce(col, F.lit(""))
    numbers, units = F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), F.regexp_extract_all(t, F.lit(pattern), F.lit(2))
    return F.transform(F.arrays_zip(numbers.alias("n"), units.alias("u")), lambda x: F.when(F.lower(F.substring(x["u"], 1, 1)) == "f", fahrenheit_to_celsius(x["n"].cast("double"))).otherwise(x["n"].cast("double")))
