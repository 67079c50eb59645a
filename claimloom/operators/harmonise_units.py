"""Quantities recorded in different units, brought to one unit per parameter.

Every numeric claim states a number and (mostly) a unit, in columns or in text. The columns of a
claim obey physical identities: value x size(unit) = normalized value, and for volume units
mass = density x volume (bushels x pounds per bushel). The operator enumerates the units of the
parameter's dimension (a fixed list) and takes the log residual of the identity of each. Where no unit is stated, the
unit with the smallest residual is taken, if it fits and no unit of another size fits as well. A stated unit stays, but it is
judged too: where it misses the identity and another unit fulfils it, the claim has two readings, is flagged as not unique, and the other unit is told.

Defined results: no number anywhere -> value_common null, unit_source null; a number without any
unit and without a normalized value -> unit_source 'none', value_common null; unknown parameter or
crop -> null value. Repeated rows give repeated rows (the caller decides on de-duplication). Extra
columns are carried along; the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.units import DIMENSIONS, NUMBER_WORDS, spelling_rows

SPACES = r"[     ]"
NUMBER = rf"\d{{1,3}}(?:{SPACES}\d{{3}})+(?!\d)(?:[.,]\d+)?|\d{{1,3}}(?:,\d{{3}})+(?!\d)(?:\.\d+)?|\d+(?:[.,]\d+)?"
FRACTIONS = {"½": 0.5, "¼": 0.25, "¾": 0.75, "⅓": 1 / 3, "⅔": 2 / 3}
OWN = ("number_text", "number", "unit_name", "unit_source", "value_common", "log_residual", "unit_unique", "unit_by_identity", "unit_changes_size")


def units_spelling(col: Column) -> Column:
    """One spelling for units that differ in letter case, superscripts, spacing or a final stop."""
    c = F.translate(F.lower(col), "²³⁻¹−", "23-1-")
    c = F.replace(F.replace(c, F.lit("℃"), F.lit("°c")), F.lit("℉"), F.lit("°f"))
    c = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    c = F.regexp_replace(c, r"(?<=[a-z])\.$", "")
    return F.nullif(c, F.lit(""))


def parse_number(text: Column) -> Column:
    """A number as written: thousands parted by spaces or commas, decimal comma or point, vulgar fractions."""
    plain = F.regexp_replace(text, SPACES, "")
    thousands = plain.rlike(r"^[1-9]\d{0,2}(,\d{3})+(\.\d+)?$")
    body = F.when(thousands, F.replace(plain, F.lit(","), F.lit(""))).otherwise(F.replace(plain, F.lit(","), F.lit(".")))
    return body.try_cast("double")


def _word_number(text: Column) -> Column:
    word = F.lower(F.regexp_extract(text, r"(?i)\b(" + "|".join(NUMBER_WORDS) + r")\b", 1))
    pos = F.array_position(F.array(*[F.lit(w) for w in NUMBER_WORDS]), word)
    return F.when(pos > 0, (pos - 1).cast("double"))


def _quote(s: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s)


def unit_pattern(dimension: str) -> str:
    """An alternation of all spellings of a dimension, the longest first, tolerant of superscripts and spacing."""
    seen = {s for names, *_ in DIMENSIONS[dimension] for s in names}
    forms = []
    for s in sorted(seen, key=len, reverse=True):
        p = _quote(s).replace(" ", r"\s+").replace("°c", r"(?:℃|°\s*c)").replace("°f", r"(?:℉|°\s*f)")
        p = re.sub(r"-1\b", "(?:-1|⁻¹)", p)
        p = re.sub(r"-2\b", "(?:-2|⁻²)", p)
        p = re.sub(r"(?<=[a-z])2\b", "[2²]", p)
        p = re.sub(r"(?<=[a-z])3\b", "[3³]", p)
        forms.append(p)
    return "(?:" + "|".join(forms) + ")"


def _text_number_pattern(number_text: Column, number: Column) -> Column:
    """The number as a pattern: as written where there is a writing, else every usual writing of the value."""
    whole = F.floor(F.abs(number)).cast("long").cast("string")
    grouped = F.regexp_replace(F.format_number(F.floor(F.abs(number)), 0), ",", r"[,\\s]?")
    dec = F.regexp_replace(F.regexp_extract(F.format_string("%.6f", F.abs(number) % 1), r"\.(\d+)", 1), "0+$", "")
    plain = F.concat(F.when(F.length(whole) > 3, grouped).otherwise(whole), F.when(dec == "", F.lit(r"(?:[.,]0+)?(?![\d])")).otherwise(F.concat(F.lit("[.,]"), dec, F.lit("0*"))))
    written = F.regexp_replace(F.regexp_replace(number_text, SPACES, r"\\s"), r"([.])", r"\\.")
    # a small whole number may stand as a word
    word = F.when((number == F.floor(number)) & number.between(0, len(NUMBER_WORDS) - 1), F.get(F.array(*[F.lit(w) for w in NUMBER_WORDS]), number.cast("int")))
    either = F.when(word.isNotNull(), F.concat(F.lit("(?:"), plain, F.lit(r"|\b"), word, F.lit(")"))).otherwise(plain)
    return F.when(F.length(number_text) > 0, written).otherwise(either)


def harmonise_units(claims: DataFrame, parameters: DataFrame, crops: DataFrame, residual_tolerance: float = 0.005) -> DataFrame:
    """claims: parameter_id, entity_name, raw_value_text, numeric_value, unit, claim_text, normalized_numeric_value.

    parameters (parameter_id, common_unit) and crops (label, aliases, scientific_names,
    lb_per_bushel) are fixed dimension tables of a few rows; they are broadcast.
    """
    spark = claims.sparkSession
    claims = claims.drop(*OWN)
    dims = F.broadcast(parameters.select(F.col("parameter_id").alias("_pid"), F.col("common_unit").alias("_dim")).dropDuplicates(["_pid"]))
    names = crops.select("lb_per_bushel", F.explode(F.array_distinct(F.transform(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("scientific_names", F.array().cast("array<string>"))), lambda n: F.lower(F.trim(n))))).alias("_crop"))
    names = F.broadcast(names.groupBy("_crop").agg(F.max("lb_per_bushel").alias("_lbbu")))
    sizes = spark.createDataFrame(spelling_rows(), "_sdim string, _spelling string, _uname string, _factor double, _offset double, _bu boolean")
    per_dim = F.broadcast(sizes.groupBy("_sdim").agg(F.map_from_entries(F.collect_list(F.struct("_spelling", F.struct(F.col("_uname").alias("name"), F.col("_factor").alias("factor"), F.col("_offset").alias("offset"), F.col("_bu").alias("bu"))))).alias("_units")))

    df = claims.join(dims, F.col("parameter_id") == F.col("_pid"), "left")
    df = df.join(per_dim, F.col("_dim") == F.col("_sdim"), "left")
    df = df.join(names, F.lower(F.trim(F.col("entity_name"))) == F.col("_crop"), "left")

    raw = F.coalesce(F.col("raw_value_text"), F.lit(""))
    df = df.withColumn("number_text", F.regexp_extract(raw, f"({NUMBER})", 1))
    fraction = F.lit(0.0)
    for sign, size in FRACTIONS.items():
        fraction = F.when(raw.contains(sign), F.lit(size)).otherwise(fraction)
    negative = F.when(raw.rlike(r"^[^\d]*[-−]\s*\d"), F.lit(-1.0)).otherwise(F.lit(1.0))
    from_raw = F.coalesce(negative * (parse_number(F.col("number_text")) + fraction), F.when(fraction > 0, fraction), _word_number(raw))
    df = df.withColumn("_rawnum", from_raw).withColumn("number", F.coalesce("_rawnum", F.nanvl("numeric_value", F.lit(None).cast("double"))))
    after = F.when(F.length("number_text") > 0, F.regexp_extract(raw, rf"(?s)(?:{NUMBER})\s*[½¼¾⅓⅔]?(.*)$", 1)).otherwise(F.regexp_replace(raw, r"(?i)^.*?\b(" + "|".join(NUMBER_WORDS) + r")\b", ""))
    df = df.withColumn("_raw_unit", F.when(F.col("_rawnum").isNotNull(), F.try_element_at("_units", units_spelling(after))))
    df = df.withColumn("_col_unit", F.try_element_at("_units", units_spelling(F.col("unit"))))

    pats = F.create_map(*[x for d in DIMENSIONS for x in (F.lit(d), F.lit(unit_pattern(d)))])
    needs_text = F.col("_raw_unit").isNull() & F.col("_col_unit").isNull() & F.col("number").isNotNull() & F.col("_dim").isNotNull()
    pattern = F.concat(F.lit(r"(?is)(?<![\d.,])"), _text_number_pattern(F.col("number_text"), F.col("number")), F.lit(r"[½¼¾⅓⅔]?[\s\-]*("), F.try_element_at(pats, F.col("_dim")), F.lit(r")(?![\w/°])"))
    df = df.withColumn("_text_pat", F.when(needs_text, pattern))
    df = df.withColumn("_text_unit", F.when(F.col("_text_pat").isNotNull(), F.try_element_at("_units", units_spelling(F.expr("regexp_extract(coalesce(claim_text, ''), _text_pat, 1)")))))
    df = df.withColumn("_stated", F.coalesce("_raw_unit", "_col_unit", "_text_unit"))

    def size(u: Column) -> Column:
        return u["factor"] * F.when(u["bu"], F.col("_lbbu")).otherwise(F.lit(1.0))

    def common(u: Column) -> Column:
        return F.col("number") * size(u) + u["offset"]

    norm = F.nanvl("normalized_numeric_value", F.lit(None).cast("double"))
    same_sign = lambda v: (v * norm) > 0
    residual = lambda u: F.when(same_sign(common(u)), F.abs(F.log(F.abs(common(u))) - F.log(F.abs(norm))))
    # the identity is solved over all units of the dimension, whatever is stated
    solved = F.array_sort(F.filter(F.transform(F.map_values("_units"), lambda u: F.struct(residual(u).alias("r"), u["name"].alias("name"), size(u).alias("size"), u.alias("u"))), lambda s: s["r"].isNotNull()))
    df = df.withColumn("_solved", F.when(F.col("number").isNotNull(), solved))
    best = F.get("_solved", F.lit(0))
    fits = F.filter("_solved", lambda s: s["r"] <= best["r"] + residual_tolerance)
    clear = (best["r"] <= residual_tolerance) & (F.size(F.array_distinct(F.transform(fits, lambda s: F.round(s["size"], 9)))) == 1)
    df = df.withColumn("_clear", F.coalesce(clear, F.lit(False))).withColumn("_stated_r", residual(F.col("_stated")))
    inferred = F.when(F.col("_clear"), best["u"])
    # a stated unit misses the identity while another fulfils it
    contradicted = F.col("_clear") & (F.col("_stated_r") > residual_tolerance)
    df = df.withColumn("_unit", F.coalesce("_stated", inferred))
    source = F.when(F.col("_raw_unit").isNotNull(), "raw_value_text").when(F.col("_col_unit").isNotNull(), "unit").when(F.col("_text_unit").isNotNull(), "claim_text").when(inferred.isNotNull(), "identity").otherwise("none")
    out = df.select(
        *[F.col(f"`{c}`") for c in claims.columns],
        "number_text",
        "number",
        F.col("_unit")["name"].alias("unit_name"),
        F.when(F.col("number").isNotNull(), source).alias("unit_source"),
        F.when(F.col("number").isNotNull(), common(F.col("_unit"))).alias("value_common"),
        F.coalesce("_stated_r", best["r"]).alias("log_residual"),
        F.when(F.col("number").isNotNull(), F.when(F.col("_stated").isNotNull(), ~F.coalesce(contradicted, F.lit(False))).otherwise(F.col("_clear"))).alias("unit_unique"),
        F.when(F.col("_clear"), best["name"]).alias("unit_by_identity"),
        ((size(F.col("_unit")) != 1.0) | (F.col("_unit")["offset"] != 0.0)).alias("unit_changes_size"),
    )
    return out
