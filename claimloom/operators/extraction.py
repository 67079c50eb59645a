"""From extractions to merged claims: coercion, projection, keys, merge and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions.quality import has_any
from claimloom.functions.values import compatible

QUALIFIERS, VALUE_TYPES, CONFIDENCES = ("optimal", "risk", "recommended", "descriptive"), ("numeric", "range", "text"), ("high", "medium", "low")
NUMBER = r"\d[\d,]*(?:\.\d+)?"
APPLICABILITY = ["entity_name", "parameter_id", "location_level", "location_name", "time_label", "cultivar", "management_system"]


# ------------------------------------------------------------ coercion
def whole_number(col: Column, low: int, high: int) -> Column:
    """A whole number within bounds, else null (unreadable text, fractions and numbers out of bounds alike)."""
    v = F.trim(col.cast("string")).try_cast("int")
    return F.when(v.between(low, high), v)


def enumerated(col: Column, allowed: tuple[str, ...], default: str) -> Column:
    v = F.lower(F.trim(col))
    return F.when(v.isin(*allowed), v).otherwise(F.lit(default))


def organisms(col: Column) -> Column:
    """Names as structs (name, role); blank names dropped; null where none is left. col: array of names, or of JSON objects as text."""
    one = lambda x: F.struct(F.trim(F.coalesce(F.get_json_object(x, "$.name"), F.when(~F.startswith(F.trim(x), F.lit("{")), x))).alias("name"), F.coalesce(F.get_json_object(x, "$.role"), F.lit("unspecified")).alias("role"))
    kept = F.filter(F.transform(col, one), lambda s: F.coalesce(s["name"], F.lit("")) != "")
    return F.when(F.size(kept) > 0, kept)


def coerced(extractions: DataFrame, parameters: DataFrame, summary_chars: int = 400) -> DataFrame:
    """Extractions of known parameters with evidence; kinds outside their lists fall back, summaries are shortened."""
    e = extractions.join(F.broadcast(parameters.select("parameter_id").distinct()), "parameter_id", "left_semi").where(F.trim(F.coalesce("evidence_text", F.lit(""))) != "")
    return e.withColumns({
        "value_type": enumerated(F.col("value_type"), VALUE_TYPES, "text"), "qualifier": enumerated(F.col("qualifier"), QUALIFIERS, "descriptive"), "confidence": enumerated(F.col("confidence"), CONFIDENCES, "low"),
        "claim_text": F.substring(F.coalesce("claim_text", F.lit("")), 1, summary_chars),
    })


def first_per(df: DataFrame, key: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key; a mergeable aggregate over whole rows."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


# ------------------------------------------------------------ values in text
def _number(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit("")).try_cast("double")


def measurement(text: Column, units: tuple[str, ...]) -> Column:
    """value_type, range_min, range_max, numeric_value, unit of the first 'a to b unit', else of the first 'a unit'; null where none stands."""
    import re

    unit = "|".join(re.escape(u) for u in units)
    low = F.lower(F.coalesce(text, F.lit("")))
    span, single = rf"({NUMBER})\s*(?:to|-)\s*({NUMBER})\s*({unit})\b", rf"({NUMBER})\s*({unit})\b"
    none = F.lit(None).cast("double")
    shape = lambda kind, a, b, v, u: F.struct(F.lit(kind).alias("value_type"), a.alias("range_min"), b.alias("range_max"), v.alias("numeric_value"), u.alias("unit"))
    part = lambda p, k: F.regexp_extract(low, p, k)
    return F.when(low.rlike(span), shape("range", _number(part(span, 1)), _number(part(span, 2)), none, part(span, 3))).when(low.rlike(single), shape("numeric", none, none, _number(part(single, 1)), part(single, 2)))


def segment_of(text: Column, subject: Column) -> Column:
    """Of a text that compares subjects ('while', ';'), the first part that names the subject; the whole text where none does."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?i)\bwhile\b|;")
    return F.coalesce(F.get(F.filter(parts, lambda p: F.contains(F.lower(p), F.lower(subject))), F.lit(0)), text)


def dispatched(text: Column, attribute: Column, units: dict[str, tuple[str, ...]]) -> Column:
    """The measurement by the units of the claim's attribute; null for attributes without units."""
    out = F.when(F.lit(False), measurement(text, ("x",)))
    for name, some in units.items():
        out = out.when(attribute == name, measurement(text, some))
    return out


# ------------------------------------------------------------ projection and merge
def projected(extractions: DataFrame, captures: DataFrame, parameters: DataFrame, least_chars: int = 5) -> DataFrame:
    """Extractions as claims: attribute names of the parameter (or the parts of its id), the capture's source; too short texts and missing evidence dropped.

    captures: source_url, final_url, source_title, source_domain, document_type, run_id; parameters: a fixed table.
    """
    p = F.broadcast(parameters.select("parameter_id", F.col("normalized_attribute").alias("_a"), F.col("normalized_attribute_subtype").alias("_s")).dropDuplicates(["parameter_id"]))
    e = extractions.join(p, "parameter_id", "left").join(captures, "source_url")
    evidence = F.trim(F.coalesce("evidence_text", F.lit("")))
    said = F.trim(F.coalesce("claim_text", F.lit("")))
    text = F.when(said == "", evidence).otherwise(said)
    dot = F.substring_index("parameter_id", ".", 1)
    rest = F.when(F.contains(F.col("parameter_id"), F.lit(".")), F.expr("substring(parameter_id, instr(parameter_id, '.') + 1)")).otherwise(F.col("parameter_id"))
    e = e.withColumns({"evidence_text": evidence, "claim_text": text, "attribute": F.coalesce("_a", dot), "attribute_subtype": F.coalesce("_s", rest), "source_urls": F.array(F.coalesce("final_url", "source_url"))})
    return e.where((F.length("claim_text") >= least_chars) & (F.col("evidence_text") != "")).drop("_a", "_s", "final_url")


def merged(claims: DataFrame, run: str, key: list[str] = APPLICABILITY) -> DataFrame:
    """Claims merged within their applicability key and numbered.

    Texts of a key are one claim if they are equal; numbers and ranges, in order of arrival, join the first
    compatible claim of their key, which widens. Sources are united in order. Groups are numbered as they were first seen, texts
    before numbers. claims: the key, ord, claim_text, value_type, lo, hi, source_urls. The fold is sequential by definition (an equal
    interval that comes later may join an earlier one that has widened since); a group is one entity's claims on one parameter, place and time.
    """
    k = F.struct(*key)
    numeric = F.col("value_type").isin("numeric", "range") & F.col("lo").isNotNull()
    urls = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", c))), lambda x: x[c])))
    text = claims.where(~numeric).groupBy(k.alias("k"), "claim_text").agg(F.min("ord").alias("ord"), F.count("*").alias("members"), urls("source_urls").alias("source_urls"))
    text = text.select("k", "ord", F.lit(0).alias("kind"), "claim_text", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), "members", "source_urls")
    one = claims.where(numeric).select(k.alias("k"), F.col("ord").cast("bigint").alias("ord"), "claim_text", "lo", "hi", F.lit(1).cast("bigint").alias("members"), "source_urls")
    rows = one.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("ord", "claim_text", "lo", "hi", "members", "source_urls"))).alias("rows"))
    row = "struct<ord:bigint,claim_text:string,lo:double,hi:double,members:bigint,source_urls:array<string>>"

    def step(acc: Column, v: Column) -> Column:
        at = F.array_position(F.transform(acc, lambda x: compatible(x["lo"], x["hi"], v["lo"], v["hi"])), F.lit(True))
        wide = lambda x: F.struct(x["ord"].alias("ord"), x["claim_text"].alias("claim_text"), F.least(x["lo"], v["lo"]).alias("lo"), F.greatest(x["hi"], v["hi"]).alias("hi"), (x["members"] + v["members"]).alias("members"), F.array_union(x["source_urls"], v["source_urls"]).alias("source_urls"))
        return F.when(at > 0, F.transform(acc, lambda x, i: F.when(i == at - 1, wide(x)).otherwise(x))).otherwise(F.concat(acc, F.array(v)))

    folded = rows.select("k", F.explode(F.aggregate(F.expr(f"cast(rows as array<{row}>)"), F.array().cast(f"array<{row}>"), step)).alias("m"))
    number = folded.select("k", "m.ord", F.lit(1).alias("kind"), "m.claim_text", "m.lo", "m.hi", "m.members", "m.source_urls")
    both = text.unionByName(number)
    first = claims.groupBy(k.alias("k")).agg(F.min("ord").alias("group_ord"))
    both = both.join(first, both["k"].eqNullSafe(first["k"])).drop(first["k"])
    from claimloom.operators.ledger import numbered

    out = numbered(both, ["group_ord", "kind", "ord"], "_n")
    return out.select(*[F.col(f"k.{c}").alias(c) for c in key], "claim_text", "lo", "hi", "members", "source_urls", "ord", F.concat(F.lit(f"{run}-llm-claim-"), F.format_string("%04d", "_n")).alias("claim_id"))


def best_confidence(df: DataFrame, key: list[str]) -> DataFrame:
    c = F.lower(F.trim("confidence"))
    rank = F.when(c == "high", 3).when(c.isin("medium", "med"), 2).when(c == "low", 1).otherwise(0)
    names = F.array(F.lit("unknown"), F.lit("low"), F.lit("medium"), F.lit("high"))
    return df.groupBy(*key).agg(F.max(rank).alias("_m")).select(*key, F.get(names, F.col("_m")).alias("confidence"))


# ------------------------------------------------------------ texts for an extractor
def rendered_blocks(blocks: DataFrame, key: str, limit: int = 12_000) -> DataFrame:
    """key, text: the blocks of a page in order, tables and headings marked by their anchor, at most `limit` characters. blocks: key, pos, anchor, kind, text."""
    one = F.concat(F.lit("["), F.col("anchor"), F.when(F.col("kind") == "table", F.lit(" table")).otherwise(F.lit("")), F.lit("] "), F.col("text"))
    g = blocks.withColumn("_t", one).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "_t"))).alias("_b"))
    return g.select(key, F.substring(F.array_join(F.transform("_b", lambda x: x["_t"]), "\n"), 1, limit).alias("text"))


def input_text(blocks_text: Column, sentences: Column, most: int = 60, limit: int = 12_000) -> Column:
    """What an extractor reads of a capture: its blocks, else its first sentences."""
    return F.substring(F.coalesce(F.nullif(blocks_text, F.lit("")), F.array_join(F.slice(F.coalesce(sentences, F.array().cast("array<string>")), 1, most), "\n")), 1, limit)


def active_parameters(parameters: DataFrame) -> DataFrame:
    status = F.coalesce(F.nullif(F.lower(F.trim("status")), F.lit("")), F.lit("active")) if "status" in parameters.columns else F.lit("active")
    return parameters.where(status == "active")


def manifest_text(parameters: DataFrame, aliases: int = 4) -> Column:
    """A parameter as a line: id, label, unit and its first aliases. Column over parameters with an aliases array."""
    return F.concat_ws(" | ", "parameter_id", "label", "common_unit", F.when(F.size("aliases") > 0, F.concat(F.lit("aliases: "), F.array_join(F.slice("aliases", 1, aliases), ", "))))


def prompt(header: str, manifest: str, body: Column) -> Column:
    return F.concat(F.lit(header + "\n\n" + manifest + "\n\n"), F.coalesce(body, F.lit("")))


def stub_extraction(texts: DataFrame, keywords: dict[str, str], methods: tuple[str, ...] = ()) -> DataFrame:
    """The deterministic extractor: the first keyword in the text names the parameter, a temperature or its range the value, the first method word the method.

    texts: doc_id, text; keywords: word -> parameter_id in order of precedence.
    """
    t = F.lower(F.coalesce("text", F.lit("")))
    param = F.when(F.lit(False), F.lit(""))
    for word, pid in keywords.items():
        param = param.when(F.contains(t, F.lit(word)), F.lit(pid))
    span = r"(\d+(?:\.\d+)?)\s*(?:-|to|–)\s*(\d+(?:\.\d+)?)\s*(?:°\s*c|degrees celsius|celsius)"
    part = lambda k: F.regexp_extract(t, span, k).try_cast("double")
    method = F.when(F.lit(False), F.lit(""))
    for word in methods:
        method = method.when(has_any(t, (word,)), F.lit(word))
    return texts.select("doc_id", param.alias("parameter_id"), part(1).alias("range_min"), part(2).alias("range_max"), method.alias("method")).where("parameter_id is not null")
