"""Signals of texts and sources. Term lists are parameters: plain words, matched in any letter case."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR = r"\b(?:january|february|march|april|may|june|july|august|september|october|november|december|spring|summer|autumn|winter)\b"


def _alternatives(terms) -> str:
    return "(?i)(?:" + "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t))) + ")"


def has_any(col: Column, terms) -> Column:
    """Whether one of the terms stands in the text; false for null."""
    return F.coalesce(col.rlike(_alternatives(terms)), F.lit(False)) if len(list(terms)) else F.lit(False)


def has_any_in(cols: list[Column], terms) -> Column:
    """The same over several fields."""
    return has_any(F.concat_ws("\n", *cols), terms)


def topics(col: Column, keywords: dict[str, tuple[str, ...]], default: str) -> Column:
    """All topics with a keyword in the text, in the order given; the default where there is none."""
    found = F.array_compact(F.array(*[F.when(has_any(col, words), F.lit(name)) for name, words in keywords.items()]))
    return F.when(F.size(found) == 0, F.array(F.lit(default))).otherwise(found)


def topic_words(names: Column, keywords: dict[str, tuple[str, ...]]) -> Column:
    """The keywords of several topics, each once, in the order of the topics."""
    table = F.create_map(*[x for k, v in keywords.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    return F.array_distinct(F.flatten(F.transform(names, lambda n: F.coalesce(F.element_at(table, n), F.array().cast("array<string>")))))


def numbers_in(col: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"(\d+(?:[.,]\d+)*)"), F.lit(1)))


def capital_words(col: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"\b([A-Z]{3,})\b"), F.lit(1)))


def word_count(col: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"(\S+)"), F.lit(1)))


def layout_artifact(col: Column, terms=(), numbers: int = 4, capitals: int = 5, words: int = 35) -> Column:
    """Leftovers of a page's layout: one of the terms, a bullet list of numbers, several ordinals, or shouting headings."""
    ordinals = F.size(F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"(?i)\b(\d+(?:st|nd|rd|th))\b"), F.lit(1)))
    bullets = F.coalesce(col.rlike(r"[•▪●]|^\s*[-*]\s"), F.lit(False)) & (numbers_in(col) >= numbers)
    return has_any(col, terms) | bullets | (ordinals >= 2) | ((capital_words(col) >= capitals) & (word_count(col) < words))


def header_artifact(col: Column, title: Column) -> Column:
    """A heading taken for a sentence: it is the title (or a part of it), or a short line without an end."""
    norm = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    same = (norm(title) != "") & F.contains(norm(title), norm(col)) & (norm(col) != "")
    short = (word_count(col) < 6) & ~F.coalesce(col.rlike(r"[.!?]\s*$"), F.lit(False))
    return same | short


def admissible(col: Column, score: Column, banned=(), keywords=(), least_score: int = 5, words: tuple[int, int] = (6, 45)) -> Column:
    """Whether a sentence may become a claim: a source of some score, a usual length, no reference to a page, table or figure, and a keyword or a number."""
    n = word_count(col)
    refers = F.coalesce(col.rlike(r"(?i)\b(?:table of contents|(?:table|figure|fig\.|page)\s*\d+)"), F.lit(False))
    says = has_any(col, keywords) | (numbers_in(col) > 0)
    return (F.coalesce(score, F.lit(0)) >= least_score) & n.between(*words) & ~refers & ~has_any(col, banned) & says


def relevant_capture(score: Column, preferred: Column, term: Column, signal: Column, least: int = 5, strong: int = 9) -> Column:
    """A capture of some score that comes from a preferred source, names a preferred term, or is strong and has the subject's signal."""
    s = F.coalesce(score, F.lit(0))
    return (s >= least) & (preferred | term | (signal & (s >= strong)))


def seasonal(label: Column, text: Column, years: tuple[int, int]) -> Column:
    """A claim of one season: a label of its own, a year of the range, or a month or season named in the text."""
    year = F.regexp_extract(F.coalesce(text, F.lit("")), r"\b((?:19|20)\d\d)\b", 1).try_cast("int")
    own = ~F.lower(F.trim(F.coalesce(label, F.lit("")))).isin("", "unspecified", "any", "all")
    return own | F.coalesce(year.between(*years), F.lit(False)) | F.coalesce(text.rlike("(?i)" + CALENDAR), F.lit(False))


def regional(level: Column, fields: list[Column], region: str, levels=("state", "county", "region", "trial_site")) -> Column:
    """A claim of one region: the region is named, or the location is no larger than one."""
    return has_any_in(fields, (region,)) | F.coalesce(F.lower(level).isin(*levels), F.lit(False))


def qualifier(col: Column, words: dict[str, tuple[str, ...]], default: str = "descriptive") -> Column:
    """The first kind of statement, in the order given, one of whose words stands in the text."""
    out = F.when(F.lit(False), F.lit(default))
    for name, terms in words.items():
        out = out.when(has_any(col, terms), F.lit(name))
    return out.otherwise(F.lit(default))


def first_rule(col: Column, rules: list[tuple[tuple[str, ...], tuple[str, ...], tuple[str, str]]], default: tuple[str, str]) -> Column:
    """(attribute, subtype) of the first rule that holds: a rule wants one of its first terms and, where it has any, one of its second."""
    pair = lambda p: F.struct(F.lit(p[0]).alias("attribute"), F.lit(p[1]).alias("subtype"))
    out = F.when(F.lit(False), pair(default))
    for some, also, result in rules:
        out = out.when(has_any(col, some) & (has_any(col, also) if also else F.lit(True)), pair(result))
    return out.otherwise(pair(default))
