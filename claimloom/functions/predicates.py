"""Predicates over text that later steps filter by; all JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import normalize_ws, overlap_share, title_tokens, tokens

NUMBER_UNIT = r"[0-9](?:\.[0-9]+)? ?(?:%|°c|°f|celsius|fahrenheit|mm|cm|m|kg|t|g|lb|ha|ac|days|weeks)(?:$|[^a-z])"
#: Words of pages that publishers return in place of a text (fixed values).
CHALLENGE_MARKERS = (
    "checking your browser", "enable javascript", "captcha", "recaptcha", "just a moment", "access denied",
    "403 forbidden", "cloudflare", "request unsuccessful", "are you a robot", "verifying you are human",
)
CHALLENGE = "|".join(CHALLENGE_MARKERS)


def low_value(text: Column, least: int = 200, challenge_under: int = 1500) -> Column:
    """Too short, or short with the words of a challenge page."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(t) < least) | ((F.length(t) < challenge_under) & F.lower(t).rlike(CHALLENGE))


def looks_like_html(payload: Column) -> Column:
    start = F.lower(F.ltrim(F.substring(F.coalesce(payload, F.lit("")), 1, 512)))
    return start.startswith("<!doctype html") | start.startswith("<html") | start.startswith("<head") | start.startswith("<body")


def resembles_title(text: Column, title: Column, share: float = 0.6, most_words: int = 16) -> Column:
    """A short text that repeats most words of the title."""
    t, b = title_tokens(title), tokens(text)
    return F.coalesce((overlap_share(b, t) >= share) & (F.size(b) >= 3) & (F.size(t) >= 3) & (F.size(F.split(normalize_ws(F.coalesce(text, F.lit(""))), " ")) <= most_words), F.lit(False))


def reference_entry(line: Column) -> Column:
    """A line of a bibliography: a URL, a DOI, or names with a year."""
    t = F.trim(F.coalesce(line, F.lit("")))
    return t.rlike(r"^https?://") | F.lower(t).rlike(r"doi\.org/|\bdoi: ?10\.") | t.rlike(r"^\[?[0-9]+[.\])] .*(19|20)[0-9]{2}") | t.rlike(r"^[A-Z][a-z]+,? [A-Z]\..*\(?(19|20)[0-9]{2}")


def index_entry(line: Column) -> Column:
    """word, 12, 34: an entry of a back-of-book index."""
    t = normalize_ws(F.coalesce(line, F.lit("")))
    return t.rlike(r"^[A-Za-z][A-Za-z -]*(, ?[0-9]+(-[0-9]+)?)+$") & (F.size(F.split(t, " ")) <= 18)


def page_noise(line: Column) -> Column:
    """Page numbers, rules and running titles of a converted document."""
    t = F.trim(F.coalesce(line, F.lit("")))
    return (t == "") | t.rlike(r"^[-–—_=.· ]{3,}$") | t.rlike(r"^[-–—\[( ]*[0-9]{1,4}[-–—\]) ]*$") | F.lower(t).rlike(r"^page [0-9]+( of [0-9]+)?$|^(vol\.|volume|issue) [0-9]|all rights reserved|^©")


def specific_evidence(text: Column) -> Column:
    """A number beside a unit."""
    return F.lower(F.coalesce(text, F.lit(""))).rlike(NUMBER_UNIT)


def trusted_domain(domain: Column, trusted: list[str]) -> Column:
    """The domain ends like a trusted one."""
    d = F.lower(F.coalesce(domain, F.lit("")))
    return F.exists(F.array(*[F.lit(t.lower()) for t in trusted]).cast("array<string>"), lambda t: F.endswith(d, t))


def url_suffix(url: Column) -> Column:
    """File suffix of a path, '.html' where there is none."""
    s = F.lower(F.regexp_extract(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"/[^/]*(\.[A-Za-z0-9]{1,5})$", 1))
    return F.when(s == "", ".html").otherwise(s)


def redirect_target(url: Column, parameter: str = "uddg") -> Column:
    """The address that a redirect carries in a query parameter, else the address itself."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), rf"[?&]{parameter}=([^&#]+)", 1)
    return F.when(found != "", F.try_url_decode(found)).otherwise(url)
