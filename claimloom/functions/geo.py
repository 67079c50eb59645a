"""Places: mentions in text, gazetteer lookups, scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("district", "valley", "plain", "station", "county", "Farm")
#: bytes of aliases (with 100 a row) that are sent to every task; where there are more, both sides of the join are shuffled
SENT_ALIASES = 32_000_000
#: 64-bit words of the bit table of aliases, as a power of two, at most (16 MB); a fuller table lets more runs through, never fewer
TABLE_WORDS = 21
MENTION = r"\b([A-Z][a-z]+(?: [A-Z][a-z]+){0,2}) (?:" + "|".join(KINDS) + r")\b"


def mentions(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, name: capitalised names before a word for a kind of place, each once."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(MENTION), F.lit(1)))
    return df.select(key, F.explode(found).alias("name"))


def unique_places(gazetteer: DataFrame) -> DataFrame:
    """Names that stand for one place only: name (lower case), geo_id."""
    g = gazetteer.where("name is not null and geo_id is not null").select(F.lower(F.trim("name")).alias("name"), "geo_id").distinct()
    return g.groupBy("name").agg(F.count("*").alias("n"), F.min("geo_id").alias("geo_id")).where("n = 1").select("name", "geo_id")


def locate(found: DataFrame, gazetteer: DataFrame, hint: str | None = None) -> DataFrame:
    """geo_id of each mention: by (name, hint) where a hint is known, else by a name that is unique.

    gazetteer: name, geo_id and, for hints, area.
    """
    m = found.withColumn("_n", F.lower(F.trim("name")))
    u = unique_places(gazetteer).select(F.col("name").alias("_n"), F.col("geo_id").alias("_unique"))
    m = m.join(u, "_n", "left")
    if hint:
        exact = gazetteer.select(F.lower(F.trim("name")).alias("_n"), F.col("area").alias(hint), F.col("geo_id").alias("_exact")).dropDuplicates(["_n", hint])
        m = m.join(exact, ["_n", hint], "left").withColumn("geo_id", F.coalesce("_exact", "_unique")).drop("_exact")
    else:
        m = m.withColumnRenamed("_unique", "geo_id").withColumn("_unique", F.lit(None))
    return m.drop("_n", "_unique").withColumn("geo_source", F.when(F.col("geo_id").isNotNull(), "gazetteer").otherwise("missing"))


def scope(level, name, geo_id, lat=None, lon=None):
    """A place as a nested struct, with markers for what is missing."""
    centroid = F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"))) if lat is not None else F.lit(None).cast("struct<lat:double,lon:double>")
    return F.struct(level.alias("level"), name.alias("name"), F.coalesce(geo_id, F.lit("missing")).alias("geo_id"), centroid.alias("centroid"), F.lit("EPSG:4326").alias("coordinate_system"))


# ------------------------------------------------------------ detection by aliases
def alias_dim(places: DataFrame) -> DataFrame:
    """alias, exact, name, level: each place by its name (any letter case) and by its abbreviation (as written). places: name, abbreviation, level; a gazetteer table."""
    by_name = places.where("name is not null").select(F.lower(F.trim("name")).alias("alias"), F.lit(False).alias("exact"), "name", "level")
    by_short = places.where("abbreviation is not null").select(F.trim("abbreviation").alias("alias"), F.lit(True).alias("exact"), "name", "level")
    both = by_name.unionByName(by_short)
    return both.groupBy("alias", "exact").agg(F.min_by("name", F.struct("level", "name")).alias("name"), F.min_by("level", F.struct("level", "name")).alias("level"))


def _place_in_table(h, words: int):
    """at, bits: the word of a hash in a table of so many words (a power of two), and its three bits there."""
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, n).bitwiseAND(F.lit(63)).cast("int")) for n in (40, 46, 52)]
    return h.bitwiseAND(F.lit(words - 1)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def _may_be_alias(h, aliases: DataFrame, count: int):
    """False only where no alias has this hash of its words in lower case; about 1 in 100 others is let through. The table (a Bloom filter, about 16 bits an alias) is one value of a scalar subquery."""
    words = 1 << min(TABLE_WORDS, (count // 4).bit_length())
    at, bits = _place_in_table(F.xxhash64(F.split(F.lower("alias"), " ", -1)), words)
    zeros = aliases.sparkSession.range(words).select(F.col("id").alias("at"), F.lit(0).cast("bigint").alias("bits"))
    table = aliases.select(at.alias("at"), bits.alias("bits")).unionByName(zeros).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    inner = lambda c, f: F.transform(F.array_sort(c), lambda x: x[f])
    blocks = table.groupBy(F.shiftright("at", 10).alias("block")).agg(inner(F.collect_list(F.struct("at", "bits")), "bits").alias("bits"))
    whole = blocks.agg(F.flatten(inner(F.collect_list(F.struct("block", "bits")), "bits")))
    at, bits = _place_in_table(h, words)
    return F.get(whole.scalar(), at.cast("int")).bitwiseAND(bits) == bits


def detect(df: DataFrame, key: list[str], text: str, aliases: DataFrame, longest: int = 4) -> DataFrame:
    """key, name, level: the place with the longest alias in the text, ties to the first position. Word runs are joined with the aliases: no loop over places.

    The runs, many times the text, are never broadcast: the join is hinted by the measured size of the aliases (an estimate from the files would take the runs for the smaller side).
    Where both sides are shuffled, runs that are no alias are left out before by a table of bits; the join decides."""
    size, count = aliases.agg(F.sum(F.lit(100) + F.octet_length("alias") + F.octet_length("name") + F.coalesce(F.octet_length("level"), F.lit(0))), F.count("*")).first()
    sent = (size or 0) <= SENT_ALIASES
    dim = aliases.select("alias", "exact", "name", "level").hint("broadcast" if sent else "merge")
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"([\p{L}\p{N}][\p{L}\p{N}.'-]*)"), F.lit(1))
    clean = F.transform(words, lambda w: F.regexp_replace(w, r"[.'-]+$", ""))
    w = df.select(*key, clean.alias("_w"))
    def of_length(n: int, of):
        starts = F.when(F.size("_w") >= n, F.sequence(F.lit(1), F.size("_w") - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: of(i, F.lit(n)))

    every = lambda of: F.explode(F.concat(*[of_length(n, of) for n in range(1, longest + 1)])).alias("_r")
    run = lambda i, n: F.array_join(F.slice("_w", i, n), " ").alias("run")
    if sent:
        r = w.select(*key, every(lambda i, n: F.struct(i.alias("at"), run(i, n)))).select(*key, "_r.at", "_r.run")
    else:
        low = w.withColumn("_low", F.transform("_w", F.lower))
        hashed = low.select(*key, "_w", every(lambda i, n: F.struct(i.alias("at"), n.alias("n"), F.xxhash64(F.slice("_low", i, n)).alias("h"))))
        r = hashed.where(_may_be_alias(F.col("_r.h"), aliases, count)).select(*key, "_r.at", run(F.col("_r.at"), F.col("_r.n")))
    found = r.withColumn("alias", F.lower("run")).join(dim.where("not exact").drop("exact"), "alias")
    short = r.withColumn("alias", F.col("run")).join(dim.where("exact").drop("exact"), "alias")
    best = F.max_by(F.struct("name", "level", "alias"), F.struct(F.length("alias").alias("n"), (-F.col("at")).alias("p")))
    return found.unionByName(short).groupBy(*key).agg(best.alias("_b")).select(*key, "_b.name", "_b.level", "_b.alias")


def first_scope(df: DataFrame, key: str, fields: list[str], aliases: DataFrame) -> DataFrame:
    """key, field, name, level: the place named in the first of the fields that names one; 'global' where none does."""
    long = df.select(key, F.posexplode(F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])).alias("pos", "_text"))
    hits = detect(long, [key, "pos"], "_text", aliases)
    first = hits.groupBy(key).agg(F.min_by(F.struct("pos", "name", "level"), "pos").alias("_f"))
    names = F.array(*[F.lit(f) for f in fields])
    j = df.select(key).join(first, key, "left")
    return j.select(key, F.coalesce(F.get(names, F.col("_f.pos")), F.lit("default_global")).alias("field"), F.coalesce("_f.name", F.lit("global")).alias("name"), F.coalesce("_f.level", F.lit("global")).alias("level"))


def confidence_of(source, level):
    """How sure an inferred place is, by where it was named (fixed values)."""
    return (
        F.when((level == "global") | (source == "default_global"), "none")
        .when(source.isin("explicit_claim", "explicit_state", "explicit_county", "explicit_region"), "high")
        .when(source.isin("source_title", "raw_snippet", "source_title_context", "source_url"), "medium")
        .when(source.isin("run_context", "source_domain"), "low")
        .otherwise("medium")
    )


def enrich(df: DataFrame, gazetteer: DataFrame, level: str = "level", name: str = "name") -> DataFrame:
    """Adds geo_id, geocode_source, geocode_confidence and coordinate_system of the place; markers where the gazetteer has none. gazetteer: level, name, geo_id."""
    g = gazetteer.where("geo_id is not null").groupBy(F.col("level").alias("_l"), F.lower(F.trim("name")).alias("_n")).agg(F.min("geo_id").alias("_id"))
    j = df.join(g, (F.col(level) == F.col("_l")) & (F.lower(F.trim(F.col(name))) == F.col("_n")), "left")
    world = F.col(level) == "global"
    return j.select(
        *[F.col(c) for c in df.columns],
        F.coalesce("_id", F.when(world, F.lit("global")).otherwise(F.lit(""))).alias("geo_id"),
        F.when(F.col("_id").isNotNull(), "gazetteer").when(world, "not_applicable").otherwise("missing_gazetteer_record").alias("geocode_source"),
        F.when(F.col("_id").isNotNull(), "approximate").otherwise("none").alias("geocode_confidence"),
        F.lit("EPSG:4326").alias("coordinate_system"),
    )


def evidence(claim, source):
    """The two inferences (struct field, level, name, text) as a list of matched places, the whole world aside."""
    named = lambda kind, s: F.struct(F.concat(F.lit(f"{kind}:"), s["field"]).alias("field"), s["level"].alias("level"), s["name"].alias("name"))
    return F.filter(F.array(named("claim_location", claim), named("source_location", source)), lambda x: x["level"] != "global")


def region_evidenced(text, region):
    """Whether a text names the run's own region."""
    return (F.coalesce(region, F.lit("")) != "") & F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(region, F.lit(""))))


def title_names_region(title, region):
    """The same for a title, where the region in the name of its university does not count."""
    t, r = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(region, F.lit("")))
    return region_evidenced(title, region) & ~F.contains(t, F.concat(r, F.lit(" state university")))
