"""Lines repeated across one site's documents, by distributed PrefixSpan.

The texts of a site are sequences of line identifiers (hash of the letters of a line, lower case).
Level 1 of the pattern growth finds the frequent single lines; a longer pattern is grown from the
occurrences of its prefix by the frequent lines that follow it in the same text (the projected
database). Every level is a DataFrame: support is counted in distinct texts by partial aggregation,
and occurrences are kept only for frequent prefixes, so a site with a third of all texts is spread
over all tasks.

frequent_runs grows patterns by the next frequent line of the text and gives their occurrences; what is found and deleted are the lines
that the occurrences of its patterns, single lines included, cover. A notice of n lines has n (n + 1) / 2 such patterns.
frequent_sequences lists the patterns with any gaps between their lines; a notice has 2^n - 1 of these.

Defined results: null and empty texts have no lines; lines with fewer than min_letters letters are
never found; texts whose address is unknown belong to no site; a text delivered twice (same id)
counts once; ties do not occur; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.hosts import site_of
from claimloom.session import checkpoint

MIN_CLAIMS, MIN_SHARE, MIN_LETTERS = 8, 0.02, 12


def line_sequences(claims: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines: site, claim_id, line_no, line; claims per site: site, site_claims).

    claims: claim_id, claim_text, source_url; sources: source_url (key), source_domain.
    """
    src = sources.select("source_url", site_of(F.col("source_domain")).alias("site")).where("site is not null").dropDuplicates(["source_url"])
    # the few distinct sites make hot keys of none of the joins: the join is on the page's address
    c = claims.join(src, "source_url").select("claim_id", "claim_text", "site")
    per_site = c.groupBy("site", "claim_id").agg(F.lit(1).alias("x")).groupBy("site").agg(F.count("*").alias("site_claims"))
    lines = c.where("claim_text is not null").select("site", "claim_id", F.posexplode(F.split("claim_text", "\n", -1)).alias("pos", "text"))
    letters = F.lower(F.regexp_replace("text", r"[^\p{L}]+", ""))
    lines = lines.select("site", "claim_id", (F.col("pos") + 1).cast("int").alias("line_no"), letters.alias("letters")).where(F.length("letters") >= MIN_LETTERS)
    return lines.select("site", "claim_id", "line_no", F.xxhash64("letters").alias("line")), per_site


def _frequent(keys: DataFrame, cols: list[str], per_site: DataFrame, min_claims: int, min_share: float) -> DataFrame:
    support = keys.groupBy("site", *cols).agg(F.count("*").alias("support")).where(F.col("support") >= min_claims)
    return support.join(per_site, "site").where(F.col("support") >= min_share * F.col("site_claims")).drop("site_claims")


def frequent_lines(lines: DataFrame, per_site: DataFrame, min_claims: int = MIN_CLAIMS, min_share: float = MIN_SHARE) -> DataFrame:
    """Occurrences (site, claim_id, line_no, line) of the frequent single lines: level 1 of the growth."""
    keys = lines.select("site", "line", "claim_id").distinct()
    frequent = _frequent(keys, ["line"], per_site, min_claims, min_share)
    return lines.join(frequent.select("site", "line"), ["site", "line"]).select("site", "claim_id", "line_no", "line").distinct()


def frequent_sequences(lines: DataFrame, per_site: DataFrame, min_claims: int = MIN_CLAIMS, min_share: float = MIN_SHARE) -> DataFrame:
    """All frequent sequences of lines (gaps allowed): site, pattern (array of line ids), support.

    Growth stops when a level has no pattern; no pattern is longer than the lines of a text. A frequent sequence
    of n lines has 2^n - 1 frequent parts, and all are reported.
    """
    occ = checkpoint(frequent_lines(lines, per_site, min_claims, min_share))
    level = occ.groupBy("site", "claim_id", F.array("line").alias("pattern")).agg(F.min("line_no").alias("end"))
    found = None
    while True:
        sup = _frequent(level.select("site", "pattern", "claim_id").distinct(), ["pattern"], per_site, min_claims, min_share)
        level = checkpoint(level.join(sup, ["site", "pattern"]))
        if level.isEmpty():
            break
        here = level.select("site", "pattern", "support").distinct()
        found = here if found is None else found.unionByName(here)
        nxt = occ.select("claim_id", F.col("line_no").alias("n"), F.col("line").alias("l"))
        level = (
            level.drop("support").join(nxt, "claim_id").where(F.col("n") > F.col("end"))
            .groupBy("site", "claim_id", F.concat("pattern", F.array("l")).alias("pattern")).agg(F.min("n").alias("end"))
        )
    return found if found is not None else occ.select("site", F.array("line").alias("pattern"), F.lit(0).cast("bigint").alias("support")).limit(0)


def frequent_runs(lines: DataFrame, per_site: DataFrame, min_claims: int = MIN_CLAIMS, min_share: float = MIN_SHARE) -> DataFrame:
    """Occurrences (site, claim_id, line_no, length, pattern, support) of the frequent patterns without gaps among the frequent lines of a text.

    pattern is a hash of the line ids. Growth by one line a level until a level is empty; a level keeps the occurrences of frequent prefixes only.
    """
    occ = frequent_lines(lines, per_site, min_claims, min_share)
    # of a text the frequent lines in order: bounded by the lines of the text
    texts = occ.groupBy("site", "claim_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("seq"))
    texts = checkpoint(texts)
    level = texts.select("site", "claim_id", "seq", F.posexplode("seq").alias("at", "x")).select("site", "claim_id", "at", "seq", F.xxhash64("x.line").alias("pattern"))
    found, length = None, 1
    while True:
        support = _frequent(level.select("site", "pattern", "claim_id").distinct(), ["pattern"], per_site, min_claims, min_share)
        level = checkpoint(level.join(support, ["site", "pattern"]))
        if level.isEmpty():
            break
        here = level.select("site", "claim_id", F.explode(F.transform(F.slice("seq", F.col("at") + 1, F.lit(length)), lambda x: x["line_no"])).alias("line_no"), F.lit(length).alias("length"), "pattern", "support")
        found = here if found is None else found.unionByName(here)
        level = level.where(F.col("at") + length < F.size("seq")).select("site", "claim_id", "at", "seq", F.xxhash64("pattern", F.get("seq", F.col("at") + length)["line"]).alias("pattern"))
        length += 1
    if found is None:
        return occ.select("site", "claim_id", "line_no", F.lit(0).alias("length"), F.col("line").alias("pattern"), F.lit(0).cast("bigint").alias("support")).limit(0)
    return found


def run_lines(runs: DataFrame) -> DataFrame:
    """claim_id, line_no, longest (the length of the longest frequent pattern that covers the line): once a line."""
    return runs.groupBy("claim_id", "line_no").agg(F.max("length").alias("longest"))


def clean_texts(claims: DataFrame, occurrences: DataFrame) -> DataFrame:
    """claim_id, claim_text without the occurrences; texts without any stay as they are."""
    drop = occurrences.groupBy("claim_id").agg(F.collect_set("line_no").alias("_drop"))
    kept = F.filter(F.split("claim_text", "\n", -1), lambda x, i: ~F.array_contains("_drop", i + 1))
    return claims.dropDuplicates(["claim_id"]).join(drop, "claim_id", "left").select("claim_id", F.when(F.col("_drop").isNull(), F.col("claim_text")).otherwise(F.array_join(kept, "\n")).alias("claim_text"))
