"""Best representative of each duplicate group, built from consistent bundles.

Fields that depend on one another form a bundle (a decision with its confidence, the two geo
evidence fields) and are only taken together from one row. For each group the operator chooses one
candidate per bundle so that the trust is lexicographically greatest, in the order of the
bundles, under functional-dependency constraints: for a constraint x -> y the chosen pair (x, y)
must be a pair that some row of the group shows (a provenance belongs to its source claim, geo evidence to the location it was
found for). The search is branch and bound: bundles are fixed one after another, candidates by falling trust; a branch is cut as
soon as the best completion of its trust vector cannot exceed the best vector found.

What reaches the search is bounded, and no choice is lost. The first bundle is the identity bundle: its trust orders whole
rows, so its winner is the best row of the group, and with it the source claim is fixed. Of the winner's source claim, and of the
whole group, one row is kept for each joint level of all trusts (a tuple over small domains; the newest row, then the smallest id), by
mergeable aggregates, so a group of any size never meets in one task. A pair that a constraint allows stands in one row, and a row
of the same joint level and, for provenance, of the same source claim is at hand.

Defined results: an empty table gives an empty table; nulls in key parts are equal to one another;
ties are broken by the smallest id; a row delivered twice (same id) makes no group of copies; groups
of one row give a survivor too, with has_copies false; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DECISIONS = ("canonical_candidate", "merge_candidate", "regional_observation", "seasonal_observation", "needs_review", "reject")
EMPTY_WORDS = ("n/a", "unknown", "-")
BUNDLES = {
    "identity": ("durable_claim_id", "source_claim_id", "run_id", "status", "promoted_at"),
    "decision": ("promotion_decision", "confidence"),
    "provenance": ("provenance_json",),
    "location": ("location_scope_json",),
    "evidence": ("source_geo_scope_json", "geo_evidence_json"),
}
#: determinant bundle.field -> dependent bundle: the dependent bundle's choice must occur together with the determinant's value
DEPENDENCIES = (("identity", "source_claim_id", "provenance"), ("location", "location_scope_json", "evidence"))


def decision_rank(col: Column) -> Column:
    norm = F.regexp_replace(F.lower(F.trim(col)), r"[\s\-]+", "_")
    pos = F.array_position(F.array(*[F.lit(d) for d in DECISIONS]), norm)
    return F.coalesce(F.when(pos > 0, pos), F.lit(len(DECISIONS) + 1)).cast("int")


def confidence_rank(col: Column) -> Column:
    c = F.lower(F.trim(col))
    return F.when(c == "high", 1).when(c.isin("medium", "med"), 2).when(c == "low", 3).otherwise(4)


def filled_keys(col: Column) -> Column:
    """Top-level keys with a value; 0 for text that is no JSON object (the strict parser rejects cut-off text)."""
    parsed = F.try_variant_get(F.try_parse_json(col), "$", "map<string,variant>")
    text = lambda v: F.trim(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")))
    filled = F.filter(F.map_values(parsed), lambda v: ~(text(v).isin("", "[]") | F.lower(text(v)).isin(*EMPTY_WORDS)))
    return F.coalesce(F.size(F.when(parsed.isNotNull(), filled)), F.lit(0))


def _json(col: str, path: str) -> Column:
    return F.get_json_object(F.col(col), path)


def claim_key(claims: DataFrame, crops: DataFrame) -> DataFrame:
    """Adds the parts of a claim's identity, spelled alike: k_crop, k_geo, k_time, k_value."""
    names = crops.select(F.col("crop_id").alias("_cid"), F.explode(F.array_distinct(F.transform(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("scientific_names", F.array().cast("array<string>"))), lambda n: F.lower(F.trim(n))))).alias("_cname"))
    names = F.broadcast(names.groupBy("_cname").agg(F.min("_cid").alias("_cid")))  # crops: a fixed table of a few rows
    df = claims.join(names, F.lower(F.trim(F.col("entity_name"))) == F.col("_cname"), "left")

    def num(path: str) -> Column:
        # a number and its text are one value; -0 is 0
        v = _json("value_json", path).try_cast("double")
        return F.when(v == 0, F.lit(0.0)).otherwise(v)

    value = F.struct(
        _json("value_json", "$.value_type").alias("value_type"),
        num("$.numeric_value").alias("numeric_value"),
        num("$.range_min").alias("range_min"),
        num("$.range_max").alias("range_max"),
        F.nullif(_json("value_json", "$.text_value"), F.lit("")).alias("text_value"),
        F.nullif(_json("value_json", "$.unit"), F.lit("")).alias("unit"),
    )
    return df.select(
        *[F.col(f"`{c}`") for c in claims.columns],
        F.coalesce("_cid", F.lower(F.trim(F.col("entity_name")))).alias("k_crop"),
        _json("location_scope_json", "$.geo_id").alias("k_geo"),
        _json("time_scope_json", "$.label").alias("k_time"),
        F.to_json(value, {"ignoreNullFields": "false"}).alias("k_value"),
    )


def _search(bundles: list[list[tuple[tuple, str, dict]]], allowed: list[tuple[int, str, int, set]]) -> list[int]:
    """Branch and bound: bundles hold (trust, row token, fields) by falling trust; the indices of the choice.

    allowed: (determinant bundle, field, dependent bundle, pairs seen).
    """
    best: tuple[list[tuple], list[int]] | None = None
    tops = [b[0][0] for b in bundles]

    def go(level: int, trust: list[tuple], chosen: list[int]) -> None:
        nonlocal best
        if best is not None and (trust + tops[level:]) <= best[0]:
            return  # even the best completion gives no more trust
        if level == len(bundles):
            best = (trust, chosen)
            return
        for i, (t, token, _) in enumerate(bundles[level]):
            ok = all((bundles[d][chosen[d]][2].get(f), token) in pairs for d, f, dep, pairs in allowed if dep == level and d < level)
            if ok:
                go(level + 1, trust + [t], chosen + [i])

    go(0, [], [])
    return best[1] if best else []


def best_records(claims: DataFrame, key: list[str], search_limit_levels: int = 4096) -> DataFrame:
    """One surviving record of each group of equal `key`.

    claims needs the columns of BUNDLES. Result: the key, group_rows (rows as delivered), has_copies (two or more
    different ids), rebuilt (the bundles that are better than the best row's own) and the fields of all bundles. search_limit_levels
    bounds the joint trust levels of a group; their domains (7 decisions x 4 confidences x numbers of JSON keys) stay far below
    it, and a group with more raises instead of losing candidates.
    """
    r = (
        claims.select(*key, *[c for cols in BUNDLES.values() for c in cols])
        .withColumn("_d", decision_rank(F.col("promotion_decision")))
        .withColumn("_c", confidence_rank(F.col("confidence")))
        .withColumn("_f", filled_keys(F.col("provenance_json")))
        .withColumn("_l", filled_keys(F.col("location_scope_json")))
        .withColumn("_e", filled_keys(F.col("geo_evidence_json")) + filled_keys(F.col("source_geo_scope_json")))
    )
    at = F.coalesce(F.unix_micros("promoted_at"), F.lit(-(2**62)))
    trusts = ["_d", "_c", "_f", "_l", "_e"]
    keep = F.struct(*[F.col(c) for cols in BUNDLES.values() for c in cols], *trusts, at.alias("_at"))
    newest = F.struct((-at).alias("a"), F.col("durable_claim_id").alias("i"))
    # mergeable and map-side: of each source claim and joint level the newest row, then the smallest id
    level = r.groupBy(*key, F.col("source_claim_id").alias("_x"), *trusts).agg(
        F.min_by(keep, newest).alias("_row"),
        F.min(newest).alias("_new"),
        F.count("*").alias("_n"),
        F.min("durable_claim_id").alias("_lo"),
        F.max("durable_claim_id").alias("_hi"),
    )
    best = F.min(F.struct("_d", "_c", (-F.col("_f")).alias("f"), "_new"))
    claim = level.groupBy(*key, "_x").agg(F.collect_list("_row").alias("_own"), best.alias("_best"), F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    winner = claim.groupBy(*key).agg(F.min_by("_own", "_best").alias("_own"), F.sum("_n").alias("group_rows"), (F.min("_lo") != F.max("_hi")).alias("has_copies"))
    whole = level.groupBy(*key, *trusts).agg(F.min_by("_row", "_new").alias("_row")).groupBy(*key).agg(F.collect_list("_row").alias("_all"))
    names_of = [f"_k{i}" for i in range(len(key))]
    whole = whole.select(*[F.col(k).alias(n) for k, n in zip(key, names_of)], "_all")
    same = F.lit(True)
    for k, n in zip(key, names_of):
        same &= F.col(k).eqNullSafe(F.col(n))  # null parts of a key are equal
    groups = winner.join(whole, same)
    names = [c for cols in BUNDLES.values() for c in cols]
    fields = {f.name: f for f in claims.schema.fields}
    key_types = ", ".join(f"`{k}` {groups.schema[k].dataType.simpleString()}" for k in key)
    out_types = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in names)
    rank = {"identity": lambda x: (-x["_d"], -x["_c"], x["_f"], x["_at"]), "decision": lambda x: (-x["_d"], -x["_c"]), "provenance": lambda x: (x["_f"],), "location": lambda x: (x["_l"],), "evidence": lambda x: (x["_e"],)}

    def solve(own: list[dict], every: list[dict]) -> dict:
        rows = own + every
        if len(rows) > 2 * search_limit_levels:
            raise ValueError("more trust levels than search_limit_levels")
        winner_id = min(own, key=lambda x: (x["_d"], x["_c"], -x["_f"], -x["_at"], x["durable_claim_id"] or ""))
        # the winner's own values come first among equals, then the smallest id
        ids = sorted(rows, key=lambda x: (x is not winner_id, x["durable_claim_id"] or ""))
        bundles, seen = [], []
        for name, cols in BUNDLES.items():
            cands = sorted([winner_id] if name == "identity" else ids, key=rank[name], reverse=True)
            uniq: dict = {}
            for x in cands:
                uniq.setdefault(repr([x[c] for c in cols]), (rank[name](x), repr([x[c] for c in cols]), {c: x[c] for c in cols}))
            bundles.append(list(uniq.values()))
        order_ = list(BUNDLES)
        for det, field, dep in DEPENDENCIES:
            seen.append((order_.index(det), field, order_.index(dep), {(x[field], repr([x[c] for c in BUNDLES[dep]])) for x in rows}))
        choice = _search(bundles, seen)
        merged: dict = {"rebuilt": []}
        for name, b, i in zip(order_, bundles, choice):
            merged |= b[i][2]
            if b[i][0] != rank[name](winner_id):
                merged["rebuilt"].append(name)
        return merged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {k: batch.column(k) for k in [*key, "group_rows", "has_copies"]}
            merged = [solve(own, every) for own, every in zip(batch.column("_own").to_pylist(), batch.column("_all").to_pylist())]
            typ = batch.schema.field("_own").type.value_type
            arrays = [cols[k] for k in cols] + [pa.array([m["rebuilt"] for m in merged], pa.list_(pa.string()))] + [pa.array([m[c] for m in merged], type=typ.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names=[*cols, "rebuilt", *names])

    return groups.select(*key, "group_rows", "has_copies", "_own", "_all").mapInArrow(run, f"{key_types}, group_rows bigint, has_copies boolean, rebuilt array<string>, {out_types}")
