"""Core operators on small fixtures: plain-loop models, nulls, ties, empty tables."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimloom.functions import hosts, keys, text, values
from claimloom.operators import claims as C
from claimloom.operators import corpus as D
from claimloom.operators import ledger as L
from claimloom.operators import relations as R
from claimloom.operators.harmonise_units import harmonise_units

CLAIMS = "claim_id string, parameter_id string, entity_name string, raw_value_text string, numeric_value double, unit string, claim_text string, normalized_numeric_value double"


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr).first()[0]


@pytest.mark.parametrize("host, site", [("WWW.Agro-x.Example:443", "agro-x.example"), ("a.example.", "a.example"), ("https://a.b.example/x", "b.example"), ("  ", None), (None, None), ("localhost", "localhost")])
def test_site(spark, host, site):
    assert one(spark, hosts.site_of(F.col("h")), h=host) == site


def test_keys_and_text(spark):
    assert one(spark, keys.canonical_key(F.col("d"), F.col("u")), d="https://doi.org/10.1/AB", u="x") == "doi:10.1/ab"
    assert one(spark, keys.canonical_key(F.col("d"), F.col("u")), d=None, u="https://www.A.example/P/?q=1") == "url:a.example/p"
    assert one(spark, text.drop_repeated_words(F.col("t")), t="soil Soil  and and water") == "soil and water"
    assert one(spark, text.text_hash(F.col("t")), t="  \n") == ""
    assert one(spark, F.to_json(text.sentences(F.col("t"))), t="One. Two? Three") == '["One.","Two?","Three"]'
    assert one(spark, text.evidence_label(F.col("t")), t="Table 3. x") == "table"
    assert one(spark, values.year_in(F.col("t")), t=None) is None


@pytest.fixture(scope="module")
def dims(spark):
    params = spark.createDataFrame([("t", "celsius"), ("y", "t/ha"), ("d", "cm")], "parameter_id string, common_unit string")
    crops = spark.createDataFrame([("Oats", ["oat"], None, 32.0), ("Wheat", None, ["Triticum aestivum"], 60.0)], "label string, aliases array<string>, scientific_names array<string>, lb_per_bushel double")
    return params, crops


@pytest.mark.parametrize(
    "row, value, source",
    [
        (("t", "x", "50 °F", None, None, None, None), 10.0, "raw_value_text"),
        (("t", "x", "ca. 300.15", 300.15, "K", None, None), 27.0, "unit"),
        (("y", " OAT ", "100 bu/ac", None, None, None, None), 100 * 32 * 0.45359237 / 0.40468564224 / 1000, "raw_value_text"),
        (("y", "unknown crop", "100 bu/ac", None, None, None, None), None, "raw_value_text"),
        (("y", "x", "5,893", 5893.0, None, "kept 5,893 kg/ha there", None), 5.893, "claim_text"),
        (("d", "x", "", 30.2, None, "12 plots; 30,2 in.", None), 76.708, "claim_text"),
        (("d", "x", "4½ in", None, None, None, None), 11.43, "raw_value_text"),
        (("t", "x", "50", 50.0, None, "found 50°F there", None), 10.0, "claim_text"),
        (("t", "x", "50", 50.0, None, "found 50 °F.", None), 10.0, "claim_text"),
        (("d", "x", None, 2.0, None, "a depth of two inch after", None), 5.08, "claim_text"),
        (("d", "x", "two inches", None, None, None, None), 5.08, "raw_value_text"),
        (("d", "x", "10", 10.0, None, "nothing", 25.4), 25.4, "identity"),
        (("d", "x", "10", 10.0, None, None, None), None, "none"),
        (("d", "x", None, None, "cm", None, None), None, None),
        ((None, None, "10 cm", 10.0, "cm", None, None), None, "none"),
    ],
)
def test_units(spark, dims, row, value, source):
    df = spark.createDataFrame([("c", *row)], CLAIMS)
    r = harmonise_units(df, *dims).first()
    assert r["unit_source"] == source
    assert r["value_common"] is None if value is None else r["value_common"] == pytest.approx(value)


def test_units_empty_clashing_and_repeated(spark, dims):
    df = spark.createDataFrame([], CLAIMS)
    assert harmonise_units(df, *dims).count() == 0
    row = ("c", "d", "x", "1 in", None, None, "y" * 100_000, None)
    df = spark.createDataFrame([row, row], CLAIMS).withColumn("unit_name", F.lit("mine")).withColumn("number", F.lit("mine"))
    got = harmonise_units(df, *dims).collect()
    assert len(got) == 2 and {r["unit_name"] for r in got} == {"in"}


def test_units_non_unique_is_flagged(spark, dims):
    # 10 without a unit, normalized 10: only cm fits; normalized 0 fits nothing
    df = spark.createDataFrame([("a", "d", "x", "10", 10.0, None, None, 10.0), ("b", "d", "x", "10", 10.0, None, None, 0.0)], CLAIMS)
    got = {r["claim_id"]: r for r in harmonise_units(df, *dims).collect()}
    assert got["a"]["unit_name"] == "cm" and got["a"]["unit_unique"]
    assert got["b"]["unit_name"] is None and not got["b"]["unit_unique"]


def test_merge_intervals_equals_a_fold(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 30), i, float(lo := rng.randint(0, 12)), float(lo + rng.choice([0, 0, 1, 3]))) for i in range(600)]
    want = {}
    for g, _, lo, hi in rows:
        acc = want.setdefault(g, [])
        for m in acc:
            if max(m[0], lo) <= min(m[1], hi) + 0.5:
                m[0], m[1], m[2] = min(m[0], lo), max(m[1], hi), m[2] + 1
                break
        else:
            acc.append([lo, hi, 1])
    df = spark.createDataFrame(rows, "g int, ord int, lo double, hi double").repartition(5)
    got = {}
    for r in C.merge_intervals(df, ["g"]).orderBy("g", "position").collect():
        got.setdefault(r["g"], []).append([r["lo"], r["hi"], r["members"]])
    assert got == want


def test_conflict_rewrite_equals_pairs(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 80), f"d{rng.randint(0, 2)}", float(lo := rng.randint(0, 6)), float(lo + rng.randint(0, 3))) for _ in range(300)]
    got = {r["g"]: r["conflict"] for r in C.conflict_groups(spark.createDataFrame(rows, "g int, source_domain string, lo double, hi double"), ["g"]).collect()}
    for g in {r[0] for r in rows}:
        m = [r for r in rows if r[0] == g]
        apart = any(max(a[2], b[2]) > min(a[3], b[3]) + 0.5 for a in m for b in m)
        assert got[g] == (apart and len({r[1] for r in m}) > 1)


def test_quota_select_only_selected_rows_use_quota(spark):
    rows = [("r", f"k{i}", 1.0, 2, 10 - i, i, d, p) for i, (d, p) in enumerate([("a", ["x"]), ("a", ["x"]), ("a", ["y"]), ("b", ["x"]), ("b", ["x"]), ("c", ["x", "z"]), (None, [])])]
    df = spark.createDataFrame(rows, "run_id string, canonical_key string, trust double, access_rank int, score int, first_ord int, source_domain string, parameter_ids array<string>")
    got = {r["canonical_key"]: r["fetch_skip_reason"] for r in L.quota_select(df, per_parameter=3, domain_cap=2).collect()}
    assert got == {"k0": "", "k1": "", "k2": "domain_cap", "k3": "", "k4": "saturated", "k5": "", "k6": ""}


def test_ledger_ids_follow_ord(spark):
    df = spark.range(1000).select(F.col("id").alias("ord")).repartition(7)
    got = {r["ord"]: r["ledger_id"] for r in L.with_ids(df, "run").collect()}
    assert [got[i][-6:] for i in (0, 499, 999)] == ["000001", "000500", "001000"]
    assert L.with_ids(df.where("ord < 0"), "run").count() == 0


EFFECTS = [
    ([("a", "beneficial"), ("b", "avoid")], "beneficial", False, True),
    ([("a", "beneficial"), ("a", "avoid"), ("a", "avoid")], "avoid", True, False),
    ([("a", "beneficial"), ("a", "conditional")], "conditional", True, False),
    ([("a", "unknown"), ("b", "avoid")], "avoid", False, False),
    ([("a", "neutral"), ("b", "beneficial")], "neutral", False, False),
    ([("a", "unknown"), ("b", None)], "unknown", False, False),
    ([("nowhere", "compatible"), ("b", "avoid")], "avoid", False, True),
]


@pytest.mark.parametrize("claims, effect, ambiguous, superseded", EFFECTS)
def test_tiered_effect(spark, claims, effect, ambiguous, superseded):
    df = spark.createDataFrame([("k", t, e, i) for i, (t, e) in enumerate(claims)], "key string, tier string, effect string, ord int")
    r = R.tiered_effect(df, spark.createDataFrame([("a", 1), ("b", 2)], "tier string, rank int")).first()
    assert (r["effect"], r["ambiguous"], r["superseded"]) == (effect, ambiguous, superseded)


def test_html_blocks():
    page = "<html><nav>skip me</nav><h1>Title</h1><p>" + "word " * 20 + "<p>short</p><table><tr><th>a<th>b</tr><tr><td>1</td><td>2</td></tr></table><script>x</script>"
    assert [k for k, _ in D.html_blocks(page)] == ["heading", "paragraph", "table"]
    assert D.html_blocks(None) == [] and D.html_blocks("") == []


def test_revision_moves_only_with_content(spark):
    prev = spark.createDataFrame([("a", "x", 3), ("b", "y", 1)], "run_id string, fingerprint string, revision int")
    cur = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "w")], "run_id string, fingerprint string")
    assert {r["run_id"]: r["revision"] for r in D.next_revision(prev, cur).collect()} == {"a": 3, "b": 2, "c": 1}


def test_latest_is_the_last_row(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": ["a", "a", "b"], "at": [1, 2, 1], "v": ["old", "new", "only"]}))
    assert {r["k"]: r["v"] for r in C.latest(df, ["k"], ["at"]).collect()} == {"a": "new", "b": "only"}
