"""Merges, quotas, configuration files, notes and hooks on small fixtures, against plain loops where order decides."""

import json
import random

import pytest
from pyspark.sql import functions as F

from claimloom.functions import geo
from claimloom.operators import corpus, extraction, fetching, lane, ledger
from claimloom.plans import claim_queries
from claimloom.sources import config, sinks


def test_merge_equals_a_plain_loop(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):  # one key holds dozens of claims
        kind = rng.choice(["numeric", "range", "text"])
        lo = rng.randint(0, 30) if kind != "text" else None
        rows.append((rng.choice(["rye", "rye", "oats", None]), "p", i, f"t{rng.randint(0, 5)}", kind, None if lo is None else float(lo), None if lo is None else float(lo + (rng.randint(0, 3) if kind == "range" else 0)), [f"u{rng.randint(0, 9)}"]))
    df = spark.createDataFrame(rows, "entity_name string, parameter_id string, ord long, claim_text string, value_type string, lo double, hi double, source_urls array<string>")
    got = {r["claim_id"]: r for r in extraction.merged(df.repartition(5), "r", ["entity_name", "parameter_id"]).collect()}
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    want = []
    for key, members in groups.items():
        texts, numbers = [], []
        for _, _, i, text, kind, lo, hi, urls in members:
            if kind == "text":
                hit = next((t for t in texts if t[0] == text), None)
                if hit is None:
                    texts.append([text, 1, list(urls)])
                else:
                    hit[1] += 1
                    hit[2] += [u for u in urls if u not in hit[2]]
        for _, _, i, text, kind, lo, hi, urls in members:
            if kind == "text":
                continue
            hit = next((x for x in numbers if max(x[1], lo) <= min(x[2], hi) + 0.5), None)
            if hit is None:
                numbers.append([text, lo, hi, 1, list(urls)])
            else:
                hit[1], hit[2], hit[3] = min(hit[1], lo), max(hit[2], hi), hit[3] + 1
                hit[4] += [u for u in urls if u not in hit[4]]
        want += [(key, t, None, None, n, u) for t, n, u in texts] + [(key, t, lo, hi, n, u) for t, lo, hi, n, u in numbers]
    assert len(got) == len(want)
    for i, (key, text, lo, hi, n, urls) in enumerate(want, 1):
        r = got[f"r-llm-claim-{i:04d}"]
        assert (r["entity_name"], r["claim_text"], r["lo"], r["hi"], r["members"]) == (key, text, lo, hi, n) and r["source_urls"] == urls
    assert extraction.merged(df.limit(0), "r", ["entity_name", "parameter_id"]).count() == 0


def test_pair_quota_equals_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [("r", f"k{i}", rng.choice(["a.example", "b.example", "x.trusted.example"]), f"p{rng.randint(0, 6)}", rng.choice([0.5, 0.9]), rng.randint(0, 2), rng.randint(0, 9), i) for i in range(120)]
    df = spark.createDataFrame(rows, "run_id string, relationship_source_key string, source_domain string, pair_key string, trust double, access_rank int, score int, first_ord long")
    got = {r["relationship_source_key"]: r["fetch_skip_reason"] for r in lane.pair_quota(df, 4, 9, ("trusted.example",), 50).collect()}
    domains, pairs = {}, {}
    for _, k, d, p, *_ in sorted(rows, key=lambda r: (-r[4], -r[5], -r[6], r[7])):
        cap = 50 if d.endswith("trusted.example") else 9
        why = "domain_cap" if domains.get(d, 0) >= cap else "pair_mode_saturated" if pairs.get(p, 0) >= 4 else ""
        if not why:
            domains[d], pairs[p] = domains.get(d, 0) + 1, pairs.get(p, 0) + 1
        assert got[k] == why


def test_group_bases_in_order_and_symmetric_modes(spark):
    nodes = spark.createDataFrame([("a", "fa", "ga", ["x", "y"]), ("b", "fb", "gb", ["y"]), ("c", None, "", None)], "node string, botanical_family string, genus string, functional_groups array<string>")
    edges = spark.createDataFrame([("aggregate", "rotation", "x", "y", "avoid", "t", 1), ("aggregate", "rotation", "ga", "gb", "beneficial", "t", 2), ("direct", "inter", "a", "b", "conditional", "t", 3)], "kind string, mode string, subject string, object string, effect string, tier string, ord long")
    ranks = spark.createDataFrame([("t", 1)], "tier string, rank int")
    asked = spark.createDataFrame([("rotation", "a", "b"), ("inter", "b", "a"), ("rotation", "b", "a"), ("rotation", "a", "c")], "mode string, subject string, object string")
    got = {(r["mode"], r["subject"], r["object"]): (r["status"], r["inference_basis"], r["effect"]) for r in lane.resolve(asked, edges, lane.memberships(nodes), ranks, ("inter",)).collect()}
    assert got[("rotation", "a", "b")] == ("inferred_from_group", "genus", "beneficial")  # before the functional groups
    assert got[("inter", "b", "a")] == ("direct_evidence", "", "conditional")
    assert got[("rotation", "b", "a")] == ("no_evidence", "", "unknown") and got[("rotation", "a", "c")][0] == "no_evidence"


def test_graph_counts_an_id_once(spark):
    end = "struct<type:string,id:string>"
    rows = [("1", "accepted", "m", ("crop", "a"), ("crop", "b"), "avoid", "t", 1), ("1", "accepted", "m", ("crop", "a"), ("crop", "b"), "beneficial", "t", 2), (None, "accepted", "m", ("host_group", "h"), ("crop", "b"), "avoid", "t", 3), ("2", "rejected", "m", ("crop", "a"), ("crop", "b"), "avoid", "t", 4), ("3", "accepted", "m", None, ("crop", "b"), "avoid", "t", 5)]
    df = spark.createDataFrame(rows, f"claim_id string, status string, mode string, subject {end}, object {end}, effect string, tier string, ord long")
    assert {(r["kind"], r["effect"]) for r in lane.graph(df).collect()} == {("direct", "avoid"), ("host", "avoid")}
    with pytest.raises(ValueError):
        lane.pair_mode(df, "both")


def test_numbering_and_sequence_of_a_hot_key(spark):
    rows = [("hot", i) for i in range(500)] + [("b", 1000), ("b", 1001), ("c", 2000)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long").repartition(7)
    got = sorted((r["k"], r["o"], r["position"], r["previous"]) for r in ledger.sequence(df, "k", "o").collect())
    want, last, n = [], {}, {}
    for k, o in sorted(rows):
        n[k] = n.get(k, 0) + 1
        want.append((k, o, n[k], last.get(k)))
        last[k] = o
    assert got == want
    assert sorted(r["i"] for r in ledger.numbered(df, ["o"], "i").collect()) == list(range(1, 504))


def test_fingerprint_is_of_the_rows_not_their_order(spark):
    df = spark.createDataFrame([("r", 1, "a"), ("r", 2, None), (None, 3, "c")], "run_id string, doc_id long, h string")
    a, b = (dict(corpus.fingerprint(x, "doc_id", ["h"]).select("run_id", "fingerprint").collect()) for x in (df, df.orderBy(F.desc("doc_id"))))
    assert a == b and len(a) == 2
    twice = dict(corpus.fingerprint(df.unionByName(df), "doc_id", ["h"]).select("run_id", "fingerprint").collect())
    assert twice["r"] != a["r"]


def test_configuration_files(spark, tmp_path):
    w = lambda name, x: (tmp_path / name).write_text(json.dumps(x)) and str(tmp_path / name)
    (tmp_path / "runs").mkdir()
    w("runs/a.json", {"run_id": "r1", "crop": "rye", "parameter_ids": ["p"]})
    assert config.run_config(spark, str(tmp_path / "runs"), "r1")["crop"] == "rye" and config.run_config(spark, str(tmp_path / "runs"), "r2", required=False) is None
    with pytest.raises(KeyError):
        config.run_config(spark, str(tmp_path / "runs"), "r2")
    p = w("p.json", {"parameters": [{"parameter_id": "p"}, {"parameter_id": "q", "status": "retired"}]})
    assert config.parameter_manifest(spark, p).count() == 2 and [r[0] for r in config.active_parameter_ids(spark, p).collect()] == ["p"]
    assert config.active_parameter_ids(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(ValueError):
        config.parameter_manifest(spark, w("p2.json", {"parameters": [{"parameter_id": "p"}, {"parameter_id": "p"}]}))
    v = config.vocabulary(spark, w("v.json", {"modes": [{"mode_id": "m"}, {"mode_id": "n"}], "default_modes": ["n"]}))
    assert {r["mode_id"]: r["is_default"] for r in v.collect()} == {"m": False, "n": True}
    with pytest.raises(ValueError):
        config.vocabulary(spark, w("v2.json", {"modes": [{"mode_id": "m"}], "default_modes": ["x"]}))
    n = w("n.json", {"nodes": [{"node_type": "genus", "node_id": "g"}, {"node_type": "crop", "node_id": "c"}]})
    assert [r["node_id"] for r in config.aggregate_nodes(spark, n, ("genus",)).collect()] == ["g"]
    with pytest.raises(ValueError):
        config.aggregate_nodes(spark, n, ("family",))
    assert config.query_templates(spark, str(tmp_path / "none.json")).count() == 0
    assert config.query_templates(spark, w("t.json", {"templates": {"p": ["a", "b"]}})).count() == 2
    s = config.seed_registry(spark, w("s.json", {"seeds": [{"seed_id": "1", "url": "u", "crops": ["rye"], "parameter_ids": ["p"]}, {"seed_id": "2", "url": "x", "crops": ["oats"], "parameter_ids": ["p"]}]}))
    assert [r["url"] for r in config.seeds_for_run({"crop": "rye", "parameter_ids": ["p"]}, s).collect()] == ["u"]
    assert [r["url"] for r in config.seeds_for_run({"seeds": [{"url": "own", "parameter_ids": []}]}, s).collect()] == ["own"]
    (tmp_path / "cache").mkdir()
    w("cache/doc-1.json", {"claims": [{"parameter_id": "p", "numeric_value": 2.0}]})
    w("cache/doc-2.json", {"claims": []})
    assert {(r["document_id"], r["parameter_id"]) for r in config.extraction_cache(spark, str(tmp_path / "cache")).collect()} == {("doc-1", "p"), ("doc-2", None)}
    assert config.extraction_cache(spark, str(tmp_path / "gone")).count() == 0
    assert config.schema("schemas/run.schema.json")["run_id"].dataType.simpleString() == "string"


def test_notes_and_hooks(spark):
    store = {"a.md": "mine", "b.md": f"{sinks.MARKER}\nold"}
    df = spark.createDataFrame([("a.md", "new"), ("b.md", "new"), ("c.md", "new")], "path string, note string")
    assert sinks.commit_notes(df, store.get, store.__setitem__, dry=True) == {"written": 2, "foreign": 1} and store["b.md"].endswith("old")
    assert sinks.commit_notes(df, store.get, store.__setitem__)["foreign"] == 1 and store == {"a.md": "mine", "b.md": "new", "c.md": "new"}
    seen = []
    rows = sinks.run_actions([("start", {"x": 1}), ("gone", {})], {"start": [("log", seen.append), ("bad", lambda p: 1 / 0), ("log", seen.append)]})
    assert [r["error"] != "" for r in rows] == [False, True, False] and seen == [{"x": 1}] * 2
    assert not sinks.write_jdbc(df, None, "t")


def test_places_by_alias_and_abbreviation(spark):
    places = spark.createDataFrame([("Iona", "IO", "state"), ("West Iona", None, "region")], "name string, abbreviation string, level string")
    al = geo.alias_dim(places)
    df = spark.createDataFrame([(1, "in west iona, early"), (2, "grown in IO."), (3, "io moons"), (4, None), (5, "Iona and West Iona")], "k int, t string")
    assert {r["k"]: r["name"] for r in geo.detect(df, ["k"], "t", al).collect()} == {1: "West Iona", 2: "Iona", 5: "West Iona"}


def test_word_runs_are_never_broadcast(spark, tmp_path, monkeypatch):
    texts, names = str(tmp_path / "t"), str(tmp_path / "n")
    spark.createDataFrame([(k, f"trial {k} near west place{k % 7}, plot {k}", "x") for k in range(200)], "k int, t string, u string").write.parquet(texts)
    spark.createDataFrame([(f"West Place{k}", None, "region") for k in range(5)], "name string, abbreviation string, level string").write.parquet(names)
    al = geo.alias_dim(spark.read.parquet(names))
    want = {k: f"West Place{k % 7}" for k in range(200) if k % 7 < 5}
    for bound, join in ((10_000, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(geo, "SENT_ALIASES", bound, raising=False)
        got = geo.detect(spark.read.parquet(texts), ["k"], "t", al)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "BuildLeft" not in plan and ("BroadcastExchange" in plan) == (bound > 0)
        assert {r["k"]: r["name"] for r in got.collect()} == want


@pytest.mark.parametrize("name", ["detected_regions", "source_scopes"])
def test_place_queries_send_the_aliases_only(spark, name):
    plan = claim_queries.QUERIES[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


def shuffled_rows(plan):
    """Rows written by the exchanges of a plan that ran."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled_rows(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return shuffled_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(shuffled_rows(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.mark.parametrize("words", [21, 0])
def test_runs_that_are_no_alias_are_not_shuffled(spark, monkeypatch, words):
    monkeypatch.setattr(geo, "SENT_ALIASES", 0)
    monkeypatch.setattr(geo, "TABLE_WORDS", words, raising=False)
    places = spark.createDataFrame([(f"Öst Place{k}", None, "region") for k in range(3000)] + [("Iona", "IO", "state"), ("ΟΔΟΣ ΑΣ", None, "region")], "name string, abbreviation string, level string")
    texts = spark.createDataFrame([(k, f"trial {k} of the rye near ÖST place{k}. and of the oats by the old mill, sown late") for k in range(0, 6000, 10)] + [(-1, "grown in IO."), (-2, "io moons"), (-3, None), (-4, ""), (-5, "by ΟΔΟΣ ας.")], "k int, t string")
    got = geo.detect(texts, ["k"], "t", geo.alias_dim(places))
    assert {r["k"]: (r["name"], r["alias"]) for r in got.collect()} == {k: (f"Öst Place{k}", f"öst place{k}") for k in range(0, 3000, 10)} | {-1: ("Iona", "IO"), -5: ("ΟΔΟΣ ΑΣ", "οδος ας")}
    n = shuffled_rows(got._jdf.queryExecution().executedPlan())
    # 600 texts of 18 words, thus 39,600 runs for either join; a table of one word is full and keeps nothing out
    assert (n < 18_000) if words else (n > 60_000)


def test_organisms_and_bounds(spark):
    df = spark.createDataFrame([([" aphid ", "", '{"name": "rust", "role": "pathogen"}'], "12"), (["", None], "9999"), (None, "x")], "o array<string>, n string")
    got = df.select(extraction.organisms(F.col("o")).alias("o"), extraction.whole_number(F.col("n"), 0, 99).alias("n")).collect()
    assert [(x["name"], x["role"]) for x in got[0]["o"]] == [("aphid", "unspecified"), ("rust", "pathogen")] and got[1]["o"] is None and got[2]["o"] is None
    assert [r["n"] for r in got] == [12, None, None]


def test_captures_fall_back_to_metadata(spark):
    q = spark.createDataFrame([(1, "u1", "open_full_text", {"p": "q", "r": None}), (2, "u2", "open_full_text", {"p": "q"}), (3, "u1", "metadata_only", {"p": "q"})], "ord long, source_url string, access_status string, parameters map<string,string>")
    answers = spark.createDataFrame([("u1", "word " * 100, "text/html", None)], "url string, text string, content_type string, error string")
    caps = fetching.captures(q, fetching.salvaged(fetching.fetched(fetching.urls_once(q), lambda urls: answers)), "run").collect()
    assert sorted((r["ord"], r["status"]) for r in caps) == [(1, "parsed"), (1, "parsed"), (2, "captured"), (3, "captured")]


def test_sections_anchors_captions_and_date():
    page = "<head><meta property='article:published_time' content='2021-02-03'></head><h1 id='a'>One</h1><p>" + "x" * 50 + "</p><h2>Two & Three</h2><table><caption>Yields</caption><tr><td>a</td></tr><tr><td>b</td></tr></table><p>short</p>"
    got = corpus.html_sections(page)
    assert [(k, s, n, a, c) for k, _, s, n, a, c, _ in got] == [("heading", "One", 1, "a", ""), ("paragraph", "One", 1, "a", ""), ("heading", "Two & Three", 2, "two-three", ""), ("table", "Two & Three", 2, "two-three", "Yields")]
    assert {x[-1] for x in got} == {"2021-02-03"} and corpus.html_sections(None) == [] and len(corpus.html_sections("<p>" + "y" * 60)) == 1
