"""The llm operators: brute force, exact round trips, and the defined edge cases."""

import base64
import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimloom.llm import batch_index, best_record, contributor_cap, new_batches, packing, scan_noise, site_lines, stuffed_pages, tokenizer, truncation
from claimloom.llm.boost import BoostedTrees
from claimloom.llm.small_world import SIGNATURE, Graph, Segments, distances, tuned_beam

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = os.path.exists(tokenizer.VOCABULARY)


# ---------------------------------------------------------------- 1
DURABLE = "durable_claim_id string, source_claim_id string, run_id string, status string, promoted_at timestamp, promotion_decision string, confidence string, provenance_json string, location_scope_json string, source_geo_scope_json string, geo_evidence_json string, k string"


def durable(spark, rows):
    full = [(i, f"s-{i}", "r", "x", None, dec, conf, prov, None, None, None, k) for i, dec, conf, prov, k in rows]
    return spark.createDataFrame(full, DURABLE)


def test_best_record_order_and_copies(spark):
    rows = [
        ("a", "reject", "high", '{"x": 1, "y": 2}', "g1"), ("b", "Canonical Candidate", "low", None, "g1"), ("c", "canonical-candidate", "MED", '{"x": "n/a", "y": []}', "g1"), ("d", "canonical_candidate", "medium", '{"x": 1}', "g1"),
        ("e", None, None, "{broken", "g2"), ("f", None, "unknown", "", "g2"), ("h", "reject", None, None, "g3"), ("h", "reject", None, None, "g3"), ("i", "reject", None, None, None), ("j", "reject", None, None, None),
    ]
    got = {r["k"]: r for r in best_record.best_records(durable(spark, rows), ["k"]).collect()}
    assert got["g1"]["durable_claim_id"] == "d" and got["g1"]["has_copies"]
    assert got["g1"]["provenance_json"] == '{"x": 1}'
    assert got["g2"]["durable_claim_id"] == "e" and got["g2"]["has_copies"]
    assert not got["g3"]["has_copies"] and got["g3"]["group_rows"] == 2
    assert got[None]["durable_claim_id"] == "i"
    assert best_record.best_records(durable(spark, []), ["k"]).count() == 0


def test_best_record_keeps_every_candidate_a_constraint_needs(spark):
    rich, thin = '{"x": 1, "y": 2, "z": 3}', '{"x": 1}'
    row = lambda i, x, dec, prov, at, k, loc=None, geo=None: (i, x, "r", "s", at, dec, "high", prov, loc, None, geo, k)
    old, new = "2020-01-01 00:00:00", "2021-01-01 00:00:00"
    rows = [row("A", "s1", "canonical_candidate", thin, old, "g"), row("B", "s1", "merge_candidate", rich, old, "g"), row("C", "s2", "merge_candidate", rich.replace("3", "4"), new, "g")]
    # the fullest location has no evidence of its own with many keys; evidence of another location may not be taken
    rows += [row("D", "s1", "reject", thin, old, "h", '{"geo_id": 1, "name": "a", "lat": 2}', '{"m": 1}'), row("E", "s1", "reject", None, old, "h", '{"geo_id": 1}', '{"m": 1, "n": 2, "o": 3}'), row("F", "s1", "reject", None, old, "h", '{"geo_id": 1, "name": "b", "lat": 2}', '{"m": 1, "n": 2}')]
    df = spark.createDataFrame(rows, DURABLE.replace("promoted_at timestamp", "promoted_at string")).withColumn("promoted_at", F.to_timestamp("promoted_at"))
    got = {r["k"]: r for r in best_record.best_records(df, ["k"]).collect()}
    assert got["g"]["durable_claim_id"] == "A" and got["g"]["provenance_json"] == rich and got["g"]["rebuilt"] == ["provenance"]
    assert got["h"]["durable_claim_id"] == "D" and '"b"' in got["h"]["location_scope_json"] and got["h"]["geo_evidence_json"] == '{"m": 1, "n": 2}' and got["h"]["rebuilt"] == ["evidence"]


def test_search_is_the_best_of_all_choices():
    rng = random.Random(1)
    for _ in range(60):
        bundles = [sorted(((rng.randint(0, 5),), f"{b}{i}", {"f": rng.randint(0, 2)}) for i in range(4)) for b in range(3)]
        bundles = [sorted(b, key=lambda x: x[0], reverse=True) for b in bundles]
        pairs = {(rng.randint(0, 2), f"2{i}") for i in range(4) for _ in range(2)}
        import itertools

        legal = [c for c in itertools.product(range(4), repeat=3) if (bundles[0][c[0]][2]["f"], bundles[2][c[2]][1]) in pairs]
        got = best_record._search(bundles, [(0, "f", 2, pairs)])
        if legal:
            value = lambda c: [bundles[b][i][0] for b, i in enumerate(c)]
            assert value(got) == max(map(value, legal))
        else:
            assert got == []


# ---------------------------------------------------------------- 2
def test_cap_equals_ranking(spark):
    rng = random.Random(2)
    tiers = spark.createDataFrame([("t_one", "T one", 2), ("unclassified", "Unclassified", 1)], "tier_id string, label string, domain_cap int")
    rows = [(i, rng.choice(["r", None]), rng.choice(["A.b.example", "www.b.example:80", "c.example", None, " "]), rng.choice(["T-ONE", "t one", "", None, "?"]), rng.choice([0.1, 0.2, None, float("nan")])) for i in range(400)]
    schema = "doc_id long, run_id string, source_domain string, source_tier_id string, quality_score double"
    got = {r["doc_id"] for r in contributor_cap.beyond_cap(contributor_cap.prepare_contributors(spark.createDataFrame(rows + rows[:50], schema).repartition(6), tiers)).collect()}
    groups = {}
    for i, run, host, tier, q in rows:
        if host and host.strip():
            t = "t_one" if (tier or "").lower().replace("-", "").replace(" ", "").replace("_", "") == "tone" else "unclassified"
            s = ".".join(host.lower().split(":")[0].split(".")[-2:])
            groups.setdefault((run, s, t), []).append((q is None or q != q, -(q or 0) if q == q else 0, i))
    want = {i for (_, _, t), m in groups.items() for *_, i in sorted(m)[{"t_one": 2, "unclassified": 1}[t] :]}
    assert got == want
    assert contributor_cap.beyond_cap(contributor_cap.prepare_contributors(spark.createDataFrame([], schema), tiers)).count() == 0


# ---------------------------------------------------------------- 3
def scanned(spark, n=400):
    rng = random.Random(5)
    places = ["Norby", "Tarrick", "Elmoor", "Wescot"]
    base = lambda: f"The grain yield of barley near {rng.choice(places)} was {rng.randint(1, 99)} in the second season. Plots with clover gave higher canopy temperature than others."
    rows = [(f"c{i}", base(), None) for i in range(n)]
    bad = {"x1": "The grairi yield of barley near Norby was 9 in the second season.", "x2": "Plots with clover gave higher can-\nopy temperature than others.", "x3": "The grain yield of barley near Norby\n- 17 -\nwas 9 in the second season.", "x4": "Plots with clovcr gave higher cctnopy temperature."}
    rows += [(k, v, " ") for k, v in bad.items()]
    rows += [(f"m{i}", f"The qrain yield of bctrley was {i} in the seconcl season.\nPlots wifh clover gave biqher canopy temperafure.", None) for i in range(3)]
    rows += [("ok1", "The grain yield was 3.\nPlots with clover gave higher yield.", ""), ("ok2", "- The grain yield was 3.\n- Plots gave more.", None), ("n", None, None)]
    return spark.createDataFrame(rows, "claim_id string, claim_text string, evidence_text string")


def test_scan_noise_parted_words_and_furniture(spark):
    got = {r["claim_id"]: r for r in scan_noise.repair_texts(scanned(spark)).collect()}
    assert got["x2"]["parted"] == 1 and got["x2"]["repaired"].startswith("Plots with clover gave higher canopy temperature")
    assert got["x3"]["furniture"] == 1 and "17" not in got["x3"]["repaired"]
    assert got["ok1"]["parted"] + got["ok1"]["furniture"] + got["ok1"]["misread"] == 0
    assert got["ok2"]["parted"] + got["ok2"]["furniture"] == 0
    assert "n" not in got


def test_scan_noise_empty(spark):
    assert scan_noise.repair_texts(spark.createDataFrame([], "claim_id string, claim_text string, evidence_text string")).count() == 0


def test_ranker_on_made_misreadings():
    rng = random.Random(14)
    letters = "abdefghimnoprstuvwy"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 9))): rng.randint(20, 5000) for _ in range(3000)}
    ops = [("e", "c", 400, 0, 900, 10**6), ("n", "ri", 300, 0, 700, 10**6), ("o", "a", 4, 40, 30, 10**6)]
    model, held = scan_noise.fit_ranker(words, sorted(words), ops)
    assert held["cases"] > 300 and held["right"] >= 0.9 * held["cases"] and held["wrong"] <= 0.02 * held["right"]
    assert scan_noise.fit_ranker({}, [], ops)[1]["cases"] == 0


def test_a_cut_off_word_is_not_misread():
    lines = scan_noise.Lines(set(), set(), {"filling", "long", "water"})
    r = scan_noise.Repairer(lines, {"fil": "fit", "wctter": "water", "Yorit": "Yoria"}, BoostedTrees(), BoostedTrees())
    assert r.reword("The grain was fil")[1] == r.reword("The grain was fil…")[1] == r.reword("Seen at Yorit")[1] == r.reword("The grain was fil [more]")[1] == 0
    assert r.reword("The wctter was fil.") == ("The water was fit.", 2) and r.reword("There is wctter") == ("There is water", 1)


def test_replacements_in_parts_are_the_same(spark, monkeypatch):
    df = scanned(spark, 600)
    whole = {tuple(r) for r in scan_noise.repair_texts(df).collect()}
    monkeypatch.setattr(scan_noise, "FIX_PART", 2)
    assert {tuple(r) for r in scan_noise.repair_texts(df).collect()} == whole


def test_alignment_of_misread_words():
    assert scan_noise.align("grairi", "grain") == ("n", "ri", 4)
    assert scan_noise.align("cctnopy", "canopy") == ("a", "ct", 1)


def test_boosted_trees_held_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = BoostedTrees(rounds=40).fit(x[:1000], y[:1000])
    assert ((model.predict(x[1000:]) > 0.5) == y[1000:]).mean() > 0.95
    assert BoostedTrees().fit(np.zeros((0, 3)), np.zeros(0)).predict(np.zeros((2, 3))).shape == (2,)
    assert BoostedTrees().fit(np.ones((5, 1)), np.ones(5)).predict(np.ones((1, 1)))[0] > 0.9


# ---------------------------------------------------------------- 4
def brute_common(a, b):
    t = [0] * (len(b) + 1)
    for x in a:
        row = t[:]
        for j, y in enumerate(b):
            t[j + 1] = row[j] + 1 if x == y else max(row[j + 1], t[j])
    return t[-1]


def test_common_words_equals_dynamic_programming():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(0, 25)), rng.integers(0, 6, rng.integers(0, 25))
        assert new_batches.common_words(a, b) == brute_common(a.tolist(), b.tolist())


def test_graph_finds_planted_neighbours():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (1500, SIGNATURE), dtype=np.uint8)
    copies = base[:300].copy()
    copies[:, :4] = rng.integers(0, 256, (300, 4), dtype=np.uint8)
    codes = lambda x: np.ascontiguousarray(x).view(np.uint64)
    keys = np.arange(1500)
    g = Graph(codes(base), keys, keys)
    node, dist = g.search(codes(copies), np.arange(300), 8)
    assert (node[:, 0] == np.arange(300)).mean() >= 0.99 and dist[:, 0].max() <= 4
    q, n = g.exhaustive(codes(copies[:20]), 4)
    assert set(zip(q, n)) >= {(i, i) for i in range(20)}
    s = Segments()
    for i in range(9):
        s.add(Graph(codes(base[i * 100 : i * 100 + 100]), keys[:100], keys[i * 100 : i * 100 + 100]))
    assert sum(len(h.ids) for *_, h in s.graphs) == 900 and len(s.graphs) < 9
    assert distances(codes(base[:1]), codes(base[:1])).tolist() == [0]


def test_duplicates_small(spark):
    words = lambda seed, n=60: " ".join(random.Random(seed).choice(["soil", "grain", "field", f"w{k}"]) + str(k * seed % 97) for k in range(n))
    t = words(3)
    rows = [
        (1, 0, t, None, "https://www.A.example/x/?utm_source=z", None, "a.example"), (2, 1, t.replace(" ", "  ") + "\n", None, None, None, "a.example"), (3, 1, words(5), "AB" * 32, None, None, None), (4, 2, words(7), "ab" * 32, None, None, None),
        (5, 2, None, "", "http://a.example/x#top", None, None), (6, 2, words(11), None, "https://a.example/", "10.99999/xxxx", None), (7, 3, words(13), None, "https://a.example", "10.99999/xxxx", None),
        (8, 3, words(17), None, None, "doi:10.5/AB.", None), (9, 4, words(19), None, None, "https://doi.org/10.5/ab", None), (10, 4, t.replace("soil", "earth", 1), None, None, None, "b.example"), (11, 4, "", None, None, None, None), (12, 5, " ", None, None, None, None),
        (13, 5, words(23), new_batches.EMPTY_SHA, None, None, None), (14, 6, words(29), new_batches.EMPTY_SHA, None, None, None),
    ]
    schema = "doc_id long, batch_no int, text string, content_hash string, canonical_url string, doi string, source_domain string"
    rows[7] = (8, 3, words(17), None, None, "doi:10.555/AB.", None)
    rows[8] = (9, 4, words(19), None, None, "https://doi.org/10.555/ab", None)
    got = {tuple(r) for r in new_batches.duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, 2), (1, 5), (1, 10), (3, 4), (8, 9)}
    assert new_batches.duplicates(spark.createDataFrame([], schema)).count() == 0


def test_a_much_copied_text(spark):
    rng = random.Random(12)
    text = [f"{rng.choice('abcdefgh')}{i}" for i in range(80)]
    rows = []
    for i in range(120):
        words = [*text[:40], f"x{i}", *text[41:]] if i % 2 else [f"y{rng.randint(0, 10**6)}" for _ in range(60)]
        rows.append((i, i // 10, " ".join(words), None, None, None, "a.example"))
    df = spark.createDataFrame(rows, "doc_id long, batch_no int, text string, content_hash string, canonical_url string, doi string, source_domain string")
    assert {tuple(r) for r in new_batches.duplicates(df).collect()} == {(1, i) for i in range(11, 120, 2)}


def test_hot_route_values_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(new_batches, "SHARD_ROWS", 40)
    base = np.arange(SIGNATURE, dtype=np.uint8)
    rows = [(i, i % 3, bytes(base), 0, 7, 9) for i in range(200)] + [(1000 + i, 0, bytes(np.roll(base, i + 1)), 0, 100 + i, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, batch_no int, signature binary, route int, value long, next_value long")
    split = new_batches._split_hot(df)
    assert split.where("doc_id >= 1000").count() == 30 and split.where("doc_id < 200").count() == 200 - new_batches.PIVOTS + new_batches.PIVOTS * 5
    assert split.groupBy("value", "salt").count().agg(F.max("count")).first()[0] < 120
    groups = {tuple(r) for r in new_batches.closed_groups(new_batches.candidates(df)).select("doc_id", "first").collect()}
    assert groups == {(i, 0) for i in range(1, 200)}


def test_near_copies_of_a_template_share_a_route(spark):
    # most words are the template's, and all edits of a near-copy fall among the few that are not
    rng = random.Random(8)
    template = [f"t{i}" for i in range(100)]
    at, rows = range(4, 100, 8), []
    for i in range(200):
        words = list(template)
        for j in at:
            words[j] = f"v{rng.randint(0, 10**9)}"
        copy = list(words)
        for j in rng.sample(at, 9):
            copy[j] = f"w{rng.randint(0, 10**9)}"
        rows += [(2 * i, 0, 1, " ".join(words)), (2 * i + 1, 1, 1, " ".join(copy))]
    tokens = new_batches.tokenise(spark.createDataFrame(rows, "doc_id long, batch_no int, site long, text string"))
    common, own, _ = new_batches.common_buckets(tokens)
    seen = new_batches.signatures(tokens, common, own).select("doc_id", "route", "value").toPandas()
    routes = {d: set(zip(g["route"], g["value"])) for d, g in seen.groupby("doc_id")}
    assert sum(bool(routes[2 * i] & routes[2 * i + 1]) for i in range(200)) >= 190


def test_a_near_copy_among_many_siblings(spark):
    # more siblings than a beam holds are as near as the partner by signature, but no near-copies by their words
    rng = random.Random(9)
    template, at, rows = [f"t{i}" for i in range(100)], range(4, 100, 8), []
    for i in range(300):
        words = list(template)
        for j in at:
            words[j] = f"v{rng.randint(0, 10**9)}"
        copy = list(words)
        for j in rng.sample(at, 9):
            copy[j] = f"w{rng.randint(0, 10**9)}"
        rows += [(2 * i, 0, " ".join(words), None, None, None, "a.example"), (2 * i + 1, 1, " ".join(copy), None, None, None, "b.example")]
    df = spark.createDataFrame(rows, "doc_id long, batch_no int, text string, content_hash string, canonical_url string, doi string, source_domain string")
    got = {tuple(r) for r in new_batches.duplicates(df).collect()}
    assert got <= {(2 * i, 2 * i + 1) for i in range(300)} and len(got) >= 285


def test_recall_counts_pairs_by_their_texts(spark):
    # none of these near-copies is lost to the exhaustive side, however far apart the signatures are
    rng = random.Random(10)
    rows = []
    for i in range(60):
        words = [f"t{j}" if j % 8 != 4 else f"v{rng.randint(0, 10**9)}" for j in range(100)]
        copy = [f"w{rng.randint(0, 10**9)}" if j in range(4, 80, 8) else w for j, w in enumerate(words)]
        rows += [(2 * i, 0, " ".join(words), None, "a.example"), (2 * i + 1, 1, " ".join(copy), None, "b.example")]
    df = spark.createDataFrame(rows, "doc_id long, batch_no int, text string, canonical_url string, source_domain string")
    r = new_batches.index_recall(df, every=1).first()
    assert (r["queries"], r["pairs"]) == (120, 60) and r["found"] >= 54


def test_beam_is_tuned_on_other_nodes():
    rng = np.random.default_rng(5)
    codes = np.ascontiguousarray(rng.integers(0, 256, (400, SIGNATURE), dtype=np.uint8)).view(np.uint64)
    g = Graph(codes, np.arange(400), np.arange(400))
    assert np.isnan(tuned_beam(g, codes, np.arange(400), 8, itself=True)[1])


def test_near_copies_in_different_salts_of_a_hot_value_meet(spark, monkeypatch):
    monkeypatch.setattr(new_batches, "SHARD_ROWS", 40)
    rng, made = np.random.default_rng(6), random.Random(6)
    texts, routed = [], []
    for i in range(200):  # 0-99 are the pivots and others; the pairs (100 + k, 150 + k) are near-copies of nothing else
        words = [f"w{made.randint(0, 10**9)}" for _ in range(30)] if i < 150 else [*texts[i - 50][3].split()[:-1], "other"]
        code = rng.integers(0, 256, SIGNATURE, dtype=np.uint8).tobytes() if i < 150 else routed[i - 50][2]
        texts.append((i, 0, 1, " ".join(words)))
        routed.append((i, 0, code, 0, 7, 9))
    tokens = new_batches.tokenise(spark.createDataFrame(texts, "doc_id long, batch_no int, site long, text string"))
    df = spark.createDataFrame(routed, "doc_id long, batch_no int, signature binary, route int, value long, next_value long")
    got = {tuple(r) for r in new_batches.index_links(df, tokens, np.zeros(0, np.int64)).collect()}
    assert got == {(100 + k, 150 + k) for k in range(50)}


BATCH_SCHEMA = "doc_id long, batch_no int, text string, content_hash string, canonical_url string, doi string, source_domain string"


def test_batches_added_one_by_one_give_the_groups_of_all_at_once(spark, tmp_path):
    rng = random.Random(12)
    base = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(120)]
    rows = []
    for i in range(480):
        text = base[rng.randrange(len(base))].split()
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(60)] = f"x{rng.randint(0, 10**9)}"
        rows.append((i, i // 120, " ".join(text) if i % 17 else None, None, f"https://a.example/{rng.randint(0, 2000)}", None, "a.example"))
    rows += [(300, 2, base[0], None, None, None, "a.example"), (2**60 + 1, 3, base[1], None, None, None, None)]
    df = spark.createDataFrame(rows, BATCH_SCHEMA)
    whole = {tuple(r) for r in new_batches.duplicates(df).collect()}
    for part in range(4):  # opened anew for each batch, as another job would
        batch_index.BatchIndex(spark, f"file://{tmp_path}/ix").add(df.where(F.col("batch_no") == part))
    index = batch_index.BatchIndex(spark, f"file://{tmp_path}/ix")
    assert {tuple(r) for r in index.held_before().collect()} == whole and len(whole) > 200
    assert index.meta["loads"] == 4 and index.meta["epoch"] >= 2
    # a later batch reads neither the documents nor the tokens of parts without candidates
    before = index.meta["epoch"]
    index.add(spark.createDataFrame([(10**7, 9, base[2], None, None, None, None)], BATCH_SCHEMA))
    assert index.meta["epoch"] == before and (10**7 in {r["doc_id"] for r in index.held_before().collect()})
    plan = index._tokens_of(range(5))(spark.createDataFrame([(10**7, 10**7)], "a long, b long"))
    assert "part#" in (shown := plan._jdf.queryExecution().executedPlan().toString()).split("PartitionFilters: [")[1].split("]")[0] and str(10**7 // batch_index.PART) in shown
    index.drop()


def test_an_index_of_nothing(spark, tmp_path):
    index = batch_index.BatchIndex(spark, f"file://{tmp_path}/ix")
    index.add(spark.createDataFrame([], BATCH_SCHEMA))
    index.add(spark.createDataFrame([(1, 0, None, None, None, None, None), (2, 1, " ", "", "", "", "")], BATCH_SCHEMA))
    assert index.held_before().count() == 0


def test_hot_values_are_split_by_further_values(spark, monkeypatch):
    monkeypatch.setattr(new_batches, "SHARD_ROWS", 40)
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, 0, rng.integers(0, 256, SIGNATURE, dtype=np.uint8).tobytes(), 1, 7, 9) for i in range(200)], "doc_id long, batch_no int, signature binary, route int, value long, next_value long")
    levels = new_batches.hot_levels(df)
    assert len(levels) == 2  # the value, and with the same next value; the first byte tells them apart
    assert new_batches._split_hot(df, levels).select("value").distinct().count() > 40


@pytest.mark.parametrize("one_task", [0, 1_000_000])
def test_closed_groups_of_a_chain(spark, monkeypatch, one_task):
    monkeypatch.setattr(new_batches, "ONE_TASK_LINKS", one_task)
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)]
    random.Random(1).shuffle(edges)
    got = {tuple(r) for r in new_batches.closed_groups(spark.createDataFrame(edges, "a long, b long")).select("doc_id", "first").collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(101, 100), (102, 100)}


# ---------------------------------------------------------------- 5
@pytest.mark.parametrize(
    "text, kind",
    [("All was well.", "closed"), ("All was we", "bare"), ("All was well…", "mark"), ("All was […]", "mark"), ("A | B | 12 kg", "table"), ("Table 3. Yield of rye", "caption"), ("“All was well.”", "closed"), ("“All was well.", "open"), ("It ended (plot 3)", "bracket"), ("It ended (plot", "bare"), ("All was well.\n- 12 -", "closed"), ("All was w&am", "mark"), ("Only 4 of 5 fields,", "bare"), ("", "empty")],
)
def test_closing_shapes(text, kind):
    assert truncation.shape(text) == kind


def test_truncation_with_copies_and_edges(spark):
    full = " ".join(f"word{i}" for i in range(40)) + " end of it all here now."
    rows = [("a", "s", full), ("b", "s", full[:-14]), ("b", "s", full[:-14]), ("c", "s", None), ("d", "t", " "), ("e", "t", "Short one."), ("f", "t", "x" * 50_000 + ".")]
    got = {r["claim_id"]: r for r in truncation.judged(spark.createDataFrame(rows, "claim_id string, source_domain string, evidence_text string")).collect()}
    assert sorted(got) == ["a", "b", "e", "f"]
    assert got["b"]["cut"] and got["b"]["by_copy"] and not got["a"]["cut"] and not got["e"]["cut"] and not got["f"]["cut"]


HEAD_TEXT = "The plots at the northern station were sown in early autumn and the yield of rye there was "
CAPTION_TEXT = "Table 3. Yield of winter rye by region and year at all of the northern stations"
ROW_TEXT = "Rye | Nordhof | 1999 | loam | 4 plots | 120 kg N | sown early | 31 days | 5.2"


@pytest.mark.parametrize(
    "copy, longer, cut",
    [
        (HEAD_TEXT + "3.", HEAD_TEXT + "3.5 t/ha in all plots.", True), (HEAD_TEXT + "good, cf.", HEAD_TEXT + "good, cf. Miller for all plots.", True), (HEAD_TEXT + "no.", HEAD_TEXT + "no. 4 in all plots.", True), (HEAD_TEXT + "good.", HEAD_TEXT + "good. The next year was dry.", False), (HEAD_TEXT + "good.", HEAD_TEXT + "good.[3] The next", False),
        (HEAD_TEXT + "good (plot 3)", HEAD_TEXT + "good (plot 3) and bad in the others.", True), (HEAD_TEXT + "good (plot 3)", HEAD_TEXT + "good (plot 3).", False), (CAPTION_TEXT, CAPTION_TEXT + " in 1999", True), (CAPTION_TEXT, CAPTION_TEXT + "\nThe text goes on.", False),
        (ROW_TEXT, ROW_TEXT + " | 14 kg", True), (ROW_TEXT, ROW_TEXT + " t/ha", True), (ROW_TEXT, ROW_TEXT + "\nOats | Nordhof | 2000", False),
    ],
)
def test_where_a_longer_copy_goes_on(copy, longer, cut):
    assert truncation.breaks_off(copy, longer) == cut


def test_a_cut_row_and_caption_are_told_by_a_copy_that_is_not_the_longest(spark):
    # the longest near-copy has another ending and says nothing about the cut
    rows = [("cut", "s", ROW_TEXT), ("whole", "s", ROW_TEXT + " | 14 kg"), ("other", "s", ROW_TEXT.replace("| 5.2", "| n/a | n/a | n/a")), ("c", "t", CAPTION_TEXT), ("d", "t", CAPTION_TEXT + " in 1999"), ("e", "t", ROW_TEXT.replace("Rye", "Oats"))]
    got = {r["claim_id"] for r in truncation.judged(spark.createDataFrame(rows, "claim_id string, source_domain string, evidence_text string")).where("cut").collect()}
    assert got == {"cut", "c"}


def test_a_full_bucket_is_searched_whole(spark, monkeypatch):
    # more near-copies than MANY; the one that tells the cut is neither the longest nor opens with the same words
    row = lambda place, *end: " | ".join(["Rye", place, *[f"cell{i}" for i in range(60)], *end])
    rows = [("cut", "s", row("Nordhof", "5.2")), ("whole", "s", row("Nordhoff", "5.2", "14 kg")), *[(f"o{c}", "s", row(f"Nordho{c}", *["n/a"] * 5)) for c in "abcdeghijk"]]
    monkeypatch.setattr(truncation, "MANY", 4)
    for block in (1_024, 3):
        monkeypatch.setattr(truncation, "BLOCK", block, raising=False)
        got = {r["claim_id"] for r in truncation.judged(spark.createDataFrame(rows, "claim_id string, source_domain string, evidence_text string")).where("by_copy").collect()}
        assert got == {"cut"}


def test_blocks_find_what_all_pairs_find(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"word{i}" for i in range(60)]
    rows = []
    for k in range(120):
        words = [w if rng.random() > 0.01 else rng.choice(["of", "and", w + "s"]) for w in base]
        text = " ".join(words[: rng.randint(50, 60)])
        rows.append((f"c{k}", "s", text[: -rng.randint(1, 4)] if k % 3 else text + "."))
    df = spark.createDataFrame(rows, "claim_id string, source_domain string, evidence_text string")
    c = truncation.closing(df).where("claim_id is not null")
    got = []
    for many, block in ((10**9, 1_024), (2, 16), (2, 1_024)):
        monkeypatch.setattr(truncation, "MANY", many)
        monkeypatch.setattr(truncation, "BLOCK", block)
        got.append({r["claim_id"] for r in truncation.cut_copies(df, c).collect()})
    bands = {r["claim_id"]: set(r["bands"]) for r in c.collect()}
    text = {k: t for k, _, t in rows}
    loop = {x for x in text if any(len(text[x]) < len(text[y]) and bands[x] & bands[y] and truncation.breaks_off(text[x], text[y]) for y in text)}
    assert len(loop) > 30 and got == [loop] * 3


def test_search_of_cut_texts_broadcasts_no_table(spark, tmp_path, monkeypatch):
    # files are small against what is made of them: an estimate would broadcast the rows of all bands
    spark.createDataFrame([(f"c{k}", "s", f"The rye of plot {k} was sown early and stood well.") for k in range(40)], "claim_id string, source_domain string, evidence_text string").write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    monkeypatch.setattr(truncation, "checkpoint", lambda x: x)
    plan = truncation.judged(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 8 and "Broadcast" not in plan


def test_truncation_of_nothing_and_clashing_columns(spark):
    schema = "claim_id string, source_domain string, evidence_text string, word string, shape string, n_words int"
    assert truncation.judged(spark.createDataFrame([], schema)).count() == 0
    rows = [("a", None, "It was dry at the 3.", "w", "s", 1), (None, "d", "No id here.", None, None, None), ("b", "d", None, None, None, None), ("c", "d", "It broke off at th", "x", None, 2)]
    got = {r["claim_id"]: r["cut"] for r in truncation.judged(spark.createDataFrame(rows, schema)).collect()}
    assert not got["a"] and got["c"] and "b" not in got


def test_made_cuts_are_shorter_texts():
    text = "“The rye was sown in early spring. It had no rain for weeks.”"
    for k in range(12):
        for cut in truncation.made_cuts(text, k):
            bare = cut.rstrip("….-[] ")
            assert text.startswith(bare) and len(bare) < len(text.rstrip())
    assert truncation.bare_word("3,5.") == "#" and truncation.bare_word("(rye).") == "rye" and truncation.bare_word("5cm") == "5cm"


# ---------------------------------------------------------------- 7
def test_a_sequence_of_nine_lines(spark):
    lines = [("s", f"c{i}", k + 1, k) for i in range(8) for k in range(9)]
    df = spark.createDataFrame(lines, "site string, claim_id string, line_no int, line long")
    got = site_lines.frequent_sequences(df, spark.createDataFrame([("s", 8)], "site string, site_claims long")).collect()
    assert len(got) == 2**9 - 1 and max(len(r["pattern"]) for r in got) == 9 and {r["support"] for r in got} == {8}


def test_runs_of_repeated_lines(spark):
    # the notice of three lines, once with a rare line in between, and a single line of another text
    rows = [("s", f"c{i}", k + 1 + (k > 0 and i == 0), 100 + k) for i in range(8) for k in range(3)] + [("s", "c0", 2, 999), ("s", "d", 5, 101)]
    df = spark.createDataFrame(rows, "site string, claim_id string, line_no int, line long")
    runs = site_lines.frequent_runs(df, spark.createDataFrame([("s", 9)], "site string, site_claims long"))
    assert sorted((r["length"], r["support"]) for r in runs.select("length", "pattern", "support").distinct().collect()) == [(1, 8), (1, 8), (1, 9), (2, 8), (2, 8), (3, 8)]
    lines = {(r["claim_id"], r["line_no"]): r["longest"] for r in site_lines.run_lines(runs).collect()}
    assert lines[("c0", 1)] == lines[("c0", 3)] == lines[("c0", 4)] == 3 and lines[("d", 5)] == 1 and ("c0", 2) not in lines and len(lines) == 25
    none = spark.createDataFrame([], "site string, claim_id string, line_no int, line long")
    assert site_lines.frequent_runs(none, spark.createDataFrame([], "site string, site_claims long")).count() == 0


def test_site_lines_and_clean(spark):
    rows = [(f"c{i}", f"Body number {i} {'xyz' * (i % 5)}.\nShare this Page with Friends {i}!" + ("\nshort one" if i % 2 else ""), "u1") for i in range(10)]
    rows += [rows[0], ("z", None, "u1"), ("y", "", "u2"), ("w", "Share this page with friends", "gone")]
    claims = spark.createDataFrame(rows, "claim_id string, claim_text string, source_url string")
    src = spark.createDataFrame([("u1", "WWW.One.example:80"), ("u2", None)], "source_url string, source_domain string")
    occ = site_lines.frequent_lines(*site_lines.line_sequences(claims, src))
    assert {(r["claim_id"], r["line_no"]) for r in occ.collect()} == {(f"c{i}", 2) for i in range(10)}
    clean = {r["claim_id"]: r["claim_text"] for r in site_lines.clean_texts(claims, occ).collect()}
    assert "Share" not in clean["c3"] and clean["z"] is None and clean["w"].startswith("Share")
    longer = site_lines.frequent_sequences(*site_lines.line_sequences(claims.withColumn("claim_text", F.concat("claim_text", F.lit("\nWe use cookies on this site"))), src))
    assert sorted(len(r["pattern"]) for r in longer.collect()) == [1, 1, 2]


# ---------------------------------------------------------------- 8, 9
@pytest.mark.skipif(not VOCABULARY, reason="no vocabulary")
def test_tokenizer_equals_the_library():
    import tiktoken

    raw = tokenizer.read_vocabulary()
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}, special_tokens={})
    rng = random.Random(7)
    bits = ["a", "'", "s", "re", "'ll", "'t", " ", "  ", "\n", "\t", "é", "小", "👩", "1", "٣", "½", ".", "don't", "\r\n", "x" * 70, "́", "\x85", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, "", "'", "ab" * 5000, " " * 300]
    ids, off, _, _ = tokenizer.encode_array(pa.array(texts), tokenizer.Merger(raw))
    table = tokenizer.decode_table(raw)
    for i, t in enumerate(texts):
        got = ids[off[i] : off[i + 1]].tolist()
        assert got == (enc.encode_ordinary(t) if t else [])
        assert tokenizer.decode(got, table) == (t or "")


@pytest.mark.skipif(not VOCABULARY, reason="no vocabulary")
def test_encode_rows_and_spans(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (1, "Hello world")], "doc_id long, text string")
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in tokenizer.encode(df).collect())
    assert len(got) == 4 and got[2] == (2, ()) and got[3] == (3, ()) and got[0] == got[1] != (1, ())
    s = {r["doc_id"]: r for r in tokenizer.spans(df).collect()}
    assert s[1]["piece_offsets"] == [0, 5] and s[1]["first_token"][0] == 0 and s[2]["piece_offsets"] == []


def test_packing_is_whole_and_dense(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 1, 7, 120, 300, 700, 2048, 2049, 9000])) for i in range(3000)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, n_tokens long"), shard_bins=64).collect()
    load, docs = {}, {}
    for r in got:
        load[r["container"]] = load.get(r["container"], 0) + r["n_tokens"]
        docs.setdefault(r["doc_id"], []).append((r["piece"], r["first_token"], r["n_tokens"]))
    assert max(load.values()) <= 2048
    for i, n in rows:
        pieces = sorted(docs[i])
        assert sum(p[2] for p in pieces) == n and len(pieces) == max(1, -(-n // 2048))
        assert [p[1] for p in pieces] == [2048 * k for k in range(len(pieces))]
    assert sum(load.values()) / (2048 * len(load)) > 0.95
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


# ---------------------------------------------------------------- 10
def test_stuffed_pages(spark):
    rng = random.Random(9)
    honest = lambda i: f"The trial at site {i} was sown in the spring and it had a yield of {i} on the clay. After the rain, the plots of rye were cut by the team, which was late for the year."
    rows = [(i, honest(i), "en") for i in range(80)]
    spam = {100: "cheap rye buy rye seed online rye " * 20, 101: "\n".join(f"Home > Shop > Brand{i % 4} rye" for i in range(40)), 102: " | ".join(f"[rye {i % 3}](/rye/{i})" for i in range(40)), 103: honest(3) + "\n" + " ".join(rng.choice(["#rye", "#sale", "#ryeSeed", "#best"]) for _ in range(120))}
    fair = {200: honest(1) + "\nVariety | Place | yield\n" + "\n".join(f"Name{chr(65 + i)}ella | Town{chr(70 + i)}wick | {i}.5" for i in range(6)), 201: "rye " * 3, 202: None, 203: "", 204: "rye and the rye of the rye in the field was the rye that we had sown for rye on the land of rye " * 3}
    rows += [(k, v, None) for k, v in (spam | fair).items()]
    got = {r["doc_id"] for r in stuffed_pages.stuffed_pages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == set(spam)
    assert stuffed_pages.stuffed_pages(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_nothing_else_imports_llm():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent.parent / "claimloom"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "claimloom.llm" not in p.read_text()
    assert json.dumps(1) == "1"
