"""Readers, connectors, sinks, places and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from claimloom.functions import geo
from claimloom.sources import connectors, files, sinks
from claimloom.streaming import ledger_stream


def test_json_objects_lenient_and_strict(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x",\n "n": 1}')
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text('{"n": 3}')
    (tmp_path / "summary.json").write_text('{"id": "s", "n": 9}')
    got = files.json_objects(spark, str(tmp_path), "id string, n int").collect()
    assert [(r["id"], r["file_name"]) for r in got] == [("x", "a.json")]
    with pytest.raises(Exception):
        files.json_objects(spark, str(tmp_path), "id string, n int", strict=True).collect()


def test_json_lines_missing(spark, tmp_path):
    assert files.json_lines(spark, str(tmp_path / "none.jsonl"), "a int", missing_ok=True).count() == 0
    with pytest.raises(Exception):
        files.json_lines(spark, str(tmp_path / "none.jsonl"), "a int").count()
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert files.json_lines(spark, str(tmp_path / "x.jsonl"), "a int", missing_ok=True).where("a is not null").count() == 2


def test_gold_and_mixed_files(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"domain": "water", "run_id": "r1", "records": [{"gold_id": "1", "run_id": None}, {"gold_id": "2", "run_id": "r2"}]}))
    got = {(r["gold_id"], r["domain"], r["run_id"]) for r in files.gold_set(spark, str(tmp_path / "g.json"), "gold_id:string,run_id:string").collect()}
    assert got == {("1", "water", "r1"), ("2", "water", "r2")}
    assert files.gold_set(spark, str(tmp_path / "g.json"), "gold_id:string,run_id:string", "r1").count() == 1
    m = tmp_path / "m"
    m.mkdir()
    (m / "one.json").write_text('{"claim_id": "a"}')
    (m / "many.json").write_text('{"claims": [{"claim_id": "b"}, {"claim_id": "c"}]}')
    assert {r[0] for r in files.mixed_claims(spark, str(m), "claim_id string").collect()} == {"a", "b", "c"}


def test_gazetteer_and_first_by_key(spark, tmp_path):
    (tmp_path / "g.txt").write_text("NAME|AREA|GEO_ID\nNorby |x|1\nElm|x|2\nElm|y|3\n")
    g = files.gazetteer(spark, str(tmp_path / "g.txt"))
    found = spark.createDataFrame([("m1", "norby", "q"), ("m2", "Elm", "y"), ("m3", "Elm", "q"), ("m4", "Gone", None)], "key string, name string, hint string")
    got = {r["key"]: r["geo_id"] for r in geo.locate(found, g, "hint").collect()}
    assert got == {"m1": "1", "m2": "3", "m3": None, "m4": None}
    rows = spark.createDataFrame([("a", 1), ("a", 0), (None, 2), (None, 3)], "k string, o int")
    assert sorted((r["k"] or "", r["o"]) for r in files.first_by_key(rows, "k", "o").collect()) == [("", 2), ("", 3), ("a", 0)]


RESPONSES = {
    "openalex": ({"results": [{"id": "W1", "display_name": "T", "doi": "10.1/a", "open_access": {"is_oa": True, "oa_url": "u"}}]}, ("T", "u", "10.1/a", "open_full_text")),
    "crossref": ({"message": {"items": [{"DOI": "10.1/a", "title": ["T"], "URL": "u"}]}}, ("T", "u", "10.1/a", "metadata_only")),
    "google_books": ({"items": [{"id": "b", "volumeInfo": {"title": "T"}, "accessInfo": {"viewability": "ALL_PAGES"}}]}, ("T", "b", None, "open_full_text")),
    "open_library": ({"docs": [{"key": "/w/1", "title": "T", "ia": ["x"]}]}, ("T", "ia:x", None, "open_full_text")),
    "europe_pmc": ({"resultList": {"result": [{"id": "1", "title": "T", "doi": "d", "fullTextUrlList": {"fullTextUrl": [{"availability": "Subscription", "url": "no"}, {"availability": "Free", "url": "yes"}]}}]}}, ("T", "yes", "d", "open_full_text")),
    "doaj": ({"results": [{"bibjson": {"title": "T", "identifier": [{"type": "doi", "id": "d1"}, {"type": "doi", "id": "d2"}], "link": []}}]}, ("T", "d2", "d2", "metadata_only")),
    "internet_archive": ({"response": {"docs": [{"identifier": "", "title": "skip"}, {"identifier": "i", "title": "T"}]}}, ("T", "ia:i", None, "open_full_text")),
    "doab": ({"items": [{"handle": "h", "metadata": [{"key": "dc.title", "value": "old"}, {"key": "dc.title", "value": "T"}]}]}, ("T", "h", None, "open_full_text")),
    "wikipedia": ({"query": {"search": [{"title": "A b", "snippet": "<b>x</b>"}]}}, ("A b", "wiki:A_b", None, "open_full_text")),
}


@pytest.mark.parametrize("provider", sorted(connectors.SHAPES))
def test_connectors(spark, provider):
    body, want = RESPONSES[provider]
    df = spark.createDataFrame([(1, json.dumps(body)), (2, "{}"), (3, None)], "q int, payload string")
    got = [(r["title"], r["source_url"], r["doi"], r["access_status"]) for r in connectors.results(provider, df).collect()]
    assert got == [want]


def test_run_partitions_and_resume(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_runs(spark.createDataFrame([("r1", 1), ("r2", 2)], "run_id string, v int"), path)
    sinks.write_runs(spark.createDataFrame([("r2", 5)], "run_id string, v int"), path)
    assert {(r["run_id"], r["v"]) for r in spark.read.parquet(path).collect()} == {("r1", 1), ("r2", 5)}
    p2 = str(tmp_path / "u")
    assert sinks.append_new(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), p2, ["k"]).columns == ["k", "v"]
    sinks.append_new(spark.createDataFrame([("a", 9), ("b", 1)], "k string, v int"), p2, ["k"])
    assert sorted(r["k"] for r in spark.read.parquet(p2).collect()) == ["a", "b"]


def test_relational_rows(spark):
    schema = "claim_id string, run_id string, value struct<value_type:string,numeric_value:double>, location_scope struct<name:string>, provenance struct<source_urls:array<string>,source_title:string,source_domain:string>, inserted_at int"
    df = spark.createDataFrame([("c", "r", ("numeric", 1.0), ("x",), (["u", "v"], "t", "d"), 1), ("c", "r", ("numeric", 2.0), None, (["u"], "t2", "d"), 2)], schema)
    src, flat = sinks.relational_rows(df)
    assert {(r["source_url"], r["source_title"]) for r in src.collect()} == {("u", "t2"), ("v", "t")}
    assert [(r["claim_id"], r["numeric_value"]) for r in flat.collect()] == [("c", 2.0)]


def test_stream_first_of_key(spark, tmp_path):
    rows = spark.sql("select * from values (1, 'a', timestamp '2024-01-01 00:00:00'), (2, 'a', timestamp '2024-01-01 00:01:00'), (3, 'b', timestamp '2024-01-01 00:02:00') t(id, k, at)")
    rows.write.parquet(str(tmp_path / "in"))
    s = ledger_stream.read_ledger(spark, str(tmp_path / "in"), rows.schema.simpleString()[7:-1].replace(":", " "))
    q = ledger_stream.first_of_key(s, ["k"]).writeStream.format("memory").queryName("t_first").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.table("t_first").select("k").collect()) == ["a", "b"]
    assert spark.range(1).select(F.lit(1)).count() == 1
