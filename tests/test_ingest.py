"""Configuration, registries, the personal-data step, runs, token-paged sources and the command line."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from mergewell import cli
from mergewell.functions import location, pii, text
from mergewell.operators import candidates, consolidate, ingest, provenance, records
from mergewell.plans import catalogue
from mergewell.sources import config, paged

UUID = "11111111-1111-4111-8111-111111111111"
FULL = {"id": "a-1", "name": "n", "type": "manual_file", "enabled": True, "trust_tier": "C", "url": "u", "refresh_minutes": 5, "parser_asignado": "demo"}


@pytest.mark.parametrize(
    "change,wrong",
    [({}, 0), ({"type": "x"}, 1), ({"trust_tier": "Z"}, 1), ({"refresh_minutes": True}, 1), ({"id": "a b"}, 1), ({"enabled": 1}, 1), ({"name": " "}, 1), ({"page_size": 0}, 1), ({"page_size": None}, 0),
     ({"allowed_domains": []}, 1), ({"timeout_seconds": 0.5}, 0), ({"full_scan": "no"}, 1), ({"cursor_field": ""}, 1), ({"required_keywords": [1]}, 1), ({"notes": 3}, 1), ({"bulk_size": -1, "max_retries": 0}, 2)],
)
def test_rules_of_full_entries(change, wrong):
    assert len(config.validate_entry(FULL | change)) == wrong


def test_thin_entries_and_lists():
    thin = {"id": UUID, "enabled": True, "parser_asignado": "demo"}
    assert config.validate_sources([FULL, thin]) == []
    assert len(config.validate_sources([thin, thin])) == 1 and config.validate_entry(thin | {"id": "x"}) and config.validate_entry(7) == ["is no mapping"]


def test_sources_from_yaml_and_catalogue(spark, tmp_path):
    path = tmp_path / "s.yaml"
    path.write_text(f"project: {{event_id: e}}\nsources:\n - {json.dumps(FULL)}\n - {{id: {UUID}, parser: demo, enabled: true}}\n")
    table = spark.createDataFrame([(UUID, "shown", "http://x.invalid", "rss", "B", 9, True)], "source_id string, display_name string, url string, source_type string, governed_tier string, refresh_minutes int, active boolean")
    project, sources = config.load_sources(str(path), table)
    assert project == {"event_id": "e"} and sources[0] == FULL and sources[1]["name"] == "shown" and sources[1]["type"] == "rss" and sources[1]["enabled"] is True
    assert config.load_sources(str(path), table.withColumn("active", F.lit(False)))[1][1]["enabled"] is False
    for bad in (None, table.limit(0), table.withColumn("url", F.lit(""))):
        with pytest.raises(ValueError):
            config.load_sources(str(path), bad)


def test_registry_and_guards(spark):
    assert ingest.adapter_for(FULL) is ingest.read_files and ingest.parser_for(FULL) is ingest.parse_demo and ingest.adapter_for({"type": "webapp_js"}) is None and ingest.parser_for({}) is None
    with pytest.raises(ValueError):
        ingest.adapter_for(FULL, "rss")
    assert [ingest.positive_int(v, 4) for v in (3, "7", 0, None, "x", True)] == [3, 7, 4, 4, 4, 4]


def test_ingest_of_files_and_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("La Familia Demo busca a juan perez, 12 años, Lara.")
    (tmp_path / "in/b.txt").write_text("nothing here")
    sources = [FULL | {"url": str(tmp_path / "in")}, FULL | {"id": "b", "type": "pdf"}, FULL | {"id": "c", "enabled": False}]
    good, bad, failures = ingest.ingest(spark, sources, "s")
    row = good.first()
    assert (row["full_name"], row["is_minor"], row["entity_type"], row["source_id"]) == ("Juan Perez", True, "Person", "a-1") and good.count() == 1
    assert [r["reason_code"] for r in bad.collect()] == ["invalid_schema"] and failures == ["b: no adapter"]
    path = tmp_path / "s.yaml"
    path.write_text(json.dumps({"sources": sources[:1]}))
    out = str(tmp_path / "out")
    assert cli.main(["validate", "--config", str(path)]) == 0 and cli.main(["list-enabled", "--config", str(path)]) == 0 and cli.main(["validate", "--config", str(tmp_path / "no")]) == 2
    assert cli.main(["ingest", "--config", str(path), "--out", out, "--dry-run"]) == 0 and not (tmp_path / "out").exists()
    assert cli.main(["ingest", "--config", str(path), "--out", out]) == 0 and spark.read.parquet(f"{out}/staging").count() == 1


def test_runs_artifacts_and_notices(spark):
    raw = spark.createDataFrame([("s1", "u", 1, "x"), ("s2", "u", 1, "y"), ("s1", "u", 2, None)], "source_id string, source_url string, page int, raw_content string")
    runs = provenance.start_runs(raw.where("source_id = 's1'"), "b", F.lit("2024-01-01").cast("timestamp"))
    assert provenance.raw_artifacts(raw, runs).count() == 2 and [r["source_id"] for r in provenance.unrecorded(raw, runs).collect()] == ["s2"]
    nested = spark.createDataFrame([((2, "a"),)], "c struct<b:int,a:string>")
    assert nested.select(provenance.as_text(nested, "c").alias("t")).first()["t"] == '{"a":"a","b":2}'
    done = provenance.finish_runs(runs, spark.createDataFrame([], "source_id string, outcome string"), F.lit("2024-01-02").cast("timestamp")).first()
    assert done["stats"] == {"records": 0}
    assert [provenance.run_notice(*x).split()[0] for x in ((5, 0, 0), (5, 1, 0), (5, 5, 0), (0, 0, 0))] == ["OK", "DEGRADED", "FAILED", "OK"]
    bad = spark.createDataFrame([("s", "odd", "low", "h", "p", None)], "source_slug string, reason_code string, risk_level string, payload_hash string, payload_preview_redacted string, pii_findings_summary map<string,int>")
    with pytest.raises(Exception, match="unknown reason_code"):
        provenance.quarantine_sink(bad, F.lit("r"), F.current_timestamp()).collect()


class _Search(BaseHTTPRequestHandler):
    def do_GET(self):
        asked = parse_qs(urlparse(self.path).query)
        at = int(asked.get("next_token", ["0"])[0])
        body = json.dumps({"data": [{"id": f"{at}-{i}", "q": asked["query"][0], "since": asked.get("start_time", [""])[0]} for i in range(2)], "meta": {"next_token": str(at + 1)} if at < 4 else {}}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def search():
    server = HTTPServer(("127.0.0.1", 0), _Search)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/"
    server.shutdown()


def test_token_paged_search(spark, search):
    spark.dataSource.register(paged.TokenPaged)
    read = lambda **o: spark.read.format("token_paged").options(url=search, query="a OR b", **o).load().collect()
    rows = read()
    assert [json.loads(r["record"])["id"] for r in rows] == ["0-0", "0-1", "1-0", "1-1"] and json.loads(rows[0]["record"])["q"] == "a OR b"
    assert len(read(maxPages="50")) == 10 and len({r["content_hash"] for r in rows}) == 2
    assert json.loads(read(updatedAfter="2024-01-01")[0]["record"])["since"] == "2024-01-01" and json.loads(read(updatedAfter="1970-01-01")[0]["record"])["since"] == ""


def test_token_paged_stream_goes_on(search):
    reader = paged.TokenPagedStream({"url": search, "query": "q"})
    rows, at = reader.read(reader.initialOffset())
    more, then = reader.read(at)
    again = list(reader.readBetweenOffsets(at, then))
    more = list(more)
    last, end = reader.read(then)
    assert len(list(rows)) == 4 and more == again and [json.loads(r[5])["id"] for r in more] == ["2-0", "2-1", "3-0", "3-1"]
    assert len(list(last)) == 2 and end["done"] and list(reader.read(end)[0]) == []


def test_rate_limiter_waits():
    now, slept = [0.0], []
    limiter = paged.RateLimiter(2, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        limiter.wait()
    assert slept == [60.0] and paged.RateLimiter(None).wait() is None


def test_tokens_of_redaction_equal_identity_tokens(spark):
    values = ["CÉDULA: 12345678", "V-12345678", "0412-1234567"]
    frame = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.identity_token(F.col("v"), "k").alias("t"), pii.redact_pii(F.col("v"), "k").alias("r"))
    assert all(r["t"] in r["r"] for r in frame.collect())


def test_upsert_takes_the_last_and_keeps_odd_names(spark):
    old = spark.createDataFrame([("a", 1, 7), (None, 2, 8)], "id string, v int, is_new int")
    new = spark.createDataFrame([("a", 2, 0, 1), ("a", 3, 0, 2), ("b", 4, 0, 1), ("b", 4, 0, 1)], "id string, v int, is_new int, at int")
    got = {r["id"]: (r["v"], r["is_new"]) for r in consolidate.upsert(old, new, ["id"], keep=("is_new",), order="at").collect()}
    assert got == {"a": (3, 7), None: (2, 8), "b": (4, 0)}
    both = consolidate.union_by_id(old.select("id", "v"), spark.createDataFrame([("a", 9), (None, 5), ("c", 6)], "id string, v int"))
    assert sorted((str(r["id"]), r["v"]) for r in both.collect()) == [("None", 2), ("None", 5), ("a", 1), ("c", 6)]


def test_synonyms_from_yaml(spark, tmp_path):
    path = tmp_path / "l.yaml"
    path.write_text("canonical:\n  maiquetia:\n    - Maiquetía\n  caracas:\n    - CCS\n    - caracas df\n  empty:\n")
    assert location.load_synonyms(str(path)) == {"maiquetia": "maiquetia", "ccs": "caracas", "caracas df": "caracas"}
    large = {f"s{i}": "caracas" for i in range(1500)} | location.load_synonyms(str(path))
    got = spark.createDataFrame([("ccs",), ("s77",), ("x",)], "p string").select(location.normalize_location(F.col("p"), large)["estado"].alias("e")).collect()
    assert [r["e"] for r in got] == ["Distrito Capital", "Distrito Capital", None]


def test_hot_blocks_give_the_same_pairs(spark, monkeypatch):
    people = catalogue.persons(spark, "/root/testdata/sf0.01").withColumn("block_keys", F.concat("block_keys", F.array(F.lit("hot"))))
    edges = lambda **o: {(r["left_id"], r["right_id"], r["blocking_key"]) for r in candidates.find_candidates(people, **o).select("left_id", "right_id", "blocking_key").collect()}
    whole = edges()
    monkeypatch.setattr(candidates, "HOT_BLOCK", 200)
    assert edges() == whole and len(whole) > 10
    new = people.where("right(id, 1) = '3'").select("id")
    assert edges(new_ids=new) == {e for e in whole if e[0].endswith("3") or e[1].endswith("3")}


def test_routes_and_seeds_of_odd_rows(spark):
    rows = spark.createDataFrame([("1", "person", "{}"), ("", "person", "{}"), ("2", "person", None), ("3", "person", "[]"), ("4", None, "{}"), ("5", "event", "{}")], "id string, entity_type string, raw_json string")
    assert {r["id"]: r["route"] for r in records.route(rows).collect()} == {"1": "person", "": "malformed", "2": "malformed", "3": "malformed", "4": "unknown", "5": "event"}
    assert [r["event_id"] for r in records.seed_events(rows, rows.select(F.col("id").alias("event_id")), "E").collect()] == ["E"]


#: Published primary codes.
CODES = {"smith": "SM0", "schmidt": "XMT", "jose": "HS", "gonzalez": "KNSLS", "thomas": "TMS", "rodriguez": "RTRKS", "hernandez": "HRNNTS", "philip": "FLP", "xavier": "SF", "wright": "RT", "williams": "ALMS", "johnson": "JNSN", "campbell": "KMPL", "edgar": "ATKR", "laugh": "LF", "caesar": "SSR", "chianti": "KNT", "michael": "MKL", "sugar": "XKR", "island": "ALNT", "castro": "KSTR"}


def test_metaphone_of_known_names():
    assert {n: text.metaphone(n) for n in CODES} == CODES


def test_abbreviations_from_json(tmp_path):
    (tmp_path / "a.json").write_text('{"Edo": "Estado", "X": "Y"}')
    (tmp_path / "b.json").write_text("{}")
    assert text.load_abbreviations(str(tmp_path / "a.json")) == {"edo": "Estado", "x": "Y"}
    assert text.load_abbreviations(str(tmp_path / "b.json")) == text.load_abbreviations(str(tmp_path / "no")) == text.ABBREVIATIONS
