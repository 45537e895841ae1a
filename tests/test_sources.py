import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from mergewell.sources import config, paged, pages
from mergewell.streaming import incremental


class Api(BaseHTTPRequestHandler):
    total = 290
    failed: set = set()

    def do_GET(self):
        query = parse_qs(urlparse(self.path).query)
        offset, limit = int(query["offset"][0]), min(100, int(query["limit"][0]))
        if offset == 100 and offset not in self.failed:
            self.failed.add(offset)
            self.send_response(503)
            self.end_headers()
            return
        items = [{"id": i} for i in range(offset, min(self.total, offset + limit))]
        body = {"items": items} | ({"total": self.total} if "known" in query else {})
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def api():
    server = HTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/x"
    server.shutdown()


@pytest.mark.parametrize("params,parts", [({"known": 1}, 3), ({}, 1)])
def test_paged_source_reads_each_record_once(spark, api, params, parts):
    spark.dataSource.register(paged.PagedJson)
    Api.failed = set()
    df = spark.read.format("paged_json").option("url", api).option("probeLimit", "500").option("params", json.dumps(params)).load()
    got = df.collect()
    assert sorted(json.loads(r["record"])["id"] for r in got) == list(range(290)) and df.rdd.getNumPartitions() == parts


def test_shapes_of_answers():
    assert paged.records_and_total({"results": [1], "count": 5}) == ([1], 5, True)
    assert paged.records_and_total({"odd": [1]}) == ([], None, False) and paged.records_and_total([1]) == ([1], None, True)
    assert paged.page_size_of(0, 500, 100) == 100 and paged.page_size_of(80, 500, 100) == 80 and paged.page_size_of(500, 500, 100) == 500


def test_html():
    got = pages.read_html("<html><head><title>T &amp; U</title><script>var a='</p>'</script></head><body><nav>no</nav><p>Yes<br>it is<footer>no")
    assert got == {"title": "T & U", "text": "T & U Yes it is"}


def test_feeds():
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><summary>B</summary><link rel="self" href="s"/><link href="h"/></entry></feed>'
    assert pages.read_feed(atom) == [("A", "A B h")]
    assert pages.read_feed("<rss><item>broken") == [(None, "<rss><item>broken")] and len(pages.read_feed("<!DOCTYPE x [<!ENTITY a 'b'>]><rss/>")) == 1


def test_json_lines():
    assert pages.flatten_json('{"a": [{"b": 1}, null, ""], "c": "x"}') == "a[0].b: 1\nc: x" and pages.flatten_json("{") == ""


def test_api_persons(spark):
    body = json.dumps({"items": [{"id": "1", "nombre": " Ana ", "cedula": "12••00", "edad": 200, "estado": "FALLECIDA", "descripcion": ""}, {"id": "2", "nombre": None}], "total": 2})
    good, bad = pages.api_persons(spark.createDataFrame([(body,), ("nonsense",)], "raw_content string"))
    row = good.first()
    assert (row["full_name"], row["cedula_masked"], row["unmapped_cedula"], row["age_range"], row["status"], row["nota"]) == ("Ana", None, "12••00", None, "deceased", "[id:1]")
    assert bad.count() == 2


def test_config(spark):
    good = {"id": "1", "name": "n", "type": "api_json", "enabled": True, "trust_tier": "A", "url": "u", "refresh_minutes": 5, "parser_asignado": "p"}
    assert config.validate_sources([good, {"id": "11111111-1111-4111-8111-111111111111", "parser_asignado": "p", "enabled": True}]) == []
    assert len(config.validate_sources([good, good | {"type": "x", "trust_tier": "Z"}])) == 3
    thin = spark.createDataFrame([("1", True)], "id string, enabled boolean")
    table = spark.createDataFrame([("1", "u", False)], "source_id string, url string, active boolean")
    assert config.resolve_sources(thin, table).first()["enabled"] is False
    with pytest.raises(Exception, match="no catalogue row"):
        config.resolve_sources(thin, table.limit(0)).collect()


def test_incremental_files_are_handled_once(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    spark.range(5).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    run = lambda: incremental.process_new_files(spark, source, schema, str(tmp_path / "cp"), lambda b, i: seen.append(b.count()))
    run()
    run()
    spark.range(5, 8).write.mode("append").parquet(source)
    run()
    assert sum(seen) == 8
    for _ in range(2):
        spark.range(3, 10).write.mode("append").parquet(source)
        incremental.unique_stream(spark, source, schema, "id", str(tmp_path / "out"), str(tmp_path / "cp2"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(10))


def test_pages_until_the_watermark(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("s", p, 10 - p) for p in range(5)], "source_id string, page int, cursor_at int")
    assert sorted(r["page"] for r in incremental.pages_until(rows, F.lit(8)).collect()) == [0, 1, 2]
